"""Row-preserving projections: renames, constants, stamps, tagged unions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class MissingColumns(ValueError):
    """A source lacks columns that its layout names."""


def quoted(name: str) -> Column:
    """Column reference for names with blanks, dots or parentheses."""
    return F.col("`" + name.replace("`", "``") + "`")


def require_columns(present: Iterable[str], wanted: Iterable[str]) -> None:
    present = set(present)
    missing = [name for name in wanted if name not in present]
    if missing:
        raise MissingColumns(f"columns not found in the source: {missing}")


def project_map(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep the mapped columns, renamed and as text; values are untouched."""
    require_columns(df.columns, names)
    return df.select(*[quoted(old).cast("string").alias(new) for old, new in names.items()])


def stamp(df: DataFrame, name: str) -> DataFrame:
    """Audit instant, the same on every row of one query."""
    return df.withColumn(name, F.current_timestamp())


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def unify(parts: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """UNION ALL of sources about one subject; ``tag`` tells which source a row is from."""
    return union_all(df.withColumn(tag, F.lit(label)) for label, df in parts.items())

"""Published text files: a banner line, then the header, then rows; everything as text.

Files of one source may differ in their columns, the order of these, and whether there is a
banner.  One pass over the first lines gives every file's own header; files with the same
header are read with one schema, by position, and the groups are united by name.

Stock Spark has no option to skip leading lines.  ``header=true`` makes it drop the first
line of every file, which is the banner (and the BOM on it) or, without one, the header;
a header line that follows a banner is then an ordinary row, recognised because every field
equals its column name.  Files stay splittable: no multi-line mode, no whole-file reads, no
inference.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pontualis import model
from pontualis.operators.rows import MissingColumns, union_all
from pontualis.sources.headers import HeaderGroup, header_groups, header_index, of_group


class HeaderMismatch(MissingColumns):
    """Some files of a source lack columns that others have."""


@dataclass(frozen=True)
class Layout:
    """How one kind of file is written."""

    columns: Mapping[str, str]
    sep: str = ";"
    quote: str | None = '"'
    charset: str = "UTF-8"
    banner_lines: int = 1

    def __post_init__(self):
        if self.banner_lines not in (0, 1):
            raise ValueError("banner_lines must be 0 or 1")

    def without_banner(self) -> Layout:
        return replace(self, banner_lines=0)


FLIGHTS = Layout(model.FLIGHT_HEADERS)
AIRLINES = Layout(model.AIRLINE_HEADERS)
# In this file a double quote means arc seconds, so quoting is off.
AIRPORTS = Layout(model.AIRPORT_HEADERS, quote=None, charset="ISO-8859-1")


def headers_of(spark: SparkSession, path: str, layout: Layout) -> list[HeaderGroup]:
    """The different headers of the files under ``path``; reads their first lines only."""
    return header_groups(header_index(
        spark, path, names=list(layout.columns), sep=layout.sep, quote=layout.quote,
        charset=layout.charset, banner_lines=layout.banner_lines))


def _require(groups: Sequence[HeaderGroup], path: str, layout: Layout, missing: str) -> None:
    """Raises unless every file can be read."""
    total = sum(g.files for g in groups)
    headless = sum(g.files for g in groups if g.skipped < 0)
    if headless:
        raise MissingColumns(f"{path}: {headless} of {total} files have no header")
    for group in groups:
        twice = [n for n in layout.columns if group.header.count(n) > 1]
        if twice:
            raise ValueError(f"{path}: {group.files} of {total} files have columns twice: {twice}")
    if not any(g.header for g in groups):
        raise MissingColumns(f"{path}: no file has a header")
    if missing == "null":
        return
    lacking = {n: sum(g.files for g in groups if n not in g.header) for n in layout.columns}
    lacking = {n: files for n, files in lacking.items() if files}
    if any(files == total for files in lacking.values()):
        raise MissingColumns(f"columns not found in the source: {list(lacking)}")
    if lacking:
        raise HeaderMismatch(f"{path}: {max(lacking.values())} of {total} files lack columns that "
                             f"others have: {list(lacking)}")


def _read_group(spark: SparkSession, path: str, layout: Layout, group: HeaderGroup, files: Column | None,
                provenance: str | None, folders: int, malformed: str | None) -> DataFrame:
    """The group's lines with the layout's columns, and ``_is_header``."""
    options = {
        "sep": layout.sep,
        "header": "true",
        "encoding": layout.charset,
        "mode": "PERMISSIVE",
        # With quoting off there is nothing to escape either: a backslash is data.
        "quote": layout.quote or "",
        "escape": layout.quote or "",
    }
    fields = [f"_c{i}" for i in range(len(group.header))]
    schema = StructType([StructField(f, StringType()) for f in fields])
    if malformed:
        schema = schema.add("_line", StringType())
        options["columnNameOfCorruptRecord"] = "_line"
    lines = spark.read.schema(schema).options(**options).csv(path)
    if files is not None:
        lines = lines.filter(files)
    columns = {new: F.col(fields[group.header.index(old)]) if old in group.header
               else F.lit(None).cast("string") for old, new in layout.columns.items()}
    if malformed:
        columns[malformed] = F.col("_line")
    if provenance:
        columns[provenance] = F.substring_index("_metadata.file_path", "/", -1 - folders) if folders \
            else F.col("_metadata.file_name")
    is_header = F.lit(False)
    if group.skipped:
        is_header = reduce(and_, [F.col(f).eqNullSafe(F.lit(n))
                                  for f, n in zip(fields, group.header, strict=True)])
    return lines.select(*[c.alias(n) for n, c in columns.items()], is_header.alias("_is_header"))


def read_delimited(spark: SparkSession, path: str, layout: Layout, *,
                   provenance: str | None = None, folders: int = 0, malformed: str | None = None,
                   missing: str = "raise", headers_seen: Observation | None = None,
                   groups: Sequence[HeaderGroup] | None = None) -> DataFrame:
    """All rows of the files matching ``path``, renamed per ``layout``, as text.

    Each file is read by its own header, wherever its columns stand and with or without a
    banner.  Before any row is read, ``MissingColumns`` is raised for a file without header, or
    a column that no file has, and ``HeaderMismatch`` for one that some files lack; with
    ``missing="null"`` such columns are NULL, and a file of nothing but a banner has no rows.
    ``malformed`` names a column to receive the whole line of a row with more or fewer fields
    than its header (NULL for all other rows), so that no field is lost.
    ``provenance`` names a column to receive the file name, after as many ``folders`` of its
    path as wanted.  ``headers_seen`` counts the
    header lines after banners (as ``headers``) while an action runs.  ``groups`` are those of
    :func:`headers_of`, if already known.
    """
    if missing not in ("raise", "null"):
        raise ValueError(f"missing: {missing}")
    groups = headers_of(spark, path, layout) if groups is None else groups
    _require(groups, path, layout, missing)
    rows = union_all([
        _read_group(spark, path, layout, g, of_group(g, groups), provenance, folders, malformed)
        for g in groups if g.header])
    if headers_seen is not None:
        rows = rows.observe(headers_seen, F.count_if("_is_header").alias("headers"))
    return rows.filter("NOT _is_header").drop("_is_header")

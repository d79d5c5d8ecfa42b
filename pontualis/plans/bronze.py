"""Bronze: every source as it arrived.  All text, no row dropped, provenance added."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pontualis.model import INGESTED_AT, SOURCE_FILE
from pontualis.operators.rows import stamp
from pontualis.sources.delimited import Layout, read_delimited
from pontualis.sources.headers import HeaderGroup

#: Bronze keeps here the whole line of a row with too many or too few fields.
MALFORMED = "_linha_malformada"


@dataclass(frozen=True)
class Source:
    """Files of one layout.  ``label`` fixes the provenance text; else it is the file name.
    ``malformed`` names the column that keeps lines with too many or too few fields; without
    it, surplus fields are lost.  With ``missing="null"`` a file may lack columns.
    ``folders`` of a file's path, at most, are part of its name.
    """

    path: str
    layout: Layout
    label: str | None = None
    provenance: bool = True
    malformed: str | None = MALFORMED
    missing: str = "raise"
    folders: int = 0


def bronze_table(spark: SparkSession, source: Source, headers_seen: Observation | None = None,
                 groups: Sequence[HeaderGroup] | None = None) -> DataFrame:
    named_by_file = source.provenance and source.label is None
    rows = read_delimited(
        spark, source.path, source.layout,
        provenance=SOURCE_FILE if named_by_file else None, malformed=source.malformed,
        folders=source.folders, missing=source.missing, headers_seen=headers_seen, groups=groups,
    )
    if source.label is not None:
        rows = rows.withColumn(SOURCE_FILE, F.lit(source.label))
    return stamp(rows, INGESTED_AT)


def bronze_tables(spark: SparkSession, sources: Mapping[str, Source]) -> dict[str, DataFrame]:
    """One reader over all sources, one table each; uniting them is silver's business."""
    return {name: bronze_table(spark, source) for name, source in sources.items()}

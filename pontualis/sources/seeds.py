"""Curated seed tables."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pontualis import model


def seed(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """A text table from rows kept with the code.

    Made from an Arrow table, it is a local relation whose size the planner knows; from a
    list of rows it would be an RDD of unknown size, and joining it would shuffle the fact.
    """
    columns = [pa.array(values, pa.string()) for values in zip(*rows, strict=True)]
    return spark.createDataFrame(pa.table(columns, names=list(names)))


def operation_codes(spark: SparkSession) -> DataFrame:
    """Descriptions of the operation codes, which are published as a page, not a file."""
    return seed(spark, model.OPERATION_CODES, model.OPERATION_CODE_COLUMNS)

"""Whether a result's rows are in order, as a figure.

Rows are compared with their predecessor inside each partition, and partitions by their
first and last rows; no window spans the whole result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pontualis.sources.scratch import materialize


@dataclass(frozen=True)
class SortKey:
    name: str
    ascending: bool = True
    nulls_first: bool | None = None  # by default as Spark: first if ascending

    @property
    def nulls_lead(self) -> bool:
        return self.ascending if self.nulls_first is None else self.nulls_first


def sorts_before(a: Column, b: Column, keys: Sequence[SortKey]) -> Column:
    """Whether struct ``a`` must come before struct ``b``; ties need not."""
    result = F.lit(False)
    for key in reversed(keys):
        x, y = a[key.name], b[key.name]
        smaller = F.coalesce(x < y if key.ascending else x > y, F.lit(False))
        lead, other = (x, y) if key.nulls_lead else (y, x)
        result = smaller | (lead.isNull() & other.isNotNull()) | (x.eqNullSafe(y) & result)
    return result


def order_inversions(df: DataFrame, order: Sequence[str | SortKey]) -> DataFrame:
    """One row: ``linhas``, and ``inversoes``, the neighbours of which the later sorts first."""
    keys = [k if isinstance(k, SortKey) else SortKey(k) for k in order]
    # Written as they come: numbers that depend on the place keep the sort in the plan.
    rows = df.select(F.struct(*[k.name for k in keys]).alias("key"),
                     F.spark_partition_id().alias("part"),
                     F.monotonically_increasing_id().alias("row"))
    rows = materialize(rows, "ordered")
    last = F.lag("key").over(W.partitionBy("part").orderBy("row"))
    inverted = F.col("last").isNotNull() & sorts_before(F.col("key"), F.col("last"), keys)
    parts = rows.withColumn("last", last).groupBy("part").agg(
        F.count(F.lit(1)).alias("linhas"), F.count_if(inverted).alias("inversoes"),
        F.min_by("key", "row").alias("first"), F.max_by("key", "row").alias("last"))
    # One row for each partition.
    bounds = parts.agg(
        F.coalesce(F.sum("linhas"), F.lit(0)).alias("linhas"),
        F.coalesce(F.sum("inversoes"), F.lit(0)).alias("inversoes"),
        F.array_sort(F.collect_list(F.struct("part", "first", "last")),
                     lambda a, b: (a["part"] - b["part"]).cast("int")).alias("parts"))
    later = F.slice("parts", F.lit(2), F.size("parts"))
    between = F.zip_with(F.slice("parts", F.lit(1), F.greatest(F.size("parts") - 1, F.lit(0))), later,
                         lambda a, b: sorts_before(b["first"], a["last"], keys))
    return bounds.select("linhas", (F.col("inversoes") + F.size(F.filter(between, lambda x: x)))
                         .cast("long").alias("inversoes"))

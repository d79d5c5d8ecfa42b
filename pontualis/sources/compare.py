"""Which rows differ between two loads, reading only the parts that do.

A load that is to be compared is published in buckets of a key, each a partition.  Every
bucket has a digest that does not depend on the order of its rows: their number, and the
sums of two hashes over all columns but the audit's.  Digests are a table beside the
loads, of one row for each bucket; two loads are compared digest by digest, and only the
buckets that differ are read, by partition pruning.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pontualis.model import INGESTED_AT, TRANSFORMED_AT
from pontualis.operators.reconcile import UNCHANGED, diff_rows, multiset_difference
from pontualis.sources import loads

BUCKET = "_balde"
AUDIT = (INGESTED_AT, TRANSFORMED_AT)


class NotComparable(ValueError):
    """The loads were not published in the same buckets."""


def _row_hash(columns: Sequence[str], seed: int) -> Column:
    # xxhash64 passes over NULLs, so where they are is hashed too.
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(F.lit(seed), nulls, *columns).cast("decimal(38,0)")


def _digest(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    return table.groupBy(BUCKET).agg(
        F.count(F.lit(1)).alias("linhas"), F.sum(_row_hash(columns, 1)).alias("soma_1"),
        F.sum(_row_hash(columns, 2)).alias("soma_2"))


def publish_in_buckets(df: DataFrame, path: str, load_id: str, keys: Sequence[str], *,
                       buckets: int = 256, ignored: Sequence[str] = AUDIT, **options) -> DataFrame:
    """:func:`loads.publish` of ``df`` with its ``_balde``, partitioned by it.

    ``keys`` decide the bucket and ``ignored`` columns are not compared.  Rows of a hot key are
    one bucket, which the write spreads over several files.
    """
    columns = [c for c in df.columns if c not in ignored]
    layout = json.dumps({"chaves": list(keys), "baldes": buckets, "colunas": columns})
    bucketed = df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    table = loads.publish(bucketed, path, load_id, partition_by=[BUCKET], rebalance=True,
                          layout=layout, **options)
    digests(df.sparkSession, path, load_id)
    return table


def _layout(spark: SparkSession, path: str, load_id: str) -> dict:
    layout = loads.layout_of(spark, path, load_id)
    if layout is None:
        raise NotComparable(f"{path}: load {load_id} is not in buckets")
    return json.loads(layout)


def digests(spark: SparkSession, path: str, load_id: str) -> DataFrame:
    """A load's digests, one row for each bucket; made and stored if a writer died before it did."""
    beside = f"{path}/resumos"
    known = loads.published(spark, beside, load_id)
    if known is not None:
        return known
    layout = _layout(spark, path, load_id)
    made = _digest(loads.read_load(spark, path, load_id), layout["colunas"])
    try:
        return loads.publish(made, beside, load_id)
    except loads.RivalLoad:  # who has stored the same
        return loads.read_load(spark, beside, load_id)


def changed_buckets(spark: SparkSession, path: str, first: str, second: str) -> list[int]:
    """The buckets in which two loads differ, at most as many as there are buckets."""
    layouts = [_layout(spark, path, load_id) for load_id in (first, second)]
    if layouts[0] != layouts[1]:
        raise NotComparable(f"{path}: loads {first} and {second} have other buckets or columns")
    old, new = (digests(spark, path, load_id).alias(a) for a, load_id in (("o", first), ("n", second)))
    same = [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in ("linhas", "soma_1", "soma_2")]
    both = old.join(new, F.col(f"o.{BUCKET}") == F.col(f"n.{BUCKET}"), "full")
    differing = both.filter(~(same[0] & same[1] & same[2]))
    found = differing.select(F.coalesce(f"o.{BUCKET}", f"n.{BUCKET}").alias(BUCKET)).collect()
    return sorted(r[0] for r in found)


def _of_buckets(spark: SparkSession, path: str, load_id: str, buckets: Sequence[int]) -> DataFrame:
    return loads.read_load(spark, path, load_id).filter(F.col(BUCKET).isin(*buckets))


def changed_rows(spark: SparkSession, path: str, first: str, second: str, *,
                 compare: Sequence[str] | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Added, removed and changed rows, as :func:`diff_rows` gives them; the loads' bucket keys
    must be unique.  ``compare`` defaults to all columns that count."""
    layout = _layout(spark, path, first)
    buckets = changed_buckets(spark, path, first, second)
    keys = layout["chaves"]
    compare = compare or [c for c in layout["colunas"] if c not in keys]
    old, new = (_of_buckets(spark, path, load_id, buckets) for load_id in (first, second))
    return diff_rows(old, new, keys, compare, carry=carry).filter(F.col("status") != UNCHANGED)


def surplus_rows(spark: SparkSession, path: str, first: str, second: str) -> DataFrame:
    """Rows that one load has more often (+ the first, - the second), for loads without a key."""
    columns = _layout(spark, path, first)["colunas"]
    buckets = changed_buckets(spark, path, first, second)
    old, new = (_of_buckets(spark, path, load_id, buckets) for load_id in (first, second))
    return multiset_difference(old, new, columns)

"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Words as the contracts count them: maximal runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, size: str = "4m") -> Iterator[None]:
    """What is written inside goes to Python in batches of about ``size`` bytes.

    A batch of ten thousand texts is as large as these; the JVM and Python hold it at once.
    """
    before = spark.conf.get(_BATCH_BYTES, None)
    spark.conf.set(_BATCH_BYTES, size)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH_BYTES)
        else:
            spark.conf.set(_BATCH_BYTES, before)


def fresh(columns: Iterable[str], name: str) -> str:
    """``name``, lengthened until no column has it, so that helpers never clash."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def power_of_two(n: int) -> int:
    return 1 << max(0, int(n) - 1).bit_length()


def with_running(df: DataFrame, keys: list[str], order: list[Column], bucket: Column,
                 measure: Column, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``measure`` over earlier rows of the same ``keys``.

    ``bucket`` splits a key into ordered buckets (every row of a bucket comes before every
    row of a later one).  Buckets are summed first, and only within one bucket are rows put
    in order, so a key that holds a third of all rows is spread over all its buckets.
    """
    b, part, base = (fresh(df.columns, c) for c in ("_bucket", "_part", "_base"))
    rows = df.withColumn(b, bucket)
    match = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in (*keys, b)]
    before = W.partitionBy(*keys).orderBy(b).rowsBetween(W.unboundedPreceding, -1)
    sums = rows.groupBy(*keys, b).agg(F.sum(measure).alias(part))
    bases = sums.withColumn(base, F.coalesce(F.sum(part).over(before), F.lit(0))).drop(part)
    inner = W.partitionBy(*keys, b).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    inside = rows.withColumn(part, F.coalesce(F.sum(measure).over(inner), F.lit(0)))
    condition = match[0]
    for m in match[1:]:
        condition = condition & m
    joined = inside.alias("l").join(bases.alias("r"), condition, "left")
    return joined.select(*[F.col(f"l.{c}") for c in df.columns],
                         (F.col(f"l.{part}") + F.col(f"r.{base}")).cast("long").alias(name))

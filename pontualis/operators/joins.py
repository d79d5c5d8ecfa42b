"""Lookups from the fact to registries.

None of these joins carries a broadcast hint.  Registries come from tables or files, so
Spark knows their size and broadcasts them only below
``spark.sql.autoBroadcastJoinThreshold``; a registry beyond it is sort-merge joined, and
AQE splits the fact side's oversized partitions (a hot carrier, or all rows without a
code).  The build side is reduced to one row per key first, so a lookup can neither add
nor drop fact rows.

AQE splits only a join whose two inputs both come straight from a shuffle.  A build side
grouped by the join key alone would keep that partitioning, skip the shuffle and rule the
split out, hence the extra grouping column of :func:`unjoined_grouping`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pontualis.functions.text import is_filled


def unjoined_grouping(*keys: str) -> Column:
    """A grouping column that depends on ``keys`` alone: same groups, other partitioning."""
    return F.hash(*keys).alias("key_hash")


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Distinct values of ``keys``, ready to be the build side of a join on them."""
    return df.select(*keys, unjoined_grouping(*keys)).distinct().select(*keys)


def clean_keys(dim: DataFrame, key: str) -> DataFrame:
    """Distinct non-blank keys."""
    return distinct_keys(dim.filter(is_filled(F.col(key))), key)


def one_row_per_key(dim: DataFrame, key: str, *, wanted: str | None = None,
                    precedence: Sequence[Column] = ()) -> DataFrame:
    """Non-blank keys with one of their attribute rows.

    Registries may list a code more than once.  Rows whose ``wanted`` attribute (the first
    one, if not named) is filled come first, then those first by ``precedence``, then the
    smallest row, so that the choice never depends on row order.
    """
    values = [c for c in dim.columns if c != key]
    blank = ~is_filled(F.col(wanted or values[0]).cast("string"))
    order = F.struct(blank.alias("blank"), *[c.alias(f"p{i}") for i, c in enumerate(precedence)],
                     *values)
    groups = dim.filter(is_filled(F.col(key))).groupBy(key, unjoined_grouping(key))
    return groups.agg(F.min(order).alias("row")).select(key, *[f"row.{c}" for c in values])


def flag_membership(df: DataFrame, key: str, dim: DataFrame, dim_key: str, out: str) -> DataFrame:
    """Add ``out``: is ``key`` listed in ``dim``?  FALSE for a NULL key."""
    known = f"{out}__known"
    keys = clean_keys(dim, dim_key).withColumnRenamed(dim_key, known)
    joined = df.join(keys, F.col(key) == F.col(known), "left")
    return joined.withColumn(out, F.col(known).isNotNull()).drop(known)


def describe_code(df: DataFrame, code: str, codes: DataFrame, domain: str, out: str) -> DataFrame:
    """Add ``out``: the description of ``code`` within ``domain``, NULL if not listed."""
    texts = codes.filter(F.col("dominio") == domain).select(
        F.col("codigo").alias(code), F.col("descricao").alias(out)
    )
    return df.join(one_row_per_key(texts, code), code, "left")


def by_longest_prefix(df: DataFrame, key: str, prefixes: DataFrame, out: str, *,
                      prefix: str = "prefixo", value: str = "valor") -> DataFrame:
    """Add ``out``: the ``value`` of the longest of ``prefixes`` that ``key`` begins with.

    NULL for a NULL key or one without a listed prefix; the empty prefix matches all.  Only the
    distinct keys meet the prefixes, each with one candidate for every length that is listed
    (lengths are few, and are looked up first); the longest match is then joined as any lookup.
    """
    listed = one_row_per_key(prefixes.select(F.col(prefix).alias("_found"), F.col(value).alias("_value"))
                             .withColumn("_found", F.concat(F.lit("^"), "_found")), "_found")
    lengths = sorted(r[0] for r in listed.select(F.length("_found") - 1).distinct().collect())
    codes = df.filter(F.col(key).isNotNull()).select(key, unjoined_grouping(key)).distinct()
    # The mark in front makes the empty prefix a key like the others.
    starts = F.array(*[F.concat(F.lit("^"), F.substring(key, 1, n)) for n in lengths])
    candidates = codes.withColumn("_found", F.explode(F.array_distinct(starts.cast("array<string>"))))
    matched = candidates.join(listed, "_found").groupBy(key, unjoined_grouping(key)).agg(
        F.max_by("_value", F.length("_found")).alias(out))
    return df.join(matched.select(key, out), key, "left")

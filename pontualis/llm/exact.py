"""Exact de-duplication by tree-merging runs of digests; DataFrame operations only.

A document's digest is its SHA-256, verified by two independent values, the byte length and
``xxhash64``.  Rows are dealt to runs by a hash of their identifier; each run holds one
record per digest.  In every round ``fan_in`` neighbouring runs meet: they are exchanged by
(run block, digest), sorted, and merged, keeping the wanted identifier and the summed
count.  After the last round one run is left, spread over all partitions by digest.  The
result then goes back down: to the records of the first runs, one for each digest and run,
and from them to the documents, so that a text held by a third of all rows is dealt over
as many keys as there are runs.

Defined cases: a null text counts as the empty one; of rows with the same identifier and
text all are kept or none; rows without an identifier stay only if none of their group
has one.  Extra columns are ignored by ``groups`` and carried by ``exact_dedup``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pontualis.llm.tables import fresh, power_of_two
from pontualis.sources.scratch import materialize

DIGEST = ["sha", "bytes", "check"]


def digests(text: Column) -> list[Column]:
    text = F.coalesce(text, F.lit(""))
    return [F.sha2(text, 256).alias("sha"), F.octet_length(text).cast("long").alias("bytes"),
            F.xxhash64(text).alias("check")]


def merge_round(runs: DataFrame, fan_in: int, keep: str) -> DataFrame:
    """Merges each ``fan_in`` neighbouring runs into one."""
    best = F.max if keep == "largest" else F.min
    exchanged = (runs.withColumn("run", F.floor(F.col("run") / fan_in).cast("long"))
                 .repartition("run", *DIGEST).sortWithinPartitions("run", *DIGEST))
    return exchanged.groupBy("run", *DIGEST).agg(best("keep_id").alias("keep_id"),
                                                 F.sum("rows").alias("rows"))


def groups(df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
           keep: str = "smallest", runs: int | None = None, fan_in: int = 4) -> DataFrame:
    """One row per input row: ``id, sha, keep_id, group_size, kept``.

    ``keep`` is ``smallest`` or ``largest`` identifier; ``runs`` defaults to the number of
    shuffle partitions, 256 at least.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep: {keep}")
    shuffles = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    runs = power_of_two(runs or max(256, int(shuffles)))
    rows = df.select(F.col(id_column).alias("id"), *digests(F.col(text_column)))
    rows = rows.withColumn("run", F.pmod(F.xxhash64("id"), F.lit(runs)))
    rows = materialize(rows, "digests")
    best = F.max if keep == "largest" else F.min
    leaves = rows.groupBy("run", *DIGEST).agg(best("id").alias("keep_id"),
                                              F.count(F.lit(1)).alias("rows"))
    root, left = leaves, runs
    while left > 1:
        root, left = merge_round(root, fan_in, keep), -(-left // fan_in)
    decided = (leaves.select("run", *DIGEST)
               .join(root.select(*DIGEST, "keep_id", F.col("rows").alias("group_size")), DIGEST))
    out = rows.join(decided, ["run", *DIGEST])
    kept = F.col("id").eqNullSafe(F.col("keep_id"))
    return out.select("id", "sha", "keep_id", "group_size", kept.alias("kept"))


def exact_dedup(df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
                keep: str = "smallest") -> DataFrame:
    """The rows of ``df`` that stay, all their columns unchanged.  Identifiers are unique."""
    other = fresh(df.columns, "_id")
    kept = (groups(df, id_column=id_column, text_column=text_column, keep=keep)
            .filter("kept").select(F.col("id").alias(other)).distinct())
    return df.join(kept, F.col(id_column).eqNullSafe(F.col(other)), "left_semi")

"""The stages from raw documents to shards.

Every stage takes what its predecessor kept, and all but the last return the columns of
``documents``, whatever further columns it has.  Identifiers are expected to be unique: rows that
repeat one are one document to the join, and share its fate.  Ties go to the smallest
identifier; an empty table goes through all stages and gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pontualis.llm import decontaminate, jaccard, language, mixing, sharding
from pontualis.llm.tables import fresh, table
from pontualis.sources.scratch import materialize, release


#: Nats a byte by which the best language must explain a text better than none; a little below 0, so
#: that a text of rare words stays.  Text of a language that was learned is above 0.5, other text
#: below -0.5.
LEAST_GAIN = -0.2


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned: those go that have no letters, or that the language
    explaining them best explains worse than a model without language.

    The column ``lang`` is only learned from; it is left as it is.  If it names no language at
    all, nothing can be told from it, and all documents with letters stay.  Null texts go, empty
    tables stay empty, repeated rows are decided alike, other columns are carried along, and a
    very long text is read as a whole.
    """
    model = language.train(docs)
    if not model.languages:
        return docs.filter(language.has_letter(F.col("text")))
    gain = fresh(docs.columns, "_gain")
    found = docs.withColumn(gain, language.gain(spark, model)(F.col("text")))
    return found.filter(F.col(gain) >= LEAST_GAIN).select(*docs.columns)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest identifier."""
    return jaccard.representatives(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which fewer than one word in twenty lies in a benchmark passage."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the target of its source takes it."""
    return mixing.repeated(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, size, shard, slot`` of every row of the mix."""
    out = sharding.into_shards(docs, 8)
    return out.select(F.col("id").alias("doc_id"), "size", "shard", "slot")


STAGES = [
    ("language ID", identified),
    ("n-gram Jaccard join", distinct),
    ("benchmark decontamination", decontaminated),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: The language model and the packing are beyond SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        before, docs = docs, materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
        if number:
            release(before)
    return docs

"""Mixing sources to target weights by capped water-filling.

Sources are poured words in proportion to their weights.  A source that would get more than
``max_epochs`` times its size is clamped there and its excess goes to the others, by weight,
until none is above.  The level is found in closed form from the sources in order of
``capacity / weight``: a source is clamped exactly if its capacity is no more than what the
level of all sources from it on would give it.

A target is then sampled: every document of the source is taken a whole number of times,
and the rest in a seeded order of the documents until the target is reached; the document
at the border is taken in part.  The order is that of MD5 over seed and identifier, summed
bucket by bucket, so that one source with most of the rows is spread over 4,096 tasks' keys.

Defined cases: a null text has size 0 and takes nothing; null is a source of its own, the
last; rows with equal identifiers are taken one after another, in order of their size.
Only totals per source (one row each) are ever gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pontualis.llm.tables import WORD, fresh, with_running
from pontualis.sources.scratch import materialize


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, *, budget: float, max_epochs: int) -> DataFrame:
    """Adds ``target`` to rows of ``size`` (long) and ``weight``."""
    by_ratio = W.orderBy(F.col("size") / F.col("weight"), "rank")
    cap = max_epochs * F.col("size")
    earlier = F.coalesce(F.sum(cap).over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing))
    whole = W.partitionBy()
    total = budget * F.sum("size").over(whole)
    marked = (sources.withColumns({"cap": cap, "earlier": earlier, "rest": rest, "total": total})
              .withColumn("clamped", F.col("cap") * F.col("rest")
                          <= F.col("weight") * (F.col("total") - F.col("earlier"))))
    free = F.sum(F.when(~F.col("clamped"), F.col("weight"))).over(whole)
    held = F.coalesce(F.sum(F.when(F.col("clamped"), F.col("cap"))).over(whole), F.lit(0))
    target = F.when(F.col("clamped"), F.col("cap").cast("double")).otherwise(
        F.col("weight") * (F.col("total") - held) / free)
    return marked.withColumn("target", target).select(*sources.columns, "target")


def _placed(df: DataFrame, id_column: str, text_column: str, source_column: str,
            weights: Sequence[int], budget: float, max_epochs: int,
            seed: str) -> tuple[DataFrame, DataFrame]:
    """The rows with their place in their source (``key, id, size``), the words ``before`` it, and
    the source's ``whole`` repetitions and words ``left`` for the rest; and the sources."""
    rows = df.select(F.col(id_column).alias("id"), F.col(source_column).alias("source"),
                     words(F.col(text_column)).alias("size"))
    rows = materialize(rows, "sizes")
    ranked = W.orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights)) + 1)
    sources = (rows.groupBy("source").agg(F.sum("size").alias("size"))
               .withColumn("rank", F.row_number().over(ranked) - 1)
               .withColumn("weight", turn))
    whole = F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size")))
    whole = F.coalesce(whole, F.lit(0)).cast("long")
    left = F.floor(F.col("target") + 0.5).cast("long") - F.col("whole") * F.col("size")
    targets = materialize(water_fill(sources, budget=budget, max_epochs=max_epochs)
                          .withColumn("whole", whole).withColumn("left", left), "targets")
    targets = targets.select(F.col("source").alias("_source"), F.col("size").alias("source_size"),
                             "target", "whole", "left")
    keyed = rows.withColumn("key", place_key(F.col("id"), seed))
    bucket = F.conv(F.substring("key", 1, 3), 16, 10).cast("int")
    summed = with_running(keyed, ["source"], [F.col("key"), F.col("id"), F.col("size")],
                          bucket, F.col("size"), "before")
    return summed.join(targets, F.col("source").eqNullSafe(F.col("_source"))), targets


def place_key(id: Column, seed: str) -> Column:
    """What orders a source's documents, before identifier and size."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit(""))))


def mix(df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
        source_column: str = "source", weights: Sequence[int] = (3, 1, 2),
        budget: float = 1.5, max_epochs: int = 2, seed: str = "mix") -> DataFrame:
    """One row per input row: ``id, source, size, source_size, target, taken``.

    Sources in code-point order, null last, have ``weights`` in turn; together they share
    ``budget`` times the words of all documents.
    """
    out, _ = _placed(df, id_column, text_column, source_column, weights, budget, max_epochs, seed)
    part = F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), F.col("left") - F.col("before")))
    return out.select("id", "source", "size", "source_size", "target",
                      (F.col("whole") * F.col("size") + part).alias("taken"))


def repeated(df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
             source_column: str = "source", weights: Sequence[int] = (3, 1, 2),
             budget: float = 1.5, max_epochs: int = 2, seed: str = "mix") -> DataFrame:
    """The mixed rows themselves: each as often as :func:`mix` takes it, all columns unchanged
    except that a part holds the document's leading words, joined by one space.

    A document's share follows from its own place and that of its source's border document, one
    small row for each source, so no text is shuffled.  Identifiers are unique; a document may
    appear several times, which is the mix.
    """
    placed, targets = _placed(df, id_column, text_column, source_column, weights, budget, max_epochs,
                              seed)
    place = F.struct("key", "id", "size")
    border = placed.filter("before < left AND before + size >= left").select(
        "source", place.alias("border"), (F.col("left") - F.col("before")).alias("part"))
    known = targets.join(border, F.col("_source").eqNullSafe(F.col("source")), "left")
    names = {c: fresh(df.columns, f"_mix_{c}") for c in
             ("source", "whole", "border", "part", "size", "place", "copy")}
    known = materialize(known.select(F.col("_source").alias(names["source"]),
                                     *[F.col(c).alias(names[c]) for c in ("whole", "border", "part")]),
                        "borders")
    whole, border, part, size, place, copy = (
        F.col(names[c]) for c in ("whole", "border", "part", "size", "place", "copy"))
    rows = df.withColumn(names["size"], words(F.col(text_column)))
    rows = rows.withColumn(names["place"], F.struct(
        place_key(F.col(id_column), seed).alias("key"), F.col(id_column).alias("id"), size.alias("size")))
    joined = rows.join(known, F.col(source_column).eqNullSafe(F.col(names["source"])))
    # A document before the border is taken once more, the one at the border in part.
    again = F.when(place < border, size).when(place == border, part).otherwise(0)
    copies = F.array_repeat(F.lit(0).cast("long"), (whole + (again == size).cast("int")).cast("int"))
    copies = F.when((again > 0) & (again < size), F.array_append(copies, again)).otherwise(copies)
    found = F.regexp_extract_all(F.col(text_column), F.lit(WORD), F.lit(0))
    cut = F.array_join(F.slice(found, F.lit(1), copy.cast("int")), " ")
    text = F.when(copy > 0, cut).otherwise(F.col(text_column))
    return (joined.filter(size > 0).withColumn(names["copy"], F.explode(copies))
            .withColumn(text_column, text).select(*df.columns))

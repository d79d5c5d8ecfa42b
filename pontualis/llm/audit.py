"""What a chain of filters removes in every order, and how the filters overlap.

A filter's failures are a relation of document keys.  That of the copies comes from an
existential self-join: documents are semi-joined with the smallest identifiers of equal
texts on hash, exact text and smaller identifier.  Its keys are united with those of the
other filters, and each document's failures become a combination of bits.  All else
follows from how many documents of a part have each combination, at most ``2^filters`` rows
a part, however many documents there are.

**Skew.**  Only texts whose hash occurs again are read a second time.  The rows of one hash
are dealt over as many keys as it has thousands of rows, and the smallest identifier, found
with a map-side step, is replicated to these keys, so a text held by a third of all rows is
no single task's.

Defined cases: a null text is the empty one, a null part the empty string.  Rows without
identifier are no copies and have none.  Repeated rows count each; rows with the same
identifier and text fail together.  A document is good or toxic if any label row of its
identifier says so.  A table without rows gives none.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pontualis.llm.tables import WORD
from pontualis.sources.scratch import materialize

_DEALT = 1000  # rows of equal texts that share a key


def text_failures(text: Column) -> dict[str, Column]:
    """The four conditions on a text alone, under which a document fails."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return {
        "A": F.size(words) < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 5 * F.char_length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def _bits(failures: Mapping[str, Column], letters: str) -> Column:
    bits = [F.when(c, F.lit(1 << letters.index(name))).otherwise(F.lit(0))
            for name, c in failures.items()]
    return reduce(Column.bitwiseOR, bits)


def later_copies(docs: DataFrame) -> DataFrame:
    """Distinct ``id, hash`` of the rows of ``docs`` (id, hash, text) that a row with equal text
    and a smaller id precedes."""
    known = docs.filter(F.col("id").isNotNull())
    again = (known.groupBy("hash").agg(F.count(F.lit(1)).alias("rows"), F.min("id").alias("least"),
                                       F.max("id").alias("most"))
             .filter("least < most")
             .select("hash", (F.col("rows") / _DEALT).cast("int").alias("last_key")))
    again = materialize(again, "repeated_hashes")
    key = F.pmod(F.xxhash64("id"), F.col("last_key") + 1).cast("int")
    candidates = materialize(known.join(again, "hash").withColumn("key", key), "candidates")
    first = (candidates.groupBy("hash", "text", "last_key").agg(F.min("id").alias("least"))
             .withColumn("key", F.explode(F.sequence(F.lit(0), "last_key"))))
    l, r = candidates.alias("l"), first.alias("r")
    same = ((F.col("l.hash") == F.col("r.hash")) & (F.col("l.key") == F.col("r.key"))
            & (F.col("l.text") == F.col("r.text")) & (F.col("r.least") < F.col("l.id")))
    return l.join(r, same, "left_semi").select("id", "hash").distinct()


def combinations(documents: DataFrame, labels: DataFrame, *, letters: str = "ABCDE",
                 copies: str = "E", id_column: str = "doc_id", text_column: str = "text",
                 part_column: str = "source", failures=text_failures) -> DataFrame:
    """``part, bits, n, good, toxic``: documents of each part by the filters they fail.

    ``letters`` names the filters, bit by bit; ``failures`` gives the conditions of all but
    ``copies``.
    """
    text = F.coalesce(text_column, F.lit(""))
    docs = documents.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("hash"),
                            F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"),
                            text.alias("text"))
    rows = materialize(docs.select("id", "hash", "part", _bits(failures(F.col("text")), letters)
                                   .alias("bits")), "judged")
    again = later_copies(docs.select("id", "hash", "text"))
    failed = (rows.filter("bits > 0").select("id", "hash", "bits")
              .unionAll(again.withColumn("bits", F.lit(1 << letters.index(copies))))
              .groupBy("id", "hash").agg(F.bit_or("bits").alias("bits")))
    failed = failed.select(F.col("id").alias("f_id"), F.col("hash").alias("f_hash"), "bits")
    counted = rows.groupBy("id", "hash", "part").agg(F.count(F.lit(1)).alias("n"))
    joined = counted.join(failed, F.col("id").eqNullSafe(F.col("f_id"))
                          & (F.col("hash") == F.col("f_hash")), "left")

    def says(column: str) -> Column:
        return F.coalesce(F.max(F.col(column) == 1), F.lit(False)).alias(column)

    said = labels.groupBy(F.col(id_column).alias("l_id")).agg(says("quality"), says("toxic"))
    judged = joined.join(said, F.col("id") == F.col("l_id"), "left")

    def those(column: str) -> Column:
        return F.sum(F.when(F.col(column), F.col("n")).otherwise(0))

    return judged.groupBy("part", F.coalesce("bits", F.lit(0)).alias("bits")).agg(
        F.sum("n").alias("n"), those("quality").alias("good"), those("toxic").alias("toxic"))


def interactions(counts: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """One row per part, order of the filters and step, from the rows of :func:`combinations`."""
    orders = F.array(*[F.lit("".join(p)) for p in permutations(letters)])
    by_part = (counts.groupBy("part")
               .agg(F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("groups"))
               .withColumn("filter_order", F.explode(orders))
               .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters))))))
    place = F.instr(F.lit(letters), F.substring("filter_order", F.col("step"), F.lit(1)))
    earlier = [F.when(F.instr("filter_order", F.lit(x)) < F.col("step"), 1 << i).otherwise(0)
               for i, x in enumerate(letters)]
    steps = by_part.select("*", F.call_function("shiftleft", F.lit(1), place - 1).alias("own"),
                           reduce(Column.__add__, earlier).alias("before"))
    own, before = F.col("own"), F.col("before")

    def fails(group: Column) -> Column:
        return group["bits"].bitwiseAND(own) != 0

    def untouched(group: Column) -> Column:
        return group["bits"].bitwiseAND(before) == 0

    def total(which, value=lambda group: group["n"]) -> Column:
        return F.aggregate(F.filter("groups", which), F.lit(0).cast("long"),
                           lambda sum, group: sum + value(group))

    def here(group: Column) -> Column:
        return fails(group) & untouched(group)

    def all_orders(group: Column) -> Column:
        # Of a document's failing filters, each comes first in the same share of all orders.
        n = len(list(permutations(letters)))
        share = reduce(lambda rest, k: F.when(F.bit_count(group["bits"]) == k, n // k).otherwise(rest),
                       range(1, len(letters) + 1), F.lit(0))
        return group["n"] * share

    return steps.select(
        "part", "filter_order", "step",
        total(lambda g: untouched(g) & ~fails(g)).alias("kept"),
        total(here).alias("removed"),
        total(lambda g: fails(g) & ~untouched(g)).alias("redundant"),
        total(lambda g: g["bits"] == own).alias("unique_fails"),
        total(here, lambda g: g["good"]).alias("good_lost"),
        total(here, lambda g: g["toxic"]).alias("toxic_lost"),
        total(fails, all_orders).alias("shapley"))

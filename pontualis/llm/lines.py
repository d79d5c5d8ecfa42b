"""Line de-duplication with a suffix array over line-ID sequences.

A document is the sequence of its lines that hold words.  All suffixes of all sequences are
sorted by prefix doubling: once they are ranked by their first h lines, the pairs of ranks
at a place and h lines on rank them by 2h lines, and the pairs at a place and d < h lines on
tell which are equal in h + d lines.  A rank is the place of a group's first suffix in
the suffix array.  Suffixes whose first lines occur once are settled and drop out, so a
round handles only what still repeats.  The groups of a length are the intervals whose
longest common prefix is at least that long; of every group the first place (by
identifier, then line) is the original, and the other places begin later copies.

The longest stretch at a place that has come before is the maximal run there, and it goes if it
holds at least ``min_words`` words.  A line holds one, so a run of more than ``min_words`` lines
is the union of its stretches of ``min_words`` lines, and all lengths up to that many lines
are all there is to judge.  All lines of a later copy are deleted; wordless lines are no part
of any run and stay.

A line that is a third of all lines is counted before the shuffle, and its ranks go back in a
join whose large side AQE splits.

Defined cases: a null text has no lines and stays null; rows with equal identifiers are in
the order of a hash of their texts, and fully repeated rows are one document; an empty
identifier comes first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pontualis.llm.tables import WORD, with_running
from pontualis.sources.scratch import materialize

_WORDY = r"[^\x20\x09-\x0D]"
_PLACE = ["id", "check", "pos"]


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _wordy(line: Column) -> Column:
    return F.regexp_like(line, F.lit(_WORDY))


def _lines_for(counts: Column, min_words: int) -> Column:
    """How many of the lines with these word counts it takes for ``min_words``; NULL if all are
    too few."""
    zero = F.struct(F.lit(0).alias("words"), F.lit(0).alias("lines"))

    def add(done: Column, more: Column) -> Column:
        needed = (done["words"] < min_words).cast("int")
        return F.struct((done["words"] + more).alias("words"), (done["lines"] + needed).alias("lines"))

    return F.aggregate(counts, zero, add, lambda done: F.when(done["words"] >= min_words, done["lines"]))


def line_table(df: DataFrame, id_column: str, text_column: str, min_words: int) -> DataFrame:
    """``id, check, pos, enough, h1, h2``: a row for each line with words, of each input row.
    ``enough`` lines from there hold ``min_words`` words."""
    text = F.col(text_column)
    rows = df.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("check"),
                     F.filter(split_lines(text), _wordy).alias("lines"))
    rows = rows.withColumn("counts", F.transform("lines", lambda x: F.regexp_count(x, F.lit(WORD))))
    rows = rows.select("id", "check", "counts", F.posexplode("lines").alias("pos", "line"))
    ahead = F.slice("counts", F.col("pos") + 1, F.lit(min_words))
    second = F.shiftleft(F.crc32("line"), 31).bitwiseXOR(F.length("line").cast("long"))
    return rows.select(*_PLACE, _lines_for(ahead, min_words).alias("enough"),
                       F.xxhash64("line").alias("h1"), second.alias("h2"))


def _same(left: str, right: str, columns: list[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


def _ranked(rows: DataFrame, names: list[str], base: Column, group: list[str]) -> DataFrame:
    """Rows whose ``names`` occur at several places, with the rank of their group and whether
    an earlier place has the same."""
    first = F.min(F.struct(*_PLACE)).alias("first")
    counted = (rows.groupBy(*names).agg(F.count(F.lit(1)).alias("size"), first)
               .filter("size > 1"))
    counted = materialize(counted, "names")
    bucket = F.shiftright(F.col(names[-1] if group else names[0]), 52).cast("int")
    if group:  # ranks are small numbers: their own order, some thousand to a bucket
        bucket = F.shiftright(F.col(names[-1]), 10)
    order = [F.col(n) for n in names]
    placed = with_running(counted, group, order, bucket, F.col("size"), "smaller")
    placed = materialize(placed.withColumn("new_rank", base + F.col("smaller")), "ranks")
    out = rows.join(placed.select(*names, "new_rank", "first"), names)
    later = F.col("first") < F.struct(*_PLACE)
    return out.select(*_PLACE, "enough", F.col("new_rank").alias("rank"), later.alias("later"))


def _paired(level: DataFrame, on: int) -> DataFrame:
    """The suffixes of a level with the rank of the one ``on`` lines on, where that repeats too."""
    further = level.select("id", "check", (F.col("pos") - on).alias("pos"), F.col("rank").alias("next"))
    return (level.alias("l").join(further.alias("r"), _same("l", "r", _PLACE))
            .select(*[f"l.{c}" for c in _PLACE], "l.enough", "l.rank", "r.next"))


def copied(df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
           min_words: int = 5) -> DataFrame:
    """``id, check, pos`` of all lines of later copies; ``pos`` counts lines with words from 0."""
    lines = materialize(line_table(df, id_column, text_column, min_words), "lines")
    level = _ranked(lines, ["h1", "h2"], F.lit(0), [])
    # Fully repeated rows give equal places, which are one from here on.
    level = materialize(level.distinct(), "suffixes")

    def begun(rows: DataFrame, size: int) -> DataFrame:
        """All lines of the later copies of ``size`` lines with words enough."""
        begins = rows.filter(F.col("later") & (F.col("enough") <= size))
        return begins.select("id", "check", F.explode(F.sequence(
            F.col("pos"), F.col("pos") + (size - 1))).alias("pos"))

    found, length = [begun(level, 1)], 1
    while length < min_words:
        for size in range(length + 1, min(2 * length - 1, min_words) + 1):
            pairs = materialize(_paired(level, size - length), "pairs")
            first = materialize(pairs.groupBy("rank", "next").agg(
                F.min(F.struct(*_PLACE)).alias("first"), F.count(F.lit(1)).alias("size"))
                .filter("size > 1").drop("size"), "firsts")
            later = F.col("first") < F.struct(*_PLACE)
            found.append(begun(pairs.join(first, ["rank", "next"]).withColumn("later", later), size))
        if 2 * length > min_words:
            break
        pairs = materialize(_paired(level, length), "pairs")
        level = materialize(_ranked(pairs, ["rank", "next"], F.col("rank"), ["rank"]), "suffixes")
        length *= 2
        found.append(begun(level, length))
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out.distinct()


def dedup_lines(df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
                min_words: int = 5) -> DataFrame:
    """One row per input row: ``id, text, n_lines, deleted``; ``text`` without the deleted
    lines, ``deleted`` their numbers from 0."""
    gone = (copied(df, id_column=id_column, text_column=text_column, min_words=min_words)
            .groupBy("id", "check").agg(F.sort_array(F.collect_set("pos")).alias("gone")))
    rows = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"),
                     F.xxhash64(text_column).alias("check"))
    joined = rows.alias("l").join(gone.alias("r"), _same("l", "r", ["id", "check"]), "left")
    lines = split_lines(F.col("text"))
    numbers = F.sequence(F.lit(0), F.size("lines") - 1)
    # Numbers of the lines with words, of which those at the places in ``gone`` go.
    wordy = F.filter(numbers, lambda i: _wordy(F.get(F.col("lines"), i)))
    deleted = F.transform("gone", lambda p: F.get(F.col("wordy"), p))
    kept = F.transform(F.array_except(numbers, F.col("deleted")), lambda i: F.get(F.col("lines"), i))
    return (joined.select("l.id", "l.text", "r.gone").withColumn("lines", lines)
            .withColumn("wordy", F.when(F.col("gone").isNotNull(), wordy))
            .withColumn("deleted", F.coalesce(deleted, F.array().cast("array<int>")))
            .select("id", F.when(F.size("deleted") > 0, F.array_join(kept, "\n"))
                    .otherwise(F.col("text")).alias("text"),
                    F.coalesce(F.size("lines"), F.lit(0)).alias("n_lines"), "deleted"))

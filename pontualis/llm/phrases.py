"""Collocations by SETM: frequent phrases from persisted, sorted occurrence relations.

**Relations.**  The relation of length k holds, for every document, the sorted positions at
which a frequent phrase of k words occurs and the phrase's number.  A position counts the
words and the borders of pieces before it, so positions one apart lie in one piece.  A row of
the relation is a document; its positions are sorted, so the merge-join of piece and adjacent
position (a phrase at p and one at p + 1 make one of k + 1 words) is one pass over each row.
Joined pairs are grouped and counted, within a task first.  The groups that are frequent are
numbered, the relation is semi-joined with them, written, and read for the next length.  A
phrase of k + 1 words is frequent only if both of its parts are, so nothing is lost.

**Semi-join.**  Up to ``broadcast_rows`` frequent groups (8 bytes each) are sent to the tasks;
beyond, occurrences are joined with them by Spark and gathered by document again.  Both give
the same relation.

**Scores.**  Phrase counts are joined by text with the counts of each cut's two parts.  Products
are DECIMAL(38,0), the quotient is an integer division; nothing is rounded.

Words are told apart by 64-bit hashes and groups of words by the numbers of their parts, which
is exact.  Should two words of a corpus share a hash, ``HashClash`` is raised (for 10 million
different words, about once in 400,000 corpora).  More than 2^31 frequent phrases of one length
are refused.  A document's positions are one value of its row.

Defined cases: a null text is empty, a null language ``und``; empty texts, pieces without words
and words of any length are as defined; repeated rows and rows without identifier are documents
as any other.  Extra columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pontualis.llm.tables import small_batches
from pontualis.llm.words import LOWER, find_words, flat, mix, pieces
from pontualis.sources.scratch import materialize

_BYTE = np.arange(256)
BORDER = np.isin(_BYTE, np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8))
INSIDE = ~(BORDER | (_BYTE == 0x20) | (_BYTE == 0x09))
_EXACT = "decimal(38,0)"
_RELATION = "doc long, at array<int>, phrase array<int>"
_BYTES = 1 << 18  # bytes of texts whose words are found at once
_AT_ONCE = 1 << 18  # positions of a relation that are handled at once in a task
_COUNTED = 1 << 20  # pairs, and twice the words, that a task counts before it hands them on
_HANDED_ON = 1 << 16  # counts that go back to Spark at once


class HashClash(RuntimeError):
    """Two words of the corpus have the same hash."""


def _tokens(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(from, to, document, position, key, start, length, bytes) of the words of parts of a batch
    with columns ``text`` and ``tongue``; ``start`` counts in ``bytes``."""
    data, offsets = flat(batch.column("text"))
    tongue = batch.column("tongue").to_numpy().view(np.uint64)
    for low, high in pieces(offsets, _BYTES):
        part = data[offsets[low]:offsets[high]]
        edges = offsets[low:high + 1] - offsets[low]
        found = find_words(part, edges, INSIDE)
        borders = np.cumsum(np.append(0, BORDER[part]))
        words = np.bincount(found.doc, minlength=high - low)
        first = np.cumsum(words) - words
        at = (np.arange(len(found.doc)) - first[found.doc]
              + borders[found.start] - borders[edges[found.doc]])
        yield low, high, found.doc, at, mix(found.hash ^ tongue[low:high][found.doc]), found, part


def _vocabulary(docs: DataFrame) -> DataFrame:
    """``key, lang, word, n``: all words of each language with their counts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            waiting, words = [], 0
            lang = batch.column("lang")

            def flush():
                key = np.concatenate([w[0] for w in waiting])
                doc, start, length = (np.concatenate([w[i] for w in waiting]) for i in (1, 2, 3))
                text = b"".join(w[4] for w in waiting)
                each, where, n = np.unique(key, return_index=True, return_counts=True)
                spans = zip(start[where].tolist(), length[where].tolist(), strict=True)
                spelled = pa.array([text[s:s + size] for s, size in spans], pa.binary())
                return pa.RecordBatch.from_arrays(
                    [pa.array(each.view(np.int64)), lang.take(pa.array(doc[where])),
                     spelled.cast(pa.string()), pa.array(n)], ["key", "lang", "word", "n"])

            base = 0
            for low, _, doc, _, key, found, part in _tokens(batch):
                waiting.append((key, (doc + low).astype(np.int32), found.start + base,
                                found.length.astype(np.int32), LOWER[part].tobytes()))
                base += len(part)
                words += len(key)
                if words >= _COUNTED // 2:
                    yield flush()
                    waiting, words, base = [], 0, 0
            if words:
                yield flush()

    counted = docs.select("text", "lang", "tongue").mapInArrow(
        count, "key long, lang string, word string, n long")
    return counted.groupBy("key", "lang", "word").agg(F.sum("n").alias("n"))


def numbered(groups: DataFrame, name: str, partitions: int) -> DataFrame:
    """``groups`` with ``id``, the place of each row by its unique ``key``, from 0."""
    ordered = (groups.repartitionByRange(partitions, "key").sortWithinPartitions("key")
               .withColumn("_row", F.monotonically_increasing_id()))
    ordered = materialize(ordered, f"{name}_ordered")
    split = F.shiftright("_row", 33)
    sizes = ordered.groupBy(split.alias("_split")).agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(W.orderBy("_split").rowsBetween(W.unboundedPreceding, -1))
    # One row for each of the partitions.
    starts = sizes.select("_split", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_row").bitwiseAND((1 << 33) - 1)
    out = ordered.join(F.broadcast(starts), split == F.col("_split"))
    return materialize(out.select(place.alias("id"), *groups.columns), name)


def _lists(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the row of each."""
    sizes = np.diff(array.offsets.to_numpy())
    return array.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(array)), sizes)


def _adjacent(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The merge-join of a relation's rows with themselves: row, position and pair of numbers."""
    at, row = _lists(batch.column("at"))
    phrase, _ = _lists(batch.column("phrase"))
    near = np.flatnonzero((at[1:] - at[:-1] == 1) & (row[1:] == row[:-1]))
    return row[near], at[near], (phrase[near].astype(np.int64) << 32) | phrase[near + 1]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a relation's batch with about ``_AT_ONCE`` positions each, or of one row."""
    edges = batch.column("at").offsets.to_numpy()
    low = 0
    while low < len(batch):
        high = int(np.searchsorted(edges, edges[low] + _AT_ONCE, "right")) - 1
        high = min(len(batch), max(high, low + 1))
        yield batch.slice(low, high - low)
        low = high


def _rows(row: np.ndarray, n: int, at: np.ndarray, phrase: np.ndarray, doc: pa.Array) -> pa.RecordBatch:
    """A batch of a relation from its flat occurrences, sorted by row."""
    edges = pa.array(np.append(0, np.cumsum(np.bincount(row, minlength=n))), pa.int32())
    lists = [pa.ListArray.from_arrays(edges, pa.array(x.astype(np.int32))) for x in (at, phrase)]
    out = pa.RecordBatch.from_arrays([doc, *lists], ["doc", "at", "phrase"])
    return out.filter(pa.array(np.diff(edges.to_numpy()) > 0))


def _semi_join(source: DataFrame, occurrences, groups: DataFrame, limit: int) -> DataFrame:
    """The relation of the occurrences in ``source`` whose key is one of the ``groups``.

    ``occurrences`` gives (batch, row, position, key) of batches of ``source``.
    """
    if groups.count() <= limit:
        keys = groups.select("id", "key").toArrow().sort_by("id").column("key").to_numpy()
        shared = source.sparkSession.sparkContext.broadcast(keys)

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = shared.value
            for batch in batches:
                for doc, row, at, key in occurrences(batch):
                    place = np.minimum(np.searchsorted(known, key), max(0, len(known) - 1))
                    hit = np.flatnonzero(known[place] == key) if len(known) else place[:0]
                    yield _rows(row[hit], len(doc), at[hit], place[hit], doc)

        return source.mapInArrow(keep, _RELATION)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, row, at, key in occurrences(batch):
                yield pa.RecordBatch.from_arrays(
                    [doc.take(pa.array(row)), pa.array(at.astype(np.int32)), pa.array(key)],
                    ["doc", "at", "key"])

    found = source.mapInArrow(spread, "doc long, at int, key long").join(groups.select("key", "id"), "key")
    place = F.struct("at", F.col("id").cast("int").alias("phrase"))
    rows = found.groupBy("doc").agg(F.array_sort(F.collect_list(place)).alias("places"))
    return rows.select("doc", "places.at", "places.phrase")


def _word_occurrences(batch: pa.RecordBatch) -> Iterator[tuple]:
    for low, high, doc, at, key, _, _ in _tokens(batch):
        yield batch.column("doc").slice(low, high - low), doc, at, key.view(np.int64)


def _pair_occurrences(batch: pa.RecordBatch) -> Iterator[tuple]:
    for part in _slices(batch):
        yield part.column("doc"), *_adjacent(part)


def _pairs(relation: DataFrame) -> DataFrame:
    """``key, n``: how often each two phrases are adjacent; counted in each part of a task first."""
    def counts(waiting: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """Those of ``waiting``, which is empty then."""
        every = np.concatenate(waiting)
        waiting.clear()
        key, n = np.unique(every, return_counts=True)
        counted = pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "n"])
        for low in range(0, len(counted), _HANDED_ON):
            yield counted.slice(low, _HANDED_ON)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, pairs = [], 0
        for batch in batches:
            for part in _slices(batch):
                waiting.append(_adjacent(part)[2])
                pairs += len(waiting[-1])
                if pairs >= _COUNTED:
                    yield from counts(waiting)
                    pairs = 0
        if pairs:
            yield from counts(waiting)

    counted = relation.mapInArrow(count, "key long, n long")
    return counted.groupBy("key").agg(F.sum("n").alias("n"))


def frequent_phrases(df: DataFrame, *, text_column: str = "text", lang_column: str = "lang",
                     longest: int = 5, min_count: int = 100,
                     broadcast_rows: int = 1 << 22) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, words, n`` of all phrases of up to ``longest`` words with ``min_count``
    occurrences in a language, single words included; and ``lang, total``, all word occurrences."""
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lang = F.coalesce(F.col(lang_column).cast("string"), F.lit("und"))
    docs = df.select(F.col(text_column).alias("text"), lang.alias("lang"), F.xxhash64(lang).alias("tongue"))
    with small_batches(spark):
        words = materialize(_vocabulary(docs), "vocabulary")
    if not words.groupBy("key").count().filter("count > 1").isEmpty():
        raise HashClash("two words have the same hash")
    totals = materialize(words.groupBy("lang").agg(F.sum("n").alias("total")), "totals")

    level = numbered(words.filter(F.col("n") >= min_count)
                     .select("key", "lang", F.col("word").alias("phrase"), "n"), "words", partitions)
    numbers = docs.select("text", "tongue", F.monotonically_increasing_id().alias("doc"))
    with small_batches(spark):
        relation = materialize(_semi_join(numbers, _word_occurrences, level, broadcast_rows), "occurrences")
    found = [level.select("lang", "phrase", F.lit(1).alias("words"), "n")]
    for k in range(2, longest + 1):
        with small_batches(spark):
            groups = numbered(_pairs(relation).filter(F.col("n") >= min_count), f"groups_{k}", partitions)
            if k < longest:
                relation = materialize(_semi_join(relation, _pair_occurrences, groups, broadcast_rows),
                                       "occurrences")
        left = level.select(F.col("id").alias("a"), "lang", F.col("phrase").alias("begin"))
        right = level.select(F.col("id").alias("b"),
                             F.substring_index("phrase", " ", -1).alias("end"))
        spelled = (groups.withColumn("a", F.shiftright("key", 32))
                   .withColumn("b", F.col("key").bitwiseAND((1 << 32) - 1))
                   .join(left, "a").join(right, "b")
                   .select("id", "lang", F.concat_ws(" ", "begin", "end").alias("phrase"), "n"))
        level = materialize(spelled, f"phrases_{k}")
        found.append(level.select("lang", "phrase", F.lit(k).alias("words"), "n"))
    return reduce(DataFrame.unionAll, found), totals


def cut_score(a: Column, total: Column, left: Column, right: Column) -> Column:
    """``floor(1000 * a * total / (left * right))`` exactly, for counts below 10^17."""
    def exact(c: Column) -> Column:
        return c.cast("decimal(17,0)")

    above = (exact(a) * exact(total) * F.lit(1000).cast("decimal(4,0)")).cast(_EXACT)
    below = (exact(left) * exact(right)).cast(_EXACT)
    return F.call_function("div", above, below)


def collocations(df: DataFrame, *, share: int = 100, best: int = 2000, **parameters) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``best`` phrases of each language by the least
    score over all cuts, without those of which a longer phrase holds ``share`` percent."""
    phrases, totals = frequent_phrases(df, **parameters)
    phrases = materialize(phrases, "phrases")
    several = phrases.filter("words > 1")
    # Every shorter part of a phrase, of two words or more.
    cut = F.split("phrase", " ")
    inner = F.expr("flatten(transform(sequence(2, words - 1), size -> "
                   "transform(sequence(1, words - size + 1), i -> "
                   "array_join(slice(_w, i, size), ' '))))")
    within = (several.filter("words > 2").withColumn("_w", cut)
              .select("lang", F.explode(inner).alias("phrase"), F.col("n").alias("longer"))
              .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    kept = (several.join(within, ["lang", "phrase"], "left")
            .filter(F.coalesce(100 * F.col("longer") < share * F.col("n"), F.lit(True)))
            .drop("longer"))
    cuts = kept.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumns({
        "left": F.call_function("substring_index", "phrase", F.lit(" "), F.col("cut")),
        "right": F.call_function("substring_index", "phrase", F.lit(" "), F.col("cut") - F.col("words"))})
    sides = [phrases.select("lang", F.col("phrase").alias(side), F.col("n").alias(side[0]))
             for side in ("left", "right")]
    scored = (cuts.join(sides[0], ["lang", "left"]).join(sides[1], ["lang", "right"])
              .join(totals, "lang")
              .withColumn("score", cut_score(F.col("n"), F.col("total"), F.col("l"), F.col("r"))))
    least = scored.groupBy("lang", "phrase", F.col("n").alias("a"), "total").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("least"))
    rows = least.select("lang", "phrase", "a", "least.l", "least.r", F.col("total").alias("n"),
                        "least.score")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    dealt = W.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    rows = rows.withColumn("rank", F.row_number().over(dealt)).filter(F.col("rank") <= best)
    rows = rows.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long"))
    return rows.filter(F.col("rank") <= best)

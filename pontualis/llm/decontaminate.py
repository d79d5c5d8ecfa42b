"""Benchmark decontamination with a distributed positional inverted index.

The benchmark's items are cut into windows of ``size`` words (a shorter item is one window).
How often each of their words occurs is counted over the whole corpus; a window's words are
then looked up from the rarest on.

``index`` stores postings.  Every document keeps the sorted positions of each benchmark word,
but only if two lists already meet in it: those of the two rarest words of some window, the
second within ``slop`` positions of its place.  ``search`` intersects the lists of all words
of a window, each moved by the word's offset, rarest first.  What is left are the exact
phrases; a window whose words all lie within ``slop`` positions of their places is a
proximity match.  The index is partitioned by document, so nothing is shuffled, and a
passage that very many documents share is just found in each of them.

The benchmark is the query set.  It is taken in blocks of at most about ``block_words`` words,
and only a block is sent to the executors.

Defined cases: a null or wordless text has no words and no hits, a wordless item no window;
items with equal identifiers are one item; an item without identifier makes hits but is not
listed; repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pontualis.llm.tables import fresh, small_batches
from pontualis.llm.words import ALPHANUMERIC, find_words, flat, pieces
from pontualis.sources.scratch import materialize

_COUNTED = 1 << 18  # bytes of texts whose words are counted at once
_INDEXED = 1 << 19  # bytes of texts that are indexed at once
POSTINGS = "n_words long, terms array<int>, positions array<int>"
MATCHES = ("n_words long, n_hit long, items array<string>, near array<string>, "
           "spans array<struct<start:int,end:int>>")


def _expand(counts: np.ndarray) -> np.ndarray:
    """0 … n-1 for each n of ``counts``."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


@dataclass
class Queries:
    """A block of windows, their words as numbers of ``terms``."""

    items: list[str | None]
    terms: np.ndarray  # sorted hashes
    words: np.ndarray  # (window, place): term, rarest first, -1 beyond the window's length
    offsets: np.ndarray  # (window, place): the word's offset in the window
    lengths: np.ndarray
    owners: list[np.ndarray]  # items of each window
    by_anchor: np.ndarray  # windows in order of their rarest word
    anchor_start: np.ndarray  # where a term's windows begin in ``by_anchor``
    pairs: np.ndarray  # distinct (rarest, second rarest or -1, distance)

    def number(self, h: np.ndarray) -> np.ndarray:
        if not len(self.terms):
            return np.full(len(h), -1, np.int32)
        at = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        return np.where(self.terms[at] == h, at, -1).astype(np.int32)


def _windows(items: list, texts: pa.Array, size: int) -> dict[tuple, list[int]]:
    data, offsets = flat(texts)
    found = find_words(data, offsets, ALPHANUMERIC)
    out: dict[tuple, list[int]] = {}
    number: dict = {}
    ends = np.cumsum(np.bincount(found.doc, minlength=len(items)))
    own_words = np.split(found.hash, ends[:-1]) if items else []
    for item, hashes in zip(items, own_words, strict=True):
        own = tuple(hashes.tolist())
        n = number.setdefault(item, len(number))
        for i in range(max(1, len(own) - size + 1) if own else 0):
            owners = out.setdefault(own[i:i + size], [])
            if n not in owners:
                owners.append(n)
    return out


def build_queries(items: list, texts: pa.Array, size: int, frequency) -> Queries:
    """``frequency``: sorted term hashes -> how often each occurs in the corpus."""
    windows = _windows(items, texts, size)
    terms = np.array(sorted({h for w in windows for h in w}), np.uint64)
    often = frequency(terms)
    place = {h: i for i, h in enumerate(terms.tolist())}
    words = np.full((len(windows), size), -1, np.int32)
    offsets = np.zeros((len(windows), size), np.int32)
    lengths = np.zeros(len(windows), np.int32)
    pairs = set()
    for w, window in enumerate(windows):
        ids = [place[h] for h in window]
        order = sorted(range(len(ids)), key=lambda i: (often[ids[i]], ids[i], i))
        words[w, :len(ids)] = [ids[i] for i in order]
        offsets[w, :len(ids)] = order
        lengths[w] = len(ids)
        second = next((i for i in order[1:] if ids[i] != ids[order[0]]), None)
        pairs.add((ids[order[0]], -1, 0) if second is None
                  else (ids[order[0]], ids[second], second - order[0]))
    anchors = words[:, 0] if len(windows) else np.empty(0, np.int32)
    by_anchor = np.argsort(anchors, kind="stable")
    start = np.searchsorted(anchors[by_anchor], np.arange(len(terms) + 1))
    return Queries(list(dict.fromkeys(items)), terms, words, offsets, lengths,
                   [np.array(x) for x in windows.values()], by_anchor, start,
                   np.array(sorted(pairs), np.int64).reshape(-1, 3))


def _frequencies(docs: DataFrame, text_column: str, terms: np.ndarray) -> np.ndarray:
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def count(batches):
        known = shared.value
        total = np.zeros(len(known), np.int64)
        for batch in batches:
            data, offsets = flat(batch.column(0))
            for low, high in pieces(offsets, _COUNTED):
                found = find_words(data[offsets[low]:offsets[high]],
                                   offsets[low:high + 1] - offsets[low], ALPHANUMERIC)
                at = np.minimum(np.searchsorted(known, found.hash), len(known) - 1)
                total += np.bincount(at[known[at] == found.hash], minlength=len(known))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])],
                                         ["term", "n"])

    out = np.zeros(len(terms), np.int64)
    if len(terms):
        with small_batches(docs.sparkSession):
            got = (docs.select(text_column).mapInArrow(count, "term long, n long")
                   .groupBy("term").agg(F.sum("n").alias("n")).toPandas())
        out[got["term"]] = got["n"]
    return out


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)])
    flat_values = np.concatenate(values) if values else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat_values, kind))


def index_batch(queries: Queries, texts: pa.Array, slop: int) -> pa.Array:
    data, offsets = flat(texts)
    n_words, terms, positions = [], [], []
    for low, high in pieces(offsets, _INDEXED):
        n = high - low
        found = find_words(data[offsets[low]:offsets[high]],
                           offsets[low:high + 1] - offsets[low], ALPHANUMERIC)
        counts = np.bincount(found.doc, minlength=n)
        first = np.cumsum(counts) - counts
        term = queries.number(found.hash)
        where = np.flatnonzero(term >= 0)
        # Sorted by term, then place; documents are set apart by more than any distance.
        where = where[np.argsort(term[where], kind="stable")]
        apart = where + found.doc[where] * np.int64(1 << 32)
        begin = np.searchsorted(term[where], np.arange(len(queries.terms) + 1))
        have = np.diff(begin) > 0
        wanted = np.zeros(n, bool)
        for a, b, distance in queries.pairs[have[queries.pairs[:, 0]]].tolist():
            own = slice(begin[a], begin[a + 1])
            if b < 0:
                wanted[found.doc[where[own]]] = True
            elif have[b]:
                other = apart[begin[b]:begin[b + 1]]
                place = apart[own] + distance
                near = np.searchsorted(other, place - slop)
                hit = (near < len(other)) & (other[np.minimum(near, len(other) - 1)]
                                             <= place + slop)
                wanted[found.doc[where[own]][hit]] = True
        where = where[wanted[found.doc[where]]]
        where = where[np.argsort(found.doc[where], kind="stable")]
        own = np.split(where, np.cumsum(np.bincount(found.doc[where], minlength=n))[:-1])
        n_words.append(counts)
        terms += [term[x] for x in own]
        positions += [(x - first[k]).astype(np.int32) for k, x in enumerate(own)]
    counts = np.concatenate(n_words) if n_words else np.empty(0, np.int64)
    return pa.StructArray.from_arrays(
        [pa.array(counts, pa.int64()), _lists(terms, pa.int32()), _lists(positions, pa.int32())],
        ["n_words", "terms", "positions"])


def search_document(queries: Queries, terms: np.ndarray, positions: np.ndarray, slop: int):
    """(window, start) of exact phrases, and the windows of proximity matches.

    ``terms`` are sorted, and ``positions`` within a term.
    """
    anchored = queries.anchor_start[terms + 1] - queries.anchor_start[terms]
    window = queries.by_anchor[np.repeat(queries.anchor_start[terms], anchored)
                               + _expand(anchored)]
    start = np.repeat(positions, anchored) - queries.offsets[window, 0]
    key = terms.astype(np.int64) << 32 | positions
    near_window, near_start = window, start
    for place in range(1, queries.words.shape[1]):
        for near in (False, True) if slop else (False,):
            w, s = (near_window, near_start) if near else (window, start)
            term = queries.words[w, place].astype(np.int64)
            reach = slop if near else 0
            expected = s + queries.offsets[w, place]
            lowest = term << 32 | np.maximum(expected - reach, 0)
            at = np.searchsorted(key, lowest)
            met = np.zeros(len(w), bool)
            inside = at < len(key)
            met[inside] = key[at[inside]] <= (term[inside] << 32 | np.maximum(
                expected[inside] + reach, 0))
            met &= expected + reach >= 0
            met |= term < 0
            if near:
                near_window, near_start = w[met], s[met]
            else:
                window, start = w[met], s[met]
    exact = start >= 0
    return window[exact], start[exact], np.unique(near_window)


def search_batch(queries: Queries, postings: pa.StructArray, slop: int) -> pa.Array:
    n_words = postings.field(0)
    terms, positions = postings.field(1), postings.field(2)
    offsets = terms.offsets.to_numpy()
    all_terms, all_positions = terms.values.to_numpy(), positions.values.to_numpy()
    shift = positions.offsets.to_numpy()
    hits, items, nears, spans = [], [], [], []
    for k in range(len(postings)):
        own = slice(offsets[k], offsets[k + 1])
        if own.start == own.stop:
            hits.append(0)
            items.append([])
            nears.append([])
            spans.append([])
            continue
        window, start, near = search_document(
            queries, all_terms[own], all_positions[shift[k]:shift[k + 1]], slop)
        length = queries.lengths[window]
        covered = np.unique(np.repeat(start, length) + _expand(length))
        hits.append(len(covered))
        names = {i for w in np.unique(window).tolist() for i in queries.owners[w].tolist()}
        items.append(sorted(queries.items[i] for i in names if queries.items[i] is not None))
        names = {i for w in near.tolist() for i in queries.owners[w].tolist()}
        nears.append(sorted(queries.items[i] for i in names if queries.items[i] is not None))
        cut = np.flatnonzero(np.diff(covered) > 1)
        begin = covered[np.concatenate([[0], cut + 1])] if len(covered) else covered
        end = covered[np.concatenate([cut, [len(covered) - 1]])] + 1 if len(covered) else covered
        spans.append([{"start": int(a), "end": int(b)} for a, b in zip(begin, end, strict=True)])
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return pa.StructArray.from_arrays(
        [n_words, pa.array(hits, pa.int64()), pa.array(items, pa.list_(pa.string())),
         pa.array(nears, pa.list_(pa.string())), pa.array(spans, span)],
        ["n_words", "n_hit", "items", "near", "spans"])


def _whole(array):
    return array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array


def functions(spark, queries: Queries, slop: int):
    """Column functions: text -> postings, and postings -> matches."""
    shared = spark.sparkContext.broadcast(queries)

    @F.arrow_udf(POSTINGS)
    def index(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in texts:
            yield index_batch(shared.value, _whole(array), slop)

    @F.arrow_udf(MATCHES)
    def search(postings: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in postings:
            yield search_batch(shared.value, _whole(array), slop)

    return index, search


def blocks(docs: DataFrame, benchmark: DataFrame, *, text_column: str = "text",
           item_column: str = "item_id", item_text: str = "text", size: int = 13,
           block_words: int = 1_000_000) -> Iterator[Queries]:
    """The benchmark's windows, with word frequencies over all of ``docs``, block by block."""
    items = benchmark.select(F.col(item_column).cast("string").alias("item"),
                             F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    words = items.agg(F.sum(F.regexp_count("text", F.lit(r"\S+")))).first()[0] or 0
    n = -(-words // block_words) or 1
    for k in range(n):
        block = items.filter(F.pmod(F.xxhash64("item"), F.lit(n)) == k)
        got = block.orderBy("item", "text").toArrow()
        yield build_queries(got.column(0).to_pylist(), got.column(1), size,
                            lambda terms: _frequencies(docs, text_column, terms))


def matches(docs: DataFrame, benchmark: DataFrame, *, id_column: str = "doc_id",
            text_column: str = "text", slop: int = 3, **parameters) -> DataFrame:
    """One row per document: ``id, n_words, n_hit, items, near, spans``.

    ``items`` holds the identifiers with exact phrases, ``near`` those with proximity matches,
    ``spans`` the words hit, as half-open intervals of word positions.
    """
    spark = docs.sparkSession
    found = []
    for queries in blocks(docs, benchmark, text_column=text_column, **parameters):
        index, search = functions(spark, queries, slop)
        with small_batches(spark):
            stored = materialize(docs.select(
                F.col(id_column).alias("id"), F.xxhash64(text_column).alias("check"),
                index(F.col(text_column)).alias("postings")), "postings")
        found.append(stored.withColumn("match", search("postings"))
                     .select("id", "check", "match.*"))
    if len(found) == 1:
        return found[0].drop("check")
    return _merged(found)


def _merged(found: list[DataFrame]) -> DataFrame:
    """Results of several blocks; equal rows have equal results, and stay as many."""
    union = found[0]
    for more in found[1:]:
        union = union.unionAll(more)
    positions = F.flatten(F.transform("spans", lambda s: F.sequence(s.start, s.end - 1)))
    rows = union.withColumn("hit", positions)
    grouped = rows.groupBy("id", "check", "n_words").agg(
        (F.count(F.lit(1)) / len(found)).cast("int").alias("copies"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("near")))).alias("near"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("hit")))).alias("hit"))
    starts = F.filter("hit", lambda x: ~F.array_contains(F.col("hit"), x - 1))
    ends = F.filter("hit", lambda x: ~F.array_contains(F.col("hit"), x + 1))
    spans = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda z: F.struct(
        z["a"].alias("start"), (z["b"] + 1).cast("int").alias("end")))
    return (grouped.withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.col("copies"))))
            .select("id", "n_words", F.size("hit").cast("long").alias("n_hit"), "items", "near",
                    spans.alias("spans")))


def contaminated(n_hit: Column, n_words: Column, share: int = 20) -> Column:
    """Whether at least one word in ``share`` is hit."""
    return (n_hit > 0) & (share * n_hit >= n_words)


def clean(docs: DataFrame, benchmark: DataFrame, *, text_column: str = "text", share: int = 20,
          **parameters) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns unchanged.

    Blocks are taken one after another, and the words each hits are carried in one column.
    """
    hit, words = (fresh(docs.columns, c) for c in ("_hit", "_words"))
    out = docs.withColumn(hit, F.array().cast("array<int>"))
    for queries in blocks(docs, benchmark, text_column=text_column, **parameters):
        index, search = functions(docs.sparkSession, queries, 0)
        match = fresh(out.columns, "_match")
        out = out.withColumn(match, search(index(F.col(text_column))))
        now = F.flatten(F.transform(f"{match}.spans", lambda s: F.sequence(s.start, s.end - 1)))
        out = out.withColumns({hit: F.array_union(hit, now), words: F.col(f"{match}.n_words")})
        out = out.drop(match)
    verdict = contaminated(F.size(hit).cast("long"), F.col(words), share)
    return out.filter(~verdict).select(*docs.columns)

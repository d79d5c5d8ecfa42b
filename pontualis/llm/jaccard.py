"""Exact Jaccard join of documents' word shingles, as a join in a metric space.

The distance of two documents is one minus the Jaccard index of their shingle sets; those
within ``1 - share`` are linked.

**Regions.**  Unrelated texts are all at distance 1, so documents chosen as pivots would
not tell them apart.  The first pivots are therefore the single shingles: a document is at
distance ``1 - 1/n`` from each of its own and 1 from all others, and belongs to the Voronoi
region of the one that comes first in an order that all documents share (rare shingles first).
**Windows.**  If a partner had none of a document's first k shingles, what they share
would lie in the other ``n - k``, so the distance would be at least ``k/n``.  Within the
threshold it thus has one of the first ``floor((1 - share) * n) + 1``; the document is
replicated to the regions of these pivots and no others, and every link lies in a region.

**Inside a region** documents are pivots.  Distances to the first one are bounded, and where
the bound allows a link computed; what lies within the threshold is linked to it.  Regions
with the same first pivot are now one, the region of that document.  Only those that still
hold several components go on, recursively: more pivots are taken, from all components in
turn, those first that are nearest to the pivots so far on average and so link most, and
meet the members of other components, unless their distances to the first pivot differ by more than the threshold
(triangle inequality).  A pivot that has met its region is done with; the number of pivots
grows sixteenfold from round to round, so small regions end at once.  No region's pairs are
all emitted: members of one component are not compared again.

**Bounds.**  A pair must fit by size, and what follows its common pivot must suffice for a
link (the first pivot that two linked documents share always passes).  Its sketches must
too: a set's sketch keeps the parity of the number of its shingles per hash value, in two to
four bits for each shingle.  Sketches differ in no more bits than the sets differ in
shingles, so the distance is at least ``2h / (n + m + h)`` for h such bits.  Only texts of
pairs that pass are read, and their distances are exact.  Texts and sketches are dealt to buckets
by identifier once; after that only pairs, with what they compare, move.  New links unite
components of the round before, so older links are not followed again.

The order only decides how large regions are, never what is found.  It counts shingles
that recur within a few million of a task's, over all documents; the most frequent (at most ``frequent``,
as many powers of two of their count as fit) come last, and their regions are dealt over
several keys for the first pivot.

Defined cases: null or wordless texts have no shingles and are linked with nothing; of fewer
words than ``k`` the whole sequence is one shingle; rows with equal identifiers are one
document with several texts, linked by any of them; rows without identifier are linked with
nothing and have no component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from pontualis.llm.components import components
from pontualis.llm.tables import fresh, small_batches
from pontualis.llm.words import NOT_SPACE, find_words, flat, mix, pieces, shingles
from pontualis.sources.scratch import fresh_path, materialize, release

_BYTES = 1 << 18  # bytes of texts whose shingles are found at once
_COUNTED = 1 << 22  # shingles among which those that recur are looked for
_RECURS = 3  # times among these from which a shingle is counted
_KNOWN = 10_000  # sets that a task knows again
_REGION = 4096  # documents of a frequent shingle's region that share a key at first
_PAIRS = 512  # pairs of texts that a task compares at once
_PIVOTS = 32  # documents that are pivots of a region in the first round
_MORE_PIVOTS = 16  # times as many in each round


def shingle_sets(texts: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from, to, owners, hashes) of parts of a column: distinct shingles, sorted by owner
    and hash; owners count from the part's start."""
    data, offsets = flat(texts)
    for low, high in pieces(offsets, _BYTES):
        found = find_words(data[offsets[low]:offsets[high]],
                           offsets[low:high + 1] - offsets[low], NOT_SPACE)
        owner, h = shingles(found, high - low, k)
        order = np.lexsort((h, owner))
        owner, h = owner[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        yield low, high, owner[new], h[new]


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def sketches(n: np.ndarray, owner: np.ndarray, h: np.ndarray) -> pa.Array:
    """Parity sketches of sets of ``n`` hashes each, as lists of 64-bit words."""
    bits = np.maximum(64, 1 << np.ceil(np.log2(np.maximum(2 * n, 1))).astype(np.int64))
    base = np.concatenate([[0], np.cumsum(bits)])
    value = mix(h ^ np.uint64(0x2545F4914F6CDD1D)).view(np.int64) & (bits[owner] - 1)
    odd = np.bincount(base[:-1][owner] + value, minlength=base[-1]) & 1
    words = np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)
    return pa.ListArray.from_arrays(pa.array(base // 64, pa.int32()), pa.array(words))


def differing_bits(a: Column, b: Column) -> Column:
    """Bits in which two sketches differ, the longer one folded to the shorter's length."""
    def fold(long: Column, size: Column) -> Column:
        half = F.zip_with(F.slice(long, F.lit(1), size), F.slice(long, size + 1, size),
                          lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(long) > size, half).otherwise(long)

    size = F.least(F.size(a), F.size(b))
    bits = F.zip_with(fold(a, size), fold(b, size), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda total, x: total + x)


def repeated(every: np.ndarray, times: int) -> tuple[np.ndarray, np.ndarray]:
    """The values that a sorted array holds ``times`` or more often, and how often."""
    first = every[times - 1:] == every[:max(0, len(every) - times + 1)]
    first[1:] &= every[1:len(first)] != every[:max(0, len(first) - 1)]
    values = every[:len(first)][first]
    return values, np.searchsorted(every, values, "right") - np.searchsorted(every, values, "left")


def _scan(rows: DataFrame, k: int) -> DataFrame:
    """``id, n, d1, d2, sketch`` of every row, and rows ``shingle, df`` of shingles that recur."""
    schema = StructType([rows.schema["id"]]).add("n", "long").add("d1", "long").add("d2", "long")
    schema = schema.add("sketch", ArrayType(LongType())).add("shingle", "long").add("df", "long")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, waiting, kind = [], 0, None
        for batch in batches:
            sizes, firsts, seconds, marks = [], [], [], []
            kind = batch.column(0).type
            for low, high, owner, h in shingle_sets(batch.column(1), k):
                n = np.bincount(owner, minlength=high - low)
                edge = np.concatenate([[0], np.cumsum(n)])
                for values, out in ((mix(h), firsts), (mix(h ^ np.uint64(0x5851F42D4C957F2D)),
                                                       seconds)):
                    total = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
                    out.append(total[edge[1:]] - total[edge[:-1]])
                sizes.append(n)
                marks.append(sketches(n, owner, h))
                seen.append(h)
                waiting += len(h)
            if not sizes:
                continue
            none = pa.nulls(len(batch), pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(np.concatenate(sizes)), _signed(np.concatenate(firsts)),
                _signed(np.concatenate(seconds)), pa.concat_arrays(marks), none, none],
                names=schema.names)
            if waiting >= _COUNTED:
                yield from recurring(seen, kind)
                waiting = 0
        if waiting:
            yield from recurring(seen, kind)

    def recurring(seen: list[np.ndarray], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        """Those of ``seen`` that recur, and how often; ``seen`` is empty then."""
        # Sorted in place: of all shingles there is one copy, even if all of them recur.
        every = np.concatenate(seen)
        seen.clear()
        every.sort()
        values, counts = repeated(every, _RECURS)
        if more := len(values):
            gap = pa.nulls(more, pa.int64())
            yield pa.RecordBatch.from_arrays([
                pa.nulls(more, kind), gap, gap, gap, pa.nulls(more, pa.list_(pa.int64())),
                _signed(values), pa.array(counts)], names=schema.names)

    with small_batches(rows.sparkSession):
        return materialize(rows.mapInArrow(scan, schema), "shingle_scan")


def _frequent(scanned: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and counts of the most frequent shingles, at most ``most`` of them."""
    counts = materialize(scanned.filter(F.col("shingle").isNotNull()).groupBy("shingle")
                         .agg(F.sum("df").alias("df")), "frequencies")
    power = F.floor(F.log2("df") * 4).cast("int")
    levels = sorted(((r.power, r.n) for r in counts.groupBy(power.alias("power"))
                     .agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    total, least = 0, None
    for level, n in levels:
        total += n
        if total > most:
            break
        least = level
    if least is None:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    got = counts.filter(power >= least).toArrow()
    h, n = (got.column(c).to_numpy() for c in ("shingle", "df"))
    order = np.argsort(h.view(np.uint64))
    return h.view(np.uint64)[order], n[order]


def _postings(rows: DataFrame, k: int, share: int, hashes, counts) -> DataFrame:
    """``region, part, id, place``: the regions each document is replicated to; ``place`` is
    its number of shingles, times 2^32, plus the region's place in its order."""
    shared = rows.sparkSession.sparkContext.broadcast((hashes, counts))
    schema = (StructType().add("region", "long").add("part", "integer")
              .add(StructField("id", rows.schema["id"].dataType)).add("place", "long"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, often = shared.value
        done = set()
        for batch in batches:
            if len(done) >= _KNOWN:
                done.clear()
            for low, high, owner, h in shingle_sets(batch.column(1), k):
                n = np.bincount(owner, minlength=high - low)
                edge = np.concatenate([[0], np.cumsum(n)])
                total = np.concatenate([[np.uint64(0)], np.cumsum(mix(h), dtype=np.uint64)])
                digest = total[edge[1:]] - total[edge[:-1]]
                df = np.zeros(len(h), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    df = np.where(known[at] == h, often[at], 0)
                order = np.lexsort((h, df, owner))
                window = (100 - share) * n // 100 + 1
                rank = np.arange(len(h)) - edge[:-1][owner]
                # Of equal sets known here, which are linked anyway, the first stands for all.
                ids = batch.column(0).slice(low, high - low)
                stands = np.zeros(high - low, bool)
                for i in np.flatnonzero(n * ids.is_valid().to_numpy(zero_copy_only=False)).tolist():
                    if (key := (int(digest[i]), int(n[i]))) not in done:
                        done.add(key)
                        stands[i] = True
                within = (rank < window[owner]) & stands[owner]
                chosen, rank = order[within], rank[within]
                if not len(chosen):
                    continue
                own = owner[chosen]
                # Part 0 is a whole region; those of several parts have them from 1 on.
                parts = df[chosen] // _REGION + 1
                part = (digest[own] % parts.astype(np.uint64)).astype(np.int32) + (parts > 1)
                yield pa.RecordBatch.from_arrays([
                    _signed(h[chosen]), pa.array(part.astype(np.int32)),
                    ids.take(pa.array(own)), pa.array(n[own] << 32 | rank)], schema.names)

    return rows.mapInArrow(place, schema)


def _may_link(a: Column, b: Column, share: int) -> Column:
    """Whether sizes, and the shingles from a common region on, allow a link of two places."""
    n, m = F.shiftright(a, 32), F.shiftright(b, 32)
    low = F.lit((1 << 32) - 1)
    most = F.least(n - a.bitwiseAND(low), m - b.bitwiseAND(low))
    return ((100 * F.least(n, m) >= share * F.greatest(n, m))
            & ((100 + share) * most >= share * (n + m)))


def _bounded(pairs: DataFrame, docs: DataFrame, share: int) -> DataFrame:
    """``a, b, low``: lower bounds of the distances, from sketches."""
    x = docs.select(F.col("id").alias("a"), F.col("n").alias("n"), F.col("sketch").alias("x"))
    y = docs.select(F.col("id").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("y"))
    h = differing_bits(F.col("x"), F.col("y"))
    return (pairs.join(x, "a").join(y, "b")
            .select("a", "b", (2 * h / (F.col("n") + F.col("m") + h)).alias("low")))


def _in_buckets(rows: DataFrame, what: str) -> DataFrame:
    """``rows`` as a table in buckets of ``id``, of which a join by it moves nothing."""
    spark = rows.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = fresh_path(spark, f"{what}_by_id")
    name = f"{what}_{hashlib.md5(path.encode()).hexdigest()}"
    (rows.filter(F.col("id").isNotNull()).repartition(buckets, "id").write.option("path", path)
     .bucketBy(buckets, "id").saveAsTable(name))
    table = spark.table(name)
    table._scratch_path, table._scratch_name = path, name
    return table


def _drop(*tables: DataFrame) -> None:
    """Frees tables of :func:`_in_buckets`."""
    for table in tables:
        table.sparkSession.sql(f"DROP TABLE {table._scratch_name}")
    release(*tables)


def _distances(pairs: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """``a, b, common, either``: sizes of the intersection and union of two documents' sets."""
    needed = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    # By hash, with the few identifiers on the build side: the texts are neither moved nor sorted.
    texts = materialize(rows.join(needed.hint("shuffle_hash"), "id", "left_semi"), "texts")
    x = texts.select(F.col("id").alias("a"), F.col("text").alias("x"))
    y = texts.select(F.col("id").alias("b"), F.col("text").alias("y"))
    joined = pairs.join(x.hint("merge"), "a").join(y.hint("merge"), "b").select("a", "b", "x", "y")
    schema = (StructType([joined.schema["a"], joined.schema["b"]])
              .add("common", "long").add("either", "long"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, len(whole), _PAIRS):
                yield common_of(whole.slice(low, _PAIRS))

    def common_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = len(batch)
        size, sets = [], []
        for column in (2, 3):
            own, every = np.zeros(n, np.int64), []
            for low, high, owner, h in shingle_sets(batch.column(column), k):
                own[low:high] = np.bincount(owner, minlength=high - low)
                every.append(h ^ mix((owner + low).astype(np.uint64)))
            size.append(own)
            sets.append((np.repeat(np.arange(n), own), np.concatenate(every)))
        owner, h = sets[1]
        h = np.sort(h)
        first, probe = sets[0]
        at = np.minimum(np.searchsorted(h, probe), max(0, len(h) - 1))
        hit = h[at] == probe if len(h) else np.zeros(len(probe), bool)
        common = np.bincount(first[hit], minlength=n)
        return pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), pa.array(common),
            pa.array(size[0] + size[1] - common)], names=schema.names)

    with small_batches(rows.sparkSession):
        measured = materialize(joined.mapInArrow(measure, schema), "distances")
    release(texts)
    return measured


def _several(rows: DataFrame) -> DataFrame:
    """The rows of regions that hold several components."""
    mixed = (rows.groupBy("region").agg(F.min("component").alias("one"), F.max("component").alias("other"),
                                        F.count(F.lit(1)).alias("members"))
             .filter("one <> other").select("region", "members"))
    return rows.join(mixed, "region")


def join(df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", k: int = 5,
         share: int = 75,
         frequent: int = 1 << 16) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents (``id, n``), links found (``a, b, common, either``) and ``id, component`` of
    their ends.

    The links span every component: two documents are connected by them exactly if they are
    by all pairs that share ``share`` percent of their shingles.
    """
    rows = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    texts = _in_buckets(rows, "texts")
    scanned = _scan(rows, k)
    docs = scanned.filter(F.col("shingle").isNull()).select("id", "n", "d1", "d2", "sketch")

    # Documents with equal sets, linked without a look at their texts.
    sets = _in_buckets(docs.filter("n > 0"), "sketches")
    least = materialize(sets.groupBy("n", "d1", "d2").agg(F.min("id").alias("b"))
                        .select(F.col("n").alias("m"), F.col("d1").alias("e1"),
                                F.col("d2").alias("e2"), "b"), "set_least")
    equal = (sets.join(least, (F.col("n") == F.col("m")) & (F.col("d1") == F.col("e1"))
                       & (F.col("d2") == F.col("e2")))
             .filter("id <> b").select(F.col("id").alias("a"), "b", F.col("n").alias("common"),
                                       F.col("n").alias("either")).distinct())
    links = materialize(equal, "links")

    by_region = W.partitionBy("region", "part").orderBy("id")
    alone = F.lag("id").over(by_region).isNull() & F.lead("id").over(by_region).isNull()
    placed = _postings(rows, k, share, *_frequent(scanned, frequent))
    with small_batches(df.sparkSession):
        members = materialize(
            placed.select("*", F.first("id").over(by_region).alias("pivot"),
                          F.first("place").over(by_region).alias("pivot_place"), alone.alias("alone"))
            .filter("part > 0 OR NOT alone").drop("alone"), "regions")

    meet = _may_link(F.col("place"), F.col("pivot_place"), share) & (F.col("id") != F.col("pivot"))
    pairs = members.filter(meet).select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct()
    pairs = pairs.join(links.select("a", "b"), ["a", "b"], "left_anti")
    first, new = _meet(pairs, sets, texts, k, share)
    links = links.unionAll(new)
    labels = _components(links)

    # From here on regions are those of their first pivots.  One of several parts is whole
    # again, under the least of its pivots, and all its members stay, for none has met all.
    whole = (members.filter("part > 0").groupBy("region").agg(F.min("pivot").alias("center")))
    parted = members.filter("part > 0").join(whole, "region").drop("region")
    single = members.filter((F.col("part") == 0) & (F.col("id") != F.col("pivot")))
    single = single.withColumn("center", F.col("pivot")).drop("region")
    rest = (parted.unionByName(single).groupBy(F.col("center").alias("region"), "id")
            .agg(F.min("place").alias("place")))
    rest = materialize(_several(_labelled(rest, labels)), "open")
    first = first.select(F.col("a").alias("id"), F.col("b").alias("region"), "low", "high")
    rest = rest.join(first, ["id", "region"], "left")
    itself = F.col("id") == F.col("region")
    rest = materialize(rest.withColumns({
        "low": F.when(itself, 0.0).otherwise(F.coalesce("low", F.lit(0.0))),
        "high": F.when(itself, 0.0).otherwise(F.coalesce("high", F.lit(1.0)))})
        .withColumn("away", F.col("low")), "open")
    release(members)
    pivots = _PIVOTS
    while not rest.isEmpty():
        new, left, used = _round(rest, sets, texts, k, share, pivots)
        if not new.isEmpty():
            links = links.unionAll(new)
            labels = _united(labels, new)
            left = _labelled(left.drop("component"), labels)
        before, rest = rest, materialize(_several(left).select(*rest.columns), "open")
        release(before, *used)
        pivots *= _MORE_PIVOTS
    _drop(texts, sets)
    return docs.select("id", "n"), links, labels


def _components(links: DataFrame) -> DataFrame:
    return materialize(components(links.select("a", "b")), "components")


def _united(labels: DataFrame, new: DataFrame) -> DataFrame:
    """``labels`` after ``new`` links: only the components that these join are looked at again."""
    ends = new.select("a", "b").distinct()
    a = labels.select(F.col("id").alias("a"), F.col("component").alias("of_a"))
    b = labels.select(F.col("id").alias("b"), F.col("component").alias("of_b"))
    known = materialize(ends.join(a, "a", "left").join(b, "b", "left").select(
        F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")).distinct(), "unions")
    joined = components(known).select(F.col("id").alias("before"), F.col("component").alias("after"))
    # A component is called by its smallest member, so a document without one is its own.
    alone = known.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    alone = alone.join(labels.select("id"), "id", "left_anti").withColumn("component", F.col("id"))
    every = labels.unionAll(alone)
    moved = every.join(joined, F.col("component") == F.col("before"), "left")
    return materialize(moved.select("id", F.coalesce("after", "component").alias("component")),
                       "components")


def _meet(pairs: DataFrame, docs: DataFrame, rows: DataFrame, k: int, share: int):
    """Bounds of the pairs' distances (``a, b, low, high``), and the links among them."""
    bounds = materialize(_bounded(pairs, docs, share), "bounds")
    # Rounding must not lose a pair at the very threshold.
    near = bounds.filter(F.col("low") <= (100 - share) / 100 + 1e-9).select("a", "b").distinct()
    met = _distances(near, rows, k)
    within = (F.col("common") > 0) & (100 * F.col("common") >= share * F.col("either"))
    away = (1 - F.max(F.col("common") / F.col("either"))).alias("away")
    exact = met.groupBy("a", "b").agg(away)
    bounds = (bounds.groupBy("a", "b").agg(F.min("low").alias("low"), F.count("a").alias("texts"))
              .join(exact, ["a", "b"], "left"))
    # Documents with several texts have no one distance.
    one = F.col("texts") == 1
    return bounds.select("a", "b", F.when(one, F.coalesce("away", "low")).otherwise(0.0).alias("low"),
                         F.when(one, F.coalesce("away", F.lit(1.0))).otherwise(1.0).alias("high")), met.filter(within)


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return (rows.join(labels, "id", "left")
            .withColumn("component", F.coalesce("component", "id")))


def _round(rest: DataFrame, docs: DataFrame, rows: DataFrame, k: int, share: int,
           pivots: int) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """One step of the recursion inside regions: links found, the rows that go on, and the tables
    that are free once these are written.

    ``rest``: region (its first pivot), id, place, low and high (bounds of the distance to the
    first pivot), away (mean distance to the pivots of the last round), component, members.
    """
    in_component = W.partitionBy("region", "component").orderBy("away", "id")
    central_first = W.partitionBy("region").orderBy("turn", "away", "id")
    chosen = (rest.withColumn("turn", F.row_number().over(in_component))
              .filter(F.col("turn") <= pivots)
              .withColumn("rank", F.row_number().over(central_first))
              .filter(F.col("rank") <= pivots)
              .select("region", *[F.col(c).alias(f"q_{c}") for c in
                                  ("id", "place", "low", "high", "component")]))
    chosen = materialize(chosen, "pivots")
    apart = (100 - share) / 100 + 1e-9
    far = (F.col("low") - F.col("q_high") > apart) | (F.col("q_low") - F.col("high") > apart)
    windows = ((F.col("component") != F.col("q_component")) & ~far
               & _may_link(F.col("place"), F.col("q_place"), share))
    meetings = materialize(
        rest.join(chosen, "region").filter(windows)
        .select("region", "id", F.greatest("id", "q_id").alias("a"), F.least("id", "q_id").alias("b")),
        "meetings")
    bounds, new = _meet(meetings.select("a", "b").distinct(), docs, rows, k, share)
    means = (meetings.join(bounds, ["a", "b"]).groupBy("region", "id")
             .agg(F.avg("low").alias("mean")))
    # A chosen pivot has met all of its region.
    done = chosen.select("region", F.col("q_id").alias("id"))
    left = rest.join(done, ["region", "id"], "left_anti").join(means, ["region", "id"], "left")
    left = left.withColumn("away", F.coalesce("mean", "away")).drop("mean", "members")
    return new, left, [chosen, meetings]


def near_duplicates(df: DataFrame, **parameters) -> DataFrame:
    """One row per input row: ``id, n_shingles, component_id``."""
    docs, _, labels = join(df, **parameters)
    return (docs.join(labels, "id", "left")
            .select("id", F.col("n").alias("n_shingles"),
                    F.coalesce("component", "id").alias("component_id")))


def representatives(df: DataFrame, *, id_column: str = "doc_id", **parameters) -> DataFrame:
    """The rows of ``df`` with one document left of each component, the one with the smallest
    identifier; all columns unchanged.  Identifiers are unique."""
    docs = near_duplicates(df, id_column=id_column, **parameters)
    name = fresh(df.columns, "_gone")
    gone = docs.filter("id <> component_id").select(F.col("id").alias(name)).distinct()
    return df.join(gone, F.col(id_column) == F.col(name), "left_anti")

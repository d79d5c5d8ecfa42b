import hashlib
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pontualis.llm import sharding
from pontualis.llm.queries import QUERIES
from pontualis.llm.tables import table


def naive(sizes, capacity):
    left, out = [], []
    for size in sizes:
        fits = [(r, b) for b, r in enumerate(left) if r >= size]
        if fits:
            _, b = min(fits)
        else:
            b = len(left)
            left.append(max(capacity, size))
        left[b] -= size
        out.append(b)
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=80), st.integers(30, 100))
def test_best_fit_decreasing(sizes, capacity):
    sizes.sort(reverse=True)
    assert sharding.best_fit(sizes, capacity) == naive(sizes, capacity)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 1000), min_size=1, max_size=200), st.integers(1, 9))
def test_even_bins(sizes, bins):
    sizes.sort(reverse=True)
    loads = [0] * bins
    for size, b in zip(sizes, sharding.even_bins(sizes, bins), strict=True):
        loads[b] += size
    assert max(loads) <= max(-(-sum(sizes) // bins) + sizes[0], sizes[0])


def check(rows, texts):
    shard_of, slots = {}, {}
    for r in rows:
        assert shard_of.setdefault(r.sha, r.shard) == r.shard
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sorted(r.size for r in rows) == sorted(len((t or "").encode()) + 1 for t in texts)


def test_into_shards(odd):
    rows = sharding.into_shards(odd, 3).collect()
    check(rows, [r.text for r in odd.collect()])
    assert {r.shard for r in rows} <= {0, 1, 2}


def test_loads_are_even(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "repeat('x', int(id * 7 % 300)) || id AS text")
    loads = [r["sum(size)"] for r in
             sharding.into_shards(docs, 8, parcels=512).groupBy("shard").sum("size").collect()]
    assert len(loads) == 8 and max(loads) < 1.03 * min(loads)


@pytest.mark.parametrize("large", [[3], [5], [3, 5], [4, 4, 4]])
def test_loads_beside_large_groups(large):
    total = 120_000
    sizes = [total // part for part in large]
    rest, bins = total - sum(sizes), 8 - len(sizes)
    sizes += [rest // 4000] * 4000
    loads = [0] * 8
    for size, b in zip(sizes, sharding.even_bins(sizes, 8), strict=True):
        loads[b] += size
    loads.sort(reverse=True)
    assert loads[:len(large)] == sizes[:len(large)]
    assert loads[-1] > 0 and loads[len(large)] - loads[-1] <= 0.02 * rest / bins


def test_shards_beside_a_large_group(spark):
    docs = spark.range(9_000).selectExpr(
        "id AS doc_id", "if(id % 3 = 0, repeat('y', 90), repeat('x', 85) || (10000 + id)) AS text")
    loads = sorted(r["sum(size)"] for r in
                   sharding.into_shards(docs, 8, parcels=512).groupBy("shard").sum("size").collect())
    assert len(loads) == 8 and loads[-1] == 91 * 3_000
    assert loads[-2] < 1.05 * loads[0]


def test_by_capacity(odd, spark):
    check(sharding.by_capacity(odd, 1000).collect(), [r.text for r in odd.collect()])
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat('x', int(id % 50)) || id AS text")
    rows = sharding.by_capacity(docs, 5000, zone_groups=1000).collect()
    loads = {}
    for r in rows:
        loads[r.shard] = loads.get(r.shard, 0) + r.size
    assert max(loads.values()) <= 5000
    assert sorted(loads) == list(range(len(loads)))
    assert len(loads) <= sum(loads.values()) / 5000 * 1.05 + 4


def test_empty(empty):
    assert sharding.into_shards(empty, 8).count() == 0
    assert sharding.by_capacity(empty, 100).count() == 0


def least_capacity(sizes, bins):
    """The naive packing with the least capacity that needs no more than ``bins``."""
    capacity = max(sizes[0], -(-sum(sizes) // bins))
    while True:
        out = naive(sizes, capacity)
        if max(out) < bins:
            return out
        capacity += 1


def test_query_against_a_naive_packing(spark):
    """Every row's shard, from groups, parcels and their packing one by one; and its own columns."""
    folder, parcels = "/root/testdata/sf0.001", 4096
    docs = [(r.doc_id, r.text or "") for r in table(spark, folder, "documents").collect()]
    texts = sorted({t for _, t in docs})
    sha = {t: hashlib.sha256(t.encode()).hexdigest() for t in texts}
    df = spark.createDataFrame([(s,) for s in sha.values()], "sha string")
    parcel = {r.sha: r.p for r in df.selectExpr("sha", f"pmod(xxhash64(sha), {parcels}) AS p").collect()}
    total, groups, dealt = 0, {}, {}
    for _, t in docs:
        size = len(t.encode()) + 1
        groups[sha[t]] = groups.get(sha[t], 0) + size
        total += size
    items = []
    for s, size in groups.items():
        if size * parcels > total:
            items.append((-size, s, -1))
        else:
            dealt[parcel[s]] = dealt.get(parcel[s], 0) + size
    items = sorted([*items, *((-size, "", p) for p, size in dealt.items())])
    sizes, rest, alone = [-x[0] for x in items], total, 0
    while sizes[alone] * (8 - alone) > rest:
        rest -= sizes[alone]
        alone += 1
    shards = [*range(alone), *(alone + b for b in least_capacity(sizes[alone:], 8 - alone))]
    of = {(s if p < 0 else p): shard for (_, s, p), shard in zip(items, shards, strict=True)}
    rows = QUERIES["op8_sharding"](spark, folder).collect()
    text = dict(docs)
    assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in docs)
    slots = {}
    for r in rows:
        t = text[r.doc_id]
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (
            len(t.encode()) + 1, zlib.crc32(t.encode()), "bytes", None)
        assert r.shard == of.get(sha[t], of.get(parcel[sha[t]]))
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(slots) == list(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())

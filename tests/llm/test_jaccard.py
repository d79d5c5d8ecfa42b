import collections
import random
import re
import tracemalloc

import numpy as np
import pytest

from pontualis.llm import components, jaccard
from pontualis.llm.queries import QUERIES
from pontualis.llm.tables import table
from tests.plans import settings


def shingles(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(w) >= k:
        return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    return frozenset([tuple(w)] if w else [])


def brute(docs, share=75):
    """(id, shingles, component) of every row, from all pairs that share a shingle."""
    sets = [(i, shingles(t)) for i, t in docs]
    up = {i: i for i, _ in sets if i is not None}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = collections.defaultdict(list)
    for n, (i, s) in enumerate(sets):
        if i is None:
            continue
        common = collections.Counter(m for g in s for m in holders[g])
        for m, both in common.items():
            j, other = sets[m]
            if 100 * both >= share * (len(s) + len(other) - both):
                a, b = sorted((top(i), top(j)))
                up[b] = a
        for g in s:
            holders[g].append(n)
    return sorted(((i, len(s), None if i is None else top(i)) for i, s in sets), key=str)


def found(df, **parameters):
    return sorted((tuple(r) for r in jaccard.near_duplicates(df, **parameters).collect()), key=str)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in table(spark, folder, "documents").collect()]
    got = QUERIES["op3_jaccard_join"](spark, folder).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs)


def test_odd_rows(odd, empty):
    assert found(odd) == brute([(r.doc_id, r.text) for r in odd.collect()])
    kept = jaccard.representatives(odd)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} == {None, 1, 2, 3, 4, 6, 7, 9, 10, 12}
    assert found(empty) == []


def chains(seed):
    """Families whose texts drift apart step by step, so that links form chains, and texts
    that share a passage without being similar."""
    dice = random.Random(seed)
    docs, passage = [], [f"p{i}" for i in range(14)]
    for family in range(6):
        words = [f"w{family}_{i}" for i in range(dice.choice((9, 20, 60)))]
        for _ in range(dice.choice((3, 12, 25))):
            docs.append(" ".join(words))
            words = list(words)
            for _ in range(dice.choice((1, 1, 2))):
                words[dice.randrange(len(words))] = f"n{dice.random()}"
    for i in range(40):
        own = [f"o{i}_{j}" for j in range(dice.choice((1, 2, 4, 8)))]
        docs.append(" ".join([*passage, *own]))
    return list(enumerate(docs))


@pytest.mark.parametrize("seed", range(3))
def test_recursion_is_exact(spark, seed, monkeypatch):
    monkeypatch.setattr(jaccard, "_PIVOTS", 2)
    monkeypatch.setattr(jaccard, "_REGION", 8)
    docs = chains(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = found(df)
    assert got == brute(docs)
    assert len({c for _, _, c in got}) < len(docs)


def test_batches_of_texts_are_small(spark, monkeypatch):
    """Three thousand texts of four thousand bytes in one partition, every two of them alike."""
    find = jaccard.shingle_sets

    def bounded(texts, k):
        assert texts.get_total_buffer_size() < 10 << 20
        return find(texts, k)

    monkeypatch.setattr(jaccard, "shingle_sets", bounded)
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None)
    words = "transform(sequence(0, 400), i -> concat('word', id div 2, '_', i))"
    docs = spark.range(0, 3000, 1, 1).selectExpr(
        "id AS doc_id", f"concat_ws(' ', array_append({words}, concat('end', id % 2))) AS text")
    got = found(docs)
    assert sorted(got) == [(i, 398, i // 2 * 2) for i in range(3000)]
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) == before


def test_shingles_recur_across_batches(spark):
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch="1"):
        rows = spark.createDataFrame([(i, "a b c d e") for i in range(4)], "id long, text string").coalesce(1)
        counted = jaccard._scan(rows, 5).filter("shingle IS NOT NULL").select("df").collect()
    assert [r.df for r in counted] == [4]


@pytest.mark.parametrize("times", [1, 2, 3])
def test_repeated_values(times):
    dice = random.Random(5)
    for n in [*range(8), *range(8), 500]:
        values = sorted(dice.randrange(1 + n // 3) for _ in range(n))
        counts = sorted((v, c) for v, c in collections.Counter(values).items() if c >= times)
        got = jaccard.repeated(np.array(values, np.uint64), times)
        assert list(zip(*(x.tolist() for x in got), strict=True)) == counts


def test_repeated_values_are_found_without_copies():
    every = np.repeat(np.arange(1 << 17, dtype=np.uint64), 8)
    tracemalloc.start()
    values, counts = jaccard.repeated(every, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(values) == 1 << 17 and set(counts.tolist()) == {8}
    assert peak < every.nbytes


def test_components(spark):
    dice = random.Random(3)
    edges = [(dice.randrange(400), dice.randrange(400)) for _ in range(260)]
    edges += [(1000 + i, 1001 + i) for i in range(50)] + [(2000, 2001 + i) for i in range(300)]
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    got = components.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.id: r.component for r in got.collect()} == {
        x: top(x) for a, b in edges if a != b for x in (a, b)}

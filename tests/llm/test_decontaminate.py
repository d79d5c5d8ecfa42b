import hashlib
import re

import pytest

from pontualis.llm import decontaminate
from pontualis.llm.queries import QUERIES
from pontualis.llm.tables import table


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, size=13):
    """(id, words, hit positions, items) of every document."""
    windows = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[k:k + size]), set()).add(item)
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for length in {len(x) for x in windows}:
            for k in range(len(w) - length + 1):
                if names := windows.get(tuple(w[k:k + length])):
                    hit |= set(range(k, k + length))
                    found |= names
        yield i, len(w), hit, sorted(x for x in found if x is not None)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in table(spark, folder, "documents").collect()]
    items = [(str(r.item_id), r.text) for r in table(spark, folder, "benchmark").collect()]
    wanted = {(i, n, len(h), len(f), hashlib.sha256(",".join(f).encode()).hexdigest(),
               bool(h) and 20 * len(h) >= n) for i, n, h, f in brute(docs, items)}
    got = QUERIES["op10_decontamination"](spark, folder)
    assert {tuple(r) for r in got.collect()} == wanted
    assert any(w[5] for w in wanted) and not all(w[5] for w in wanted)


ITEMS = [("1", "A b c d e f g h i j k l m n o"), ("1", "one two"), ("2", "café au lait"), ("3", None),
         ("4", ""), (None, "fin"), ("5", "x x x x x x x x x x x x x x"), ("6", "Word3x3 word4x4")]
DOCS = [(20, "x " * 20), (21, "x " * 13), (22, "x " * 12), (23, "m n o a b c d e f g h i j k l m n o"),
        (24, "one, two; ONE TWO one"), (25, "b c d e f g h i j k l m n")]


@pytest.mark.parametrize("block_words", [1_000_000, 12])
def test_odd_rows(spark, odd, block_words):
    benchmark = spark.createDataFrame(ITEMS, "item_id string, text string")
    more = spark.createDataFrame(DOCS, "doc_id long, text string")
    docs = odd.select("doc_id", "text").union(more)
    got = decontaminate.matches(docs, benchmark, block_words=block_words)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    wanted = sorted(((i, n, len(h), f, h) for i, n, h, f in brute(rows, ITEMS)), key=str)
    found = sorted(((r.id, r.n_words, r.n_hit, list(r["items"]),
                     {p for s in r.spans for p in range(s.start, s.end)})
                    for r in got.collect()), key=str)
    assert found == wanted
    clean = decontaminate.clean(odd, benchmark, block_words=block_words)
    assert clean.columns == odd.columns
    kept = sorted((i for i, n, h, _ in brute([(r.doc_id, r.text) for r in odd.collect()], ITEMS)
                   if not (h and 20 * len(h) >= n)), key=str)
    assert sorted((r.doc_id for r in clean.collect()), key=str) == kept


def test_proximity(spark):
    benchmark = spark.createDataFrame([("1", "red green blue")], "item_id string, text string")
    docs = spark.createDataFrame(
        [(1, "red green blue"), (2, "red and green and blue"), (3, "red a b c d e f green blue"),
         (4, "green red blue")], "doc_id long, text string")
    got = {r.id: (list(r["items"]), list(r.near))
           for r in decontaminate.matches(docs, benchmark, slop=3).collect()}
    assert got == {1: (["1"], ["1"]), 2: ([], ["1"]), 3: ([], []), 4: ([], ["1"])}


def test_empty(spark, empty, odd):
    nothing = spark.createDataFrame([], "item_id string, text string")
    assert decontaminate.matches(empty, nothing).count() == 0
    assert {r.n_hit for r in decontaminate.matches(odd, nothing).collect()} == {0}
    assert decontaminate.clean(odd, nothing).count() == odd.count()


def test_texts_are_taken_in_small_parts(spark, monkeypatch):
    """Three thousand texts of nine thousand bytes in one partition."""
    find, flatten = decontaminate.find_words, decontaminate.flat

    def small(texts):
        assert texts.get_total_buffer_size() < 10 << 20
        return flatten(texts)

    def bounded(data, offsets, inside):
        assert len(data) <= 1 << 19
        return find(data, offsets, inside)

    item = " ".join(f"item{i}" for i in range(13))
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    words = "transform(sequence(1, 1000), i -> concat('word', i + id))"
    docs = spark.range(0, 3000, 1, 1).selectExpr(
        "id AS doc_id", f"concat_ws(' ', {words}, repeat(if(id % 3 = 0, '{item} ', ''), 10)) AS text")
    monkeypatch.setattr(decontaminate, "find_words", bounded)
    text = docs.select("text").toArrow().column(0).combine_chunks()
    (queries,) = decontaminate.blocks(docs.limit(3), benchmark)
    postings = decontaminate.index_batch(queries, text, 0)
    assert [len(x) for x in postings.field(1).to_pylist()] == [130, 0, 0] * 1000
    monkeypatch.setattr(decontaminate, "flat", small)
    kept = decontaminate.clean(docs, benchmark)
    assert kept.filter("doc_id % 3 = 0").count() == 0 and kept.count() == 2000

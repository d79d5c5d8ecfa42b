import re

import pytest

import corpus_pipeline
from pontualis.llm import mixing
from pontualis.llm.tables import table
from pontualis.sources.scratch import materialize
from tests.llm.test_decontaminate import brute as contamination
from tests.llm.test_jaccard import brute as near

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """The rows after every stage."""
    docs, out = table(spark, SMALL, "documents"), []
    docs = docs.union(spark.createDataFrame(
        [(10_001, None, "en", "src1", None), (10_002, "12 %%", None, None, 5)], docs.schema))
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SMALL), name.replace(" ", "_"))
        out.append(docs)
    return out


def texts(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "n-gram Jaccard join", "benchmark decontamination", "mixing", "sharding"]
    assert all(df.columns == steps[0].columns for df in steps[:5])


def test_only_texts_without_language_go(steps):
    kept = {i for i, _ in texts(steps[1])}
    assert kept == {i for i, t in texts(steps[0]) if any(map(str.isalpha, t or ""))}


def test_all_texts_with_letters_stay_where_no_language_is_named(spark):
    rows = [(1, "plain text"), (2, "12 %%"), (3, None), (4, ""), (5, "éé"), (6, "x")]
    docs = spark.createDataFrame([(i, t, None, "s", 0) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.identified(spark, docs, SMALL)
    assert kept.columns == docs.columns
    assert sorted(i for i, _ in texts(kept)) == [1, 5, 6]


def test_texts_in_languages_that_were_not_learned_go(spark):
    docs = table(spark, SMALL, "documents")
    foreign = [(20_001, "Это русский текст о погоде и природе, который никто не учил."),
               (20_002, "日本語の文章を分割する"), (20_003, "αυτό είναι ένα ελληνικό κείμενο"),
               (20_004, "the and that of the thing")]
    more = spark.createDataFrame([(i, t, None, "s", 0) for i, t in foreign], docs.schema)
    kept = {i for i, _ in texts(corpus_pipeline.identified(spark, docs.union(more), SMALL))}
    assert {i for i, _ in texts(docs)} <= kept and kept & {i for i, _ in foreign} == {20_004}


def test_odd_tables_go_through_all_stages(spark):
    """Nulls, repeated rows, a very long text and a column of a clashing name; and no rows at all."""
    long = " ".join(f"the word{i % 900} of thing{i}" for i in range(8000))
    rows = [(1, None), (2, ""), (3, "the same text of some words"), (3, "the same text of some words"),
            (4, long), (None, "of the and to the"), (5, "the same text of some words")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, "x") for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, _gain string")
    for table_ in (docs, docs.limit(0)):
        out = table_
        for name, stage in corpus_pipeline.STAGES:
            out = materialize(stage(spark, out, SMALL), name.replace(" ", "_"))
        ids = {r.doc_id for r in out.collect()}
        assert ids == ({3, 4, None} if table_ is docs else set())


def test_one_of_each_group_stays(steps):
    assert {i for i, _ in texts(steps[2])} == {c for _, _, c in near(texts(steps[1]))}


def test_contaminated_texts_go(spark, steps):
    items = [(str(r.item_id), r.text) for r in table(spark, SMALL, "benchmark").collect()]
    wanted = {i for i, n, h, _ in contamination(texts(steps[2]), items)
              if not (h and 20 * len(h) >= n)}
    assert {i for i, _ in texts(steps[3])} == wanted
    assert wanted < {i for i, _ in texts(steps[2])}


def test_the_mix_holds_what_is_taken(steps):
    taken = {r.id: r.taken for r in mixing.mix(steps[3]).collect() if r.taken}
    found = {}
    for i, t in texts(steps[4]):
        found[i] = found.get(i, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t))
    assert found == taken


def test_all_rows_are_sharded(steps):
    rows = steps[5].collect()
    assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in texts(steps[4]))
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 8

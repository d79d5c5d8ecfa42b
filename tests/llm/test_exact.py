import hashlib

import pytest

from pontualis.llm import exact


def expected(rows, keep):
    best = {}
    for i, t in rows:
        if i is not None:
            best[t or ""] = keep(best.get(t or "", i), i)
    sizes = {}
    for _, t in rows:
        sizes[t or ""] = sizes.get(t or "", 0) + 1
    return sorted(((i, hashlib.sha256((t or "").encode()).hexdigest(), best.get(t or ""),
                    sizes[t or ""], i == best.get(t or "")) for i, t in rows), key=str)


@pytest.mark.parametrize("keep, runs, fan_in", [("largest", 256, 4), ("smallest", 8, 3),
                                                ("smallest", 1, 2)])
def test_groups(odd, keep, runs, fan_in):
    got = exact.groups(odd, keep=keep, runs=runs, fan_in=fan_in)
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(
        rows, max if keep == "largest" else min)


def test_kept_rows_are_unchanged(odd):
    kept = exact.exact_dedup(odd)
    assert kept.columns == odd.columns
    # 5 equals 4 and is there twice; 1, 2 and a row without identifier are empty.
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 6, 7, 8, 9, 10, 11, 12]


def test_empty(empty):
    assert exact.groups(empty).count() == 0


def test_a_hot_text_is_spread(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'hot', string(id)) AS text")
    got = exact.groups(docs, keep="largest").filter("kept")
    assert got.count() == 2001
    assert got.filter("group_size = 1000").collect()[0].keep_id == 2997


def test_no_python_on_the_main_path(spark):
    docs = spark.range(10).selectExpr("id AS doc_id", "'x' AS text")
    plan = exact.groups(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan

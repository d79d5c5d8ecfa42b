"""Registered queries against their SQL, on the test tables and on odd ones."""

import pytest

import __spark_entry__ as entry_point
from pontualis.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(name, spark, agrees):
    agrees(QUERIES[name](spark, SMALL), ORACLE[name], SMALL)


@pytest.mark.parametrize("name", sorted(set(ORACLE) - {"op9_line_dedup"}))
def test_matches_sql_on_odd_rows(name, spark, odd, odd_turns, folder, agrees):
    labels = spark.createDataFrame([(1, 1, 0), (4, None, 1), (5, 1, 1), (5, 0, None), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    place = folder(documents=odd, conversations=odd_turns, labels=labels)
    agrees(QUERIES[name](spark, place), ORACLE[name], place)


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert {"pipeline", *QUERIES} <= set(entry_point.queries())

"""Every registered query against its SQL on the same tables."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from tests.plans import settings
from workload.oracle import ORACLE
from workload.queries import QUERIES


@pytest.fixture(scope="session")
def duck(small):
    con = duckdb.connect()
    for file in Path(small).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def canonical(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    return value


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, Counter(tuple(canonical(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(name, spark, small, duck):
    df = QUERIES[name](spark, small)
    names, got = multiset(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(ORACLE[name])
    wanted_names, wanted = multiset([d[0] for d in result.description], result.fetchall())
    assert names == wanted_names
    assert sum(got.values()) == sum(wanted.values())
    assert not list((got - wanted).items())[:3] and not list((wanted - got).items())[:3]


def test_all_have_sql():
    assert set(QUERIES) == set(ORACLE)


def test_all_are_registered():
    assert QUERIES.items() <= entry_point.queries().items()
    assert ORACLE.items() <= entry_point.oracle_sql().items()


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() > 0 and "taxa_cancelamento" in df.columns


@pytest.mark.parametrize("name", ["ref_flags", "quarantine_reasons", "gold_obt", "side_by_side"])
def test_matches_sql_when_nothing_may_be_broadcast(name, spark, small, duck):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1",
                  spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20000",
                  spark__sql__adaptive__advisoryPartitionSizeInBytes="40000"):
        test_matches_sql(name, spark, small, duck)

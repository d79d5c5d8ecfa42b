"""Layer comparisons against brute force, with hot and missing keys."""

import random

import pytest
from pyspark.sql import functions as F

from pontualis.model import FLIGHT_COLUMNS, INSTANTS, PAIR_KEYS, SOURCE_FILE
from pontualis.operators import reconcile
from pontualis.plans.silver import silver_flights
from tests.plans import executed, settings
from workload import flights as w


@pytest.fixture(scope="module")
def layers(spark):
    """A third of the flights share one key, some have none, and copies abound."""
    rng = random.Random(7)
    rows = []
    for i in range(240):
        hot = i % 3 == 0
        carrier = None if i % 11 == 0 else "HOT" if hot else rng.choice("ABC")
        instants = [rng.choice(["null", "2026-01-01 10:00:00", "lixo",
                                f"2026-01-0{rng.randint(1, 9)} 11:00:00.123456789"])
                    for _ in INSTANTS]
        rows.append((i, carrier, "1" if hot else str(i % 4), "0", "N", "SBGR", "SBSP",
                     *instants, "REALIZADO", rng.choice(["N/A", "X", None]), "m.csv"))
    schema = ", ".join(f"{c} string" for c in (*FLIGHT_COLUMNS, SOURCE_FILE))
    raw = spark.createDataFrame(rows, "event_id bigint, " + schema).cache()
    return raw, silver_flights(raw).cache()


def literal_pairs(raw, typed):
    b, s = raw.alias("b"), typed.alias("s")
    on = [F.col(f"b.{k}") == F.col(f"s.{k}") for k in PAIR_KEYS]
    return b.join(s, on)


def test_pair_counts_equal_the_literal_join(layers):
    raw, typed = layers
    pairs = literal_pairs(raw, typed)
    measures = {
        "total_linhas": F.lit(True),
        "bronze_justificativa_NA": F.col("b.codigo_justificativa") == "N/A",
        "silver_justificativa_null": F.col("s.codigo_justificativa").isNull(),
        "linhas_com_atraso_partida": F.col("s.atraso_partida_min").isNotNull(),
    }
    for c in INSTANTS:
        measures[f"bronze_{c}_str_null"] = F.col(f"b.{c}") == "null"
        measures[f"silver_{c}_null_real"] = F.col(f"s.{c}").isNull()
        measures[f"{c}_cast_ok"] = (F.col(f"b.{c}") != "null") & F.col(f"s.{c}").isNotNull()
    wanted = pairs.agg(*[F.count_if(m).alias(n) for n, m in measures.items()]).first().asDict()
    got = reconcile.reconcile_pairs(raw, typed).first().asDict()
    assert wanted["total_linhas"] > 2500
    assert {n: int(got[n]) for n in measures} == wanted


def test_pair_counts_beyond_bigint(spark):
    groups = spark.createDataFrame([(4 * 10**9,)], "n bigint").select(
        F.col("n").cast(reconcile.PAIR_COUNT).alias("n"))
    assert int(groups.agg(F.sum(F.col("n") * F.col("n"))).first()[0]) == 16 * 10**18


def test_pairs_are_never_joined_row_by_row(layers):
    with settings(layers[0].sparkSession, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = executed(reconcile.reconcile_pairs(*layers))
    join = plan.index("SortMergeJoin")
    assert plan[join:].count("HashAggregate") >= 4


@pytest.mark.parametrize("n", [1, 5, 40])
def test_side_by_side_equals_the_literal_join(layers, n):
    raw, typed = layers
    pairs = literal_pairs(raw, typed).select(
        "s.partida_prevista", "s.event_id", F.col("b.event_id").alias("raw_id"),
        F.col("b.partida_real").alias("bronze_partida_real"),
        F.col("s.icao_empresa"), F.col("s.atraso_partida_min"))
    order = [F.col(c).asc_nulls_first() for c in ("partida_prevista", "event_id", "raw_id")]
    wanted = [tuple(r)[3:] for r in pairs.orderBy(*order).limit(n).collect()]
    got = reconcile.side_by_side(raw, typed, tie="event_id", n=n).collect()
    assert [(r.bronze_partida_real, r.icao_empresa, r.silver_atraso_partida_min)
            for r in got] == wanted


def test_side_by_side_without_a_unique_column(layers):
    raw, typed = layers
    with_id = reconcile.side_by_side(raw, typed, tie="event_id", n=30).collect()
    without = reconcile.side_by_side(raw.drop("event_id"), typed.drop("event_id"), n=30)
    assert without.columns == reconcile.side_by_side(raw, typed, tie="event_id").columns
    scheduled = [r.silver_partida_prevista for r in with_id]
    assert [r.silver_partida_prevista for r in without.collect()] == scheduled


def test_keyed_diff_on_two_versions_of_a_registry(spark, small):
    customer = w.table(spark, small, "customer").select("c_custkey", "c_mktsegment")
    old = customer.filter("c_custkey % 11 <> 0").withColumn(
        "c_mktsegment", F.when(F.col("c_custkey") % 5 == 0, "X").otherwise(F.col("c_mktsegment")))
    new = customer.filter("c_custkey % 7 <> 0")
    diff = reconcile.keyed_diff(new, old, ["c_custkey"], "c_mktsegment")
    got = {r.status: r["count"] for r in diff.groupBy("status").count().collect()}
    assert sum(got.values()) == 1500 - 1500 // 77 - 1
    assert got["ALTERADA"] == customer.filter(
        "c_custkey % 5 = 0 AND c_custkey % 7 <> 0 AND c_custkey % 11 <> 0").count()


def test_keyed_diff_compares_null_safe(spark):
    left = spark.createDataFrame([(1, None), (2, None), (3, "a")], "k int, v string")
    right = spark.createDataFrame([(1, None), (2, "b"), (4, None)], "k int, v string")
    got = {r.k: r.status for r in reconcile.keyed_diff(left, right, ["k"], "v").collect()}
    assert got == {1: "INALTERADA", 2: "ALTERADA", 3: "REMOVIDA", 4: "ADICIONADA"}


def test_multiset_difference_counts_copies(spark):
    left = spark.createDataFrame([("a",)] * 5 + [(None,), ("b",)], "x string")
    right = spark.createDataFrame([("a",)] * 3 + [(None,), ("c",)], "x string")
    got = reconcile.multiset_difference(left, right, ["x"]).collect()
    assert {r.x: r.saldo for r in got} == {"a": 2, "b": 1, "c": -1}


def test_conservation(spark, small):
    raw = w.raw_flights(spark, small)
    kept = reconcile.count_conservation({"a": raw}, {"b": raw}).first()
    assert kept.asDict() == {"a": 10000, "b": 10000, "diferenca": 0}
    lost = reconcile.count_conservation({"a": raw, "b": raw}, {"c": raw}).first()
    assert lost.asDict() == {
        "a": 10000, "b": 10000, "c": 10000, "diferenca": 10000, "soma_esperada": 20000}


def test_profile_without_join(spark, small):
    raw, typed = w.raw_flights(spark, small), w.flights(spark, small)
    assert "Join" not in executed(reconcile.transform_profile(raw, typed))
    row = reconcile.transform_profile(raw, typed).first()
    assert row.bronze_partida_prevista_str_null == row.silver_partida_prevista_null_real == 100
    assert row.partida_real_cast_ok == 7986 and row.total_linhas == 10000


def test_a_removed_column_comes_last_however_many_there_are(spark):
    left = spark.createDataFrame([("gone", "int")], "coluna string, tipo string")
    right = spark.createDataFrame([(f"c{i}", "int", i) for i in range(1, 1005)],
                                  "coluna string, tipo string, posicao int")
    diff = reconcile.keyed_diff(left, right, ["coluna"], "tipo", position="posicao").collect()
    assert diff[-1].coluna == "gone" and diff[999].coluna == "c1000"


def test_side_by_side_moves_keys_and_order_only(spark, small):
    for tie in (None, "event_id"):
        shown = reconcile.side_by_side(w.raw_flights(spark, small), w.flights(spark, small), tie=tie)
        plan = shown._jdf.queryExecution().executedPlan().toString()
        assert "codigo_justificativa" not in "".join(
            line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
        semi = [line for line in plan.splitlines() if "LeftSemi" in line]
        assert len(semi) == 2


def test_pair_counts_stay_narrow_until_the_product(spark, small):
    plan = reconcile.reconcile_pairs(w.raw_flights(spark, small), w.flights(spark, small))
    lines = plan._jdf.queryExecution().executedPlan().toString().splitlines()
    assert not any("decimal" in line for line in lines if "partial_count" in line)

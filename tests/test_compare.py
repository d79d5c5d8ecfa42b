"""Comparing loads bucket by bucket, diffs of several columns, order, prefixes."""

import random

import pytest
from pyspark.sql import functions as F

from pontualis.operators import joins, order, profile, reconcile
from pontualis.plans import gold
from pontualis.sources import compare, loads
from tests.plans import executed

ROWS = [(i, f"v{i % 7}" if i % 11 else None, i % 5) for i in range(400)]


def table(spark, rows, schema="id int, v string, n int"):
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture
def two_loads(spark, tmp_path):
    path = str(tmp_path / "t")
    later = [(i, "new" if i == 17 else v, n) for i, v, n in ROWS if i != 40] + [(1000, "x", None)]
    for load_id, rows in (("a", ROWS), ("b", later)):
        compare.publish_in_buckets(table(spark, rows), path, load_id, ["id"], buckets=64)
    return path


def test_only_the_buckets_that_differ_are_read(spark, two_loads):
    buckets = compare.changed_buckets(spark, two_loads, "a", "b")
    assert 1 <= len(buckets) <= 3
    diff = compare.changed_rows(spark, two_loads, "a", "b", carry=["n"])
    plan = executed(diff)
    inside = ",".join(map(str, buckets))
    assert plan.count("PartitionFilters: [_balde") + plan.count("PartitionFilters: [isnotnull(_balde") == 2
    assert f"_balde#" in plan and f"IN ({inside})" in plan if len(buckets) > 1 else True
    got = {r.id: (r.status, [tuple(c) for c in r.alteracoes], r.n) for r in diff.collect()}
    assert got == {
        17: ("ALTERADA", [("v", "v3", "new")], 2),
        40: ("REMOVIDA", [("v", "v5", None), ("n", "0", None)], 0),
        1000: ("ADICIONADA", [("v", None, "x")], None)}


def test_equal_loads_read_no_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    for load_id, rows in (("a", ROWS), ("b", list(reversed(ROWS)))):
        compare.publish_in_buckets(table(spark, rows), path, load_id, ["id"], buckets=8)
    assert compare.changed_buckets(spark, path, "a", "b") == []
    assert compare.changed_rows(spark, path, "a", "b").count() == 0


def test_one_changed_row_is_one_bucket(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, "x", 1) for i in range(300)]
    for load_id, changed in (("a", rows), ("b", [(5, "y", 1), *[r for r in rows if r[0] != 5]])):
        compare.publish_in_buckets(table(spark, changed), path, load_id, ["id"], buckets=32)
    (bucket,) = compare.changed_buckets(spark, path, "a", "b")
    plan = executed(compare.changed_rows(spark, path, "a", "b"))
    assert plan.count(f"(_balde#") >= 2 and plan.count(f" = {bucket})") >= 2


def test_rows_without_a_key(spark, tmp_path):
    """Repeated rows, NULLs that change places, and a hot value."""
    path = str(tmp_path / "t")
    first = [("hot", str(i % 3), None) for i in range(500)] + [("k", None, "a"), ("k", None, "a")]
    second = first[1:] + [("k", "a", None)]
    for load_id, rows in (("a", first), ("b", second)):
        compare.publish_in_buckets(table(spark, rows, "k string, v string, w string"), path, load_id,
                                   ["k"], buckets=16)
    rows = {tuple(r) for r in compare.surplus_rows(spark, path, "a", "b").collect()}
    assert rows == {("hot", "0", None, 1), ("k", "a", None, -1)}


def test_digests_are_made_again_if_their_writer_died(spark, two_loads, tmp_path, monkeypatch):
    path = str(tmp_path / "u")
    with monkeypatch.context() as patch:
        patch.setattr(compare, "digests", lambda *a: None)
        compare.publish_in_buckets(table(spark, ROWS), path, "a", ["id"], buckets=8)
    compare.publish_in_buckets(table(spark, ROWS), path, "b", ["id"], buckets=8)
    assert compare.changed_buckets(spark, path, "a", "b") == []
    assert loads.published(spark, f"{path}/resumos", "a").count() == 8


def test_other_buckets_are_refused(spark, two_loads):
    compare.publish_in_buckets(table(spark, ROWS), two_loads, "c", ["id"], buckets=8)
    loads.publish(table(spark, ROWS), two_loads, "plain")
    for other in ("c", "plain"):
        with pytest.raises(compare.NotComparable):
            compare.changed_rows(spark, two_loads, "a", other)


def test_audit_columns_do_not_count(spark, tmp_path):
    path = str(tmp_path / "t")
    for load_id in "ab":
        df = table(spark, ROWS).withColumn("_ingerido_em", F.current_timestamp())
        compare.publish_in_buckets(df, path, load_id, ["id"], buckets=8)
    assert compare.changed_buckets(spark, path, "a", "b") == []


def test_diff_rows_against_a_fold(spark):
    dice = random.Random(2)

    def side():
        keys = dice.sample([(a, b) for a in (None, 1, 2, 3) for b in ("x", None, "y")], 9)
        return {k: tuple(dice.choice([None, 1, 2]) for _ in range(3)) for k in keys}

    left, right = side(), side()
    dfs = [spark.createDataFrame([(*k, *v) for k, v in s.items()], "a int, b string, p int, q int, r int")
           for s in (left, right)]
    got = {(r.a, r.b): ([tuple(c) for c in r.alteracoes], r.status, r.r)
           for r in reconcile.diff_rows(*dfs, ["a", "b"], ["p", "q"], carry=["r"]).collect()}
    wanted = {}
    for key in left.keys() | right.keys():
        old, new = left.get(key), right.get(key)
        changes = [(c, *[None if s is None or s[i] is None else str(s[i]) for s in (old, new)])
                   for i, c in enumerate("pq") if (old and old[i]) != (new and new[i])]
        status = ("ADICIONADA" if old is None else "REMOVIDA" if new is None
                  else "ALTERADA" if changes else "INALTERADA")
        wanted[key] = (changes, status, (new or old)[2])
    assert got == wanted


def test_diff_rows_in_the_order_of_the_right_side(spark):
    left = spark.createDataFrame([("gone", 1, 9), ("b", 1, 8)], "k string, v int, at int")
    right = spark.createDataFrame([("b", 2, 2), ("a", 1, 1)], "k string, v int, at int")
    rows = reconcile.diff_rows(left, right, ["k"], ["v"], position="at").collect()
    assert [r.k for r in rows] == ["a", "b", "gone"]
    text = reconcile.diff_rows(left, right, ["k"], ["v"]).select(reconcile.changes_text().alias("t"))
    assert {r.t for r in text.collect()} == {"v: 1 -> (vazio)", "v: 1 -> 2", "v: (vazio) -> 1"}


def test_schemas_carry_their_comments(spark):
    typed = spark.range(1).select(F.col("id").alias("a", metadata={"comment": "what a is"}), F.lit("x").alias("b"))
    diff = reconcile.keyed_diff(reconcile.schema_as_rows(spark.range(1).select(F.lit("1").alias("a"))),
                                reconcile.schema_as_rows(typed), ["coluna"], "tipo", position="posicao",
                                carry=["comentario"])
    assert [(r.coluna, r.status, r.comentario) for r in diff.collect()] == [
        ("a", "ALTERADA", "what a is"), ("b", "ADICIONADA", None)]


def inversions(rows, keys):
    """Neighbours in the wrong order, in Python."""
    def value(row):
        out = []
        for i, up, nulls_first in keys:
            x = row[i]
            lead = (x is not None) if nulls_first else (x is None)
            out.append((lead, 0 if x is None else x if up else -x))
        return out

    return sum(value(b) < value(a) for a, b in zip(rows, rows[1:], strict=False))


@pytest.mark.parametrize("partitions", [1, 4, 9])
def test_inversions_within_and_between_partitions(spark, partitions):
    dice = random.Random(partitions)
    rows = [(dice.choice([None, 1, 2, 3]), dice.choice([None, 1, 2])) for _ in range(200)]
    per = -(-len(rows) // partitions)
    df = spark.createDataFrame(spark.sparkContext.parallelize(
        [(i, *r) for i, r in enumerate(rows)], partitions), "i int, a int, b int")
    assert per * partitions >= len(rows)
    for up, first in ((True, None), (False, None), (True, False), (False, True)):
        keys = [order.SortKey("a", up, first), order.SortKey("b")]
        got = order.order_inversions(df, keys).first()
        lead = up if first is None else first
        assert tuple(got) == (200, inversions(rows, [(0, up, lead), (1, True, True)]))
        sort = F.col("a").asc_nulls_first() if up and lead else F.col("a").asc_nulls_last() if up else (
            F.col("a").desc_nulls_first() if lead else F.col("a").desc_nulls_last())
        assert tuple(order.order_inversions(df.orderBy(sort, "b"), keys).first()) == (200, 0)


def test_an_unordered_report_shows(spark):
    df = spark.range(1000, numPartitions=4).orderBy(F.desc("id"))
    assert order.order_inversions(df, ["id"]).first() == (1000, 999)
    assert order.order_inversions(df.filter("id < 0"), ["id"]).first() == (0, 0)


def test_longest_prefix_against_brute_force(spark):
    dice = random.Random(4)
    listed = {"": "any", "S": "south", "SB": "home", "SBX": "away", "SBXYZ": "far", "K": "k", "KA": None}
    prefixes = spark.createDataFrame([*listed.items(), ("SB", "zz later")], "prefixo string, valor string")
    codes = [None, "", "S", *["".join(dice.choices("SBXYKA", k=dice.randrange(1, 7))) for _ in range(300)]]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "i int, code string")

    def longest(code, table):
        hits = [p for p in table if code is not None and code.startswith(p)]
        return table[max(hits, key=len)] if hits else None

    out = joins.by_longest_prefix(df, "code", prefixes, "country")
    assert {r.i: r.country for r in out.collect()} == {i: longest(c, listed) for i, c in enumerate(codes)}
    del listed[""]
    some = joins.by_longest_prefix(df, "code", prefixes.filter("prefixo <> ''"), "country").collect()
    assert {r.i: r.country for r in some} == {i: longest(c, listed) for i, c in enumerate(codes)}
    none = joins.by_longest_prefix(df, "code", prefixes.filter("false"), "country").collect()
    assert len(none) == len(codes) and not any(r.country for r in none)


def test_countries_of_the_dimension(spark):
    flights = spark.createDataFrame([("SBGR", "KJFK"), ("SAEZ", None)], "icao_origem string, icao_destino string")
    airports = spark.createDataFrame([("SBGR", "GRU", "x", "y")], "icao string, nome string, municipio string, uf_nome string")
    countries = spark.createDataFrame([("S", "Exterior"), ("SB", "Brasil")], "prefixo string, valor string")
    dim = gold.build_dim(flights, airports, countries=countries)
    assert {r.icao_aeroporto: r.pais_aeroporto for r in dim.collect()} == {
        "SBGR": "Brasil", "SAEZ": "Exterior", "KJFK": None}


def test_axes_in_one_pass(spark):
    flights = spark.createDataFrame(
        [(h, r, bool(i % 3), not i % 3, i, i - 5, i < 4, None) for i, (h, r) in enumerate(
            [(1, "a"), (1, None), (None, "a"), (2, "b"), (1, "a")])],
        "h int, r string, voo_realizado boolean, voo_cancelado boolean, atraso_partida_min bigint, "
        "atraso_chegada_min bigint, partida_pontual boolean, chegada_pontual boolean")
    got = gold.kpis_by_axis(flights, ["h", "r"])
    assert executed(got).count("Exchange") == 1 and executed(got).count("Scan") <= 1
    rows = {tuple(r)[:2]: tuple(r)[2:] for r in got.collect()}
    wanted = {("total", None): tuple(gold.kpis(flights).first())}
    for axis in ("h", "r"):
        for r in gold.kpis(flights, axis).collect():
            wanted[axis, None if r[0] is None else str(r[0])] = tuple(r)[1:]
    assert rows == wanted


def test_first_rows_need_no_cluster(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (None, "n"), (2, "b")], "x int, y string")
    assert [r.y for r in profile.first_rows_of_table(df, ["x", "y"], 3).collect()] == ["n", "a", "b"]

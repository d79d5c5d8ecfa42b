"""Coverage reports on small hand-made tables."""

from datetime import date, datetime

from pyspark.sql import functions as F

from pontualis.operators import profile


def test_completeness_counts_blank_as_missing(spark):
    df = spark.createDataFrame(
        [("a", "x"), ("a", ""), ("a", None), ("b", "y")], "tabela string, comentario string")
    got = [tuple(r) for r in profile.completeness(df, ["tabela"], "comentario").collect()]
    assert got == [("a", 3, 2, 33.3), ("b", 1, 0, 100.0)]


def test_edges_are_recent_distinct_and_named(spark):
    df = spark.createDataFrame(
        [("s", "x.t", date(2026, 1, 8)), ("s", "x.t", date(2026, 1, 9)),
         ("", "x.u", date(2026, 1, 3)), (None, "x.u", date(2026, 1, 4)),
         ("s", "y.t", date(2026, 1, 9)), ("old", "x.t", date(2026, 1, 2))],
        "source string, target string, day date")
    got = profile.edges(df, "source", "target", "day", like="x.%", today=date(2026, 1, 10),
                        unnamed="(arquivo no volume)")
    assert [tuple(r) for r in got.collect()] == [("s", "x.t"), ("(arquivo no volume)", "x.u")]


def test_listing_is_ordered_and_of_one_label(spark):
    df = spark.createDataFrame([("b", "1", "2", "silver"), ("a", "3", None, "silver"),
                                ("c", "4", "5", "gold")],
                               "t string, grao string, fonte string, camada string")
    got = profile.attr_listing(df, "t", ["grao", "fonte"], "camada", "silver")
    assert [tuple(r) for r in got.collect()] == [
        ("a", "fonte", None), ("a", "grao", "3"), ("b", "fonte", "2"), ("b", "grao", "1")]


def test_first_rows_put_unscheduled_flights_first(spark):
    df = spark.createDataFrame([(1, datetime(2026, 1, 2)), (2, None), (3, datetime(2026, 1, 1))],
                               "id int, t timestamp_ntz")
    top = profile.first_rows(df, ["t", "id"], 2)
    assert [r.id for r in top.collect()] == [2, 3]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_known_codes_in_order(spark):
    df = spark.createDataFrame([("TAP", 1), ("GLO", 2), ("XXX", 3)], "icao string, n int")
    got = profile.find_codes(df, "icao", ["GLO", "TAP", "ZZZ"], ["icao", "n"])
    assert [tuple(r) for r in got.collect()] == [("GLO", 2), ("TAP", 1)]


def test_recovered_but_late_ignores_flights_that_lost_time(spark):
    df = spark.createDataFrame([(5, 0), (5, 10), (5, 16), (0, 30), (-5, 30), (None, None)],
                               "minutos_recuperados int, atraso_chegada_min int")
    assert tuple(profile.recovered_but_late(df).first()) == (3, 1, 2, 1)
    nothing = profile.recovered_but_late(df.filter("minutos_recuperados < 0")).first()
    assert tuple(nothing) == (0, None, None, None)


def test_filters_and_columns_reach_the_scan(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet")
    found = profile.find_codes(events, "event_type", ["error"], ["event_id", "event_type"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in plan
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan


def test_sums_over_no_rows_are_null(spark):
    empty = spark.range(0)
    assert empty.agg(profile.sum_if(F.col("id") > 0)).first()[0] is None

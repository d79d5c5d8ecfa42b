"""Gold semantics."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from pontualis import model
from pontualis.operators import profile
from pontualis.plans import gold
from pontualis.sources.scratch import materialize
from tests.plans import adapted, executed
from workload import flights as w
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def flights(spark, small):
    return w.flights(spark, small)


@pytest.fixture(scope="module")
def fact(spark, small, flights):
    return gold.build_fact(flights, w.carriers(spark, small), w.codes(spark))


def delays(spark, *rows):
    return spark.createDataFrame(
        list(rows), "atraso_partida_min int, atraso_chegada_min int, minutos_recuperados int")


@pytest.mark.parametrize("delay, punctual", [(15, True), (16, False), (-5, True), (None, None)])
def test_punctuality(spark, delay, punctual):
    row = gold.with_punctuality(delays(spark, (delay, delay, 0))).first()
    assert row.partida_pontual is punctual and row.chegada_pontual is punctual
    wider = gold.with_punctuality(delays(spark, (delay, delay, 0)), threshold=30).first()
    assert wider.partida_pontual is (None if delay is None else True)


@pytest.mark.parametrize("departure, arrival, outside", [
    (-121, 0, True), (-120, 0, False), (1440, 0, False), (1441, 0, True),
    (0, -121, True), (0, 1441, True), (None, 5, False), (None, 2000, True), (None, None, False)])
def test_one_implausible_delay_voids_all_three(spark, departure, arrival, outside):
    row = gold.null_out_of_range(delays(spark, (departure, arrival, 7))).first()
    assert row.atraso_fora_de_faixa is outside
    kept = (None, None, None) if outside else (departure, arrival, 7)
    assert (row.atraso_partida_min, row.atraso_chegada_min, row.minutos_recuperados) == kept


def test_figures_on_the_test_tables(flights):
    judged = gold.with_punctuality(gold.null_out_of_range(flights))
    got = judged.agg(
        F.count_if("atraso_fora_de_faixa"), F.count_if("partida_pontual"),
        F.count_if(~F.col("partida_pontual")), F.count_if(F.col("partida_pontual").isNull()),
        F.count_if("chegada_pontual"), F.count_if(~F.col("chegada_pontual"))).first()
    assert tuple(got) == (92, 2078, 5737, 2185, 2673, 5142)
    recovered = profile.recovered_but_late(flights).first()
    assert tuple(recovered) == (2986, 2358, 628, 347)
    assert gold.with_status_flags(flights).filter("voo_cancelado").count() == 1996


def test_tables_have_the_documented_columns(spark, small, flights, fact):
    dim = gold.build_dim(flights, w.airports(spark, small))
    obt = gold.build_obt(fact, dim)
    assert (len(fact.columns), len(dim.columns), len(obt.columns)) == (31, 7, 39)
    assert len(set(obt.columns)) == 39


def test_no_leg_is_lost_and_every_airport_is_covered(spark, small, flights, fact):
    dim = materialize(gold.build_dim(flights, w.airports(spark, small), w.HOME_PREFIXES), "dim")
    obt = gold.build_obt(fact, dim)
    assert fact.count() == flights.select(*model.FLIGHT_COLUMNS).distinct().count()
    assert obt.count() == fact.count()
    blank = " OR ".join(f"{c} IS NULL OR {c} = ''" for c in (
        "nome_companhia", "descricao_di", "descricao_tipo_linha", "nome_aeroporto_origem",
        "nome_aeroporto_destino", "rota_icao", "rota_municipios", "pais_origem"))
    assert obt.filter(blank).count() == 0
    assert dim.filter("NOT no_cadastro_anac AND nome_aeroporto NOT LIKE "
                      "'AEROPORTO FORA DO CADASTRO ANAC N%'").count() == 0
    assert dim.count() == 30 and dim.filter("no_cadastro_anac").count() == 25


def test_copies_collapse_before_the_shuffle(flights):
    plan = executed(gold.without_copies(flights))
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange") == 1
    twice = flights.unionByName(flights)
    assert gold.without_copies(twice).count() == gold.without_copies(flights).count()


def test_measures_need_no_join(flights):
    plan = executed(gold.kpis(gold.rated_legs(flights), "hora_partida_prevista"))
    assert "Join" not in plan and plan.count("Exchange") == 2


def test_published_dimension_is_broadcast_by_its_size(spark, small, flights, fact):
    dim = materialize(gold.build_dim(flights, w.airports(spark, small)), "dim")
    plan = adapted(gold.build_obt(fact, dim))
    assert plan.count("BroadcastHashJoin") == 5 and "SortMergeJoin" not in plan


def test_scope_country_and_labels(spark):
    df = spark.createDataFrame(
        [("N", "SBGR"), ("C", "SDXX"), ("I", "KJFK"), ("G", "SAEZ"), ("Z", None)],
        "codigo_tipo_linha string, code string")
    got = gold.with_scope(df).select("escopo_voo", gold.country(F.col("code"))).collect()
    assert [tuple(r) for r in got] == [
        ("Domestico", "Brasil"), ("Domestico", "Brasil"), ("Internacional", "Exterior"),
        ("Internacional", "Exterior"), (None, None)]


def test_fallback_texts(spark):
    carriers = spark.createDataFrame(
        [("GLO", "nacional", "GOL"), ("", "nacional", "AGRO"), (None, "nacional", "TAXI")],
        "icao string, origem_cadastro string, razao_social string")
    df = spark.createDataFrame([("GLO", "0", "N"), ("XXX", "1", "N"), (None, None, None)],
                               "icao_empresa string, codigo_di string, codigo_tipo_linha string")
    named = gold.with_carrier(gold.with_code_texts(df, w.codes(spark)), carriers)
    got = {r.icao_empresa: r for r in named.collect()}
    assert (got["GLO"].nome_companhia, got["GLO"].cadastro_companhia) == ("GOL", "nacional")
    assert got["XXX"].nome_companhia == "COMPANHIA NAO CADASTRADA XXX"
    assert got["XXX"].cadastro_companhia is None
    assert got["XXX"].descricao_di == "CODIGO NAO CATALOGADO 1"
    assert got["GLO"].descricao_tipo_linha == "Doméstica Mista"
    assert got[None].nome_companhia == "COMPANHIA NAO CADASTRADA"
    assert got[None].descricao_di == "CODIGO NAO CATALOGADO"


def test_calendar(spark):
    df = spark.createDataFrame([(datetime(2026, 1, 31, 23, 59),), (None,)],
                               "partida_prevista timestamp_ntz")
    rows = gold.with_calendar(df).collect()
    assert tuple(rows[0])[1:] == (23, "sabado", date(2026, 1, 1))
    assert tuple(rows[1])[1:] == (None, None, None)


def test_cancelled_flights_are_in_no_mean(spark):
    df = spark.createDataFrame(
        [(False, True, None, None, None, None), (True, False, 10, 20, True, False),
         (True, False, 30, 40, False, False)],
        "voo_realizado boolean, voo_cancelado boolean, atraso_partida_min int, "
        "atraso_chegada_min int, partida_pontual boolean, chegada_pontual boolean")
    row = gold.kpis(df).first()
    assert (row.voos, row.voos_cancelados, row.partidas_avaliadas) == (3, 1, 2)
    assert row.atraso_partida_medio == 20.0 and row.pontualidade_partida == 0.5
    assert row.taxa_cancelamento == pytest.approx(1 / 3)


def test_a_name_is_preferred_then_the_first_registry(spark):
    carriers = spark.createDataFrame(
        [("TAM", None, "estrangeira"), ("TAM", "TAM LINHAS", "nacional"), ("AAA", "Z foreign", "estrangeira"),
         ("AAA", "Y national", "nacional"), ("BBB", "", "nacional"), ("BBB", "B named", "estrangeira"),
         ("CCC", None, "nacional"), ("", "no code", "nacional")],
        "icao string, razao_social string, origem_cadastro string")
    legs = spark.createDataFrame([(c,) for c in ("TAM", "AAA", "BBB", "CCC", "DDD")], "icao_empresa string")
    got = {r.icao_empresa: (r.nome_companhia, r.cadastro_companhia)
           for r in gold.with_carrier(legs, carriers).collect()}
    assert got["TAM"] == ("TAM LINHAS", "nacional")
    assert got["AAA"] == ("Y national", "nacional") and got["BBB"] == ("B named", "estrangeira")
    assert got["CCC"] == ("COMPANHIA NAO CADASTRADA CCC", "nacional") and got["DDD"][1] is None
    foreign_first = gold.with_carrier(legs, carriers, ("estrangeira", "nacional"))
    assert {r.nome_companhia for r in foreign_first.collect()} >= {"Z foreign", "TAM LINHAS"}


def test_one_lookup_for_carrier_measures(spark, small):
    plan = QUERIES["gold_by_carrier"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 1


def test_the_condition_reaches_a_published_scan(spark, small, tmp_path):
    QUERIES["gold_fact"](spark, small).write.parquet(str(tmp_path / "fact"))
    counted = profile.recovered_but_late(spark.read.parquet(str(tmp_path / "fact")))
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(minutos_recuperados,0)" in plan

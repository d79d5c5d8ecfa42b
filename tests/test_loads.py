"""Publishing and the whole refresh."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from pontualis import model
from pontualis.operators import contract, profile
from pontualis.operators.reconcile import multiset_difference
from pontualis.plans.refresh import HeaderMismatch, Inputs, refresh
from pontualis.plans.reports import layer_reports
from pontualis.sources import loads
from pontualis.sources.scratch import fresh_path, materialize, shared_folder
from tests.plans import executed, rows_read, settings


def table(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x int")


def test_each_load_replaces_the_last(spark, tmp_path):
    path = str(tmp_path / "t")
    loads.publish(table(spark, 1, 2), path, "a", view="t")
    assert spark.table("t").count() == 2
    wider = table(spark, 1, 2, 3).withColumn("y", F.lit("new"))
    loads.publish(wider, path, "b", view="t")
    assert loads.current(spark, path).columns == ["x", "y"]
    assert spark.table("t").count() == 3
    assert loads.read_load(spark, path, "a").count() == 2
    assert [(r.load_id, r.linhas) for r in loads.loads(spark, path).orderBy("load_id").collect()
            ] == [("a", 2), ("b", 3)]


def test_a_failed_load_changes_nothing_and_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "t")
    loads.publish(table(spark, 1), path, "a")

    def refuse():
        raise RuntimeError("bad load")

    with pytest.raises(RuntimeError):
        loads.publish(table(spark, 1, 2), path, "b", verify=refuse)
    assert loads.current(spark, path).count() == 1
    with pytest.raises(loads.LoadNotFound):
        loads.read_load(spark, path, "b")
    loads.publish(table(spark, 1, 2, 3), path, "b")
    assert loads.current(spark, path).count() == 3


def test_a_committed_load_is_not_overwritten(spark, tmp_path):
    path = str(tmp_path / "t")
    loads.publish(table(spark, 1), path, "a")
    with pytest.raises(ValueError, match="already published"):
        loads.publish(table(spark, 2), path, "a")
    assert loads.current(spark, path).collect() == [(1,)]


def test_nothing_published(spark, tmp_path):
    with pytest.raises(loads.LoadNotFound):
        loads.current(spark, str(tmp_path / "none"))


def test_partitions_keep_null_and_column_order(spark, tmp_path):
    df = spark.sql("SELECT * FROM VALUES (DATE'2026-01-01', 1), (NULL, 2), "
                   "(DATE'2026-02-01', 3) t(m, x)")
    out = loads.publish(df, str(tmp_path / "t"), "a", partition_by=["m"], rebalance=True)
    assert out.dtypes == df.dtypes and multiset_difference(df, out, ["m", "x"]).count() == 0
    assert loads.current(spark, str(tmp_path / "t")).dtypes == df.dtypes
    january = loads.current(spark, str(tmp_path / "t")).filter("m = DATE'2026-01-01'")
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(m" in plan and january.count() == 1


def test_shared_folder(spark, monkeypatch):
    """The one the session names, or else its warehouse."""
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == named.rstrip("/")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    assert materialize(table(spark, 1, 2), "m").count() == 2
    monkeypatch.setattr("pontualis.sources.scratch._SETTING", "spark.not.set")
    if not spark.sparkContext.getCheckpointDir():
        assert shared_folder(spark).startswith(spark.conf.get("spark.sql.warehouse.dir"))


def test_rival_writers_of_one_load(spark, tmp_path):
    """One commits while the other writes: readers see the first whole, and a retry takes it."""
    path = str(tmp_path / "t")
    loads.publish(table(spark, 1), path, "a")
    with pytest.raises(loads.RivalLoad):
        loads.publish(table(spark, *range(100)).repartition(4), path, "b",
                      verify=lambda: loads.publish(table(spark, 5, 6).repartition(2), path, "b"))
    assert sorted(loads.read_load(spark, path, "b").collect()) == [(5,), (6,)]
    assert [(r.load_id, r.linhas) for r in loads.loads(spark, path).collect()] == [("a", 1), ("b", 2)]
    again = loads.published(spark, path, "b")
    assert sorted(again.collect()) == [(5,), (6,)] and loads.counts_of(spark, path, "b") == {"linhas": 2}


def test_rivals_that_do_not_see_each_other(spark, tmp_path, monkeypatch):
    """Both commit the same load at the same place; every reader takes the same attempt."""
    path = str(tmp_path / "t")
    loads.publish(table(spark, 1), path, "a")
    before = loads._commits(spark, path)
    commits, lost = loads._commits, 0
    for name, values in (("f" * 32, (7, 8)), ("0" * 32, (9,)), ("c" * 32, (3, 3, 3))):
        with monkeypatch.context() as blind:
            blind.setattr(loads, "_commits", lambda *a: before)
            blind.setattr(loads.uuid, "uuid4", lambda name=name: type("U", (), {"hex": name}))
            blind.setattr(loads, "_committed_as", lambda s, p, i: next(
                c for c in commits(s, p) if c.load_id == i))
            try:
                loads.publish(table(spark, *values), path, "b")
            except loads.RivalLoad:
                lost += 1
    assert lost == 1  # the last; the first was the winner while it alone had committed
    assert loads.read_load(spark, path, "b").collect() == [(9,)]
    assert loads.current(spark, path).collect() == [(9,)]
    assert loads.published(spark, path, "b").collect() == [(9,)]


def test_loads_of_two_names_at_the_same_time(spark, tmp_path):
    path = str(tmp_path / "t")
    loads.publish(table(spark, 1), path, "a", verify=lambda: loads.publish(table(spark, 2, 3), path, "b"))
    assert loads.read_load(spark, path, "a").count() == 1 and loads.read_load(spark, path, "b").count() == 2
    assert loads.current(spark, path).count() == 1


def test_counts_are_taken_while_writing(spark, tmp_path):
    """No second scan: the event of the write is the only one that reads the input."""
    path = str(tmp_path / "t")
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    df = spark.range(1000, numPartitions=4).mapInArrow(seen, "id long")
    loads.publish(df, path, "a", counts={
        "even": F.count_if(F.col("id") % 2 == 0), "none": F.count_if(F.col("id") < 0)})
    assert loads.counts_of(spark, path, "a") == {"linhas": 1000, "even": 500, "none": 0}
    assert reads.value == 1000
    loads.publish(df.filter("id < 0"), path, "empty")
    assert loads.counts_of(spark, path, "empty") == {"linhas": 0}
    shuffled = spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count()
    loads.publish(shuffled, path, "grouped", counts={"sum": F.sum("count")}, cluster_by=["k"])
    assert loads.counts_of(spark, path, "grouped") == {"linhas": 7, "sum": 1000}


def test_clustered_files_are_skipped(spark, tmp_path):
    df = spark.range(100_000).select((F.col("id") * 7919 % 100_000).alias("x"), F.col("id").cast("string").alias("y"))
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        clustered = loads.publish(df.repartition(8), str(tmp_path / "t"), "a", cluster_by=["x"])
    recent = clustered.filter("x >= 99000")
    assert "PushedFilters: [IsNotNull(x), GreaterThanOrEqual(x,99000)]" in executed(recent)
    assert rows_read(recent) < 20_000 and recent.count() == 1000
    first = profile.first_rows_of_table(clustered, ["x", "y"], 3)
    assert rows_read(first) < 20_000 and [r.x for r in first.collect()] == [0, 1, 2]
    few = profile.first_rows_of_table(clustered.filter("x < 2"), ["x"], 5)
    assert [r.x for r in few.collect()] == [0, 1]
    nulls = clustered.withColumn("x", F.when(F.col("x") > 10, F.col("x")))
    assert [r.x for r in profile.first_rows_of_table(nulls, ["x"], 5).collect()] == [None] * 5
    assert [r.x for r in profile.first_rows_of_table(nulls, ["x"], 12).collect()] == [None] * 11 + [11]


def test_the_history_does_not_follow_clocks(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    loads.publish(table(spark, 1), path, "a")

    class Slow(loads.datetime):
        @classmethod
        def now(cls, tz=None):
            return loads.datetime(2001, 1, 1, tzinfo=tz)

    monkeypatch.setattr(loads, "datetime", Slow)
    loads.publish(table(spark, 1, 2), path, "b")
    assert loads.current(spark, path).count() == 2


def test_a_resumed_refresh_refuses_other_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    inputs, root = write_inputs(tmp_path / "in"), str(tmp_path / "out")
    refresh(spark, inputs, root, "2026-08-01")
    with (tmp_path / "in/nacionais.csv").open("a") as file:
        file.write('"AZU";"AD";"AZUL";"REGULAR";"Barueri";"SP";"ATIVA"\n')
    with pytest.raises(loads.InputsChanged, match="nacionais"):
        refresh(spark, inputs, root, "2026-08-01")


def test_surplus_and_missing_fields_stay_in_bronze(spark, tmp_path):
    (tmp_path / "in").mkdir()
    inputs = write_inputs(tmp_path / "in")
    with (tmp_path / "in/vra/VRA_2026-02.csv").open("a") as file:
        file.write(";".join(f'"{f}"' for f in FLIGHTS[0]) + ';"SURPLUS"\n"GLO";"0999"\n')
    tables = refresh(spark, inputs, str(tmp_path / "out"), "2026-08-01")
    kept = [r._linha_malformada for r in tables["bronze.vra"].collect() if r._linha_malformada]
    assert len(kept) == 2 and any("SURPLUS" in line for line in kept)
    assert tables["bronze.vra"].count() == tables["silver.vra"].count() == 8
    assert {"0999"} <= {r.numero_voo for r in tables["silver.vra"].collect()}


def test_rules_and_joins_run_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    tables = refresh(spark, write_inputs(tmp_path / "in"), str(tmp_path / "out"), "2026-08-01")
    audited = tables["contract.vra_auditado"]
    assert audited.count() == 6 and spark.table("vra_marcado").count() == 6
    assert "regras_reprovadas" not in spark.table("vra_marcado").columns
    for derived in (contract.metrics_of(audited, contract.flight_rules()),
                    contract.quarantine_of(audited)):
        plan = derived._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "partida_prevista >" not in plan
    metrics = {r.regra: r.reprovados for r in tables["contract.vra_metricas"].collect()}
    assert metrics == {r.regra: r.reprovados for r in contract.rule_metrics(
        audited, contract.flight_rules()).collect()}


def test_an_absurd_instant_is_flagged_and_stops_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    inputs = write_inputs(tmp_path / "in")
    odd = ("GLO", "0666", "0", "N", "SBGR", "SBSP", "0001-01-01 00:00:00", "9999-12-31 23:59:59",
           "9999-12-31 23:59:59", "0001-01-01 00:00:00", "REALIZADO", "N/A")
    with (tmp_path / "in/vra/VRA_2026-02.csv").open("a") as file:
        file.write(";".join(f'"{f}"' for f in odd) + "\n")
    tables = refresh(spark, inputs, str(tmp_path / "out"), "2026-08-01")
    row = tables["silver.vra"].filter("numero_voo = '0666'").first()
    assert row.atraso_partida_min == -row.atraso_chegada_min > 5_000_000_000
    assert row.minutos_recuperados == 2 * row.atraso_partida_min
    why = tables["contract.vra_quarentena"].filter("numero_voo = '0666'").first()
    assert "atraso_partida_plausivel | atraso_chegada_plausivel" in why.motivos_quarentena
    assert tables["gold.obt_voos"].filter("numero_voo = '0666'").first().atraso_fora_de_faixa


FLIGHTS = [
    # carrier, number, di, line, origin, destination, four instants, status, reason
    ("GLO", "0100", "0", "N", "SBGR", "SBSP", "2026-01-27 10:00:00", "2026-01-27 10:20:00",
     "2026-01-27 11:00:00", "2026-01-27 11:05:00.500000000", "REALIZADO", "N/A"),
    ("GLO", "0101", "1", "N", "SBSP", "SBGR", "2026-02-27 10:00:00", "null",
     "2026-02-27 11:00:00", "null", "CANCELADO", "N/A"),
    ("XXX", "0007", "D", "I", "SBGR", "KJFK", "null", "2026-01-27 10:20:00", "null",
     "2026-01-27 20:05:00", "REALIZADO", "N/A"),
    ("TAP", "0008", "0", "I", "SBGR", "LPPT", "2026-01-01 10:00:00", "2026-01-05 10:00:00",
     "2026-01-01 20:00:00", "2026-01-05 20:00:00", "REALIZADO", "N/A"),
]


def write_inputs(folder, second_header=None):
    def put(name, headers, rows, charset="utf-8", quote='"', bom="\ufeff"):
        lines = [bom + "Atualizado em: 2026-08-01"]
        for row in [headers, *rows]:
            lines.append(";".join(quote + f.replace(quote or "\0", quote * 2) + quote
                                  for f in row))
        (folder / name).parent.mkdir(exist_ok=True)
        (folder / name).write_bytes(("\n".join(lines) + "\n").encode(charset))

    headers = list(model.FLIGHT_HEADERS)
    put("vra/VRA_2026-01.csv", headers, FLIGHTS + FLIGHTS[:1])
    put("vra/VRA_2026-02.csv", second_header or headers, FLIGHTS[1:2])
    put("AerodromosPublicos.csv", list(model.AIRPORT_HEADERS), [
        ("SBGR", "SP0002", "GUARULHOS", "Guarulhos", "São Paulo", "São Paulo", "São Paulo",
         "23°26'08\"S", "046°28'23\"W", "750,0", "ABERTO"),
        ("SBSP", "SP0001", "CONGONHAS", "São Paulo", "São Paulo", "São Paulo", "São Paulo",
         "23°37'34\"S", "046°39'23\"W", "802,0", "ABERTO"),
    ], "iso-8859-1", "", "")
    put("nacionais.csv", list(model.AIRLINE_HEADERS), [
        ("GLO", "G3", 'GOL "LINHAS" AÉREAS S.A.', "REGULAR", "Rio", "RJ", "ATIVA"),
        ("", "", "AEROCLUBE", "TAXI", "Bauru", "SP", "ATIVA")])
    put("estrangeiras.csv", list(model.AIRLINE_HEADERS), [
        ("TAP", "TP", "TAP TRANSPORTES", "REGULAR", "Rio", "RJ", "ATIVA")])
    return Inputs(f"{folder}/vra/*.csv", f"{folder}/AerodromosPublicos.csv",
                  f"{folder}/nacionais.csv", f"{folder}/estrangeiras.csv")


def check_reports(reports):
    rows = {name: df.collect() for name, df in reports.items()}
    assert [(r._arquivo_origem, r.linhas) for r in rows["rows_per_file"]] == [
        ("VRA_2026-01.csv", 5), ("VRA_2026-02.csv", 1)]
    assert {r.tabela: r.total_registros for r in rows["layer_counts"]} == {
        "aerodromos": 2, "codigos_operacao": 13, "empresas_estrangeiras": 1,
        "empresas_nacionais": 2, "vra": 6}
    assert [r.diferenca for r in rows["mirrors"]] == [0, 0, 0]
    assert rows["union_conservation"][0].diferenca == 0
    assert {r.origem_cadastro: r.com_icao for r in rows["registry_summary"]} == {
        "nacional": 1, "estrangeira": 1}
    # bronze's column of malformed lines is the one that silver lacks
    assert len(rows["schema_diff"]) == 27
    assert rows["schema_diff"][-1].coluna == "_linha_malformada"
    assert rows["typing_success"][0].partida_real_ok == 4
    assert rows["transform_profile"][0].total_linhas == 6
    # the repeated flight meets itself and its copy: 2 x 2 pairs, all others 1
    assert rows["reconcile_pairs"][0].total_linhas == 8
    pairs = rows["side_by_side"]
    assert [p.silver_partida_prevista for p in pairs] == [
        None, "2026-01-01 10:00:00", *["2026-01-27 10:00:00"] * 3]
    assert all(p.bronze_partida_prevista == (p.silver_partida_prevista or "null") for p in pairs)
    assert rows["recovered_but_late"][0].chegou_atrasado_mesmo_assim == 1
    assert {r.situacao_voo: r.partida_pontual_null for r in rows["punctual_null_by_status"]} == {
        "REALIZADO": 2, "CANCELADO": 1}


def test_refresh_from_files_to_gold(spark, tmp_path):
    (tmp_path / "in").mkdir()
    inputs = write_inputs(tmp_path / "in")
    root = str(tmp_path / "out")
    first = refresh(spark, inputs, root, "2026-08-01")
    counts = {name: df.count() for name, df in first.items()}
    assert counts["bronze.vra"] == counts["silver.vra"] == 6
    assert counts["silver.empresas"] == 3 and counts["bronze.codigos_operacao"] == 13
    assert counts["gold.fato_voos"] == counts["gold.obt_voos"] == 4
    assert counts["gold.dim_aeroporto"] == 4
    assert (len(first["bronze.vra"].columns), len(first["silver.vra"].columns)) == (15, 26)
    assert len(first["silver.empresas"].columns) == 11

    reasons = {r.numero_voo: r.motivos_quarentena
               for r in first["contract.vra_quarentena"].collect()}
    assert reasons["0007"] == ("horarios_previstos_presentes | empresa_no_cadastro_anac | "
                               "aeroporto_destino_no_cadastro_anac")
    assert "0100" not in reasons and "atraso_partida_plausivel" in reasons["0008"]

    obt = {r.numero_voo: r for r in spark.table("gold_obt_voos").collect()}
    assert obt["0100"].nome_companhia == 'GOL "LINHAS" AÉREAS S.A.'
    assert obt["0100"].rota_municipios == "Guarulhos - São Paulo"
    assert (obt["0100"].atraso_partida_min, obt["0100"].atraso_chegada_min) == (20, 5)
    assert obt["0100"].partida_pontual is False and obt["0100"].chegada_pontual is True
    assert obt["0101"].partida_pontual is None and obt["0101"].voo_cancelado is True
    assert obt["0101"].descricao_di == "CODIGO NAO CATALOGADO 1"
    assert obt["0007"].pais_destino == "Exterior" and obt["0007"].mes_referencia is None
    assert obt["0008"].atraso_fora_de_faixa and obt["0008"].atraso_partida_min is None

    check_reports(layer_reports(first))

    again = refresh(spark, inputs, root, "2026-09-01")
    for name in ("bronze.vra", "silver.vra", "gold.obt_voos"):
        columns = [c for c in again[name].columns if not c.endswith("_em")]
        assert multiset_difference(first[name], again[name], columns).count() == 0
    both = loads.compare_loads(spark, f"{root}/bronze_vra", ["2026-08-01", "2026-09-01"])
    rows = both.orderBy("versao").collect()
    assert rows[0].linhas == rows[1].linhas == 6 and rows[0].ingerido_em < rows[1].ingerido_em


def test_files_with_columns_in_other_orders_load(spark, tmp_path):
    (tmp_path / "in").mkdir()
    inputs = write_inputs(tmp_path / "in")
    order = list(reversed(range(12)))
    lines = ["Atualizado em: x", *[";".join(f'"{row[i]}"' for i in order)
                                   for row in (list(model.FLIGHT_HEADERS), *FLIGHTS[1:2])]]
    (tmp_path / "in/vra/VRA_2026-02.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    tables = refresh(spark, inputs, str(tmp_path / "out"), "2026-08-01")
    first = refresh(spark, write_inputs(tmp_path / "in"), str(tmp_path / "plain"), "2026-08-01")
    columns = [c for c in tables["gold.obt_voos"].columns if not c.endswith("_em")]
    assert multiset_difference(tables["gold.obt_voos"], first["gold.obt_voos"], columns).count() == 0
    assert tables["bronze.vra"].count() == 6


def test_a_file_that_lacks_a_column_loads_if_it_may(spark, tmp_path):
    (tmp_path / "in").mkdir()
    inputs = write_inputs(tmp_path / "in", second_header=["Empresa", *list(model.FLIGHT_HEADERS)[1:]])
    tables = refresh(spark, replace(inputs, missing="null"), str(tmp_path / "out"), "2026-08-01")
    assert tables["silver.vra"].filter("icao_empresa IS NULL").count() == 1
    assert tables["silver.vra"].count() == 6


def test_the_indicators_are_published(spark, tmp_path):
    (tmp_path / "in").mkdir()
    tables = refresh(spark, write_inputs(tmp_path / "in"), str(tmp_path / "out"), "2026-08-01")
    rows = {(r.eixo, r.valor): r.voos for r in tables["gold.indicadores"].collect()}
    assert rows["total", None] == 4 == sum(n for (axis, _), n in rows.items() if axis == "rota")
    assert rows["mes_referencia", None] == 1 and rows["escopo_voo", "Internacional"] == 2


def test_a_file_with_another_header_stops_the_load(spark, tmp_path):
    (tmp_path / "in").mkdir()
    other = ["Empresa", *list(model.FLIGHT_HEADERS)[1:]]
    inputs = write_inputs(tmp_path / "in", second_header=other)
    with pytest.raises(HeaderMismatch, match="1 of 2"):
        refresh(spark, inputs, str(tmp_path / "out"), "2026-08-01")
    with pytest.raises(loads.LoadNotFound):
        loads.current(spark, str(tmp_path / "out/bronze_vra"))


def test_a_repeated_refresh_resumes(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    inputs, root = write_inputs(tmp_path / "in"), str(tmp_path / "out")

    def die(*args, **kwargs):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr("pontualis.plans.gold.build_dim", die)
        with pytest.raises(RuntimeError):
            refresh(spark, inputs, root, "2026-08-01")
    ingested = loads.current(spark, f"{root}/bronze_vra").first()._ingerido_em
    tables = refresh(spark, inputs, root, "2026-08-01")
    assert tables["bronze.vra"].first()._ingerido_em == ingested
    assert tables["gold.obt_voos"].count() == 4 == spark.table("gold_obt_voos").count()
    assert len(tables["gold.obt_voos"].columns) == 39
    assert loads.loads(spark, f"{root}/bronze_vra").count() == 1

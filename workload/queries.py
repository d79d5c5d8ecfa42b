"""Spark side of the registered queries: ``name -> f(spark, folder)``.

Audit instants differ between runs and are dropped from the results.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pontualis import model
from pontualis.operators import contract, joins, order, profile, reconcile, rows
from pontualis.plans import gold, silver
from pontualis.plans.bronze import MALFORMED, Source, bronze_table, bronze_tables
from pontualis.plans.refresh import Inputs, refresh
from pontualis.plans.reports import layer_reports
from pontualis.sources import compare, loads
from pontualis.sources.delimited import AIRLINES, AIRPORTS, FLIGHTS, Layout
from pontualis.sources.scratch import fresh_path, materialize
from workload import flights as w
from workload.files import write_published

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AUDIT = (model.INGESTED_AT, model.TRANSFORMED_AT, model.QUARANTINED_AT, model.PROCESSED_AT)


def query(f: Query) -> Query:
    QUERIES[f.__name__] = lambda spark, folder: f(spark, folder).drop(*AUDIT)
    return f


# -- sources and sinks ---------------------------------------------------------------


@query
def scan_delimited(spark, folder):
    layout = Layout({"Id": "event_id", **FLIGHTS.columns})
    path = fresh_path(spark, "flight_files")
    write_published(w.raw_flights(spark, folder), path, layout)
    return bronze_table(spark, Source(path, layout, provenance=False))


@query
def scan_unquoted(spark, folder):
    path = fresh_path(spark, "airport_files")
    write_published(w.airport_register(spark, folder), path, AIRPORTS)
    bronze = bronze_table(spark, Source(path, AIRPORTS, provenance=False))
    return silver.silver_airports(bronze.drop(MALFORMED))


@query
def bronze_registries(spark, folder):
    sources = {}
    for name, df in (("nacionais", w.national_carriers(spark, folder)),
                     ("estrangeiras", w.foreign_carriers(spark, folder))):
        path = fresh_path(spark, name)
        write_published(df, path, AIRLINES)
        sources[name] = Source(path, AIRLINES, label=f"{name}.csv")
    return rows.union_all(bronze_tables(spark, sources).values()).drop(MALFORMED)


@query
def mixed_headers(spark, folder):
    """Files with their columns in three orders, one kind without banner and one that lacks a column."""
    columns = {"Id": "event_id", **FLIGHTS.columns}
    names = list(columns)
    layouts = [
        Layout(columns),
        Layout({n: columns[n] for n in reversed(names)}),
        Layout({n: columns[n] for n in [*names[5:], *names[:5]]}).without_banner(),
        Layout({n: columns[n] for n in names if columns[n] != "codigo_tipo_linha"}),
    ]
    path, raw = fresh_path(spark, "mixed_files"), w.raw_flights(spark, folder)
    for i, layout in enumerate(layouts):
        write_published(raw.filter(F.col("event_id") % len(layouts) == i), f"{path}/{i}", layout)
    return bronze_table(spark, Source(f"{path}/*", layouts[0], provenance=False, missing="null"))


@query
def seed_codes(spark, folder):
    """The seed, with the number of flights that use each code."""
    domains = ("codigo_di", "codigo_tipo_linha")
    pairs = [F.struct(F.lit(d).alias("dominio"), F.col(d).alias("codigo")) for d in domains]
    used = w.raw_flights(spark, folder).select(F.inline(F.array(*pairs)))
    counts = used.groupBy("dominio", "codigo").agg(F.count(F.lit(1)).alias("voos"))
    return w.codes(spark).join(counts, ["dominio", "codigo"], "left")


@query
def rows_per_file(spark, folder):
    """Rows of each month's files, by the names the reader found.

    All months are written at once; a file's own name is not the same in two runs, its folder's is.
    """
    path = fresh_path(spark, "monthly_files")
    write_published(w.raw_flights(spark, folder), path, FLIGHTS, folder=F.col("event_id") % 12)
    counts = profile.rows_per_file(bronze_table(spark, Source(path, FLIGHTS, folders=1)))
    name = F.regexp_extract(model.SOURCE_FILE, r"^pasta=(\d+)/part-.*[.]csv$", 1)
    return (counts.groupBy(F.concat(F.lit("month_"), name, F.lit(".csv")).alias("arquivo"))
            .agg(F.sum("linhas").alias("linhas"),
                 F.bool_and(F.col("ingerido_em").isNotNull()).alias("identificado")))


@query
def malformed_rows(spark, folder):
    """Lines with a field too many: their fields are read, and the whole line is kept."""
    layout = Layout({"Id": "event_id", **FLIGHTS.columns})
    path = fresh_path(spark, "surplus_files")
    surplus = F.when(F.col("event_id") % 50 == 0, ';"SOBRA"').otherwise("")
    write_published(w.raw_flights(spark, folder), path, layout, surplus)
    read = bronze_table(spark, Source(path, layout, provenance=False, malformed="linha"))
    return read.select("event_id", "numero_voo", "situacao_voo",
                       F.substring_index("linha", ";", -1).alias("sobra"))


def _two_loads(spark: SparkSession, folder: str) -> str:
    path = fresh_path(spark, "bronze_vra")
    for load_id in ("carga_1", "carga_2"):
        bronze = rows.stamp(w.raw_flights(spark, folder), model.INGESTED_AT)
        loads.publish(bronze, path, load_id)
    return path


@query
def idempotent_load(spark, folder):
    """Rows of two loads of the same files, and rows that only one of them has."""
    path = _two_loads(spark, folder)
    first, now = loads.read_load(spark, path, "carga_1"), loads.current(spark, path)
    columns = [c for c in now.columns if c != model.INGESTED_AT]
    surplus = reconcile.multiset_difference(first, now, columns)
    differing = surplus.agg(F.count(F.lit(1)).alias("linhas_diferentes"))
    sizes = reconcile.count_conservation({"carga_1": first}, {"carga_2": now})
    return sizes.drop("diferenca").join(differing)


@query
def load_compare(spark, folder):
    path = _two_loads(spark, folder)
    both = loads.compare_loads(spark, path, ["carga_1", "carga_2"])
    first = both.filter("versao = 'carga_1'").select(F.col("ingerido_em").alias("primeira"))
    return both.join(first).select("versao", "linhas", (F.col("ingerido_em") > F.col("primeira"))
                                   .alias("posterior_a_primeira"))


def _clustered(spark: SparkSession, folder: str) -> DataFrame:
    """Silver flights as the refresh publishes them."""
    return loads.publish(w.flights(spark, folder), fresh_path(spark, "silver_vra"), "carga_1",
                         cluster_by=silver.CLUSTERED_BY)


@query
def load_changes(spark, folder):
    """Flights that a second load has added, removed or changed, read from the buckets that differ."""
    path, raw = fresh_path(spark, "vra_em_baldes"), w.raw_flights(spark, folder)
    loads_ = {"carga_1": raw, "carga_2": w.changed_flights(raw)}
    for load_id, df in loads_.items():
        compare.publish_in_buckets(rows.stamp(df, model.INGESTED_AT), path, load_id, ["event_id"],
                                   buckets=64)
    changed = compare.changed_rows(spark, path, "carga_1", "carga_2", carry=["numero_voo"],
                                   compare=["partida_real", "situacao_voo", "codigo_justificativa"])
    return changed.withColumn("alteracoes", reconcile.changes_text())


# -- projections and filters ---------------------------------------------------------


@query
def project_map(spark, folder):
    names = {"event_id": "id_evento", "user_id": "numero_voo", "event_type": "situacao_voo",
             "props": "observacao"}
    return rows.project_map(w.table(spark, folder, "events"), names)


@query
def silver_typed(spark, folder):
    return w.flights(spark, folder)


@query
def silver_delays(spark, folder):
    return w.flights(spark, folder).select("event_id", *model.DELAYS)


@query
def filter_in(spark, folder):
    return profile.find_codes(w.national_carriers(spark, folder), "servico",
                              ["BUILDING", "MACHINERY"], ["razao_social", "icao", "servico"])


@query
def top_k(spark, folder):
    first = profile.first_rows(w.flights(spark, folder), ["partida_prevista", "event_id"])
    return first.select("event_id", *model.PREVIEW_COLUMNS)


@query
def clustered_top_k(spark, folder):
    """The first flights of a table whose files are ranges of the scheduled departure."""
    first = profile.first_rows_of_table(_clustered(spark, folder), ["partida_prevista", "event_id"], 50)
    return first.select("event_id", "numero_voo", "partida_prevista", "situacao_voo")


@query
def sample_rows(spark, folder):
    """How many rows a preview shows, and how many of them the table has."""
    raw = w.raw_flights(spark, folder)
    shown = profile.sample_rows(raw).select("event_id")
    found = shown.join(raw.select(F.col("event_id").alias("known")),
                       F.col("event_id") == F.col("known"), "left")
    return found.agg(F.countDistinct("event_id").alias("mostradas"),
                     F.count("known").alias("existentes"))


@query
def absurd_delays(spark, folder):
    """Instants thousands of years apart are flagged, and neither lost nor fatal."""
    delay_rules = [r for r in contract.flight_rules() if r.name.startswith("atraso_")]
    marked = contract.audited(w.absurd_flights(spark, folder), delay_rules)
    # Both the delays as typed and the judgement that voids them.
    judged = gold.null_out_of_range(marked.withColumns({f"lido_{d}": F.col(d) for d in model.DELAYS}))
    return judged.select("event_id", *[f"lido_{d}" for d in model.DELAYS], *model.DELAYS,
                         "atraso_fora_de_faixa", F.array_join(contract.BROKEN, contract.SEPARATOR)
                         .alias("regras"))


@query
def registry_union(spark, folder):
    return w.carriers(spark, folder)


# -- contract ------------------------------------------------------------------------


def _marked(spark: SparkSession, folder: str) -> DataFrame:
    return contract.flag_references(
        w.flights(spark, folder), w.airports(spark, folder), w.carriers(spark, folder)
    )


@query
def clean_keys(spark, folder):
    return joins.clean_keys(w.carriers(spark, folder), "icao")


@query
def ref_flags(spark, folder):
    return _marked(spark, folder).select(
        "event_id", "origem_no_cadastro", "destino_no_cadastro", "empresa_no_cadastro"
    )


@query
def rule_metrics(spark, folder):
    return contract.rule_metrics(_marked(spark, folder), contract.flight_rules())


@query
def written_counts(spark, folder):
    """The rules' counts as taken while the audited table was written."""
    path, rules = fresh_path(spark, "vra_auditado"), contract.flight_rules()
    loads.publish(contract.audited(_marked(spark, folder), rules), path, "carga_1",
                  counts=contract.rule_counts(rules))
    return contract.metrics_from(spark, loads.counts_of(spark, path, "carga_1"), rules)


@query
def audited_rows(spark, folder):
    audited, _ = contract.audit(_marked(spark, folder), contract.flight_rules())
    return audited.select("event_id", "situacao_voo", "atraso_partida_min",
                          F.size("regras_reprovadas").alias("reprovadas"))


@query
def quarantine(spark, folder):
    return contract.quarantine(_marked(spark, folder), contract.flight_rules())


@query
def quarantine_reasons(spark, folder):
    """Failing rows per combination of reasons."""
    failing = contract.quarantine(_marked(spark, folder), contract.flight_rules())
    return failing.groupBy(contract.REASONS).agg(F.count(F.lit(1)).alias("voos"))


# -- validation and profiling --------------------------------------------------------


@query
def count_conservation(spark, folder):
    return reconcile.count_conservation(
        {"bronze_vra": w.raw_flights(spark, folder)}, {"silver_vra": w.flights(spark, folder)}
    )


@query
def union_conservation(spark, folder):
    return reconcile.count_conservation(
        {"bronze_nacionais": w.national_carriers(spark, folder),
         "bronze_estrangeiras": w.foreign_carriers(spark, folder)},
        {"silver_empresas": w.carriers(spark, folder)},
    )


@query
def layer_counts(spark, folder):
    tables = (w.airports(spark, folder), w.national_carriers(spark, folder),
              w.foreign_carriers(spark, folder), w.codes(spark), w.raw_flights(spark, folder))
    return profile.layer_counts(dict(zip(model.BRONZE_TABLES, tables, strict=True)))


@query
def registry_summary(spark, folder):
    return profile.registry_summary(w.carriers(spark, folder), "origem_cadastro", "icao")


@query
def sentinel_profile(spark, folder):
    return profile.sentinel_profile(w.raw_flights(spark, folder))


@query
def typing_success(spark, folder):
    return profile.typing_success(
        w.flights(spark, folder),
        [*model.INSTANTS, "atraso_partida_min", "minutos_recuperados"],
    )


@query
def transform_profile(spark, folder):
    return reconcile.transform_profile(w.raw_flights(spark, folder), w.flights(spark, folder))


@query
def reconcile_pairs(spark, folder):
    """As text: pair counts of a hot key pass BIGINT, and engines differ on wide decimals."""
    pairs = reconcile.reconcile_pairs(w.raw_flights(spark, folder), w.flights(spark, folder))
    return pairs.select(*[F.col(c).cast("string").alias(c) for c in pairs.columns])


@query
def side_by_side(spark, folder):
    return reconcile.side_by_side(
        w.raw_flights(spark, folder), w.flights(spark, folder), tie="event_id"
    )


@query
def keyed_diff(spark, folder):
    """Services (number, destination): flights scheduled against flights departed."""
    flights = w.flights(spark, folder)

    def services(instant: str) -> DataFrame:
        known = flights.filter(F.col(instant).isNotNull())
        return known.groupBy("numero_voo", "icao_destino").agg(F.count(F.lit(1)).alias("voos"))

    return reconcile.keyed_diff(
        services("partida_prevista"), services("partida_real"),
        ["numero_voo", "icao_destino"], "voos", names=("programados", "realizados"),
    )


@query
def service_changes(spark, folder):
    """Services (number, destination) scheduled and departed, by three measures at once."""
    flights = w.flights(spark, folder)

    def services(instant: str) -> DataFrame:
        known = flights.filter(F.col(instant).isNotNull())
        return known.groupBy("numero_voo", "icao_destino").agg(
            F.count(F.lit(1)).alias("voos"), F.min(f"{instant}_hora").alias("primeira_hora"),
            F.max("situacao_voo").alias("situacao"), F.max("icao_empresa").alias("icao_empresa"))

    diff = reconcile.diff_rows(
        services("partida_prevista"), services("partida_real"), ["numero_voo", "icao_destino"],
        ["voos", "primeira_hora", "situacao"], carry=["icao_empresa"], position="voos")
    return diff.withColumn("alteracoes", reconcile.changes_text())


def _ordered_reports(spark: SparkSession, folder: str) -> dict[str, tuple[DataFrame, list]]:
    """Each ordered report with the order it promises."""
    schemas = [reconcile.schema_as_rows(df)
               for df in (w.raw_flights(spark, folder), w.flights(spark, folder))]
    return {
        "rows_per_file": (profile.rows_per_file(
            rows.stamp(w.raw_flights(spark, folder), model.INGESTED_AT)), [model.SOURCE_FILE]),
        "layer_counts": (QUERIES["layer_counts"](spark, folder), ["tabela"]),
        "registry_summary": (QUERIES["registry_summary"](spark, folder), ["origem_cadastro"]),
        "filter_in": (QUERIES["filter_in"](spark, folder), ["razao_social", "icao", "servico"]),
        "completeness": (QUERIES["completeness"](spark, folder), ["lang"]),
        "attr_listing": (QUERIES["attr_listing"](spark, folder), ["entidade", "atributo"]),
        "edges": (QUERIES["edges"](spark, folder), ["destino", "origem"]),
        "top_k": (QUERIES["top_k"](spark, folder), ["partida_prevista", "event_id"]),
        "schema_diff": (reconcile.keyed_diff(*schemas, ["coluna"], "tipo", position="posicao",
                                             carry=["posicao"]),
                        [order.SortKey("posicao", nulls_first=False), "coluna"]),
        "flights": (profile.first_rows(w.flights(spark, folder), ["partida_prevista", "event_id"],
                                       1 << 30), ["partida_prevista", "event_id"]),
    }


@query
def report_order(spark, folder):
    """Rows of each ordered report, and how many stand before one that they should follow."""
    return rows.union_all(
        order.order_inversions(df, keys).select(F.lit(name).alias("relatorio"), "linhas", "inversoes")
        for name, (df, keys) in _ordered_reports(spark, folder).items())


@query
def completeness(spark, folder):
    """Share of documents with a quality label, per language."""
    documents = w.table(spark, folder, "documents").select("doc_id", "lang")
    labels = w.table(spark, folder, "labels").select("doc_id", "quality")
    return profile.completeness(documents.join(labels, "doc_id", "left"), ["lang"], "quality")


@query
def clustered_edges(spark, folder):
    """:func:`edges` over the published table, of which it reads recent row groups."""
    return profile.edges(
        _clustered(spark, folder), "icao_empresa", "icao_origem", "partida_prevista",
        like="N1%", today=date(2024, 1, 30), unnamed="(sem empresa)",
    )


@query
def attr_listing(spark, folder):
    return profile.attr_listing(w.carriers(spark, folder), "icao", ["razao_social", "uf"],
                                "origem_cadastro", model.FOREIGN)


@query
def edges(spark, folder):
    return profile.edges(
        w.flights(spark, folder), "icao_empresa", "icao_origem", "partida_prevista_data",
        like="N1%", today=date(2024, 1, 30), unnamed="(sem empresa)",
    )


# -- gold ----------------------------------------------------------------------------


def _fact(spark: SparkSession, folder: str) -> DataFrame:
    return gold.build_fact(w.flights(spark, folder), w.carriers(spark, folder), w.codes(spark))


def _legs(spark: SparkSession, folder: str) -> DataFrame:
    """What the measures need of the fact: no lookup is made for them."""
    return gold.rated_legs(w.flights(spark, folder))


def _dim(spark: SparkSession, folder: str) -> DataFrame:
    return gold.build_dim(w.flights(spark, folder), w.airports(spark, folder), w.HOME_PREFIXES)


@query
def gold_dedup(spark, folder):
    """The same files delivered twice give the same flights once."""
    flights = w.flights(spark, folder)
    return gold.without_copies(flights.unionByName(flights))


@query
def gold_out_of_range(spark, folder):
    return gold.null_out_of_range(w.flights(spark, folder)).select(
        "event_id", "atraso_fora_de_faixa", *model.DELAYS
    )


@query
def gold_punctual(spark, folder):
    judged = gold.with_punctuality(gold.null_out_of_range(w.flights(spark, folder)))
    return judged.select("event_id", "partida_pontual", "chegada_pontual")


@query
def gold_calendar(spark, folder):
    return gold.with_calendar(w.flights(spark, folder)).select(
        "event_id", "hora_partida_prevista", "dia_semana", "mes_referencia"
    )


@query
def gold_country(spark, folder):
    return w.flights(spark, folder).select(
        "event_id",
        gold.country(F.col("icao_origem"), w.HOME_PREFIXES).alias("pais_origem"),
        gold.country(F.col("icao_destino"), w.HOME_PREFIXES).alias("pais_destino"),
    )


@query
def country_prefixes(spark, folder):
    """Countries by the longest of nested prefixes; some codes have none."""
    flights, prefixes = w.flights(spark, folder), w.country_prefixes(spark)
    for role in ("origem", "destino"):
        flights = joins.by_longest_prefix(flights, f"icao_{role}", prefixes, f"pais_{role}")
    return flights.select("event_id", "icao_origem", "pais_origem", "icao_destino", "pais_destino")


@query
def code_lookup(spark, folder):
    flights = w.flights(spark, folder)
    for domain, out in (("codigo_di", "descricao_di"),
                        ("codigo_tipo_linha", "descricao_tipo_linha")):
        flights = joins.describe_code(flights, domain, w.codes(spark), domain, out)
    return flights.select("event_id", "codigo_di", "descricao_di", "codigo_tipo_linha",
                          "descricao_tipo_linha")


@query
def gold_fallback(spark, folder):
    described = gold.with_code_texts(w.flights(spark, folder), w.codes(spark))
    return gold.with_carrier(described, w.carriers(spark, folder)).select(
        "event_id", "nome_companhia", "cadastro_companhia", "descricao_di",
        "descricao_tipo_linha",
    )


@query
def repeated_codes(spark, folder):
    """Names from a registry that lists codes more than once, some without a name."""
    named = gold.with_carrier(w.flights(spark, folder), w.untidy_carriers(spark, folder))
    return named.select("event_id", "icao_empresa", "nome_companhia", "cadastro_companhia")


def _refreshed(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All tables, made from files by the refresh."""
    files = {
        "vra": (w.raw_flights(spark, folder), FLIGHTS),
        "aerodromos": (w.airport_file(spark, folder), AIRPORTS),
        "nacionais": (w.national_carriers(spark, folder), AIRLINES),
        "estrangeiras": (w.foreign_carriers(spark, folder), AIRLINES),
    }
    paths = {name: fresh_path(spark, name) for name in files}
    for name, (df, layout) in files.items():
        write_published(df, paths[name], layout)
    return refresh(spark, Inputs(*paths.values()), fresh_path(spark, "lake"), "carga_1")


@query
def refresh_obt(spark, folder):
    """The product: the wide table as published from files."""
    return _refreshed(spark, folder)["gold.obt_voos"]


@query
def refresh_quarantine(spark, folder):
    return _refreshed(spark, folder)["contract.vra_quarentena"].drop(model.SOURCE_FILE)


@query
def refresh_reports(spark, folder):
    """Mirrored layers and the rules' counts, from the published tables."""
    tables = _refreshed(spark, folder)
    mirrors = layer_reports(tables)["mirrors"].select(
        F.col("tabela").alias("nome"), F.col("bronze").alias("a"), F.col("silver").alias("b"))
    metrics = tables["contract.vra_metricas"].select(
        F.col("regra").alias("nome"), F.col("aprovados").alias("a"), F.col("reprovados").alias("b"))
    return mirrors.unionByName(metrics)


@query
def gold_fact(spark, folder):
    return _fact(spark, folder)


@query
def gold_dim(spark, folder):
    return _dim(spark, folder)


@query
def gold_obt(spark, folder):
    dim = materialize(_dim(spark, folder), "dim_aeroporto")
    return gold.build_obt(_fact(spark, folder), dim)


@query
def gold_kpis(spark, folder):
    return gold.kpis(_legs(spark, folder))


@query
def gold_by_hour(spark, folder):
    return gold.kpis(_legs(spark, folder), "hora_partida_prevista")


@query
def gold_by_day(spark, folder):
    return gold.kpis(_legs(spark, folder), "partida_prevista_data")


@query
def gold_by_month(spark, folder):
    return gold.kpis(_legs(spark, folder), "mes_referencia")


@query
def gold_by_route(spark, folder):
    return gold.kpis(_legs(spark, folder), "rota")


@query
def gold_by_scope(spark, folder):
    return gold.kpis(_legs(spark, folder), "escopo_voo")


@query
def gold_by_carrier(spark, folder):
    named = gold.with_carrier(_legs(spark, folder), w.carriers(spark, folder))
    return gold.kpis(named, "nome_companhia")


@query
def gold_kpis_by_axis(spark, folder):
    """All axes and the overall figures from one pass over the legs."""
    return gold.kpis_by_axis(gold.with_carrier(_legs(spark, folder), w.carriers(spark, folder)))


@query
def recovered_but_late(spark, folder):
    return profile.recovered_but_late(_legs(spark, folder))


@query
def punctual_null_by_status(spark, folder):
    return profile.punctual_null_by_status(_legs(spark, folder))

"""The whole refresh: files -> bronze -> silver -> contract -> gold, each layer published.

Every step reads the layer below from its published files, so an executor or driver lost
on the way costs the step at hand, and the planner knows the size of each lookup table.
Tables that do not need each other are written at the same time.  Repeating a refresh that
died, with the same load id, resumes after its last table.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pontualis.operators import contract
from pontualis.plans import gold, silver
from pontualis.plans.bronze import MALFORMED, Source, bronze_table
from pontualis.sources.delimited import AIRLINES, AIRPORTS, FLIGHTS, HeaderMismatch, headers_of
from pontualis.sources.loads import counts_of, publish, published
from pontualis.sources.seeds import operation_codes

__all__ = ["HeaderMismatch", "Inputs", "refresh"]


@dataclass(frozen=True)
class Inputs:
    """Where the files are; with ``missing="null"`` single files may lack columns."""

    flights: str
    airports: str
    national_carriers: str
    foreign_carriers: str
    missing: str = "raise"

    def sources(self) -> dict[str, Source]:
        def named(path: str) -> Source:
            return Source(path, AIRLINES, label=path.rsplit("/", 1)[-1], missing=self.missing)

        return {
            "vra": Source(self.flights, FLIGHTS, missing=self.missing),
            "aerodromos": Source(self.airports, AIRPORTS, provenance=False, missing=self.missing),
            "empresas_nacionais": named(self.national_carriers),
            "empresas_estrangeiras": named(self.foreign_carriers),
        }


def publish_bronze(spark: SparkSession, source: Source, path: str, load_id: str,
                   view: str) -> DataFrame:
    """Publish one source, unless it is published.

    The write is a single map stage, so each task's count of header lines enters exactly once; a
    file whose header has changed since the headers were read stops the load.  The commit
    holds a digest of the files' names, sizes and times; a committed load is taken as it is if
    they are still the same.
    """
    origin = file_listing(spark, source.path)
    table = published(spark, path, load_id, view=view, origin=origin)
    if table is not None:
        return table
    groups = headers_of(spark, source.path, source.layout)
    seen = Observation()
    rows = bronze_table(spark, source, headers_seen=seen, groups=groups)
    expected = sum(g.files for g in groups if g.header and g.skipped)

    def one_header_per_file() -> None:
        if seen.get["headers"] != expected:
            raise HeaderMismatch(f"{source.path}: {seen.get['headers']} of {expected} headers match")

    return publish(rows, path, load_id, view=view, verify=one_header_per_file, origin=origin)


def file_listing(spark: SparkSession, path: str) -> str:
    """A digest of the names, sizes and times of the files a source reads, whatever their order."""
    line = F.concat_ws("|", "path", "length", F.col("modificationTime").cast("string"))
    files = spark.read.format("binaryFile").load(path).select(line.alias("line"))
    summed = [F.sum(F.xxhash64(F.lit(seed), "line").cast("decimal(38,0)")) for seed in (1, 2)]
    return "-".join(map(str, files.agg(F.count(F.lit(1)), *summed).first()))


def refresh(spark: SparkSession, inputs: Inputs, root: str, load_id: str) -> dict[str, DataFrame]:
    """Rebuild all tables under ``root``; returns them by ``<layer>.<table>``.

    Each table is also a temporary view named ``<layer>_<table>``.
    """
    tables: dict[str, DataFrame] = {}

    def place(name: str) -> tuple[str, str]:
        view = name.replace(".", "_")
        return f"{root}/{view}", view

    def put(name: str, make: Callable[[], DataFrame], **options) -> Callable[[], None]:
        """A step that publishes a table, unless it is published."""
        def step() -> None:
            path, view = place(name)
            table = published(spark, path, load_id, view=view)
            tables[name] = publish(make(), path, load_id, view=view, **options) if table is None else table

        return step

    def put_bronze(name: str, source: Source) -> Callable[[], None]:
        def step() -> None:
            path, view = place(f"bronze.{name}")
            tables[f"bronze.{name}"] = publish_bronze(spark, source, path, load_id, view)

        return step

    def together(*steps: Callable[[], None]) -> None:
        """Run steps that do not need each other, as jobs at the same time."""
        with ThreadPoolExecutor(len(steps)) as pool:
            for done in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]:
                done.result()

    def kept(name: str) -> DataFrame:
        """Bronze as silver mirrors it: malformed lines stay below."""
        return tables[f"bronze.{name}"].drop(MALFORMED)

    together(*[put_bronze(name, source) for name, source in inputs.sources().items()],
             put("bronze.codigos_operacao", lambda: operation_codes(spark)))
    together(
        put("silver.vra", lambda: silver.silver_flights(kept("vra")), cluster_by=silver.CLUSTERED_BY),
        put("silver.empresas", lambda: silver.silver_carriers(
            kept("empresas_nacionais"), kept("empresas_estrangeiras"))),
        put("silver.aerodromos", lambda: silver.silver_airports(kept("aerodromos"))),
        put("silver.codigos_operacao", lambda: silver.silver_codes(tables["bronze.codigos_operacao"])))
    flights, airports = tables["silver.vra"], tables["silver.aerodromos"]

    rules = contract.flight_rules()
    together(
        put("contract.vra_auditado", lambda: contract.audited(
            contract.flag_references(flights, airports, tables["silver.empresas"]), rules),
            counts=contract.rule_counts(rules)),
        put("gold.dim_aeroporto", lambda: gold.build_dim(flights, airports)),
        put("gold.fato_voos", lambda: gold.build_fact(
            flights, tables["silver.empresas"], tables["silver.codigos_operacao"]),
            partition_by=["mes_referencia"], rebalance=True))
    audited = tables["contract.vra_auditado"]
    # Flags without verdicts: a view alone, not a table.
    audited.drop(contract.BROKEN).createOrReplaceTempView("vra_marcado")
    # Counted while the audited table was written.
    counted = counts_of(spark, place("contract.vra_auditado")[0], load_id)
    together(
        put("contract.vra_metricas", lambda: contract.metrics_from(spark, counted, rules)),
        put("contract.vra_quarentena", lambda: contract.quarantine_of(audited)),
        put("gold.obt_voos", lambda: gold.build_obt(tables["gold.fato_voos"], tables["gold.dim_aeroporto"]),
            partition_by=["mes_referencia"]),
        put("gold.indicadores", lambda: gold.kpis_by_axis(tables["gold.fato_voos"])))
    return tables

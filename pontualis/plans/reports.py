"""The validation reports on a refreshed set of tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pontualis.model import DELAYS, INGESTED_AT, INSTANTS, PAIR_KEYS
from pontualis.operators import profile, reconcile
from pontualis.operators.rows import union_all


def _mirrors(tables: Mapping[str, DataFrame], *names: str) -> DataFrame:
    """Bronze and silver row counts of tables that must mirror each other."""
    def mirror(name: str) -> DataFrame:
        counts = reconcile.count_conservation(
            {"bronze": tables[f"bronze.{name}"]}, {"silver": tables[f"silver.{name}"]})
        return counts.select(F.lit(name).alias("tabela"), "bronze", "silver", "diferenca")

    return union_all(mirror(name) for name in names)


def layer_reports(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All reports, unevaluated, over tables named as ``refresh`` returns them."""
    raw, typed = tables["bronze.vra"], tables["silver.vra"]
    obt = tables["gold.obt_voos"]
    keys = (*PAIR_KEYS, INGESTED_AT)
    bronze = {n.removeprefix("bronze."): df for n, df in tables.items() if n.startswith("bronze.")}
    return {
        "rows_per_file": profile.rows_per_file(raw),
        "layer_counts": profile.layer_counts(bronze),
        "sentinel_profile": profile.sentinel_profile(raw),
        "typing_success": profile.typing_success(typed, [*INSTANTS, *DELAYS]),
        "mirrors": _mirrors(tables, "vra", "aerodromos", "codigos_operacao"),
        "union_conservation": reconcile.count_conservation(
            {"bronze_nacionais": tables["bronze.empresas_nacionais"],
             "bronze_estrangeiras": tables["bronze.empresas_estrangeiras"]},
            {"silver_empresas": tables["silver.empresas"]}),
        "registry_summary": profile.registry_summary(
            tables["silver.empresas"], "origem_cadastro", "icao"),
        "schema_diff": reconcile.keyed_diff(
            reconcile.schema_as_rows(raw), reconcile.schema_as_rows(typed), ["coluna"], "tipo",
            names=("tipo_bronze", "tipo_silver"), changed="TIPO_ALTERADO", position="posicao",
            carry=["comentario"]),
        "first_flights": profile.first_rows_of_table(typed, ["partida_prevista", *PAIR_KEYS]),
        "transform_profile": reconcile.transform_profile(raw, typed),
        "reconcile_pairs": reconcile.reconcile_pairs(raw, typed, keys),
        "side_by_side": reconcile.side_by_side(raw, typed, keys),
        "recovered_but_late": profile.recovered_but_late(obt),
        "punctual_null_by_status": profile.punctual_null_by_status(obt),
    }

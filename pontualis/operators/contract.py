"""Warn-only data contract: one list of rules drives metrics, reasons and quarantine.

A rule that evaluates to NULL has failed.  ``NOT (a AND b ...)`` would be NULL for such a
row and lose it, so every use goes through :func:`broken`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pontualis.model import CANCELLED, FLOWN, QUARANTINED_AT
from pontualis.operators.joins import flag_membership
from pontualis.operators.rows import stamp

REASONS = "motivos_quarentena"
BROKEN = "regras_reprovadas"
SEPARATOR = " | "


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: Column


def _after(later: str, earlier: str) -> Column:
    """``later`` is strictly after ``earlier``, or one of them is unknown."""
    a, b = F.col(earlier), F.col(later)
    return a.isNull() | b.isNull() | (b > a)


def _plausible(delay: str, low: int, high: int) -> Column:
    return F.col(delay).isNull() | F.col(delay).between(low, high)


def flight_rules(low: int = -120, high: int = 1440) -> list[Rule]:
    """The flight contract, in contract order.  Rule names are fixed values."""
    both_scheduled = F.col("partida_prevista").isNotNull() & F.col("chegada_prevista").isNotNull()
    return [
        Rule("horarios_previstos_presentes", both_scheduled),
        Rule("situacao_voo_conhecida", F.col("situacao_voo").isin(FLOWN, CANCELLED)),
        Rule("chegada_prevista_depois_da_partida_prevista",
             _after("chegada_prevista", "partida_prevista")),
        Rule("chegada_real_depois_da_partida_real", _after("chegada_real", "partida_real")),
        Rule("atraso_partida_plausivel", _plausible("atraso_partida_min", low, high)),
        Rule("atraso_chegada_plausivel", _plausible("atraso_chegada_min", low, high)),
        Rule("empresa_no_cadastro_anac", F.col("empresa_no_cadastro")),
        Rule("aeroporto_origem_no_cadastro_anac", F.col("origem_no_cadastro")),
        Rule("aeroporto_destino_no_cadastro_anac", F.col("destino_no_cadastro")),
    ]


def flag_references(flights: DataFrame, airports: DataFrame, carriers: DataFrame) -> DataFrame:
    """Flights with the three registry flags; the airport registry plays two roles."""
    flights = flag_membership(flights, "icao_origem", airports, "icao", "origem_no_cadastro")
    flights = flag_membership(flights, "icao_destino", airports, "icao", "destino_no_cadastro")
    return flag_membership(flights, "icao_empresa", carriers, "icao", "empresa_no_cadastro")


def broken(rule: Rule) -> Column:
    return ~F.coalesce(rule.predicate, F.lit(False))


def broken_rules(rules: Sequence[Rule]) -> Column:
    """Names of the rules a row breaks, in contract order; an empty array if none."""
    return F.array_compact(F.array(*[F.when(broken(r), F.lit(r.name)) for r in rules]))


def rule_metrics(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with its passed and failed counts, in a single pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("linhas"),
        *[F.count_if(broken(r)).alias(r.name) for r in rules],
    )
    return _long(counts, rules)


def _long(counts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    long = counts.unpivot("linhas", [r.name for r in rules], "regra", "reprovados")
    return long.select(
        "regra", (F.col("linhas") - F.col("reprovados")).alias("aprovados"), "reprovados"
    )


def with_rule_metrics(df: DataFrame, rules: Sequence[Rule], seen: Observation) -> DataFrame:
    """The same rows; ``seen`` receives the counts of whatever action runs them.

    A stage that runs again after an executor loss may be counted again when a shuffle
    follows it.  Use this for live figures and :func:`rule_metrics` for published ones.
    """
    return df.observe(
        seen,
        F.count(F.lit(1)).alias("linhas"),
        *[F.count_if(broken(r)).alias(r.name) for r in rules],
    )


def audited(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All rows with the rules they break, evaluated once.  No row is dropped.

    Publish this table; metrics and quarantine are then scans of it.
    """
    return df.withColumn(BROKEN, broken_rules(rules))


def metrics_of(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """:func:`rule_metrics` from an audited table, of which only one column is read."""
    broken_name = {r.name: F.array_contains(BROKEN, r.name) for r in rules}
    counts = rows.agg(F.count(F.lit(1)).alias("linhas"),
                      *[F.count_if(c).alias(name) for name, c in broken_name.items()])
    return _long(counts, rules)


def rule_counts(rules: Sequence[Rule]) -> dict[str, Column]:
    """The rows of an audited table that break each rule, to be counted while it is published."""
    return {r.name: F.count_if(F.array_contains(BROKEN, r.name)) for r in rules}


def metrics_from(spark: SparkSession, counts: Mapping[str, int], rules: Sequence[Rule]) -> DataFrame:
    """:func:`rule_metrics` from the counts of a published table; nothing is scanned."""
    rows = [(r.name, counts["linhas"] - counts[r.name], counts[r.name]) for r in rules]
    return spark.createDataFrame(rows, "regra string, aprovados bigint, reprovados bigint")


def quarantine_of(rows: DataFrame) -> DataFrame:
    """:func:`quarantine` from an audited table."""
    failing = rows.filter(F.size(BROKEN) > 0)
    reasons = F.array_join(BROKEN, SEPARATOR)
    return stamp(failing.withColumn(REASONS, reasons).drop(BROKEN), QUARANTINED_AT)


def audit(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """All rows with the rules they break, and the metrics.  No row is dropped."""
    return audited(df, rules), rule_metrics(df, rules)


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Diagnostic copy of the rows that break a rule, with every reason."""
    failing = df.withColumn(REASONS, broken_rules(rules)).filter(F.size(REASONS) > 0)
    return stamp(failing.withColumn(REASONS, F.array_join(REASONS, SEPARATOR)), QUARANTINED_AT)

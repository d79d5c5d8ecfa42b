"""Profiling and coverage reports.  Each is one pass with map-side partial aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pontualis.functions.text import is_filled, without_marker
from pontualis.model import INGESTED_AT, NO_INSTANT, SOURCE_FILE
from pontualis.operators.rows import union_all


def sum_if(condition: Column) -> Column:
    """Rows meeting ``condition``; NULL over no rows, as SUM is."""
    return F.sum(F.when(condition, 1).otherwise(0))


def sentinel_profile(bronze: DataFrame) -> DataFrame:
    """How the raw text writes absence and fractions of a second."""
    return bronze.agg(
        F.count(F.lit(1)).alias("linhas"),
        sum_if(F.col("partida_real").isNull()).alias("partida_real_null_de_verdade"),
        sum_if(F.col("partida_real") == NO_INSTANT).alias("partida_real_string_null"),
        sum_if(F.col("partida_prevista") == NO_INSTANT).alias("partida_prevista_string_null"),
        sum_if(F.col("partida_prevista").like("%.%")).alias("com_fracao_de_segundo"),
        sum_if(F.col("partida_real").like("%.%")).alias("partida_real_com_fracao"),
    )


def typing_success(typed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Non-NULL values per column, as ``<column>_ok`` without its unit."""
    return typed.agg(*[F.count(c).alias(f"{c.removesuffix('_min')}_ok") for c in columns])


def completeness(df: DataFrame, group: Sequence[str], column: str) -> DataFrame:
    """Rows, rows without ``column`` and the filled share in percent, per group."""
    filled = sum_if(is_filled(F.col(column).cast("string")))
    total = F.count(F.lit(1))
    return df.groupBy(*group).agg(
        total.alias("linhas"),
        (total - filled).alias("sem_valor"),
        F.round(F.lit(100.0) * filled / total, 1).alias("pct_preenchido"),
    ).orderBy(*group)


def rows_per_file(bronze: DataFrame) -> DataFrame:
    """Rows and last ingestion per source file."""
    return bronze.groupBy(SOURCE_FILE).agg(
        F.count(F.lit(1)).alias("linhas"), F.max(INGESTED_AT).alias("ingerido_em")
    ).orderBy(SOURCE_FILE)


def layer_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every table, labelled."""
    return union_all(
        df.agg(F.count(F.lit(1)).alias("total_registros"))
          .select(F.lit(label).alias("tabela"), "total_registros")
        for label, df in tables.items()
    ).orderBy("tabela")


def registry_summary(registry: DataFrame, tag: str, key: str) -> DataFrame:
    """Rows and rows with a code, per source registry."""
    return registry.groupBy(tag).agg(
        F.count(F.lit(1)).alias("linhas"),
        F.count(F.when(is_filled(F.col(key)), 1)).alias("com_icao"),
    ).orderBy(tag)


def find_codes(registry: DataFrame, key: str, codes: Sequence[str],
               columns: Sequence[str]) -> DataFrame:
    """Rows whose ``key`` is one of ``codes``, in key order."""
    return registry.filter(F.col(key).isin(*codes)).select(*columns).orderBy(*columns)


def first_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows; NULLs come first, so unscheduled flights show up."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(n)


def first_rows_of_table(table: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """:func:`first_rows` of a published table clustered by the first column of ``order``.

    That column alone is read to find the last value that can be among the first ``n``; it then
    becomes a filter, by which the scan of all columns skips row groups.
    """
    lead = F.col(order[0])
    last, found = (table.select(lead.alias("lead")).orderBy(F.col("lead").asc_nulls_first()).limit(n)
                   .agg(F.max("lead"), F.count(F.lit(1))).first())
    if found < n:
        needed = table
    elif last is None:
        needed = table.filter(lead.isNull())
    else:
        needed = table.filter(lead.isNull() | (lead <= F.lit(last)))
    return first_rows(needed, order, n)


def sample_rows(df: DataFrame, n: int = 10) -> DataFrame:
    """Any ``n`` rows, for a look at a table."""
    return df.limit(n)


def edges(events: DataFrame, source: str, target: str, day: str, *, like: str, today: date,
          days: int = 7, unnamed: str) -> DataFrame:
    """Distinct source -> target pairs of the last ``days``; blank sources become ``unnamed``.

    ``today`` is an argument so that a report can be repeated.
    """
    since = F.lit(today - timedelta(days=days))
    recent = events.filter(F.col(target).like(like) & (F.col(day) >= since))
    origin = F.coalesce(without_marker(F.col(source), ""), F.lit(unnamed))
    return recent.select(
        origin.alias("origem"), F.col(target).alias("destino")
    ).distinct().orderBy("destino", "origem")


def attr_listing(df: DataFrame, entity: str, attributes: Sequence[str], label: str,
                 value: str) -> DataFrame:
    """(entity, attribute, value) rows of one label, in order."""
    chosen = df.filter(F.col(label) == value).select(
        F.col(entity).cast("string").alias("entidade"),
        *[F.col(a).cast("string").alias(a) for a in attributes],
    )
    return chosen.unpivot("entidade", list(attributes), "atributo", "valor").orderBy(
        "entidade", "atributo"
    )


def recovered_but_late(flights: DataFrame, threshold: int = 15) -> DataFrame:
    """Flights that won time in the air, by how they arrived all the same.

    Meant for a published table, whose scan takes the filter.
    """
    delay = F.col("atraso_chegada_min")
    return flights.filter(F.col("minutos_recuperados") > 0).agg(
        F.count(F.lit(1)).alias("recuperou_algum_minuto"),
        sum_if(delay <= 0).alias("chegou_adiantado_ou_no_horario"),
        sum_if(delay > 0).alias("chegou_atrasado_mesmo_assim"),
        sum_if(delay > threshold).alias(f"chegou_atrasado_mais_de_{threshold}"),
    )


def punctual_null_by_status(flights: DataFrame) -> DataFrame:
    """Per status: flights, and flights whose punctuality cannot be judged."""
    return flights.groupBy("situacao_voo").agg(
        F.count(F.lit(1)).alias("voos"),
        sum_if(F.col("partida_pontual").isNull()).alias("partida_pontual_null"),
    )

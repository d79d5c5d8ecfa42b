"""Gold: the fact, the airport dimension, the wide table and its measures.

Thresholds, ranges and prefixes are business decisions, hence parameters.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pontualis import model
from pontualis.functions import clock, text
from pontualis.operators.joins import by_longest_prefix, describe_code, one_row_per_key
from pontualis.operators.rows import stamp
from pontualis.plans.silver import delay_metrics, split_instants


def without_copies(flights: DataFrame,
                   columns: Sequence[str] = model.FLIGHT_COLUMNS) -> DataFrame:
    """Exact copies removed, on the source columns only.

    Everything else silver holds follows from these columns, so only they are shuffled;
    copies collapse in the map-side step, before the shuffle.
    """
    return flights.select(*columns).distinct()


def null_out_of_range(df: DataFrame, low: int = -120, high: int = 1440) -> DataFrame:
    """Flag implausible delays.  One bad delay voids all three metrics; the row stays."""
    def outside(delay: str) -> Column:
        return F.coalesce(~F.col(delay).between(low, high), F.lit(False))

    flag = outside("atraso_partida_min") | outside("atraso_chegada_min")
    flagged = df.withColumn("atraso_fora_de_faixa", flag)
    return flagged.withColumns(
        {d: F.when(~F.col("atraso_fora_de_faixa"), F.col(d)) for d in model.DELAYS}
    )


def with_punctuality(df: DataFrame, threshold: int = 15) -> DataFrame:
    """TRUE up to ``threshold`` minutes late, FALSE beyond, NULL if it cannot be judged."""
    return df.withColumns({
        "partida_pontual": F.col("atraso_partida_min") <= threshold,
        "chegada_pontual": F.col("atraso_chegada_min") <= threshold,
    })


def with_calendar(df: DataFrame) -> DataFrame:
    """Hour of day, weekday and month of the scheduled departure; NULL without one."""
    scheduled = F.col("partida_prevista")
    day = scheduled.cast("date")
    return df.withColumns({
        "hora_partida_prevista": F.hour(scheduled),
        "dia_semana": clock.weekday_name(day, model.WEEKDAYS),
        "mes_referencia": clock.first_of_month(day),
    })


def with_scope(df: DataFrame) -> DataFrame:
    line = F.col("codigo_tipo_linha")
    return df.withColumn(
        "escopo_voo",
        F.when(line.isin(*model.DOMESTIC_LINES), model.DOMESTIC)
        .when(line.isin(*model.INTERNATIONAL_LINES), model.INTERNATIONAL),
    )


def with_status_flags(df: DataFrame) -> DataFrame:
    """Flown and cancelled; a flight of unknown status is neither."""
    return df.withColumns({
        "voo_realizado": F.col("situacao_voo").eqNullSafe(F.lit(model.FLOWN)),
        "voo_cancelado": F.col("situacao_voo").eqNullSafe(F.lit(model.CANCELLED)),
    })


def with_code_texts(df: DataFrame, codes: DataFrame) -> DataFrame:
    """Descriptions of both operation codes; an unlisted code says so."""
    for domain, out in (("codigo_di", "descricao_di"),
                        ("codigo_tipo_linha", "descricao_tipo_linha")):
        df = describe_code(df, domain, codes, domain, out)
        df = df.withColumn(out, text.name_or_code(F.col(out), model.UNKNOWN_CODE, F.col(domain)))
    return df


def with_carrier(df: DataFrame, carriers: DataFrame,
                 registries: Sequence[str] = (model.NATIONAL, model.FOREIGN)) -> DataFrame:
    """Company name, and the registry it came from (NULL if unregistered).

    Of several entries of a code, one with a name is taken, from the first of ``registries``
    that has one.
    """
    place = F.array_position(F.array(*[F.lit(r) for r in registries]), F.col("cadastro_companhia"))
    registered = one_row_per_key(
        carriers.select(
            F.col("icao").alias("icao_empresa"),
            F.col("origem_cadastro").alias("cadastro_companhia"),
            F.col("razao_social").alias("nome_companhia"),
        ),
        "icao_empresa", wanted="nome_companhia",
        # Registries that are not listed have position 0 and come last.
        precedence=[F.when(place > 0, place).otherwise(len(registries) + 1)],
    )
    named = df.join(registered, "icao_empresa", "left")
    return named.withColumn(
        "nome_companhia",
        text.name_or_code(F.col("nome_companhia"), model.UNKNOWN_CARRIER, F.col("icao_empresa")),
    )


def country(code: Column, prefixes: Sequence[str] = model.BRAZIL_PREFIXES) -> Column:
    """Brazil or abroad, from the prefix of the airport code; NULL without a code."""
    at_home = reduce(or_, [code.startswith(prefix) for prefix in prefixes])
    return F.when(at_home, model.BRAZIL).when(~at_home, model.ABROAD)


def rated_legs(silver: DataFrame, *, threshold: int = 15, low: int = -120,
               high: int = 1440) -> DataFrame:
    """One row per leg: silver less exact copies, with every rule that needs no lookup."""
    legs = delay_metrics(split_instants(without_copies(silver), ["partida_prevista"]))
    legs = with_punctuality(null_out_of_range(legs, low, high), threshold)
    legs = with_status_flags(with_scope(with_calendar(legs)))
    return legs.withColumn("rota", F.concat_ws(" - ", "icao_origem", "icao_destino"))


def build_fact(silver: DataFrame, carriers: DataFrame, codes: DataFrame, **rules) -> DataFrame:
    """The fact: :func:`rated_legs` (whose ``rules`` it takes), carriers and codes named."""
    named = with_carrier(with_code_texts(rated_legs(silver, **rules), codes), carriers)
    return stamp(named, model.PROCESSED_AT).select(*model.FACT_COLUMNS)


def build_dim(flights: DataFrame, airports: DataFrame,
              prefixes: Sequence[str] = model.BRAZIL_PREFIXES,
              countries: DataFrame | None = None) -> DataFrame:
    """Every airport code the flights use, registered or not, with its attributes.

    Both roles come out of one scan; the distinct collapses them map-side.  ``countries``
    (``prefixo, valor``) names the country of each code's longest listed prefix; without it, a
    code is at home if it has one of ``prefixes``, and abroad if not.
    """
    roles = F.array("icao_origem", "icao_destino")
    seen = flights.select(F.explode(roles).alias("icao_aeroporto"))
    seen = seen.filter(text.is_filled(F.col("icao_aeroporto"))).distinct()
    registered = one_row_per_key(
        airports.select(
            F.col("icao").alias("icao_aeroporto"),
            F.col("nome").alias("nome_aeroporto"),
            F.col("municipio").alias("municipio_aeroporto"),
            F.col("uf_nome").alias("uf_aeroporto"),
            F.lit(True).alias("registered"),
        ),
        "icao_aeroporto",
    )
    code = F.col("icao_aeroporto")
    dim = seen.join(registered, "icao_aeroporto", "left")
    if countries is None:
        dim = dim.withColumn("pais_aeroporto", country(code, prefixes))
    else:
        dim = by_longest_prefix(dim, "icao_aeroporto", countries, "pais_aeroporto")
    dim = dim.withColumns({
        "nome_aeroporto": text.name_or_code(F.col("nome_aeroporto"), model.UNKNOWN_AIRPORT, code),
        "no_cadastro_anac": F.col("registered").isNotNull(),
    })
    return stamp(dim, model.PROCESSED_AT).select(*model.DIM_COLUMNS)


def build_obt(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """The wide table: the fact with both airports resolved.  No leg is lost.

    Pass a published ``dim``: read back from its files its size is known, so Spark can
    decide to broadcast it.  Left as a plan over the flights it would be estimated at the
    flights' size and cost two shuffles of the fact.
    """
    wide = fact
    for role in ("origem", "destino"):
        code = f"icao_{role}"
        wide = wide.join(
            dim.select(
                F.col("icao_aeroporto").alias(code),
                F.col("nome_aeroporto").alias(f"nome_aeroporto_{role}"),
                F.col("municipio_aeroporto").alias(f"municipio_{role}"),
                F.col("uf_aeroporto").alias(f"uf_{role}"),
                F.col("pais_aeroporto").alias(f"pais_{role}"),
            ),
            code, "left",
        ).withColumn(
            f"nome_aeroporto_{role}",
            text.name_or_code(F.col(f"nome_aeroporto_{role}"), model.UNKNOWN_AIRPORT, F.col(code)),
        )
    towns = [F.coalesce(F.col(f"municipio_{r}"), F.col(f"icao_{r}")) for r in ("origem", "destino")]
    wide = wide.withColumnRenamed("rota", "rota_icao").withColumn(
        "rota_municipios", F.concat_ws(" - ", *towns)
    )
    return stamp(wide, model.PROCESSED_AT).select(*model.OBT_COLUMNS)


def _share(flag: str) -> Column:
    return F.avg(F.col(flag).cast("int"))


#: Measures by name.  Cancelled flights have no delay and no punctuality, so NULLs keep them out
#: of both.
MEASURES = {
    "voos": lambda: F.count(F.lit(1)),
    "voos_realizados": lambda: F.count_if("voo_realizado"),
    "voos_cancelados": lambda: F.count_if("voo_cancelado"),
    "taxa_cancelamento": lambda: _share("voo_cancelado"),
    "atraso_partida_medio": lambda: F.avg("atraso_partida_min"),
    "atraso_chegada_medio": lambda: F.avg("atraso_chegada_min"),
    "partidas_avaliadas": lambda: F.count("partida_pontual"),
    "pontualidade_partida": lambda: _share("partida_pontual"),
    "pontualidade_chegada": lambda: _share("chegada_pontual"),
}

#: The axes that the measures are reported by.
AXES = ("hora_partida_prevista", "partida_prevista_data", "mes_referencia", "rota", "escopo_voo",
        "nome_companhia")
OVERALL = "total"


def kpis(flights: DataFrame, *axes: str) -> DataFrame:
    """Cancellation, delay and punctuality measures, overall or per axis."""
    return flights.groupBy(*axes).agg(*[make().alias(name) for name, make in MEASURES.items()])


def kpis_by_axis(flights: DataFrame, axes: Sequence[str] = AXES) -> DataFrame:
    """The measures overall and by each of ``axes``: ``eixo``, ``valor`` (as text) and measures.

    One scan and one shuffle, of partial sums: grouping sets replicate a row for each axis only
    inside the task that reads it, and are combined there first.
    """
    sets = [[], *[[axis] for axis in axes]]
    # Bit i from the left is set where axis i is not grouped by.
    every = (1 << len(axes)) - 1
    grouped = flights.groupingSets([[F.col(a) for a in s] for s in sets], *axes).agg(
        F.grouping_id().alias("conjunto"), *[make().alias(name) for name, make in MEASURES.items()])
    name, value = F.lit(OVERALL), F.lit(None).cast("string")
    for i, axis in enumerate(axes):
        here = F.col("conjunto") == every - (1 << (len(axes) - 1 - i))
        name = F.when(here, axis).otherwise(name)
        value = F.when(here, F.col(axis).cast("string")).otherwise(value)
    return grouped.select(name.alias("eixo"), value.alias("valor"), *MEASURES)

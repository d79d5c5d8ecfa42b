"""Silver: typed mirrors of bronze.  Narrow projections only: no filter, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pontualis.functions import clock, text
from pontualis.model import (
    FOREIGN,
    INGESTED_AT,
    INSTANTS,
    NATIONAL,
    NO_INSTANT,
    NO_REASON,
    SOURCE_FILE,
    TRANSFORMED_AT,
)
from pontualis.operators.rows import stamp, unify


#: Flights are published in ranges of the scheduled departure; the other columns divide an
#: instant, or its absence, that many flights share.
CLUSTERED_BY = ("partida_prevista", "icao_empresa", "numero_voo", "icao_origem", "icao_destino")


def typed_instants(bronze: DataFrame) -> DataFrame:
    """Text instants become TIMESTAMP_NTZ; absence markers become NULL."""
    reason = text.without_marker(F.col("codigo_justificativa"), NO_REASON)
    return bronze.withColumns({
        **{c: clock.parse_instant(text.without_marker(F.col(c), NO_INSTANT)) for c in INSTANTS},
        "codigo_justificativa": reason,
    })


def split_instants(df: DataFrame, instants=INSTANTS) -> DataFrame:
    """Add ``<instant>_data`` (DATE) and ``<instant>_hora`` (``HH:mm``)."""
    parts = {}
    for name in instants:
        parts[f"{name}_data"] = F.col(name).cast("date")
        parts[f"{name}_hora"] = clock.clock_text(F.col(name))
    return df.withColumns(parts)


def delay_metrics(df: DataFrame) -> DataFrame:
    """Departure delay, arrival delay and minutes recovered; pure row arithmetic."""
    departure = clock.minutes_between(F.col("partida_prevista"), F.col("partida_real"))
    arrival = clock.minutes_between(F.col("chegada_prevista"), F.col("chegada_real"))
    return df.withColumns({
        "atraso_partida_min": departure,
        "atraso_chegada_min": arrival,
        "minutos_recuperados": departure - arrival,
    })


def silver_flights(bronze: DataFrame) -> DataFrame:
    """Same rows as bronze, 26 columns when bronze has its 14."""
    typed = delay_metrics(split_instants(typed_instants(bronze)))
    instants = [c for name in INSTANTS for c in (name, f"{name}_data", f"{name}_hora")]
    leading = ["icao_empresa", "numero_voo", "codigo_di", "codigo_tipo_linha",
               "icao_origem", "icao_destino"]
    measures = ["situacao_voo", "codigo_justificativa",
                "atraso_partida_min", "atraso_chegada_min", "minutos_recuperados"]
    audit = [c for c in (SOURCE_FILE, INGESTED_AT) if c in bronze.columns]
    extra = [c for c in bronze.columns if c not in {*leading, *INSTANTS, *measures, *audit}]
    return stamp(typed.select(*extra, *leading, *instants, *measures, *audit), TRANSFORMED_AT)


def silver_carriers(national: DataFrame, foreign: DataFrame) -> DataFrame:
    """Both airline registries, ``origem_cadastro`` telling them apart."""
    both = unify({NATIONAL: national, FOREIGN: foreign}, "origem_cadastro")
    audit = [c for c in (SOURCE_FILE, INGESTED_AT) if c in both.columns]
    data = [c for c in both.columns if c not in {*audit, "origem_cadastro"}]
    return stamp(both.select(*data, "origem_cadastro", *audit), TRANSFORMED_AT)


def silver_airports(bronze: DataFrame) -> DataFrame:
    """States are full names and coordinates stay DMS text, so the names say so."""
    typed = bronze.withColumn("altitude", text.decimal_comma(F.col("altitude")))
    named = typed.withColumnsRenamed({
        "uf": "uf_nome",
        "uf_servido": "uf_servido_nome",
        "latitude": "latitude_dms",
        "longitude": "longitude_dms",
        "altitude": "altitude_m",
    })
    return stamp(named, TRANSFORMED_AT)


def silver_codes(bronze: DataFrame) -> DataFrame:
    return stamp(bronze, TRANSFORMED_AT)

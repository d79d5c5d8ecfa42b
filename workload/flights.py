"""Flight-shaped views over the test tables (``FIXTURES.md`` section 2).

``events`` plays the flights.  The supplied rows have no absences, orphans or reversed
times, so these are put in by arithmetic on the row's ids; every row is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pontualis.model import CANCELLED, FLOWN, FOREIGN, NATIONAL, NO_INSTANT, NO_REASON, SOURCE_FILE
from pontualis.plans.silver import silver_carriers, silver_flights
from pontualis.sources.seeds import operation_codes

DI_CODES = ("0", "2", "3", "4", "6", "7", "9", "D", "E", "1")
LINE_TYPES = ("N", "C", "I", "G")
# Airports N1 and N10..N19 stand for the domestic ones.
HOME_PREFIXES = ("N1",)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _nth(values: tuple[str, ...], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (position + 1).cast("int"))


def _every(key: str, n: int) -> Column:
    return F.col(key) % n == 0


def _whole_seconds(instant: Column) -> Column:
    return F.date_format(instant, "yyyy-MM-dd HH:mm:ss")


def _nine_digits(instant: Column) -> Column:
    return F.concat(F.date_format(instant, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("000"))


def _plus_minutes(instant: Column, minutes: Column | int) -> Column:
    amount = minutes if isinstance(minutes, Column) else F.lit(minutes)
    return F.timestamp_add("MINUTE", amount, instant)


def raw_flights(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze role: everything text, plus ``event_id`` to tell equal rows apart."""
    events = table(spark, folder, "events")
    ts = F.col("ts")
    scheduled = F.date_trunc("hour", ts).cast("timestamp_ntz")
    failed = F.col("event_type") == "error"
    unscheduled = _every("event_id", 101)
    return events.select(
        "event_id",
        F.when(F.col("user_id") % 10 != 9,
               F.concat(F.lit("Customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0")),
               ).alias("icao_empresa"),
        F.col("user_id").cast("string").alias("numero_voo"),
        _nth(DI_CODES, F.col("event_id") % 10).alias("codigo_di"),
        _nth(LINE_TYPES, F.col("user_id") % 4).alias("codigo_tipo_linha"),
        F.concat(F.lit("N"), (F.col("user_id") % 30).cast("string")).alias("icao_origem"),
        F.concat(F.lit("N"), (F.col("event_id") % 28).cast("string")).alias("icao_destino"),
        F.when(unscheduled, NO_INSTANT).otherwise(_whole_seconds(scheduled))
         .alias("partida_prevista"),
        F.when(failed, NO_INSTANT)
         .when(_every("event_id", 211), _nine_digits(_plus_minutes(ts, -1440)))
         .when(_every("event_id", 223), _nine_digits(_plus_minutes(ts, 2880)))
         .when(_every("event_id", 3), _whole_seconds(ts))
         .otherwise(_nine_digits(ts)).alias("partida_real"),
        F.when(unscheduled, NO_INSTANT)
         .when(_every("event_id", 307), _whole_seconds(_plus_minutes(scheduled, -30)))
         .otherwise(_whole_seconds(_plus_minutes(scheduled, 120))).alias("chegada_prevista"),
        F.when(failed, NO_INSTANT)
         .otherwise(_nine_digits(_plus_minutes(ts, F.floor(F.col("value") * 5))))
         .alias("chegada_real"),
        F.when(~_every("event_id", 89),
               F.when((F.col("event_type") == "signup") & _every("event_id", 5), "OUTRO")
               .when(failed, CANCELLED).otherwise(FLOWN)).alias("situacao_voo"),
        F.lit(NO_REASON).alias("codigo_justificativa"),
        F.concat(F.lit("month_"), (F.col("event_id") % 12).cast("string"), F.lit(".csv"))
         .alias(SOURCE_FILE),
    )


def flights(spark: SparkSession, folder: str) -> DataFrame:
    return silver_flights(raw_flights(spark, folder)).drop("_transformado_em")


def changed_flights(raw: DataFrame) -> DataFrame:
    """:func:`raw_flights` as a later load has them: of the first sixty flights a third is gone and a
    third changed, and the first twenty are there once more under other ids."""
    early, place = F.col("event_id") < 60, F.col("event_id") % 3
    changed = early & (place == 1)
    later = raw.filter(~(early & (place == 0))).withColumns({
        "situacao_voo": F.when(changed, CANCELLED).otherwise(F.col("situacao_voo")),
        "codigo_justificativa": F.when(changed & (F.col("event_id") % 2 == 0), F.lit(None))
        .otherwise(F.col("codigo_justificativa")),
        "partida_real": F.when(changed, NO_INSTANT).otherwise(F.col("partida_real")),
    })
    again = raw.filter("event_id < 20").withColumn("event_id", F.col("event_id") + 1_000_000_000)
    return later.unionByName(again)


def country_prefixes(spark: SparkSession) -> DataFrame:
    """Nested prefixes of the airport codes; N3 to N9 and N0 have none."""
    listed = [("N1", "Brasil"), ("N12", "Exterior"), ("N2", "Exterior"), ("N27", "Brasil"),
              ("N270", "Exterior"), ("X", "Exterior")]
    return spark.createDataFrame(listed, "prefixo string, valor string")


def airports(spark: SparkSession, folder: str) -> DataFrame:
    """Airport registry: nations, their region as the state."""
    key = F.col("n_nationkey").cast("string")
    return table(spark, folder, "nation").select(
        F.concat(F.lit("N"), key).alias("icao"),
        F.col("n_name").alias("nome"),
        F.concat(F.lit("Municipio "), key).alias("municipio"),
        F.concat(F.lit("Estado "), F.col("n_regionkey").cast("string")).alias("uf_nome"),
    )


def national_carriers(spark: SparkSession, folder: str) -> DataFrame:
    """Sparse registry: customers, without a code when their balance is not positive."""
    key = F.col("c_custkey").cast("string")
    return table(spark, folder, "customer").select(
        F.when(F.col("c_acctbal") > 0, F.col("c_name")).otherwise("").alias("icao"),
        F.concat(F.lit("L"), F.substring(key, -1, 1)).alias("sigla_iata"),
        F.concat(F.lit('Linhas "'), key, F.lit('" S.A.')).alias("razao_social"),
        F.col("c_mktsegment").alias("servico"),
        F.lit("São Paulo").alias("cidade"),
        F.col("c_nationkey").cast("string").alias("uf"),
        F.lit("ATIVA").alias("situacao"),
    )


def foreign_carriers(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey").cast("string")
    return table(spark, folder, "supplier").select(
        F.col("s_name").alias("icao"),
        F.concat(F.lit("A"), F.substring(key, -1, 1)).alias("sigla_iata"),
        F.concat(F.lit("Air "), key).alias("razao_social"),
        F.lit("INTERNACIONAL").alias("servico"),
        F.lit("Brasília").alias("cidade"),
        F.col("s_nationkey").cast("string").alias("uf"),
        F.lit("ATIVA").alias("situacao"),
    )


def airport_register(spark: SparkSession, folder: str) -> DataFrame:
    """Wide airport registry with the texts that break readers: accents, DMS, commas."""
    key = F.col("c_custkey").cast("string")
    degrees = F.lpad(F.col("c_nationkey").cast("string"), 2, "0")
    return table(spark, folder, "customer").select(
        F.col("c_name").alias("icao"),
        key.alias("ciad"),
        F.concat(F.lit("Aeródromo São "), key).alias("nome"),
        F.concat(F.lit('"'), F.col("c_mktsegment")).alias("municipio"),
        F.lit("Goiás").alias("uf"),
        F.concat(F.lit("Vila\\"), key).alias("municipio_servido"),
        F.lit("Pará").alias("uf_servido"),
        F.concat(degrees, F.lit("°52'06\"S")).alias("latitude"),
        F.concat(degrees, F.lit("°10'59\"W")).alias("longitude"),
        F.concat(key, F.lit(",5")).alias("altitude"),
        F.lit("ABERTO").alias("situacao"),
    )


def airport_file(spark: SparkSession, folder: str) -> DataFrame:
    """:func:`airports` with all columns of the published file."""
    known = airports(spark, folder).withColumnRenamed("uf_nome", "uf")
    filler = ("ciad", "municipio_servido", "uf_servido", "latitude", "longitude", "altitude",
              "situacao")
    return known.withColumns({c: F.lit("1,0" if c == "altitude" else c.upper()) for c in filler})


def untidy_carriers(spark: SparkSession, folder: str) -> DataFrame:
    """Every code twice or more: once without a name, and some in both registries."""
    clean = carriers(spark, folder)
    number = F.col("uf").cast("int")
    nameless = clean.withColumn("razao_social", F.when(number % 2 == 0, F.lit("")))
    abroad = clean.filter(number % 3 == 0).withColumns({
        "razao_social": F.concat(F.lit("Outra "), F.col("razao_social")),
        "origem_cadastro": F.lit(FOREIGN)})
    only_abroad = clean.filter((number % 5 == 0) & (F.col("origem_cadastro") == NATIONAL))
    unnamed = clean.join(only_abroad.select("icao"), "icao", "left_anti")
    return unnamed.unionByName(nameless).unionByName(abroad)


def absurd_flights(spark: SparkSession, folder: str) -> DataFrame:
    """Flights with instants in the years 1, 5500 and 9999."""
    def year(column: str, places: dict[int, str]) -> Column:
        out = F.col(column)
        for place, value in places.items():
            out = F.when(F.col("event_id") % 7 == place, value).otherwise(out)
        return out

    first, late, last = "0001-01-01 00:00:00", "5500-06-01 12:00:00", "9999-12-31 23:59:59"
    raw = raw_flights(spark, folder).withColumns({
        "partida_prevista": year("partida_prevista", {0: first, 1: last}),
        "partida_real": year("partida_real", {0: last, 1: first, 2: late}),
        "chegada_prevista": year("chegada_prevista", {0: last, 1: first, 3: late}),
        "chegada_real": year("chegada_real", {0: first, 1: last}),
    })
    return silver_flights(raw).drop("_transformado_em")


def carriers(spark: SparkSession, folder: str) -> DataFrame:
    return silver_carriers(
        national_carriers(spark, folder), foreign_carriers(spark, folder)
    ).drop("_transformado_em")


def codes(spark: SparkSession) -> DataFrame:
    return operation_codes(spark)

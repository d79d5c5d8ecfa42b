"""Times the headline queries and prints one JSON line.

Each headline query runs once to warm up and then three times; its figure is the median, with
the whole result produced into a no-op sink.  All other queries run once more after a
warm-up and are reported under ``others``.  ``published`` times the reports over tables
that a refresh has published, without the cost of making the flight view; with
``BENCH_SKEW=n`` the flights are taken n times, a third of them on one carrier.
Progress goes to stderr.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from pontualis.operators import contract, profile, reconcile
from pontualis.plans import gold
from pontualis.plans.silver import silver_flights
from pontualis.sources.scratch import discard, materialize
from workload import flights as w
from workload.queries import QUERIES

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
SKEW = int(os.environ.get("BENCH_SKEW", "1"))
RUNS = 3

HEADLINES = (
    "scan_delimited", "silver_typed", "silver_delays", "registry_union",
    "ref_flags", "rule_metrics", "audited_rows", "quarantine", "quarantine_reasons",
    "sentinel_profile", "typing_success", "transform_profile", "reconcile_pairs",
    "side_by_side", "keyed_diff", "completeness", "edges", "top_k",
    "idempotent_load", "gold_dedup", "gold_dim", "gold_fact", "gold_obt", "gold_kpis",
    "gold_by_hour", "gold_by_route", "gold_by_carrier", "recovered_but_late",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED_DIR", "/tmp/checkpoints"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def report(name: str, seconds: float) -> float:
    print(f"{name}: {seconds:.3f}", file=sys.stderr)
    return round(seconds, 3)


def published(spark: SparkSession) -> dict[str, float]:
    """Seconds of each report, and of rebuilding gold, over published silver."""
    raw = w.raw_flights(spark, FOLDER)
    if SKEW > 1:
        copies = raw.join(spark.range(SKEW).withColumnRenamed("id", "copy"))
        hot = F.when(F.col("copy") % 3 == 0, F.lit("Customer#000000001")).otherwise(F.col("icao_empresa"))
        # Other numbers, so that the copies are other flights.
        raw = copies.withColumn("icao_empresa", hot).withColumn(
            "numero_voo", F.concat_ws("-", "numero_voo", "copy")).drop("copy")
    flights = materialize(silver_flights(raw).drop("_transformado_em"), "bench_silver")
    carriers, codes = w.carriers(spark, FOLDER), w.codes(spark)
    fact = materialize(gold.build_fact(flights, carriers, codes), "bench_fact")
    runs = {
        "rule_metrics": lambda: contract.rule_metrics(contract.flag_references(
            flights, w.airports(spark, FOLDER), carriers), contract.flight_rules()),
        "gold_dedup": lambda: gold.without_copies(flights),
        "gold_fact": lambda: gold.build_fact(flights, carriers, codes),
        "gold_kpis": lambda: gold.kpis(fact),
        "gold_by_carrier": lambda: gold.kpis(fact, "nome_companhia"),
        "recovered_but_late": lambda: profile.recovered_but_late(fact),
        "side_by_side": lambda: reconcile.side_by_side(flights, flights),
    }
    seconds = {}
    for name, make in runs.items():
        for _ in range(2):  # the first one warms up
            start = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
            seconds[name] = report(f"published {name}", time.perf_counter() - start)
    return seconds


def main() -> None:
    names = sys.argv[1:] or HEADLINES
    spark = session()
    seconds, others = {}, {}
    for name in names:
        timed(spark, name)
        seconds[name] = report(name, statistics.median(timed(spark, name) for _ in range(RUNS)))
    for name in [] if sys.argv[1:] else sorted(set(QUERIES) - set(HEADLINES)):
        timed(spark, name)
        others[name] = report(name, timed(spark, name))
    tables = {} if sys.argv[1:] else published(spark)
    discard(spark)
    spark.stop()
    print(json.dumps({
        "metric": "sum of median query seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "others": others,
        "published": tables,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()

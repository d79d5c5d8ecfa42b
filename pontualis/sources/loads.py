"""Full-refresh publishing with history, on plain Parquet.

Every attempt to publish a load writes a folder of its own, ``<path>/data/<attempt>/``, and
``<path>/loads/tentativa=<attempt>/`` gets one small row once all its data is in place.  The row
names the load, its schema, its counts and its place in the history; a load becomes visible
with it.  Readers see the previous load or the new one, never a part: a run that dies
half-way leaves a folder that no row names, and its retry writes another.

Of rival attempts at one load the same one wins for every reader: that with the first place,
and of equal places that with the smallest name.  A writer whose attempt is not the winner
raises ``RivalLoad``; what it wrote is never read, and repeating it finds the winner's load.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pontualis.model import INGESTED_AT
from pontualis.operators.rows import union_all
from pontualis.sources.scratch import exists

LOADS_DDL = ("load_id string, linhas bigint, esquema string, publicado_em timestamp, "
             "sequencia bigint, origem string, contagens map<string,bigint>, baldes string, "
             "tentativa string")
ROWS = "linhas"


class LoadNotFound(LookupError):
    """No committed load of that name, or none at all."""


class RivalLoad(RuntimeError):
    """Another writer has committed the same load first."""


class InputsChanged(ValueError):
    """A committed load was made from other inputs."""


def _commits(spark: SparkSession, path: str) -> list[Row]:
    """The winning commits of a table, in the order of the history; one row for each load."""
    folder, winners = f"{path}/loads", {}
    rows = spark.read.schema(LOADS_DDL).parquet(folder).collect() if exists(spark, folder) else []
    for row in sorted(rows, key=lambda r: (r.sequencia, r.tentativa)):
        winners.setdefault(row.load_id, row)
    return list(winners.values())


def loads(spark: SparkSession, path: str) -> DataFrame:
    """The committed loads of a table; empty if there are none."""
    return spark.createDataFrame(_commits(spark, path), LOADS_DDL)


def _find(spark: SparkSession, path: str, load_id: str) -> Row | None:
    return next((c for c in _commits(spark, path) if c.load_id == load_id), None)


def _committed_as(spark: SparkSession, path: str, load_id: str) -> Row:
    commit = _find(spark, path, load_id)
    if commit is None:
        raise LoadNotFound(f"{path}: {load_id}")
    return commit


def _read(spark: SparkSession, path: str, attempt: str, schema: StructType) -> DataFrame:
    """With columns in their order, which partitioned folders alone would not tell."""
    return spark.read.schema(schema).parquet(f"{path}/data/{attempt}").select(*schema.names)


def _committed(spark: SparkSession, path: str, commit: Row) -> DataFrame:
    return _read(spark, path, commit.tentativa, StructType.fromJson(json.loads(commit.esquema)))


def is_published(spark: SparkSession, path: str, load_id: str) -> bool:
    return _find(spark, path, load_id) is not None


def read_load(spark: SparkSession, path: str, load_id: str) -> DataFrame:
    """One committed load, with the schema it was written with."""
    return _committed(spark, path, _committed_as(spark, path, load_id))


def published(spark: SparkSession, path: str, load_id: str, *, view: str | None = None,
              origin: str | None = None) -> DataFrame | None:
    """The committed load, also as ``view``, or None if there is none.

    Raises ``InputsChanged`` if ``origin`` is given and the load has another.
    """
    commit = _find(spark, path, load_id)
    if commit is None:
        return None
    if origin is not None and commit.origem != origin:
        raise InputsChanged(f"{path}: load {load_id} was made from other inputs")
    table = _committed(spark, path, commit)
    if view:
        table.createOrReplaceTempView(view)
    return table


def counts_of(spark: SparkSession, path: str, load_id: str) -> dict[str, int]:
    """What was counted while a committed load was written; ``linhas`` are its rows."""
    commit = _committed_as(spark, path, load_id)
    return {ROWS: commit.linhas, **(commit.contagens or {})}


def layout_of(spark: SparkSession, path: str, load_id: str) -> str | None:
    """What ``publish`` was told of a committed load's files."""
    return _committed_as(spark, path, load_id).baldes


def current(spark: SparkSession, path: str) -> DataFrame:
    """The load committed last, by its place in the history and not by any clock."""
    commits = _commits(spark, path)
    if not commits:
        raise LoadNotFound(path)
    return _committed(spark, path, commits[-1])


def publish(df: DataFrame, path: str, load_id: str, *, view: str | None = None,
            partition_by: Sequence[str] = (), rebalance: bool = False,
            cluster_by: Sequence[str] = (), counts: Mapping[str, Column] | None = None,
            verify: Callable[[], None] | None = None, origin: str | None = None,
            layout: str | None = None) -> DataFrame:
    """Replace the table at ``path`` by ``df``; the schema may differ from the last load.

    ``verify`` runs after the write and before the commit; if it raises, the previous load
    stays current.  ``rebalance`` gathers the rows of each ``partition_by`` value first, so
    that tasks do not write a small file into every partition; AQE splits a hot value over
    several tasks.  Rows read from a table with the same partitions need no rebalancing.
    ``cluster_by`` deals the rows by ranges of these columns and sorts each file, so that
    filters on the first of them skip files' row groups; name enough columns that no value of
    them all holds too many rows.
    The rows, and ``counts`` (aggregates by name), are observed in the stage that writes, whose
    tasks each count once, and committed with the load; the table is not read again.
    ``origin`` describes the inputs, for :func:`published`, and ``layout`` the files.
    """
    spark = df.sparkSession
    if is_published(spark, path, load_id):
        raise ValueError(f"{path}: load {load_id} is already published")
    attempt, seen = uuid.uuid4().hex, Observation()
    out = df.hint("rebalance", *[F.col(c) for c in partition_by]) if rebalance else df
    if cluster_by:
        out = out.repartitionByRange(*cluster_by).sortWithinPartitions(*partition_by, *cluster_by)
    out = out.observe(seen, F.count(F.lit(1)).alias(ROWS),
                      *[c.alias(name) for name, c in (counts or {}).items()])
    out.write.partitionBy(*partition_by).parquet(f"{path}/data/{attempt}")
    if verify is not None:
        verify()
    counted = seen.get
    _commit(spark, path, load_id, attempt, schema=df.schema.json(), rows=counted.pop(ROWS),
            counts=counted, origin=origin, layout=layout)
    written = _read(spark, path, attempt, df.schema)
    if view:
        written.createOrReplaceTempView(view)
    return written


def _commit(spark: SparkSession, path: str, load_id: str, attempt: str, *, schema: str, rows: int,
            counts: Mapping[str, int], origin: str | None, layout: str | None) -> None:
    """Make an attempt the load, unless a rival has done so."""
    before = _commits(spark, path)
    if any(c.load_id == load_id for c in before):
        raise RivalLoad(f"{path}: another writer has committed {load_id}")
    place = max((c.sequencia for c in before), default=0) + 1
    commit = pa.table({
        "load_id": [load_id],
        "linhas": [rows],
        "esquema": [schema],
        "publicado_em": [datetime.now(timezone.utc)],
        "sequencia": pa.array([place], pa.int64()),
        "origem": pa.array([origin], pa.string()),
        "contagens": pa.array([list(counts.items())], pa.map_(pa.string(), pa.int64())),
        "baldes": pa.array([layout], pa.string()),
    })
    # A folder of its own, so that writers at the same time leave each other's files alone.
    spark.createDataFrame(commit).write.parquet(f"{path}/loads/tentativa={attempt}")
    if _committed_as(spark, path, load_id).tentativa != attempt:
        raise RivalLoad(f"{path}: another writer has committed {load_id}")


def compare_loads(spark: SparkSession, path: str, load_ids: Sequence[str]) -> DataFrame:
    """Rows and first ingestion of several loads; each load is its own partition."""
    return union_all(
        read_load(spark, path, load_id)
        .agg(F.count(F.lit(1)).alias("linhas"), F.min(INGESTED_AT).alias("ingerido_em"))
        .select(F.lit(load_id).alias("versao"), "linhas", "ingerido_em")
        for load_id in load_ids
    )

"""Shared storage for intermediate tables that a later plan needs to know the size of."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_serial = itertools.count()


def shared_folder(spark: SparkSession) -> str:
    """A folder that the driver and all executors see, by what the session says of itself.

    In this order: ``spark.checkpoint.dir``, the context's checkpoint folder, and, where
    neither is set, as in tests, the warehouse.  Never a machine's temporary folder.
    """
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/") if folder else f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path on shared storage that no other call gets."""
    return f"{_own_folder(spark)}/{name}-{next(_serial)}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to shared storage and read it back.

    The result survives the loss of executors, cuts the lineage, and has a size that the
    planner reads from its files.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._scratch_path = path
    return table


def _located(spark: SparkSession, path: str):
    """A path and the file system it is in, as Spark sees them."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    store, where = _located(spark, path)
    return store.exists(where)


def release(*tables: DataFrame) -> None:
    """Remove what :func:`materialize` wrote for ``tables``; nothing may read them any more."""
    for table in tables:
        store, where = _located(table.sparkSession, table._scratch_path)
        store.delete(where, True)


def discard(spark: SparkSession) -> None:
    """Remove what this application has put there; its results must no longer be in use."""
    store, where = _located(spark, _own_folder(spark))
    store.delete(where, True)

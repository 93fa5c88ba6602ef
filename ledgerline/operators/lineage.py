"""Cutting plans: intermediate tables in the folder all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _cleaned(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of an action in here go when it ends, not when the driver collects garbage."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else one below the warehouse.

    The warehouse is shared too wherever tables are; a folder of one machine
    would be lost with it.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and go on from the stored copy (a reliable checkpoint). The shuffle files
    of the step are not kept."""
    shared_dir(df.sparkSession)
    with _cleaned(df.sparkSession):
        return df.checkpoint(eager=True)


def staging_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/ledgerline-{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Like :func:`cut`, as a parquet table: later reads take only the columns they use."""
    path = staging_path(df.sparkSession, name)
    with _cleaned(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

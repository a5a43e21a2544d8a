"""Intermediate tables in the shared folder of the session, and the size of Arrow batches."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from .. import storage
from ..storage import dropped, fresh_path

__all__ = ["dropped", "fresh_path", "small_batches", "spread", "written"]

#: Bytes of rows that a Python worker is sent at once. Spark's default of 64 MB costs a worker several times as much.
BATCH_BYTES = 8 << 20


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def _batch(spark: SparkSession) -> str:
    now = spark.conf.get(_BATCH)
    bare = now.rstrip("b")
    return now if bare.isdigit() and 0 < int(bare) <= BATCH_BYTES else f"{BATCH_BYTES}b"


def small_batches(spark: SparkSession) -> None:
    """Sets the session's largest Arrow batch for long texts, unless it is smaller already. For results that are computed later by whoever
    asked for them; jobs that run here restore the setting."""
    spark.conf.set(_BATCH, _batch(spark))


def written(df: DataFrame, name: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """The same rows, read from a table in the shared folder that is written with small Arrow batches."""
    return storage.written(df, name, {_BATCH: _batch(df.sparkSession)}, **{"options": options} if options else {})


def spread(table: DataFrame) -> DataFrame:
    """A plain scan, dealt anew where it has fewer partitions than there are cores: a small file of one row group would be one task.
    A table of many files or row groups stays as it is."""
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table

"""The shared folder of the session, for rows that must not be computed twice.

A written table cuts lineage: a lost executor costs its running tasks, never a finished step.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a temporary folder takes its place on a local master; on a cluster that raises, as machines
    do not see each other's folders."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
        found = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def session_values(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session, restored afterwards."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def written(df: DataFrame, name: str, values: Mapping[str, str] | None = None, options: Mapping[str, str] | None = None) -> DataFrame:
    """The same rows, read from a table in the shared folder, which is written under the settings `values` and with the writer's `options`.
    The job's shuffle files go when it ends, as nothing else reads them."""
    path = fresh_path(df.sparkSession, name)
    with session_values(df.sparkSession, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"} | dict(values or {})):
        df.write.options(**{"compression": "zstd"} | dict(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Deletes written tables that no later job reads."""
    for table in tables:
        files = table.inputFiles()
        if files:
            folder = table.sparkSession._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            folder.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def settled(rows: DataFrame) -> DataFrame:
    """The same rows from a checkpoint: numbers that depend on how rows are dealt to tasks stay what they are."""
    context = rows.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(rows.sparkSession))
    return rows.checkpoint()

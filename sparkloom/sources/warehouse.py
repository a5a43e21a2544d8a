"""Warehouse tables: declared fields, time and range partitions, clustering, expiry, views, validated appends."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import spark_type

#: Warehouse type names that differ from the database ones.
WAREHOUSE_TYPES = {"INTEGER": "int8", "INT64": "int8", "FLOAT": "float8", "FLOAT64": "float8", "NUMERIC": "numeric", "BOOL": "bool", "TIMESTAMP": "timestamptz", "DATETIME": "timestamp", "STRING": "text", "BYTES": "bytea", "GEOGRAPHY": "text", "JSON": "json"}


def struct_of(fields: Sequence[Mapping[str, Any]]) -> T.StructType:
    """A list of {name, type, mode: NULLABLE, REQUIRED or REPEATED, fields} as a StructType."""
    out = []
    for f in fields:
        kind = f["type"].upper()
        data = struct_of(f["fields"]) if kind in ("RECORD", "STRUCT") else spark_type(WAREHOUSE_TYPES.get(kind, kind))
        mode = f.get("mode", "NULLABLE")
        out.append(T.StructField(f["name"], T.ArrayType(data) if mode == "REPEATED" else data, mode != "REQUIRED"))
    return T.StructType(out)


@dataclass(frozen=True)
class TimePartition:
    """Laid out by a time column, cut to HOUR, DAY, MONTH or YEAR; without a column by the time of ingestion."""

    granularity: str = "DAY"
    field: str | None = None
    expiration_ms: int | None = None
    required: bool = False

    def column(self) -> Column:
        return F.date_trunc(self.granularity, F.col(self.field) if self.field else F.current_timestamp())


@dataclass(frozen=True)
class RangePartition:
    """start, start + interval, ... under end; all other values, and null, are in the partition null."""

    field: str
    start: int
    interval: int
    end: int
    expiration_ms: int | None = None
    required: bool = False

    def column(self) -> Column:
        c = F.col(self.field)
        at = F.lit(self.start) + F.floor((c - self.start) / self.interval) * self.interval
        return F.when((c >= self.start) & (c < self.end), at.cast("long"))


Partition = TimePartition | RangePartition
#: The column that holds the partition in files.
PART = "part"


def with_partition(rows: DataFrame, by: Partition) -> DataFrame:
    return rows.withColumn(PART, by.column())


def clustered(rows: DataFrame, columns: Sequence[str], by: Partition | None = None) -> DataFrame:
    """rows dealt by ranges of partition and cluster columns, and sorted by them in each task; order of columns matters."""
    keys = [*([PART] if by else []), *columns]
    dealt = with_partition(rows, by) if by else rows
    return dealt.repartitionByRange(*keys).sortWithinPartitions(*keys)


def without_expired(rows: DataFrame, expiration_ms: int, as_of: datetime) -> DataFrame:
    """Rows of a time-partitioned table whose partition has not expired."""
    return rows.where(F.unix_millis(F.col(PART).cast("timestamp")) + expiration_ms > F.unix_millis(F.lit(as_of).cast("timestamp")))


@dataclass
class WarehouseTable:
    spark: SparkSession
    path: str
    schema: T.StructType
    by: Partition | None = None
    cluster: Sequence[str] = field(default=())

    def create(self) -> WarehouseTable:
        empty = self.spark.createDataFrame([], self.schema)
        self._write(empty, "errorifexists")
        return self

    def _write(self, rows: DataFrame, mode: str) -> None:
        rows = clustered(rows, self.cluster, self.by) if self.cluster else with_partition(rows, self.by) if self.by else rows
        if self.by and not self.cluster:
            rows = rows.hint("rebalance", PART)  # a large partition is split into several files, small ones share a task
        writer = rows.write.mode(mode)
        (writer.partitionBy(PART) if self.by else writer).parquet(self.path)

    def append(self, rows: DataFrame) -> None:
        self._write(rows.select(*self.schema.fieldNames()), "append")

    def read(self, predicate: Column | None = None, columns: Sequence[str] = ()) -> DataFrame:
        """The rows; a table that requires a partition filter wants a predicate that names the partition or its column."""
        if self.by and self.by.required:
            text = str(predicate) if predicate is not None else ""
            if PART not in text and not (self.by.field and self.by.field in text):
                raise ValueError("this table is read with a predicate on its partition")
        rows = self.spark.read.option("basePath", self.path).parquet(self.path)
        rows = rows.where(predicate) if predicate is not None else rows
        return rows.select(*columns) if columns else rows

    def append_by_suffix(self, rows: DataFrame, suffix: str) -> str:
        """Appends to the table of that suffix, with this table's schema, and gives its path."""
        other = WarehouseTable(self.spark, self.path + suffix, self.schema, self.by, self.cluster)
        other._write(validated(rows, self.schema)[0], "append")
        return other.path


def validated(rows: DataFrame, schema: T.StructType, ignore_unknown: bool = False) -> tuple[DataFrame, DataFrame]:
    """(valid rows in the schema's types, rejected rows with an array `reasons`).

    A field that the schema lacks raises unless it is ignored. A value that doesn't fit its type, or a null in a
    required field, rejects the row.
    """
    unknown = [c for c in rows.columns if c not in schema.fieldNames()]
    if unknown and not ignore_unknown:
        raise ValueError(f"unknown fields: {', '.join(unknown)}")
    values, reasons = [], []
    for f in schema.fields:
        raw = F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None)
        value = raw.try_cast(f.dataType)
        values.append(value.alias(f.name))
        reasons.append(F.when(raw.isNotNull() & value.isNull(), F.lit(f"{f.name}: not a {f.dataType.simpleString()}")))
        if not f.nullable:
            reasons.append(F.when(raw.isNull(), F.lit(f"{f.name}: required")))
    marked = rows.withColumn("reasons", F.array_compact(F.array(*reasons)))
    good = F.size("reasons") == 0
    return marked.where(good).select(*values), marked.where(~good)


def insert_rows(table: WarehouseTable, rows: DataFrame, ignore_unknown: bool = False, skip_invalid: bool = False) -> DataFrame:
    """Appends rows and gives the rejected ones. Without skip_invalid one bad row fails all, and nothing is written."""
    valid, rejected = validated(rows, table.schema, ignore_unknown)
    if not skip_invalid:
        first = rejected.limit(1).collect()
        if first:
            raise ValueError(f"invalid row {first[0].asDict()}")
    table.append(valid)
    return rejected


def view(rows: DataFrame, name: str) -> DataFrame:
    rows.createOrReplaceTempView(name)
    return rows.sparkSession.table(name)


def external(spark: SparkSession, path: str, format: str, schema: T.StructType | None = None, **options: Any) -> DataFrame:
    """Files read where they are."""
    reader = spark.read.format(format).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


@dataclass
class MaterializedView:
    """A query's rows in a folder, written again when they are older than the interval. Each version has its own folder."""

    path: str
    query: DataFrame
    refresh_ms: int = 1_800_000
    enabled: bool = True
    written_at: datetime | None = None
    version: int = 0

    def read(self, now: datetime) -> DataFrame:
        stale = self.written_at is None or self.enabled and (now - self.written_at).total_seconds() * 1000 >= self.refresh_ms
        if stale:
            self.version += 1
            self.query.write.parquet(f"{self.path}/v{self.version}")
            self.written_at = now
        return self.query.sparkSession.read.parquet(f"{self.path}/v{self.version}")

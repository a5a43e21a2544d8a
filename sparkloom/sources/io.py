"""Reads from relational databases, parameterised queries, and results in pieces."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession


def query(spark: SparkSession, text: str | Sequence[str], args: Mapping[str, Any] | None = None, **views: DataFrame) -> DataFrame | list[DataFrame]:
    """Runs SQL with bound values (:name) and names (IDENTIFIER(:name)); views are named in braces. A list gives a list."""
    if isinstance(text, str):
        return spark.sql(text, args=dict(args or {}), **views)
    return [spark.sql(one, args=dict(args or {}), **views) for one in text]


def query_file(spark: SparkSession, path: str, args: Mapping[str, Any] | None = None, **views: DataFrame) -> DataFrame:
    """Runs a trusted .sql file."""
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    return spark.sql(text, args=dict(args or {}), **views)


def jdbc(spark: SparkSession, url: str, table: str, split: tuple[str, Any, Any, int] | None = None, fetch: int = 10_000, **options: str) -> DataFrame:
    """A table or (query) of a database. split: column, lowest and highest value, and number of parallel reads; without it one task reads all."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, fetchsize=str(fetch), **options)
    if split:
        column, low, high, n = split
        reader = reader.options(partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(n))
    return reader.load()


def stream(rows: DataFrame, prefetch: bool = True) -> Iterator[Row]:
    """One partition after another on the driver, the next being fetched."""
    return rows.toLocalIterator(prefetchPartitions=prefetch)


def export_in_pieces(rows: DataFrame, path: str, size: int, format: str = "parquet") -> None:
    """Files of at most `size` rows."""
    rows.write.option("maxRecordsPerFile", size).format(format).save(path)

"""Checks of constraints on data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that more than one row has, with their count; a null in the key never clashes."""
    return rows.select(*key).dropna("any").groupBy(*key).agg(F.count("*").alias("count")).where(F.col("count") > 1)


def orphans(rows: DataFrame, columns: Sequence[str], parents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose foreign key is in no parent; a null in it is fine."""
    right = parents.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).distinct()
    on = F.lit(True)
    for i, c in enumerate(columns):
        on = on & (rows[c] == right[f"_k{i}"])
    return rows.dropna("any", subset=list(columns)).join(right, on, "left_anti")


def not_null(column: str) -> Column:
    return F.col(column).isNotNull()


def one_of(column: str, values: Sequence) -> Column:
    """Null passes, as in a database check."""
    return F.col(column).isNull() | F.col(column).isin(list(values))


def broken_rules(rows: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Each rule's name and how many rows break it, in one pass. A rule that is null passes."""
    counts = rows.agg(*[F.count_if(~F.coalesce(rule, F.lit(True))).alias(name) for name, rule in rules.items()])
    pairs = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"`{name}`").alias("broken")) for name in rules])
    return counts.select(F.inline(pairs))


def rejects(rows: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """The rows that break a rule, with the names of the rules in the array `reasons`."""
    reasons = F.array_compact(F.array(*[F.when(~F.coalesce(rule, F.lit(True)), F.lit(name)) for name, rule in rules.items()]))
    return rows.withColumn("reasons", reasons).where(F.size("reasons") > 0)

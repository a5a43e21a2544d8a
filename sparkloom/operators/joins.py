"""Joins by key lists. Nothing here broadcasts by hint: Spark decides by size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_keys(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows whose column is in the only column of keys."""
    right = keys.toDF("_member")
    return rows.join(right, rows[column] == right["_member"], "left_semi")


def _facts(keys: DataFrame) -> DataFrame:
    """One row: whether there are keys, and whether one is null."""
    key = keys.toDF("_member")
    return key.agg((F.count("*") > 0).alias("_any"), F.coalesce(F.bool_or(F.col("_member").isNull()), F.lit(False)).alias("_null"))


def not_in_keys(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """NOT IN with SQL's rules for null, as a plain anti join.

    A null among the keys leaves no row; without keys all rows stay; else rows with a null column go. The facts about keys
    are one row, so the plan needs no null-aware join and no broadcast of the keys.
    """
    right = keys.toDF("_member").where("_member IS NOT NULL")
    left = rows.crossJoin(F.broadcast(_facts(keys))).where(~F.col("_null") & (F.col(column).isNotNull() | ~F.col("_any")))
    return left.join(right, left[column] == right["_member"], "left_anti").select(*rows.columns)


def member_flag(rows: DataFrame, column: Column, keys: DataFrame, name: str) -> DataFrame:
    """rows with a three-valued column: IN as SQL has it, for use inside any condition."""
    right = keys.toDF("_member").where("_member IS NOT NULL").distinct().withColumn("_hit", F.lit(True))
    joined = rows.crossJoin(F.broadcast(_facts(keys))).join(right, column == F.col("_member"), "left")
    flag = F.when(~F.col("_any"), F.lit(False)).when(F.col("_hit"), F.lit(True)).when(column.isNull() | F.col("_null"), F.lit(None).cast("boolean")).otherwise(F.lit(False))
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], flag.alias(name))


def find_by_tuples(rows: DataFrame, conditions: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that match any of the key tuples in all columns; tuples with a null match nothing."""
    keys = conditions.select(*columns).dropna("any").distinct()
    return rows.join(keys, list(columns), "left_semi")


def without_tuples(rows: DataFrame, conditions: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The other rows; rows with a null in the key stay."""
    keys = conditions.select(*columns).dropna("any").distinct()
    return rows.join(keys, list(columns), "left_anti").select(*rows.columns)


def join_ignoring_case(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Inner join on equal lower-case text; repeated matches stay."""
    lowered_left = left.select("*", *[F.lower(F.col(a)).alias(f"_l{k}") for k, (a, _) in enumerate(pairs)])
    lowered_right = right.select("*", *[F.lower(F.col(b)).alias(f"_l{k}") for k, (_, b) in enumerate(pairs)])
    names = [f"_l{k}" for k in range(len(pairs))]
    return lowered_left.join(lowered_right, names).drop(*names)


def rows_of_arrays(frame: DataFrame, *arrays: str) -> DataFrame:
    """Parallel arrays as rows; a shorter array is filled with nulls."""
    return frame.select(F.inline(F.arrays_zip(*[F.col(a) for a in arrays])))

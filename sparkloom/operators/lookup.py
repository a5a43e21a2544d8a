"""Batched, de-duplicated lookups and grouped lists."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .table import numbered


class MissingKeys(KeyError):
    pass


def lookup(requests: DataFrame, source: DataFrame, key: str, group: Sequence[str] = ()) -> DataFrame:
    """One answer for each request (pos, key): the source's row as a struct `value`, null where there is none.

    Source rows are found once for each distinct key; a key that the source holds twice answers with the smallest row.
    group: more columns that requests and source share; work is shared inside a group only.
    """
    on = [*group, key]
    wanted = requests.select(*on).distinct()
    rest = [c for c in source.columns if c not in on]
    rows = source.join(wanted, on, "left_semi").groupBy(*on).agg(F.min(F.struct(*rest)).alias("value"))
    return requests.join(rows, on, "left")


def strict_lookup(requests: DataFrame, source: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Answers, of which a missing one raises when the job runs, and a table of the requests without one."""
    found = lookup(requests, source, key)
    message = F.concat(F.lit(f"no row with {key} = "), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    strict = found.withColumn("value", F.when(F.col("value").isNull(), F.raise_error(message)).otherwise(F.col("value")))
    return strict, found.where("value IS NULL").drop("value")


def by_position(requests: DataFrame, answers: DataFrame, position: str = "pos") -> DataFrame:
    """The i-th answer for the i-th request."""
    return requests.join(answers, position, "left")


def group_key(*columns: str) -> Column:
    """Several columns as one group key."""
    return F.to_json(F.struct(*columns))


def grouped_lists(rows: DataFrame, key: str, position: str, values: Sequence[str], name: str = "items") -> DataFrame:
    """key and its rows' values in order of position. A list is one row: ask for the keys that are wanted."""
    items = F.sort_array(F.collect_list(F.struct(F.col(position).alias("_pos"), *values)))
    return rows.groupBy(key).agg(F.transform(items, lambda x: F.struct(*[x[v].alias(v) for v in values])).alias(name))


def lookup_lists(requests: DataFrame, rows: DataFrame, key: str, position: str, values: Sequence[str], name: str = "items") -> DataFrame:
    """For each request the list of rows with its key, empty if there are none."""
    wanted = rows.join(requests.select(key).distinct(), key, "left_semi")
    lists = grouped_lists(wanted, key, position, values, name)
    joined = requests.join(lists, key, "left")
    return joined.withColumn(name, F.coalesce(name, F.array().cast(lists.schema[name].dataType)))


def chunks(requests: DataFrame, size: int, order: Sequence[Column], group: Sequence[str] = ()) -> DataFrame:
    """requests with a number `chunk` from 0: at most `size` in a row, in order, in each group."""
    return numbered(requests, order, "_row", group).withColumn("chunk", F.floor(F.col("_row") / size)).drop("_row")


def call_once(rows: DataFrame, key: Column, fn: Callable, result: T.DataType, should_store: Callable[[object], bool] | None = None, stored: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Calls fn once for each distinct key and shares what it returns.

    Gives rows with `value` and `error` (the text of what fn raised; the job goes on), and a table (key, value) to hand in as
    `stored` the next time: results for which should_store is true, without failures.
    """
    keyed = rows.withColumn("key", key)
    keys = keyed.select("key").distinct()
    known = stored if stored is not None else None
    asked = keys.join(known, "key", "left_anti") if known is not None else keys
    kind = T.StructType([keyed.schema["key"], T.StructField("value", result), T.StructField("error", T.StringType()), T.StructField("keep", T.BooleanType())])

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k in batch["key"]:
                try:
                    value, error = fn(k), None
                except Exception as e:  # noqa: BLE001  what the user's function raises is a result
                    value, error = None, f"{type(e).__name__}: {e}"
                out.append((k, value, error, error is None and (should_store is None or bool(should_store(value)))))
            yield pd.DataFrame(out, columns=["key", "value", "error", "keep"])

    called = asked.mapInPandas(call, kind)
    answers = called.select("key", "value", "error")
    if known is not None:
        answers = answers.unionByName(known.select("key", "value", F.lit(None).cast("string").alias("error")))
    keep = called.where("keep").select("key", "value")
    return keyed.join(answers, keyed["key"].eqNullSafe(answers["key"])).select(*[keyed[c] for c in rows.columns], answers["value"], answers["error"]), keep if known is None else keep.unionByName(known)


def load_in_batches(keys: DataFrame, load: Callable[[pd.DataFrame], pd.DataFrame], schema: str, size: int = 100) -> DataFrame:
    """load(chunk of at most `size` keys) -> rows, for all distinct keys."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), size):
                yield load(batch.iloc[at : at + size])

    return keys.distinct().mapInPandas(run, schema)

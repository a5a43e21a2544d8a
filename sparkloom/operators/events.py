"""Jobs over logs of cache events: time to live, invalidation, hit rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .table import numbered


def _latest(events: DataFrame, by: Sequence[str], value: Column, name: str, span: int, last_row: int) -> DataFrame:
    """events with the greatest value of the rows before (up to last_row: 0 this one, -1 the one before) with the same `by`.

    Rows are gone through in spans of seq, so that a key with a third of all rows is many tasks: the greatest value of earlier
    spans comes from one row for each key and span, and is joined with the running one inside the span.
    """
    spans = events.withColumn("_span", F.floor(F.col("seq") / span)).withColumn("_value", value)
    whole = spans.groupBy(*by, "_span").agg(F.max("_value").alias("_max"))
    earlier = Window.partitionBy(*by).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    before = whole.select(*by, "_span", F.max("_max").over(earlier).alias("_before"))
    here = Window.partitionBy(*by, "_span").orderBy("seq").rowsBetween(Window.unboundedPreceding, last_row)
    joined = spans.join(before, [*by, "_span"], "left").withColumn("_here", F.max("_value").over(here))
    return joined.withColumn(name, F.greatest("_before", "_here")).drop("_span", "_value", "_before", "_here")


def ttl_reads(events: DataFrame, ttl_ms: int | None = None, span: int = 1_000_000) -> DataFrame:
    """Each `get` of a log (seq, ts, name, key, op) with whether it hits.

    A get hits if the last set, delete or clear before it (in seq order) is a set that has not expired. A set lives
    ttl_ms from its own time, without end if that is None; a get does not renew it. A clear touches all keys of its name.
    Clears are brought in by a running maximum per name, so no key is paired with them.
    """
    times = F.col("ts").cast("timestamp")
    cleared = _latest(events, ["name"], F.when(F.col("op") == "clear", F.col("seq")), "_cleared", span, 0)
    change = F.when(F.col("op").isin("set", "delete"), F.struct("seq", "op", times.alias("at")))
    seen = _latest(cleared.where("op != 'clear'"), ["name", "key"], change, "_last", span, -1).where("op = 'get'")
    fresh = F.lit(True) if ttl_ms is None else F.unix_millis(times) < F.unix_millis(F.col("_last.at")) + ttl_ms
    hit = (F.col("_last.op") == "set") & (F.col("_last.seq") > F.coalesce("_cleared", F.lit(-1))) & fresh
    return seen.withColumn("hit", F.coalesce(hit, F.lit(False))).select(*events.columns, "hit")


def hit_rates(reads: DataFrame, block: int = 100) -> DataFrame:
    """The share of hits in each full block of consecutive gets of a name."""
    at = numbered(reads.select("name", "seq", "hit"), [F.col("seq")], "_at", ["name"])
    blocks = at.groupBy("name", F.floor(F.col("_at") / block).alias("block")).agg(F.count("*").alias("n"), F.sum(F.col("hit").cast("int")).alias("hits"))
    return blocks.where(F.col("n") == block).select("name", "block", (100.0 * F.col("hits") / F.col("n")).alias("hit_percent"))


def replay_invalidation(entries: DataFrame, events: DataFrame, lengths: Sequence[int] | None = None) -> DataFrame:
    """Entries (name, key, seq) that are left after the events (name, seq, op, key, keys, prefix).

    An entry goes if a later event clears its name, deletes its key (`delete`, or `delete_multiple` with keys), or
    deletes a prefix of its key (`delete_prefix`). Prefixes are matched by one equi-join for each of their lengths; lengths are
    looked up if not given (one row for each).
    """
    single = events.where("op = 'delete'").select("name", "key", "seq")
    several = events.where("op = 'delete_multiple'").select("name", F.explode("keys").alias("key"), "seq")
    last = single.unionByName(several).groupBy("name", "key").agg(F.max("seq").alias("_deleted"))
    clears = events.where("op = 'clear'").groupBy("name").agg(F.max("seq").alias("_cleared"))
    prefixes = events.where("op = 'delete_prefix'").groupBy("name", "prefix").agg(F.max("seq").alias("_prefixed"))
    if lengths is None:
        lengths = [r[0] for r in prefixes.select(F.char_length("prefix")).distinct().collect()]
    left = entries.join(last, ["name", "key"], "left").join(clears, "name", "left")
    gone = F.greatest(F.coalesce("_deleted", F.lit(-1)), F.coalesce("_cleared", F.lit(-1)))
    left = left.where(F.col("seq") > gone).select(*entries.columns)
    for n in sorted(lengths):
        own = prefixes.where(F.char_length("prefix") == n).select("name", F.col("prefix").alias("_prefix"), "_prefixed")
        cut = left.withColumn("_prefix", F.substring("key", 1, n) if n else F.lit(""))
        left = cut.join(own, ["name", "_prefix"], "left").where(F.col("seq") > F.coalesce("_prefixed", F.lit(-1))).select(*entries.columns)
    return left


def delete_by_path(entries: DataFrame, parts: Sequence[str], requests: DataFrame) -> DataFrame:
    """Entries that no request deletes. requests has an array column `path` of 1 to len(parts) leading key parts, as text."""
    left = entries
    for n in range(1, len(parts) + 1):
        own = requests.where(F.size("path") == n).select(*[F.col("path")[i].alias(f"_p{i}") for i in range(n)]).distinct()
        on = F.lit(True)
        for i in range(n):
            on = on & (F.col(parts[i]).cast("string") == F.col(f"_p{i}"))
        left = left.join(own, on, "left_anti")
    return left


def delete_by_prefix(entries: DataFrame, column: str, prefixes: DataFrame, lengths: Sequence[int] | None = None) -> DataFrame:
    """Entries whose text starts with none of the prefixes (the only column of prefixes)."""
    own = prefixes.toDF("_prefix").distinct()
    if lengths is None:
        lengths = [r[0] for r in own.select(F.char_length("_prefix")).distinct().collect()]
    left = entries
    for n in sorted(lengths):
        left = left.withColumn("_cut", F.substring(column, 1, n) if n else F.lit("")).join(own.where(F.char_length("_prefix") == n).withColumnRenamed("_prefix", "_cut"), "_cut", "left_anti").select(*entries.columns)
    return left


def sizes(entries: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Number of entries under each leading key path."""
    return entries.groupBy(*parts).agg(F.count("*").alias("size"))

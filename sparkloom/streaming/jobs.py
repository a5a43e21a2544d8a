"""Jobs over streams of requests and cache events. Rows later than the watermark are dropped."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.lookup import chunks
from ..operators.table import numbered


def timed_batches(rows: DataFrame, group: str, time: str, size: int = 100, delay_ms: int = 100, ties: Sequence[str] = (), span: int = 100_000) -> DataFrame:
    """Batch form: each row with the number of its batch in its group. A batch ends when it holds `size` rows, or with the
    first row that comes delay_ms or more after the batch began. ties: columns that order rows of one time. Rows without a time come first, as if all at
    one time; a null group is a group.

    Where a batch begins depends on the one before, so a group is cut into spans of rows (at least `size`), which are dealt to all tasks. The first batch of a span
    begins at one of its first `size` rows: for each of these a span tells where the first batch of the next one begins then and how many begin before it.
    Going through these answers, one row for each span, gives the true begins, and from them each span is numbered by itself.
    """
    span = max(span, size)
    order = [F.col(f"`{c}`") for c in (time, *ties)]
    micros = F.coalesce(F.unix_micros(F.col(f"`{time}`").cast("timestamp")), F.lit(-(2**62)))
    own = numbered(rows.withColumn("_micros", micros), order, "_at", [group]).withColumn("_span", F.floor(F.col("_at") / span))
    key = F.col(f"`{group}`").alias("_group")
    slim = own.select(key, "_span", "_at", "_micros")
    followed = slim.where((F.col("_at") >= span) & (F.col("_at") % span == 0)).select(F.col("_group").alias("_g"), (F.col("_span") - 1).alias("_s"))
    here = slim.join(followed, F.col("_group").eqNullSafe(F.col("_g")) & (F.col("_span") == F.col("_s")), "left_semi")
    ahead = slim.where((F.col("_at") >= span) & (F.col("_at") % span < size)).withColumn("_span", F.col("_span") - 1)
    kind = T.StructType([slim.schema["_group"], slim.schema["_span"], T.StructField("exits", T.ArrayType(T.LongType())), T.StructField("begun", T.ArrayType(T.LongType()))])
    leaps = here.unionByName(ahead).groupBy("_group", "_span").applyInArrow(lambda one: _leaps(one, size, delay_ms * 1000, span), kind)
    kind = T.StructType([slim.schema["_group"], T.StructField("_next", T.LongType()), T.StructField("_entry", T.LongType()), T.StructField("_before", T.LongType())])
    entries = leaps.repartition("_group").sortWithinPartitions("_group", "_span").mapInArrow(_entries, kind)
    known = own.join(entries, F.col(f"`{group}`").eqNullSafe(F.col("_group")) & (F.col("_span") == F.col("_next")), "left").drop("_group", "_next")
    known = known.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("_entry", "_before")})
    dealt = known.repartition(group, "_span").sortWithinPartitions(group, "_span", "_at")
    schema = T.StructType([*dealt.schema.fields, T.StructField("_own", T.LongType())])
    placed = dealt.mapInArrow(lambda it: _batches(it, size, delay_ms * 1000, span), schema)
    return placed.select(*[F.col(f"`{c}`") for c in rows.columns], (F.col("_before") + F.col("_own")).alias("batch"))


def _leaps(one: pa.Table, size: int, delay: int, span: int) -> pa.Table:
    """One span with the `size` rows after it: for a first batch at each possible row, where the first one after the span begins, and how many begin in the span."""
    one = one.sort_by("_at")
    at, times = one.column("_at").to_numpy(), one.column("_micros").to_numpy()
    rows = np.arange(span)
    after = np.maximum(rows + 1, np.minimum(rows + size, np.searchsorted(times, times[:span] + delay)))
    last, begun = np.where(after < span, after, rows), (after < span).astype(np.int64)
    while (last[last] != last).any():  # leaps twice as long each time
        last, begun = last[last], begun + begun[last]
    n = 1 if at[0] == 0 else size
    exits, begun = (after[last] - span)[:n], begun[:n] + 1
    lists = {c: pa.array([x.tolist()], pa.list_(pa.int64())) for c, x in (("exits", exits), ("begun", begun))}
    return pa.table({"_group": one.column("_group").slice(0, 1), "_span": one.column("_span").slice(0, 1)} | lists)


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where the first batch of each span but the first begins, and how many begin before; answers come in order of group and span."""
    entry, before = 0, 0
    for batch in batches:
        found = []
        for span, exits, begun in zip(*(batch.column(c).to_pylist() for c in ("_span", "exits", "begun")), strict=True):
            if span == 0:
                entry, before = 0, 0
            entry, before = exits[entry], before + begun[entry]
            found.append((span + 1, entry, before))
        columns = [pa.array(x, pa.int64()) for x in zip(*found, strict=True)] if found else [pa.array([], pa.int64())] * 3
        yield pa.RecordBatch.from_arrays([batch.column("_group"), *columns], names=["_group", "_next", "_entry", "_before"])


def _batches(frames: Iterator[pa.RecordBatch], size: int, delay: int, span: int) -> Iterator[pa.RecordBatch]:
    """Numbers of batches inside each span, -1 for rows of a batch that began before; rows come sorted. The last batch may go on in the next frame."""
    begin, n, batch, skip = 0, 0, -1, 0
    for frame in frames:
        at, times, entries = (frame.column(c).to_numpy() for c in ("_at", "_micros", "_entry"))
        own = np.full(len(at), -1, dtype=np.int64)
        starts = np.flatnonzero(at % span == 0).tolist()
        for a, b in zip([0, *starts], [*starts, len(at)], strict=True):
            if a < b and at[a] % span == 0:
                begin, n, batch, skip = 0, size, -1, int(entries[a])
            held = min(skip, b - a)
            a, skip = a + held, skip - held
            while a < b:
                end = min(b, a + size - n, max(a + (n == 0), a + int(np.searchsorted(times[a : min(b, a + size)], begin + delay))))
                own[a:end] = batch
                n += end - a
                a = end
                if a < b:
                    begin, n, batch = int(times[a]), 0, batch + 1
        yield pa.RecordBatch.from_arrays([*frame.columns, pa.array(own)], names=[*frame.schema.names, "_own"])


def stream_in_batches(stream: DataFrame, deliver: Callable[[DataFrame, int], None], order: str, size: int = 100, every: str = "100 milliseconds", checkpoint: str | None = None, once: bool = False) -> StreamingQuery:
    """Delivers a stream's rows with a chunk number of at most `size` rows; the trigger is the delay."""

    def each(rows: DataFrame, epoch: int) -> None:
        deliver(chunks(rows, size, [F.col(order)]), epoch)

    writer = stream.writeStream.foreachBatch(each)
    writer = writer.option("checkpointLocation", checkpoint) if checkpoint else writer
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def stream_lookup(stream: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Each request of a stream with the source's row of its key, null where there is none."""
    rest = [c for c in source.columns if c != key]
    return stream.join(source.groupBy(key).agg(F.min(F.struct(*rest)).alias("value")), key, "left")


def first_in_window(stream: DataFrame, keys: list[str], time: str, within: str) -> DataFrame:
    """The first row of each key inside the watermark's delay does the work; its repeats are dropped."""
    return stream.withWatermark(time, within).dropDuplicatesWithinWatermark(keys)


class TtlReads(StatefulProcessor):
    """State of a (name, bucket of keys): the last set of each key of the bucket, and the last clear. A get neither sets nor renews; a
    delete ends its key's set, and a clear those of all keys, as it comes once for each bucket."""

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sets = handle.getMapState("sets", "key string", "seq long, at timestamp")
        self.cleared = handle.getValueState("cleared", "seq long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        cleared = self.cleared.get()[0] if self.cleared.exists() else -1
        held: dict[str, tuple | None] = {}  # what this call has seen of keys; written back at its end
        out = []
        for r in pd.concat([frame[["name", "key", "seq", "ts", "op"]] for frame in rows]).sort_values("seq", kind="stable").itertuples():
            if r.op == "clear":
                cleared = max(cleared, r.seq)
                continue
            if r.key not in held:
                held[r.key] = tuple(self.sets.getValue((r.key,))) if self.sets.containsKey((r.key,)) else None
            if r.op == "set":
                held[r.key] = (r.seq, r.ts)
            elif r.op == "delete":
                held[r.key] = None
            else:
                last = held[r.key]
                fresh = last is not None and last[0] > cleared and (self.ttl_ms is None or (r.ts - last[1]).total_seconds() * 1000 < self.ttl_ms)
                out.append((r.name, r.key, r.seq, fresh))
        yield pd.DataFrame(out, columns=["name", "key", "seq", "hit"])
        for one, last in held.items():
            if last is not None and last[0] > cleared:
                self.sets.updateValue((one,), last)
            elif self.sets.containsKey((one,)):
                self.sets.removeKey((one,))
        if cleared >= 0:
            self.cleared.update((cleared,))

    def close(self) -> None:
        pass


def stream_ttl_reads(stream: DataFrame, ttl_ms: int | None, time: str = "ts", late: str = "10 minutes", buckets: int = 64) -> DataFrame:
    """Each get of a stream of events (seq, ts, name, key, op) with whether it hits. A clear (its key does not count) ends all sets of its name.

    The keys of a name are dealt to buckets; a clear goes to each of them, so buckets bound what it is multiplied by. Rows of a micro-batch are gone through
    in order of seq; a call holds one bucket's rows of it, so bound micro-batches (maxFilesPerTrigger, maxBytesPerTrigger). State is kept in
    RocksDB: set spark.sql.streaming.stateStore.providerClass accordingly.
    """
    own = F.array(F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))
    every = F.sequence(F.lit(0), F.lit(buckets - 1))
    dealt = stream.withWatermark(time, late).withColumn("bucket", F.explode(F.when(F.col("op") == "clear", every).otherwise(own)))
    return dealt.groupBy("name", "bucket").transformWithStateInPandas(TtlReads(ttl_ms), "name string, key string, seq long, hit boolean", "append", "none")

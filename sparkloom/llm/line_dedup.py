"""Removal of repeated passages by content-defined line chunks.

Units: a text is cut into lines. Inside a line every place between two words has a hash of these two, and places after
sentence ends go before all others; the smallest of each `window` places in a row is a cut (winnowing). A cut depends on nothing but the words
up to `window` places around it, and two cuts are at most `window` words apart, so equal passages get equal cuts wherever they stand,
with or without punctuation. Chunks: from each cut or line begin to the first one that is at least two units and `min_words` words
away. Chunks may overlap. A passage of 51 words or more in one line holds a whole chunk, whatever stands around it.

A chunk that occurs again anywhere is removed, except at its first place (smallest doc_id, then place in the text).
Chunks are grouped by a 64-bit digest and compared byte by byte: a group must hold one text only; if it holds more, nothing
of it is removed.

Scale: chunks are found once, with arrays over many texts at a time, and kept as a table of digests and places. Digests are counted after a sum in each task; only
places of repeated ones go on. Texts are shuffled once, to meet their places; bytes are compared where they then lie, equal ones of a batch having become
one, so a passage that a third of all texts share costs one row for each batch. The places of very common chunks are dealt to many tasks by a salt. Intermediate tables are deleted when the next one is written.

Edge cases: null texts stay null, empty ones empty. A text whose chunks are all removed becomes what is left, maybe
empty; its row stays. Rows with equal doc_id and text count as one document and are changed alike. A null doc_id comes
before all others. All other columns are kept; n_chars, if there, becomes the new length.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import dropped, small_batches, written
from .tokens import forget
from .words import GROUP_BYTES, mix

#: Odd bases of the polynomial hashes of bytes and of pairs of words, and the first one's inverse modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
INVERSE = pow(BASES[0], -1, 1 << 64)


SPACE = b" \t\n\x0b\x0c\r"

#: A digest with over 1 in HOT of all repeated places has its places dealt to SALTS tasks.
HOT, SALTS = 1000, 64


@dataclass(frozen=True)
class Settings:
    window: int = 12  # of so many places in a row, one is a cut
    min_words: int = 12


_known_powers: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """Powers up to n, kept from group to group; those of a longer text are not kept."""
    size = max(n, GROUP_BYTES + 1)
    if base in _known_powers and len(_known_powers[base]) >= n:
        return _known_powers[base][:n]
    out = np.full(size, base, dtype=np.uint64)
    out[0] = 1
    out = np.multiply.accumulate(out)
    if size == GROUP_BYTES + 1:
        _known_powers[base] = out
    return out[:n]


class _Hashes:
    """Polynomial hashes of any range of data."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(BASES[0], len(data)), out=self.sums[1:])
        self.back = _powers(INVERSE, len(data) + 1)

    def raw(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Not yet spread."""
        return (self.sums[stop] - self.sums[start]) * self.back[start]

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix(self.raw(start, stop) + (stop - start).astype(np.uint64))


def chunks(texts: list[bytes], s: Settings) -> dict[str, np.ndarray]:
    """text, start and stop of each chunk in its text, begin and end of its bytes without white space around them (in all texts
    side by side), and the digest of these bytes. Both starts and stops of a text's chunks never fall."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    none = {c: np.zeros(0, dtype=np.int64) for c in ("text", "start", "stop", "begin", "end", "digest")}
    if not len(data):
        return none
    first = (ends - sizes)[sizes > 0]  # where texts begin
    space = (data == 32) | (data - np.uint8(9) < 5)
    after = np.concatenate(([True], space[:-1]))
    after[first] = True
    place = np.flatnonzero(~space & after)  # the begins of words
    if not len(place):
        return none
    before = np.append(space[1:], True)
    before[first[1:] - 1] = True
    over = np.flatnonzero(~space & before) + 1  # the ends of words
    lines = np.union1d(first, np.flatnonzero(data == 10) + 1)  # where lines begin; maybe the end of all
    hashes = _Hashes(data)
    cuts = np.zeros(0, dtype=np.int64)
    if len(place) > s.window:
        own = hashes.raw(place, over)
        pair = mix(np.concatenate((own[:1], own[:-1])) * np.uint64(BASES[1]) + own)
        # The order of places: begins of lines (no cuts are made there), then begins of sentences, then all others; equal ones by place.
        on = np.searchsorted(lines, place, side="right")
        order = pair >> np.uint64(33) | np.uint64(1 << 31)
        ended = data[over - 1]
        order[1:][((ended == 46) | (ended == 33) | (ended == 63))[:-1]] &= np.uint64((1 << 31) - 1)
        order[np.concatenate(([True], on[1:] != on[:-1]))] = 0
        order = (order << np.uint64(32)) | np.arange(len(place), dtype=np.uint64)
        least, size = order, 1
        while size < s.window:
            step = min(size, s.window - size)
            least, size = np.minimum(least[:-step], least[step:]), size + step
        chosen = least[np.concatenate(([True], least[1:] != least[:-1]))]
        cuts = place[(chosen[chosen >= np.uint64(1 << 32)] & np.uint64((1 << 32) - 1)).astype(np.int64)]
    starts = np.union1d(np.union1d(lines, cuts), [len(data)])  # where units begin; the last is the end
    total = np.searchsorted(place, starts)  # words before
    text = np.searchsorted(ends, starts[:-1], side="right")
    begin = np.arange(len(starts) - 1)
    stop = np.minimum(np.maximum(begin + 2, np.searchsorted(total, total[begin] + s.min_words)), len(starts) - 1)
    stop = np.minimum(stop, np.searchsorted(starts, ends[text]))  # the first unit after the text
    good = (stop - begin >= 2) & (total[stop] - total[begin] >= s.min_words)
    begin, stop, text = begin[good], stop[good], text[good]
    left, right = place[total[begin]], over[total[stop] - 1]
    base = (ends - sizes)[text]
    return {"text": text, "start": starts[begin] - base, "stop": starts[stop] - base, "begin": left, "end": right, "digest": hashes.of(left, right).view(np.int64)}


def _groups(texts: Iterable[bytes | None]) -> Iterator[list[bytes]]:
    group: list[bytes] = []
    size = 0
    for one in texts:
        one = one or b""
        if group and size + len(one) > GROUP_BYTES:
            yield group
            group, size = [], 0
        group.append(one)
        size += len(one)
    if group:
        yield group


def _chunked(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    """Digests and spans (start, and length in the low 32 bits) of the chunks of each text."""
    forget()
    for batch in batches:
        digests, spans, counts = [], [], [np.zeros(0, dtype=np.int64)]
        for group in _groups(batch.column("data").to_pylist()):
            found = chunks(group, s)
            digests.append(found["digest"])
            spans.append(found["start"] << 32 | (found["stop"] - found["start"]))
            counts.append(np.bincount(found["text"], minlength=len(group)))
        ends = pa.array(np.concatenate(([0], np.cumsum(np.concatenate(counts)))).astype(np.int32))
        lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x) if x else np.zeros(0, dtype=np.int64), type=pa.int64())) for x in (digests, spans)]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), *lists], names=["id", "key", "digests", "spans"])


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the chunks that come again; each text of a digest once for each batch."""
    forget()
    for batch in batches:
        again = batch.column("again")
        ends = again.offsets.to_numpy()
        digests, spans = (x.to_numpy() for x in again.flatten().flatten())
        seen: dict[tuple[int, bytes], None] = {}
        for data, a, b in zip(batch.column("data"), (ends[:-1] - ends[0]).tolist(), (ends[1:] - ends[0]).tolist(), strict=True):
            data = data.as_py()
            for digest, span in zip(digests[a:b].tolist(), spans[a:b].tolist(), strict=True):
                start = span >> 32
                seen[digest, data[start : start + (span & 0xFFFFFFFF)].strip(SPACE)] = None
        yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in seen], pa.int64()), pa.array([x for _, x in seen], pa.binary())], names=["digest", "body"])


def _cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for data, gone in zip(texts, spans, strict=True):
        if data is None or gone is None:
            out.append(None)
            continue
        kept, at = [], 0
        for span in np.sort(gone).tolist():
            start = span >> 32
            if start > at:
                kept.append(data[at:start])
            at = max(at, start + (span & 0xFFFFFFFF))
        out.append(b"".join([*kept, data[at:]]))
    return pd.Series(out, dtype=object)


def without_repeats(docs: DataFrame, settings: Settings = Settings(), count: str | None = None) -> DataFrame:
    """docs with repeated chunks cut out of text. count: a name for a column with the number of chunks removed."""
    s = settings
    small_batches(docs.sparkSession)
    key = F.xxhash64("doc_id", "text").alias("key")
    source = docs.where("text IS NOT NULL").select(F.col("doc_id").alias("id"), key, F.col("text").cast("binary").alias("data"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    chunked = written(source.mapInArrow(lambda it: _chunked(it, s), f"id {kind}, key long, digests array<long>, spans array<long>"), "chunks")
    # Digests that come twice, their places, and the first of these.
    often = written(chunked.select(F.explode("digests").alias("digest")).groupBy("digest").agg(F.count("*").alias("n")).where("n > 1"), "often")
    total = often.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = F.broadcast(often.where(F.col("n") * HOT > total).select("digest", F.lit(True).alias("hot")))  # under HOT rows, as the sum of their n is at most total
    dealt = F.when(F.col("hot"), F.pmod(F.xxhash64("id", "key", "span"), F.lit(SALTS)).cast("int")).otherwise(0)
    all_salts = F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))
    each = chunked.select("id", "key", F.explode(F.arrays_zip("digests", "spans")).alias("x")).select("id", "key", F.col("x.digests").alias("digest"), F.col("x.spans").alias("span"))
    each = each.join(hot, "digest", "left").withColumn("salt", dealt).drop("hot")
    salted = often.join(hot, "digest", "left").select("digest", all_salts.alias("salt"))
    places = written(each.join(salted.hint("merge"), ["digest", "salt"], "left_semi"), "places")
    dropped(chunked)
    first = places.groupBy("digest").agg(F.min(F.struct("id", "key", "span")).alias("first"))
    first = first.join(hot, "digest", "left").select("digest", "first", all_salts.alias("salt"))
    here = F.struct("id", "key", "span").eqNullSafe(F.col("first"))
    of_text = F.collect_set(F.struct("digest", "span", (~here).alias("gone"))).alias("again")
    again = written(places.join(first, ["digest", "salt"]).groupBy("id", "key").agg(of_text), "again")
    dropped(places, often)

    # The texts' one shuffle.
    side = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("_doc"), F.xxhash64("doc_id", "text").alias("_key"))
    on = F.col("_doc").eqNullSafe(F.col("id")) & (F.col("_key") == F.col("key"))
    joined = written(side.join(again.hint("merge"), on, "left").select("row", "id", "key", "again"), "joined")
    dropped(again)
    data = F.col("row.text").cast("binary").alias("data")
    bodies = joined.where("again IS NOT NULL").select(data, F.transform("again", lambda x: F.struct(x["digest"].alias("digest"), x["span"].alias("span"))).alias("again")).mapInArrow(_bodies, "digest long, body binary")
    unlike = written(bodies.groupBy("digest").agg(F.min("body").alias("low"), F.max("body").alias("high")).where("low != high").select("digest"), "unlike")
    if unlike.isEmpty():
        gone = F.filter("again", lambda x: x["gone"])
    else:
        spared = joined.select("id", "key", F.inline("again")).join(unlike, "digest").groupBy("id", "key").agg(F.collect_set("digest").alias("spared"))
        spared = spared.select(F.col("id").alias("_id"), F.col("key").alias("_of"), "spared")
        joined = joined.join(spared, F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_of")), "left")
        gone = F.filter("again", lambda x: x["gone"] & ~F.coalesce(F.array_contains("spared", x["digest"]), F.lit(False)))
    # Called non-deterministic so that a filter on the new text doesn't have it cut twice.
    marked = joined.select("row", F.transform(gone, lambda x: x["span"]).alias("gone")).withColumn("gone", F.when(F.size("gone") > 0, F.col("gone")))
    cut = F.pandas_udf(_cut, "binary").asNondeterministic()(F.when(F.col("gone").isNotNull(), data), F.col("gone")).cast("string")
    changed = marked.select("row", F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(cut).alias("text"), F.coalesce(F.size("gone"), F.lit(0)).alias("removed"))
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    columns = [F.col("text") if c == "text" else F.when(F.col("removed") > 0, F.char_length("text")).otherwise(F.col("row.n_chars")).cast(kinds[c]).alias(c) if c == "n_chars" else F.col(f"row.`{c}`") for c in docs.columns]
    return changed.select(*columns, *([F.col("removed").cast("long").alias(count)] if count else []))


def line_dedup(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, text without repeats, n_chars and n_removed (chunks) of every row."""
    found = without_repeats(docs.select("doc_id", "text"), settings, "n_removed")
    return found.select("doc_id", "text", F.char_length("text").cast("long").alias("n_chars"), "n_removed")

"""Token-id files in patched frame-of-reference blocks.

A file holds the ids of consecutive documents. Ids are cut into blocks of 128. A block stores its smallest id,
a bit width, the differences to the smallest id packed at that width, and an exception list of the positions
and differences that don't fit. The width is that of the 90th percentile of the block's differences. An index of
block starts lets a reader go to any token.

Layout (little-endian): magic, then the blocks, then the index (u64 for each block), doc ids (i64), null flags
(u8), tokens of each document (u32), and a footer (u64 blocks, u64 documents, u64 tokens, magic). A block: u32 smallest,
u8 width, u8 exceptions, u8 ids - 1, packed bytes, u8 positions, u32 differences.

Scale: documents are dealt by ranges of doc_id, each range is one file written by one task in a stream; memory
is one segment of about a million ids. A file appears under its final name only when complete, so a task that
is run again replaces nothing but its own equal file. Only one manifest row for each file reaches the driver.

Edge cases: a null or empty text is its end id alone. A null doc_id comes first. Repeated rows and equal doc_ids
stand side by side in any order. An empty table gives no file and no rows. Other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import fresh_path, small_batches
from .tokens import encoder

BLOCK, SEGMENT, PERCENTILE, MAGIC = 128, 1 << 20, 90, b"PFORIDS1"
_HEAD = 7


def _bits(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, np.floor(np.log2(np.maximum(x, 1).astype(np.float64))).astype(np.int64) + 1, 0)


def encode_blocks(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bytes of the blocks of ids, and the start of each block in them."""
    n = -(-len(ids) // BLOCK)
    if not n:
        return b"", np.zeros(0, dtype=np.int64)
    full = np.concatenate([ids, np.full(n * BLOCK - len(ids), ids[-1], dtype=ids.dtype)]).astype(np.int64).reshape(n, BLOCK)
    low = full.min(axis=1)
    diff = full - low[:, None]
    width = _bits(np.sort(diff, axis=1)[:, (BLOCK * PERCENTILE) // 100])
    out_of = diff >> width[:, None] > 0
    misses = out_of.sum(axis=1)
    packed_size = BLOCK // 8 * width
    size = _HEAD + packed_size + 5 * misses
    start = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), dtype=np.uint8)
    used = np.full(n, BLOCK)
    used[-1] = len(ids) - (n - 1) * BLOCK
    out[start[:, None] + np.arange(4)] = low.astype("<u4").view(np.uint8).reshape(n, 4)
    out[start + 4], out[start + 5], out[start + 6] = width, misses, used - 1
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        bits = ((diff[rows][:, :, None] >> np.arange(w)) & 1).astype(np.uint8).reshape(len(rows), -1)
        out[(start[rows] + _HEAD)[:, None] + np.arange(BLOCK // 8 * w)] = np.packbits(bits, axis=1, bitorder="little")
    row, position = np.nonzero(out_of)
    rank = np.arange(len(row)) - np.repeat(np.cumsum(misses) - misses, misses)
    at = start[row] + _HEAD + packed_size[row]
    out[at + rank] = position
    values = diff[row, position].astype("<u4").view(np.uint8).reshape(-1, 4)
    out[(at + misses[row] + 4 * rank)[:, None] + np.arange(4)] = values
    return out.tobytes(), start


def decode_blocks(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The ids of blocks that start at these places of data."""
    n = len(start)
    if not n:
        return np.zeros(0, dtype=np.uint32)
    low = data[start[:, None] + np.arange(4)].view("<u4").reshape(n).astype(np.int64)
    width, misses, used = (data[start + k].astype(np.int64) for k in (4, 5, 6))
    diff = np.zeros((n, BLOCK), dtype=np.int64)
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        bits = np.unpackbits(data[(start[rows] + _HEAD)[:, None] + np.arange(BLOCK // 8 * w)], axis=1, bitorder="little")
        diff[rows] = bits.reshape(len(rows), BLOCK, w) @ (1 << np.arange(w, dtype=np.int64))
    row = np.repeat(np.arange(n), misses)
    rank = np.arange(len(row)) - np.repeat(np.cumsum(misses) - misses, misses)
    at = start[row] + _HEAD + BLOCK // 8 * width[row]
    values = data[(at + misses[row] + 4 * rank)[:, None] + np.arange(4)]
    diff[row, data[at + rank]] = np.ascontiguousarray(values).view("<u4").reshape(-1)
    return (diff + low[:, None]).reshape(-1)[: (n - 1) * BLOCK + used[-1] + 1].astype(np.uint32)


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _write(batches: Iterator[pd.DataFrame], folder: str, path: str, layout: str, end: int) -> Iterator[pd.DataFrame]:
    ids_of, last = encoder(path, layout).ids, end.to_bytes(4, "little")
    fs, root = _open(folder)
    shard = TaskContext.get().partitionId()
    docs, null, counts, index, place, waiting, size, out = [], [], [], [], len(MAGIC), [], 0, None
    temporary = f"{root}/_{shard:06d}-{uuid.uuid4().hex}"

    def flush(final: bool) -> None:
        nonlocal waiting, size, place
        ids = np.frombuffer(b"".join(waiting), dtype="<u4")
        keep = len(ids) if final else len(ids) // BLOCK * BLOCK
        data, start = encode_blocks(ids[:keep])
        index.append(start + place)
        out.write(data)
        place += len(data)
        waiting, size = [ids[keep:].tobytes()], len(ids) - keep

    for batch in batches:
        for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
            if out is None:
                out = fs.open_output_stream(temporary, compression=None)
                out.write(MAGIC)
            ids = ids_of(text) + last
            empty = pd.isna(doc)
            docs.append(0 if empty else int(doc))
            null.append(empty)
            counts.append(len(ids) // 4)
            waiting.append(ids)
            size += len(ids) // 4
            if size >= SEGMENT:
                flush(False)
    if out is not None:
        flush(True)
        starts = np.concatenate(index)
        for part, kind in ((starts, "<u8"), (docs, "<i8"), (null, "u1"), (counts, "<u4"), ([len(starts), len(docs), sum(counts)], "<u8")):
            out.write(np.asarray(part).astype(kind).tobytes())
        out.write(MAGIC)
        out.close()
        final = f"{root}/tokens-{shard:06d}.pfor"
        fs.move(temporary, final)
        yield pd.DataFrame({"shard": [shard], "path": [f"{folder}/tokens-{shard:06d}.pfor"], "docs": [len(docs)], "tokens": [sum(counts)]})


def write_tokens(docs: DataFrame, folder: str, path: str, layout: str = "words", end: int = 1) -> list:
    """Writes the files into folder, in ascending doc_id order over all files, and returns the manifest."""
    fs, root = _open(folder)
    fs.create_dir(root, recursive=True)
    small_batches(docs.sparkSession)
    dealt = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    files = dealt.mapInPandas(lambda it: _write(it, folder, path, layout, end), "shard int, path string, docs long, tokens long")
    return sorted(files.collect(), key=lambda r: r["shard"])


class TokenFile:
    """Reads a file: whole by documents, or any range of tokens by the index of block starts."""

    def __init__(self, path: str):
        fs, name = _open(path)
        self._file = fs.open_input_file(name)
        end = self._file.size()
        blocks, docs, self.tokens = map(int, self._numbers(end - 32, 3, "<u8"))
        at = end - 32 - 4 * docs
        self.counts = self._numbers(at, docs, "<u4").astype(np.int64)
        self.null = self._numbers(at - docs, docs, "u1").astype(bool)
        self.doc_ids = self._numbers(at - 9 * docs, docs, "<i8")
        self._blocks_end = int(at - 9 * docs - 8 * blocks)
        self.starts = self._numbers(self._blocks_end, blocks, "<u8").astype(np.int64)

    def _numbers(self, at: int, n: int, kind: str) -> np.ndarray:
        return np.frombuffer(self._file.read_at(int(n) * np.dtype(kind).itemsize, int(at)), dtype=kind)

    def ids(self, begin: int, end: int) -> np.ndarray:
        """The ids from token begin to token end."""
        if begin >= end:
            return np.zeros(0, dtype=np.uint32)
        first, last = begin // BLOCK, -(-end // BLOCK)
        starts = self.starts[first:last]
        stop = int(self.starts[last]) if last < len(self.starts) else self._blocks_end
        data = np.frombuffer(self._file.read_at(stop - int(starts[0]), int(starts[0])), dtype=np.uint8)
        return decode_blocks(data, starts - starts[0])[begin - first * BLOCK : end - first * BLOCK]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """doc_id, start in the file and ids of each document, read in segments."""
        ends = np.cumsum(self.counts)
        k = 0
        while k < len(ends):
            begin = int(ends[k] - self.counts[k])
            stop = max(k + 1, int(np.searchsorted(ends, begin + SEGMENT, side="right")))
            ids = self.ids(begin, int(ends[stop - 1]))
            for j in range(k, stop):
                a = int(ends[j] - self.counts[j])
                yield None if self.null[j] else int(self.doc_ids[j]), a, ids[a - begin : int(ends[j]) - begin]
            k = stop


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, base in zip(batch["path"], batch["base"], strict=True):
            out = []
            for doc, start, ids in TokenFile(path).documents():
                out.append((doc, base + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                if len(out) == 10_000:
                    yield pd.DataFrame(out, columns=["doc_id", "start", "n_tokens", "ids_crc32"]).astype({"doc_id": "Int64"})
                    out = []
            yield pd.DataFrame(out, columns=["doc_id", "start", "n_tokens", "ids_crc32"]).astype({"doc_id": "Int64"})


def read_digests(spark, manifest: list) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files of a manifest."""
    rows, base = [], 0
    for r in manifest:
        rows.append((r["path"], base))
        base += r["tokens"]
    files = spark.createDataFrame(rows, "path string, base long").repartition(max(1, len(rows)))
    return files.mapInPandas(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, path: str) -> DataFrame:
    spark = docs.sparkSession
    return read_digests(spark, write_tokens(docs, fresh_path(spark, "tokens"), path))

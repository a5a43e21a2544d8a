"""Benchmark decontamination by Wu-Manber search over words.

Patterns are windows of 10 consecutive words of a benchmark item (a shorter item is one window). Windows of one
length are searched together: the last two words at the search position are the block; a shift table tells
how far the search may jump when the block ends no window; a block that does end one leads to the bucket of its
windows, which are compared word by word.

Scale: one block of windows needs no shuffle at all. A benchmark of more than `block_windows` windows is searched in blocks of distinct windows, so what is sent
to executors has a fixed size however many items share a window, and is taken back when its block is done; then the hit spans and window ids of a
document (not its text) are united by row and meet their items in a join.

Edge cases: null and empty texts have no words; a null item text has no window; equal windows of several items
hit for all of them; a null item_id is reported as the empty string in the digest. Repeated document rows give a row
each. Other columns of both inputs are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import small_batches, written
from .words import words_of

WINDOW = 10
RESULT = "n_words long, n_hit long, n_items long, items_sha256 string"


class WuManber:
    """Finds all occurrences of word windows of one length."""

    def __init__(self, length: int, patterns: dict[tuple[bytes, ...], set[str]]):
        self.length, self.block = length, min(2, length)
        self.jump = length - self.block + 1
        self.shift: dict[bytes, int] = {}
        self.bucket: dict[bytes, list[tuple[list[bytes], set[str]]]] = defaultdict(list)
        for window, items in patterns.items():
            for end in range(self.block, length + 1):
                key = b" ".join(window[end - self.block : end])
                self.shift[key] = min(self.shift.get(key, self.jump), length - end)
            self.bucket[b" ".join(window[-self.block :])].append((list(window), items))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, set[str]]]:
        """Start and items of each occurrence."""
        n, m, jump, shift, pair = len(words), self.length, self.jump, self.shift.get, self.block == 2
        at = m - 1
        while at < n:
            key = words[at - 1] + b" " + words[at] if pair else words[at]
            step = shift(key, jump)
            if step:
                at += step
                continue
            start = at - m + 1
            here = words[start : at + 1]
            for window, items in self.bucket[key]:
                if window == here:
                    yield start, items
            at += 1


def compiled(windows: list[tuple[bytes, str]]) -> list[WuManber]:
    """A searcher for each window length. windows: words joined by spaces, and the item."""
    by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
    for text, item in windows:
        words = tuple(text.split(b" "))
        by_length[len(words)][words].add(item)
    return [WuManber(n, found) for n, found in sorted(by_length.items())]


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for item, text in zip(batch["item"], batch["text"], strict=True):
            words = words_of(text)
            out += [(item, b" ".join(words[i : i + WINDOW])) for i in range(max(1, len(words) - WINDOW + 1)) if words]
        yield pd.DataFrame(out, columns=["item", "window"])


def windows_of(benchmark: DataFrame) -> DataFrame:
    """(item, window) without repeats."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    return items.mapInPandas(_windows, "item string, window binary").distinct()


def _digest(items: set[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def _hits(words: list[bytes], searchers: list[WuManber]) -> tuple[np.ndarray, set[str]]:
    edges, items = np.zeros(len(words) + 1, dtype=np.int64), set()
    for searcher in searchers:
        for start, found in searcher.search(words):
            edges[start] += 1
            edges[start + searcher.length] -= 1
            items |= found
    return np.cumsum(edges[:-1]) > 0, items


def hits_column(windows: list[tuple[bytes, str]], text: Column | str, spark) -> Column:
    """A struct of RESULT for each text."""
    shared = spark.sparkContext.broadcast(windows)

    @F.pandas_udf(RESULT)
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        searchers = compiled(shared.value)
        for texts in batches:
            out = []
            for text in texts:
                words = words_of(text)
                hit, items = _hits(words, searchers)
                out.append((len(words), int(hit.sum()), len(items), _digest(items)))
            yield pd.DataFrame(out, columns=["n_words", "n_hit", "n_items", "items_sha256"])

    return hits(text)


def _spans(batches: Iterator[pd.DataFrame], shared) -> Iterator[pd.DataFrame]:
    searchers = compiled(shared.value)
    for batch in batches:
        out = []
        for row, text in zip(batch["row"], batch["text"], strict=True):
            words = words_of(text)
            hit, found = _hits(words, searchers)
            edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
            out.append((row, len(words), edge[0::2].tolist(), edge[1::2].tolist(), sorted(found)))
        yield pd.DataFrame(out, columns=["row", "n_words", "starts", "ends", "found"])


def _united(n: pd.Series, starts: pd.Series, ends: pd.Series, items: pd.Series) -> pd.DataFrame:
    out = []
    for words, a, b, names in zip(n, starts, ends, items, strict=True):
        edges = np.zeros(words + 1, dtype=np.int64)
        for x, y in zip(a, b, strict=True):
            np.add.at(edges, np.asarray(x, dtype=np.int64), 1)
            np.add.at(edges, np.asarray(y, dtype=np.int64), -1)
        names = set() if names is None else set(names)
        out.append((words, int((np.cumsum(edges[:-1]) > 0).sum()), len(names), _digest(names)))
    return pd.DataFrame(out, columns=["n_words", "n_hit", "n_items", "items_sha256"])


def with_hits(docs: DataFrame, benchmark: DataFrame, name: str, block_windows: int = 200_000) -> DataFrame:
    """docs with a column of that name, a struct of RESULT."""
    spark = docs.sparkSession
    small_batches(spark)
    windows = windows_of(benchmark)
    n = windows.count()
    if n <= block_windows:
        return docs.withColumn(name, hits_column([(bytes(r["window"]), r["item"]) for r in windows.collect()], F.col("text"), spark))
    row = "_row"
    while row in docs.columns or row == name:
        row += "_"
    windows = written(windows, "windows")
    distinct = windows.select("window").distinct().withColumn("id", F.monotonically_increasing_id().cast("string"))
    distinct = written(distinct, "distinct")
    blocks = -(-distinct.count() // (block_windows // 2))  # hashed blocks of about half the limit
    kept = written(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    parts = None
    for k in range(blocks):
        shared = spark.sparkContext.broadcast([(bytes(r["window"]), r["id"]) for r in distinct.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k).collect()])
        part = kept.select(F.col(row).alias("row"), "text").mapInPandas(lambda it, s=shared: _spans(it, s), "row long, n_words long, starts array<long>, ends array<long>, found array<string>")
        part = written(part, "spans")
        shared.destroy()
        parts = part if parts is None else parts.unionByName(part)
    names = distinct.join(windows, "window").select("id", "item")
    items = parts.select("row", F.explode("found").alias("id")).join(names, "id").groupBy("row").agg(F.collect_set("item").alias("i"))
    united = parts.groupBy("row").agg(F.first("n_words").alias("n"), F.collect_list("starts").alias("a"), F.collect_list("ends").alias("b")).join(items, "row", "left")
    return kept.join(united.select(F.col("row").alias(row), F.pandas_udf(_united, RESULT)("n", "a", "b", "i").alias(name)), row).drop(row)


def decontamination(docs: DataFrame, benchmark: DataFrame, block_windows: int = 200_000) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every row of docs."""
    found = with_hits(docs.select("doc_id", "text"), benchmark, "hits", block_windows)
    return found.select("doc_id", "hits.*", (F.col("hits.n_hit") > 0).alias("contaminated"))


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, in which no window occurs."""
    name = "_hits_of_row"
    while name in docs.columns:
        name += "_"
    return with_hits(docs, benchmark, name).where(F.col(f"{name}.n_hit") == 0).drop(name)

"""Approximate nearest neighbours by stable projections, a kd-tree and a chi-square stopping test.

Vectors are brought to length one, so that the nearest by distance is the nearest by cosine, and projected by a
normal (2-stable) matrix to `dims` dimensions. The projections of up to `tree_rows` vectors are indexed by a kd-tree.
A query takes the tree's leaves in the order of their distance in the projection, from a queue of nodes, and measures the original vectors in
them. It stops when the next leaf is so far that a vector nearer than the k-th best so far would have been seen with
probability `sure`: its squared projected distance, divided by its squared distance, is chi-square distributed.

Scale: rows are never paired up. Each task builds trees of bounded size from its rows and searches them; queries come in
blocks of at most `block_queries` vectors. Equal vectors are one entry of the index, with their smallest k + 1 ids, which is
all that any query can need.

Edge cases: rows whose vec_id is null, and vectors that are null, empty, zero or hold null or non-finite components, take no part.
Ties, as among scaled copies of a vector, go to the smaller vec_id:
candidates whose single-precision cosines might tie are all kept and ranked in double precision. Vectors are compared with those of their own length only. Repeated rows count once; a query never finds its own vec_id.
Fewer than k candidates give fewer rows; none give none. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import written


@dataclass(frozen=True)
class Settings:
    k: int = 5
    dims: int = 8  # even
    sure: float = 0.9
    leaf: int = 64
    tree_rows: int = 32_768
    block_queries: int = 16_384
    seed: int = 7


def chi_square_quantile(p: float, dims: int) -> float:
    """For even dims the distribution is a finite sum."""

    def below(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dims // 2))

    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) < p else (low, mid)
    return high


class Tree:
    """A kd-tree: halves along the widest side until small enough. The two children of a node are side by side; a leaf is a range of `order`."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.order = np.arange(len(points))
        self.begins, self.ends, self.child = [0], [len(points)], [-1]
        at = 0
        while at < len(self.begins):
            a, b = self.begins[at], self.ends[at]
            if b - a > leaf:
                rows = self.order[a:b]
                side = int(np.argmax(np.ptp(points[rows], axis=0)))
                middle = (b - a) // 2
                self.order[a:b] = rows[np.argpartition(points[rows, side], middle)]
                self.child[at] = len(self.begins)
                self.begins += [a, a + middle]
                self.ends += [a + middle, b]
                self.child += [-1, -1]
            at += 1
        boxes = [points[self.order[a:b]] for a, b in zip(self.begins, self.ends, strict=True)]
        self.low, self.high = (np.array([f(x, axis=0) for x in boxes]) for f in (np.min, np.max))

    def leaves(self, query: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """Squared distance, begin and end of each leaf, nearest first, from a queue of nodes. Only nodes on the way are looked at."""
        queue = [(0.0, 0)]
        while queue:
            far, node = heapq.heappop(queue)
            child = self.child[node]
            if child < 0:
                yield far, self.begins[node], self.ends[node]
                continue
            out = np.maximum(0, np.maximum(self.low[child : child + 2] - query, query - self.high[child : child + 2]))
            left, right = np.einsum("ij,ij->i", out, out).tolist()
            heapq.heappush(queue, (left, child))
            heapq.heappush(queue, (right, child + 1))


class Index:
    def __init__(self, vectors: np.ndarray, s: Settings):
        self.s, self.vectors = s, vectors
        self.norms = np.linalg.norm(vectors, axis=1)
        unit = vectors / self.norms[:, None]
        self.matrix = np.random.default_rng(s.seed).standard_normal((vectors.shape[1], s.dims))
        self.tree = Tree(unit @ self.matrix, s.leaf)
        self.unit = unit[self.tree.order].astype(np.float32)  # for the search; scores come from the vectors
        self.slack = 2 * (vectors.shape[1] + 4) * 2.0**-24  # how far two single-precision cosines may be off
        self.bound = chi_square_quantile(s.sure, s.dims)

    def search(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and cosines of the vectors nearest to a vector, nearest first: k, and all that are as near as the last of these."""
        norm = np.linalg.norm(query)
        like = (query / norm).astype(np.float32)
        leaves = self.tree.leaves((query / norm) @ self.matrix)
        best, rows = np.zeros(0, dtype=np.float32), np.zeros(0, dtype=np.int64)
        kth, step, over = -2.0, 8, False
        while not over:
            seen = []
            for far, a, b in leaves:
                if len(best) >= k and far >= self.bound * max(0.0, 2 - 2 * kth):
                    over = True
                    break
                seen.append(np.arange(a, b))
                if len(seen) == step:
                    break
            over = over or len(seen) < step
            if seen:
                places = np.concatenate(seen)
                found = self.unit[places] @ like
                good = np.flatnonzero(found >= kth - self.slack)
                best, rows = np.concatenate([best, found[good]]), np.concatenate([rows, places[good]])
                if len(best) > k:
                    kth = float(np.partition(best, len(best) - k)[len(best) - k])
                    keep = best >= kth - self.slack
                    best, rows = best[keep], rows[keep]
                elif len(best) == k:
                    kth = float(best.min())
            step = min(2 * step, 64)
        rows = self.tree.order[rows]
        scores = (self.vectors[rows] * query).sum(axis=1) / (self.norms[rows] * norm)
        turn = np.argsort(-scores, kind="stable")
        if len(turn) > k:
            turn = turn[scores[turn] >= scores[turn[k - 1]]]
        return rows[turn], scores[turn]


def _searched(batches: Iterator[pd.DataFrame], shared, s: Settings) -> Iterator[pd.DataFrame]:
    queries: dict[int, tuple[np.ndarray, np.ndarray]] = shared.value
    held: dict[int, list[tuple[np.ndarray, list[int]]]] = {}

    def searched(size: int) -> Iterator[pd.DataFrame]:
        rows = held.pop(size)
        vectors = np.array([v for v, _ in rows], dtype=np.float64)
        ids, asked = queries[size]
        index, out = Index(vectors, s), []
        for query, vector in zip(ids.tolist(), asked, strict=True):
            near, scores = index.search(vector, s.k + 1)
            pairs = [(-score, other) for j, score in zip(near.tolist(), scores.tolist(), strict=True) for other in rows[j][1] if other != query]
            out += [(query, other, -score) for score, other in heapq.nsmallest(s.k, pairs)]
            if len(out) > 50_000:
                yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])
                out = []
        yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    for batch in batches:
        for vector, ids in zip(batch["vector"], batch["ids"], strict=True):
            if len(vector) in queries:
                held.setdefault(len(vector), []).append((np.asarray(vector), list(ids)))
                if len(held[len(vector)]) == s.tree_rows:
                    yield from searched(len(vector))
    for size in list(held):
        yield from searched(size)


def nearest(embeddings: DataFrame, every: int = 50, settings: Settings = Settings()) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest found of each row whose vec_id is divisible by `every`."""
    s, spark = settings, embeddings.sparkSession
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
    rows = rows.select("vec_id", F.transform("vector", lambda x: x + 0.0).alias("vector"))  # -0.0 becomes 0.0
    few = rows.distinct().withColumn("n", F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))).where(F.col("n") <= s.k + 1)
    index = written(few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "index")
    asked = rows.where(F.col("vec_id") % every == 0).distinct()
    n = asked.count()
    blocks = max(1, -(-n // s.block_queries))
    asked = written(asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))), "queries")
    found = None
    for block in range(blocks):
        part: dict[int, tuple[list, list]] = {}
        for r in asked.where(F.col("block") == block).collect():
            ids, vectors = part.setdefault(len(r["vector"]), ([], []))
            ids.append(r["vec_id"])
            vectors.append(r["vector"])
        shared = spark.sparkContext.broadcast({size: (np.array(ids, dtype=np.int64), np.array(vectors)) for size, (ids, vectors) in part.items()})
        here = written(index.mapInPandas(lambda it, q=shared: _searched(it, q, s), "query_id long, vec_id long, score double"), "found")
        shared.destroy()
        found = here if found is None else found.unionByName(here)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= s.k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

"""Connected components of a table of edges, without collecting edges or components anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import dropped, written


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A task's own edges as stars: each node with the smallest that it is linked to there."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for batch in batches:
        for a, b in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    pairs = [(x, root(x)) for x in list(parent)]
    yield pd.DataFrame([p for p in pairs if p[0] != p[1]], columns=["a", "b"]).astype("int64")


#: A node's neighbours are dealt to so many tasks.
SALT = 8
#: Up to so many edges are settled by one task, which holds their nodes (about 80 MB).
SHARE = 200_000


def components(edges: DataFrame, share: int = SHARE) -> DataFrame:
    """edges (a long, b long, a != b) to (node, component): component is the smallest node that node is linked to. edges are counted first, so they
    should be stored rows.

    Up to `share` edges are brought to stars by one task, whatever the length of their chains. More of them take steps, until no more than that are left or all are stars.

    Alternating large and small stars (Kiveris and others): each step links a node's larger neighbours, then
    its smaller ones, to its smallest neighbour. A node's neighbours are never gathered in a row: the smallest is an
    aggregate that is joined back, in `SALT` parts, so that a centre of many links is not one task's. Before each step every task brings its own edges to
    stars. Steps end when no node that others are linked to is linked itself; each step's edges are a written table. An empty table gives an empty table.
    """
    larger = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b")
    if larger.count() <= share:
        now = _by_one_task(larger)
    else:
        now = written(larger.mapInPandas(_forest, "a long, b long").distinct(), "edges")
        while not _stars(now):
            after = _by_one_task(now) if now.count() <= share else _step(now)
            dropped(now)
            now = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _by_one_task(edges: DataFrame) -> DataFrame:
    """Stars of edges that one task holds: all that are there."""
    return written(edges.repartition(1).mapInPandas(_forest, "a long, b long"), "edges")


def _step(now: DataFrame) -> DataFrame:
    """A large and a small star."""
    both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    large = _with_low(both, low).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    small = _with_low(large, low).select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b"))).where("a != b")
    return written(small.mapInPandas(_forest, "a long, b long").distinct(), "edges")


def _with_low(edges: DataFrame, low: DataFrame) -> DataFrame:
    dealt = low.withColumn("salt", F.explode(F.array(*[F.lit(k) for k in range(SALT)])))
    return edges.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALT)).cast("int")).join(dealt, ["a", "salt"]).drop("salt")


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one link and links only to nodes without one."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("linked"), F.lit(0).alias("centre")).unionByName(edges.select(F.col("b").alias("n"), F.lit(0).alias("linked"), F.lit(1).alias("centre")))
    return ends.groupBy("n").agg(F.sum("linked").alias("linked"), F.max("centre").alias("centre")).where("linked > 1 OR linked = 1 AND centre = 1").isEmpty()

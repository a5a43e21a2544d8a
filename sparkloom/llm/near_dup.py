"""Near-duplicate groups by DartMinHash signatures, bands and exact checks.

A text is the weighted set of its shingles of five words (a shorter text is one shingle), the weight being how
often a shingle occurs. Two texts are near duplicates if their weighted Jaccard similarity is 0.8 or more.

DartMinHash: darts fall on the plane of (weight, rank) of each shingle at a rate of one a unit of area. The plane is cut
into regions; the number and places of the darts in a region come from hashes of shingle, weight unit and region
alone, so all texts see the same darts. Darts within a text's weight hit; each hit has one of `k` coordinates and
the one of lowest rank there is the signature's value. Two texts agree in a coordinate with the probability of their
similarity. Only the ranks that are needed to fill all coordinates are looked at, about k ln k darts a text.

Steps: (1) texts with equal words fall into one class, whose smallest doc_id stands for it; (2) classes with an equal
band of `rows` coordinates meet: each is tied to the smallest of its bucket, and what is tied together is a cluster of candidates;
(3) a cluster goes to one task as a cell, where all its texts are compared, first by signature (pairs whose agreement is
4.5 standard errors under 0.8 go), then exactly, unless they are connected already; (4) links become components. A comparison counts the shingles of
both texts, each occurrence of a shingle being a 32-bit mark; a false match adds less than the share of words / 2**32 to a similarity.

Scale: links leave a cell, never pairs: at most one for each text and cell. A cluster of more than `block` bytes has several cells. For such
clusters the ties are verified first, and the texts of the largest part (a group of copies that hold a third of all rows) stay in their home cell;
only texts outside of it visit the cluster's other cells, where they are compared as they stream by. What is shuffled is bands of classes and the marks and
signatures of texts, once by row and, for candidates, once by cell.

Edge cases: null and empty texts, and texts without words, are in no group (each is its own). Repeated rows and equal
doc_ids with equal words fall into one class; several texts under one doc_id belong together. A null doc_id takes no
part: its group is null and it is kept. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.components import components
from .store import dropped, written
from .tokens import forget
from .words import Words, fold, grouped, mix

SHINGLE = 5
#: Ranks under 2**FIRST are one region; above, each region doubles.
FIRST = -6


@dataclass(frozen=True)
class Settings:
    similarity: float = 0.8
    bands: int = 24
    rows: int = 6
    block: int = 4 << 20  # bytes of signatures and marks that a cell holds

    @property
    def floor(self) -> float:
        """The least agreement of signatures at which texts are compared: 4.5 standard errors under the similarity."""
        return self.similarity - 4.5 * (self.similarity * (1 - self.similarity) / (self.bands * self.rows)) ** 0.5


def shingles(words: Words, n_texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, shingle and weight of each distinct shingle, in order of text."""
    h = words.hashes()
    per = words.per_text
    begin = np.cumsum(per) - per
    n = np.maximum(per - SHINGLE + 1, np.minimum(per, 1))
    text = np.repeat(np.arange(n_texts), n)
    at = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n) + begin[text]
    code = np.zeros(len(text), dtype=np.uint64)
    last = (begin + per)[text]
    for k in range(SHINGLE):
        there = at + k < last
        code = mix(code * np.uint64(0x2545F4914F6CDD1D) + np.where(there, h[np.minimum(at + k, max(len(h) - 1, 0))], np.uint64(7))) if len(h) else code
    order = np.lexsort((code, text))
    text, code = text[order], code[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (code[1:] != code[:-1])
    start = np.flatnonzero(new)
    return text[start], code[start], np.diff(np.append(start, len(text)))


def _poisson_table(mean: float) -> np.ndarray:
    p, out, total = np.exp(-mean), [], 0.0
    k = 0
    while total < 1 - 1e-15 and k < 60 + 20 * mean:
        total += p
        out.append(total)
        k += 1
        p *= mean / k
    return np.array(out)


def signatures(text: np.ndarray, item: np.ndarray, weight: np.ndarray, n_texts: int, k: int) -> np.ndarray:
    """DartMinHash of each text, n_texts x k; a text without items has zeros. Weights are positive numbers."""
    signature = np.zeros((n_texts, k), dtype=np.uint64)
    if not len(item):
        return signature
    best = np.full((n_texts, k), np.inf)
    total = np.bincount(text, weights=weight, minlength=n_texts)
    wanted = k * np.log(k) + 2 * k
    top = np.where(total > 0, np.ceil(np.log2(wanted / np.maximum(total, 1e-9))), FIRST).astype(int)
    units = np.ceil(weight).astype(np.int64)
    which = np.repeat(np.arange(len(item)), units)
    unit = np.arange(len(which)) - np.repeat(np.cumsum(units) - units, units)
    seed = mix(item[which] + mix(unit.astype(np.uint64) + np.uint64(1)))
    owner, limit = text[which], weight[which] - unit
    region, active = FIRST, total > 0
    while active.any():
        low, high = (0.0 if region == FIRST else 2.0 ** (region - 1)), 2.0**region
        rows = np.flatnonzero(active[owner])
        cell = mix(seed[rows] ^ np.uint64((region + 64) * 0x9E3779B1))
        count = np.searchsorted(_poisson_table(high - low), (cell >> np.uint64(11)).astype(np.float64) * 2.0**-53, side="right")
        dart = np.repeat(cell, count)
        dart_row = np.repeat(rows, count)
        nth = np.arange(len(dart)) - np.repeat(np.cumsum(count) - count, count)
        dart = mix(dart + (nth + 1).astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
        more = mix(dart + np.uint64(0x632BE59BD9B4E019))
        hit = (more & np.uint64(0xFFFFFF)).astype(np.float64) * 2.0**-24 < limit[dart_row]
        dart, dart_row, more = dart[hit], dart_row[hit], more[hit]
        rank = low + (high - low) * (more >> np.uint64(24)).astype(np.float64) * 2.0**-40
        place = owner[dart_row] * k + (dart % np.uint64(k)).astype(np.int64)
        order = np.argsort(-rank, kind="stable")
        place, rank, dart = place[order], rank[order], dart[order]
        better = rank < best.ravel()[place]
        signature.ravel()[place[better]] = dart[better]
        best.ravel()[place[better]] = rank[better]
        region += 1
        active &= (top >= region) | np.isinf(best).any(axis=1)
    return signature


def _describe(batches: Iterator[pd.DataFrame], s: Settings) -> Iterator[pd.DataFrame]:
    forget()
    k = s.bands * s.rows
    for batch in batches:
        at = 0
        for group in grouped(batch["text"]):
            n = len(group)
            text, code, weight = shingles(Words(group), n)
            signature = signatures(text, code, weight, n, k)
            banded = signature.reshape(n, s.bands, s.rows)
            band = np.zeros((n, s.bands), dtype=np.uint64)
            for r in range(s.rows):
                band = mix(band * np.uint64(0x2545F4914F6CDD1D) + banded[:, :, r])
            band = mix(band + np.arange(s.bands, dtype=np.uint64)).view(np.int64)
            short = (signature >> np.uint64(32)).astype(np.uint8)  # the lowest bits name the coordinate
            found = marks(text, code, weight, n)
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].iloc[at : at + n].astype("Int64").array,
                    "row": batch["row"].to_numpy()[at : at + n],
                    "words": [_digest(b" ".join(one.split())) for one in group],
                    "bands": list(band),
                    "signature": [x.tobytes() for x in short],
                    "marks": found,
                    "size": np.array([len(x) + k for x in found], dtype=np.int32),
                }
            )
            at += n


def _digest(words: bytes) -> bytes | None:
    return hashlib.blake2b(words, digest_size=16).digest() if words else None


def weights_of(text: str | None) -> dict[bytes, int]:
    """Shingles and how often each occurs, as a plain dictionary."""
    words = fold(text).split()
    out: dict[bytes, int] = {}
    for i in range(max(1, len(words) - SHINGLE + 1) if words else 0):
        key = b" ".join(words[i : i + SHINGLE])
        out[key] = out.get(key, 0) + 1
    return out


def similarity(a: dict[bytes, int], b: dict[bytes, int]) -> float:
    both = sum(min(n, b[x]) for x, n in a.items() if x in b)
    return both / (sum(a.values()) + sum(b.values()) - both) if a and b else 0.0


def marks(text: np.ndarray, code: np.ndarray, weight: np.ndarray, n_texts: int) -> list[bytes]:
    """For each text a sorted array of 32-bit marks, one for each occurrence of each shingle: the k-th occurrence has a mark of
    its own, so the marks that two texts share are the sum of the smaller counts."""
    nth = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
    text, mark = np.repeat(text, weight), mix(np.repeat(code, weight) + nth.astype(np.uint64) * np.uint64(0x632BE59BD9B4E019))
    both = np.sort(text.astype(np.uint64) << np.uint64(32) | mark >> np.uint64(32))
    ends = np.cumsum(np.bincount(text, minlength=n_texts)) * 4
    data = (both & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()
    return [data[x:y] for x, y in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


def _near(one: np.ndarray, others: list[np.ndarray], least: float) -> np.ndarray:
    """Which of the other texts' marks are near duplicates of one's."""
    sizes = np.array([len(x) for x in others])
    good = np.minimum(sizes, len(one)) >= least * np.maximum(sizes, len(one))
    chosen = np.flatnonzero(good)
    if len(chosen):
        flat = np.concatenate([others[j] for j in chosen])
        there = one[np.minimum(np.searchsorted(one, flat), len(one) - 1)] == flat
        both = np.add.reduceat(there.astype(np.int64), np.cumsum(sizes[chosen]) - sizes[chosen])
        good[chosen] = both / (len(one) + sizes[chosen] - both) >= least
    return good


def _compare(batches: Iterator[pd.DataFrame], least: float) -> Iterator[pd.DataFrame]:
    for batch in batches:
        a, b = ([np.frombuffer(x, "<u4") for x in batch[c]] for c in ("marks_a", "marks_b"))
        keep = np.array([bool(_near(x, [y], least)[0]) for x, y in zip(a, b, strict=True)], dtype=bool)
        yield batch.loc[keep, ["a", "b"]]


class _Cell:
    """The held texts of a cell. A text's part is its component as far as it is known; texts of one part are never compared."""

    def __init__(self, rows: pd.DataFrame, s: Settings):
        self.least, self.floor = s.similarity, s.floor
        self.ids, self.home, self.major = (rows[c].to_numpy() for c in ("doc_id", "home", "major"))
        self.signature = np.frombuffer(b"".join(rows["signature"]), dtype=np.uint8).reshape(len(rows), -1)
        self.marks = [np.frombuffer(x, "<u4") for x in rows["marks"]]
        names, self.part = np.unique(rows["part"].to_numpy(), return_inverse=True)
        self.number = {name: k for k, name in enumerate(names.tolist())}
        self.root = np.arange(len(names))
        self.links: list[tuple[int, int]] = []

    def _link(self, part: int, others: np.ndarray, signature: np.ndarray, marks: np.ndarray, doc: int) -> None:
        """Links a text to those of others (positions) that it is near to, each part once."""
        others = others[self.root[self.part[others]] != self.root[part]]
        if len(others):
            others = others[(self.signature[others] == signature).mean(axis=1) >= self.floor]
        if len(others):
            for j in others[_near(marks, [self.marks[j] for j in others], self.least)].tolist():
                old, new = self.root[self.part[j]], self.root[part]
                if old != new:
                    self.links.append((int(self.ids[j]), doc))
                    self.root[self.root == old] = new

    def within(self) -> None:
        for i in range(len(self.ids) - 1):
            self._link(self.part[i], np.arange(i + 1, len(self.ids)), self.signature[i], self.marks[i], int(self.ids[i]))

    def visit(self, rows: pd.DataFrame) -> None:
        """Texts whose home is another cell. Two texts outside of the largest part meet in the lower of their homes."""
        for doc, part, home, signature, mark in zip(rows["doc_id"].tolist(), rows["part"].tolist(), rows["home"].tolist(), rows["signature"], rows["marks"], strict=True):
            if part not in self.number:
                self.number[part] = len(self.root)
                self.root = np.append(self.root, len(self.root))
            meets = np.flatnonzero(self.major | (self.home < home))
            self._link(self.number[part], meets, np.frombuffer(signature, np.uint8), np.frombuffer(mark, "<u4"), doc)


def _cells(batches: Iterator[pd.DataFrame], s: Settings) -> Iterator[pd.DataFrame]:
    """Links between the texts of each cell. Rows come sorted by cell, held texts first; only held ones are kept in memory."""
    waiting: list[pd.DataFrame] = []
    cell: _Cell | None = None
    now: int | None = None

    def settle() -> list[tuple[int, int]]:
        nonlocal cell, waiting
        if cell is None and waiting:
            cell = _Cell(pd.concat(waiting, ignore_index=True), s)
            cell.within()
        waiting = []
        found = [] if cell is None else cell.links
        if cell is not None:
            cell.links = []
        return found

    for batch in batches:
        out: list[tuple[int, int]] = []
        key, visits = batch["cell"].to_numpy(), batch["visits"].to_numpy()
        starts = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (visits[1:] != visits[:-1]))))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(batch)], strict=True):
            if key[a] != now:
                out += settle()
                cell, now = None, key[a]
            rows = batch.iloc[a:b]
            if not visits[a]:
                waiting.append(rows)
            else:
                out += settle()
                if cell is not None:
                    cell.visit(rows)
                    out += settle()
        yield pd.DataFrame(out, columns=["a", "b"]).astype("int64")
    last = settle()
    if last:
        yield pd.DataFrame(last, columns=["a", "b"]).astype("int64")


def _verified(pairs: DataFrame, described: DataFrame, s: Settings) -> DataFrame:
    """Those pairs that are near duplicates. described: doc_id and marks, each doc_id once."""
    two, one = (described.select(F.col("doc_id").alias(x), F.col("marks").alias(f"marks_{x}")) for x in "ba")
    return pairs.join(two, "b").join(one, "a").mapInPandas(lambda it: _compare(it, s.similarity), "a long, b long")


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, group_id (the smallest doc_id of its group) and kept (whether it stands for the group) of every row."""
    s = settings
    source = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    columns = "doc_id long, row long, words binary, bands array<long>, signature binary, marks binary, size int"
    described = written(source.mapInPandas(lambda it: _describe(it, s), columns), "described")
    # Texts of a class have the same bands and marks; the row with its smallest doc_id stands for it.
    usable = described.where("words IS NOT NULL AND doc_id IS NOT NULL")
    of_words = usable.groupBy("words").agg(F.min(F.struct("doc_id", "row")).alias("first"), F.first("bands").alias("bands"), F.first("size").alias("size"))
    classes = written(of_words.select("words", "first.doc_id", "first.row", "bands", "size"), "classes")
    banded = classes.select("doc_id", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("doc_id").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    pairs = written(banded.join(buckets, "band").where("doc_id != a").select("a", F.col("doc_id").alias("b")).distinct(), "pairs")
    clusters = components(pairs).withColumnsRenamed({"node": "doc_id", "component": "cluster"})
    asked = classes.join(clusters, "doc_id").select("doc_id", "row", "cluster", F.col("size").cast("long").alias("size"))
    sizes = asked.groupBy("cluster").agg(F.ceil(F.sum("size") / s.block).cast("int").alias("blocks"))
    placed = written(asked.join(sizes, "cluster"), "placed")
    texts = described.select("row", "signature", "marks")

    wide = placed.where("blocks > 1").select("doc_id", "row", "cluster", "size")
    star = None
    if wide.isEmpty():
        parts = placed.select("*", F.col("doc_id").alias("part"), F.lit(False).alias("major"))
    else:
        # Clusters of several blocks: links to each bucket's smallest first, so that their largest part need not go from block to block.
        theirs = written(texts.join(wide, "row").groupBy("doc_id").agg(F.min("marks").alias("marks")), "wide")
        star = written(_verified(pairs.join(theirs.select(F.col("doc_id").alias("a")), "a", "left_semi"), theirs, s), "links")
        known = components(star).withColumnsRenamed({"node": "doc_id", "component": "part"})
        parts = placed.join(known, "doc_id", "left").withColumn("part", F.coalesce("part", "doc_id"))
        by_size = wide.join(known, "doc_id").groupBy("cluster", "part").agg(F.sum("size").alias("size"))
        most = by_size.groupBy("cluster").agg(F.max(F.struct("size", "part")).getField("part").alias("most"))
        parts = parts.join(most, "cluster", "left").withColumn("major", F.coalesce(F.col("part") == F.col("most"), F.lit(False))).drop("most")
    home = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    dealt = parts.withColumn("home", home).withColumn("block", F.explode(F.when(F.col("major"), F.array("home")).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))))
    dealt = dealt.select("doc_id", "row", "part", "major", "home", F.xxhash64("cluster", "block").alias("cell"), (F.col("home") != F.col("block")).alias("visits"))
    cells = texts.join(dealt.hint("merge"), "row").drop("row").repartition("cell").sortWithinPartitions("cell", "visits")
    links = written(cells.mapInPandas(lambda it: _cells(it, s), "a long, b long"), "links")
    dropped(pairs, placed, clusters)
    found = components(links if star is None else links.unionByName(star))
    grouped_classes = classes.select("words", F.col("doc_id").alias("class")).join(found.withColumnRenamed("node", "class"), "class", "left")
    grouped_ = described.select("doc_id", "words").join(grouped_classes, "words", "left")
    group = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "class", "doc_id"))
    return grouped_.select("doc_id", group.alias("group_id"), F.coalesce(group == F.col("doc_id"), F.lit(True)).alias("kept"))


def one_of_each_group(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """docs, with all their columns, with one row of each group of near duplicates: one row with the smallest doc_id."""
    dropped = near_duplicates(docs, settings).where(~F.col("kept")).select("doc_id").distinct()
    name = "_row_of_text"
    while name in docs.columns:
        name += "_"
    left = docs.where("doc_id IS NOT NULL").join(dropped, "doc_id", "left_anti").select(*docs.columns)
    # Repeated rows of a kept document are copies as well; the join has dealt them by doc_id already.
    copies = Window.partitionBy("doc_id", F.md5("text")).orderBy(F.lit(1))
    once = left.withColumn(name, F.row_number().over(copies)).where(F.col(name) == 1).drop(name)
    return once.unionByName(docs.where("doc_id IS NULL"))

"""Toxicity by maximal scoring segments.

Learning: every labelled row that is not held out adds its words, and their prefixes of 4, 5 and 6 bytes, to a
table of exact counts by 64-bit key (how many toxic and how many clean texts hold them). A token's log-odds come from a chain of
Dirichlet priors: the toxic share of a prefix is the prior mean of the next longer prefix, up to the word, so
an unseen word gets the score of what is known of its beginning.

Scoring: a linear scan over a text's token scores finds all maximal scoring segments (Ruzzo and Tompa). Every occurrence
makes segments; to a segment's score a word that comes again inside it adds once, as the sum over the maximal segments left so. A
segment of score s in a text of n words has the expected number E = K n exp(-L s) in clean text; L and K are
fitted to the segments of clean labelled texts (exceedances over a threshold). Segments with E under
`significance` are passages; the text's evidence sums their -ln E and a logistic curve turns it into a score.

Scale: the counts grow with the corpus (distinct keys, about its square root). Up to `broadcast_keys` keys (16 bytes each) they are
sent to all tasks: two passes over the texts without a shuffle of texts. A larger table stays where it is: the distinct keys of each
distinct text are joined with it, and each text meets its own counts, with the same scores. The curve and the tail are fitted
on at most about `sample` labelled rows, picked by a hash of doc_id, each scored without its own counts.

Edge cases: null and empty texts have no words, hence no evidence, and get the score of no evidence. Repeated
rows are scored one by one. Several labels for one doc_id: the highest counts. Null labels teach nothing. With
no labels of both kinds the score is the toxic share of the labels (0 if there are none). A null doc_id is
scored and is not held out. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import dropped, small_batches, written
from .words import Words, grouped, mix

#: Prefix lengths in bytes; the word itself comes last.
LEVELS = (4, 5, 6, None)
#: The parts of `known`, as columns of arrays.
_CARRIED = ("known.key AS keys", "known.clean AS clean", "known.toxic AS toxic")
RESULT = "score double, n_passages int, passage_start int, passage_end int, passage_score double, passages array<struct<start:int,end:int,score:double>>"


@dataclass(frozen=True)
class Settings:
    prior: float = 5.0  # weight of each Dirichlet prior, in texts
    drift: float = 0.7  # taken from every token, so that clean text falls
    tail: float = 0.5  # segments over this score are used to fit the tail
    significance: float = 0.05
    sample: int = 20_000  # labelled rows for tail and curve
    small_labels: int = 2_000_000  # up to so many labels are broadcast
    broadcast_keys: int = 8_000_000  # up to so many keys, their counts are broadcast (128 MB)


@dataclass
class Counts:
    """Clean and toxic texts of each key; keys are sorted."""

    keys: np.ndarray
    clean: np.ndarray
    toxic: np.ndarray

    def of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(keys)), np.zeros(len(keys))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[at] == keys
        return np.where(hit, self.clean[at], 0.0), np.where(hit, self.toxic[at], 0.0)


@dataclass
class Model:
    counts: Counts | None  # None: each row carries those of its own text
    share: float
    settings: Settings
    rate: float = 1.0
    volume: float = 1e-3
    curve: tuple[float, float] = (-2.0, 1.0)
    constant: float | None = None


def held_out(doc_id: Column | str = "doc_id") -> Column:
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _keys(words: Words, only: np.ndarray | slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
    """The key of each word (or of those at `only`) at each level, and whether the level is there: a word no longer than a
    prefix is itself the last level."""
    keys = np.stack([mix(words.hashes(level)[only] + np.uint64(k * 0x51ED2701)).view(np.int64) for k, level in enumerate(LEVELS)])
    there = np.stack([np.ones(keys.shape[1], dtype=bool) if level is None else words.length[only] > level for level in LEVELS])
    return keys, there


def first_of_text(keys: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Whether a key comes for the first time in its text."""
    first = np.zeros(len(keys), dtype=bool)
    first[np.unique(mix(keys.view(np.uint64)) ^ mix(text + 1), return_index=True)[1]] = True
    return first


def _summed(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    clean, toxic = (np.bincount(back, np.concatenate([p[k] for p in parts]), len(keys)).astype(np.int64) for k in (1, 2))
    return keys, clean, toxic


def _count(batches: Iterator[pd.DataFrame], held: int = 1_000_000) -> Iterator[pd.DataFrame]:
    """Counts of a task's texts, summed up in memory; beyond `held` keys they go out, and the shuffle sums them."""
    parts: list = []
    for batch in batches:
        for label in (0, 1):
            for group in grouped(batch["text"][batch["label"] == label]):
                words = Words(group)
                keys, there = _keys(words)
                once = [k[t][first_of_text(k[t], words.text[t])] for k, t in zip(keys, there, strict=True)]  # texts, not repeats in a text, are counted
                found, n = np.unique(np.concatenate(once), return_counts=True)
                parts.append((found, n * (1 - label), n * label))
                if sum(len(p[0]) for p in parts) > held:
                    parts = [_summed(parts)]
                    if len(parts[0][0]) > held // 2:
                        yield from _rows(parts.pop())
    if parts:
        yield from _rows(_summed(parts))


def _rows(counts: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Iterator[pd.DataFrame]:
    for start in range(0, len(counts[0]), 100_000):
        yield pd.DataFrame({c: x[start : start + 100_000] for c, x in zip(("key", "clean", "toxic"), counts, strict=True)})


def _wanted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The keys of each text."""
    for batch in batches:
        for at, text in zip(batch["at"], batch["text"], strict=True):
            for group in grouped([text]):
                keys, there = _keys(Words(group))
                yield pd.DataFrame({"at": at, "key": np.unique(keys[there])})


def _with_counts(rows: DataFrame, m: Model, table: DataFrame) -> DataFrame:
    """rows with a column `known`: null, or the counts of their text's keys where these are not broadcast."""
    if m.counts is not None or m.constant is not None:
        return rows.withColumn("known", F.lit(None).cast("array<struct<key:long,clean:long,toxic:long>>"))
    at = F.xxhash64("text")
    wanted = rows.where("text IS NOT NULL").select(at.alias("at"), "text").mapInPandas(_wanted, "at long, key long").distinct()
    known = wanted.join(table, "key").groupBy("at").agg(F.collect_list(F.struct("key", "clean", "toxic")).alias("known"))
    return rows.join(known, at == known["at"], "left").drop("at")


def _counts(m: Model, keys: pd.Series, clean: pd.Series, toxic: pd.Series) -> Counts:
    """Those of the model, or those that a batch of rows carries."""
    if m.counts is not None:
        return m.counts
    there = keys.notna()
    one, two, three = (np.concatenate([np.zeros(0), *x[there]]) if k else np.concatenate([np.zeros(0, dtype=np.int64), *x[there]]) for k, x in enumerate((keys, clean, toxic)))
    one, first = np.unique(one, return_index=True)
    return Counts(one, two[first], three[first])


def _scores(words: Words, counts: Counts, share: float, s: Settings, own: int | None = None) -> np.ndarray:
    """A score for each word. own: the label whose counts hold these texts; they are taken out again."""
    _, first, back = np.unique(words.hashes(), return_index=True, return_inverse=True)
    keys, there = _keys(words, first)
    p = np.full(len(first), share)
    for k in range(len(LEVELS)):
        good, bad = counts.of(keys[k])
        if own is not None:
            bad, good = np.maximum(0, bad - own), np.maximum(0, good - (1 - own))
        p = np.where(there[k], (bad + s.prior * p) / (bad + good + s.prior), p)
    return (np.log(p / (1 - p)) - np.log(share / (1 - share)) - s.drift)[back]


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in linear time.

    Sums before and after each positive token are kept. A new segment is joined with the nearest earlier one
    that starts lower and ends lower, until none does.
    """
    after = np.cumsum(scores)
    found: list[list] = []  # start, end, sum before, sum after, index of the nearest earlier one that starts lower
    for i in np.flatnonzero(scores > 0).tolist():
        high = float(after[i])
        start, low, end = i, high - float(scores[i]), i + 1
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j = found[j][4]
            if j < 0 or found[j][3] >= high:
                found.append([start, end, low, high, j])
                break
            start, low = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, high - low) for a, b, low, high, _ in found]


def _expected(x: float, n: int, m: Model) -> float:
    """The logarithm of E."""
    return np.log(m.volume * max(n, 1)) - m.rate * x


def _evidence(found: list[float], n: int, m: Model) -> tuple[float, int]:
    e = [_expected(x, n, m) for x in found]
    strong = [x for x in e if x < np.log(m.settings.significance)]
    return float(np.log1p(sum(-x for x in strong) if strong else max(0.0, -min(e, default=0.0)))), len(strong)


def once_each(scores: np.ndarray, keys: np.ndarray, drift: float) -> list[tuple[int, int, float]]:
    """Maximal scoring segments of all places; to a segment's score, a key's first place in it adds and others only take the drift."""
    out, names = [], keys.tolist()
    for a, b, x in segments(scores):
        if len(set(names[a:b])) == b - a:
            out.append((a, b, x))
            continue
        again = np.ones(b - a, dtype=bool)
        again[np.unique(keys[a:b], return_index=True)[1]] = False
        out.append((a, b, sum(y for _, _, y in segments(np.where(again, -drift, scores[a:b])))))
    return out


def _per_text(words: Words, scores: np.ndarray, drift: float) -> Iterator[list[tuple[int, int, float]]]:
    ends, keys = np.cumsum(words.per_text), words.hashes()
    for a, b in zip(ends - words.per_text, ends, strict=True):
        yield once_each(scores[a:b], keys[a:b], drift)


def _sampled(batches: Iterator[pd.DataFrame], shared) -> Iterator[pd.DataFrame]:
    m: Model = shared.value
    for batch in batches:
        counts = _counts(m, batch["keys"], batch["clean"], batch["toxic"])
        for label in (0, 1):
            for group in grouped(batch["text"][batch["label"] == label]):
                words = Words(group)
                scores = _scores(words, counts, m.share, m.settings, own=label)
                yield pd.DataFrame({"label": label, "n": words.per_text, "found": [[x for _, _, x in one] for one in _per_text(words, scores, m.settings.drift)]})


def _fit(m: Model, rows: pd.DataFrame) -> None:
    s = m.settings
    clean = rows[rows["label"] == 0]
    over = [x - s.tail for found in clean["found"] for x in found if x > s.tail]
    if len(over) >= 20:
        m.rate = 1 / max(np.mean(over), 1e-3)
        m.volume = len(over) / max(1, clean["n"].sum()) * np.exp(m.rate * s.tail)
    x = np.array([_evidence(list(found), n, m)[0] for found, n in zip(rows["found"], rows["n"], strict=True)])
    y = rows["label"].to_numpy(float)
    a, b = 0.0, 0.0
    for _ in range(50):  # Newton steps for a logistic curve with a weak prior
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        g, w = np.array([(y - p).sum() - 1e-3 * a, ((y - p) * x).sum() - 1e-2 * b]), p * (1 - p)
        h = np.array([[w.sum() + 1e-3, (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + 1e-2]])
        step = np.linalg.solve(h, g)
        a, b = a + np.clip(step[0], -2, 2), b + np.clip(step[1], -2, 2)
        if abs(step).max() < 1e-6:
            break
    m.curve = (float(a), float(max(b, 0)))


def learn(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> tuple[Model, DataFrame]:
    """The model, fitted on the labelled rows of docs that are not held out, and the table of counts (key, clean, toxic)."""
    s = settings
    small_batches(docs.sparkSession)
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    n = known.count()
    known = F.broadcast(known) if n <= s.small_labels else known
    taught = docs.select("doc_id", "text").where(~held_out()).join(known, "doc_id").select("doc_id", "text", "label")
    table = written(taught.select("text", "label").mapInPandas(_count, "key long, clean long, toxic long").groupBy("key").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "toxicity_counts")
    size, good, bad = table.agg(F.count("*"), F.coalesce(F.sum("clean"), F.lit(0)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    m = Model(None, bad / (bad + good) if bad + good else 0.0, s)
    if not bad or not good:
        m.constant = m.share
        return m, table
    if size <= s.broadcast_keys:
        found = table.select("key", F.col("clean").cast("float"), F.col("toxic").cast("float")).toArrow()
        order = np.argsort(keys := found["key"].to_numpy())
        m.counts = Counts(keys[order], found["clean"].to_numpy()[order], found["toxic"].to_numpy()[order])
        del found, keys, order
        dropped(table)
    shared = docs.sparkSession.sparkContext.broadcast(m)
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, s.sample / max(n, 1)))
    rows = _with_counts(taught.where(part).select("text", "label"), m, table).selectExpr("text", "label", *_CARRIED)
    _fit(m, rows.mapInPandas(lambda it: _sampled(it, shared), "label int, n long, found array<double>").toPandas())
    return m, table


def score_column(m: Model, spark) -> Column:
    """A struct of RESULT for each row's text and known; passage_* tell the strongest passage, in words, or are null; passages holds all, in order."""
    shared = spark.sparkContext.broadcast(m)

    @F.pandas_udf(RESULT)
    def score(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts, *known in batches:
            out, counts = [], _counts(m, *known)
            for group in grouped(texts):
                words = Words(group)
                scores = _scores(words, counts, m.share, m.settings) if m.constant is None else np.zeros(len(words))
                for n, found in zip(words.per_text, _per_text(words, scores, m.settings.drift), strict=True):
                    x, strong = _evidence([v for _, _, v in found], n, m)
                    best = max(found, key=lambda f: f[2], default=None) if strong else None
                    p = m.constant if m.constant is not None else 1 / (1 + np.exp(-(m.curve[0] + m.curve[1] * x)))
                    passages = [{"start": a, "end": b, "score": v} for a, b, v in found if _expected(v, n, m) < np.log(m.settings.significance)] if strong else []
                    out.append((p, strong, *(best or (None, None, None)), passages))
            frame = pd.DataFrame(out, columns=["score", "n_passages", "passage_start", "passage_end", "passage_score", "passages"])
            yield frame.astype({"passage_start": "Int32", "passage_end": "Int32", "n_passages": "int32", "passage_score": "float64"})

    return score(F.col("text"), F.col("known.key"), F.col("known.clean"), F.col("known.toxic"))


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score, predicted, the strongest passage and all significant passages of every row of docs."""
    m, table = learn(docs, labels, settings)
    rows = _with_counts(docs.select("doc_id", "text"), m, table)
    scored = rows.select("doc_id", held_out().alias("held_out"), score_column(m, docs.sparkSession).alias("r"))
    return scored.select("doc_id", "held_out", "r.score", (F.col("r.score") >= 0.5).cast("int").alias("predicted"), "r.n_passages", "r.passage_start", "r.passage_end", "r.passage_score", "r.passages")


def without_toxic(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of docs, with all their columns, whose score is under 0.5."""
    m, table = learn(docs, labels, settings)
    rows = _with_counts(docs.select("text", F.struct("*").alias("row")), m, table)
    return rows.select("row", score_column(m, docs.sparkSession)["score"].alias("score")).where("score < 0.5").select("row.*")

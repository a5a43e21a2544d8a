"""The rows of each stage of the corpus pipeline against a plain version of it, and odd rows through all of it."""

from __future__ import annotations

import re
import shutil

import numpy as np
import pytest

pytest.importorskip("sparkloom.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkloom.llm import line_dedup, near_dup, toxicity
from sparkloom.llm.words import words_of

SF = "/root/testdata/sf0.001"
MASK = (1 << 64) - 1
SPACE = rb"[ \t\n\x0b\x0c\r]"


def spread_bits(x: int) -> int:
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def word_hash(word: bytes) -> int:
    out, power = 0, 1
    for b in word:
        out, power = (out + (b + 1) * power) & MASK, power * line_dedup.BASES[0] & MASK
    return out


def slow_chunks(text: bytes, window: int = 12, least: int = 12) -> list[tuple[int, int]]:
    """Start and stop of each chunk, one word after another, by the rule of line_dedup's docstring."""
    words = [(m.start(), m.end()) for m in re.finditer(rb"[^ \t\n\x0b\x0c\r]+", text)]
    lines = {0} | {m.end() for m in re.finditer(rb"\n", text)}
    order = []
    for k, (a, b) in enumerate(words):
        pa, pb = words[k - 1] if k else (a, b)
        if k == 0 or b"\n" in text[pb:a]:
            order.append((0, 0, k))
            continue
        pair = spread_bits((word_hash(text[pa:pb]) * line_dedup.BASES[1] + word_hash(text[a:b])) & MASK) >> 33
        order.append((1 if text[pb - 1 : pb] in (b".", b"!", b"?") else 2, pair, k))
    begins = set(lines)
    for k in range(len(words) - window + 1):
        kind, _, at = min(order[k : k + window])
        if kind:
            begins.add(words[at][0])
    edges = sorted(x for x in begins | {len(text)} if x <= len(text))
    out = []
    for i in range(len(edges) - 1):
        for j in range(i + 2, len(edges)):
            if sum(edges[i] <= a < edges[j] for a, _ in words) >= least:
                out.append((edges[i], edges[j]))
                break
    return out


def plain_line_dedup(rows: list[tuple[int, str]]) -> dict[int, str]:
    first: dict[bytes, tuple] = {}
    data = [(d, t.encode()) for d, t in sorted(rows)]
    spans = {d: slow_chunks(t) for d, t in data}
    for d, t in data:
        for a, b in spans[d]:
            first.setdefault(t[a:b].strip(b" \t\n\x0b\x0c\r"), (d, a))
    out = {}
    for d, t in data:
        keep, at = [], 0
        for a, b in spans[d]:
            if first[t[a:b].strip(b" \t\n\x0b\x0c\r")] != (d, a):
                keep.append(t[at : max(a, at)])
                at = max(at, b)
        out[d] = (b"".join(keep) + t[at:]).decode()
    return out


def plain_groups(texts: dict[int, str]) -> dict[int, int]:
    weights = {d: near_dup.weights_of(t) for d, t in texts.items()}
    group = {d: d for d in texts}
    for a in texts:
        for b in texts:
            if a < b and group[a] != group[b] and near_dup.similarity(weights[a], weights[b]) >= 0.8:
                low, high = sorted((group[a], group[b]))
                group = {d: low if g == high else g for d, g in group.items()}
    return group


def test_each_stage_against_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    bad = {r["doc_id"] for r in toxicity.toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet")).where("score >= 0.5").collect()}
    now = stage["toxicity"](spark, docs, SF)
    assert now.columns == docs.columns and {r["doc_id"] for r in now.collect()} == {r["doc_id"] for r in docs.collect()} - bad

    rows = {r["doc_id"]: r["text"] for r in now.collect()}
    expected = plain_line_dedup(list(rows.items()))
    expected = {d: t for d, t in expected.items() if t.strip() or t == rows[d]}
    cut = stage["line_dedup"](spark, now, SF)
    assert cut.columns == docs.columns and {r["doc_id"]: r["text"] for r in cut.collect()} == expected
    assert {r["doc_id"]: r["n_chars"] for r in cut.collect()} == {d: len(t) for d, t in expected.items()}
    assert any(t != rows[d] for d, t in expected.items())

    group = plain_groups(expected)
    kept = stage["near_dedup"](spark, cut, SF)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {d for d, g in group.items() if d == g}

    texts = {r["doc_id"]: words_of(r["text"]) for r in kept.collect()}
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words_of(r["text"])
        windows |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(w) for w in windows}
    clean = {d for d, w in texts.items() if not any(tuple(w[k : k + n]) in windows for n in sizes for k in range(len(w) - n + 1))}
    left = stage["decontamination"](spark, kept, SF)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == clean

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lengths = {r["doc_id"]: len(plain.encode(r["text"], add_special_tokens=False).ids) + 1 for r in left.collect()}
    packed = stage["packing"](spark, left, SF).collect()
    got: dict[int, int] = {}
    bins: dict[int, list] = {}
    for r in packed:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert got == lengths
    for places in bins.values():
        assert [a for a, _ in sorted(places)] == np.cumsum([0, *[n for _, n in sorted(places)]]).tolist()[:-1] and sum(n for _, n in places) <= 2048
    assert len(corpus_pipeline.run(spark, SF).collect()) == len(packed)


def test_near_copies_in_raw_documents_go_as_the_operator_says(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    alone = {r["doc_id"] for r in near_dup.near_duplicates(docs).where("kept").collect()}
    assert {r["doc_id"] for r in dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, SF).collect()} == alone
    assert len(alone) < docs.count()


def test_chunks_of_odd_texts_against_the_slow_ones():
    r = np.random.default_rng(5)
    for _ in range(200):
        text = bytes(r.choice(list(b"ab.  \n\t"), r.integers(0, 400)).tolist())
        found = line_dedup.chunks([b"other words before, ", text, b"and after"], line_dedup.Settings())
        own = found["text"] == 1
        assert list(zip(found["start"][own].tolist(), found["stop"][own].tolist(), strict=True)) == slow_chunks(text), text


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows_and_empty_tables_go_through(spark, tmp_path, empty):
    long = " ".join(f"w{k}" for k in range(30_000))
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, long, "en", "s", len(long)), (None, "some text of no one", "en", None, 5), (4, "same words here", "en", "s", 15), (4, "same words here", "en", "s", 15), (5, " \n\t ", "en", "s", 5)]
    docs = spark.createDataFrame([] if empty else rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.select("*", *[F.lit(1).alias(c) for c in ("removed", "score", "hits", "key", "row", "sequence_id", "_open")])
    docs.coalesce(1).write.parquet(f"file://{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        table = spark.read.parquet(f"{SF}/{name}.parquet")
        (table.limit(0) if empty else table).write.parquet(f"file://{tmp_path}/{name}.parquet")
    now = spark.read.parquet(f"file://{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, f"file://{tmp_path}")
        assert now.columns == docs.columns, name
    out = corpus_pipeline.run(spark, f"file://{tmp_path}").collect()
    assert sorted({-1 if r["doc_id"] is None else r["doc_id"] for r in out}) == ([] if empty else [-1, 1, 2, 3, 4, 5])
    assert sum(r["doc_id"] == 4 for r in out) == (0 if empty else 1)
    shutil.rmtree(tmp_path)

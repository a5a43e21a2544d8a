"""Operators on small tables: plain versions, round trips, and the edge cases that the docstrings name."""

from __future__ import annotations

import hashlib
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("sparkloom.llm")
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkloom.llm import chat, decontaminate, html, licenses, line_dedup, near_dup, neighbours, packing, token_files, toxicity
from sparkloom.llm.tokens import Encoder
from sparkloom.llm.words import words_of

SF = "/root/testdata/sf0.001"
WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(["ba", "ke", "lu", "mi", "or", "en"]) for _ in range(r.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, an empty text, a very long one, ties, repeated rows and extra columns."""
    long = prose(1, 30_000)
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, long, "en", "s", len(long)), (None, "some text of no one", "en", None, 5), (4, "same words here", "en", "s", 15), (4, "same words here", "en", "s", 15), (5, " \n\n\t ", "en", "s", 5)]
    return spark.createDataFrame(rows, DOCS).select("*", F.lit(1).alias("score"), F.lit("x").alias("hits"), F.lit(0).alias("key"), F.lit(2).alias("component"), F.lit(0).alias("removed"))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0, None), (2, None, 1), (3, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")


def test_toxicity_learns_and_counts_unseen_endings(spark):
    r = random.Random(3)
    rows, known = [], []
    for i in range(600):
        bad = i % 4 == 0
        words = prose(i, 60).split()
        if bad:
            words[r.randrange(60)] = "grumbl" + r.choice(["ed", "ing", "er", "y", "ish", str(i)])
            words[r.randrange(60)] = "snark" + str(i)
        rows.append((i, " ".join(words)))
        known.append((i, 0, int(bad)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(known, "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in toxicity.toxicity(docs, marks).collect()}
    assert len(out) == 600 and all(out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in out)
    held = [i for i in out if out[i]["held_out"]]
    assert np.mean([out[i]["predicted"] == (i % 4 == 0) for i in held]) > 0.95
    assert all(out[i]["passage_start"] is not None for i in held if out[i]["predicted"])
    assert {r["doc_id"] for r in toxicity.without_toxic(docs, marks).collect()} == {i for i in out if not out[i]["predicted"]}
    joined = toxicity.toxicity(docs, marks, toxicity.Settings(broadcast_keys=0)).collect()  # counts too many to send
    assert len(joined) == 600 and all(abs(r["score"] - out[r["doc_id"]]["score"]) < 1e-6 and r["passages"] == out[r["doc_id"]]["passages"] for r in joined)


def test_toxicity_counts_are_exact(spark):
    rows = [(i, f"{prose(i, 30)} {prose(i % 7, 20)}") for i in range(200)]
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, 0, i % 3 // 2) for i, _ in rows], "doc_id long, quality int, toxic int")
    m, table = toxicity.learn(docs, marks, toxicity.Settings(broadcast_keys=0))
    plain = Counter()
    for i, text in rows:
        if zlib.crc32(str(i).encode()) % 5:
            plain.update((level, part, i % 3 // 2) for level, part in {(k or 0, w[:k]) for w in words_of(text) for k in (4, 5, 6, None) if k is None or len(w) > k})
    pairs = Counter()
    for (level, part, label), n in plain.items():
        pairs[level, part] += n * (1000 if label else 1)
    assert sorted((r["clean"], r["toxic"]) for r in table.collect()) == sorted((n % 1000, n // 1000) for n in pairs.values())


def test_toxic_passages_of_words_that_came_before_are_all_found(spark):
    bad = [f"{a}{b}" for a, b in zip(["grum", "snark", "blar", "vext", "drog", "quim"], ["ble", "ish", "gar", "ing", "lam", "pok"], strict=True)]
    r, rows, known = random.Random(4), [], []
    for i in range(600):
        words = prose(i, 60).split()
        if i % 4 == 0:
            words[20:26] = r.sample(bad, 6)
        rows.append((i, " ".join(words)))
        known.append((i, 0, int(i % 4 == 0)))
    single = " ".join(f"{prose(2000 + k, 40)} {w}" for k, w in enumerate(bad))
    dense = " ".join(bad)
    rows.append((5000, f"{single} {prose(2100, 60)} {dense} {prose(2101, 60)} {dense} {prose(2102, 60)}"))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(known, "doc_id long, quality int, toxic int")
    found = toxicity.toxicity(docs, marks).where("doc_id = 5000").first()
    starts = [246 + 60, 246 + 60 + 6 + 60]
    for start in starts:
        assert any(p["start"] <= start and p["end"] >= start + 6 for p in found["passages"]), found
    assert found["n_passages"] == len(found["passages"]) >= 2
    keys = np.array([1, 1, 1, 2], dtype=np.uint64)
    assert [(a, b, round(x, 6)) for a, b, x in toxicity.once_each(np.array([2.0, 2.0, 2.0, 3.0]), keys, 0.5)] == [(0, 4, 4.0)]


def test_segments_are_the_maximal_ones():
    def slow(x: list[float]) -> list[tuple[int, int]]:
        """All maximal segments: the best one, then those on either side of it."""
        best = max(((sum(x[a:b]), -(b - a), a, b) for a in range(len(x)) for b in range(a + 1, len(x) + 1)), default=None)
        if best is None or best[0] <= 0:
            return []
        _, _, a, b = best
        return slow(x[:a]) + [(a, b)] + [(b + c, b + d) for c, d in slow(x[b:])]

    r = random.Random(5)
    for _ in range(200):
        x = [r.uniform(-2, 1.5) for _ in range(r.randint(0, 14))]
        assert [(a, b) for a, b, _ in toxicity.segments(np.array(x))] == slow(x)


def test_toxicity_edges(spark, odd, labels):
    out = toxicity.toxicity(odd, labels).collect()
    assert len(out) == 7 and all(0 <= r["score"] <= 1 for r in out)
    assert toxicity.without_toxic(odd, labels).columns == odd.columns
    assert toxicity.toxicity(odd.limit(0), labels.limit(0)).count() == 0


def test_decontamination_against_plain_search(spark):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    items = {r["item_id"]: words_of(r["text"]) for r in bench.collect()}
    windows = {(i, tuple(w[k : k + 10])) for i, w in items.items() if w for k in range(max(1, len(w) - 9))}
    expected = {}
    for r in docs.collect():
        w = words_of(r["text"])
        hit, found = set(), set()
        for i, win in windows:
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k : k + len(win)]) == win:
                    hit |= set(range(k, k + len(win)))
                    found.add(str(i))
        expected[r["doc_id"]] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    for blocks in (200_000, 20):  # one block, and several
        got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in decontaminate.decontamination(docs, bench, blocks).collect()}
        assert got == expected
    assert any(x[4] for x in expected.values())


def test_decontamination_edges(spark, odd):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "same words"), (3, "same words"), (None, "no one")], "item_id long, text string")
    out = decontaminate.decontamination(odd, bench).collect()
    assert sorted((r["doc_id"] or -1, r["n_hit"], r["n_items"]) for r in out) == [(-1, 2, 1), (1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 2, 1), (4, 2, 1), (5, 0, 0)]
    kept = decontaminate.without_benchmark(odd, bench)
    assert kept.columns == odd.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 5]
    assert decontaminate.decontamination(odd, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.decontamination(odd.limit(0), bench).count() == 0


def test_near_duplicates_against_all_pairs(spark):
    base = [prose(i, 120).split() for i in range(12)]
    rows, n = [], 0
    r = random.Random(9)
    for k, words in enumerate(base):
        for c in range(6):
            other = list(words)
            for _ in range([0, 0, 1, 2, 3, 8][c]):
                other[r.randrange(120)] = f"new{r.randrange(10**6)}"
            rows.append((n, " ".join(other)))
            n += 1
    chain = prose(99, 160).split()  # a chain: neighbours are alike, its ends are not
    for c in range(8):
        rows.append((n, " ".join(chain)))
        n += 1
        chain = chain[7:] + [f"c{c}x{j}" for j in range(7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    weights = [near_dup.weights_of(t) for _, t in rows]
    group = list(range(n))
    for a in range(n):
        for b in range(a):
            if near_dup.similarity(weights[a], weights[b]) >= 0.8 and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = [low if g == high else g for g in group]
    for settings in (near_dup.Settings(), near_dup.Settings(block=4000, bands=60, rows=3)):  # the second has many chance meetings, and clusters of several cells
        out = {r["doc_id"]: r for r in near_dup.near_duplicates(docs, settings).collect()}
        assert {i: out[i]["group_id"] for i in out} == dict(enumerate(group))
    assert sorted(r["doc_id"] for r in near_dup.one_of_each_group(docs).collect()) == sorted(set(group))
    assert all(out[i]["kept"] == (group[i] == i) for i in out)


def test_dart_signatures_estimate_weighted_similarity():
    r = np.random.default_rng(1)
    item = r.integers(0, 2**63, 400).astype(np.uint64)
    a, b = r.uniform(0.2, 3, 400), r.uniform(0.2, 3, 400)
    b[:300] = a[:300]
    text = np.repeat([0, 1], 400)
    s = near_dup.signatures(text, np.concatenate([item, item]), np.concatenate([a, b]), 2, 2000)
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((s[0] == s[1]).mean() - true) < 0.04


def test_near_duplicates_edges(spark, odd):
    out = near_dup.near_duplicates(odd).collect()
    assert sorted((r["doc_id"] or -1, r["group_id"], r["kept"]) for r in out) == [(-1, None, True), (1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (4, 4, True), (5, 5, True)]
    kept = near_dup.one_of_each_group(odd)
    assert kept.columns == odd.columns and sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 1, 2, 3, 4, 5]
    assert near_dup.near_duplicates(odd.limit(0)).count() == 0


@pytest.mark.parametrize(("path", "layout"), [(WORD, "words"), (BYTE, "bytes")])
def test_ids_are_those_of_the_library(path, layout):
    mine, plain = Encoder(path, layout), Tokenizer.from_file(path)
    parts = ["a", "word", "Word,", "'s", "'LL", " ", "  ", "\n", "\n\n", " \n", "\t", "é", "ÉCOLE", "ß", "é", "<|endoftext|>", "***", "12", "3.5", "你好", " ", "\xa0", "\x1c", "\x85", "İ", "Σ", "\r\n", "ﬁ", "×", "🙂", "<|"]
    r = random.Random(2)
    for _ in range(3000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 12)))
        assert np.frombuffer(mine.ids(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_blocks_round_trip():
    r = np.random.default_rng(4)
    for n in (0, 1, 127, 128, 129, 5000):
        for high in (1, 2, 300, 50_000, 2**32 - 1):
            ids = r.integers(0, high, n, dtype=np.uint32)
            if n > 10:
                ids[::37] = high - 1
            data, start = token_files.encode_blocks(ids)
            assert (token_files.decode_blocks(np.frombuffer(data, np.uint8), start) == ids).all()


def test_token_files_round_trip(spark, odd, tmp_path):
    plain = Tokenizer.from_file(WORD)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(odd.where("doc_id IS NULL OR doc_id != 3").select("doc_id", "text"))
    rows = token_files.token_files(docs, WORD).orderBy("start").collect()
    expected = {}
    for r in docs.collect():
        ids = [*plain.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        expected.setdefault(r["doc_id"], []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    at = 0
    for r in rows:
        assert r["start"] == at and (r["n_tokens"], r["ids_crc32"]) in expected[r["doc_id"]]
        at += r["n_tokens"]
    order = [-1 if r["doc_id"] is None else r["doc_id"] for r in rows]
    assert order == sorted(order) and len(rows) == docs.count()
    manifest = token_files.write_tokens(docs, f"file://{tmp_path}/out", WORD)
    whole = token_files.TokenFile(manifest[0]["path"])
    assert (whole.ids(300, 700) == whole.ids(0, whole.tokens)[300:700]).all()
    assert token_files.token_files(docs.limit(0), WORD).count() == 0


def test_license_scan(spark, odd):
    mit = licenses.LICENSES["MIT"]
    noisy = mit.replace("charge", "cost").replace("publish,", "print,")
    rows = [(1, prose(1, 50) + " " + noisy + " " + prose(2, 50)), (2, prose(3, 80)), (3, "Released under the MIT License.\nx\nReleased under the MIT license"), (4, " ".join(mit.split()[:60]))]
    out = licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {(r["doc_id"], r["license"]): r for r in out}
    assert set(found) == {(1, "MIT"), (3, "MIT-notice")} and sum(r["doc_id"] == 3 for r in out) == 2
    r = found[1, "MIT"]
    assert r["first_word"] == 50 and r["end_word"] == 50 + len(words_of(mit)) and 0.97 < r["coverage"] < 1
    assert licenses.license_scan(odd).count() == 0 and licenses.license_scan(odd.limit(0)).count() == 0


def test_variants_of_licenses_are_told_apart():
    scanner = licenses.Scanner(licenses.LICENSES, licenses.Settings())
    around = prose(11, 40), prose(12, 40)
    for name, text in licenses.LICENSES.items():
        found = scanner.scan(words_of(f"{around[0]} {text} {around[1]}"))
        assert [(x[0], x[1]) for x in found] == [(name, 1.0)] and found[0][2] == 40, name

    def names(text: str) -> list[str]:
        return [x[0] for x in scanner.scan(words_of(f"{around[0]} {text} {around[1]}"))]

    assert names("This work is licensed under the GNU General Public License, version 4") == []
    assert names("Licensed under CC BY-NC-SA 3.0") == []
    header = licenses.LICENSES["GPL-3.0-header"]
    assert names(header.replace("GNU General", "GNU Lesser General")) == ["LGPL-3.0-header"]
    assert names(header.replace("GNU General", "GNU Affero General")) == ["AGPL-3.0-header"]
    assert names(header.replace("version 3", "version 5")) == []
    mit = licenses.LICENSES["MIT"].split()
    padded = [x for k, w in enumerate(mit) for x in ([w, f"added{k}"] if k % 5 == 0 else [w])]
    assert names(" ".join(padded)) == []  # a fifth of added words


def test_alignment_rises_in_both():
    r = random.Random(8)
    for _ in range(300):
        a = [r.choice("abcdefgh").encode() for _ in range(r.randint(0, 12))]
        b = [r.choice("abcdefgh").encode() for _ in range(r.randint(0, 12))]
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:], strict=False))
    assert len(licenses.align(list(b"abcdef"), list(b"abxdef"))) == 5


def test_alignment_against_longest_common_subsequences():
    def longest(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        return best[-1][-1]

    r = random.Random(18)
    for _ in range(300):
        words = [f"w{k}".encode() for k in range(14)]  # each once: anchors are all that is common
        a, b = r.sample(words, r.randint(0, 12)), r.sample(words, r.randint(0, 12))
        assert len(licenses.align(a, b)) == longest(a, b)
        c, d = ([r.choice(words[:5]) for _ in range(r.randint(0, 12))] for _ in range(2))
        assert len(licenses.align(c, d)) <= longest(c, d)


def test_license_finds_with_ties_repeats_and_long_texts(spark):
    mit, isc = licenses.LICENSES["MIT"], licenses.LICENSES["ISC"]
    twice = f"{prose(1, 30)} {mit} {prose(2, 40)} {mit} {prose(3, 20)}"
    long = f"{prose(4, 20_000)} {isc} {prose(5, 5000)}"
    rows = [(1, twice), (2, long), (3, mit), (3, mit), (None, mit)]
    out = sorted((r["doc_id"] or -1, r["license"], r["first_word"]) for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string").withColumn("license", F.lit("x"))).collect())
    n = len(words_of(mit))
    assert out == [(-1, "MIT", 0), (1, "MIT", 30), (1, "MIT", 70 + n), (2, "ISC", 20_000), (3, "MIT", 0), (3, "MIT", 0)]


def test_line_dedup_cuts_passages_wherever_they_stand(spark):
    passage = ". ".join(prose(1000 + k, 18).capitalize() for k in range(4)) + "."
    rows = [(i, f"{prose(i, 30)}.\n{prose(50 + i, 9 + i)}.\n{passage}\n{prose(90 + i, 25)}.") for i in range(6)] + [(9, prose(500, 200))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = {r["doc_id"]: r for r in line_dedup.line_dedup(docs).collect()}
    assert out[0]["text"] == rows[0][1] and out[9]["text"] == rows[-1][1]
    for i in range(1, 6):
        assert out[i]["text"] == rows[i][1].replace(passage + "\n", "") and out[i]["n_removed"] >= 1, i


def test_line_dedup_against_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    s, first = line_dedup.Settings(), {}
    rows = [(r["doc_id"], r["text"].encode()) for r in docs.orderBy("doc_id").collect()]
    found = line_dedup.chunks([t for _, t in rows], s)  # all texts side by side
    data = b"".join(t for _, t in rows)
    spans = [[] for _ in rows]
    for k, a, b, x, y in zip(*[found[c].tolist() for c in ("text", "start", "stop", "begin", "end")], strict=True):
        assert rows[k][1][a:b].strip() == data[x:y] and len(data[x:y].split()) >= s.min_words - 1
        spans[k].append((a, b, data[x:y]))
    for (d, t), own in zip(rows, spans, strict=True):
        alone = line_dedup.chunks([t], s)
        assert list(zip(alone["start"].tolist(), alone["stop"].tolist(), strict=True)) == [(a, b) for a, b, _ in own]
        for a, _, body in own:
            first.setdefault(body, (d, a))
    expected = {}
    for (d, t), own in zip(rows, spans, strict=True):
        keep, at = [], 0
        for a, b, body in own:
            if first[body] != (d, a):
                keep.append(t[at : max(a, at)])
                at = max(at, b)
        expected[d] = (b"".join(keep) + t[at:]).decode()
    assert {r["doc_id"]: r["text"] for r in line_dedup.line_dedup(docs).collect()} == expected
    assert any(expected[d] != t.decode() for d, t in rows)


@pytest.mark.parametrize("place", ["{a} {p}", "{a} {p} {b}", "{p} {b}", "{a}\n{p}\n{b}"])
def test_passages_inside_lines_are_found(spark, place):
    passage = " ".join(prose(700 + k, 14).capitalize() + "." for k in range(5))
    rows = [(i, place.format(a=prose(i, 40).capitalize() + ".", b=prose(60 + i, 40).capitalize() + ".", p=passage)) for i in range(8)]
    out = {r["doc_id"]: r["text"] for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[0] == rows[0][1]
    for i in range(1, 8):
        assert len(out[i].split()) <= len(rows[i][1].split()) - 35
        assert prose(i, 40).split()[5] in out[i] or "{a}" not in place


@pytest.mark.parametrize("n", [51, 60, 75, 100])
def test_passages_without_punctuation_share_chunks_at_all_offsets(n):
    passage = prose(800 + n, n)

    def digests(before: str, after: str) -> set:
        found = line_dedup.chunks([f"{before}{passage}{after}".encode()], line_dedup.Settings())
        return set(found["digest"].tolist())

    other = digests(prose(1, 7) + " ", " " + prose(2, 30))
    for offset in range(41):
        assert digests(prose(100 + offset, offset) + " " * (offset > 0), " " + prose(200 + offset, 25)) & other, offset


def test_unpunctuated_passages_after_other_words_of_their_sentence_go(spark):
    passage = prose(820, 60)
    rows = [(i, f"{prose(830 + i, 5 + 3 * i)} {passage} {prose(860 + i, 20)}") for i in range(8)]
    out = {r["doc_id"]: r for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[0]["text"] == rows[0][1]
    for i in range(1, 8):
        assert out[i]["n_removed"] >= 1 and len(out[i]["text"].split()) <= len(rows[i][1].split()) - 12, i


def test_line_dedup_edges(spark, odd):
    out = line_dedup.without_repeats(odd)
    assert out.columns == odd.columns and out.count() == 7 and out.dtypes == odd.dtypes
    assert sorted((r["doc_id"] or -1, r["text"] is None) for r in out.collect()) == [(-1, False), (1, True), (2, False), (3, False), (4, False), (4, False), (5, False)]
    assert line_dedup.without_repeats(odd.limit(0)).count() == 0


def test_html_keeps_the_article(spark):
    page = (
        "<html><head><title>T</title><script>var a='</p>';</script></head><body><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>"
        "<div class='cookie-notice'>We use cookies, many, many, cookies.</div><div class=sidebar><p>Side text, long enough, to score some points, really.</p></div>"
        "<div id=content><h2>Head &amp; line</h2><p>First   paragraph,\n with <b>bold</b>text &eacute;<p>Second one, after<br>a break"
        "<form><input><button>Send</button></form><div class='comments'><p>Nice post, thanks, really, so good.</p></div></div><footer>&copy; us</footer>"
    )
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (3, "u", "")]
    out = html.html_text(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))).collect()
    assert [r["text"] for r in out] == ["Head & line First paragraph, with boldtext é Second one, after a break", "", "", ""]
    assert out[0]["n_chars"] == len(out[0]["text"]) and len(out) == 4
    assert html.html_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_html_keeps_parts_beside_the_best_container():
    long = "".join(f"<p>{prose(900 + k, 60)}, {prose(930 + k, 30)}.</p>" for k in range(13))
    menu = "<div><a href=/a>One</a> <a href=/b>Two</a></div>"
    article = html.extract(f"<body>{menu}<article><h1>Title</h1><div>{long}</div><div><p>Closing words.</p></div></article></body>")
    plain = html.extract(f"<body>{menu}<div><h1>Title</h1><div><div>{long}</div><ul><li>Item</ul><table><tr><td>Cell</table><div><p>Closing words.</p></div></div></div></body>")
    beside = html.extract(f"<body><div><h1>Title</h1>{menu}<div>{long}</div><div><p>Closing words.</p></div></div></body>")
    for found in (article, plain, beside):
        assert found.startswith("Title ") and found.endswith("Closing words.") and "One" not in found
    assert "Item" in plain and "Cell" in plain


def test_html_reads_pages_inside_a_form():
    text = "<p>" + prose(950, 80) + ".</p>"
    small = "<form><input><label>Name</label><p>Send us your name</p></form>"
    assert html.extract(f"<body><form id=aspnetForm><div>{text}{text}</div></form></body>") == " ".join([prose(950, 80) + "."] * 2)
    assert html.extract(f"<body><form role=form><h1>Title</h1>{text}</form></body>").startswith("Title ")
    assert "Send" not in html.extract(f"<body><div>{text}{small}</div></body>")
    assert html.extract(f"<body><form hidden>{text}</form></body>") == ""


STORY = "<p>" + "This is a long story about things, with commas, and much more text than before. " * 6 + "</p>"


@pytest.mark.parametrize(
    "page",
    [
        f'<article class="post comments-open">{STORY}</article>', f'<article class="post reply-to-editor">{STORY}</article>', f'<div class="post side-by-side">{STORY}</div>',
        f'<div id="content" class="share-enabled">{STORY}</div>', f'<section class="legal-news">{STORY}</section>', f"<form>{STORY}</form>", f'<main><div class="discussion">{STORY}</div></main>',
        f'<article><div class="search-and-rescue">{STORY}</div></article>', f'<div class="sidebar">{STORY}</div>',
    ],
)
def test_html_names_weigh_but_do_not_hide_the_article(page):
    assert html.extract(f"<body><div class=ad>Buy, now</div>{page}</body>") == " ".join(STORY[3:-4].split())


@pytest.mark.parametrize("name", ["sidebar", "comment-list", "cookie_notice", "relatedPosts", "ad-slot-2", "share-buttons", "site-footer"])
def test_html_side_parts_go(name):
    side = f'<div class="{name}"><p>Side words, many, of them, and more.</p></div>'
    assert "Side" not in html.extract(f"<body><div>{STORY}{side}{STORY}</div></body>")


def test_html_points_and_link_density_against_a_plain_sum():
    page = "<body><div><p>one, two, three</p><p>four <a href=x>five</a></p><div><p>six, seven</p></div></div></body>"
    root = html.parse(page)
    nodes = {(n.tag, k): n for k, n in enumerate(html._score(root))}
    divs = [n for (tag, _), n in nodes.items() if tag == "div"]
    first, second, inner = (html.block_points(t) for t in ("one, two, three", "four five", "six, seven"))
    assert html.block_points("a, b" + "x" * 400) == 1 + 1 + 3
    assert abs(divs[0].points - (first + second + inner * 0.5)) < 1e-9 and abs(divs[1].points - inner) < 1e-9
    assert abs(html._value(divs[0]) - divs[0].points * (1 - 4 / len("one, two, threefourfivesix, seven"))) < 1e-9


def test_html_reads_any_text():
    r = random.Random(5)
    parts = ["<", ">", "!", "[", "]", "<![", "<!--", "-->", "</", "<?", "&#x", "&amp", "<p", "<div class='", "'", '"', "=", "<a href=", "<script>", "</script", "<form>", "<li>", "text, ", "<table><td>", "\x00", "\ud83d", "é", "<!doctype", "<![CDATA["]
    page = "<html><body><nav>x</nav><article><h1>T</h1>" + STORY + "</article><footer>f</footer></body></html>"
    for k in range(10_000):
        text = list(page[: 60 + r.randrange(len(page) - 60)]) if k % 2 else []
        for _ in range(r.randint(1, 8)):
            text.insert(r.randint(0, len(text)), r.choice(parts))
        html.extract("".join(text))


@pytest.mark.parametrize("page", ["<span>" * 100_000 + "x" + "</div>" * 100_000, "<div>" * 50_000 + "<header>" * 50_000 + "x", "<div><b>" + "<i>" * 50_000 + "<hr>" * 50_000 + "</b>" * 50_000, "<div>" * 100_000 + "x", "<ul><li>x" * 50_000, "<span>" * 50_000 + "<div>y</div>" * 50_000])
def test_html_is_linear(page):
    begin = time.process_time()
    html.extract(page)
    assert time.process_time() - begin < 20


def test_packing_places_every_piece(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    rows = packing.pack(packing.pieces(docs, BYTE).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), pool=60).collect()
    plain = Tokenizer.from_file(BYTE)
    assert len(packing.packing(docs, BYTE).collect()) == len(rows)
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        places.sort()
        assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(places, places[1:], strict=False)) and sum(places[-1]) <= 2048
    total = sum(r["length"] for r in rows)
    assert len(by) <= 1.1 * total / 2048 + 1
    for d in docs.where("doc_id IN (0, 3)").collect():
        ids = np.array([*plain.encode(d["text"], add_special_tokens=False).ids, 0], "<u4")
        own = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows if r["doc_id"] == d["doc_id"])
        at = 0
        mine = [x for x in own if zlib.crc32(ids[x[1] : x[1] + x[2]].tobytes()) == x[3]]
        for k, start, n, _ in mine:
            assert start == at and (n == 2048 or k == 0)
            at += n
        assert at == len(ids)
    assert packing.packing(docs.limit(0), BYTE).count() == 0


def test_placing_takes_the_smallest_sum_of_squares():
    r = np.random.default_rng(6)
    for _ in range(30):
        lengths = r.integers(1, 21, 40)
        bins, offsets, gaps = packing.place(lengths, 20)
        open_, level = {}, {}
        for i in np.argsort(-lengths, kind="stable"):
            def total(state):
                n = {}
                for g in state.values():
                    n[g] = n.get(g, 0) + 1
                return sum(v * v for g, v in n.items() if 0 < g)
            options = [total(open_ | {b: g - lengths[i]}) for b, g in open_.items() if g >= lengths[i]] + [total(open_ | {"new": 20 - lengths[i]})]
            b = bins[i]
            chosen = total(open_ | {b: open_.get(b, 20) - lengths[i]})
            assert chosen == min(options)
            assert offsets[i] == 20 - open_.get(b, 20)
            open_[b] = open_.get(b, 20) - lengths[i]
        assert all(open_[b] == gaps[b] for b in open_)


def test_bins_are_opened_for_what_fits_in_none():
    r = np.random.default_rng(7)
    for _ in range(30):
        lengths = r.integers(1, 21, 40)
        bins, offsets, gaps = packing.place(lengths, 20, opens=False)
        open_ = {}
        for i in np.argsort(-lengths, kind="stable"):
            fits = {b: g for b, g in open_.items() if g >= lengths[i]}

            def total(b, g):
                left = [*(x for k, x in open_.items() if k != b), g]
                return sum(left.count(x) ** 2 for x in set(left) if x > 0)

            b, g = bins[i], open_.get(bins[i], 20)
            assert (b in fits) == bool(fits) and offsets[i] == 20 - g
            if fits:
                assert total(b, g - lengths[i]) == min(total(k, x - lengths[i]) for k, x in fits.items())
            open_[b] = g - lengths[i]
        assert all(open_[b] == gaps[b] for b in open_)


def test_packing_is_close_to_the_lower_bound(spark):
    r = np.random.default_rng(8)
    lengths = np.minimum(2048, r.lognormal(6.4, 1.0, 3000).astype(int) + 1)
    table = spark.createDataFrame([(i, int(n), "x") for i, n in enumerate(lengths)], "id long, length long, _open string")
    least = -(-int(lengths.sum()) // 2048)
    for pool in (40_000, 400):
        rows = packing.pack(table.drop("_open"), pool=pool)
        assert rows.count() == 3000 and rows.select("sequence_id").distinct().count() <= (1.002 if pool > 3000 else 1.01) * least + 1


def _exact(rows, k=5):
    good = {i: np.array(v, float) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in (i for i in good if i % 50 == 0):
        near = sorted((-float(v @ good[q] / (np.linalg.norm(v) * np.linalg.norm(good[q]))), i) for i, v in good.items() if i != q and len(v) == len(good[q]))
        out[q] = [i for _, i in near[:k]]
    return out


def test_neighbours_recall_and_edges(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    exact = _exact([(r["vec_id"], r["embedding"]) for r in df.collect()])
    got = {}
    for r in neighbours.nearest(df, settings=neighbours.Settings(tree_rows=150, block_queries=4)).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    hit = sum(len(set(exact[q]) & set(got[q])) for q in exact)
    assert set(got) == set(exact) and hit >= 0.9 * 5 * len(exact)
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, [0.0, 0.0]), (5, None), (6, [float("nan"), 1.0]), (7, [1.0, None]), (None, [1.0, 0.0]), (8, [1.0, 0.0]), (8, [1.0, 0.0]), (50, [1.0, 0.0, 0.0]), (9, [])]
    small = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("vector", F.lit(1))
    out = neighbours.nearest(small).orderBy("rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in out] == [(0, 1, 1), (0, 2, 2), (0, 3, 8), (0, 4, 3)]
    assert neighbours.nearest(small.limit(0)).count() == 0


def test_neighbours_among_scaled_copies_are_the_smallest_ids(spark):
    r = np.random.default_rng(3)
    base = r.standard_normal(16)
    rows = [(i, (base * 2.0 ** ((i * 7) % 23 - 11)).tolist()) for i in range(60)] + [(100 + i, r.standard_normal(16).tolist()) for i in range(200)]
    random.Random(2).shuffle(rows)
    out = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3), settings=neighbours.Settings(leaf=8, tree_rows=70)).orderBy("query_id", "rank").collect()
    assert [x["vec_id"] for x in out if x["query_id"] == 0] == [1, 2, 3, 4, 5]
    assert [x["vec_id"] for x in out if x["query_id"] == 50] == [0, 1, 2, 3, 4]


def test_tree_gives_all_leaves_nearest_first():
    r = np.random.default_rng(4)
    points = r.standard_normal((1000, 4))
    tree = neighbours.Tree(points, 16)
    query = r.standard_normal(4)
    found = list(tree.leaves(query))
    assert sorted(i for _, a, b in found for i in tree.order[a:b].tolist()) == list(range(1000))
    far = [x for x, _, _ in found]
    assert far == sorted(far) and all(((points[tree.order[a:b]] - query) ** 2).sum(axis=1).min() >= x - 1e-12 for x, a, b in found)


def test_chat_round_trip(spark):
    common = [("system", "be kind"), ("user", "hello <|im_end|> <\\|x|> <|endoftext|>")]
    convs = {i: [*common, ("assistant", f"reply {i % 3} é🙂"), ("user", "more"), ("assistant", f"again {i}")][: 3 + i % 3] for i in range(20)}
    convs[-1] = [("user", "<|im_end|><|im_start|>assistant ok"), ("assistant", "<|im_end|><|im_start|>assistant ok")]
    convs[77] = [("odd\nrole\\n<|", None), (None, "")]
    rows = [(c, t, r, x) for c, turns in convs.items() for t, (r, x) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("leaves", F.lit(0)).repartition(3)
    out = {r["conv_id"]: r for r in chat.chat(df, BYTE).collect()}
    assert set(out) == set(convs)
    for c, turns in convs.items():
        turns = [(r or "", x or "") for r, x in turns]
        learned = "".join(x for r, x in turns if r == "assistant")
        assert out[c]["n_turns"] == len(turns)
        assert out[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert (out[c]["loss_chars"], out[c]["loss_sha256"]) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    one = chat.sequences(df.coalesce(1), BYTE).collect()
    nodes = sum(len(r["starts"]) for r in one)
    prefixes = {tuple(turns[: k + 1]) for turns in convs.values() for k in range(len(turns))}
    assert len(prefixes) <= nodes <= len(prefixes) + 3 * len(one)  # shared turns once in a sequence
    for r in one:
        for a, b, above in zip(r["starts"], r["stops"], r["attends"], strict=True):
            before = sum(above[1::2]) - sum(above[0::2])
            assert r["positions"][a:b] == list(range(before, before + b - a))
    assert chat.chat(df.limit(0), BYTE).count() == 0


def test_pipeline_stages_keep_columns_and_clean_documents(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert out.count() > 0
    sizes = corpus_pipeline.run(spark, SF).groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert all(r["n"] <= 2048 for r in sizes)

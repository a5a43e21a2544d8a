"""What op10's tasks hold does not grow with the table: memos of the encoder, sequences that are read at once, Arrow batches."""

import random
import string
import sys

import pandas as pd
import pyarrow.parquet as pq
import pytest

pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

import numpy as np  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from sparkloom.llm import chat, tokens  # noqa: E402

BYTE = public_tokenizers.path("byte_bpe_50k.json")


def _text(r: random.Random, n: int) -> str:
    words = ["".join(r.choices(string.ascii_lowercase + "é", k=r.randrange(4, 12))) + r.choice(["", "", ",", ".", "\n", "  "]) for _ in range(n)]
    return " ".join(words)


def test_memos_of_workers_stay_within_their_bytes():
    r = random.Random(3)
    texts = [_text(r, 400) for _ in range(100)] + ["x" * 50_000]
    batches = [pd.DataFrame({"conv_id": [k], "turns": [[{"role": "assistant", "text": x}]]}) for k, x in enumerate(texts)]
    room = 1 << 20
    tokens.forget()
    rows = pd.concat(chat._grown(iter(batches), BYTE, chat.Settings(max_ids=1, memo_bytes=room)))
    plain = Tokenizer.from_file(BYTE)
    for x, ids in zip(texts, rows["ids"], strict=True):
        assert ids.tolist() == [i for part in ("<|im_start|>assistant\n", x, "<|im_end|>\n") for i in plain.encode(part, add_special_tokens=False).ids]
    held = 0
    for found in tokens._encoders.values():
        for memo in (found._part, found._first, found._rest, found._run):
            held += sum(sys.getsizeof(k) + sys.getsizeof(v) for d in (memo, memo.aside) for k, v in d.items())
    tokens.forget()
    assert 0 < held <= room
    assert len({w for x in texts for w in x.split()}) * 90 > 2 * room  # all of them would not fit


def test_pieces_decode_like_the_library():
    r, plain, pieces = random.Random(4), Tokenizer.from_file(BYTE), tokens.pieces(BYTE)
    assert len(pieces) == plain.get_vocab_size()
    for x in [_text(r, 200), "é🙂 <\\|im_end|>\r\n\t　ñ <|endoftext|> \x00", ""]:
        ids = plain.encode(x, add_special_tokens=False).ids
        assert b"".join(pieces[i] for i in ids).decode() == plain.decode(ids, skip_special_tokens=False) == x
    ids = np.random.default_rng(5).integers(0, len(pieces), 3000).tolist()
    assert b"".join(pieces[i] for i in ids).decode("utf-8", "replace") == plain.decode(ids, skip_special_tokens=False)


def test_few_sequences_are_read_at_once(spark):
    r = random.Random(6)
    words = [_text(r, 1) for _ in range(30_000)]
    rows = [(c, 0, "assistant", " ".join(r.choices(words, k=17_000))) for c in range(30)]  # a sequence each
    batch, tasks = "spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.shuffle.partitions"
    before = {k: spark.conf.get(k) for k in (batch, tasks)}
    try:
        spark.conf.set(tasks, "1")
        spark.conf.set(batch, "64m")
        out = chat.chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1), BYTE)
        assert spark.conf.get(batch) == f"{8 << 20}b"
        assert out.count() == 30
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "positions" not in plan[plan.index("ReadSchema") :]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = [pq.ParquetFile(f.removeprefix("file://")) for f in out.inputFiles()]
    groups = [f.metadata.row_group(k) for f in files for k in range(f.metadata.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 30
    assert len(groups) > len(files) and max(g.total_byte_size for g in groups) < 3 << 20
    ids = sum(len(x) for f in files for x in f.read(["ids"])["ids"])
    positions = sum(g.column(k).total_compressed_size for g in groups for k in range(g.num_columns) if g.column(k).path_in_schema.startswith("positions"))
    assert positions < ids / 20  # bytes: they count upwards

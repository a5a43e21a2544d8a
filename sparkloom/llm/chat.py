"""Chat formatting by prefix trees.

A turn is written as `<|im_start|>role`, a line feed, the text, `<|im_end|>` and a line feed. Control strings
inside texts are escaped reversibly: one backslash more stands between < and | than before. Conversations that begin
with the same turns share them: in the order of their turns, each conversation adds only the turns after those that it
has in common with the one before it, which is the prefix tree in depth-first order. A sequence holds the ids of such
turns side by side; a turn has the positions that it would have in its conversation alone, and the intervals of the
sequence that hold its earlier turns: a token attends to those and to earlier tokens of its own turn.

Scale: conversations are dealt by ranges of their turns' hashes and id, so conversations with a common beginning lie
side by side and a beginning that a third of them share is spread over many tasks. A sequence ends after `max_ids` ids or
`max_conversations`; a tree that is cut there, or where a range ends, has its shared turns once in each sequence.
The sequences are written to the shared folder and read back. Spark reads up to 4,096 rows of a row group at once, which are as many sequences,
so row groups are of a few sequences; the encoder's memos keep to `memo_bytes`, and workers that read give them back.

Edge cases: null text and role are empty. Rows of one conversation with equal turn stand in the order of role and text; null turns
come first. Repeated rows are turns. Rows with a null conv_id are one conversation. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import small_batches, written
from .tokens import encoder, forget, pieces

_CONTROL, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)
SEQUENCE = (
    "ids array<int>, positions array<int>, loss array<boolean>, starts array<int>, stops array<int>, parents array<int>, "
    "attends array<array<int>>, conversations array<long>, leaves array<int>"
)
#: Row groups end after so many bytes, looked at after each row, and so many rows, as equal texts take few bytes. Positions count upwards and
#: are written as differences.
FILES = {
    "parquet.block.size": str(2 << 20),
    "parquet.block.row.count.limit": "32",
    "parquet.page.size.row.check.min": "1",
    "parquet.writer.version": "v2",
    "parquet.enable.dictionary#positions.list.element": "false",
}


@dataclass(frozen=True)
class Settings:
    max_ids: int = 65_536
    max_conversations: int = 4_096
    memo_bytes: int = 96 << 20


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


@dataclass
class _Sequence:
    """Turns in depth-first order; path: the open turns, each (role, text, node)."""

    ids: list[np.ndarray] = field(default_factory=list)
    positions: list[np.ndarray] = field(default_factory=list)
    loss: list[np.ndarray] = field(default_factory=list)
    starts: list[int] = field(default_factory=list)
    stops: list[int] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    attends: list[list[int]] = field(default_factory=list)
    conversations: list[int | None] = field(default_factory=list)
    leaves: list[int] = field(default_factory=list)
    path: list[tuple[str, str, int]] = field(default_factory=list)

    def add(self, conv: int | None, turns: list[tuple[str, str]], ids_of) -> None:
        same = 0
        while same < min(len(turns), len(self.path)) and self.path[same][:2] == turns[same]:
            same += 1
        del self.path[same:]
        for role, text in turns[same:]:
            parts = [np.frombuffer(ids_of(x), dtype="<u4") for x in (f"<|im_start|>{escape_role(role)}\n", escape(text), "<|im_end|>\n")]
            n, start, node = sum(map(len, parts)), self.stops[-1] if self.stops else 0, len(self.starts)
            parent = self.path[-1][2] if self.path else -1
            above = [*self.attends[parent], self.starts[parent], self.stops[parent]] if self.path else []
            if len(above) > 2 and above[-3] == above[-2]:  # two intervals that touch are one
                above[-3:-1] = []
            self.ids += parts
            first = sum(b - a for a, b in zip(above[0::2], above[1::2], strict=True))
            self.positions.append(np.arange(first, first + n))
            self.loss.append(np.repeat([False, role == "assistant", False], list(map(len, parts))))
            self.starts.append(start)
            self.stops.append(start + n)
            self.parents.append(parent)
            self.attends.append(above)
            self.path.append((role, text, node))
        self.conversations.append(conv)
        self.leaves.append(self.path[-1][2] if self.path else -1)

    def row(self) -> dict:
        joined = {c: np.concatenate(getattr(self, c)) if getattr(self, c) else np.zeros(0) for c in ("ids", "positions", "loss")}
        kinds = {"ids": np.int32, "positions": np.int32, "loss": bool}
        return {c: joined[c].astype(kinds[c]) for c in joined} | {c: getattr(self, c) for c in ("starts", "stops", "parents", "attends", "conversations", "leaves")}


def _grown(batches: Iterator[pd.DataFrame], path: str, s: Settings) -> Iterator[pd.DataFrame]:
    ids_of, now = encoder(path, "bytes", s.memo_bytes).ids, _Sequence()
    for batch in batches:
        for conv, turns in zip(batch["conv_id"], batch["turns"], strict=True):
            now.add(None if pd.isna(conv) else int(conv), [(t["role"], t["text"]) for t in turns], ids_of)
            if (now.stops[-1] if now.stops else 0) >= s.max_ids or len(now.leaves) >= s.max_conversations:
                yield pd.DataFrame([now.row()])
                now = _Sequence()
    if now.leaves:
        yield pd.DataFrame([now.row()])


def sequences(conversations: DataFrame, path: str, settings: Settings = Settings()) -> DataFrame:
    """A row of SEQUENCE for each sequence."""
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull().alias("known"), "turn", "role", "text"))).alias("turns"))
    order = F.transform("turns", lambda t: F.xxhash64(t["role"], t["text"])).alias("hashes")
    dealt = turns.select("conv_id", "turns", order).repartitionByRange("hashes", "conv_id").sortWithinPartitions("hashes", "conv_id")
    return dealt.select("conv_id", "turns").mapInPandas(lambda it: _grown(it, path, settings), SEQUENCE)


def _read(batches: Iterator[pd.DataFrame], path: str) -> Iterator[pd.DataFrame]:
    forget()
    piece = pieces(path)

    def shown(ids: np.ndarray) -> str:
        return b"".join([piece[i] for i in ids.tolist()]).decode("utf-8", "replace")

    for batch in batches:
        for r in batch.itertuples():
            ids, loss = np.asarray(r.ids), np.asarray(r.loss, dtype=bool)
            read = []  # of each turn's text: turns, what the digest takes, what is learned, length
            for a, b in zip(r.starts, r.stops, strict=True):
                text, under = shown(ids[a:b]), unescape(shown(ids[a:b][loss[a:b]]))
                turns = [f"{unescape_role(x)}\n{unescape(y)}\n" for x, y in _TURN.findall(text)]
                read.append((len(turns), "".join(turns).encode(), len(under), under.encode(), len(text)))
            node_at = {a: k for k, a in reversed(list(enumerate(r.starts)))}
            out = []
            for conv, leaf in zip(r.conversations, r.leaves, strict=True):
                nodes = []
                if leaf >= 0:  # the turns that the last turn's tokens attend to, and itself
                    for a, b in zip(r.attends[leaf][0::2], r.attends[leaf][1::2], strict=True):
                        k = node_at[a]
                        while a < b:
                            nodes.append(k)
                            a, k = r.stops[k], k + 1
                    nodes.append(leaf)
                said, learned, n_turns, n_learned, n_text = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                for turns, text, under, under_text, length in map(read.__getitem__, nodes):
                    said.update(text)
                    learned.update(under_text)
                    n_turns, n_learned, n_text = n_turns + turns, n_learned + under, n_text + length
                out.append((conv, n_turns, said.hexdigest(), n_learned, learned.hexdigest(), n_text))
            yield pd.DataFrame(out, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]).astype({"conv_id": "Int64"})


def read_digests(rows: DataFrame, path: str) -> DataFrame:
    """What each conversation of written sequences holds, read from ids, attention intervals and loss mask alone."""
    needed = rows.select("ids", "loss", "starts", "stops", "attends", "conversations", "leaves")
    return needed.mapInPandas(lambda it: _read(it, path), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def chat(conversations: DataFrame, path: str) -> DataFrame:
    rows = written(sequences(conversations, path), "chat", FILES)
    small_batches(conversations.sparkSession)
    return read_digests(rows, path)

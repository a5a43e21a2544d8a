"""Token ids by the tokenizers library, with a bounded memo of chunks.

The library's own speed is about 1 MB a second and core; natural text repeats its words, so each worker
keeps the ids of chunks that it has seen. Chunks are cut only where the tokenizer's own rules always cut:

* layout "words" (white space dropped): at a space or a line feed;
* layout "bytes" (a space belongs to the next word): before a space and around a single line feed, if no other
  white space touches them; a text where it does is cut between a non-space and the white space after it.

A chunk of plain characters goes straight to the library's BPE model, part by part; all others, and texts with
the separators U+001C to U+001F, go through the library's whole encoder. Tests hold the ids against encode().
"""

from __future__ import annotations

import re
import sys
from array import array

from tokenizers import Tokenizer

#: Chunks and parts that a worker remembers (about 200 bytes each); beyond that it starts anew.
MEMO = 700_000
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
_PARTS = {
    "words": re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+"),
    "bytes": re.compile("'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^ A-Za-z0-9À-ÖØ-öø-ÿ]+"),
}
#: A word with marks after it: two parts in either layout.
_SIMPLE = re.compile("( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@[-`{-~]*)")
_OTHER_SPACE = re.compile(r"[^\S \n]")
_RUNS = re.compile(r"\s*\S+|\s+")
_ODD = re.compile("[\x1c-\x1f]")


def _visible() -> dict[int, str]:
    """Byte-level tokenizers write a byte as a printable character: itself if it is one, else from U+0100 up."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in own else next(rest)) for b in range(256)}


class _Room:
    """Bytes that the keys and values of some memos take together. When half of them are taken, the memos set aside what they hold, and what
    they had set aside before goes: keys that still come are taken over, the others go at the next turn."""

    def __init__(self, size: int):
        self.size, self.taken, self.memos = size, 0, []

    def take(self, size: int) -> None:
        if self.taken + size > self.size // 2:
            for memo in self.memos:
                memo.aside = dict(memo)
                memo.clear()
            self.taken = 0
        self.taken += size


class _Memo(dict):
    """Values by key, made when first asked for. In a room, a key that takes over a hundredth of it is not kept."""

    def __init__(self, make, room: _Room | None = None):
        super().__init__()
        self.make, self.room, self.aside = make, room, {}
        if room:
            room.memos.append(self)

    def __missing__(self, key):
        found = self.aside.get(key)
        if found is None:
            found = self.make(key)
        if self.room:
            size = sys.getsizeof(key) + sys.getsizeof(found) + 64  # a table's share and rounding
            if size > self.room.size // 100:
                return found
            self.room.take(size)
        self[key] = found
        return found


class Encoder:
    """ids(text): the ids as little-endian unsigned 32-bit integers. room: bytes that its memos
    take together, about; without it each holds MEMO chunks."""

    def __init__(self, path: str, layout: str, room: int | None = None):
        self.tokenizer = Tokenizer.from_file(path)
        self.layout, self._model, self._visible = layout, self.tokenizer.model, _visible()
        self._bound = bound = _Room(room) if room else None
        self._part = _Memo(self._of_part, bound)
        self._first = _Memo(lambda chunk: self._of_chunk(chunk), bound)
        self._rest = _Memo(lambda chunk: self._of_chunk(" " + chunk), bound)
        self._run = _Memo(self._whole, bound)
        self._line = self._whole("\n")

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _of_part(self, part: str) -> bytes:
        shown = part.replace(" ", "Ġ", 1) if part.isascii() else part.encode().decode("latin-1").translate(self._visible)
        return array("I", [t.id for t in self._model.tokenize(shown)]).tobytes()

    def _of_chunk(self, chunk: str) -> bytes:
        simple = _SIMPLE.fullmatch(chunk)
        if simple and "<|" not in chunk:
            word, marks = simple.groups()
            word = word.lower() if self.layout == "words" else word
            if self._bound and not marks:  # the chunk itself is kept
                return self._part.get(word) or self._of_part(word)
            ids = self._part[word]
            return ids + self._part[marks] if marks else ids
        bare = chunk.removeprefix(" ")
        if not _PLAIN.fullmatch(bare) or "<|" in bare:
            return self._whole(chunk)
        return b"".join([self._part[p] for p in _PARTS[self.layout].findall(chunk.lower() if self.layout == "words" else chunk)])

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        for memo in (self._part, self._first, self._rest, self._run):
            if not memo.room and len(memo) > MEMO:
                memo.clear()
        if self.layout == "words":
            return b"".join(map(self._first.__getitem__, text.replace("\n", " ").split(" "))) if not _ODD.search(text) else self._whole(text)
        if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[0].isspace() or text[-1].isspace() or not (text.isascii() and text.replace("\n", "").isprintable()) and _OTHER_SPACE.search(text):
            return self._whole(text) if _ODD.search(text) else b"".join(map(self._run.__getitem__, _RUNS.findall(text)))
        first, rest = self._first.__getitem__, self._rest.__getitem__
        out = []
        for line in text.split("\n"):
            chunks = line.split(" ")
            out.append(first(chunks[0]) + b"".join(map(rest, chunks[1:])))
        return self._line.join(out)


_encoders: dict[tuple[str, str, int | None], Encoder] = {}


def encoder(path: str, layout: str, room: int | None = None) -> Encoder:
    """One for each worker: its memo lasts from task to task."""
    if (path, layout, room) not in _encoders:
        _encoders[path, layout, room] = Encoder(path, layout, room)
    return _encoders[path, layout, room]


def pieces(path: str) -> list[bytes]:
    """The bytes that each id of a byte-level tokenizer stands for."""
    tokenizer, bytes_of = Tokenizer.from_file(path), {c: b for b, c in _visible().items()}
    shown = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
    return [bytes([bytes_of[c] for c in x]) if all(c in bytes_of for c in x) else x.encode() for x in shown]


def forget() -> None:
    """A worker that goes on to other work gives its memos back."""
    _encoders.clear()

"""Words and hashes shared by the text operators.

A word is a maximal run of digits, letters a-z and characters from U+0080 up, after A-Z became a-z. All
other ASCII separates. In UTF-8 every byte of a character from U+0080 up is 0x80 or more, so the rule can
be applied to bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

#: Lower-cases A-Z and turns every separator into a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Texts are hashed together up to so many bytes; a longer text goes alone.
GROUP_BYTES = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15)


def fold(text: str | None) -> bytes:
    """The text as lower-case bytes with separators as spaces. Null has no words."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass").translate(FOLD)


def words_of(text: str | None) -> list[bytes]:
    return fold(text).split()


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (a public finalizer of the splitmix family)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _BASE, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def grouped(texts: Iterable[str | None], limit: int = GROUP_BYTES) -> Iterator[list[bytes]]:
    """Folded texts in groups of bounded size, in order."""
    group: list[bytes] = []
    size = 0
    for text in texts:
        one = fold(text)
        if group and size + len(one) > limit:
            yield group
            group, size = [], 0
        group.append(one)
        size += len(one)
    if group:
        yield group


class Words:
    """The words of a group of folded texts: bytes side by side, and for each word its start, length and text."""

    def __init__(self, group: list[bytes]):
        data = np.frombuffer(b" ".join(group) + b" ", dtype=np.uint8)
        inside = data != 32
        edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
        begin, end = edge[0::2], edge[1::2]
        text_ends = np.cumsum([len(one) + 1 for one in group])
        self.length = (end - begin).astype(np.int64)
        self.text = np.searchsorted(text_ends, begin, side="right")
        self.per_text = np.bincount(self.text, minlength=len(group))
        self._bytes = data[inside].astype(np.uint64) + np.uint64(1)
        self._start = np.cumsum(self.length) - self.length
        self._at = np.arange(len(self._bytes)) - np.repeat(self._start, self.length)

    def __len__(self) -> int:
        return len(self.length)

    def hashes(self, prefix: int | None = None) -> np.ndarray:
        """A 64-bit hash of each word, or of its first `prefix` bytes."""
        if not len(self):
            return np.zeros(0, dtype=np.uint64)
        table = powers(int(self.length.max()))
        values = self._bytes * table[self._at]
        if prefix is not None:
            values[self._at >= prefix] = 0
        return mix(np.add.reduceat(values, self._start) + np.minimum(self.length, prefix or 1 << 40).astype(np.uint64))

"""License scans by patience alignment.

A license's words are aligned with a stretch of a text: words that occur once in both are anchors, the longest
increasing run of anchors is kept, and the gaps between them are aligned in the same way, after equal words at
either end of a gap. The run of aligned words that is best after unaligned words between them are taken off is the find.
Coverage is its aligned words as a share of the license's words or of the find's words, whichever are more.

Variants: version numbers and words like "Lesser" that a license's name holds must be aligned, and a find may not
hold such a word that the license lacks there. Of finds that share words, the one with most aligned words less
unaligned ones (here and in the license) is kept.

Stretches: a license that is covered by at least `coverage` lacks at most m = (1 - coverage) of its words, so
one of any m + 1 of its words must occur in the stretch, near the place where the license has it. The m + 1 rarest by
length are looked up; only around these is anything aligned. Nothing that reaches the coverage within a stretch of
`stretch` times the license's length is missed. Licenses of over `long` words are looked for in texts that are long enough
only, in stretches of near starts together, and aligned only where the stretch holds enough of their words in any order.

Scale: no shuffle; the licenses are a parameter of fixed size. Work is linear in a text's words, plus its candidate stretches.

Edge cases: null and empty texts have no finds. Finds don't share words; the earliest comes first. Repeated rows
have a row for each find each. Other columns are ignored.
"""

from __future__ import annotations

import pkgutil
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import small_batches
from .words import words_of



def _terms(name: str) -> str:
    """A whole license text, up to the end of its terms; the appendix on how to apply them is found as a header."""
    return pkgutil.get_data(__package__, f"license_texts/{name}.txt").decode().split("END OF TERMS AND CONDITIONS")[0]


_GNU = (
    "This {what} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published by the Free Software"
    " Foundation, either version {version} of the License, or (at your option) any later version."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source"
    " code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice,"
    " this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_NAME = (
    " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior"
    " written permission."
)
_BSD_END = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF"
    " MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,"
    " SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS"
    " INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF"
    " THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
#: Public license notices and texts.
LICENSES = {
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": (
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
        " Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS,"
        " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    "MIT-notice": "Released under the MIT License",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the"
        " Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the"
        " Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission"
        " notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR"
        " IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR"
        " COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION"
        " WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and"
        " this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL"
        " IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES"
        " WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE"
        " USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "Apache-2.0": _terms("Apache-2.0"),
    "GPL-2.0": _terms("GPL-2"),
    "GPL-3.0": _terms("GPL-3"),
    "LGPL-2.0": _terms("LGPL-2"),
    "LGPL-2.1": _terms("LGPL-2.1"),
    "LGPL-3.0": _terms("LGPL-3"),
    "MPL-2.0": _terms("MPL-2.0"),
    "CC0-1.0": _terms("CC0-1.0"),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"
        " http://mozilla.org/MPL/2.0/."
    ),
    **{
        f"{name}-notice": f"This work is licensed under the GNU {kind}General Public License, version {version}"
        for name, kind, version in (("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.0", "Library ", "2"), ("LGPL-2.1", "Lesser ", "2.1"), ("LGPL-3.0", "Lesser ", "3"), ("AGPL-3.0", "Affero ", "3"))
    },
    "GPL-2.0-header": _GNU.format(what="program", mark=";", kind="", version="2"),
    "GPL-3.0-header": _GNU.format(what="program", mark=":", kind="", version="3"),
    "LGPL-2.0-header": _GNU.format(what="library", mark=";", kind="Library ", version="2"),
    "LGPL-2.1-header": _GNU.format(what="library", mark=";", kind="Lesser ", version="2.1"),
    "LGPL-3.0-header": _GNU.format(what="library", mark=":", kind="Lesser ", version="3"),
    "AGPL-3.0-header": _GNU.format(what="program", mark=":", kind="Affero ", version="3"),
    "BSD-2-Clause": _BSD + _BSD_END,
    "BSD-3-Clause": _BSD + _BSD_NAME + _BSD_END,
    **{f"CC-{kind}-4.0-notice": f"Licensed under CC {kind} 4.0" for kind in ("BY-NC", "BY-NC-SA", "BY-NC-ND")},
    **{f"CC-{kind}-4.0-short-notice": f"Licensed under CC {kind} 4.0" for kind in ("BY", "BY-SA", "BY-ND")},
    **{
        f"CC-{kind}-4.0{'-long' * kind.startswith('BY-NC')}-notice": f"licensed under a Creative Commons Attribution{words} 4.0 International License"
        for kind, words in (
            ("BY", ""),
            ("BY-SA", "-ShareAlike"),
            ("BY-ND", "-NoDerivatives"),
            ("BY-NC", "-NonCommercial"),
            ("BY-NC-SA", "-NonCommercial-ShareAlike"),
            ("BY-NC-ND", "-NonCommercial-NoDerivatives"),
        )
    },
    "All-rights-reserved": "All rights reserved",
    "CC0-1.0-notice": "dedicated to the public domain under CC0 1.0 Universal",
}


@dataclass(frozen=True)
class Settings:
    coverage: float = 0.9
    stretch: float = 1.25
    long: int = 300  # words


#: Words that tell variants of a license apart.
VARIANTS = {b"lesser", b"affero", b"sa", b"nc", b"nd", b"noncommercial", b"sharealike", b"noderivatives", b"noderivs"}
#: In so many first words of a license its name stands; a license of no more words is a notice, of which every number counts.
NAMED = 80


def _required(words: list[bytes]) -> set[int]:
    """Places of version numbers and variant words in a license's name."""
    out: set[int] = set()
    for i, w in enumerate(words[:NAMED]):
        if w in VARIANTS or w == b"library" and words[i + 1 : i + 2] == [b"general"]:
            out.add(i)
        elif w.isdigit() and (len(words) <= NAMED or i and (words[i - 1] == b"version" or i - 1 in out and words[i - 1].isdigit())):
            out.add(i)
    return out


def _best_run(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The pairs in a row whose number, less the unaligned words of the text between them, is largest."""
    best, best_at, now, start = 0, (0, 0), 0, 0
    for k, (_, j) in enumerate(pairs):
        now -= j - pairs[k - 1][1] - 1 if k else 0
        if now <= 0:
            now, start = 0, k
        now += 1
        if now > best:
            best, best_at = now, (start, k + 1)
    return pairs[slice(*best_at)]


def _increasing(places: list[int]) -> list[int]:
    """Indexes of a longest increasing subsequence, by piles of cards."""
    tops: list[int] = []
    top_index: list[int] = []
    before: list[int] = []
    for i, x in enumerate(places):
        pile = bisect_left(tops, x)
        before.append(top_index[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(x)
            top_index.append(i)
        else:
            tops[pile], top_index[pile] = x, i
    out, i = [], top_index[-1] if top_index else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def align(a: list[bytes], b: list[bytes]) -> list[tuple[int, int]]:
    """Pairs of equal words of a and b, rising in both."""
    out, work = [], [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        at = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        anchors = [(i, at[a[i]]) for i in range(a0, a1) if in_a[a[i]] == 1 and a[i] in at]
        kept = [anchors[k] for k in _increasing([j for _, j in anchors])]
        if not kept:
            continue
        out += kept
        i0, j0 = a0, b0
        for i, j in [*kept, (a1, b1)]:
            work.append((i0, i, j0, j))
            i0, j0 = i + 1, j + 1
    return sorted(out)


class Scanner:
    def __init__(self, licenses: dict[str, str], s: Settings):
        self.s = s
        self.words = {name: words_of(text) for name, text in licenses.items()}
        self.required = {name: _required(words) for name, words in self.words.items()}
        self.bags = {name: Counter(words) for name, words in self.words.items()}
        self.probes: dict[bytes, list[tuple[str, int]]] = {}
        self.long_probes: dict[str, dict[bytes, list[int]]] = {}
        for name, words in self.words.items():
            lacking = int(len(words) * (1 - s.coverage) + 1e-9)
            for i in sorted(range(len(words)), key=lambda i: (-len(words[i]), i))[: lacking + 1]:
                if len(words) > s.long:
                    self.long_probes.setdefault(name, {}).setdefault(words[i], []).append(i)
                else:
                    self.probes.setdefault(words[i], []).append((name, i))

    def _near(self, text: list[bytes]) -> dict[str, list[tuple[int, int]]]:
        """Stretches of the text around each license's rare words."""
        near: dict[str, set[tuple[int, int]]] = {}

        def add(name: str, p: int, i: int) -> None:
            m = len(self.words[name])
            slack = int(m * (self.s.stretch - 1)) + 1
            near.setdefault(name, set()).add((max(0, p - i - slack), min(len(text), p - i + m + slack)))

        if not self.probes.keys().isdisjoint(text):
            for p, word in enumerate(text):
                for name, i in self.probes.get(word, ()):
                    add(name, p, i)
        out = {name: sorted(found) for name, found in near.items()}
        near.clear()
        bag = None
        for name, probes in self.long_probes.items():
            least = self.s.coverage * len(self.words[name]) - 1e-9
            if len(text) < least:
                continue
            bag = bag or Counter(text)
            if (bag & self.bags[name]).total() < least:
                continue
            for p, word in enumerate(text):
                for i in probes.get(word, ()):
                    add(name, p, i)
            near_starts = int(len(self.words[name]) * (self.s.stretch - 1)) // 2 + 1
            joined: list[tuple[int, int]] = []
            for a, b in sorted(near.get(name, ())):
                if joined and a - joined[-1][0] < near_starts:
                    joined[-1] = (joined[-1][0], max(b, joined[-1][1]))
                else:
                    joined.append((a, b))
            out[name] = [(a, b) for a, b in joined if (Counter(text[a:b]) & self.bags[name]).total() >= least]
        return out

    def scan(self, text: list[bytes]) -> list[tuple[str, float, int, int]]:
        """License, coverage, first word and end of each find."""
        found = []
        for name, stretches in self._near(text).items():
            words, end = self.words[name], 0
            for a, b in stretches:
                a = max(a, end)
                if b - a < len(words) * self.s.coverage:
                    continue
                pairs = _best_run(align(words, text[a:b]))
                if len(pairs) < self.s.coverage * len(words) - 1e-9:
                    continue
                if len(pairs) < len(words):  # the stretch may have cut off an end
                    slack = int(len(words) * (self.s.stretch - 1)) + 1
                    wide = max(end, a + pairs[0][1] - slack)
                    again = _best_run(align(words, text[wide : a + pairs[-1][1] + 1 + slack]))
                    if len(again) > len(pairs):
                        a, pairs = wide, again
                first, last = a + pairs[0][1], a + pairs[-1][1] + 1
                coverage = len(pairs) / max(len(words), last - first)
                used = {a + j for _, j in pairs}
                if coverage < self.s.coverage - 1e-9 or not self.required[name] <= {i for i, _ in pairs} or any(text[p] in VARIANTS and p not in used for p in range(first, last)):
                    continue
                end = last
                found.append((2 * len(pairs) - len(words) - (last - first - len(pairs)), name, coverage, first, last, used))
        out, taken = [], set()
        for _, name, coverage, first, last, used in sorted(found, key=lambda x: (-x[0], x[3], x[1])):
            if taken.isdisjoint(used):
                taken |= used
                out.append((name, coverage, first, last))
        return sorted(out, key=lambda x: (x[2], x[0]))


def _scanned(batches: Iterator[pd.DataFrame], licenses: dict[str, str], s: Settings) -> Iterator[pd.DataFrame]:
    scanner = Scanner(licenses, s)
    for batch in batches:
        out = [(doc, *found) for doc, text in zip(batch["doc_id"], batch["text"], strict=True) for found in scanner.scan(words_of(text))]
        yield pd.DataFrame(out, columns=["doc_id", "license", "coverage", "first_word", "end_word"]).astype({"doc_id": "Int64"})


def license_scan(docs: DataFrame, licenses: dict[str, str] = LICENSES, settings: Settings = Settings()) -> DataFrame:
    """doc_id, license, coverage, first_word and end_word of every find."""
    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInPandas(lambda it: _scanned(it, licenses, settings), "doc_id long, license string, coverage double, first_word long, end_word long")

"""Operator 1: license texts found by patience alignment.

Words (letters, digits and non-ASCII bytes; case folded) that are unique to both a passage and a template anchor the
alignment; the longest increasing run of anchors is kept, and the gaps between them are aligned in the same way. The
coverage is the share of the template's words that are matched; the score also counts the words between them that are
not the template's: matched words by words in either.

A template that differs from another one by a name, a version or a variant has telling phrases, which must stand in the
passage word by word, so a license that no template has is not taken for its nearest relative. Licenses that one
sentence or notice tells apart by such words alone come from one rule for all of them.

Passages come from the whole text. A template is looked for in a text that holds its telling phrases and enough of its
words, each counted as often as the template has it, for the coverage asked for; there the same bound is taken for every
window somewhat longer than the template. A sweep aligns the best window of each stretch; after a window that fails by k
words the next one starts k words on, as each word can add one match at most. So the time grows with the text, whatever
it repeats. Of findings that overlap, the one with more matched words stays, then the higher score, then the first
template.

Edge cases: null and empty texts have no finding, nor has an empty table; a license that stands in a text n times is
found n times, in a text of any length; a null doc_id is handed through. Repeated rows are scanned one by one. Columns
besides doc_id and text are not looked at.
"""

from __future__ import annotations

import bisect
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.common import span_hashes, text_chunks, word_spans

MIN_COVERAGE = 0.8
SLACK, SLACK_WORDS = 1.25, 4  # a window has this many times the template's words and some more


class Template(NamedTuple):
    license: str
    form: str  # line, notice or text
    text: str
    telling: tuple[str, ...] = ()  # phrases that must stand in the passage


# Public license texts and the usual notices that name a license.
_GNU = {("GPL", "General"): ("2", "3"), ("LGPL", "Lesser General"): ("2.1", "3"), ("AGPL", "Affero General"): ("3",)}
_GNU_NOTICE = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation, either version {version} of "
    "the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details."
)
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain "
    "the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_THIRD = (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
)


def _templates() -> list[Template]:
    out = [
        Template("Apache-2.0", "line", "Licensed under the Apache License, Version 2.0", ("apache license version 2.0",)),
        Template("Apache-2.0", "line", "Licensed under the Apache License 2.0", ("apache license 2.0",)),
        Template("MPL-2.0", "line", "Licensed under the Mozilla Public License, Version 2.0", ("mozilla public license version 2.0",)),
        *(Template(name, "line", f"Released under the {name} License", (f"{name} license",)) for name in ("MIT", "ISC")),
        Template("CC0-1.0", "line", "Released under CC0 1.0", ("cc0 1.0",)),
    ]
    for (short, kind), versions in _GNU.items():
        name = f"GNU {kind} Public License"
        for v in versions:
            license = f"{short}-{v}" + ".0" * ("." not in v)
            out.append(Template(license, "line", f"This work is licensed under the {name}, version {v}", (f"{name} version {v}",)))
            out.append(Template(license, "notice", _GNU_NOTICE.format(name=name, version=v), (name, f"version {v}")))
    for short, name in _CC.items():
        for v in ("4.0", "3.0"):
            out.append(Template(f"CC-{short}-{v}", "line", f"Licensed under CC {short} {v}", (f"cc {short} {v}",)))
            out.append(Template(f"CC-{short}-{v}", "notice", f"This work is licensed under a Creative Commons {name} {v} International License", (f"creative commons {name} {v}",)))
    return [
        *out,
        Template(
            "Apache-2.0",
            "notice",
            'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at '
            "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
            '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
            ("apache license version 2.0",),
        ),
        Template(
            "MIT",
            "text",
            'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without '
            "restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
            "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
            'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE '
            "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
            "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        ),
        Template(
            "ISC",
            "text",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice "
            'appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. '
            "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
            "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
        ),
        Template("BSD-2-Clause", "text", _BSD),
        Template("BSD-3-Clause", "text", _BSD + _BSD_THIRD, ("neither the name",)),
        Template("MPL-2.0", "notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.", ("mozilla public license", "2.0")),
    ]


TEMPLATES = _templates()

_BLANK = np.ones(256, bool)
for _a, _b in ((48, 57), (65, 90), (97, 122), (128, 255)):
    _BLANK[_a : _b + 1] = False

FOUND = "doc_id long, occurrence int, license string, form string, matched int, coverage double, score double, first_word long, last_word long"


def hashed_words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words = word_spans(buf, off, _BLANK)
    return span_hashes(buf, words.start, words.end), words.off


def template_words(text: str) -> list[int]:
    buf = np.frombuffer(text.encode(), np.uint8)
    return hashed_words(buf, np.array([0, len(buf)]))[0].tolist()


# ------------------------------------------------------------------ patience alignment


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, ordered by their first, whose second rises."""
    tops: list[int] = []
    top_at: list[int] = []
    back = [-1] * len(pairs)
    for i, (_, j) in enumerate(pairs):
        pile = bisect.bisect_left(tops, j)
        back[i] = top_at[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(j)
            top_at.append(i)
        else:
            tops[pile], top_at[pile] = j, i
    out, i = [], top_at[-1] if top_at else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def align(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Matched positions of two word lists, rising in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        anchors = increasing([(i, place[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in place])
        last = (a0, b0)
        for i, j in anchors:
            out.append((i, j))
            todo.append((last[0], i, last[1], j))
            last = (i + 1, j + 1)
        if anchors:
            todo.append((last[0], a1, last[1], b1))
    return sorted(out)


# ------------------------------------------------------------------ scanning


class Finding(NamedTuple):
    first: int
    last: int
    matched: int
    score: float
    template: int


class Scanner:
    def __init__(self, templates: list[Template], coverage: float):
        self.templates = templates
        words = [template_words(t.text) for t in templates]
        self.vocabulary = np.unique(np.array([x for w in words for x in w], np.uint64))
        self.size = len(self.vocabulary)  # the code of a word that no template has
        self.words = [self.codes(np.array(w, np.uint64)).tolist() for w in words]
        self.need = [max(1, int(np.ceil(coverage * len(w)))) for w in words]
        self.window = [int(SLACK * len(w)) + SLACK_WORDS for w in words]
        self.times = np.array([np.bincount(w, minlength=self.size + 1) for w in self.words])
        phrases = [[self.codes(np.array(template_words(p), np.uint64)) for p in t.telling] for t in templates]
        if any((p == self.size).any() for own in phrases for p in own):
            raise ValueError("a telling phrase holds a word that no template has")
        # Each phrase once, whatever templates share it.
        self.phrases = {p.tobytes(): p for own in phrases for p in own}
        self.telling = [[p.tobytes() for p in own] for own in phrases]

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), self.size - 1)
        return np.where(self.vocabulary[at] == hashes, at, self.size)

    def candidates(self, codes: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, int, dict[bytes, np.ndarray]]]:
        """(document, template, places of phrases in all documents) where the whole document may hold the template."""
        n = len(off) - 1
        known = np.flatnonzero(codes < self.size)
        doc = np.searchsorted(off, known, "right") - 1
        own = codes[known]
        counts = np.bincount(doc * self.size + own, minlength=n * self.size).reshape(n, self.size)
        order = np.argsort(own, kind="stable")
        edge = np.searchsorted(own[order], np.arange(self.size + 1))
        places: dict[bytes, np.ndarray] = {}
        held: dict[bytes, np.ndarray] = {}
        for name, phrase in self.phrases.items():
            rare = int(np.argmin(np.diff(edge)[phrase]))
            start = known[order[edge[phrase[rare]] : edge[phrase[rare] + 1]]] - rare
            start = start[(start >= 0) & (start + len(phrase) <= len(codes))]
            for j, code in enumerate(phrase):
                start = start[codes[start + j] == code]
            at = np.searchsorted(off, start, "right") - 1
            inside = start + len(phrase) <= off[at + 1]
            places[name] = start[inside]
            held[name] = np.zeros(n, bool)
            held[name][at[inside]] = True
        for t, need in enumerate(self.need):
            may = np.logical_and.reduce([held[p] for p in self.telling[t]]) if self.telling[t] else np.ones(n, bool)
            own = np.flatnonzero(may)
            if len(own):
                enough = np.minimum(counts[own], self.times[t][:-1]).sum(1) >= need
                yield from ((int(d), t, places) for d in own[enough])

    def bounds(self, codes: np.ndarray, t: int) -> np.ndarray:
        """For each window of a text, how many of the template's words it holds, each at most as often as the template."""
        at = np.flatnonzero(self.times[t][codes])
        at = at[np.argsort(codes[at], kind="stable")]
        code, nth = codes[at], np.arange(len(at))
        first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        nth -= np.repeat(first, np.diff(np.append(first, len(at))))
        times = self.times[t][code]
        # An occurrence counts in windows that start after the one that is `times` occurrences earlier.
        earlier = np.where(nth >= times, at[np.maximum(np.arange(len(at)) - times, 0)], -1)
        change = np.bincount(np.maximum(at - self.window[t], earlier) + 1, minlength=len(codes) + 1)
        change[at + 1] -= 1
        return np.cumsum(change)[:-1]

    def told(self, t: int, codes: np.ndarray, first: int, last: int) -> bool:
        for name in self.telling[t]:
            phrase = self.phrases[name]
            part = codes[first : last + 1]
            start = np.flatnonzero(part[: len(part) - len(phrase) + 1] == phrase[0]) if len(part) >= len(phrase) else ()
            if not any((part[i : i + len(phrase)] == phrase).all() for i in start):
                return False
        return True

    def sweep(self, codes: np.ndarray, t: int, lo: int, hi: int) -> list[Finding]:
        """Findings of a template within words [lo, hi) of a text, none overlapping another."""
        need, window, template = self.need[t], self.window[t], self.words[t]
        bound = self.bounds(codes, t)
        good = np.flatnonzero((bound >= need) & (self.times[t][codes] > 0))
        out, todo = [], [(lo, hi)]
        while todo:
            lo, hi = todo.pop()
            k, plain = int(np.searchsorted(good, lo)), lo
            while k < len(good) and good[k] + need <= hi:
                stretch = good[k : k + window]
                stretch = stretch[stretch < min(good[k] + window, hi)]
                start = int(good[k] if good[k] < plain else stretch[bound[stretch].argmax()])
                stop = min(start + window, hi)
                pairs = align(codes[start:stop].tolist(), template)
                first, last = (start + pairs[0][0], start + pairs[-1][0]) if pairs else (start, start)
                if len(pairs) >= need and self.told(t, codes, first, last):
                    out.append(Finding(first, last, len(pairs), len(pairs) / (last - first + 1 + len(template) - len(pairs)), t))
                    if first - good[k] >= need:  # before the best window of the stretch another may have room
                        todo.append((int(good[k]), first))
                    k = int(np.searchsorted(good, last + 1))
                elif start > good[k]:  # the best failed: the stretch window by window
                    plain = start + 1
                else:
                    k = int(np.searchsorted(good, start + max(1, need - len(pairs))))
        return out

    def findings(self, hashes: np.ndarray, off: np.ndarray) -> dict[int, list[Finding]]:
        """For each document with any, in text order; words are counted from the document's first."""
        codes = self.codes(hashes)
        found: dict[int, list[Finding]] = {}
        for d, t, _ in self.candidates(codes, off):
            own = codes[off[d] : off[d + 1]]
            found.setdefault(d, []).extend(self.sweep(own, t, 0, len(own)))
        return {d: _without_overlaps(x) for d, x in found.items() if x}


def _without_overlaps(found: list[Finding]) -> list[Finding]:
    firsts: list[int] = []
    kept: list[Finding] = []
    for x in sorted(found, key=lambda x: (-x.matched, -x.score, x.template, x.first)):
        at = bisect.bisect_left(firsts, x.first)
        if (at == 0 or kept[at - 1].last < x.first) and (at == len(kept) or x.last < kept[at].first):
            firsts.insert(at, x.first)
            kept.insert(at, x)
    return kept


def scan(docs: DataFrame, templates: list[Template] | None = None, coverage: float = MIN_COVERAGE) -> DataFrame:
    """One row for each license text found in each row of docs (doc_id, text): FOUND; words are counted from 0."""
    known = templates or TEMPLATES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(known, coverage)
        types = [pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
        for batch in batches:
            rows = []
            for c in text_chunks(batch.column("text")):
                for d, found in sorted(scanner.findings(*hashed_words(c.buf, c.off)).items()):
                    doc_id = batch.column("doc_id")[c.lo + d].as_py()
                    rows += [(doc_id, k, known[x.template].license, known[x.template].form, x.matched, x.matched / len(scanner.words[x.template]), x.score, x.first, x.last) for k, x in enumerate(found)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=[f.split()[0] for f in FOUND.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, FOUND)

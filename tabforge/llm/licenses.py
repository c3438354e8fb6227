"""License notices in texts by patience alignment with templates.

Words are runs of word characters in lower case.  A template occurs where a stretch
of the text aligns with MIN_COVERAGE or more of its words in order.  To find it,
every occurrence of one of the template's seed words opens a window around the
place where the template would lie; text and template are aligned there by
patience: the words that are unique in both are matched, the longest increasing
subsequence of these matches anchors the alignment, and the gaps between anchors
are aligned the same way (gaps without unique words by the longest common
subsequence, of large ones in linear space).  Where the matched words lie too far
apart, the window is tried again without its first and without its last matched word.

Seeds lose nothing: a match leaves out at most (1 - MIN_COVERAGE) of the template's
words, so of any set of more words than that at least one occurs; the longest words
are taken.  Texts are read whole; each document is one row of a map.
"""

from __future__ import annotations

import heapq
import math
import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from tabforge.llm.common import map_texts

MIN_COVERAGE = 0.8
#: Cells of a gap up to which its longest common subsequence is found by one table.
LCS_CELLS = 10_000
_WORD = re.compile(r"\w+")

#: Public license notices, headers and whole texts.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("all-rights-reserved", "All rights reserved."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
            "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE
FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR
ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in
the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
)


def patience(text: list[str], a: int, b: int, tmpl: list[str], c: int, d: int, out: list[tuple[int, int]]) -> None:
    """Append matched (text, template) positions of text[a:b] against tmpl[c:d] to ``out``."""
    work = [(a, b, c, d)]
    while work:
        a, b, c, d = work.pop()
        while a < b and c < d and text[a] == tmpl[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == tmpl[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        in_text, in_tmpl = Counter(text[a:b]), Counter(tmpl[c:d])
        spot = {text[i]: i for i in range(a, b) if in_text[text[i]] == 1}
        pairs = [(spot[tmpl[j]], j) for j in range(c, d) if in_tmpl[tmpl[j]] == 1 and tmpl[j] in spot]
        anchors = increasing(pairs)
        if not anchors:
            common(text, a, b, tmpl, c, d, out)
            continue
        out.extend(anchors)
        for i, j in [*anchors, (b, d)]:
            work.append((a, i, c, j))
            a, c = i + 1, j + 1


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of (text, template) pairs, in template order, with increasing text positions."""
    tails: list[int] = []
    back, at = [-1] * len(pairs), []
    for k, (i, _) in enumerate(pairs):
        p = bisect_left(tails, i)
        back[k] = at[p - 1] if p else -1
        if p == len(tails):
            tails.append(i)
            at.append(k)
        else:
            tails[p], at[p] = i, k
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def common(text: list[str], a: int, b: int, tmpl: list[str], c: int, d: int, out: list[tuple[int, int]]) -> None:
    """Gap without unique words: longest common subsequence, large gaps halved until they are small (Hirschberg)."""
    work = [(a, b, c, d)]
    while work:
        a, b, c, d = work.pop()
        if (b - a) * (d - c) <= LCS_CELLS or b - a < 2:
            _table(text, a, b, tmpl, c, d, out)
            continue
        mid = (a + b) // 2
        head = _lengths(text[a:mid], tmpl[c:d])
        tail = _lengths(text[mid:b][::-1], tmpl[c:d][::-1])[::-1]
        cut = c + max(range(len(head)), key=lambda k: head[k] + tail[k])
        work += [(a, mid, c, cut), (mid, b, cut, d)]


def _lengths(x: list[str], y: list[str]) -> list[int]:
    """Lengths of the longest common subsequences of x and each beginning of y."""
    row = [0] * (len(y) + 1)
    for w in x:
        corner = 0
        for j, v in enumerate(y, 1):
            corner, row[j] = row[j], corner + 1 if w == v else max(row[j], row[j - 1])
    return row


def _table(text: list[str], a: int, b: int, tmpl: list[str], c: int, d: int, out: list[tuple[int, int]]) -> None:
    """Longest common subsequence by the table of all its lengths."""
    n, m = b - a, d - c
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if text[a + i] == tmpl[c + j] else max(best[i + 1][j], best[i][j + 1])
    i = j = 0
    while i < n and j < m:
        if text[a + i] == tmpl[c + j]:
            out.append((a + i, c + j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1


class Scanner:
    """Templates with their seed words; ``scan`` gives a text's matches."""

    def __init__(self, templates=TEMPLATES, coverage: float = MIN_COVERAGE):
        self.coverage = coverage
        self.templates = []
        for name, text in templates:
            words = _WORD.findall(text.lower())
            if not words:
                continue
            need = math.ceil(coverage * len(words) - 1e-9)
            order = sorted(range(len(words)), key=lambda k: (-len(words[k]), k))[: len(words) - need + 1]
            seeds: dict[str, list[int]] = {}
            for k in order:
                # all places of a seed word count: leaving one out could lose the match
                seeds[words[k]] = [j for j, w in enumerate(words) if w == words[k]]
            self.templates.append((name, words, need, seeds))
        every = sorted({w for t in self.templates for w in t[3]})
        self.any_seed = re.compile(r"\b(?:" + "|".join(map(re.escape, every)) + r")\b").search if every else (lambda text: None)

    def align(self, words: list[str], a: int, b: int, tmpl: list[str], need: int) -> tuple[int, int, int] | None:
        """(matched words, first, last position) of a template in words[a:b]: enough of its words,
        not too far apart.  Else a far word at either end may have been matched in place of a near
        one: the narrower windows without the first and without the last are tried, wide ones first."""
        tried, work = {(a, b)}, [(a - b, a, b)]
        while work:
            _, a, b = heapq.heappop(work)
            pairs: list[tuple[int, int]] = []
            patience(words, a, b, tmpl, 0, len(tmpl), pairs)
            if len(pairs) < need:
                continue
            first, last = min(i for i, _ in pairs), max(i for i, _ in pairs)
            if len(pairs) >= self.coverage * (last - first + 1):
                return len(pairs), first, last
            for low, high in ((first + 1, b), (a, last)):
                if high - low >= need and (low, high) not in tried:
                    tried.add((low, high))
                    heapq.heappush(work, (low - high, low, high))
        return None

    def widen(self, words: list[str], a: int, b: int, start: int, match: tuple[int, int, int], tmpl: list[str], need: int) -> tuple[int, int, int]:
        """The match with all of the notice: a seed that the template has several times may have opened
        a window that ends within it, so it is aligned again with room for the words not yet matched."""
        while True:
            k, first, last = match
            room = math.ceil((len(tmpl) - k) / self.coverage) + 1
            low, high = max(start, first - room), min(len(words), last + 1 + room)
            if k == len(tmpl) or (low >= a and high <= b):
                return match
            a, b = low, high
            again = self.align(words, a, b, tmpl, need)
            if again is None or again[0] <= k:
                return match
            match = again

    def scan(self, text: str | None) -> list[tuple[str, int, int, int, int, float]]:
        """(license, start, end, matched words, template words, coverage) in text order; offsets
        are code points of the text.  Of matches that overlap, the one with more
        matched words stays (then the higher coverage, then the earlier template)."""
        low = text.lower() if text else ""
        if not low or not self.any_seed(low):
            return []
        if "\u0130" in text:  # its lower case is longer: words are lower-cased one by one
            spans = [m.span() for m in _WORD.finditer(text)]
            words = [text[a:b].lower() for a, b in spans]
        else:
            spans = [m.span() for m in _WORD.finditer(low)]
            words = [low[a:b] for a, b in spans]
        places: dict[str, list[int]] = {}
        wanted = {w for t in self.templates for w in t[3]}
        for k, w in enumerate(words):
            if w in wanted:
                places.setdefault(w, []).append(k)
        found = []
        for rank, (name, tmpl, need, seeds) in enumerate(self.templates):
            n = len(tmpl)
            slack = math.ceil(n / self.coverage) - n + 1
            windows = sorted({(max(0, p - q - slack), min(len(words), p + n - q + slack)) for s, qs in seeds.items() for p in places.get(s, ()) for q in qs})
            done = -1
            for a, b in windows:
                if b - a < need or b <= done:
                    continue
                match = self.align(words, max(a, done), b, tmpl, need)
                if match:
                    k, first, last = self.widen(words, max(a, done), b, max(0, done), match, tmpl, need)
                    found.append((k, k / n, rank, first, last, name, n))
                    done = last + 1
        found.sort(key=lambda f: (-f[0], -f[1], f[2], f[3]))
        kept: list[tuple] = []
        for f in found:
            if all(f[4] < g[3] or f[3] > g[4] for g in kept):
                kept.append(f)
        kept.sort(key=lambda f: f[3])
        return [(f[5], spans[f[3]][0], spans[f[4]][1], f[0], f[6], f[1]) for f in kept]


def scan_docs(docs: DataFrame, templates=TEMPLATES, coverage: float = MIN_COVERAGE) -> DataFrame:
    """One row per notice found in ``docs`` (doc_id, text): doc_id, license, start_pos,
    end_pos, matched, template_words, coverage.

    Null and empty texts, and texts without a notice, give no row.  Repeated rows
    are scanned each; null ids stay null.  No documents or no templates: no rows."""
    scanner = Scanner(templates, coverage)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [
            (i, *match)
            for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
            for match in scanner.scan(t)
        ]
        cols = list(zip(*out)) if out else [()] * 7
        kinds = [batch.column("doc_id").type, pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64()]
        names = ["doc_id", "license", "start_pos", "end_pos", "matched", "template_words", "coverage"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, license string, start_pos long, end_pos long, matched int, template_words int, coverage double"
    return map_texts(docs.select("doc_id", "text"), run, schema)

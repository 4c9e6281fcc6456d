"""License notices found by patience alignment with known texts.

A window of words is aligned with a license text: words that occur once in both
are anchors, the longest increasing sequence of anchors is kept, and the gaps
between neighbouring anchors are aligned in the same way; a gap without such
words is aligned by the longest common subsequence. The share of the license
text's words that are aligned is its coverage.

Windows start at places of license words and are as long as the license text, a
quarter longer, and a little over twice as long, to bridge inserted words; those
that lack too many of its words to reach the coverage asked for are not aligned.
A window without a notice is followed by one an eighth of the license text later,
which the longest window allows for: every notice that lies within twice the
length of its license text is whole in a window, wherever it stands. Of each
alignment the part is taken that has most aligned less other words, and aligned
again from where its first and its last word put the license text. Places are
taken from left to right, the next window starts behind the last place, so the
alignments grow with the words.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from lakeload.llm.common import give_back, column, no_cycle_search

_WORD = re.compile(r"[^\W_]+(?:[.'-][^\W_]+)*")

# The parts of short licenses.
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
    ' documentation files (the "Software"), to deal in the Software without restriction, including without limitation'
    " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and"
    " to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above"
    " copyright notice and this permission notice shall be included in all copies or substantial portions of the"
    ' Software.'
)
_MIT_DISCLAIMER = (
    ' THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE'
    " WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR"
    " COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR"
    " OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
    " granted, provided that the above copyright notice and this permission notice appear in all copies."
)
_ISC_DISCLAIMER = (
    ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL'
    " IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,"
    " INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN"
    " ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF"
    " THIS SOFTWARE."
)
_BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
    " following conditions are met: Redistributions of source code must retain the above copyright notice, this list of"
    " conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice,"
    " this list of conditions and the following disclaimer in the documentation and/or other materials provided with the"
    " distribution."
)
_BSD_THIRD_CLAUSE = (
    " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"
    " derived from this software without specific prior written permission."
)
_BSD_DISCLAIMER = (
    ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,'
    " INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE"
    " DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,"
    " SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR"
    " SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,"
    " WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF"
    " THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)

# Notices as their licenses ask for them, whole short licenses, and their parts, which can stand alone.
LICENSES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "MIT": _MIT_GRANT + _MIT_DISCLAIMER,
    "MIT-grant": _MIT_GRANT,
    "MIT-disclaimer": _MIT_DISCLAIMER,
    "ISC": _ISC_GRANT + _ISC_DISCLAIMER,
    "ISC-grant": _ISC_GRANT,
    "ISC-disclaimer": _ISC_DISCLAIMER,
    "BSD-2-Clause": _BSD_CONDITIONS + _BSD_DISCLAIMER,
    "BSD-3-Clause": _BSD_CONDITIONS + _BSD_THIRD_CLAUSE + _BSD_DISCLAIMER,
    "BSD-conditions": _BSD_CONDITIONS,
    "BSD-disclaimer": _BSD_DISCLAIMER,
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with"
        " the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by"
        " applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS,"
        " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any"
        " later version."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
        " distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
}


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _increasing(values: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence."""
    tops: list[int] = []
    ends: list[int] = []
    before = [-1] * len(values)
    for i, value in enumerate(values):
        pile = bisect_left(tops, value)
        before[i] = ends[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(value)
            ends.append(i)
        else:
            tops[pile], ends[pile] = value, i
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def _common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """A longest common subsequence of two lists, as index pairs; a row of lengths is the bits of one integer."""
    at: dict[str, int] = {}
    for j, word in enumerate(b):
        at[word] = at.get(word, 0) | 1 << j
    full = (1 << len(b)) - 1
    rows = [full]  # a bit is 0 where the length grows by one
    for word in a:
        last = rows[-1]
        same = last & at.get(word, 0)
        rows.append((last + same | last - same) & full)
    out, i, j = [], len(a), len(b)
    while i and j:
        if rows[i] >> j - 1 & 1:
            j -= 1
        elif not rows[i - 1] >> j - 1 & 1:
            i -= 1
        else:
            i, j = i - 1, j - 1
            out.append((i, j))
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned index pairs of two word lists, increasing in both."""
    out: list[tuple[int, int]] = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        at_b = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1 and in_a[w] == 1}
        anchors = [(i, at_b[w]) for i, w in enumerate(a[a0:a1], a0) if w in at_b]
        anchors = [anchors[k] for k in _increasing([j for _, j in anchors])]
        if not anchors:
            if in_a.keys() & in_b.keys():
                out += [(a0 + i, b0 + j) for i, j in _common(a[a0:a1], b[b0:b1])]
            continue
        out += anchors
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        gaps += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:]) if k > i + 1 and m > j + 1]
    out.sort()
    return out


def _bags(words: list[str], at: list[int], wanted: Counter, width: int) -> list[int]:
    """For the window from each place on, how many words of the license text it has at most."""
    out, held, have, ahead = [], Counter(), 0, 0
    for i in at:
        while ahead < len(at) and at[ahead] < i + width:
            word = words[at[ahead]]
            held[word] += 1
            have += held[word] <= wanted[word]
            ahead += 1
        out.append(have)
        have -= held[words[i]] <= wanted[words[i]]
        held[words[i]] -= 1
    return out


def _densest(pairs: list[tuple[int, int]], need: int) -> tuple[int, int, int]:
    """Score, first and last index of the neighbouring pairs, at least ``need``, that have most aligned less other words."""
    best, lead = None, None
    for last in range(need - 1, len(pairs)):
        first = last - need + 1
        lead = max(lead or (pairs[first][0] - 2 * first, -first), (pairs[first][0] - 2 * first, -first))
        score = 2 * last + 1 - pairs[last][0] + lead[0]
        if best is None or score > best[0]:
            best = (score, -lead[1], last)
    return best


def _place(words: list[str], start: int, floor: int, limit: int, pattern: list[str], need: int) -> tuple[int, int, int] | None:
    """Words aligned, first and behind last word, of the best place in the windows from ``start`` on, between two bounds."""
    size, best = len(pattern), None

    def look(begin: int, end: int) -> list[tuple[int, int]]:
        nonlocal best
        begin, end = max(begin, floor), min(end, limit)
        pairs = align(words[begin:end], pattern) if end - begin >= need else []
        if len(pairs) < need:
            return []
        score, first, last = _densest(pairs, need)
        place = (score, last - first + 1, -(begin + pairs[first][0]), begin + pairs[last][0] + 1)
        best = place if best is None else max(best, place)
        return [(begin + i, j) for i, j in (pairs[first], pairs[last])]

    for length in (size, size + size // 4 + 1, 2 * size + _step(size)):
        for i, j in look(start, start + length):
            if (i - j, i - j + size) != (start, start + size):
                look(i - j, i - j + size)
        if best and best[0] == size:  # nothing is better than a notice without changes
            break
    return best and (best[1], -best[2], best[3])


def _step(size: int) -> int:
    return max(1, size // 8)


def _places(words: list[str], pattern: list[str], wanted: Counter, need: int) -> list[tuple[int, int, int]]:
    """Places that align ``need`` words, none overlapping, in order."""
    at, size = [i for i, w in enumerate(words) if w in wanted], len(pattern)
    out: list[tuple[int, int, int]] = []
    floor = past = 0
    for start, bag in zip(at, _bags(words, at, wanted, 2 * size + _step(size))):
        if bag < need or start < past:
            continue
        place = _place(words, start, floor, len(words), pattern, need)
        if place is None:
            past = start + _step(size)
            continue
        while earlier := place[1] - start >= need and _place(words, start, floor, place[1], pattern, need):
            place = earlier
        out.append(place)
        floor = past = place[2]
    return out


def scan(text: str | None, licenses: dict[str, list[str]], coverage: float = 0.8, every: bool = False) -> list[tuple[str, float, int, int, int]]:
    """(license, coverage, words aligned, first and behind last word) of the best place of each license found, or of ``every`` place."""
    words = words_of(text) if text else []
    counts, found = Counter(words), []
    for name, pattern in licenses.items():
        need = max(1, math.ceil(len(pattern) * coverage))
        wanted = Counter(pattern)
        if not pattern or sum(min(n, counts[w]) for w, n in wanted.items()) < need:
            continue
        places = _places(words, pattern, wanted, need)
        if places and not every:
            places = [max(places, key=lambda p: p[0])]
        found += [(name, place[0] / len(pattern), *place) for place in places]
    return found


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", licenses: dict[str, str] | None = None, coverage: float = 0.8, every: bool = True) -> DataFrame:
    """A row per place of a license in a document: id, ``license``, ``coverage``, ``n_aligned``, ``first_word``, ``end_word``.

    Null and empty texts hold no license. Repeated rows are scanned each.
    Places of one license do not overlap; places of different licenses can. Of
    Apache-2.0, GPL-3.0 and MPL-2.0 only the notices are known by default: their
    whole texts are found if given as ``licenses``. If
    not ``every`` place is asked for, the best of each license is returned, of
    equally covered ones the first.
    """
    known = {name: words_of(text) for name, text in (licenses or LICENSES).items()}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = batch["id"].to_pylist(), []
            with no_cycle_search():
                for i, text in zip(ids, batch["text"].to_pylist()):
                    found += [(i, *hit) for hit in scan(text, known, coverage, every)]
            columns = list(zip(*found)) or [[]] * 6
            types = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
            names = ["id", "license", "coverage", "n_aligned", "first_word", "end_word"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
        give_back()


    plain = docs.select(column(id_col).cast("long").alias("id"), column(text_col).cast("string").alias("text"))
    schema = "id long, license string, coverage double, n_aligned long, first_word long, end_word long"
    return plain.mapInArrow(rows, schema).withColumnRenamed("id", id_col)

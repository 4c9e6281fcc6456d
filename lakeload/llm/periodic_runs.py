"""Runs of repeated words, found on a grammar.

The word ids of a document are compressed by Re-Pair: in rounds, adjacent pairs
that occur again in their document become nonterminals, a pair giving way to a
neighbour it overlaps that occurs more often, until no pair occurs twice. What is
left, the start rule, has boundaries between its symbols; a nonterminal has one
boundary, between its two. A run lies across a boundary of exactly one lowest
nonterminal or of the start rule, so it is enough to look there: runs crossing a
nonterminal's boundary are computed once, on its first derivation, and
translated to all positions where the grammar derives it. There a run may be cut
off at the nonterminal's ends; the same run whole is found higher up, and merging
intervals of one period that overlap by a period leaves the maximal ones.

A run of period q covers four periods, so two of them lie on one side of the
boundary and words next to the boundary come again q words on. With 2^j <= q, so
does a stretch of 2^j words; dense names for the stretches of 1, 2, 4, ... words
that occur twice in a document give these places, and compare any two stretches
exactly.

Everything is numpy over the documents of a batch at once; ids, names and pairs
are always of one document.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from lakeload.llm.common import column, give_back, no_cycle_search

_BATCH_BYTES = 2 << 20  # of text worked on at once, if no text is longer

LEAST, TIMES = 6, 4  # a run has at least six words and four periods


def _dense(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each key in sorted order, how often each number occurs)."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.empty(len(keys), bool)
    new[:1] = True
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    starts = np.flatnonzero(new)
    found = np.empty(len(keys), np.int64)
    found[order] = np.cumsum(new) - 1
    return found, np.diff(np.append(starts, len(keys)))


class Grammar:
    """Re-Pair of several documents' word ids; ``doc`` is the document of each word, ascending.

    ``symbols`` are what is left, the start rules, and ``starts`` where each begins. For every
    replacement made on the way, ``rule``, ``at``, ``middle`` and ``end`` are its
    nonterminal, its first word, its boundary and the word behind it.
    """

    def __init__(self, words: np.ndarray, doc: np.ndarray) -> None:
        n = len(words)
        symbol = words.astype(np.int64)
        start = np.arange(n)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)  # neighbours among the symbols left
        last = np.empty(n, bool)  # symbols without a right neighbour in their document
        last[-1:] = True
        np.not_equal(doc[1:], doc[:-1], out=last[:-1])
        live = np.ones(n, bool)
        names = int(symbol.max(initial=0)) + 1
        length = np.ones(n, np.int64)
        rules, ats, middles, ends = [], [], [], []
        rule_count = 0
        at = np.flatnonzero(~last)  # left symbols of pairs that may occur again
        while len(at):
            pair, often = _dense(symbol[at] * names + symbol[after[at]])
            again = often[pair] > 1
            at, pair = at[again], pair[again]
            if not len(at):
                break
            # more frequent pairs first; of equal ones the lower name
            level = np.full(n + 1, np.iinfo(np.int64).max)
            level[at] = (int(often.max()) - often[pair]) * len(often) + pair
            mine, left, right = level[at], level[before[at]], level[after[at]]
            # overlapping places of one pair (a a a) are judged together; of them every second is taken
            follows = left == mine
            first = np.flatnonzero(~follows)
            group = np.cumsum(~follows) - 1
            step = np.arange(len(at)) - first[group]
            last_of = np.append(first[1:], len(at)) - 1
            chosen = (mine < left[first][group]) & (mine < right[last_of][group]) & (step % 2 == 0)
            picked, kind = at[chosen], pair[chosen]
            other = after[picked]
            numbers, name = np.unique(kind, return_inverse=True)
            rules.append(rule_count + name)
            ats.append(start[picked])
            middles.append(start[other])
            ends.append(start[other] + length[other])
            rule_count += len(numbers)
            symbol[picked] = names + name
            names += len(numbers)
            length[picked] += length[other]
            last[picked] = last[other]
            live[other] = False
            beyond = after[other]
            after[picked] = beyond
            inner = beyond < n
            before[beyond[inner]] = picked[inner]
            # pairs beside the new symbols are new, pairs met once stay single
            changed = np.zeros(n + 1, bool)
            changed[at] = True
            changed[picked] = True
            changed[before[picked]] = True
            changed[n] = False
            at = np.flatnonzero(changed[:n] & live & ~last)
        empty = np.empty(0, np.int64)
        self.rule, self.at, self.middle, self.end = (np.concatenate(x) if x else empty for x in (rules, ats, middles, ends))
        self.starts, self.symbols = start[live], symbol[live]


_NEAR = 2  # up to this level, places are tried one by one instead of searched


class Stretches:
    """Names of the stretches of 2^j words that occur twice or more in a document; 0 for all others."""

    def __init__(self, words: np.ndarray, doc_end: np.ndarray) -> None:
        n = len(words)
        self.levels: list[np.ndarray] = []
        self.places: list[np.ndarray] = []  # of each level: name and place in one number, ascending
        places, width = np.flatnonzero(np.bincount(words)[words] > 1), 1
        name = words[places] + 1
        while len(places):
            names = np.zeros(n, np.int32)
            names[places] = name
            self.levels.append(names)
            self.places.append(np.sort(name * (n + 1) + places) if width > 1 << _NEAR else places[:0])
            places = places[places + 2 * width <= doc_end[places]]
            second = names[places + width].astype(np.int64)
            places, second = places[second > 0], second[second > 0]
            name, often = _dense(names[places] * (n + 2) + second)
            again = often[name] > 1
            places, name = places[again], name[again] + 1
            width *= 2

    def alike(self, x: np.ndarray, y: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many words from ``x`` and from ``y`` > x on are equal, up to ``limit`` for y."""
        far = np.zeros(len(x), np.int64)
        for j in range(len(self.levels) - 1, -1, -1):  # what is alike is a sum of powers of two
            names, width = self.levels[j], 1 << j
            fits = np.flatnonzero(y + far + width <= limit)
            same = names[x[fits] + far[fits]]
            far[fits[(same > 0) & (same == names[y[fits] + far[fits]])]] += width
        return far

    def alike_before(self, x: np.ndarray, y: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many words before ``x`` < y and before ``y`` are equal, down to ``limit`` for x."""
        far = np.zeros(len(x), np.int64)
        for j in range(len(self.levels) - 1, -1, -1):
            names, width = self.levels[j], 1 << j
            fits = np.flatnonzero(x - far - width >= limit)
            same = names[x[fits] - far[fits] - width]
            far[fits[(same > 0) & (same == names[y[fits] - far[fits] - width])]] += width
        return far

    def again(self, level: int, place: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``place``, other place): the stretch at ``place`` stands there too, low <= other place < high."""
        names = self.levels[level]
        use = np.flatnonzero((names[place] > 0) & (low < high))
        own, low, high = names[place[use]].astype(np.int64), low[use], high[use]
        if level <= _NEAR:
            parts = []
            for step in range(int((high - low).max(initial=0))):
                fits = np.flatnonzero(low + step < high)
                fits = fits[names[low[fits] + step] == own[fits]]
                parts.append((use[fits], low[fits] + step))
            return tuple(np.concatenate(x) for x in zip(*parts)) if parts else (use, use)
        base = len(names) + 1
        first = np.searchsorted(self.places[level], own * base + low)
        many = np.searchsorted(self.places[level], own * base + high) - first
        which = np.repeat(np.arange(len(use)), many)
        offset = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
        return use[which], self.places[level][first[which] + offset] - own[which] * base


def _crossing(stretches: Stretches, low: np.ndarray, middle: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(index, start, end, period) of stretches across ``middle`` within [low, high) of length for a run, smallest period each."""
    indexes, periods = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for j in range(len(stretches.levels)):
        width = 1 << j
        # two periods of width to 2 * width - 1 behind the boundary
        near = np.flatnonzero(middle + 2 * width <= high)
        m = middle[near]
        which, other = stretches.again(j, m, m + width, np.minimum(m + 2 * width, m + (high[near] - m) // 2 + 1))
        indexes.append(near[which])
        periods.append(other - m[which])
        # two such periods before it
        near = np.flatnonzero(middle - 2 * width >= low)
        m = middle[near]
        which, other = stretches.again(j, m - width, np.maximum(m - width - (m - low[near]) // 2, m - 3 * width + 1), m - 2 * width + 1)
        indexes.append(near[which])
        periods.append(m[which] - width - other)
    span = int((high - low).max(initial=0)) + 1
    both = np.unique(np.concatenate(indexes) * span + np.concatenate(periods))
    which, period = both // span, both % span
    m = middle[which]
    # words behind the boundary against those a period on, and words behind it against those a period before
    right, left = np.flatnonzero(m + period <= high[which]), np.flatnonzero(m - period >= low[which])
    x = np.concatenate([m[right], m[left] - period[left]])
    which, period = np.concatenate([which[right], which[left]]), np.concatenate([period[right], period[left]])
    start = x - stretches.alike_before(x, x + period, low[which])
    end = x + period + stretches.alike(x, x + period, high[which])
    long = (end - start >= np.maximum(LEAST, TIMES * period)) & (start < middle[which]) & (end > middle[which])
    which, start, end, period = which[long], start[long], end[long], period[long]
    order = np.lexsort((period, end, start, which))
    which, start, end, period = which[order], start[order], end[order], period[order]
    new = np.ones(len(which), bool)
    new[1:] = (which[1:] != which[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return which[new], start[new], end[new], period[new]


def _merged(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of one period that overlap by a period or more joined, by start and period."""
    order = np.lexsort((end, start, period))
    start, end, period = start[order], end[order], period[order]
    if not len(start):
        return start, end, period
    # the furthest end so far within a period: periods are kept apart by an offset
    apart = int(end.max()) + 1
    far = np.maximum.accumulate(end + period * apart) - period * apart
    new = np.ones(len(start), bool)
    new[1:] = (period[1:] != period[:-1]) | (start[1:] > far[:-1] - period[1:])
    first = np.flatnonzero(new)
    behind = far[np.append(first[1:], len(start)) - 1]
    start, end, period = start[first], behind, period[first]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def runs(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all maximal runs of several documents' words, by start and period.

    ``words`` are ids that no two documents share, ``doc`` the ascending document of each.
    """
    empty = np.empty(0, np.int64)
    n = len(words)
    if not n:
        return empty, empty, empty
    edges = np.append(np.flatnonzero(np.append(True, doc[1:] != doc[:-1])), n)
    begin, finish = np.repeat(edges[:-1], np.diff(edges)), np.repeat(edges[1:], np.diff(edges))
    grammar, stretches = Grammar(words, doc), Stretches(words, finish)
    # the start rules: boundaries in front of every symbol but a document's first
    middle = grammar.starts[grammar.starts > begin[grammar.starts]]
    _, start, end, period = _crossing(stretches, begin[middle], middle, finish[middle])
    parts = [(start, end, period)]
    # nonterminals, each on its first derivation
    rule, first, of_rule = np.unique(grammar.rule, return_index=True, return_inverse=True)
    low, high = grammar.at[first], grammar.end[first]
    wide = np.flatnonzero(high - low >= LEAST)
    which, start, end, period = _crossing(stretches, low[wide], grammar.middle[first][wide], high[wide])
    which = wide[which]
    # to all derivations: those of a rule lie together once sorted
    order = np.argsort(of_rule, kind="stable")
    many = np.bincount(of_rule, minlength=len(rule))
    behind = np.cumsum(many)
    times = many[which]
    found = np.repeat(np.arange(len(which)), times)
    nth = np.arange(len(found)) - np.repeat(np.cumsum(times) - times, times)
    shift = grammar.at[order[(behind - many)[which[found]] + nth]] - low[which[found]]
    parts.append((start[found] + shift, end[found] + shift, period[found]))
    return _merged(*(np.concatenate(x) for x in zip(*parts)))


def _kept(start: np.ndarray, end: np.ndarray, period: np.ndarray, n: int) -> np.ndarray:
    """Which words stay when of each run only the first period is kept."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, end, -1)
    return np.cumsum(edge[:-1]) == 0


def _replant(words: list[bytes], start: int, period: int) -> list[bytes]:
    """``words`` whose part from ``start`` on repeats its first ``period`` words."""
    tail = words[start : start + period]
    return words[:start] + (tail * ((len(words) - start) // period + 1))[: len(words) - start]


_NAMES = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256"]


def _analysed(texts: list[bytes], planted: list[int | None]) -> list[dict]:
    """The runs and the collapsed text of each of several texts."""
    per_doc = []
    for text, h in zip(texts, planted):
        words = text.split()
        if h is not None and h % 10 == 0 and words:
            g = h // 10
            a = g % len(words)
            words = _replant(words, a, 1 + (len(words) - a) // (3 + g % 8))
        per_doc.append(words)
    sizes = np.array([len(w) for w in per_doc], np.int64)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    ids, known = np.empty(int(edges[-1]), np.int64), 0
    for i, words in enumerate(per_doc):
        number = dict(zip(dict.fromkeys(words), itertools.count(known)))
        ids[edges[i] : edges[i + 1]] = list(map(number.__getitem__, words))
        known += len(number)
    doc = np.repeat(np.arange(len(texts)), sizes)
    start, end, period = runs(ids, doc)
    of_doc = np.searchsorted(edges, start, "right") - 1
    cuts = np.searchsorted(of_doc, np.arange(len(texts) + 1))
    out = []
    for i, words in enumerate(per_doc):
        own = slice(cuts[i], cuts[i + 1])
        s, p, length = start[own] - edges[i], period[own], end[own] - start[own]
        lines = [f"{a},{b},{c}\n" for a, b, c in zip(s.tolist(), length.tolist(), p.tolist())]
        row = dict.fromkeys(_NAMES) | {"n_runs": len(lines), "runs_sha256": hashlib.sha256("".join(lines).encode()).hexdigest()}
        if lines:
            best = 0
            for k in range(1, len(lines)):  # exact: fractions compared crosswise, earlier ones win ties
                if int(length[k]) * int(p[best]) > int(length[best]) * int(p[k]):
                    best = k
            row |= {"start": int(s[best]), "length": int(length[best]), "period": int(p[best]), "exponent_milli": 1000 * int(length[best]) // int(p[best])}
            stay = _kept(s, s + length, p, len(words))
            words = [w for w, k in zip(words, stay.tolist()) if k]
        row["collapsed"] = b" ".join(words)
        out.append(row)
    return out


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False, with_text: bool = True) -> DataFrame:
    """Per row: its id, ``n_runs``, the run of most periods (``start``, ``length``, ``period``, ``exponent_milli``), ``runs_sha256``, ``collapsed_sha256`` and the ``collapsed`` text.

    Words are what ASCII white space parts. A run is a maximal stretch of a
    smallest period that covers it four times or more, six words at least; the
    collapsed text has only the first period of each. With ``plant``, a tenth of
    the rows, by a hash of the id, are first made periodic from some word on.
    Null and empty texts have no words; rows without runs have four nulls. A row
    depends on its own id and text only, so repeated rows agree; with ``plant``,
    a null id is planted in no way.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            piece = (np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False).astype(np.int64)) // _BATCH_BYTES).tolist()
            at = 0
            while at < batch.num_rows:
                to = at + 1
                while to < batch.num_rows and piece[to] == piece[at]:
                    to += 1
                part = batch.slice(at, to - at)
                with no_cycle_search():
                    rows = _analysed(part["text"].cast(pa.binary()).to_pylist(), part["hash"].to_pylist())
                arrays = [part["id"], *(pa.array([r[k] for r in rows], pa.string() if k == "runs_sha256" else pa.int64()) for k in _NAMES)]
                arrays.append(pa.array([hashlib.sha256(r["collapsed"]).hexdigest() for r in rows]))
                if with_text:
                    arrays.append(pa.array([r["collapsed"] for r in rows], pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, names=names)
                at = to
        give_back()

    names = ["id", *_NAMES, "collapsed_sha256"] + (["collapsed"] if with_text else [])
    kinds = "id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    id_ = column(id_col).cast("long")
    hashed = F.crc32(id_.cast("string").cast("binary")) if plant else F.lit(None).cast("long")
    plain = docs.select(id_.alias("id"), F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"), hashed.alias("hash"))
    return plain.mapInArrow(found, kinds + (", collapsed string" if with_text else "")).withColumnRenamed("id", id_col)

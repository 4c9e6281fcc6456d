"""Runs against a plain search over all periods, and the grammar against its text."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from lakeload.llm import periodic_runs, queries
from tests.llm.test_operators import DOCS, SMALL, TINY, documents, odd_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs_by_hand(words):
    """Every maximal stretch for every period, the smallest period of each stretch."""
    found = {}
    n = len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and j > i:
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, q, e - s) for (s, e), q in found.items())


def row_by_hand(doc_id, text, plant=True):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if plant and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = runs_by_hand(words)
    kept = [True] * n
    for s, q, length in runs:
        for i in range(s + q, s + length):
            kept[i] = False
    best = min(runs, key=lambda r: (-Fraction(r[2], r[1]), r[0], r[1])) if runs else None
    lines = "".join(f"{s},{length},{q}\n" for s, q, length in runs)
    text = " ".join(w for w, k in zip(words, kept) if k)
    whole = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
    return (doc_id, len(runs), *whole, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


@pytest.mark.parametrize("sf_dir", [TINY, SMALL])
def test_runs_by_hand(spark, sf_dir):
    found = sorted(tuple(r) for r in queries.op13_repair_runs(spark, sf_dir).collect())
    assert found == sorted(row_by_hand(r["doc_id"], r["text"]) for r in documents(sf_dir))
    assert sum(r[1] > 0 for r in found) > len(found) // 20


def batch_of(texts):
    ids, doc, known = [], [], 0
    for i, words in enumerate(texts):
        names = {w: known + k for k, w in enumerate(dict.fromkeys(words))}
        known += len(names)
        ids += [names[w] for w in words]
        doc += [i] * len(words)
    return np.array(ids, np.int64), np.array(doc, np.int64)


def random_texts(rng, count, letters, size):
    texts = []
    for _ in range(count):
        words = [rng.choice(letters) for _ in range(rng.randrange(size))]
        if rng.random() < 0.6:  # powers of a piece, and powers of such powers
            piece = words[: rng.randrange(1, 8)] * rng.randrange(2, 7)
            piece = (piece + words[:2]) * rng.choice([1, 1, 4, 5])
            words = words[3:] + piece + words[: rng.randrange(9)]
        texts.append(words)
    return texts


@pytest.mark.parametrize("letters,size", [("a", 60), ("ab", 40), ("abc", 120), ("abcdefgh", 300)])
def test_random_texts(letters, size):
    rng = random.Random(len(letters))
    for _ in range(30):
        texts = random_texts(rng, 12, letters, size)
        ids, doc = batch_of(texts)
        start, end, period = periodic_runs.runs(ids, doc)
        edges = np.cumsum([0] + [len(t) for t in texts])
        expected = [(s + edges[i], q, s + edges[i] + length) for i, t in enumerate(texts) for s, q, length in runs_by_hand(t)]
        assert list(zip(start.tolist(), period.tolist(), end.tolist())) == expected


def test_the_grammar_derives_its_text_and_repeats_no_pair():
    rng = random.Random(9)
    texts = random_texts(rng, 40, "abcd", 200) + [["a"] * 33]
    ids, doc = batch_of(texts)
    grammar = periodic_runs.Grammar(ids, doc)
    shape = {}
    for rule, at, middle, end in zip(grammar.rule, grammar.at, grammar.middle, grammar.end):
        expansion = (tuple(ids[at:middle]), tuple(ids[middle:end]))
        assert shape.setdefault(rule, expansion) == expansion
    left = grammar.symbols
    pairs = [(x, y) for a, x, y, z in zip(grammar.starts, left, left[1:], grammar.starts[1:]) if doc[a] == doc[z]]
    assert len(set(pairs)) == len(pairs) and len(grammar.starts) < len(ids) // 2


def test_nested_and_long_repetition():
    words = ["a"] * 5000 + ["b"] + (["x", "y", "x", "z"] * 5 + ["w"]) * 300
    start, end, period = periodic_runs.runs(*batch_of([words]))
    expected = [(0, 1, 5000), (5001, 21, 6300)] + [(5001 + 21 * k, 4, 20) for k in range(300)]
    assert sorted(zip(start.tolist(), period.tolist(), (end - start).tolist())) == sorted(expected)


def test_odd_rows(spark):
    docs = odd_documents(spark).selectExpr("*", "'x' AS hash", "1 AS id")
    found = periodic_runs.periodic_runs(docs, plant=True).collect()
    expected = [row_by_hand(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted((tuple(r[:-1]) for r in found), key=str) == sorted(expected, key=str)
    assert all(hashlib.sha256(r["collapsed"].encode()).hexdigest() == r["collapsed_sha256"] for r in found)
    assert periodic_runs.periodic_runs(spark.createDataFrame([], DOCS)).count() == 0

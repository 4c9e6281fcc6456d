"""Work of op1_suffix_dedup that must not grow faster than the corpus."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from lakeload.llm import suffix_dedup
from tests.llm.test_operators import removed_by_hand

LENGTH = 50


def bucket_of(strings):
    """What the verdicts read: every string from a chunk of its own, whose document has the chunk's number."""
    one, none = np.zeros(1, np.int64), np.zeros(1, np.uint8)
    rows = []
    for chunk, string in enumerate(strings):
        facts = [one, np.array([len(string)]), np.array([chunk]), none, none]
        try:
            packed = suffix_dedup._pack(*facts, [string])
        except TypeError:  # without parts
            packed = suffix_dedup._pack(*facts[:4], [string])
        rows.append({"_bucket": 0, "_chunk": chunk, "_count": 1, "_packed": packed})
    return pa.Table.from_pylist(rows, suffix_dedup._STRINGS)


def test_transforms_hold_only_windows_that_may_be_shared(monkeypatch):
    rng, seen = random.Random(4), []
    noise = lambda n: bytes(rng.choices(b"abcdefghij", k=n))
    gram, passage = noise(16), noise(60)
    strings = [noise(30) + gram + noise(30) for _ in range(200)] + [noise(19) + edge + passage + edge + noise(19) for edge in (b"x", b"y")]
    merge = suffix_dedup.merge_transforms
    monkeypatch.setattr(suffix_dedup, "merge_transforms", lambda shards, depth: seen.extend(map(len, shards)) or merge(shards, depth))
    out = suffix_dedup._verdicts(LENGTH, 1000)(bucket_of(strings)).to_pylist()
    # only the passage is shared: it goes from the later document
    assert [r["_chunk"] for r in out] == [201]
    start, stop, first = (np.frombuffer(out[0][c], kind) for c, kind in (("_from", np.int32), ("_to", np.int32), ("_first", np.int64)))
    assert [(a, b) for a, b, f in zip(start, stop, first) if f < 201] == [(20, 31)] and first.min() == 200
    assert sum(seen) <= 2 * (len(passage) + 2 * LENGTH)


def test_equal_hashes_decide_nothing(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_window_hashes", lambda text, length: np.zeros(len(text) - length + 1, np.uint64), raising=False)
    rng = random.Random(6)
    strings = [bytes(rng.choices(b"abc", k=70)) for _ in range(30)]
    assert suffix_dedup._verdicts(LENGTH, 500)(bucket_of(strings)).num_rows == 0


@pytest.mark.parametrize("frequent", [20_000, 0])
def test_buckets_do_not_follow_the_chunks(spark, monkeypatch, frequent):
    monkeypatch.setattr(suffix_dedup, "_FREQUENT", frequent)
    monkeypatch.setattr(suffix_dedup, "_BUCKETS", 3, raising=False)
    monkeypatch.setattr(suffix_dedup, "_PART_BYTES", 1000, raising=False)
    rng, asked = random.Random(9), []
    rows = [(i, "".join(rng.choice("abc") for _ in range(rng.choice([10, 60, 300])))) for i in range(90)]
    rows += [(100 + i, rows[i % 20][1] + "x" + rows[(i + 7) % 90][1]) for i in range(60)]
    string_rows = suffix_dedup._string_rows
    monkeypatch.setattr(suffix_dedup, "_string_rows", lambda *sizes: asked.append(sizes) or string_rows(*sizes))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = suffix_dedup.remove_repeats(docs, length=LENGTH, chunk_bytes=1000, bucket_bytes=500, shard_bytes=300)
    found = {r["_row"]["doc_id"]: (r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found.collect()}
    assert found == removed_by_hand([(i, t.encode()) for i, t in rows])
    assert asked[0][1] <= 4

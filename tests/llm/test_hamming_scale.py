"""Searches of op2_hamming_top_k in several groups and blocks, against all distances."""

from __future__ import annotations

import random

import numpy as np
import pytest

from lakeload.llm import hamming_search


def nearest(codes, first, rows, query, k):
    """Distance and place of the codes that may hold one of the ``k`` nearest rows."""
    apart = np.bitwise_count(codes ^ query[:, None]).sum(axis=0)
    out = []
    for d, i in sorted(zip(apart.tolist(), first.tolist())):
        before = rows[apart < d].sum() + ((apart == d) & (first < i)).sum()
        if before < k:
            out.append((d, i))
    return out


@pytest.mark.parametrize(("dims", "bits"), [(64, None), (100, None), (24, 9), (130, 17)])
def test_blocks_in_turn_give_the_nearest_of_all(monkeypatch, dims, bits):
    monkeypatch.setattr(hamming_search, "_TILE", 50, raising=False)
    monkeypatch.setattr(hamming_search, "_MET", 40, raising=False)
    rng = np.random.default_rng(dims)
    limbs = -(-dims // 64)
    bound = [min(64, dims - 64 * i) for i in range(limbs)]
    draw = lambda n: np.stack([rng.integers(0, 2**b, n, dtype=np.uint64) if b < 64 else rng.integers(0, 2**64, n, dtype=np.uint64) for b in bound])
    queries = draw(25)
    codes = np.hstack((draw(500), queries[:, :10] ^ np.uint64(5), queries[:, :4]))
    codes = np.unique(codes, axis=1)
    n = codes.shape[1]
    mixed = rng.permutation(n)
    codes, first, rows = codes[:, mixed], rng.permutation(n).astype(np.int64), rng.integers(1, 4, n).astype(np.int32)
    search = hamming_search._Search(queries, dims, 7, bits)
    for i in (0, 3, 200, 450):  # the first block has fewer codes than are asked for
        stop = {0: 3, 3: 200, 200: 450, 450: n}[i]
        search.pass_by(np.ascontiguousarray(codes[:, i:stop]), first[i:stop], rows[i:stop])
    for q in range(queries.shape[1]):
        mine = search.query == q
        found = sorted(zip(search.distance[mine].tolist(), search.first[mine].tolist()))
        assert found == nearest(codes, first, rows, queries[:, q], 7)


def test_groups_and_blocks_on_spark(spark, monkeypatch):
    for name, size in (("_BLOCK", 64), ("_PACKED", 16), ("_PAIRS", 100)):
        monkeypatch.setattr(hamming_search, name, size, raising=False)
    rng = random.Random(8)
    rows = [(i, [rng.choice([-1.0, 1.0]) for _ in range(70)]) for i in range(300)]
    rows += [(1000 + i, rows[i][1]) for i in range(0, 300, 7)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    code = {i: np.array(e) > 0 for i, e in rows}
    found = {}
    context = spark.sparkContext
    context.setJobGroup("far", "far codes")
    try:
        for r in hamming_search.top_k(frame, frame.where("vec_id % 20 = 0"), 70, k=5).collect():
            found.setdefault(r["query_id"], []).append((r["rank"], r["distance"], r["vec_id"]))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        context.setLocalProperty("spark.job.description", None)
    assert set(found) == {i for i in code if i % 20 == 0}
    for q, rank in found.items():
        near = sorted((int((code[q] != c).sum()), i) for i, c in code.items())[:5]
        assert sorted(rank) == [(n + 1, *x) for n, x in enumerate(near)]
    # lookups of further radii are no jobs
    assert len(context.statusTracker().getJobIdsForGroup("far")) <= 20

"""The audit against a plain count, the trees against plain sums, and odd tables."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from lakeload.llm import divergence, queries
from lakeload.llm.oracle import ORACLE
from tests.llm.test_operators import DOCS, SMALL, TINY, documents, odd_documents

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def audit_by_hand(rows, least=30, best=50):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for r in rows:
        lang, source = r["lang"] or "", r["source"] or ""
        terms = TERM.findall((r["text"] or "").translate(LOWER))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = {}
    for lang in {lang for lang, _ in counts}:
        kept = [t for t in docs[lang] if docs[lang][t] >= least]
        sources = [s for g, s in counts if g == lang]
        total = Counter()
        for s in sources:
            total.update({t: counts[lang, s][t] for t in kept})

        def share(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 1000000000 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p, q = {s: share(counts[lang, s]) for s in sources}, share(total)
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(q[t] - p[s][t], t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:best])):
                out.update({(lang, s, part, i): (item.decode(), -minus) for i, (minus, item) in enumerate(found, 1)})
    return out


def as_map(found):
    return {(r["lang"], r["source"], r["part"], r["rank"]): (r["item"], r["value"]) for r in found.collect()}


@pytest.mark.parametrize("sf_dir", [TINY, SMALL])
def test_audit_by_hand(spark, sf_dir):
    assert as_map(queries.op12_segment_trees(spark, sf_dir)) == audit_by_hand(documents(sf_dir))


def test_audit_by_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    rows = con.execute(ORACLE["op12_segment_trees"]).fetchall()
    assert {tuple(r[:3]) + (r[5],): (r[3], r[4]) for r in rows} == as_map(queries.op12_segment_trees(spark, SMALL))


def test_many_sources_in_chunks_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "_CHUNK", 3)
    monkeypatch.setattr(divergence, "_BLOCK_ROWS", 40)
    monkeypatch.setattr(divergence, "_FLUSH", 100)
    monkeypatch.setattr(divergence, "_PIECE", 64)
    rows = documents(TINY)
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    assert as_map(divergence.audit(docs, least_docs=8)) == audit_by_hand(rows, 8)


def test_odd_tables(spark):
    docs = odd_documents(spark).selectExpr("*", "1 AS term", "2 AS n", "'z' AS block")
    rows = [r.asDict() for r in docs.collect()]
    for least in (1, 2, 30):
        assert as_map(divergence.audit(docs, least_docs=least)) == audit_by_hand(rows, least)
    assert divergence.audit(spark.createDataFrame([], DOCS)).count() == 0


def test_trees_price_equal_pairs_once():
    rng = np.random.default_rng(3)
    counts = np.sort(rng.poisson(0.4, (6, 5000)), axis=1)[:, ::-1].copy()
    counts[:, :40] += rng.integers(0, 10**13, (6, 40))
    trees = divergence.Trees(counts)
    for a in range(6):
        for b in range(6):
            p, q = (divergence.shares(trees.values.tolist(), int(counts[k].sum()), 5000) for k in (a, b))
            plain = [divergence.shares(counts[k].tolist(), int(counts[k].sum()), 5000) for k in (a, b)]
            trees.priced = 0
            assert trees.price(a, b, p, q) == int(np.abs(plain[0] - plain[1]).sum())
            assert trees.priced < 1000  # of nearly 10,000 pairs of places

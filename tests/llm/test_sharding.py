"""Virtual slots: the map against a plain deal, places, hot rows, and the edits of rebalancing."""

from __future__ import annotations

import heapq
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.errors import AnalysisException

from lakeload.llm import queries, sharding
from lakeload.scratch import run_dir
from tests.llm.test_operators import DOCS, SMALL, documents, odd_documents


def dealt_by_hand(bytes_of, shards):
    heap, out = [(0, 0, s) for s in range(shards)], {}
    for slot in sorted(bytes_of, key=lambda s: (-bytes_of[s], s)):
        load, n, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (load + bytes_of[slot], n + 1, shard))
    return out


def gapless(rows):
    places = defaultdict(list)
    for r in rows:
        places[r["shard"]].append(r["slot"])
    return all(sorted(p) == list(range(len(p))) for p in places.values())


def test_shards_by_hand(spark):
    rows = queries.op11_virtual_slots(spark, SMALL).collect()
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in documents(SMALL)}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    assert all(r["size"] == len(texts[r["doc_id"]]) + 1 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]]) for r in rows)
    assert {(r["law"], r["grown_shard"], r["map_version"]) for r in rows} == {("bytes", None, 1)} and gapless(rows)
    slots, shards = Counter(), Counter()
    for r in rows:
        slots[r["virtual_slot"]] += r["size"]
        shards[r["shard"]] += r["size"]
    by_hand = dealt_by_hand({s: slots[s] for s in range(sharding.SLOTS)}, 8)
    assert all(by_hand[r["virtual_slot"]] == r["shard"] for r in rows)
    assert max(shards.values()) - min(shards.values()) < 0.001 * min(shards.values())


def test_odd_rows(spark):
    path = run_dir(spark, "odd-map")
    rows = sharding.shard_documents(odd_documents(spark), path, shards=3, slots=64).collect()
    assert len(rows) == 9 and gapless(rows)
    assert sorted(r["size"] for r in rows if r["doc_id"] in (3, 4, 7)) == [1, 1, 4]
    assert {r["text_crc32"] for r in rows if r["doc_id"] in (3, 4)} == {0}
    empty = spark.createDataFrame([], DOCS)
    assert sharding.shard_documents(empty, run_dir(spark, "empty-map"), slots=64).count() == 0


def test_one_row_repeated_spreads(spark):
    docs = spark.range(3000).selectExpr("if(id % 3 = 0, 7, id) AS doc_id", "if(id % 3 = 0, 'the same text over and over', concat('text ', id)) AS text")
    rows = sharding.shard_documents(docs, run_dir(spark, "hot-map"), shards=4, slots=256).collect()
    assert len(rows) == 3000 and gapless(rows)
    hot = Counter(r["virtual_slot"] for r in rows if r["doc_id"] == 7)
    assert len(hot) > 50 and max(hot.values()) < 60
    shards = Counter()
    for r in rows:
        shards[r["shard"]] += r["size"]
    assert max(shards.values()) - min(shards.values()) <= 100


@pytest.fixture(scope="module")
def stored(spark):
    rows = sharding.with_slots(sharding.sized(spark.read.parquet(f"{SMALL}/documents.parquet")))
    totals = sharding.slot_totals(rows).cache()
    path = run_dir(spark, "maps")
    sharding.store_map(sharding.first_map(totals, 8), path, 1)
    return totals, path


def map_of(spark, path, version=None):
    rows = sharding.stored_map(spark, path, version).collect()
    loads = Counter()
    for r in rows:
        loads[r["shard"]] += r["bytes"]
    return {r["slot"]: r["shard"] for r in rows}, loads


@pytest.mark.parametrize("only_new", [True, False])
def test_a_new_shard(spark, stored, only_new):
    totals, path = stored
    version = 2 + only_new
    sharding.store_map(sharding.rebalanced(sharding.stored_map(spark, path, 1), totals, 9, only_new), path, version)
    (old, _), (new, loads) = map_of(spark, path, 1), map_of(spark, path)
    assert len(new) == sharding.SLOTS and set(new.values()) == set(range(9))
    largest = max(r["bytes"] for r in totals.collect())
    assert max(loads.values()) - min(loads.values()) <= largest
    moved = [s for s in old if old[s] != new[s]]
    if only_new:
        assert all(new[s] == 8 for s in moved)
    with pytest.raises(AnalysisException):
        sharding.store_map(sharding.stored_map(spark, path, 1), path, version)


def test_a_leaving_shard_and_an_overfull_one(spark, stored):
    totals, path = stored
    old, _ = map_of(spark, path, 1)
    fewer = sharding.rebalanced(sharding.stored_map(spark, path, 1), totals, 7).collect()
    loads = Counter()
    for r in fewer:
        loads[r["shard"]] += r["bytes"]
    assert set(loads) == set(range(7)) and len(fewer) == sharding.SLOTS
    assert max(loads.values()) - min(loads.values()) <= max(r["bytes"] for r in totals.collect())
    grown = totals.selectExpr("slot", "bytes + if(slot < 40, 20000, 0) AS bytes", "rows")
    edited = {r["slot"]: (r["shard"], r["bytes"]) for r in sharding.rebalanced(sharding.stored_map(spark, path, 1), grown, 8).collect()}
    after = Counter()
    for shard, size in edited.values():
        after[shard] += size
    mean = sum(after.values()) / 8
    assert max(after.values()) <= mean + max(size for _, size in edited.values())
    even = sharding.rebalanced(sharding.stored_map(spark, path, 1), totals, 8, only_new=True)
    assert {r["slot"]: r["shard"] for r in even.collect()} == old

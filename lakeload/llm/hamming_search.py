"""Exact nearest binary codes by multi-index hashing with growing radii.

Codes are cut into segments, and every distinct code is filed under the value
of each segment. A code that was not met although j of m segments were searched
up to radius r and the others up to r - 1 differs in at least m * r + j bits.
So radius after radius every query looks up the segment values at exactly that
distance from its own, in no more segments than it takes to cover the kth best
distance it has found; the codes met are compared on all bits, against that
distance; and the query is done once it is covered.
Lookups do not travel: queries are dealt to groups, and all codes pass every
group, packed, in blocks of bounded size that are filed as they come. What a
query has found in earlier blocks bounds its radius in the next. The codes under
one value are compared at once with all queries that look the value up.
Queries with equal codes are one search, and rows with equal codes are one entry
with their k smallest ids, which are only expanded for the codes that remain.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeload.llm.common import column, give_back, settled

_WORD_BITS = 32
_PACKED = 64  # codes in a packed row
_BLOCK = 1 << 21  # codes filed at once
_ASKED = 1 << 16  # queries of the largest group
_PAIRS = 1 << 23  # pairs of query and code that are worth a group
_TILE = 1 << 16  # pairs compared at once
_MET = 1 << 19  # pairs kept before the nearest are taken from them
_SAMPLE = 1 << 11  # codes for a first bound
_EIGHT = np.arange(8)


def sign_code(embedding: Column, dims: int) -> Column:
    """Which of ``dims`` components are above zero, as an array of longs of 32 bits; missing and null ones are not."""
    words = []
    for start in range(0, dims, _WORD_BITS):
        bits = [
            F.when(F.get(embedding, F.lit(i)) > 0, F.lit(1 << (i - start))).otherwise(F.lit(0)).cast("long")
            for i in range(start, min(dims, start + _WORD_BITS))
        ]
        total = bits[0]
        for bit in bits[1:]:
            total = total + bit
        words.append(total)
    return F.array(*words)


def _limbs(codes: pa.Array, words: int) -> np.ndarray:
    """Codes as arrays of 32-bit words in 64-bit limbs, a row for each limb."""
    flat = codes.flatten().to_numpy(zero_copy_only=False).astype(np.uint64).reshape(-1, words)
    if words % 2:
        flat = np.hstack((flat, np.zeros((len(flat), 1), np.uint64)))
    return np.ascontiguousarray((flat[:, 0::2] | flat[:, 1::2] << np.uint64(_WORD_BITS)).T)


def _words(limbs: np.ndarray, words: int) -> pa.Array:
    """The reverse of ``_limbs``."""
    flat = np.empty((limbs.shape[1], 2 * len(limbs)), np.int64)
    flat[:, 0::2] = (limbs & np.uint64(0xFFFFFFFF)).T
    flat[:, 1::2] = (limbs >> np.uint64(_WORD_BITS)).T
    flat = flat[:, :words].ravel()
    return pa.ListArray.from_arrays(pa.array(np.arange(limbs.shape[1] + 1, dtype=np.int32) * words), pa.array(flat))


def _values(limbs: np.ndarray, start: int, stop: int) -> np.ndarray:
    """Bits ``start`` to ``stop`` of each code as one number."""
    limb, low = divmod(start, 64)
    value = limbs[limb] >> np.uint64(low)
    if low + stop - start > 64:
        value = value | limbs[limb + 1] << np.uint64(64 - low)
    return (value & np.uint64((1 << (stop - start)) - 1)).astype(np.uint32)


def _filed(values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places ordered by value, and where each value's places begin."""
    kind = np.uint16 if size <= 16 else np.uint32
    return np.argsort(values.astype(kind), kind="stable").astype(np.int32), np.concatenate(([0], np.cumsum(np.bincount(values, minlength=1 << size))))


def _where(hits: np.ndarray) -> np.ndarray:
    """Places of the few true ones, eight looked at at once."""
    flat = hits.ravel()
    whole = len(flat) // 8 * 8
    eights = flat[:whole].view(np.uint64).nonzero()[0]
    places = (eights[:, None] * 8 + _EIGHT).ravel()
    places = places[flat.take(places)]
    rest = flat[whole:].nonzero()[0]
    return np.concatenate((places, rest + whole)) if len(rest) else places


class _Search:
    """The nearest codes of some queries among the codes they have passed."""

    def __init__(self, queries: np.ndarray, dims: int, k: int, segment_bits: int | None) -> None:
        self.queries, self.dims, self.k, self.segment_bits = queries, dims, k, segment_bits
        self.kind = np.uint8 if dims < 256 else np.uint16
        self.limit = np.full(queries.shape[1], dims, self.kind)  # no row beyond it is among the k nearest
        self.query, self.distance, self.first, self.rows = (np.zeros(0, np.int64) for _ in range(4))
        self.code = np.zeros((len(queries), 0), np.uint64)

    def _distances(self, a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
        total = np.bitwise_count(a[0][:, None] ^ b[0])
        for x, y in zip(a[1:], b[1:]):
            total = total.astype(self.kind) + np.bitwise_count(x[:, None] ^ y)
        return total

    def pass_by(self, codes: np.ndarray, first: np.ndarray, rows: np.ndarray) -> None:
        """Search one more block of distinct codes."""
        n, asked = codes.shape[1], self.queries.shape[1]
        if not len(self.query) and n >= self.k:
            self._bound(codes[:, :: -(-n // _SAMPLE)])
        # the longer the segments, the fewer codes are met and the more values are looked at
        width = self.segment_bits or min(16, max(4, round((math.log2(n) + math.log2(asked)) / 2 - 4.5)))
        count = -(-self.dims // min(width, 20))
        bounds = [self.dims * i // count for i in range(count + 1)]
        sizes = [bounds[i + 1] - bounds[i] for i in range(count)]
        files = [_filed(_values(codes, bounds[i], bounds[i + 1]), sizes[i]) for i in range(count)]
        values = [_values(self.queries, bounds[i], bounds[i + 1]) for i in range(count)]
        for radius in range(max(sizes) + 1):
            for i in range(count):
                # segments up to i at this radius and the others below it cover less than radius * count + i + 1 bits
                active = np.flatnonzero(self.limit >= radius * count + i)
                if len(active) and radius <= sizes[i]:
                    self._meet(codes, first, rows, files[i], values[i], active, sizes[i], radius)
            if not (self.limit >= (radius + 1) * count).any():
                break

    def _bound(self, sample: np.ndarray) -> None:
        """The kth distance to some codes bounds that to all."""
        if sample.shape[1] >= self.k:
            step = max(1, _TILE // sample.shape[1])
            for i in range(0, len(self.limit), step):
                near = self._distances(list(self.queries[:, i : i + step]), list(sample))
                self.limit[i : i + step] = np.partition(near, self.k - 1, axis=1)[:, self.k - 1]

    def _meet(self, codes: np.ndarray, first: np.ndarray, rows: np.ndarray, file: tuple[np.ndarray, np.ndarray], values: np.ndarray, active: np.ndarray, size: int, radius: int) -> None:
        """Compare the codes under each value with the active queries whose own value is ``radius`` bits away."""
        order, begin = file
        by_value, opens = _filed(values[active], size)
        by_value = active[by_value]
        sorted_codes, sorted_queries = [limb[order] for limb in codes], [limb[by_value] for limb in self.queries]
        flips = np.array([sum(1 << bit for bit in bits) for bits in combinations(range(size), radius)], np.int64)
        met, held = [], 0
        full = np.flatnonzero(np.diff(begin))
        for value, low, high in zip(full.tolist(), begin[full].tolist(), begin[full + 1].tolist()):
            near = flips ^ value
            start = opens[near]
            many = opens[near + 1] - start
            ends = many.cumsum()
            total = int(ends[-1])
            if not total:
                continue
            asked = np.arange(total)
            asked += np.repeat(start - ends + many, many)
            for j in range(0, total, _TILE):
                some = asked[j : j + _TILE]
                bits, who = [limb.take(some) for limb in sorted_queries], by_value.take(some)
                limit = self.limit.take(who)
                step = max(1, _TILE // len(some))
                for i in range(low, high, step):
                    distances = self._distances([limb[i : min(i + step, high)] for limb in sorted_codes], bits)
                    hit = _where(distances <= limit)
                    if len(hit):
                        row = hit // len(some)
                        met.append((who.take(hit - row * len(some)), order.take(row + i), distances.ravel().take(hit)))
                        held += len(hit)
                        if held >= _MET:
                            self._settle(codes, first, rows, met)
                            met, held, limit = [], 0, self.limit.take(who)
        self._settle(codes, first, rows, met)

    def _settle(self, codes: np.ndarray, first: np.ndarray, rows: np.ndarray, met: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        """Of each query the codes that may hold one of the ``k`` nearest rows, ``k`` codes at most; ties go to the smaller id."""
        if not met:
            return
        query, place, distance = (np.concatenate(x) for x in zip(*met))
        near = distance <= self.limit[query]
        query, place, distance = query[near], place[near], distance[near]
        touched = np.zeros(len(self.limit), bool)
        touched[query] = True
        again = touched[self.query]
        query = np.concatenate((query, self.query[again]))
        distance = np.concatenate((distance, self.distance[again])).astype(np.int64)
        least = np.concatenate((first[place], self.first[again]))
        count = np.concatenate((rows[place], self.rows[again]))
        code = np.hstack((codes[:, place], self.code[:, again]))
        rank = query * (self.dims + 1) + distance
        order = np.lexsort((*code, least, rank))
        # a pair that meets in several segments is one
        same = (rank[order[1:]] == rank[order[:-1]]) & (least[order[1:]] == least[order[:-1]]) & (code[:, order[1:]] == code[:, order[:-1]]).all(axis=0)
        order = order[np.concatenate(([True], ~same))] if len(order) else order
        query, distance, least, count, code = query[order], distance[order], least[order], count[order], code[:, order]
        if not len(query):
            return
        # all rows of nearer codes come before a code's, and the first row of each that is as near and has a smaller id
        parted = np.concatenate(([True], query[1:] != query[:-1]))
        level = np.flatnonzero(parted | np.concatenate(([True], distance[1:] != distance[:-1])))
        length = np.diff(np.append(level, len(query)))
        nearer = (np.cumsum(count) - count)[level]
        opening = np.flatnonzero(parted[level])
        nearer -= np.repeat(nearer[opening], np.diff(np.append(opening, len(level))))
        keep = np.repeat(nearer - level, length) + np.arange(len(query)) < self.k
        query, distance, least, count, code = query[keep], distance[keep], least[keep], count[keep], code[:, keep]
        at = np.flatnonzero(np.concatenate(([True], query[1:] != query[:-1])))
        enough = np.add.reduceat(count, at) >= self.k
        last = (np.append(at[1:], len(query)) - 1)[enough]
        self.limit[query[last]] = distance[last].astype(self.kind)
        self.query = np.concatenate((self.query[~again], query))
        self.distance = np.concatenate((self.distance[~again], distance))
        self.first = np.concatenate((self.first[~again], least))
        self.rows = np.concatenate((self.rows[~again], count))
        self.code = np.hstack((self.code[:, ~again], code))


_ROWS = "_group int, _kind int, _codes binary, _first binary, _n binary"
_ROWS_ARROW = pa.schema([("_group", pa.int32()), ("_kind", pa.int32()), ("_codes", pa.binary()), ("_first", pa.binary()), ("_n", pa.binary())])


def _packed_codes(words: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = _limbs(batch.column("code"), words).T
            first, n = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("first", "n"))
            cuts = [slice(i, i + _PACKED) for i in range(0, len(codes), _PACKED)]
            columns = [[x[cut].tobytes() for cut in cuts] for x in (codes, first, n.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([pa.array([0] * len(cuts), pa.int32()), pa.array([1] * len(cuts), pa.int32()), *(pa.array(x, pa.binary()) for x in columns)], schema=_ROWS_ARROW)

    return rows


def _packed_queries(words: int, groups: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = _limbs(batch.column("q_code"), words)
            mixed = np.zeros(codes.shape[1], np.uint64)
            for limb in codes:
                mixed = (mixed ^ limb) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(32)
            group = (mixed % np.uint64(groups)).astype(np.int64)
            here = np.unique(group)
            blobs = [codes[:, group == g].T.tobytes() for g in here]
            none = pa.nulls(len(here), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(here, pa.int32()), pa.array([0] * len(here), pa.int32()), pa.array(blobs, pa.binary()), none, none], schema=_ROWS_ARROW)

    return rows


def _nearest_codes(dims: int, k: int, words: int, segment_bits: int | None):
    limbs = -(-words // 2)

    def unpacked(blob: bytes) -> np.ndarray:
        return np.frombuffer(blob, np.uint64).reshape(-1, limbs).T

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        asked: list[bytes] = []
        search, size = None, 0
        codes, first, n = np.empty((limbs, _BLOCK), np.uint64), np.empty(_BLOCK, np.int64), np.empty(_BLOCK, np.int32)
        for batch in batches:
            for kind, *packed in zip(*(batch.column(c).to_pylist() for c in ("_kind", "_codes", "_first", "_n"))):
                if kind == 0:
                    if search:
                        raise RuntimeError("a query behind the codes it is compared with")
                    asked.append(packed[0])
                elif asked:
                    search = search or _Search(np.ascontiguousarray(unpacked(b"".join(asked))), dims, k, segment_bits)
                    more = unpacked(packed[0])
                    stop = size + more.shape[1]
                    if stop > _BLOCK:
                        search.pass_by(codes[:, :size], first[:size], n[:size])
                        size, stop = 0, more.shape[1]
                    codes[:, size:stop], first[size:stop], n[size:stop] = more, np.frombuffer(packed[1], np.int64), np.frombuffer(packed[2], np.int32)
                    size = stop
        if size:
            search.pass_by(codes[:, :size], first[:size], n[:size])
        if search is not None:
            for i in range(0, len(search.query), 1 << 16):
                some = slice(i, i + (1 << 16))
                found = [_words(search.queries[:, search.query[some]], words), _words(search.code[:, some], words), pa.array(search.distance[some], pa.int32())]
                yield pa.RecordBatch.from_arrays(found, ["q_code", "code", "distance"])

    return rows


def top_k(rows: DataFrame, queries: DataFrame, dims: int, k: int = 10, id_col: str = "vec_id", embedding_col: str = "embedding", segment_bits: int | None = None) -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``distance``): the ``k`` rows nearest to each query.

    Ties go to the smaller id; a query that is a row itself finds itself. Fewer
    rows than ``k`` give fewer results. Rows with a null id are left out; a null
    embedding has a code of zeros, and NaN counts as above zero. Rows that repeat an id count once per code.
    Segments follow the codes in a block and the queries in a group, up to 16
    bits; ``segment_bits`` sets their length, up to 20.
    """
    words = -(-dims // _WORD_BITS)
    coded = rows.where(column(id_col).isNotNull()).select(column(id_col).cast("long").alias("id"), sign_code(column(embedding_col), dims).alias("code")).distinct()
    asked = queries.where(column(id_col).isNotNull()).select(column(id_col).cast("long").alias("query_id"), sign_code(column(embedding_col), dims).alias("q_code")).distinct()
    asked = settled(asked)
    nth = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    entries = coded.withColumn("nth", nth).where(F.col("nth") <= k).select("code", "id")
    codes = settled(entries.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")))  # k ids at most
    n_codes, n_asked = codes.count(), asked.count()
    if n_codes == 0:
        return asked.select("query_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("vec_id"), F.lit(0).alias("distance")).limit(0)
    # enough groups to keep the cores busy, if the work is worth it, and as many as bound their size
    cores = rows.sparkSession.sparkContext.defaultParallelism
    groups = max(-(-n_asked // _ASKED), min(2 * cores, n_codes * n_asked // _PAIRS + 1))
    packed = codes.select("code", F.col("ids")[0].alias("first"), F.size("ids").alias("n")).mapInArrow(_packed_codes(words), _ROWS)
    packed = packed.withColumn("_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    sought = asked.select("q_code").distinct().mapInArrow(_packed_queries(words, groups), _ROWS)
    # in a group the queries come first
    dealt = sought.unionByName(packed).repartitionById(groups, F.col("_group")).sortWithinPartitions("_group", "_kind")
    best = dealt.groupBy("_group").applyInArrow(_nearest_codes(dims, k, words, segment_bits), "q_code array<long>, code array<long>, distance int")
    ids = best.join(codes, "code").select("q_code", "distance", F.explode("ids").alias("id"))
    rank = F.row_number().over(Window.partitionBy("q_code").orderBy("distance", "id"))
    return asked.join(ids.withColumn("rank", rank).where(F.col("rank") <= k), "q_code").select("query_id", "rank", F.col("id").alias("vec_id"), "distance")

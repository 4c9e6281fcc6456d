"""How far the sources of a language differ, by hash-consed segment trees over term ids.

The kept terms of a language are dealt into blocks by hash. In a block, terms
are numbered by falling frequency, and every source's counts make a segment tree
over these ids: leaves are counts, a node is the pair of its children. Nodes are
hash-consed, so equal count subtrees are one node, in whichever trees and at
whichever ids they stand; rare terms lie side by side, where most counts are
equal. Two sources are compared by walking both trees at once, level by level:
each distinct pair of nodes is expanded and priced one time, however often it
occurs. Prices of blocks add up.

All arithmetic is exact: shares are computed as Python integers, once per
distinct count of a source, and fit 64 bits from there on.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lakeload.llm.common import column, give_back, settled

UNIT = 1_000_000_000
PRIOR = 5
_FLUSH = 300_000  # counted terms that a task holds before it passes them on
_PIECE = 4 << 20  # bytes of a text that are split at once
_BLOCK_ROWS = 50_000  # counts in a block on average
_CHUNK = 64  # sources of one side of a task, on average

#: ASCII letters in lower case, bytes of other characters as they are, a space for the rest
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _pieces(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, of some megabytes at a time."""
    at = 0
    while at < len(data):
        end = at + _PIECE
        if end < len(data):  # on to the next byte that parts terms
            while end < len(data) and _LETTERS[data[end]] != 32:
                end += 1
        yield data[at:end].translate(_LETTERS).split()
        at = end


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, occurrences, documents) of the rows of a task, partly summed."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def out() -> pa.RecordBatch:
        langs, sources, terms, n, d = [], [], [], [], []
        for (lang, source), (times, rows) in held.items():
            langs += [lang] * len(times)
            sources += [source] * len(times)
            terms += times.keys()
            n += times.values()
            d += map(rows.__getitem__, times)
        held.clear()
        names = ["lang", "source", "term", "n", "d"]
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(sources, pa.string()), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(d, pa.int64())], names=names)

    size = 0
    for batch in batches:
        texts = batch["text"].cast(pa.binary())
        for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), texts):
            times, rows = held.setdefault((lang, source), (Counter(), Counter()))
            size -= len(times)
            own: set[bytes] = set()
            for terms in _pieces(text.as_py()):
                times.update(terms)
                own.update(terms)
            rows.update(own)
            size += len(times)
            if size > _FLUSH:
                yield out()
                size = 0
    if held:
        yield out()
    give_back()


def shares(counts: list[int], total: int, terms: int) -> np.ndarray:
    """The smoothed share of each count, in billionths, plus one."""
    whole = total + PRIOR * terms
    return np.array([1 + UNIT * (c + PRIOR) // whole for c in counts], np.int64)


class Trees:
    """Hash-consed segment trees, one a row of ``counts`` (trees x ids)."""

    def __init__(self, counts: np.ndarray) -> None:
        trees, ids = counts.shape
        width = 1 << max(ids - 1, 0).bit_length()
        self.values, leaves = np.unique(counts, return_inverse=True)
        self.pad = len(self.values)  # the leaf behind the last id
        nodes = np.full((trees, width), self.pad, np.int64)
        nodes[:, :ids] = leaves.reshape(trees, ids)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # children of each node, from the leaves up
        base = self.pad + 1
        while nodes.shape[1] > 1:
            pairs, found = np.unique(nodes[:, 0::2] * base + nodes[:, 1::2], return_inverse=True)
            self.levels.append((pairs // base, pairs % base))
            nodes = found.reshape(trees, -1).astype(np.int64)
            base = len(pairs)
        self.roots = nodes[:, 0]
        self.priced = 0  # distinct pairs of nodes looked at so far

    def price(self, a: int, b: int, share_a: np.ndarray, share_b: np.ndarray) -> int:
        """Sum over the ids of the difference between the shares of both trees' leaves."""
        x, y = self.roots[a : a + 1], self.roots[b : b + 1]
        above = []
        for left, right in reversed(self.levels):
            self.priced += len(x)
            x, y = np.concatenate([left[x], right[x]]), np.concatenate([left[y], right[y]])
            base = int(y.max()) + 1
            pairs, found = np.unique(x * base + y, return_inverse=True)
            x, y = pairs // base, pairs % base
            above.append(found)
        self.priced += len(x)
        prices = np.abs(np.append(share_a, 0)[x] - np.append(share_b, 0)[y])
        for found in reversed(above):
            both = prices[found]
            prices = both[: len(both) // 2] + both[len(both) // 2 :]
        return int(prices[0])


def _compared(key: tuple, table: pa.Table) -> pa.Table:
    """Prices of the source pairs of a block, and each source's most overweight terms in it."""
    lang, low, high, best = key[0].as_py(), key[2].as_py(), key[3].as_py(), key[4].as_py()
    rows = table.to_pydict()
    facts, counts = {}, []
    for i, term in enumerate(rows["term"]):
        if term is None:
            facts[rows["source"][i]] = (rows["side"][i], rows["size"][i], rows["terms"][i], rows["lang_size"][i], rows["block_terms"][i])
        else:
            counts.append(i)
    names = sorted(facts, key=str.encode)
    number = {s: k for k, s in enumerate(names)}
    _, _, terms, lang_size, block_terms = facts[names[0]]
    totals = {rows["term"][i]: rows["total"][i] for i in counts}
    ids = {t: k for k, t in enumerate(sorted(totals, key=lambda t: (-totals[t], t.encode())))}
    grid = np.zeros((len(names), len(ids)), np.int64)
    if counts:
        grid[[number[rows["source"][i]] for i in counts], [ids[rows["term"][i]] for i in counts]] = [rows["n"][i] for i in counts]
    out = []
    if terms:
        trees = Trees(grid) if ids else None
        values = trees.values.tolist() if ids else []
        own = [shares(values, facts[s][1], terms) for s in names]
        none = [int(shares([0], facts[s][1], terms)[0]) for s in names]
    for a in range(len(names)):
        for b in range(a + 1, len(names)):
            if low != high and facts[names[a]][0] == facts[names[b]][0]:
                continue  # another task compares these
            value = 0
            if terms:  # ids of no source here: a subtree of zeros only
                value = (block_terms - len(ids)) * abs(none[a] - none[b])
                value += trees.price(a, b, own[a], own[b]) if ids else 0
            out.append((names[a], "pair", names[b], value))
    if low == high and ids:
        by_id = list(ids)
        of_lang = shares([totals[t] for t in by_id], lang_size, terms)
        order = np.empty(len(by_id), np.int64)
        order[sorted(range(len(by_id)), key=lambda k: by_id[k].encode())] = np.arange(len(by_id))
        for a, source in enumerate(names):
            over = own[a][np.searchsorted(trees.values, grid[a])] - of_lang
            found = np.flatnonzero((grid[a] > 0) & (over > 0))
            found = found[np.lexsort((order[found], -over[found]))][:best]
            out += [(source, "term", by_id[k], int(over[k])) for k in found]
    columns = list(zip(*out)) or [(), (), (), ()]
    return pa.table({"lang": pa.array([lang] * len(out), pa.string()), "source": pa.array(columns[0], pa.string()), "part": pa.array(columns[1], pa.string()), "item": pa.array(columns[2], pa.string()), "value": pa.array(columns[3], pa.int64())})


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = 30, best: int = 50) -> DataFrame:
    """(``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``) for every source of every language.

    Part ``pair`` prices the distance to each other source over the language's
    terms found in ``least_docs`` documents; part ``term`` has the ``best`` terms
    that a source uses more than its language does. Null texts, languages and
    sources count as empty strings. Groups without terms have shares of zero
    counts; a language without kept terms has distances of 0; an empty table
    gives no rows. Rows that repeat are documents of their own.

    The contract asks for each pair of sources, so rows grow with the square of
    a language's sources; tasks are cut by term blocks and by pairs of source
    chunks, so none holds all terms or all sources.
    """

    def plain(name: str, to: str):
        return F.coalesce(column(name).cast("string"), F.lit("")).alias(to)

    rows = docs.select(plain(lang_col, "lang"), plain(source_col, "source"), plain(text_col, "text"))
    partial = rows.mapInArrow(_counted, "lang string, source string, term string, n long, d long")
    counts = partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    same = Window.partitionBy("lang", "term")
    kept = counts.select(
        "lang", "source", "term", "n", F.sum("n").over(same).alias("total"), F.sum("d").over(same).alias("docs"),
        F.row_number().over(same.orderBy("source")).alias("nth"), F.xxhash64("term").alias("hash"),
    )
    kept = settled(kept.where(F.col("docs") >= least_docs).drop("docs"))
    blocks = max(8, kept.count() // _BLOCK_ROWS)
    kept = kept.withColumn("block", F.pmod("hash", F.lit(blocks)).cast("int"))
    by_source = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    by_lang = kept.groupBy("lang").agg(F.sum("n").alias("lang_size"), F.sum((F.col("nth") == 1).cast("long")).alias("terms"))
    groups = rows.select("lang", "source").distinct()
    chunks = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / _CHUNK).cast("int").alias("chunks"))
    groups = groups.join(by_source, ["lang", "source"], "left").join(by_lang, "lang", "left").join(chunks, "lang")
    groups = groups.withColumn("side", F.pmod(F.xxhash64("source"), "chunks").cast("int")).na.fill(0, ["size", "lang_size", "terms"])
    groups = settled(groups)

    # both kinds of rows go to every task that compares their source's chunk with another
    facing = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    by_block = kept.where("nth = 1").groupBy("lang", "block").agg(F.count(F.lit(1)).alias("block_terms"))
    every = groups.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")).join(by_block, ["lang", "block"], "left").na.fill(0, ["block_terms"])
    facts = every.select(
        "lang", "block", "source", "side", F.lit(None).cast("string").alias("term"), F.lit(None).cast("long").alias("n"), F.lit(None).cast("long").alias("total"),
        "size", "terms", "lang_size", "block_terms", facing.alias("other"),
    )
    none = [F.lit(None).cast("long").alias(c) for c in ("size", "terms", "lang_size", "block_terms")]
    sides = kept.join(groups.select("lang", "source", "side", "chunks"), ["lang", "source"])
    cells = sides.select("lang", "block", "source", "side", "term", "n", "total", *none, facing.alias("other"))
    both = facts.unionByName(cells).withColumn("low", F.least("side", "other")).withColumn("high", F.greatest("side", "other")).withColumn("best", F.lit(best))
    found = both.groupBy("lang", "block", "low", "high", "best").applyInArrow(_compared, "lang string, source string, part string, item string, value long")
    found = settled(found)

    pairs = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    turned = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    pairs = pairs.select("lang", turned.alias("e"), "value").select("lang", "e.source", F.lit("pair").alias("part"), "e.item", "value")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    terms = found.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(terms)

"""Near-duplicate texts by SimHash fingerprints, linked by meeting in the middle.

Two fingerprints that differ in at most 2r bits have a value within r bits of
both. So every distinct fingerprint emits all values within r bits of itself,
the values are shuffled, and fingerprints that meet at a value are checked.
With r = 1 that is 65 rows a fingerprint. Fingerprints at one value are linked
in a chain, not in all pairs: any two of them are within 2r bits, and the chain
joins the same component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeload.llm.common import give_back, column, settled
from lakeload.llm.components import components

_SEED = 42
_AT_ONCE = 1 << 15  # shingles whose bits are unpacked at once


def fingerprint(text: str | bytes | None, shingle: int = 3) -> int:
    """64 majority bits of the XXH64 of a text's word shingles, as an unsigned number.

    A-Z are lowered, words end at ASCII white space. A text of fewer words than
    a shingle has one shingle of them all; a text without words gives zero.
    """
    if not text:
        return 0
    words = (text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text).lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    size = min(shingle, len(words))
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - size + 1].tolist()
    stops = (ends[size - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], _SEED) for a, b in zip(starts, stops)], "<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _AT_ONCE):
        part = hashes[i : i + _AT_ONCE]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def with_fingerprint(docs: DataFrame, id_col: str, text_col: str, shingle: int = 3) -> DataFrame:
    """(``id``, ``text_hash``, ``fp``): each row's fingerprint as a signed long."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in batch["text"].to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["id"], batch["text_hash"], pa.array(found)], names=["id", "text_hash", "fp"])
        give_back()

    plain = docs.select(column(id_col).cast("long").alias("id"), column(text_col).cast("binary").alias("text"), _text_hash(text_col).alias("text_hash"))
    return plain.mapInArrow(rows, "id long, text_hash long, fp long")


def _ball(radius: int):
    """All values within ``radius`` bits of ``fp``, each with its highest changed bit."""
    near = F.array(F.struct(F.col("fp").alias("value"), F.lit(-1).alias("bit")))
    shell = near
    for _ in range(radius):
        shell = F.flatten(
            F.transform(
                shell,
                lambda s: F.transform(
                    F.when(s["bit"] < 63, F.sequence(s["bit"] + 1, F.lit(63))).otherwise(F.expr("array()").cast("array<int>")),
                    lambda i: F.struct(s["value"].bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)).alias("value"), i.alias("bit")),
                ),
            )
        )
        near = F.concat(near, shell)
    return F.transform(near, lambda s: s["value"])


def near_links(fingerprints: DataFrame, max_bits: int = 2) -> DataFrame:
    """Links (``u``, ``v``) that join all distinct fingerprints (``fp``) at most ``max_bits`` apart."""
    if max_bits % 2:
        raise ValueError("an odd number of bits has no half")
    met = fingerprints.select("fp", F.explode(_ball(max_bits // 2)).alias("value"))
    before = F.lag("fp").over(Window.partitionBy("value").orderBy("fp"))
    pairs = met.select("fp", before.alias("other")).where("other IS NOT NULL")
    pairs = pairs.select(F.col("other").alias("u"), F.col("fp").alias("v")).distinct()
    return pairs.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """(``id``, ``fingerprint``, ``component_id``) for every row of ``docs``.

    Rows whose fingerprints differ in at most ``max_bits`` bits are linked;
    ``component_id`` is the smallest id that links lead to, its own included.
    Null and wordless texts have fingerprint zero and are linked like others.
    A null id is never a component's id unless no other is there. Repeated rows
    come out as often as they came in.
    """
    found = settled(with_fingerprint(docs, id_col, text_col, shingle))
    rooted = _rooted(found, max_bits, F.min("id"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    component = rooted.join(smallest, "root").select("fp", "component_id")
    return found.join(component, "fp").select(
        "id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def _rooted(found: DataFrame, max_bits: int, least: Column) -> DataFrame:
    """(``fp``, ``least``, ``root``): each fingerprint's aggregate ``least`` and the least fingerprint it leads to."""
    least = found.groupBy("fp").agg(least.alias("least"))
    roots = components(near_links(least.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    return least.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one row of every component: one with its smallest id.

    Rows that repeat an id with texts of different components stay, one for
    each component; of texts of one id and component the one with the least
    hash stays, and one of rows that repeat both. Rows without an id stay.
    """
    found = settled(with_fingerprint(docs, id_col, text_col, shingle))
    named = F.when(F.col("id").isNotNull(), F.struct("id", "text_hash"))
    least = _rooted(found, max_bits, F.min(named)).groupBy("root").agg(F.min("least").alias("least"))
    least = least.where("least IS NOT NULL").select("least.*")
    own = [column(c) for c in docs.columns]
    rows = docs.select(F.struct(*own).alias("_row"), column(id_col).cast("long").alias("id"), _text_hash(text_col).alias("text_hash"))
    single = rows.where("id IS NOT NULL").join(least, ["id", "text_hash"], "left_semi").dropDuplicates(["id", "text_hash"])
    kept = single.select("_row").unionByName(rows.where("id IS NULL").select("_row"))
    return kept.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])


def _text_hash(text_col: str) -> Column:
    return F.xxhash64(column(text_col).cast("binary"))

"""Finding what differs between a source and its copy without comparing all rows.

Both sides are summed up to order-free digests (rows, exclusive or and sum of
their hashes) per block, a block being a month and a range of key hashes. That
needs no shuffle of rows: a task sends one line per block. Only rows of blocks
whose digests differ are then compared by key, so a copy that is nearly right
costs two scans and next to no shuffle; and unlike a look-up of changes it also
finds the records that are gone from the source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakeload.functions.times import month_bucket
from lakeload.operators.conform import source_column
from lakeload.operators.versioned import row_hash

_BLOCK = ["__month", "__range"]


def _tagged(df: DataFrame, key: str, columns: Sequence[str], date_column: str | None, ranges: int) -> DataFrame:
    """Key, block and content hash of every row."""
    month = month_bucket(source_column(date_column)) if date_column is not None else F.lit(0)
    part = F.pmod(F.xxhash64(source_column(key)), F.lit(ranges)).cast("int")
    return df.select(source_column(key).alias("__key"), month.alias(_BLOCK[0]), part.alias(_BLOCK[1]), row_hash(columns).alias("__hash"))


def _digest() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.bit_xor("__hash").alias("hash_xor"),
        F.sum(F.col("__hash").cast("decimal(38,0)")).alias("hash_sum"),
    ]


def block_digests(df: DataFrame, key: str, columns: Sequence[str], date_column: str | None = None, ranges: int = 64) -> DataFrame:
    """(``month``, ``key_range``, ``n_rows``, ``hash_xor``, ``hash_sum``): at most one row per month and range."""
    found = _tagged(df, key, columns, date_column, ranges).groupBy(*_BLOCK).agg(*_digest())
    return found.withColumnsRenamed({_BLOCK[0]: "month", _BLOCK[1]: "key_range"})


def differing_blocks(source: DataFrame, target: DataFrame) -> DataFrame:
    """(``month``, ``key_range``) of the digests that are not the same on both sides."""
    facts = ["n_rows", "hash_xor", "hash_sum"]
    theirs = target.withColumnsRenamed({c: f"__{c}" for c in facts})
    both = source.join(theirs, ["month", "key_range"], "full_outer")
    same = F.lit(True)
    for c in facts:
        same &= F.col(c).eqNullSafe(F.col(f"__{c}"))
    return both.where(~same).select("month", "key_range")


def reconcile(
    source: DataFrame,
    target: DataFrame,
    key: str,
    columns: Sequence[str] | None = None,
    date_column: str | None = None,
    ranges: int = 64,
) -> DataFrame:
    """(``key``, ``change``): records ``new`` in the source, ``changed``, or ``gone`` from it.

    Target values are compared as the source's types. Blocks are at most
    ``ranges`` times the months, which bounds what is joined back to the rows. A
    record whose date moved is in two blocks that differ, so it is found as
    changed. Several rows of a key count together, in any order; null keys are
    one key. Equal sides give no rows.
    """
    columns = list(columns or source.columns)
    types = {f.name: f.dataType for f in source.schema}
    needed = dict.fromkeys([key, *columns, *([date_column] if date_column else [])])
    sides = []
    for df in (source, target):
        alike = df.select(*(source_column(c).cast(types[c]).alias(c) for c in needed))
        sides.append(_tagged(alike, key, columns, date_column, ranges))
    digests = [s.groupBy(*_BLOCK).agg(*_digest()).withColumnsRenamed({_BLOCK[0]: "month", _BLOCK[1]: "key_range"}) for s in sides]
    blocks = differing_blocks(*digests).withColumnsRenamed({"month": _BLOCK[0], "key_range": _BLOCK[1]})
    ours, theirs = (
        s.join(blocks, _BLOCK, "left_semi").groupBy("__key").agg(F.struct(*_digest()).alias(f"__{name}"))
        for name, s in zip(("ours", "theirs"), sides)
    )
    theirs = theirs.withColumnRenamed("__key", "__their_key")
    both = ours.join(theirs, F.col("__key").eqNullSafe(F.col("__their_key")), "full_outer")
    change = F.when(F.col("__theirs").isNull(), "new").when(F.col("__ours").isNull(), "gone").when(F.col("__ours") != F.col("__theirs"), "changed")
    found = both.select(F.when(F.col("__ours").isNull(), F.col("__their_key")).otherwise(F.col("__key")).alias(key), change.alias("change"))
    return found.where(F.col("change").isNotNull())

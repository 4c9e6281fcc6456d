"""Joins to a one-row-per-key side that stay balanced when a key is hot.

Spark's own skew handling splits a hot partition only where the join reads
plain shuffles. A side that was just aggregated to one row per key is not one,
so a key holding, say, a third of the left rows would land in one task. Here
the hottest keys get salts, as many as their share of the rows calls for:
their left rows spread over that many tasks and their single right row is
repeated once per salt. All other keys join unsalted, so nothing is dropped
and the result does not depend on which keys were salted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakeload.operators.conform import source_column

_SALT = "__salt"

HotKeys = Mapping[int, int]
"""Key hash -> number of salts, a power of two."""


def hot_keys(df: DataFrame, *key_sets: Sequence[str]) -> list[HotKeys]:
    """Per key set, the keys with more rows than an average shuffle task.

    Mergeable heavy-hitter sketches, all in one pass over the key columns: no
    shuffle of keys. No more keys than partitions can be that large, so that
    many values come back at most. The keys are read once more for it, before
    the plan that uses the result is built.
    """
    partitions = _partitions(df)
    tracked = min(max(16 * partitions, 1024), 1_000_000)
    hashed = df.select(*(F.xxhash64(*keys).alias(f"h{i}") for i, keys in enumerate(key_sets)))
    sketches = [F.expr(f"approx_top_k(h{i}, {min(partitions, tracked)}, {tracked})").alias(f"top{i}") for i in range(len(key_sets))]
    row = hashed.agg(F.count(F.lit(1)).alias("n"), *sketches).first()
    found = []
    for i in range(len(key_sets)):
        tasks = {t["item"]: t["count"] * partitions / row["n"] for t in row[f"top{i}"] or []}
        found.append({h: 1 << int(2 * size - 1).bit_length() for h, size in tasks.items() if size > 1})
    return found


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    hot: HotKeys | None = None,
    hot_on: Sequence[str] | None = None,
) -> DataFrame:
    """Join ``left`` to ``right``, which has at most one row per key.

    ``how`` is ``left`` or ``inner``. ``hot`` are the hot values of ``hot_on``
    (all keys by default) found earlier with :func:`hot_keys`; without it they
    are looked up now, which reads the left keys once more.
    """
    keys = list(keys)
    hot_on = list(hot_on or keys)
    types = {k: left.schema[k].dataType for k in keys}
    # hashes agree only between equal types; what does not fit the left type matches nothing
    right = right.withColumns({k: F.col(k).try_cast(types[k]) for k in keys if right.schema[k].dataType != types[k]})
    if hot is None:
        (hot,) = hot_keys(left, hot_on)
    if not hot:
        return left.join(right, keys, how)
    salts = _salts_of_key(hot, hot_on)
    salted = left.withColumn(_SALT, F.when(salts > 1, F.pmod(_spread(left), salts)).otherwise(F.lit(0)))
    repeated = right.withColumn(_SALT, F.explode(F.sequence(F.lit(0), salts - 1)))
    return salted.join(repeated, [*keys, _SALT], how).drop(_SALT)


def _salts_of_key(hot: HotKeys, hot_on: Sequence[str]) -> Column:
    """Number of salts of a row's key: one hash-set test per distinct number."""
    key = F.xxhash64(*hot_on)
    salts = F.when(F.lit(False), F.lit(1))
    for n in sorted(set(hot.values())):
        salts = salts.when(key.isin([h for h, of in hot.items() if of == n]), F.lit(n))
    return salts.otherwise(F.lit(1))


def _spread(df: DataFrame) -> Column:
    """A number that a retried task computes again, and that separates exact copies.

    The row's content hash alone would keep copies together; the number of the
    task reading them spreads those, and neither depends on row order.
    """
    limit = F.lit(1 << 30)
    content = F.pmod(F.xxhash64(*map(source_column, df.columns)), limit).cast("int")
    return F.pmod(content + F.spark_partition_id(), limit)


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

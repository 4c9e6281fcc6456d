"""Tables that keep the newest version of each record, and changes to them.

Everything is ``DataFrame -> DataFrame``; :mod:`lakeload.tables` applies the
same functions to the touched months of a stored table.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeload.contracts import TableContract
from lakeload.functions.times import UNDATED_MONTH, minus_days, month_bucket, month_number, ntz, plus_years, to_second
from lakeload.operators.conform import source_column
from lakeload.operators.skew import HotKeys, lookup_join

MONTH = "p_month"


def latest_version(
    df: DataFrame,
    key: Sequence[str | Column],
    order: Sequence[str],
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the greatest by ``order``, NULLs losing.

    Rows equal in all of ``order`` are separated by ``tiebreak``, by default a
    hash of the whole row, so the choice does not depend on how the data is
    partitioned. Because only the first row per key survives, each task prunes
    to one row per key before the shuffle: a key with very many versions sends
    at most one row per task.
    """
    rank = "__rank"
    ties = [F.desc_nulls_last(c) for c in tiebreak] if tiebreak is not None else [F.xxhash64(*map(source_column, df.columns)).desc()]
    ordering = [*(F.desc_nulls_last(c) for c in order), *ties]
    window = Window.partitionBy(*key).orderBy(*ordering)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) == 1).drop(rank)


def latest_by_contract(df: DataFrame, contract: TableContract, by_modification: bool = False) -> DataFrame:
    """Newest row per contract key.

    Under sort-key scope the key contains the date, so versions are replaced
    within a month only.
    The greatest version wins, then the latest modification: equal versions
    come from one load, which inserts in modification order. With
    ``by_modification`` the modification counts first.
    """
    order = [c for c in (contract.version_column, contract.modified_column) if c is not None]
    if by_modification:
        order.reverse()
    return latest_version(df, contract.key, order, contract.tiebreak)


def with_month(df: DataFrame, date_column: str) -> DataFrame:
    return df.withColumn(MONTH, month_bucket(source_column(date_column)))


def classify_changes(
    incoming: DataFrame,
    existing: DataFrame,
    key: str,
    modified: str,
    as_of: datetime | str | None = None,
    lookback_days: int | None = None,
    hot: HotKeys | None = None,
    unique: bool = False,
) -> DataFrame:
    """``incoming`` with column ``change``: ``new``, ``updated`` or ``unchanged``.

    ``new``: key not found; ``updated``: modified later than the existing
    record; otherwise unchanged (or stale). With ``lookback_days``, only
    existing rows modified within that many days before ``as_of`` are looked
    at, so an older known key counts as new. ``unique`` declares that
    ``existing`` has one row per key, as a compacted table does: then nothing
    is aggregated, no keys are read ahead, and adaptive execution splits hot
    keys of the plain join. Several rows per key would repeat incoming rows.
    """
    if lookback_days is not None:
        if as_of is None:
            raise ValueError("a look-back needs as_of")
        existing = existing.where(F.col(modified) >= minus_days(as_of, lookback_days))
    if unique:
        known = existing.select(key, F.col(modified).alias("__known_at"), F.lit(True).alias("__known"))
    else:
        known = existing.groupBy(key).agg(F.max(modified).alias("__known_at"), F.lit(True).alias("__known"))
    joined = lookup_join(incoming, known, [key], "left", {} if unique else hot)
    newer = F.col(modified).isNotNull() & (F.col("__known_at").isNull() | (F.col(modified) > F.col("__known_at")))
    change = F.when(F.col("__known").isNull(), "new").when(newer, "updated").otherwise("unchanged")
    return joined.select(*(source_column(c) for c in incoming.columns), change.alias("change"))


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    modified: str,
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """``existing`` with new keys added and records replaced by later versions.

    An incoming row replaces the existing one only if it was modified strictly
    later; of several incoming rows per key the latest counts. Written as one
    window over the union rather than a join and an anti-join: one shuffle,
    and many versions of one key do not meet in one task.
    """
    side = "__incoming"
    both = existing.withColumn(side, F.lit(0)).unionByName(incoming.withColumn(side, F.lit(1)))
    ordered = both.withColumn(side, -F.col(side))  # existing first among equals
    ties = [side, *(tiebreak if tiebreak is not None else [])]
    if tiebreak is None:
        ordered = ordered.withColumn("__tie", F.xxhash64(*map(source_column, existing.columns)))
        ties.append("__tie")
    return latest_version(ordered, key, [modified], ties).select(*(source_column(c) for c in existing.columns))


def row_hash(columns: Sequence[str]) -> Column:
    """64-bit content hash of a row; NULL positions count, so (NULL, 1) differs from (1, NULL)."""
    values = [source_column(c) for c in columns]
    return F.xxhash64(*values, *(v.isNull() for v in values))


def changes_by_hash(
    incoming: DataFrame,
    existing: DataFrame,
    key: str,
    columns: Sequence[str] | None = None,
    hot: HotKeys | None = None,
    order: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """``incoming`` with column ``change``: ``new``, ``changed`` or ``same`` by row content.

    Existing values are compared as the incoming types. Of several existing
    rows per key the greatest by ``order`` counts, as on a table that is not
    compacted. Only key, order and hash are shuffled. ``unique`` declares one
    existing row per key, as in :func:`classify_changes`.
    """
    columns = list(columns or incoming.columns)
    types = {f.name: f.dataType for f in incoming.schema}
    alike = existing.select(
        *(source_column(c).cast(types[c]).alias(c) for c in dict.fromkeys([key, *columns])),
        F.struct(*(source_column(c) for c in order), F.lit(0).alias("__")).alias("__order"),
    )
    old = alike.select(source_column(key).alias(key), "__order", row_hash(columns).alias("__old_hash"))
    if unique:
        old = old.drop("__order")
    else:
        newest = F.max(F.struct("__order", "__old_hash"))["__old_hash"]
        old = old.groupBy(source_column(key).alias(key)).agg(newest.alias("__old_hash"))
    joined = lookup_join(incoming.withColumn("__hash", row_hash(columns)), old, [key], "left", {} if unique else hot)
    change = (
        F.when(F.col("__old_hash").isNull(), "new")
        .when(F.col("__old_hash") == F.col("__hash"), "same")
        .otherwise("changed")
    )
    return joined.select(*(source_column(c) for c in incoming.columns), change.alias("change"))


def key_lookup(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is among ``keys``, however many there are."""
    return df.join(keys.select(*on), list(on), "left_semi")


def mark_synced(
    df: DataFrame,
    synced: str,
    mark: datetime | str,
    modified: str | None = None,
    first: datetime | str | None = None,
    last: datetime | str | None = None,
) -> DataFrame:
    """Set the sync mark on rows modified from ``first`` to ``last``, both inclusive.

    Bounds are cut to the second like the stored values. Without ``modified``
    every row is marked.
    """
    value = ntz(mark)
    if modified is not None:
        in_range = F.col(modified).between(to_second(ntz(first)), to_second(ntz(last)))
        old = F.col(synced) if synced in df.columns else F.lit(None).cast("timestamp_ntz")
        value = F.when(in_range, value).otherwise(old)
    return df.withColumn(synced, value)


def condition(predicate: str | Column | None) -> Column:
    """A delete/update predicate, NULL counting as false; an empty one is an error."""
    if predicate is None or (isinstance(predicate, str) and not predicate.strip()):
        raise ValueError("a condition is required")
    column = F.expr(predicate) if isinstance(predicate, str) else predicate
    return F.coalesce(column, F.lit(False))


def delete_where(df: DataFrame, predicate: str | Column | None) -> DataFrame:
    """All rows but those the predicate holds for."""
    return df.where(~condition(predicate))


def retained(date_column: str, as_of: datetime | str, years: int) -> Column:
    """Whether a row's date plus the retention lies after ``as_of``; undated rows stay."""
    alive = plus_years(F.col(date_column).cast("timestamp_ntz"), years) > ntz(as_of)
    return F.coalesce(alive, F.lit(True))


def retain(df: DataFrame, date_column: str, as_of: datetime | str, years: int = 5) -> DataFrame:
    """Rows still inside their retention.

    The exact test adds years to the row's date, which no scan can use, so a
    slightly wider bare-column bound (leap days) goes with it, and the
    equivalent partition bound when the table is partitioned by month.
    """
    floor = ntz(as_of) - F.make_ym_interval(years=F.lit(years)) - F.make_dt_interval(days=F.lit(2))
    day = F.col(date_column)
    coarse = day.isNull() | (day >= floor)
    if MONTH in df.columns:
        coarse &= (F.col(MONTH) == UNDATED_MONTH) | (F.col(MONTH) >= month_bucket(floor))
    return df.where(coarse & retained(date_column, as_of, years))


def months_between(first: date, last: date) -> list[int]:
    """Month partitions a date range can fall into; Spark does not derive them from the date."""
    count = (last.year - first.year) * 12 + last.month - first.month + 1
    return [month_number(date(first.year + m // 12, m % 12 + 1, 1)) for m in range(first.month - 1, first.month - 1 + count)]

"""What part of a source a load picks up: watermarks, look-back, ranges, lookups."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, functions as F

from lakeload.functions.casts import wall_clock
from lakeload.functions.times import minus_months, ntz
from lakeload.operators.conform import source_column


def modified_time(df: DataFrame, modified: str) -> Column:
    """The modification time of a raw row; unreadable text counts as NULL.

    A column that already is a zone-less timestamp is used as it is, so that
    comparisons with it reach the scan.
    """
    return wall_clock(source_column(modified), df.schema[modified].dataType)


def incremental_extract(df: DataFrame, modified: str, watermark: datetime | str | None) -> DataFrame:
    """Rows modified at or after the watermark; all rows when there is none.

    The bound is inclusive, so the boundary row is loaded again each run; the
    keyed target absorbs it. A source without the column yields nothing.
    """
    if modified not in df.columns:
        return df.where(F.lit(False))
    if watermark is None:
        return df
    return df.where(modified_time(df, modified) >= ntz(watermark))


def lookback_extract(df: DataFrame, modified: str, watermark: datetime | str | None, months: int = 1) -> DataFrame:
    """Rows modified strictly after the watermark minus whole calendar months."""
    if watermark is None:
        raise ValueError("a look-back extract needs a watermark")
    if modified not in df.columns:
        return df.where(F.lit(False))
    return df.where(modified_time(df, modified) > minus_months(watermark, months))


def date_between(df: DataFrame, column: str, first: date | str, last: date | str) -> DataFrame:
    """Rows dated from ``first`` to ``last``, both days whole.

    A half-open range on the bare column: equal to comparing its date, and
    usable by Parquet statistics and database indexes.
    """
    end = date.fromisoformat(str(last)) + timedelta(days=1)
    col = source_column(column)
    return df.where((col >= ntz(str(first))) & (col < ntz(end)))


def maximum(df: DataFrame, column: str) -> DataFrame:
    """One row ``high_water``, NULL over no rows: the last sync or last change."""
    return df.agg(F.max(source_column(column)).alias("high_water"))


def read_watermark(df: DataFrame, column: str) -> datetime | None:
    """The single value of :func:`maximum`, for use as a literal bound."""
    return maximum(df, column).first()["high_water"]


def batch_bounds(df: DataFrame, modified: str) -> DataFrame:
    """First and last modification time and row count, in one pass."""
    ts = modified_time(df, modified)
    return df.agg(
        F.min(ts).alias("modified_min"),
        F.max(ts).alias("modified_max"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def observed_bounds(df: DataFrame, modified: str, name: str = "bounds") -> tuple[DataFrame, Observation]:
    """``df`` to be written, and what :func:`batch_bounds` would say of it, counted on the way.

    The figures cost no pass of their own: they are there once an action on the
    returned frame has run.
    """
    ts = modified_time(df, modified)
    seen = Observation(name)
    return df.observe(seen, F.min(ts).alias("modified_min"), F.max(ts).alias("modified_max"), F.count(F.lit(1)).alias("n_rows")), seen


def by_modified(df: DataFrame, modified: str) -> DataFrame:
    """Oldest change first, undated rows last; a range shuffle, only for output order.

    Rows of one instant are further ordered by content and origin, so that a
    range boundary can fall among them however many there are.
    """
    ts = modified_time(df, modified)
    return df.orderBy(ts.asc_nulls_last(), F.xxhash64(*df.columns), F.spark_partition_id())


def point_lookup(df: DataFrame, key: str, value: object) -> DataFrame:
    return df.where(source_column(key) == F.lit(value))


def preview(df: DataFrame, modified: str, n: int = 3, tiebreak: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows in modification order (a per-task top-n, no full sort)."""
    order = [modified_time(df, modified).asc_nulls_last(), *(F.asc(c) for c in tiebreak or [])]
    return df.orderBy(*order).limit(n)


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()


"""Date and time expressions.

Warehouse timestamps carry no zone (``timestamp_ntz``), so nothing here goes
through the zoned timestamp type, whose arithmetic depends on the session zone.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, functions as F

# Dates before this instant stand for "no date" in the source
# system; freshness is reported in the shop's local zone and text format.
SENTINEL_BEFORE = "2000-01-01 00:00:00"
FRESHNESS_ZONE = "Asia/Ho_Chi_Minh"
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss"

UNDATED_MONTH = 0
"""Month bucket of rows without a date; keeps the partition column non-null."""


def ntz(value: datetime | date | str) -> Column:
    """A zone-less timestamp literal (folded, hence pushed down to scans)."""
    if isinstance(value, datetime) and value.tzinfo is not None:
        raise ValueError("expected a datetime without zone")
    return F.lit(str(value)).cast("timestamp_ntz")


def load_time(as_of: datetime | str | None) -> Column:
    """The load instant: ``as_of`` when given, else the query's own clock."""
    return F.localtimestamp() if as_of is None else ntz(as_of)


def to_second(col: Column) -> Column:
    """Cut sub-seconds; ``date_trunc`` would return a zoned timestamp."""
    second = F.extract(F.lit("SECOND"), col)
    return col - F.make_dt_interval(secs=second - F.floor(second))


def drop_sentinel(col: Column) -> Column:
    """NULL instead of the placeholder dates before 2000."""
    return F.when(col >= ntz(SENTINEL_BEFORE), col)


def month_bucket(col: Column) -> Column:
    """``yyyymm`` as int, the partition value of month-partitioned tables."""
    return F.coalesce(F.year(col) * 100 + F.month(col), F.lit(UNDATED_MONTH)).cast("int")


def month_number(day: date) -> int:
    return day.year * 100 + day.month


def minus_months(value: datetime | str, months: int) -> Column:
    """Calendar-month subtraction: 31 March - 1 month is the end of February."""
    return ntz(value) - F.make_ym_interval(months=F.lit(months))


def minus_days(value: datetime | str, days: int) -> Column:
    return ntz(value) - F.make_dt_interval(days=F.lit(days))


def plus_years(col: Column, years: int) -> Column:
    return col + F.make_ym_interval(years=F.lit(years))


def zone_text(col: Column, zone: str = FRESHNESS_ZONE) -> Column:
    """An instant (zoned timestamp) as local wall-clock text in ``zone``."""
    utc = F.to_utc_timestamp(col, F.current_timezone())
    return F.date_format(F.from_utc_timestamp(utc, zone), TIMESTAMP_TEXT)


def strict_timestamp(col: Column) -> Column:
    """Text in exactly ``yyyy-MM-dd HH:mm:ss``, anything else is NULL."""
    return F.try_to_timestamp(col, F.lit(TIMESTAMP_TEXT)).cast("timestamp_ntz")

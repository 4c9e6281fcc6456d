"""Tolerant casts: source values that do not fit become NULL or a fill value.

Each function takes the column and its Spark type, because the cheapest safe
cast depends on where the value comes from. Nothing raises under ANSI mode and
everything stays inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from lakeload.functions.times import drop_sentinel, to_second

# Fill of missing values in non-nullable columns, and the number
# of decimals a float keeps on its way into the warehouse.
TEXT_FILL = ""
CODE_FILL = "unknown"
FLOAT_DECIMALS = 6

# Wide enough for every 64-bit integer, signed or not.
_EXACT_NUMBER = "decimal(38,18)"

_TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


def is_temporal(source: T.DataType) -> bool:
    return isinstance(source, _TEMPORAL)


def _is_number(source: T.DataType) -> bool:
    return isinstance(source, (T.NumericType, T.BooleanType))


def integer(col: Column, source: T.DataType, target: T.DataType) -> Column:
    """Whole number, fractions cut toward zero; NULL if unparseable or too big."""
    if isinstance(source, T.StringType):
        # '1.5' has no direct integer cast, and going through double would
        # lose the low digits of 64-bit keys
        return col.try_cast(_EXACT_NUMBER).try_cast(target)
    if _is_number(source):
        return col.try_cast(target)
    return F.lit(None).cast(target)


def floating(col: Column, source: T.DataType, target: T.DataType) -> Column:
    """Finite number rounded to six decimals; NULL for NaN and infinities."""
    if not (isinstance(source, T.StringType) or _is_number(source)):
        return F.lit(None).cast(target)
    x = col if isinstance(source, T.DoubleType) else col.try_cast("double")
    finite = F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)
    return F.round(finite, FLOAT_DECIMALS).cast(target)


def exact_decimal(col: Column, source: T.DataType, target: T.DecimalType) -> Column:
    if isinstance(source, T.StringType) or _is_number(source):
        return col.try_cast(target)
    return F.lit(None).cast(target)


def boolean(col: Column, source: T.DataType) -> Column:
    if isinstance(source, T.BooleanType):
        return col
    if isinstance(source, T.NumericType):
        return col != 0
    if isinstance(source, T.StringType):
        return col.try_cast("boolean")
    return F.lit(None).cast("boolean")


def text(col: Column, source: T.DataType) -> Column:
    """Text with newlines flattened to spaces."""
    value = col
    if not isinstance(source, T.StringType):
        value = (drop_sentinel(wall_clock(col, source)) if is_temporal(source) else col).cast("string")
    return F.replace(value, F.lit("\n"), F.lit(" "))


def wall_clock(col: Column, source: T.DataType) -> Column:
    """Zone-less timestamp; text and instants that cannot be read are NULL."""
    if isinstance(source, T.TimestampNTZType):
        return col
    if isinstance(source, T.TimestampType):
        return F.to_utc_timestamp(col, F.current_timezone()).cast("timestamp_ntz")
    if isinstance(source, T.DateType):
        return col.cast("timestamp_ntz")
    if isinstance(source, T.StringType):
        return col.try_cast("timestamp_ntz")
    if isinstance(source, T.NumericType):
        # numbers are nanoseconds since the epoch
        seconds = F.make_dt_interval(secs=(col.try_cast("long") / 1e9).cast("decimal(18,6)"))
        return F.lit("1970-01-01").cast("timestamp_ntz") + seconds
    return F.lit(None).cast("timestamp_ntz")


def timestamp(col: Column, source: T.DataType) -> Column:
    """Second-precision timestamp; placeholder dates are NULL."""
    return to_second(drop_sentinel(wall_clock(col, source)))


def day(col: Column, source: T.DataType) -> Column:
    return drop_sentinel(wall_clock(col, source)).cast("date")


def as_number(col: Column, source: T.DataType) -> Column:
    """Approximate value of anything numeric, to tell 'too big' from 'not a number'."""
    if isinstance(source, T.StringType) or _is_number(source):
        return col.try_cast("double")
    return F.lit(None).cast("double")

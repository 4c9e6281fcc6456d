"""Conform a batch to a table contract, in one projection.

Columns the contract does not know are dropped, declared columns the batch
lacks are added with their default, the rest are cast tolerantly, and the
result is in contract order. A single ``select`` keeps the plan flat for
tables with hundreds of columns and prunes the scan to what is needed.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lakeload.contracts import DEFAULT, TableContract, declared_type
from lakeload.functions import casts
from lakeload.functions.times import load_time

_CODES = ("Enum8", "Enum16", "UUID")


def source_column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def extra_columns(df: DataFrame, contract: TableContract) -> list[str]:
    """Incoming columns the contract does not declare; conforming drops them."""
    return [c for c in df.columns if c not in contract.schema.names]


def missing_columns(df: DataFrame, contract: TableContract) -> list[str]:
    """Declared columns the batch lacks; conforming adds them."""
    return [c for c in contract.schema.names if c not in df.columns]


def conform(df: DataFrame, contract: TableContract, as_of: datetime | str | None = None) -> DataFrame:
    """``df`` in the contract's columns, types and order.

    ``as_of`` is the load time given to ``now()`` defaults.
    """
    return df.select(*(conformed_column(df, f, contract, as_of).alias(f.name) for f in contract.schema))


def conformed_column(
    df: DataFrame, f: T.StructField, contract: TableContract, as_of: datetime | str | None = None
) -> Column:
    """One declared column, from the batch or from its default."""
    if f.name in df.columns:
        value = conformed(source_column(f.name), df.schema[f.name].dataType, f, contract)
    else:
        value = added(df.sparkSession, f, contract, as_of)
    return value.cast(f.dataType)


def conformed(col: Column, source: T.DataType, f: T.StructField, contract: TableContract) -> Column:
    """Value of an existing column, missing values filled unless nullable."""
    value = tolerant(col, source, f)
    if f.nullable:
        return value
    fill = type_zero(f, contract)
    return value if fill is None else F.coalesce(value, fill)


def tolerant(col: Column, source: T.DataType, f: T.StructField) -> Column:
    """The cast alone: NULL wherever the value is missing or does not fit."""
    target = f.dataType
    if isinstance(target, T.StringType):
        return casts.text(col, source)
    if isinstance(target, T.IntegralType):
        return casts.integer(col, source, target)
    if isinstance(target, T.DecimalType):
        return casts.exact_decimal(col, source, target)
    if isinstance(target, (T.FloatType, T.DoubleType)):
        return casts.floating(col, source, target)
    if isinstance(target, T.BooleanType):
        return casts.boolean(col, source)
    if isinstance(target, T.DateType):
        return casts.day(col, source)
    if isinstance(target, T.TimestampNTZType):
        return casts.timestamp(col, source)
    raise ValueError(f"column {f.name}: contract type {target.simpleString()} is not loadable")


def type_zero(f: T.StructField, contract: TableContract) -> Column | None:
    """Fill of a missing value in a non-nullable column, None to leave NULL.

    Dates stay NULL unless the contract asks for the epoch; the sync mark is
    NULL until a load sets it.
    """
    if isinstance(f.dataType, T.StringType):
        return F.lit(casts.CODE_FILL if declared_type(f) in _CODES else casts.TEXT_FILL)
    if casts.is_temporal(f.dataType):
        if contract.null_date == "epoch" and f.name != contract.synced_column:
            return F.lit("1970-01-01").cast(f.dataType)
        return None
    if isinstance(f.dataType, T.BooleanType):
        return F.lit(False)
    return F.lit(0).cast(f.dataType)


def added(spark: SparkSession, f: T.StructField, contract: TableContract, as_of: datetime | str | None) -> Column:
    """Value of a declared column the batch does not have."""
    empty = F.lit(None).cast(f.dataType)
    default = f.metadata.get(DEFAULT)
    if default:
        if isinstance(f.dataType, T.TimestampNTZType):
            return load_time(as_of) if "now()" in default else empty
        if isinstance(f.dataType, T.NumericType) and not isinstance(f.dataType, T.DecimalType):
            constant = _constant(spark, default)
            if constant is not None:
                return F.lit(constant).try_cast(f.dataType)
        elif isinstance(f.dataType, T.StringType) and declared_type(f) not in _CODES:
            return F.lit(default)
    if f.nullable:
        return empty
    if isinstance(f.dataType, T.StringType):
        return F.lit(casts.TEXT_FILL)
    fill = type_zero(f, contract)
    return empty if fill is None else fill


def _constant(spark: SparkSession, default: str) -> object:
    """Value of a constant SQL expression, None if it cannot be evaluated."""
    for number in (int, float):
        try:
            return number(default)
        except ValueError:
            pass
    try:
        return spark.sql(f"SELECT {default}").first()[0]
    except PySparkException:
        return None

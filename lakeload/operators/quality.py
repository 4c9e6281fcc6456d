"""Primary-key validity, rows a batch must not load, and schema/coercion reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lakeload.contracts import DEFAULT, TableContract, declared_type, integer_bounds
from lakeload.functions import casts
from lakeload.functions.times import SENTINEL_BEFORE, ntz
from lakeload.operators.conform import source_column, tolerant

REASON = "reject_reason"
INVALID_KEY = "invalid primary key"


def valid_key(col: Column, source: T.DataType, f: T.StructField) -> Column:
    """Whether a raw key value is acceptable for the declared key type.

    Unsigned: a whole number >= 0; signed: a whole number; float: a number;
    text: always; any other type: never. Keys are judged before coercion,
    which would turn an unreadable key into 0.
    """
    declared = declared_type(f)
    if declared == "String":
        return F.lit(True)
    if declared.startswith("Float"):
        return casts.as_number(col, source).isNotNull()
    if not declared.startswith(("UInt", "Int")):
        return F.lit(False)
    whole = _whole(col, source)
    ok = whole.isNotNull() & (whole >= 0) if declared.startswith("U") else whole.isNotNull()
    return F.coalesce(ok, F.lit(False))


def _whole(col: Column, source: T.DataType) -> Column:
    """The value if it is integral, in a type that holds any 64-bit integer."""
    if isinstance(source, T.StringType):
        # all digits with an optional sign; '2.7' is not a key
        return F.when(F.trim(col).rlike(r"^[+-]?[0-9]+$"), col.try_cast("decimal(38,0)"))
    if isinstance(source, T.IntegralType):
        return col
    if isinstance(source, T.NumericType):
        value = col.try_cast("decimal(38,0)")
        return F.when(value == col, value)
    return F.lit(None).cast("long")


def out_of_range(col: Column, source: T.DataType, f: T.StructField) -> Column | None:
    """Whether a numeric value cannot be held by an integer column, None if it always can."""
    bounds = integer_bounds(f)
    if bounds is None or not isinstance(source, (T.StringType, T.NumericType)):
        return None
    held = integer_bounds(T.StructField(f.name, source)) if isinstance(source, T.IntegralType) else None
    if held and bounds[0] <= held[0] and held[1] <= bounds[1]:
        return None
    number = casts.as_number(col, source)
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) != float("inf"))
    value = casts.integer(col, source, T.LongType())
    outside = value.isNull() | (value < F.lit(bounds[0])) | (value > F.lit(bounds[1]))
    return finite & outside


def reject_reason(df: DataFrame, contract: TableContract) -> Column:
    """Why a raw row cannot be loaded, NULL for loadable rows."""
    incoming = {f.name: f.dataType for f in df.schema}
    key = contract.schema[contract.primary_key]
    if key.name not in incoming:
        return F.lit(INVALID_KEY)
    reason = F.when(~valid_key(source_column(key.name), incoming[key.name], key), F.lit(INVALID_KEY))
    for f in contract.schema:
        if f.name in incoming:
            outside = out_of_range(source_column(f.name), incoming[f.name], f)
            if outside is not None:
                reason = reason.when(outside, F.lit(f"value out of range: {f.name}"))
    return reason


def with_reason(df: DataFrame, contract: TableContract) -> DataFrame:
    return df.withColumn(REASON, reject_reason(df, contract))


def split_rejects(df: DataFrame, contract: TableContract) -> tuple[DataFrame, DataFrame]:
    """(accepted raw rows, rejected raw rows with their reason); together all of ``df``."""
    tagged = with_reason(df, contract)
    return tagged.where(F.col(REASON).isNull()).drop(REASON), tagged.where(F.col(REASON).isNotNull())


def drift_report(df: DataFrame, contract: TableContract) -> DataFrame:
    """Incoming columns the contract lacks, their neighbours, and the values they carry.

    One row per undeclared column: the incoming column before and after it
    (NULL at the ends) and how many non-null values conforming would drop.
    """
    names = df.columns
    extra = [(i, c) for i, c in enumerate(names) if c not in contract.schema.names]
    schema = "missing_column string, prev_column string, next_column string, dropped_values long"
    if not extra:
        return df.sparkSession.createDataFrame([], schema)
    counts = df.agg(*[F.count(source_column(c)).alias(f"n{i}") for i, c in extra])
    rows = [
        F.struct(
            F.lit(c).alias("missing_column"),
            F.lit(names[i - 1] if i else None).cast("string").alias("prev_column"),
            F.lit(names[i + 1] if i + 1 < len(names) else None).cast("string").alias("next_column"),
            F.col(f"n{i}").alias("dropped_values"),
        )
        for i, c in extra
    ]
    return counts.select(F.inline(F.array(*rows)))


def coercion_loss(df: DataFrame, contract: TableContract) -> DataFrame:
    """Per declared column: NULLs, values the cast loses, and placeholder dates.

    A single aggregation over the batch, however many columns there are.
    """
    incoming = {f.name: f.dataType for f in df.schema}
    counted = [f for f in contract.schema if f.name in incoming]
    aggregates = []
    for i, f in enumerate(counted):
        col, source = source_column(f.name), incoming[f.name]
        sentinel = F.lit(False)
        if casts.is_temporal(f.dataType) or casts.is_temporal(source):
            sentinel = casts.wall_clock(col, source) < ntz(SENTINEL_BEFORE)
        sentinel = F.coalesce(sentinel, F.lit(False))
        failed = F.lit(False)
        if _can_fail(source, f.dataType):
            failed = col.isNotNull() & tolerant(col, source, f).isNull() & ~sentinel
        aggregates += [
            F.count_if(col.isNull()).alias(f"nulls{i}"),
            F.count_if(failed).alias(f"failed{i}"),
            F.count_if(sentinel).alias(f"sentinels{i}"),
        ]
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(declared_type(f)).alias("declared"),
            F.col("n_rows"),
            F.col(f"nulls{i}").alias("null_rows"),
            F.col(f"failed{i}").alias("failed_casts"),
            F.col(f"sentinels{i}").alias("sentinel_dates"),
        )
        for i, f in enumerate(counted)
    ]
    totals = df.agg(F.count(F.lit(1)).alias("n_rows"), *aggregates)
    return totals.select(F.inline(F.array(*rows)))


def _can_fail(source: T.DataType, target: T.DataType) -> bool:
    """Whether some value of the source type has no counterpart in the target type."""
    if isinstance(target, T.StringType) or (casts.is_temporal(source) and casts.is_temporal(target)):
        return False
    return source != target or isinstance(target, (T.FloatType, T.DoubleType))


def contract_profile(df: DataFrame, contract: TableContract) -> DataFrame:
    """The contract as rows (position, type, nullability, default) with the values each column holds."""
    fields = list(enumerate(contract.schema))
    present = [(i, f) for i, f in fields if f.name in df.columns]
    totals = df.agg(F.count(F.lit(1)), *(F.count(source_column(f.name)).alias(f"n{i}") for i, f in present))
    rows = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(declared_type(f)).alias("declared"),
            F.lit(f.nullable).alias("nullable"),
            F.lit(f.metadata.get(DEFAULT)).cast("string").alias("default_text"),
            (F.col(f"n{i}") if f.name in df.columns else F.lit(0).cast("long")).alias("n_values"),
        )
        for i, f in fields
    ]
    return totals.select(F.inline(F.array(*rows)))

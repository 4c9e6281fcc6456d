"""One load: pick up changes, set bad rows aside, conform, merge, mark, audit."""

from __future__ import annotations

import time
import uuid
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from lakeload.contracts import TableContract
from lakeload.functions.times import month_bucket, ntz, to_second
from lakeload.operators.conform import conform, conformed_column, extra_columns, missing_columns, source_column
from lakeload.operators.incremental import incremental_extract, lookback_extract, modified_time
from lakeload.operators.quality import REASON, reject_reason
from lakeload.operators.versioned import mark_synced
from lakeload.sources.files import newest_modification, read_newer, read_or_empty
from lakeload.tables import MonthTable

MODES = ("full", "daily", "monthly")


@dataclass
class LoadReport:
    """What one run did; one row of the audit table."""

    run_id: str
    table_name: str
    mode: str
    status: str = "started"
    started_at: datetime | None = None
    modified_min: datetime | None = None
    modified_max: datetime | None = None
    synced_at: datetime | None = None
    rows_read: int = 0
    rows_rejected: int = 0
    rows_accepted: int = 0
    rows_in_months: int = 0
    dropped_columns: list[str] = field(default_factory=list)
    added_columns: list[str] = field(default_factory=list)
    source_modified: datetime | None = None
    extract_seconds: float = 0.0
    load_seconds: float = 0.0
    error: str | None = None


_TEXT, _COUNT, _TIME, _SECONDS = T.StringType(), T.LongType(), T.TimestampNTZType(), T.DoubleType()
_NAMES = T.ArrayType(T.StringType())
_AUDIT = T.StructType(
    [
        T.StructField("run_id", _TEXT),
        T.StructField("table_name", _TEXT),
        T.StructField("mode", _TEXT),
        T.StructField("status", _TEXT),
        T.StructField("started_at", _TIME),
        T.StructField("modified_min", _TIME),
        T.StructField("modified_max", _TIME),
        T.StructField("synced_at", _TIME),
        T.StructField("rows_read", _COUNT),
        T.StructField("rows_rejected", _COUNT),
        T.StructField("rows_accepted", _COUNT),
        T.StructField("rows_in_months", _COUNT),
        T.StructField("dropped_columns", _NAMES),
        T.StructField("added_columns", _NAMES),
        T.StructField("source_modified", _TIME),
        T.StructField("extract_seconds", _SECONDS),
        T.StructField("load_seconds", _SECONDS),
        T.StructField("error", _TEXT),
    ]
)


def run_load(
    source: DataFrame,
    table: MonthTable,
    mode: str = "daily",
    as_of: datetime | None = None,
    rejects_path: str | None = None,
    audit_path: str | None = None,
    run_id: str | None = None,
    defer_merge: bool = False,
    by_modification: bool = False,
    source_modified: datetime | None = None,
) -> LoadReport:
    """Load the new part of ``source`` into ``table``.

    ``daily`` takes rows modified at or after the table's last sync mark,
    ``monthly`` those after the mark minus a calendar month, ``full`` all.
    Nothing new means status ``skipped``. With ``defer_merge`` the batch is
    only appended, which costs no rewrite of the months it touches: readers use
    :meth:`MonthTable.current` and a later :meth:`MonthTable.compact` merges;
    the mark is then set on the batch's own rows. The mark moves only together
    with all rows of a load; a failed run is recorded, then raised. Rejected
    rows are always kept, next to the table unless ``rejects_path`` says where.
    ``by_modification`` is for batches that come in any order: see
    :meth:`MonthTable.merge`. Load times are UTC. ``source_modified`` is kept
    with the audit: how new the files were (:func:`load_files`).
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    as_of = as_of or datetime.now(timezone.utc).replace(tzinfo=None)
    report = LoadReport(run_id or uuid.uuid4().hex, table.contract.name, mode, started_at=as_of, source_modified=source_modified)
    try:
        known = last_marks(table.spark, audit_path, table.contract.name) if audit_path else (None, None)
        _run(source, table, mode, as_of, rejects_path or rejects_of(table), known, defer_merge, by_modification, report)
    except Exception as error:
        report.status, report.error = "failed", str(error)
        raise
    finally:
        if audit_path is not None:
            record(table.spark, report, audit_path)
    return report


def _run(
    source: DataFrame,
    table: MonthTable,
    mode: str,
    as_of: datetime,
    rejects_path: str,
    known: tuple[datetime | None, datetime | None],
    defer_merge: bool,
    by_modification: bool,
    report: LoadReport,
) -> None:
    contract = table.contract
    begun = time.monotonic()
    table.recover()
    batch, high_water = source, None
    if mode != "full":
        synced, high_water = table.watermarks(known)
        if contract.modified_column is None:
            raise ValueError(f"{contract.name} has no modification time; use mode 'full'")
        extract = incremental_extract if mode == "daily" else lookback_extract
        batch = extract(source, contract.modified_column, synced)
    report.dropped_columns = extra_columns(batch, contract)
    report.added_columns = missing_columns(batch, contract)
    # facts, rejects and merge must see the same rows, however the source changes meanwhile; the
    # facts are observed while the rows are written, so the batch is read once
    reason = reject_reason(batch, contract)
    rejected = reason.isNotNull()
    timed = contract.modified_column is not None and contract.modified_column in batch.columns
    modified = modified_time(batch, contract.modified_column) if timed else F.lit(None).cast("timestamp_ntz")
    accepted_time = F.when(~rejected, to_second(modified))
    day = conformed_column(batch, contract.schema[contract.date_column], contract, as_of)
    seen = Observation(f"load {report.run_id}")
    observed = batch.observe(
        seen,
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(rejected).alias("rows_rejected"),
        F.min(accepted_time).alias("modified_min"),
        F.max(accepted_time).alias("modified_max"),
        F.collect_set(F.when(~rejected, month_bucket(day))).alias("months"),
    )
    staged = table.landed(observed.select(*_staged_columns(batch, contract, rejected), reason.alias(REASON)))
    facts = seen.get
    for name in ("rows_read", "rows_rejected", "modified_min", "modified_max"):
        setattr(report, name, facts[name])
    report.rows_accepted = report.rows_read - report.rows_rejected
    report.extract_seconds = time.monotonic() - begun

    begun = time.monotonic()
    if report.rows_rejected:
        # one folder per table and run, so a repeated run does not repeat its rejects
        staged.where(F.col(REASON).isNotNull()).write.mode("overwrite").parquet(f"{rejects_path}/of={contract.name}/run_id={report.run_id}")
    if report.rows_accepted == 0:
        table.discard_landed()
        report.status = "rejected" if report.rows_read else "skipped"
        return
    mark = None
    if contract.synced_column is not None and report.modified_max is not None:
        if mode == "full":  # only a mark needs to know how far the table already is
            high_water = table.watermarks(known)[1]
        report.synced_at = max(report.modified_max, high_water) if high_water else report.modified_max
        mark = (report.modified_min, report.modified_max, report.synced_at)
    accepted = staged.where(F.col(REASON).isNull()).drop(REASON, REST)
    ready = conform(accepted, contract, as_of)
    if defer_merge:
        if mark is not None:
            marked = mark_synced(ready, contract.synced_column, mark[2], contract.modified_column, mark[0], mark[1])
            ready = marked.select(*contract.schema.names)
        table.append(ready, whole=True, months=facts["months"])
    else:
        report.rows_in_months = table.merge(ready, mark, facts["months"], by_modification)
    table.discard_landed()
    report.status = "loaded"
    report.load_seconds = time.monotonic() - begun


REST = "undeclared_columns"


def _staged_columns(batch: DataFrame, contract: TableContract, rejected: Column) -> list[Column]:
    """The declared columns a batch has, and of rejected rows the others too, packed as JSON text.

    Columns without a type, which Parquet can't hold, become text.
    """
    columns = []
    for c in contract.schema.names:
        if c in batch.columns:
            untyped = batch.schema[c].dataType == T.NullType()
            columns.append(source_column(c).cast("string").alias(c) if untyped else source_column(c))
    rest = extra_columns(batch, contract)
    if rest:
        columns.append(F.when(rejected, F.to_json(F.struct(*map(source_column, rest)))).alias(REST))
    return columns


def load_files(
    spark: SparkSession, path: str, schema: T.StructType, table: MonthTable, audit_path: str, mode: str = "daily", as_of: datetime | None = None, **options: object
) -> LoadReport:
    """:func:`run_load` of the Parquet files under ``path`` that are newer than those loaded last.

    The audit keeps the modification time up to which files were loaded. If none
    is newer the run is ``skipped`` without a file being opened; otherwise older
    files are left out when they are listed. Files that land while a load runs
    are the next one's.
    """
    newest = newest_modification(spark, path)
    since = last_source(spark, audit_path, table.contract.name)
    if newest is None or (since is not None and newest <= since):
        now = as_of or datetime.now(timezone.utc).replace(tzinfo=None)
        report = LoadReport(str(options.get("run_id") or uuid.uuid4().hex), table.contract.name, mode, "skipped", now, source_modified=since)
        record(spark, report, audit_path)
        return report
    source = read_newer(spark, path, schema, since, newest)
    return run_load(source, table, mode, as_of, audit_path=audit_path, source_modified=newest, **options)


def record(spark: SparkSession, report: LoadReport, audit_path: str) -> None:
    """Append the run to the audit table; repeating a run id replaces its row."""
    values = asdict(report)
    row = spark.range(1).select(*(_literal(values[f.name], f.dataType).alias(f.name) for f in _AUDIT))
    row.coalesce(1).write.mode("overwrite").parquet(f"{audit_path}/of={report.table_name}/run={report.run_id}")


def rejects_of(table: MonthTable) -> str:
    """Where a table's rejected rows go if nothing else is said."""
    return f"{table.path}.rejects"


def _literal(value: object, spark_type: T.DataType) -> Column:
    if isinstance(value, datetime):
        return ntz(value)
    if isinstance(value, list):
        return F.array(*(F.lit(v) for v in value)).cast(spark_type)
    return F.lit(value).cast(spark_type)


def read_audit(spark: SparkSession, audit_path: str) -> DataFrame:
    return read_or_empty(spark, audit_path, _AUDIT)


def last_source(spark: SparkSession, audit_path: str, table_name: str) -> datetime | None:
    """The modification time up to which a table's files were loaded, or found to hold nothing new."""
    done = read_audit(spark, audit_path).where((F.col("table_name") == table_name) & F.col("status").isin("loaded", "skipped", "rejected"))
    return done.agg(F.max("source_modified")).first()[0]


def last_marks(spark: SparkSession, audit_path: str, table_name: str) -> tuple[datetime | None, datetime | None]:
    """Latest sync mark and modification time among a table's successful runs."""
    loaded = read_audit(spark, audit_path).where((F.col("table_name") == table_name) & (F.col("status") == "loaded"))
    return tuple(loaded.agg(F.max("synced_at"), F.max("modified_max")).first())

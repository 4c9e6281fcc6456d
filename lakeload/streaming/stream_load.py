"""The batch load driven by a directory of landed files.

Every micro-batch goes through the same conform, key check and keyed merge as
a batch load, so a batch that is replayed after a failure changes nothing.
"""

from __future__ import annotations

import threading
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from lakeload.operators.conform import source_column
from lakeload.plans.load import run_load
from lakeload.tables import MonthTable


def stream_load(
    spark: SparkSession,
    source_dir: str,
    source_schema: T.StructType,
    table: MonthTable,
    checkpoint: str,
    as_of: datetime | None = None,
    files_per_batch: int | None = None,
    pattern: str | None = None,
    rejects_path: str | None = None,
    audit_path: str | None = None,
) -> StreamingQuery:
    """Load all files not yet loaded (of those matching ``pattern``), then stop.

    The checkpoint remembers which files were loaded, which takes the place of
    the watermark filter. Files may come in any order: the latest modification
    of a record wins. Run ids hold the query's own id, so streams and fresh
    checkpoints never share audit or reject rows. The audit, by default next to
    the table, bounds the search for the table's last mark.
    """
    reader = spark.readStream.schema(source_schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)

    audit_path = audit_path or f"{table.path}.runs"
    started, query = threading.Event(), []

    def load(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        run_id = f"{query[0].id}-batch-{batch_id}"
        run_load(batch, table, "full", as_of, rejects_path, audit_path, run_id, by_modification=True)

    writer = reader.parquet(source_dir).writeStream.foreachBatch(load)
    query.append(writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    started.set()
    return query[0]


def distinct_stream(rows: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """A stream of files without the rows landed again, within a bounded state.

    The first row of each key is passed on; its key is remembered until the
    watermark, the latest event time seen less ``delay``, has passed the row's
    own event time by ``delay``. Rows older than the watermark are left out and
    counted (:func:`late_rows`): whether they came before is not known any more.
    Rows without an event time are left out too.
    """
    at = "__event_time"
    timed = rows.withColumn(at, source_column(event_time).cast("timestamp")).withWatermark(at, delay)
    return timed.dropDuplicatesWithinWatermark(list(keys)).drop(at)


def late_rows(query: StreamingQuery) -> int:
    """Rows of a finished run that came after the watermark had passed them."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def dedup_stream(
    spark: SparkSession, source_dir: str, schema: T.StructType, target_dir: str, checkpoint: str, keys: Sequence[str], event_time: str, delay: str
) -> StreamingQuery:
    """Append the rows of landed files that no earlier file held to ``target_dir``, then stop.

    State and watermark lie in the checkpoint, so the next run goes on where
    this one ended.
    """
    rows = distinct_stream(spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(source_dir), keys, event_time, delay)
    return rows.writeStream.format("parquet").option("path", target_dir).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

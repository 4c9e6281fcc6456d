"""Queries on landed files and catalog tables: file-level skips, drift, digests, buckets, event-time state."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeload.buckets import BucketedTable
from lakeload.contracts import contract_from_description, contract_from_table, create_table, insert_into
from lakeload.functions import times
from lakeload.operators import incremental, reconcile
from lakeload.operators.conform import conform
from lakeload.plans.load import load_files, read_audit
from lakeload.plans.queries import Query
from lakeload.plans.samples import EVENTS, FIRST_LOAD, ORDERS, SECOND_LOAD, order_changes, orders_before_2000, stamped, table
from lakeload.scratch import run_dir
from lakeload.sources import files
from lakeload.streaming import stream_load as streams
from lakeload.tables import MonthTable

QUERIES: dict[str, Query] = {}
_CLOCK_STEP = 1.1  # seconds; some stores keep whole seconds of modification times


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _name(purpose: str) -> str:
    return f"{purpose}_{uuid.uuid4().hex}"


@query
def bucketed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as changes to a bucketed table of those before 2000."""
    orders = table(spark, sf_dir, "orders")
    target = BucketedTable(spark, _name("orders"), run_dir(spark, "buckets"), "o_orderkey", "o_orderdate", buckets=16)
    target.replace(orders_before_2000(orders))
    target.upsert(order_changes(orders))
    return target.read()


@query
def bucketed_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the same batch would change, from a join that moves the batch only."""
    orders = table(spark, sf_dir, "orders")
    target = BucketedTable(spark, _name("orders"), run_dir(spark, "buckets"), "o_orderkey", "o_orderdate", buckets=16)
    target.replace(orders_before_2000(orders))
    return target.changes(order_changes(orders)).select("o_orderkey", "o_orderdate", "change")


@query
def reconcile_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed orders without the low priorities against the orders before 2000: new, changed and gone ones."""
    orders = table(spark, sf_dir, "orders")
    source = order_changes(orders).where("o_orderpriority <> '5-LOW'")
    return reconcile.reconcile(source, orders_before_2000(orders), "o_orderkey", date_column="o_orderdate")


@query
def block_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per month and key range, as the digests count them, and whether the orders' digests repeat."""
    orders = table(spark, sf_dir, "orders")
    once = reconcile.block_digests(orders, "o_orderkey", orders.columns, "o_orderdate", ranges=8)
    again = reconcile.block_digests(orders.repartition(7, "o_custkey"), "o_orderkey", orders.columns, "o_orderdate", ranges=8)
    differing = reconcile.differing_blocks(once, again).groupBy("month").agg(F.count(F.lit(1)).alias("n"))
    months = once.groupBy("month").agg(F.sum("n_rows").alias("n_rows")).join(differing, "month", "left")
    return months.select("month", "n_rows", F.coalesce("n", F.lit(0)).alias("n_differing"))


@query
def observed_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds and rows of a snapshot, counted while it is written."""
    events, seen = incremental.observed_bounds(table(spark, sf_dir, "events"), "ts")
    files.write_snapshot(events, run_dir(spark, "observed"))
    found = seen.get
    return spark.range(1).select(times.ntz(found["modified_min"]).alias("modified_min"), times.ntz(found["modified_max"]).alias("modified_max"), F.lit(found["n_rows"]).cast("long").alias("n_rows"))


def _land_in_two(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str, object]:
    """Events landed in two pieces: the rows, the folder, and the time between them."""
    events = table(spark, sf_dir, "events")
    folder = run_dir(spark, "landed")
    events.where(F.col("ts") < times.ntz("2024-01-15")).write.parquet(f"{folder}/first")
    between = files.newest_modification(spark, folder)
    time.sleep(_CLOCK_STEP)
    events.where(F.col("ts") >= times.ntz("2024-01-15")).write.parquet(f"{folder}/second")
    return events, folder, between


@query
def fresh_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two landed pieces only the later one is listed and read."""
    events, folder, between = _land_in_two(spark, sf_dir)
    return files.read_newer(spark, f"{folder}/*", events.schema, between)


@query
def load_fresh_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads of a landing folder: the first piece, the second, and nothing newer."""
    events = table(spark, sf_dir, "events")
    folder = run_dir(spark, "landed")
    target, audit = MonthTable(spark, f"{folder}/table", EVENTS), f"{folder}/runs"
    early = F.col("ts") < times.ntz("2024-01-15")
    for run, (rows, at) in enumerate(((events.where(early), FIRST_LOAD), (events.where(~early), SECOND_LOAD), (None, SECOND_LOAD))):
        if rows is not None:
            if run:
                time.sleep(_CLOCK_STEP)
            rows.write.parquet(f"{folder}/landed/piece{run}")
        load_files(spark, f"{folder}/landed/*", events.schema, target, audit, "daily", at, run_id=f"run{run}")
    runs = read_audit(spark, audit).select("run_id", "status", "rows_read", "rows_accepted")
    return runs.join(target.read().agg(F.count(F.lit(1)).alias("rows_in_table")))  # one row


def _land_drifting(spark: SparkSession, sf_dir: str) -> str:
    """Events in three pieces: the first lacks a column, the last has one more."""
    events = table(spark, sf_dir, "events")
    folder = run_dir(spark, "drifting")
    first, second = times.ntz("2024-01-10"), times.ntz("2024-01-20")
    events.where(F.col("ts") < first).drop("props").write.parquet(f"{folder}/piece1")
    events.where((F.col("ts") >= first) & (F.col("ts") < second)).write.parquet(f"{folder}/piece2")
    events.where(F.col("ts") >= second).withColumn("channel", F.concat(F.lit("c"), F.col("user_id") % 3)).write.parquet(f"{folder}/piece3")
    return folder


@query
def scan_drifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces as one table, with the column that only the last one has."""
    return files.read_drifted(spark, _land_drifting(spark, sf_dir)).select("event_id", "ts", "user_id", "event_type", "value", "props", "channel")


@query
def conform_drifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces conformed to the declared table: a column that a file lacks is filled, one too many dropped."""
    return conform(files.read_drifted(spark, _land_drifting(spark, sf_dir)), EVENTS, FIRST_LOAD)


@query
def drift_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each piece lacks or has too much; files of a piece are taken together."""
    drifted = files.read_drifted(spark, _land_drifting(spark, sf_dir))
    declared = [c for c in EVENTS.schema.names if c not in ("last_synced_at", "updated_at")]
    return files.drift_by_file(drifted, declared, F.regexp_extract("_metadata.file_path", "/(piece[0-9])/", 1))


@query
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs from one checkpoint; the second finds files landed again, and late ones it must not judge."""
    events = table(spark, sf_dir, "events")
    folder = run_dir(spark, "dedup")
    early = F.col("ts") < times.ntz("2024-01-15")
    late = 0
    for rows in (events.where(early), events.where(~early).unionByName(events.where(early))):
        rows.write.mode("append").parquet(f"{folder}/landed")
        run = streams.dedup_stream(spark, f"{folder}/landed", events.schema, f"{folder}/distinct", f"{folder}/checkpoint", ["event_id"], "ts", "2 days")
        run.awaitTermination()
        late += streams.late_rows(run)
    distinct = spark.read.schema(events.schema).parquet(f"{folder}/distinct")
    return distinct.select("event_id", "ts", "event_type", F.lit(late).cast("long").alias("n_late"))


@query
def catalog_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders inserted by column list into a catalog table; defaults fill the rest, and the contract reads back."""
    described = [
        ("o_orderkey", "UInt64", "", ""),
        ("o_totalprice", "Float64", "", ""),
        ("o_orderpriority", "String", "", ""),
        ("channel", "String", "DEFAULT", "store's own"),
        ("n_copies", "Int32", "DEFAULT", "1 + 1"),
        ("rate", "Nullable(Float64)", "DEFAULT", "0.5"),
        ("note", "Nullable(String)", "", ""),
    ]
    name = _name("orders")
    create_table(spark, contract_from_description("orders", described, primary_key="o_orderkey"), name, run_dir(spark, "catalog"))
    insert_into(table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice"), name)
    contract = contract_from_table(spark, name, primary_key="o_orderkey")
    declared = ",".join(f"{f.metadata['declared']}:{f.metadata.get('CURRENT_DEFAULT', '')}" for f in contract.schema)
    return spark.table(name).withColumn("declared", F.lit(declared))


@query
def clustered_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key range and a date range, both from files clustered by key and date at once."""
    orders = table(spark, sf_dir, "orders")
    path = run_dir(spark, "clustered")
    files.write_clustered(orders, path, ["o_orderkey", "o_totalprice"], files=16)
    stored = spark.read.parquet(path)
    keys = stored.where("o_orderkey BETWEEN 300 AND 700").withColumn("found_by", F.lit("key"))
    dear = stored.where("o_totalprice > 350000").withColumn("found_by", F.lit("price"))
    return keys.unionByName(dear).select("o_orderkey", "o_totalprice", "o_orderdate", "found_by")


@query
def bloom_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key that is there and one that is not, searched in a table whose files carry Bloom filters."""
    orders = table(spark, sf_dir, "orders")
    target = MonthTable(spark, run_dir(spark, "bloom"), ORDERS, bloom_keys=10_000)
    target.append(stamped(orders, ORDERS, FIRST_LOAD))
    there, absent = (incremental.point_lookup(target.read(), "o_orderkey", key) for key in (77, -5))
    return there.unionByName(absent).select("o_orderkey", "o_custkey", "o_totalprice", "p_month")


@query
def compact_noted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deferred loads note their months; only those are compacted, and a second compaction finds none."""
    events = table(spark, sf_dir, "events")
    target = MonthTable(spark, run_dir(spark, "events"), EVENTS)
    target.append(stamped(events.withColumn("ts", F.col("ts") - F.expr("INTERVAL 1 YEAR")), EVENTS, FIRST_LOAD))
    target.compact()
    again = events.where(F.col("ts") >= times.ntz("2024-01-20")).withColumn("event_type", F.lit("again"))
    target.append(stamped(events, EVENTS, FIRST_LOAD))
    target.append(stamped(again, EVENTS, SECOND_LOAD))
    n = target.compact()
    second = target.compact()
    return target.read().select("event_id", "ts", "event_type", "p_month", F.lit(n).cast("long").alias("n_rewritten"), F.lit(second).cast("long").alias("n_second"))

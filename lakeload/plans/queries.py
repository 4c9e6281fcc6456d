"""One runnable query per operator, over the sample tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeload.contracts import TableContract, contract_from_description
from lakeload.functions import times
from lakeload.operators import conform as cf
from lakeload.operators import incremental as inc
from lakeload.operators import lineage, quality, versioned
from lakeload.plans import samples
from lakeload.plans.load import read_audit, rejects_of, run_load
from lakeload.plans.samples import EVENTS, FIRST_LOAD, ORDERS, SECOND_LOAD, order_changes, orders_before_2000, stamped, table
from lakeload.scratch import run_dir
from lakeload.sources import files
from lakeload.streaming import stream_load as streams
from lakeload.tables import MonthTable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CSV_BYTES = 16 << 20  # of text in a file that is read as a whole


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# scans and sinks


@query
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer")


@query
def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    path = run_dir(spark, "landed") + "/orders.csv"
    orders.write.csv(path, header=True)
    return files.read_landed(spark, path, orders.schema, by_line=True)


@query
def scan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    path = run_dir(spark, "landed") + "/events.json"
    events.withColumn("ts", F.col("ts").cast("string")).write.json(path)
    landed = "event_id long, ts string, user_id long, event_type string, value double, props string"
    read = files.read_landed(spark, path, landed, by_line=True)
    return read.withColumn("ts", inc.modified_time(read, "ts"))


@query
def scan_json_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are one JSON document of bounded size each, eight for every 50,000 rows of a partition."""
    orders = table(spark, sf_dir, "orders")
    path = run_dir(spark, "landed") + "/orders.json"
    row = F.struct("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    document = F.to_json(F.collect_list(row)).alias("value")
    block = F.expr("monotonically_increasing_id() div 50000")  # partitions share none
    in_files = orders.withColumn("block", block).groupBy("block", F.col("o_orderkey") % 8).agg(document)
    in_files.select("value").write.option("maxRecordsPerFile", 1).text(path)
    read = files.read_landed(spark, path, "o_orderkey long, o_orderstatus string, o_totalprice double, o_orderpriority string")
    return read.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


@query
def scan_csv_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files whose quoted values hold newlines and quotes, with inferred types."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    path = run_dir(spark, "landed") + "/documents.csv"
    kept = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    documents.repartition(max(4, size // CSV_BYTES + 1), "doc_id").write.options(**kept).csv(path, header=True, quoteAll=True)
    return files.read_landed(spark, path).withColumn("doc_id", F.col("doc_id").cast("long"))


@query
def snapshot_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "snapshot") + "/customer.parquet"
    files.write_snapshot(table(spark, sf_dir, "supplier"), path)
    files.write_snapshot(table(spark, sf_dir, "customer"), path)
    return files.read_landed(spark, path)


@query
def append_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landed pieces appended to one file set."""
    events = table(spark, sf_dir, "events")
    cut = times.ntz("2024-01-11")
    path = run_dir(spark, "append") + "/events.parquet"
    files.append_parquet(events.where(F.col("ts") < cut), path)
    files.append_parquet(events.where(F.col("ts") >= cut), path)
    return files.read_landed(spark, path)


@query
def union_same_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    cut = times.ntz("2024-01-11")
    return files.union_all(events.where(F.col("ts") >= cut), events.where(F.col("ts") < cut))


@query
def typed_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = MonthTable(spark, run_dir(spark, "orders"), ORDERS)
    target.append(stamped(table(spark, sf_dir, "orders"), ORDERS, FIRST_LOAD))
    return target.read()


@query
def date_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.date_between(table(spark, sf_dir, "lineitem"), "l_shipdate", "1997-01-01", "1997-01-31")


@query
def pruned_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same kind of range on a month-partitioned table: only its months are read."""
    target = MonthTable(spark, run_dir(spark, "orders"), ORDERS)
    target.append(stamped(table(spark, sf_dir, "orders"), ORDERS, FIRST_LOAD))
    return target.between(date(1997, 1, 15), date(1997, 3, 14)).select("o_orderkey", "o_orderdate", "p_month")


@query
def source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each scanned file, and whether its time reads like one; the time itself is no data."""
    orders, lineitem = (files.scan_freshness(table(spark, sf_dir, name)) for name in ("orders", "lineitem"))
    return orders.unionByName(lineitem).select(
        F.regexp_extract("file_path", r"([a-z]+)\.parquet", 1).alias("file_name"),
        F.col("modified_at").rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d").alias("well_formed"),
        "n_rows",
    )


@query
def table_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.contract_profile(table(spark, sf_dir, "events"), EVENTS)


# extracts


@query
def incremental_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.incremental_extract(table(spark, sf_dir, "events"), "ts", "2024-01-15")


@query
def lookback_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.lookback_extract(table(spark, sf_dir, "orders"), "o_orderdate", "2001-03-31")


@query
def batch_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.batch_bounds(incremental_extract(spark, sf_dir), "ts")


@query
def skip_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source not newer than the table: nothing to load."""
    events = table(spark, sf_dir, "events")
    return inc.batch_bounds(inc.incremental_extract(events, "ts", "2024-02-15"), "ts")


@query
def watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.maximum(mark_synced(spark, sf_dir), "last_synced_at")


@query
def high_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.maximum(table(spark, sf_dir, "events"), "ts")


@query
def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.point_lookup(table(spark, sf_dir, "orders"), "o_orderkey", 7)


@query
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.preview(table(spark, sf_dir, "orders"), "o_orderdate", 3, ["o_orderkey"])


@query
def sorted_by_modified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.by_modified(table(spark, sf_dir, "events"), "ts")


# conforming


@query
def conform_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One extra column, missing columns, retyped columns, placeholder dates."""
    orders = table(spark, sf_dir, "orders").withColumn("o_custkey", F.col("o_custkey").cast("string"))
    return cf.conform(orders.withColumn("o_comment", F.lit("extra")), ORDERS, FIRST_LOAD)


_NUMBERS = contract_from_description(
    "numbers",
    [
        ("p_partkey", "Int64"),
        ("brand_digits", "Int64"),
        ("brand_raw", "Int32"),
        ("price_text", "Float64"),
        ("price_cut", "Int64"),
        ("price_raw", "Float64"),
        ("price_optional", "Nullable(Float64)"),
        ("size_optional", "Nullable(Int32)"),
    ],
    primary_key="p_partkey",
)


@query
def coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    price = F.col("p_retailprice")
    raw = part.select(
        "p_partkey",
        F.regexp_extract("p_brand", "([0-9]+)", 1).alias("brand_digits"),
        F.col("p_brand").alias("brand_raw"),
        price.cast("string").alias("price_text"),
        price.cast("string").alias("price_cut"),
        F.col("p_name").alias("price_raw"),
        F.when(F.col("p_size") > 25, F.lit(float("nan"))).otherwise(price / 3).alias("price_optional"),
        F.when(F.col("p_size") > 25, "none").otherwise(F.col("p_size").cast("string")).alias("size_optional"),
    )
    typed = cf.conform(raw, _NUMBERS)
    return typed.withColumn("size_optional", F.col("size_optional").cast("string"))


_TYPES = contract_from_description(
    "types",
    [
        ("event_id", "UInt64"),
        ("big", "Boolean"),
        ("flag_text", "Boolean"),
        ("kind", "Enum8('click' = 1)"),
        ("maybe_text", "String"),
        ("optional_text", "Nullable(String)"),
        ("seen_day", "Date"),
        ("seen_text", "DateTime"),
        ("seen_bad", "Nullable(DateTime)"),
        ("seen_nanos", "DateTime"),
        ("amount", "Decimal(32,16)"),
        ("loaded_at", "DateTime", "DEFAULT", "now()"),
        ("two", "Int32", "DEFAULT", "1+1"),
        ("label", "String", "DEFAULT", "none"),
        ("unset_number", "Int64", "", ""),
        ("unset_optional", "Nullable(Int64)", "", ""),
        ("unset_text", "String", "", ""),
        ("unset_time", "DateTime", "DEFAULT", "today()"),
    ],
    primary_key="event_id",
    date_column="seen_text",
)


@query
def conform_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every declared type and every kind of default."""
    events = table(spark, sf_dir, "events")
    known = F.when(F.col("event_type") != "error", F.col("event_type"))
    raw = events.select(
        "event_id",
        F.floor(F.col("value") / 100).alias("big"),
        F.when(F.col("event_type") == "click", "true").when(F.col("event_type") == "view", "x").alias("flag_text"),
        known.alias("kind"),
        known.alias("maybe_text"),
        known.alias("optional_text"),
        F.col("ts").cast("string").alias("seen_day"),
        F.col("ts").cast("string").alias("seen_text"),
        F.when(F.col("event_type") == "click", F.col("ts").cast("string")).otherwise(F.col("props")).alias("seen_bad"),
        (F.lit(1_700_000_000_000_000_000) + F.col("event_id") * 1_000_000_000).alias("seen_nanos"),
        F.col("value").cast("string").alias("amount"),
    )
    typed = cf.conform(raw, _TYPES, FIRST_LOAD)
    shown = {"amount": "double", "seen_day": "string", "unset_optional": "string"}
    return typed.withColumns({c: F.col(c).cast(t) for c, t in shown.items()})


@query
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract = contract_from_description(
        "documents", [("doc_id", "Int64"), ("text", "String")], primary_key="doc_id"
    )
    return cf.conform(table(spark, sf_dir, "documents"), contract)


@query
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date, text and number expressions the loads are made of."""
    ts = F.col("ts")
    text = F.date_format(ts, times.TIMESTAMP_TEXT)
    instant = F.from_utc_timestamp(ts.cast("timestamp"), F.current_timezone())
    return table(spark, sf_dir, "events").select(
        "event_id",
        (ts - F.expr("INTERVAL 1 MONTH")).alias("month_back"),
        (ts - F.expr("INTERVAL 15 DAY")).alias("days_back"),
        times.plus_years(ts, 5).alias("expires"),
        times.month_bucket(ts).alias("month"),
        F.to_date(ts).cast("string").alias("day"),
        times.to_second(ts).alias("second"),
        text.alias("second_text"),
        times.zone_text(instant).alias("local_text"),
        times.strict_timestamp(text).alias("parsed"),
        times.strict_timestamp(F.to_date(ts).cast("string")).alias("not_parsed"),
        F.round(F.col("value") / 7, 6).alias("six_decimals"),
        F.col("value").cast("decimal(18,2)").cast("int").alias("whole"),
        F.replace(F.concat("event_type", F.lit("\n"), "props"), F.lit("\n"), F.lit(" ")).alias("one_line"),
        F.trim(F.regexp_replace(F.concat(F.lit(" '"), "event_type", F.lit("' ")), "['\"]", "")).alias("unquoted"),
    )


# key validity and reports

_ACCOUNTS = contract_from_description(
    "accounts", [("account", "UInt64"), ("c_custkey", "Int64")], primary_key="account"
)


@query
def pk_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers keyed by their whole balance, an unsigned key that some do not satisfy."""
    raw = table(spark, sf_dir, "customer").select(F.floor("c_acctbal").cast("string").alias("account"), "c_custkey")
    accepted, rejected = quality.split_rejects(raw, _ACCOUNTS)
    return accepted.withColumn(quality.REASON, F.lit(None).cast("string")).unionByName(rejected)


def _without(df: DataFrame, name: str, *dropped: str) -> TableContract:
    kinds = {"bigint": "Int64", "int": "Int32", "double": "Float64", "string": "String", "timestamp_ntz": "DateTime"}
    columns = [(c, kinds[t]) for c, t in df.dtypes if c not in dropped]
    return contract_from_description(name, columns, primary_key=columns[0][0])


@query
def drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    return quality.drift_report(lineitem, _without(lineitem, "lineitem", "l_tax", "l_shipdate"))


@query
def coercion_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load of parts (brand declared as a number) and of orders would lose."""
    part, orders = table(spark, sf_dir, "part"), table(spark, sf_dir, "orders")
    typed = contract_from_description(
        "part",
        [("p_partkey", "UInt32"), ("p_name", "String"), ("p_brand", "Int64"), ("p_retailprice", "Float64")],
        primary_key="p_partkey",
    )
    reports = [("part", quality.coercion_loss(part, typed)), ("orders", quality.coercion_loss(orders, ORDERS))]
    first, second = (r.select(F.lit(n).alias("table_name"), "*") for n, r in reports)
    return first.unionByName(second)


# versioned tables

_LINE_TIES = [
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]


@query
def latest_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return versioned.latest_version(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"], _LINE_TIES)


@query
def latest_lineitem_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = versioned.with_month(table(spark, sf_dir, "lineitem"), "l_shipdate")
    key = ["l_orderkey", "l_linenumber", "p_month"]
    return versioned.latest_version(lines, key, ["l_shipdate"], _LINE_TIES)


@query
def month_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = versioned.with_month(table(spark, sf_dir, "orders"), "o_orderdate")
    return orders.groupBy("p_month").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def classify_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as a batch against a target that ends in 1999."""
    orders = table(spark, sf_dir, "orders")
    target = orders_before_2000(orders)
    changes = versioned.classify_changes(order_changes(orders), target, "o_orderkey", "o_orderdate", unique=True)
    return changes.select("o_orderkey", "o_orderdate", "change")


@query
def classify_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, looking only at the target's last 15 days before the end of 1999."""
    orders = table(spark, sf_dir, "orders")
    target = orders_before_2000(orders)
    changes = versioned.classify_changes(
        order_changes(orders), target, "o_orderkey", "o_orderdate", "2000-01-01", lookback_days=15, unique=True
    )
    return changes.select("o_orderkey", "o_orderdate", "change")


@query
def upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return versioned.upsert(orders_before_2000(orders), order_changes(orders), ["o_orderkey"], "o_orderdate")


@query
def row_hash_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    changed = versioned.changes_by_hash(order_changes(orders), orders_before_2000(orders), "o_orderkey", unique=True)
    return changed.select("o_orderkey", "change")


@query
def key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    buyers = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING")
    buyers = buyers.select(F.col("c_custkey").alias("o_custkey"))
    return versioned.key_lookup(table(spark, sf_dir, "orders"), buyers, ["o_custkey"])


@query
def mark_synced(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return versioned.mark_synced(events, "last_synced_at", "2024-02-01", "ts", "2024-01-10", "2024-01-20")


@query
def mark_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versioned.mark_synced(table(spark, sf_dir, "events"), "last_synced_at", "2024-02-01")


@query
def delete_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versioned.delete_where(table(spark, sf_dir, "events"), "event_type = 'error'")


@query
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versioned.retain(table(spark, sf_dir, "lineitem"), "l_shipdate", "2001-11-04")


# stored tables


def _stored_orders(spark: SparkSession, sf_dir: str, **facts: object) -> MonthTable:
    target = MonthTable(spark, run_dir(spark, "orders"), ORDERS.but(**facts))
    target.append(stamped(table(spark, sf_dir, "orders"), ORDERS, FIRST_LOAD))
    return target


@query
def compact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders were loaded again under a newer version, then the table is compacted."""
    target = _stored_orders(spark, sf_dir)
    finished = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").withColumn("o_orderstatus", F.lit("C"))
    target.append(stamped(finished, ORDERS, SECOND_LOAD))
    target.compact()
    return target.read().drop("last_synced_at")


@query
def moved_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order although finished orders moved to another month."""
    target = _stored_orders(spark, sf_dir, scope="primary_key")
    moved = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    moved = moved.withColumn("o_orderdate", F.col("o_orderdate") + F.expr("INTERVAL 40 DAY"))
    target.merge(stamped(moved, ORDERS, SECOND_LOAD))
    return target.read().drop("last_synced_at")


@query
def upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change batch applied to a stored table: a day later is a change, the same day is not."""
    target = MonthTable(spark, run_dir(spark, "orders"), ORDERS)
    orders = table(spark, sf_dir, "orders")
    target.append(stamped(orders_before_2000(orders), ORDERS, FIRST_LOAD))
    target.upsert(stamped(order_changes(orders), ORDERS, SECOND_LOAD))
    return target.read().drop("last_synced_at")


@query
def table_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletes whole months and single rows; emptied months must really be empty."""
    target = _stored_orders(spark, sf_dir)
    target.delete("o_orderdate < TIMESTAMP_NTZ'1996-01-01' OR o_orderstatus = 'P'")
    return target.read().select("o_orderkey", "o_orderstatus", "o_orderdate", "p_month")


@query
def table_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _stored_orders(spark, sf_dir)
    target.retain(date(2003, 6, 15))
    return target.read().select("o_orderkey", "o_orderdate", "p_month")


@query
def table_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _stored_orders(spark, sf_dir)
    target.mark("2001-09-01", "2001-06-01", "2001-07-15")
    return target.read().select("o_orderkey", "o_orderdate", "last_synced_at")


# loads


@query
def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole load on an empty table: extract, validate, conform, merge, mark."""
    target = MonthTable(spark, run_dir(spark, "events"), EVENTS)
    run_load(table(spark, sf_dir, "events"), target, "daily", FIRST_LOAD)
    return target.read()


@query
def daily_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load of what had landed by 15 January, then a daily load of the full file."""
    events = table(spark, sf_dir, "events")
    target = MonthTable(spark, run_dir(spark, "events"), EVENTS)
    run_load(events.where(F.col("ts") < times.ntz("2024-01-15")), target, "daily", FIRST_LOAD)
    run_load(events, target, "daily", SECOND_LOAD)
    return target.read()


@query
def deferred_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily loads appended without a rewrite; reading picks the newest versions."""
    events = table(spark, sf_dir, "events")
    target = MonthTable(spark, run_dir(spark, "events"), EVENTS)
    run_load(events.where(F.col("ts") < times.ntz("2024-01-15")), target, "daily", FIRST_LOAD, defer_merge=True)
    run_load(events, target, "daily", SECOND_LOAD, defer_merge=True)
    return target.current()


@query
def monthly_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full load of orders, then a monthly re-read of the last calendar month."""
    orders = table(spark, sf_dir, "orders")
    target = MonthTable(spark, run_dir(spark, "orders"), ORDERS)
    run_load(orders, target, "full", FIRST_LOAD)
    run_load(orders, target, "monthly", SECOND_LOAD)
    return target.read()


@query
def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows of a load with unusable keys and of a repeat that finds nothing newer."""
    events = table(spark, sf_dir, "events")
    key = F.concat(F.when(F.col("event_type") == "error", "bad ").otherwise(""), F.col("event_id"))
    raw = events.withColumn("event_id", key).withColumn("origin", F.lit("shop"))
    folder = run_dir(spark, "audit")
    target = MonthTable(spark, folder + "/events", EVENTS)
    run_load(raw, target, "daily", FIRST_LOAD, folder + "/rejects", folder + "/runs", run_id="first")
    older = raw.where(F.col("ts") < times.ntz("2024-01-20"))
    run_load(older, target, "daily", SECOND_LOAD, folder + "/rejects", folder + "/runs", run_id="second")
    return read_audit(spark, folder + "/runs").select(
        "run_id",
        "table_name",
        "mode",
        "status",
        "modified_min",
        "modified_max",
        "synced_at",
        "rows_read",
        "rows_rejected",
        "rows_accepted",
        "rows_in_months",
        F.concat_ws(",", "dropped_columns").alias("dropped_columns"),
        F.concat_ws(",", "added_columns").alias("added_columns"),
    )


@query
def load_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that finds its table up to date: what it says, and the table as it was."""
    events = table(spark, sf_dir, "events")
    target = MonthTable(spark, run_dir(spark, "events"), EVENTS)
    run_load(events, target, "daily", FIRST_LOAD)
    report = run_load(events.where(F.col("ts") < times.ntz("2024-01-20")), target, "daily", SECOND_LOAD)
    return target.read().agg(
        F.lit(report.status).alias("status"), F.lit(report.rows_read).cast("long").alias("rows_read"), F.count(F.lit(1)).alias("rows_in_table")
    )


@query
def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every landed row is in the table or among its rejects, although no place for those was named."""
    events = table(spark, sf_dir, "events")
    key = F.concat(F.when(F.col("event_type") == "error", "bad ").otherwise(""), F.col("event_id"))
    target = MonthTable(spark, run_dir(spark, "events"), EVENTS)
    run_load(events.withColumn("event_id", key), target, "daily", FIRST_LOAD)
    accepted = target.read().select(F.col("event_id").cast("string"), "event_type", F.lit(False).alias("rejected"))
    rejects = spark.read.parquet(rejects_of(target))
    return accepted.unionByName(rejects.select("event_id", "event_type", F.col("reject_reason").isNotNull().alias("rejected")))


@query
def stream_late_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sets of files landed in the wrong order: the later modification stays."""
    events = table(spark, sf_dir, "events")
    folder = run_dir(spark, "stream")
    later = events.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 HOUR")).withColumn("event_type", F.lit("corrected"))
    target = MonthTable(spark, folder + "/events", EVENTS.but(scope="primary_key"))
    for rows in (later, events):
        rows.write.mode("append").parquet(folder + "/landed")
        streams.stream_load(spark, folder + "/landed", events.schema, target, folder + "/checkpoint", as_of=FIRST_LOAD).awaitTermination()
    return target.read().select("event_id", "ts", "event_type")


@query
def stream_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load as an available-now stream over landed files; equals the batch load."""
    folder = run_dir(spark, "stream")
    target = MonthTable(spark, folder + "/events", EVENTS)
    schema = table(spark, sf_dir, "events").schema
    stream = streams.stream_load(
        spark, sf_dir, schema, target, folder + "/checkpoint", as_of=FIRST_LOAD, pattern="events.parquet"
    )
    stream.awaitTermination()
    return target.read()


# lineage


@query
def return_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "landed") + "/links.parquet"
    lineitem, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    files.write_snapshot(samples.return_links(lineitem), path)
    tables = samples.return_tables(lineitem, orders, files.read_landed(spark, path))
    return lineage.return_lineage(tables["link"], tables["moves"], tables["origins"], tables["headers"])

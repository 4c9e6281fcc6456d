"""File-level skips, drift between files, digests, buckets, observed loads and the stream's state."""

from __future__ import annotations

import glob
import os
import re
import shutil
import subprocess
import sys
import textwrap
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from lakeload.buckets import BucketedTable
from lakeload.contracts import contract_from_description, contract_from_table, create_table, insert_into
from lakeload.operators import reconcile, versioned
from lakeload.plans.load import REST, load_files, read_audit, rejects_of, run_load
from lakeload.plans.samples import EVENTS, FIRST_LOAD, SECOND_LOAD
from lakeload.sources import files
from lakeload.streaming import stream_load as streams
from lakeload.tables import MonthTable
from tests.conftest import DATA


def above(plan: str, mark: str) -> list[str]:
    """The operators above the line that holds ``mark`` in a plan drawn as a tree."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if mark in line)

    def depth(line: str) -> int:
        return len(re.match(r"[ :+\-|]*", line).group())

    found, level = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            level = depth(line)
            found.append(line)
    return found


@pytest.fixture
def bucketed(spark, tmp_path):
    name = f"b{abs(hash(str(tmp_path)))}"
    table = BucketedTable(spark, name, str(tmp_path / "t"), "k", "at", buckets=4)
    table.replace(spark.range(2000).selectExpr("id AS k", "timestamp_ntz'2024-01-01' + make_dt_interval(cast(id % 9 AS int)) AS at", "concat('v', id) AS v"))
    return table


def test_a_bucketed_table_is_not_shuffled_for_changes(spark, bucketed):
    batch = spark.range(1500, 2600).selectExpr("id AS k", "timestamp_ntz'2024-01-05' AS at", "'new' AS v")
    for changed in (bucketed.upserted(batch), bucketed.changes(batch.hint("merge"))):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        try:
            plan = changed._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert "Bucketed: true" in plan and "Exchange" in plan
        assert not [line for line in above(plan, "Bucketed: true") if "Exchange" in line]


def test_bucketed_upserts_equal_the_plain_operator(spark, bucketed, tmp_path):
    rows = [(5, "2024-01-09", "a"), (5, "2024-01-11", "b"), (7, "2023-01-01", "old"), (8, None, "undated"), (9000, None, "added"), (None, "2024-01-01", "keyless")]
    batch = spark.createDataFrame(rows, "k long, at string, v string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    for step in (batch, batch.withColumn("at", F.col("at") + F.expr("INTERVAL 1 YEAR"))):
        before = bucketed.read()
        expected = versioned.upsert(before, step, ["k"], "at").orderBy("k").collect()
        bucketed.upsert(step)
        found = bucketed.read().orderBy("k").collect()
        keyed = [r for r in found if r["k"] is not None]
        assert keyed == [r for r in expected if r["k"] is not None] and len(found) > len(keyed)
    assert len(glob.glob(str(tmp_path / "t" / "slot*" / "*.parquet"))) <= 2 * 4


def test_digests_do_not_depend_on_order_and_see_every_change(spark):
    rows = spark.range(3000).selectExpr("id AS k", "if(id % 5 = 0, NULL, concat('v', id)) AS v", "timestamp_ntz'2024-01-15' + make_dt_interval(cast(id % 90 AS int)) AS d")
    shuffled = rows.repartition(5, "v").orderBy(F.desc("k"))
    assert reconcile.reconcile(shuffled, rows, "k", date_column="d").count() == 0
    moved = rows.where("k <> 11").unionByName(spark.sql("SELECT 5000L AS k, 'x' AS v, timestamp_ntz'2024-02-01' AS d"))
    moved = moved.withColumn("d", F.when(F.col("k") == 42, F.col("d") + F.expr("INTERVAL 40 DAY")).otherwise(F.col("d")))
    moved = moved.withColumn("v", F.when(F.col("k") == 50, F.lit("filled")).otherwise(F.col("v")))
    moved = moved.unionByName(rows.where("k = 60"))  # a row repeated
    found = {r["k"]: r["change"] for r in reconcile.reconcile(moved, rows, "k", date_column="d").collect()}
    assert found == {11: "gone", 42: "changed", 50: "changed", 60: "changed", 5000: "new"}
    swapped = rows.select("k", F.col("v").alias("v"), "d")
    assert reconcile.reconcile(swapped.limit(0), rows.limit(0), "k").count() == 0


def test_equal_blocks_are_not_joined(spark):
    rows = spark.range(6400).selectExpr("id AS k", "id * 7 AS v")
    source = rows.withColumn("v", F.when(F.col("k") == 3, 0).otherwise(F.col("v")))
    digests = [reconcile.block_digests(df, "k", ["k", "v"], ranges=64) for df in (source, rows)]
    blocks = reconcile.differing_blocks(*digests).collect()
    assert len(blocks) == 1
    found = reconcile.reconcile(source, rows, "k", ranges=64)
    assert [tuple(r) for r in found.collect()] == [(3, "changed")]
    # rows of one block of 64 reach the comparison
    sizes = {r["key_range"]: r["n_rows"] for r in digests[1].collect()}
    assert sizes[blocks[0]["key_range"]] < 200


def events(spark, first, last):
    ids = spark.range(first, last)
    return ids.selectExpr("id AS event_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, cast(id AS int)) AS ts", "id % 7 AS user_id", "'view' AS event_type", "1.5D AS value", "'{}' AS props")


def test_a_batch_is_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(i):
        seen.add(1)
        return i

    source = events(spark, 0, 500).withColumn("event_id", counted("event_id")).withColumn("origin", F.lit("shop"))
    table = MonthTable(spark, str(tmp_path / "t"), EVENTS)
    report = run_load(source, table, "full", FIRST_LOAD)
    assert (report.status, report.rows_read, report.dropped_columns) == ("loaded", 500, ["origin"])
    assert seen.value == 500 and table.read().count() == 500
    assert spark.read.schema("x int").parquet(f"{table.path}/_lakeload/batch").count() == 0  # nothing is left staged


def test_undeclared_columns_cannot_break_a_load_and_stay_with_rejects(spark, tmp_path):
    source = events(spark, 0, 20).selectExpr("*", "make_interval(1, 2) AS span", "NULL AS nothing", "event_id AS EXTRA", "'x' AS extra_too")
    source = source.withColumn("event_id", F.when(F.col("event_id") == 3, F.lit("bad")).otherwise(F.col("event_id").cast("string")))
    table = MonthTable(spark, str(tmp_path / "t"), EVENTS)
    report = run_load(source, table, "daily", FIRST_LOAD)
    assert (report.rows_read, report.rows_rejected) == (20, 1)
    kept = spark.read.parquet(rejects_of(table)).first()
    assert kept["event_id"] == "bad" and '"EXTRA":3' in kept[REST] and '"extra_too":"x"' in kept[REST]
    clash = events(spark, 20, 25).select("*", F.lit(1).alias("Note"), F.lit(2).alias("note"))
    spark.conf.set("spark.sql.caseSensitive", True)
    try:
        assert run_load(clash, table, "full", SECOND_LOAD).status == "loaded"
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_files_that_are_not_newer_are_never_opened(spark, tmp_path):
    landed, audit = str(tmp_path / "landed"), str(tmp_path / "runs")
    table = MonthTable(spark, str(tmp_path / "t"), EVENTS)
    schema = events(spark, 0, 1).schema
    assert load_files(spark, landed + "/*", schema, table, audit, "daily", FIRST_LOAD, run_id="r0").status == "skipped"
    events(spark, 0, 100).write.parquet(landed + "/a")
    assert load_files(spark, landed + "/*", schema, table, audit, "daily", FIRST_LOAD, run_id="r1").rows_read == 100
    for path in glob.glob(landed + "/a/*.parquet"):  # whoever opens one fails
        at = os.stat(path)
        with open(path, "r+b") as file:
            file.write(b"garbage" * 100)
        os.utime(path, ns=(at.st_atime_ns, at.st_mtime_ns))
    assert load_files(spark, landed + "/*", schema, table, audit, "daily", SECOND_LOAD, run_id="r2").status == "skipped"
    events(spark, 100, 130).write.parquet(landed + "/b")
    report = load_files(spark, landed + "/*", schema, table, audit, "daily", SECOND_LOAD, run_id="r3")
    assert (report.status, report.rows_read) == ("loaded", 30) and table.read().count() == 130
    runs = {r["run_id"]: r["source_modified"] for r in read_audit(spark, audit).collect()}
    assert runs["r0"] is None and runs["r1"] == runs["r2"] < runs["r3"]


def test_a_file_without_values_and_one_without_the_column_drift_alike(spark, tmp_path):
    path = str(tmp_path / "pieces")
    spark.sql("SELECT 1 AS a, 'x' AS b").write.parquet(path + "/p1")
    spark.sql("SELECT 2 AS a, CAST(NULL AS STRING) AS b, 3 AS more").write.parquet(path + "/p2")
    spark.sql("SELECT 4 AS a").write.parquet(path + "/p3")
    df = files.read_drifted(spark, path)
    assert sorted(df.columns) == ["a", "b", "more"] and df.count() == 3
    piece = F.regexp_extract("_metadata.file_path", "/(p[0-9])/", 1)
    found = {tuple(r) for r in files.drift_by_file(df, ["a", "b", "c"], piece).collect()}
    lacking = {(f"p{i}", "c", "empty", 1, 0) for i in (1, 2, 3)}
    assert found == lacking | {("p2", "b", "empty", 1, 0), ("p3", "b", "empty", 1, 0), ("p2", "more", "undeclared", 1, 1)}
    assert files.drift_by_file(df, ["a", "b", "more"]).where("drift = 'undeclared'").count() == 0


def test_the_stream_forgets_keys_behind_its_watermark(spark, tmp_path):
    schema = "event_id long, ts timestamp_ntz"

    def land(first, last, day):
        spark.range(first, last).selectExpr("id AS event_id", f"timestamp_ntz'{day}' AS ts").write.mode("append").parquet(str(tmp_path / "landed"))

    def run():
        query = streams.dedup_stream(spark, str(tmp_path / "landed"), schema, str(tmp_path / "out"), str(tmp_path / "check"), ["event_id"], "ts", "1 day")
        query.awaitTermination()
        states = [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]
        return streams.late_rows(query), states[-1]

    land(0, 10, "2024-01-01")
    land(5, 15, "2024-01-01")
    assert run() == (0, 15)
    land(20, 25, "2024-01-10")
    land(0, 5, "2024-01-01 12:00:00")  # known and not yet behind the watermark
    assert run() == (0, 5)  # the first day's keys are forgotten at the end
    land(0, 7, "2024-01-02")
    assert run()[0] == 7
    assert spark.read.schema(schema).parquet(str(tmp_path / "out")).count() == 20


def test_defaults_of_the_catalog_fill_and_read_back(spark, tmp_path):
    described = [("k", "UInt64", "", ""), ("s", "String", "DEFAULT", "it's"), ("updated_at", "DateTime", "DEFAULT", "now()"), ("amount", "Nullable(Decimal(9,2))", "", "")]
    contract = contract_from_description("filled", described, primary_key="k")
    create_table(spark, contract, "filled_defaults", str(tmp_path / "filled"))
    try:
        insert_into(spark.range(2).selectExpr("id AS k"), "filled_defaults")
        insert_into(spark.sql("SELECT 'own' AS s, 7L AS k"), "filled_defaults")
        rows = {r["k"]: r for r in spark.table("filled_defaults").collect()}
        assert {k: r["s"] for k, r in rows.items()} == {0: "it's", 1: "it's", 7: "own"} and rows[0]["amount"] is None
        assert abs((rows[7]["updated_at"] - datetime.now()).total_seconds()) < 36 * 3600
        back = contract_from_table(spark, "filled_defaults", primary_key="k")
        facts = [(f.name, f.metadata["declared"], f.metadata.get("CURRENT_DEFAULT")) for f in back.schema]
        assert facts == [("k", "UInt64", None), ("s", "String", "it's"), ("updated_at", "DateTime", "now()"), ("amount", "Decimal(9,2)", None)]
    finally:
        spark.sql("DROP TABLE filled_defaults")


def entry_in(folder, package, code):
    """Run ``code`` against a copy of the entry in ``folder``, in a process of its own."""
    run = subprocess.run([sys.executable, "-c", textwrap.dedent(code).replace("PACKAGE", str(package))], cwd=folder, capture_output=True, text=True, timeout=300, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert run.returncode == 0, run.stderr[-2000:]
    return run.stdout


LOADED = """
    import importlib.util
    spec = importlib.util.spec_from_file_location("entry", "PACKAGE/__spark_entry__.py")
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
"""


def test_the_entry_without_the_optional_folders(tmp_path):
    root = os.path.dirname(os.path.abspath(driver.__file__))
    copy = tmp_path / "copy"
    shutil.copytree(os.path.join(root, "lakeload"), copy / "lakeload", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), copy)
    count = LOADED + "    print(len(entry.queries()))\n"
    n = int(entry_in(tmp_path, copy, count))
    assert n == sum(not re.match(r"op\d+_|pipeline$", name) for name in driver.queries())
    os.makedirs(copy / "lakeload" / "llm" / "__pycache__")  # what version control leaves of a deleted folder
    assert int(entry_in(tmp_path, copy, count)) == n


def test_workers_find_the_package_from_any_folder(tmp_path):
    if not any(name.startswith("op4_") for name in driver.queries()):
        pytest.skip("the optional folders are not there")
    code = LOADED + f"""
    from pyspark.sql import SparkSession
    spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
    name = next(n for n in entry.queries() if n.startswith("op4_"))
    print(entry.queries()[name](spark, "{DATA}/sf0.001").count())
    """
    assert int(entry_in(tmp_path, os.path.dirname(os.path.abspath(driver.__file__)), code).split()[-1]) == 200


def scanned_rows(df):
    """Rows that the scans of a plan hand on: what file and row-group statistics have not skipped."""
    df._jdf.queryExecution().executedPlan()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    total, open_ = 0, [plan]
    while open_:
        node = open_.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.executedPlan()
        if "Scan" in node.nodeName():
            total += node.metrics().apply("numOutputRows").value()
        open_ += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_clustered_files_serve_both_columns(spark, tmp_path):
    rows = spark.range(40_000).selectExpr("id AS k", "date'2024-01-01' + cast(pmod(xxhash64(id), 1000) AS int) AS day", "concat('v', id) AS v")
    clustered, sliced = str(tmp_path / "z"), str(tmp_path / "k")
    files.write_clustered(rows, clustered, ["k", "day"], files=16)
    rows.repartitionByRange(16, "k").sortWithinPartitions("k").write.parquet(sliced)
    assert sorted(spark.read.parquet(clustered).collect()) == sorted(rows.collect())
    by_key, by_day = "k BETWEEN 1000 AND 1200", "day > date'2026-09-01'"
    read = {(name, where): scanned_rows(spark.read.parquet(path).where(where)) for name, path in (("z", clustered), ("k", sliced)) for where in (by_key, by_day)}
    # one sort serves its own column only, the curve serves both
    assert read["z", by_key] <= 16_000 and read["z", by_day] <= 16_000
    assert read["k", by_day] == 40_000


def test_a_clustered_write_splits_a_common_value(spark, tmp_path):
    rows = spark.range(9000).selectExpr("if(id % 3 = 0, NULL, id % 2) AS a", "if(id < 6000, 5, id) AS b", "id AS v")
    files.write_clustered(rows, str(tmp_path / "z"), ["a", "b"], files=9)
    sizes = [r["n"] for r in spark.read.parquet(str(tmp_path / "z")).groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 9000 and max(sizes) < 2500
    files.write_clustered(rows.limit(0), str(tmp_path / "none"), ["a", "b"], files=4)
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError):
        files.write_clustered(spark.sql("SELECT 'x' AS s"), str(tmp_path / "text"), ["s"], files=1)


def test_a_key_that_is_not_there_reads_no_rows(spark, tmp_path):
    even = events(spark, 0, 5000).withColumn("event_id", F.col("event_id") * 2)
    stamps = even.select("*", F.lit(None).cast("timestamp_ntz").alias("last_synced_at"), F.lit(str(FIRST_LOAD)).cast("timestamp_ntz").alias("updated_at"))
    stamps = stamps.select(*(F.col(f.name).cast(f.dataType) for f in EVENTS.schema))
    read = {}
    for bloom in (None, 5000):
        table = MonthTable(spark, str(tmp_path / f"t{bloom}"), EVENTS, bloom_keys=bloom)
        table.append(stamps)
        table.mark(SECOND_LOAD)  # rewritten months keep their filters
        read[bloom] = [scanned_rows(table.read().where(F.col("event_id") == key)) for key in (4001, 4000)]
    assert read[None][0] > 0 and read[5000][0] == 0 and read[5000][1] > 0


def test_compaction_reads_noted_months_only(spark, tmp_path):
    table = MonthTable(spark, str(tmp_path / "t"), EVENTS)
    old = events(spark, 0, 50)
    rows = old.select("*", F.lit(None).cast("timestamp_ntz").alias("last_synced_at"), F.lit(str(FIRST_LOAD)).cast("timestamp_ntz").alias("updated_at"))
    table.append(rows.withColumn("ts", F.col("ts") - F.expr("INTERVAL 1 YEAR")))
    assert table.compact() == 0
    for path in glob.glob(f"{table.path}/p_month=2023*/*.parquet"):  # whoever reads that year fails
        with open(path, "wb") as file:
            file.write(b"garbage")
    table.append(rows)
    table.append(rows.withColumn("updated_at", F.lit(str(SECOND_LOAD)).cast("timestamp_ntz")))
    assert table.compact() == 50 and table.compact() == 0
    assert table.read([202401]).count() == 50
    with pytest.raises(Exception):
        table.compact(repair=True)

"""Stored month tables, whole loads, streams and file sources."""

from __future__ import annotations

import json
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F, types as T

from lakeload.contracts import TableContract, column
from lakeload.operators.conform import conform
from lakeload.operators.versioned import months_between
from lakeload.plans import jobs, queries
from lakeload.plans.load import read_audit, run_load
from lakeload.scratch import shared_dir
from lakeload.sources import files, jdbc
from lakeload.streaming.stream_load import stream_load
from lakeload.tables import MonthTable

D = datetime
T1, T2, T3 = D(2025, 6, 1), D(2025, 6, 2), D(2025, 6, 3)

CONTRACT = TableContract(
    "sales",
    T.StructType(
        [
            column("RECID", "UInt64"),
            column("NAME", "String"),
            column("TRANSDATE", "DateTime"),
            column("MODIFIEDDATETIME", "DateTime"),
            column("last_synced_at", "DateTime"),
            column("updated_at", "DateTime", "now()"),
        ]
    ),
    primary_key="RECID",
    date_column="TRANSDATE",
)


def frame(spark, data):
    df = spark.createDataFrame(data, "RECID string, NAME string, TRANSDATE string, MODIFIEDDATETIME string")
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("TRANSDATE", "MODIFIEDDATETIME")})


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


FIRST = [
    ("1", "one", "2025-01-05", "2025-01-06 10:00:00"),
    ("2", "two", "2025-01-20", "2025-01-21 10:00:00.5"),
    ("3", "three", "2025-02-03", "2025-02-04 10:00:00"),
    ("4", "undated", None, "2025-02-01 10:00:00"),
    ("5", "ancient", "1990-01-01", "2025-02-01 10:00:00"),
    ("x", "bad key", "2025-02-03", "2025-02-09 10:00:00"),
]


@pytest.fixture
def table(spark, tmp_path):
    return MonthTable(spark, str(tmp_path / "sales"), CONTRACT)


def test_first_load(spark, table, tmp_path):
    report = run_load(frame(spark, FIRST), table, "daily", T1, rejects_path=str(tmp_path / "rejects"))
    assert (report.status, report.rows_read, report.rows_rejected, report.rows_accepted) == ("loaded", 6, 1, 5)
    assert report.added_columns == ["last_synced_at", "updated_at"]
    # the rejected row's later time moves neither bound nor mark
    assert report.synced_at == D(2025, 2, 4, 10)
    assert table.watermarks() == (D(2025, 2, 4, 10), D(2025, 2, 4, 10))
    assert rows(table.read(), "RECID", "p_month") == [(1, 202501), (2, 202501), (3, 202502), (4, 0), (5, 0)]
    assert rows(table.read(), "last_synced_at") == [(D(2025, 2, 4, 10),)] * 5
    rejected = spark.read.parquet(str(tmp_path / "rejects"))
    assert rows(rejected, "RECID", "reject_reason") == [("x", "invalid primary key")]


def test_loading_the_same_batch_again_changes_nothing(spark, table):
    run_load(frame(spark, FIRST), table, "full", T1)
    before = rows(table.read(), "*")
    run_load(frame(spark, FIRST), table, "full", T1)
    assert rows(table.read(), "*") == before
    run_load(frame(spark, FIRST), table, "monthly", T1)
    assert rows(table.read(), "*") == before


def test_daily_load_takes_the_boundary_again_and_skips_older_files(spark, table):
    run_load(frame(spark, FIRST), table, "daily", T1)
    again = run_load(frame(spark, FIRST), table, "daily", T2)
    assert (again.status, again.rows_read, again.rows_accepted) == ("loaded", 2, 1)
    older = frame(spark, FIRST[:2])
    assert run_load(older, table, "daily", T3).status == "skipped"
    newer = frame(spark, [("2", "two again", "2025-01-20", "2025-03-01 00:00:00")])
    assert run_load(newer, table, "daily", T3).rows_accepted == 1
    got = {r["RECID"]: (r["NAME"], r["updated_at"], r["last_synced_at"]) for r in table.read().collect()}
    assert got[2] == ("two again", T3, D(2025, 3, 1))
    assert got[3] == ("three", T2, D(2025, 2, 4, 10))
    assert got[1] == ("one", T1, D(2025, 2, 4, 10))


def test_deferred_loads_read_and_compact_to_the_merged_table(spark, table, tmp_path):
    deferred = MonthTable(spark, str(tmp_path / "deferred"), CONTRACT)
    batches = [FIRST, [("2", "two again", "2025-01-20", "2025-03-01 00:00:00")], FIRST[2:3]]
    for i, batch in enumerate(batches):
        for target, defer in ((table, False), (deferred, True)):
            run_load(frame(spark, batch), target, "full", D(2025, 6, 1 + i), defer_merge=defer)
    columns = [c for c in CONTRACT.schema.names if c != "last_synced_at"]
    assert deferred.read().count() > table.read().count()
    assert rows(deferred.current(), *columns) == rows(table.read(), *columns)
    assert deferred.watermarks() == table.watermarks()
    deferred.compact()
    assert rows(deferred.read(), *columns) == rows(table.read(), *columns)


def test_mark_covers_older_rows_in_range_in_other_months(spark, table):
    run_load(frame(spark, FIRST), table, "full", T1)
    late = [("7", "seven", "2025-05-01", "2025-01-21 00:00:00"), ("8", "eight", "2025-05-02", "2025-05-02 00:00:00")]
    run_load(frame(spark, late), table, "full", T2)
    marks = {r["RECID"]: r["last_synced_at"] for r in table.read().collect()}
    assert marks[2] == D(2025, 5, 2) and marks[1] == D(2025, 2, 4, 10)


def test_nothing_accepted_moves_no_mark(spark, table):
    run_load(frame(spark, FIRST), table, "full", T1)
    report = run_load(frame(spark, [("bad", "b", "2025-06-01", "2025-06-01 00:00:00")]), table, "daily", T2)
    assert report.status == "rejected"
    assert table.watermarks()[0] == D(2025, 2, 4, 10)


def test_monthly_needs_a_watermark(spark, table, tmp_path):
    with pytest.raises(ValueError):
        run_load(frame(spark, FIRST), table, "monthly", T1, audit_path=str(tmp_path / "runs"), run_id="r")
    audit = read_audit(spark, str(tmp_path / "runs")).first()
    assert (audit["status"], audit["run_id"]) == ("failed", "r") and "watermark" in audit["error"]


def test_audit_row_of_a_repeated_run_is_replaced(spark, table, tmp_path):
    for _ in range(2):
        run_load(frame(spark, FIRST), table, "full", T1, audit_path=str(tmp_path / "runs"), run_id="r")
    run_load(frame(spark, FIRST), table, "full", T1, audit_path=str(tmp_path / "runs"))
    assert read_audit(spark, str(tmp_path / "runs")).count() == 2


def test_table_without_modification_time_loads_in_full(spark, tmp_path):
    schema = T.StructType([f for f in CONTRACT.schema if f.name != "MODIFIEDDATETIME"])
    contract = TableContract("link", schema, "RECID", "TRANSDATE", modified_column=None)
    target = MonthTable(spark, str(tmp_path / "link"), contract)
    report = run_load(frame(spark, FIRST).drop("MODIFIEDDATETIME"), target, "full", T1)
    assert (report.status, report.synced_at) == ("loaded", None)
    with pytest.raises(ValueError):
        run_load(frame(spark, FIRST), target, "daily", T1)


@pytest.mark.parametrize(("scope", "expected"), [("sort_key", [202501, 202503]), ("primary_key", [202503])])
def test_record_that_changes_month(spark, tmp_path, scope, expected):
    target = MonthTable(spark, str(tmp_path / scope), CONTRACT.but(scope=scope))
    run_load(frame(spark, FIRST[:1]), target, "full", T1)
    run_load(frame(spark, [("1", "moved", "2025-03-05", "2025-03-06 00:00:00")]), target, "full", T2)
    assert [m for (m,) in rows(target.read(), "p_month")] == expected
    assert target.months() == expected


def test_upsert_replaces_only_later_modifications_across_months(spark, table):
    run_load(frame(spark, FIRST), table, "full", T1)
    batch = frame(
        spark,
        [
            ("1", "moved", "2025-04-01", "2025-04-01 00:00:00"),
            ("2", "stale", "2025-01-20", "2025-01-02 00:00:00"),
            ("3", "same time", "2025-02-03", "2025-02-04 10:00:00"),
            ("9", "new", "2025-02-03", "2025-02-04 10:00:00"),
        ],
    )
    for _ in range(2):
        table.upsert(conform(batch, CONTRACT, T2))
        got = rows(table.read(), "RECID", "NAME", "p_month")
        assert [r[:2] for r in got] == [(1, "moved"), (2, "two"), (3, "three"), (4, "undated"), (5, "ancient"), (9, "new")]
        assert got[0][2] == 202504


def test_append_then_compact(spark, table):
    run_load(frame(spark, FIRST), table, "full", T1)
    newer = table.read().drop("p_month").where("RECID = 1").withColumns(
        {"NAME": F.lit("newer"), "updated_at": F.lit(T2).cast("timestamp_ntz")}
    )
    table.append(newer)
    assert table.read().count() == 6
    assert table.current().count() == 5
    table.compact([202501])
    assert rows(table.read().where("RECID = 1"), "NAME") == [("newer",)]
    assert table.read().count() == 5
    with pytest.raises(ValueError):
        table.append(newer.select("NAME", "RECID"))


def test_compaction_rewrites_only_months_with_several_versions(spark, tmp_path):
    for scope, moved, untouched in (("sort_key", "2025-01-05", "202502"), ("primary_key", "2025-03-05", "202502")):
        target = MonthTable(spark, str(tmp_path / scope), CONTRACT.but(scope=scope), months_at_once=1)
        target.append(conform(frame(spark, FIRST[:3]), CONTRACT, T1))
        before = sorted(os.listdir(f"{target.path}/p_month={untouched}"))
        target.append(conform(frame(spark, [("1", "newer", moved, "2025-03-06 00:00:00")]), CONTRACT, T2))
        expected = rows(target.current(), "RECID", "NAME")
        assert (1, "newer") in expected and len(expected) == 3
        target.compact()
        assert rows(target.read(), "RECID", "NAME") == expected
        assert sorted(os.listdir(f"{target.path}/p_month={untouched}")) == before
        assert target.compact() == 0


def test_changes_in_portions_equal_changes_at_once(spark, tmp_path):
    results = []
    for size in (None, 2):
        target = MonthTable(spark, str(tmp_path / str(size)), CONTRACT, months_at_once=size)
        target.append(conform(frame(spark, FIRST[:5]), CONTRACT, T1))
        target.mark(T3)
        target.delete("RECID IN (1, 3, 4)")
        results.append(rows(target.read(), "*"))
    assert results[0] == results[1] and len(results[0]) == 2


def test_delete_empties_months_and_leaves_others_alone(spark, table):
    run_load(frame(spark, FIRST), table, "full", T1)
    kept = os.path.join(table.path, "p_month=202501")
    files_before = sorted(os.listdir(kept))
    table.delete("TRANSDATE >= TIMESTAMP_NTZ'2025-02-01'")
    assert rows(table.read(), "RECID") == [(1,), (2,), (4,), (5,)]
    assert sorted(os.listdir(kept)) == files_before
    assert table.months() == [0, 202501]
    table.delete("true")
    assert table.read().count() == 0 and table.months() == []
    run_load(frame(spark, FIRST), table, "full", T2)
    assert table.read().count() == 5


def test_retention_drops_months_and_rows(spark, table):
    run_load(frame(spark, FIRST), table, "full", T1)
    table.retain(date(2030, 1, 10))
    assert rows(table.read(), "RECID") == [(2,), (3,), (4,), (5,)]
    table.retain(date(2030, 4, 1))
    assert rows(table.read(), "RECID") == [(4,), (5,)]


def test_mark(spark, table):
    run_load(frame(spark, FIRST), table, "full", T1)
    table.mark(T2, D(2025, 1, 6, 10), D(2025, 1, 21, 10, 0, 0, 900000))
    assert rows(table.read().where("last_synced_at = TIMESTAMP_NTZ'2025-06-02'"), "RECID") == [(1,), (2,)]
    table.mark(T3)
    assert rows(table.read(), "last_synced_at") == [(T3,)] * 5


def test_range_read_prunes_months(spark, table):
    run_load(frame(spark, FIRST), table, "full", T1)
    df = table.between(date(2025, 1, 10), date(2025, 1, 31))
    assert rows(df, "RECID") == [(2,)]
    assert df.inputFiles() and all("p_month=202501" in f for f in df.inputFiles())
    assert table.between(date(2024, 1, 10), date(2024, 1, 31)).count() == 0
    assert rows(table.between(date(2024, 12, 1), date(2025, 2, 28)), "RECID") == [(1,), (2,), (3,)]
    assert months_between(date(2024, 11, 5), date(2025, 2, 1)) == [202411, 202412, 202501, 202502]


def test_replacing_refuses_rows_of_other_months(spark, table):
    run_load(frame(spark, FIRST), table, "full", T1)
    with pytest.raises(ValueError):
        table.replace(table.read(), [202501])
    assert table.read().count() == 5


def test_swap_interrupted_at_any_point_is_finished_later(spark, table, monkeypatch):
    """The driver dies before, within and after the swap; the change is applied exactly once."""
    run_load(frame(spark, FIRST), table, "full", T1)
    expected = rows(table.read().where("NAME <> 'one' AND RECID <> 3"), "*")

    with monkeypatch.context() as dying:
        dying.setattr(MonthTable, "_swap", lambda self, note: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            table.delete("NAME = 'one' OR RECID = 3")
    assert table._read().count() == 5
    # one month was already swapped out, the other deleted but not yet replaced
    files.no_rows(spark, table.schema).write.mode("overwrite").parquet(f"{table.path}/p_month=202501")
    fresh = MonthTable(spark, table.path, CONTRACT)
    assert fresh.recover()
    assert rows(fresh.read(), "*") == expected
    assert not fresh.recover()


@pytest.mark.parametrize("defer", [False, True])
def test_interrupted_first_load_leaves_no_mark_without_its_rows(spark, table, monkeypatch, defer):
    """Only part of the files became visible when the driver died: the next daily load must miss nothing."""

    def dies(self):
        raise KeyboardInterrupt

    with monkeypatch.context() as dying:
        dying.setattr(MonthTable, "_settle", dies)
        with pytest.raises(KeyboardInterrupt):
            run_load(frame(spark, FIRST), table, "daily", T1, defer_merge=defer)
    files.no_rows(spark, table.schema).write.mode("overwrite").parquet(f"{table.path}/p_month=202501")
    assert 0 < table._read().count() < 5
    run_load(frame(spark, FIRST), MonthTable(spark, table.path, CONTRACT), "daily", T2, defer_merge=defer)
    assert rows(table.current(), "RECID") == [(1,), (2,), (3,), (4,), (5,)]


def test_watermark_hints_do_not_change_the_answer(spark, table):
    run_load(frame(spark, FIRST), table, "full", T1)
    true = table.watermarks()
    early, late = D(2025, 1, 1), D(2026, 1, 1)
    for known in [(early, early), true, (late, late), (late, None), (early, late), (None, None)]:
        assert table.watermarks(known) == true


def test_audited_loads_use_the_last_marks(spark, table, tmp_path):
    audit = str(tmp_path / "runs")
    run_load(frame(spark, FIRST), table, "daily", T1, audit_path=audit)
    again = run_load(frame(spark, FIRST), table, "daily", T2, audit_path=audit)
    assert (again.rows_read, again.rows_accepted) == (2, 1)


def test_a_large_month_is_written_by_several_tasks(spark, tmp_path):
    """A third of all rows in one month must not end up in one file."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        target = MonthTable(spark, str(tmp_path / "big"), CONTRACT)
        month = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 24)
        day = F.expr("TIMESTAMP_NTZ'2024-01-01'") + F.make_ym_interval(months=month.cast("int"))
        big = spark.range(60000).select(
            F.col("id").alias("RECID"), F.md5(F.col("id").cast("string")).alias("NAME"), day.alias("TRANSDATE")
        )
        big = big.withColumns({c: F.col("TRANSDATE") for c in ("MODIFIEDDATETIME", "last_synced_at", "updated_at")})
        target.append(big.select(*CONTRACT.schema.names))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot = [f for f in os.listdir(f"{target.path}/p_month=202401") if f.endswith(".parquet")]
    assert len(hot) > 3
    assert target.read().count() == 60000


def test_stream_equals_batch_and_replays_nothing(spark, tmp_path):
    source = str(tmp_path / "landed")
    batch = MonthTable(spark, str(tmp_path / "batch"), CONTRACT)
    run_load(frame(spark, FIRST), batch, "full", T1)
    streamed = MonthTable(spark, str(tmp_path / "streamed"), CONTRACT)
    schema = frame(spark, FIRST).schema

    def run():
        checkpoint = str(tmp_path / "checkpoint")
        audit, rejects = str(tmp_path / "runs"), str(tmp_path / "rejects")
        query = stream_load(spark, source, schema, streamed, checkpoint, T1, 1, None, rejects, audit)
        query.awaitTermination()

    frame(spark, FIRST[:3]).coalesce(1).write.parquet(source)
    run()
    frame(spark, FIRST[3:]).coalesce(1).write.mode("append").parquet(source)
    run()
    run()
    columns = [c for c in CONTRACT.schema.names if c != "last_synced_at"]
    assert rows(streamed.read(), *columns) == rows(batch.read(), *columns)
    assert streamed.watermarks() == batch.watermarks()
    assert read_audit(spark, str(tmp_path / "runs")).count() == 2
    assert spark.read.parquet(str(tmp_path / "rejects")).count() == 1


# files


def test_formats_are_chosen_by_extension(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n long, s string")
    df.write.parquet(str(tmp_path / "x.parquet"))
    df.coalesce(1).write.csv(str(tmp_path / "x.csv"), header=True)
    (tmp_path / "x.json").write_text(json.dumps([{"n": 1, "s": "a"}, {"n": 2, "s": "b"}], indent=1))
    (tmp_path / "lines.json").write_text('{"n": 1, "s": "a"}\n{"n": 2, "s": "b"}\n')
    for read in (
        files.read_landed(spark, str(tmp_path / "x.parquet")),
        files.read_landed(spark, str(tmp_path / "x.csv")),
        files.read_landed(spark, str(tmp_path / "x.json")),
        files.read_landed(spark, str(tmp_path / "lines.json"), "n long, s string", by_line=True),
    ):
        assert rows(read, "n", "s") == [(1, "a"), (2, "b")]
    (tmp_path / "quoted.csv").write_text('n,s\n1,"two\nlines, ""quoted"""\n2,\n')
    assert rows(files.read_landed(spark, str(tmp_path / "quoted.csv")), "n", "s") == [
        (1, 'two\nlines, "quoted"'),
        (2, None),
    ]
    for path in ("x.PARQUET", "x.txt", "x"):
        with pytest.raises(ValueError):
            files.read_landed(spark, path)


def test_json_documents_are_bounded_and_follow_the_rows(spark, tmp_path):
    found = {}
    for n in (100_000, 300_000):
        orders = spark.range(n).select(F.col("id").alias("o_orderkey"), F.lit("O").alias("o_orderstatus"), F.lit(1.5).alias("o_totalprice"), F.lit("LOW").alias("o_orderpriority"))
        orders.coalesce(1).write.parquet(str(tmp_path / f"{n}" / "orders.parquet"))
        read = queries.scan_json_document(spark, str(tmp_path / f"{n}"))
        assert read.agg(F.countDistinct("o_orderkey")).first()[0] == read.count() == n
        sizes = [r["count"] for r in read.groupBy(F.input_file_name()).count().collect()]
        found[n] = (len(sizes), max(sizes))
    assert found == {100_000: (16, 6_250), 300_000: (48, 6_250)}


def test_landed_files_follow_the_table(spark, tmp_path, monkeypatch):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.repeat(F.lit('"a"\n'), 100).alias("text"))
    docs.write.parquet(str(tmp_path / "in" / "documents.parquet"))
    assert len(queries.scan_csv_quoted(spark, str(tmp_path / "in")).inputFiles()) == 4
    monkeypatch.setattr(queries, "CSV_BYTES", 4_000)
    read = queries.scan_csv_quoted(spark, str(tmp_path / "in"))
    assert len(read.inputFiles()) == 11 and read.count() == 100

    events = spark.range(0, 40, 1, 4).selectExpr("id AS event_id", "TIMESTAMP_NTZ'2024-01-05' AS ts", "id AS user_id", "'click' AS event_type", "1.5D AS value", "'' AS props")
    events.write.parquet(str(tmp_path / "in" / "events.parquet"))
    monkeypatch.setattr(queries, "run_dir", lambda spark, name: str(tmp_path / name))
    late = queries.stream_late_file(spark, str(tmp_path / "in"))
    assert [tuple(r) for r in late.groupBy("event_type").count().collect()] == [("corrected", 40)]
    assert len(list((tmp_path / "stream" / "landed").glob("*.parquet"))) > 2


def test_append_is_strict_and_snapshot_replaces(spark, tmp_path):
    path = str(tmp_path / "set")
    df = spark.createDataFrame([(1, "a")], "n long, s string")
    files.append_parquet(df, path)
    files.append_parquet(df, path)
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError):
        files.append_parquet(df.withColumn("n", F.col("n").cast("int")), path)
    with pytest.raises(ValueError):
        files.append_parquet(df.drop("s"), path)
    files.write_snapshot(df, path)
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(ValueError):
        files.union_all(df, df.drop("s"))


def test_freshness_is_local_time_text(spark, tmp_path):
    path = tmp_path / "f.parquet"
    path.write_bytes(b"not even parquet")
    os.utime(path, (1735689600, 1735689600))  # 2025-01-01 00:00:00 UTC
    assert files.last_modified(spark, str(path)) == "2025-01-01 07:00:00"
    spark.range(7).coalesce(1).write.parquet(str(tmp_path / "set"))
    (part,) = (tmp_path / "set").glob("*.parquet")
    os.utime(part, (1735689600, 1735689600))
    assert rows(files.scan_freshness(spark.read.parquet(str(tmp_path / "set"))), "modified_at", "n_rows") == [
        ("2025-01-01 07:00:00", 7)
    ]
    assert files.last_modified(spark, str(tmp_path / "absent")) is None


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


# database reads, as far as they go without a database


def test_jdbc_sub_select_and_day_ranges():
    assert jdbc.table_query("dbo.T", dirty_read=True) == "(SELECT * FROM dbo.T WITH (NOLOCK)) src"
    assert jdbc.table_query("t") == "(SELECT * FROM t) src"
    ranges = jdbc.day_predicates("TRANSDATE", date(2025, 1, 30), date(2025, 2, 1))
    assert ranges == [
        "TRANSDATE >= '2025-01-30' AND TRANSDATE < '2025-01-31'",
        "TRANSDATE >= '2025-01-31' AND TRANSDATE < '2025-02-01'",
        "TRANSDATE >= '2025-02-01' AND TRANSDATE < '2025-02-02'",
    ]


# jobs


def test_retail_job_from_landed_file_to_table(spark, tmp_path, capsys):
    description = [
        ["NAME", "String", "", ""],
        ["MODIFIEDDATETIME", "DateTime", "", ""],
        ["CREATEDDATETIME", "DateTime", "", ""],
        ["RECID", "UInt64", "", ""],
        ["last_synced_at", "DateTime", "", ""],
        ["updated_at", "DateTime", "DEFAULT", "now()"],
    ]
    (tmp_path / "description.json").write_text(json.dumps(description))
    lake, warehouse = str(tmp_path / "lake"), str(tmp_path / "warehouse")
    landed = spark.createDataFrame(
        [(1, "cash", "2025-01-01", "2025-01-02 00:00:00"), (-2, "bad", "2025-01-01", "2025-01-02 00:00:00")],
        "RECID long, NAME string, CREATEDDATETIME string, MODIFIEDDATETIME string",
    )
    jobs.land(landed.limit(1), lake, "retailtendertypetable", append=False)
    jobs.land(landed, lake, "retailtendertypetable", append=False)
    jobs.land(landed, lake, "retailtendertypetable", append=True)
    where = ["--lake", lake, "--warehouse", warehouse, "--description", str(tmp_path / "description.json")]
    for mode in ("daily", "monthly"):
        jobs.main([mode, "retailtendertypetable", *where])
        assert "status='loaded'" in capsys.readouterr().out
    stored = spark.read.parquet(f"{warehouse}/retailtendertypetable")
    assert rows(stored, "RECID", "NAME", "p_month") == [(1, "cash", 202501)]
    assert read_audit(spark, f"{warehouse}/etl_runs/retailtendertypetable").count() == 2
    for wrong in (["daily", "t", "--lake", lake], ["land", "t", "--lake", lake, "--options", "o", "--source", "s", "--column", "c"]):
        with pytest.raises(SystemExit):
            jobs.main(wrong)

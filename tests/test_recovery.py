"""What is left behind by a driver that dies, and rows that must not get lost."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakeload.operators.versioned import changes_by_hash
from lakeload.plans.load import rejects_of, run_load
from lakeload.plans.samples import FIRST_LOAD, SECOND_LOAD, EVENTS, stamped
from lakeload.tables import MonthTable

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def rows(spark, *ids, day="2024-01-05", kind="view"):
    data = [(i, datetime.fromisoformat(day), 1, kind, 1.0, "{}") for i in ids]
    return spark.createDataFrame(data, SCHEMA)


def batch(spark, *ids, at=FIRST_LOAD, **facts):
    return stamped(rows(spark, *ids, **facts), EVENTS, at)


def die_in_swap(monkeypatch, table, act):
    """Let an action end right before it touches the table."""
    with monkeypatch.context() as m:
        m.setattr(table, "_swap", lambda note: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            act()


def ids(table):
    return sorted(r[0] for r in table.read().select("event_id").distinct().collect())


@pytest.mark.parametrize("setting", ["same", "other"])
def test_append_after_a_dead_merge_keeps_all_rows(spark, tmp_path, monkeypatch, setting):
    path = str(tmp_path / "events")
    table = MonthTable(spark, path, EVENTS)
    table.append(batch(spark, 1))
    die_in_swap(monkeypatch, table, lambda: table.merge(batch(spark, 2, 4)))
    with pytest.raises(RuntimeError, match="interrupted"):
        table.read()
    before = spark.conf.get("spark.checkpoint.dir")
    try:
        if setting == "other":
            monkeypatch.setattr("lakeload.scratch._SETTING", "spark.no.such.setting")
        fresh = MonthTable(spark, path, EVENTS)
        fresh.append(batch(spark, 3))
        fresh.merge(batch(spark, 5))
        assert ids(fresh) == [1, 2, 3, 4, 5]
    finally:
        assert spark.conf.get("spark.checkpoint.dir") == before


def test_append_after_a_dead_first_write_keeps_its_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "events")
    table = MonthTable(spark, path, EVENTS)
    with monkeypatch.context() as m:
        m.setattr(table, "_settle", lambda: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            table.merge(batch(spark, 1, 2))
    fresh = MonthTable(spark, path, EVENTS)
    fresh.append(batch(spark, 3))
    fresh.merge(batch(spark, 4))
    assert ids(fresh) == [3, 4]


def test_rejects_are_kept_without_a_path(spark, tmp_path):
    table = MonthTable(spark, str(tmp_path / "events"), EVENTS)
    landed = rows(spark, 1, 2).withColumn("event_id", F.expr("IF(event_id = 2, 'x', CAST(event_id AS STRING))"))
    report = run_load(landed, table, "daily", FIRST_LOAD)
    assert (report.rows_accepted, report.rows_rejected) == (1, 1)
    assert spark.read.parquet(rejects_of(table)).select("event_id").first()[0] == "x"


def test_latest_modification_wins_if_asked_for(spark, tmp_path):
    table = MonthTable(spark, str(tmp_path / "events"), EVENTS)
    run_load(rows(spark, 1, day="2024-01-20", kind="new"), table, "full", FIRST_LOAD, by_modification=True)
    run_load(rows(spark, 1, day="2024-01-10", kind="old"), table, "full", SECOND_LOAD, by_modification=True)
    newest = table.read().orderBy(F.desc("ts")).first()
    assert newest["event_type"] == "new"


def test_hash_compares_values_not_types(spark):
    incoming = spark.createDataFrame([(1, 5)], "k long, v long")
    existing = spark.createDataFrame([(1, 5)], "k int, v int")
    assert changes_by_hash(incoming, existing, "k").first()["change"] == "same"


def test_hash_compares_with_the_latest_version(spark):
    incoming = spark.createDataFrame([(1, "b")], "k long, v string")
    for first, second, change in (("a", "b", "same"), ("b", "a", "changed")):
        existing = spark.createDataFrame([(1, first, 1), (1, second, 2)], "k long, v string, at int")
        assert changes_by_hash(incoming, existing, "k", order=["at"]).first()["change"] == change


def test_hash_takes_dotted_names(spark):
    incoming = spark.createDataFrame([(1, "b")], ["k", "v.w"])
    assert changes_by_hash(incoming, incoming, "k").first()["change"] == "same"

"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from tests.conftest import DATA

SF_DIR = os.environ.get("TEST_SF_DIR", f"{DATA}/sf0.01")
ORACLE = driver.oracle_sql()


@pytest.fixture(scope="module")
def duck() -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(spark, duck, name):
    df = driver.queries()[name](spark, SF_DIR)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert rows
        return
    expected = duck.execute(ORACLE[name])
    columns = [d[0] for d in expected.description]
    expected_rows = expected.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert len(rows) == len(expected_rows)
    assert canonical(df.columns, rows) == canonical(columns, expected_rows)


GOLDEN = f"{DATA}/sf0.01"


@pytest.mark.parametrize(
    ("name", "where", "count"),
    [
        ("incremental_extract", "true", 5332),
        ("skip_path", "n_rows = 0", 1),
        ("lookback_extract", "true", 953),
        ("conform_orders", "o_orderdate IS NULL", 11326),
        ("pk_split", "reject_reason IS NULL", 1378),
        ("latest_lineitem", "true", 45832),
        ("latest_lineitem_by_month", "true", 59798),
        ("mark_synced", "last_synced_at IS NOT NULL", 3351),
        ("delete_where", "true", 7986),
        ("retention", "true", 43674),
        ("month_buckets", "true", 80),
        ("date_range_scan", "true", 694),
        ("coercion_loss", "failed_casts = 2000 AND column_name = 'p_brand'", 1),
        ("coercion_loss", "sentinel_dates = 11326 AND column_name = 'o_orderdate'", 1),
        ("clean_text", "contains(text, '\n')", 0),
    ],
)
def test_golden_counts(spark, name, where, count):
    assert driver.queries()[name](spark, GOLDEN).where(where).count() == count


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() == 1000

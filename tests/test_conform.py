"""Conforming rules, one golden case each."""

from __future__ import annotations

from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from lakeload.contracts import (
    RETAIL_DATE_COLUMNS,
    TableContract,
    column,
    contract_from_description,
    contract_from_table,
    declared_type,
    default_primary_key,
    integer_bounds,
    landed_path,
    retail_contract,
)
from lakeload.operators import quality
from lakeload.operators.conform import conform, extra_columns, missing_columns

AS_OF = datetime(2025, 5, 1, 12, 0, 0)


def contract(*fields: T.StructField, **facts) -> TableContract:
    return TableContract(
        "t",
        T.StructType([column("id", "Int64"), *fields]),
        primary_key="id",
        version_column=None,
        modified_column=None,
        synced_column=None,
        **facts,
    )


def conformed(spark, values, source, declared, **facts):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", source)])
    df = spark.createDataFrame(list(enumerate(values)), schema)
    out = conform(df, contract(column("x", declared), **facts), AS_OF)
    return [r["x"] for r in out.orderBy("id").collect()]


NTZ = T.TimestampNTZType()


@pytest.mark.parametrize(
    ("declared", "source", "values", "expected"),
    [
        ("String", T.StringType(), [None, "a\nb", "ab"], ["", "a b", "ab"]),
        ("Nullable(String)", T.StringType(), [None, "a"], [None, "a"]),
        ("String", T.LongType(), [5, None], ["5", ""]),
        ("String", NTZ, [datetime(1999, 1, 1), datetime(2024, 1, 2, 3, 4, 5)], ["", "2024-01-02 03:04:05"]),
        (
            "Int64",
            T.StringType(),
            ["x", None, "2.7", "-2.7", "1e3", " 7 ", "2.9999999999", "9223372036854775807"],
            [0, 0, 2, -2, 1000, 7, 2, 9223372036854775807],
        ),
        ("Int64", T.DoubleType(), [float("nan"), 2.9, -2.9, float("inf"), None], [0, 2, -2, 0, 0]),
        ("Int8", T.LongType(), [5, 1000, None], [5, 0, 0]),
        ("Nullable(Int32)", T.StringType(), ["x", "3"], [None, 3]),
        ("Float64", T.StringType(), ["x", "1.23456789", None], [0.0, 1.234568, 0.0]),
        ("Float64", T.DoubleType(), [float("nan"), float("inf"), -float("inf"), 1.23456789], [0.0, 0.0, 0.0, 1.234568]),
        ("Nullable(Float64)", T.DoubleType(), [float("nan"), float("inf"), 0.5], [None, None, 0.5]),
        ("Boolean", T.BooleanType(), [None, True], [False, True]),
        ("Boolean", T.LongType(), [0, 2, None], [False, True, False]),
        ("Boolean", T.StringType(), ["true", "x", None, "0"], [True, False, False, False]),
        ("Enum8('a' = 1)", T.StringType(), [None, "a"], ["unknown", "a"]),
        ("UUID", T.StringType(), [None, "u"], ["unknown", "u"]),
        ("Date", T.StringType(), ["2024-02-30", "2024-02-29 10:00:00", "1999-12-31"], [None, datetime(2024, 2, 29).date(), None]),
        (
            "DateTime",
            NTZ,
            [datetime(1999, 12, 31, 23, 59, 59), datetime(2000, 1, 1), datetime(2025, 1, 2, 3, 4, 5, 678000), None],
            [None, datetime(2000, 1, 1), datetime(2025, 1, 2, 3, 4, 5), None],
        ),
        ("DateTime", T.StringType(), ["1900-01-01", "bad", "2025-01-02 03:04:05.9"], [None, None, datetime(2025, 1, 2, 3, 4, 5)]),
        (
            "DateTime",
            T.TimestampType(),
            [datetime(2025, 1, 2, 3, 4, 5, tzinfo=timezone.utc)],
            [datetime(2025, 1, 2, 3, 4, 5)],
        ),
        (
            "DateTime",
            T.DoubleType(),
            [1.7e18, float("nan"), 1e300, None, 5.0],
            [datetime(2023, 11, 14, 22, 13, 20), None, None, None, None],
        ),
        ("DateTime", T.LongType(), [1_700_000_000_000_000_000, 2**63 - 1], [datetime(2023, 11, 14, 22, 13, 20), datetime(2262, 4, 11, 23, 47, 16)]),
        ("Nullable(DateTime)", T.StringType(), ["bad", "2025-01-02"], [None, datetime(2025, 1, 2)]),
        ("Decimal(32,16)", T.StringType(), ["1.5", None, "x"], [Decimal("1.5"), Decimal(0), Decimal(0)]),
        ("Decimal(32,16)", T.DecimalType(10, 2), [Decimal("1.50")], [Decimal("1.5")]),
    ],
)
def test_coercion(spark, declared, source, values, expected):
    assert conformed(spark, values, source, declared) == expected


def test_zoned_time_is_read_in_utc_whatever_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        moment = datetime(2025, 3, 9, 7, 30, tzinfo=timezone.utc)
        assert conformed(spark, [moment], T.TimestampType(), "DateTime") == [datetime(2025, 3, 9, 7, 30)]
        # a wall-clock time that does not exist in this zone must survive
        gap = datetime(2025, 3, 9, 2, 30, 1, 5)
        assert conformed(spark, [gap], NTZ, "DateTime") == [datetime(2025, 3, 9, 2, 30, 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_missing_date_can_become_the_epoch(spark):
    assert conformed(spark, [None], NTZ, "DateTime", null_date="epoch") == [datetime(1970, 1, 1)]


def test_columns_are_dropped_added_and_ordered(spark):
    c = contract(
        column("loaded", "DateTime", "now()"),
        column("day", "DateTime", "today()"),
        column("two", "Int32", "1+1"),
        column("bad", "Int32", "nonsense()"),
        column("bad_optional", "Nullable(Int32)", "1/0"),
        column("text", "String", "abc"),
        column("n", "Int64"),
        column("n_optional", "Nullable(Int64)"),
        column("s", "String"),
        column("kept", "String"),
    )
    df = spark.createDataFrame([("k", 1, "gone")], "kept string, id long, extra string")
    assert extra_columns(df, c) == ["extra"]
    assert "loaded" in missing_columns(df, c)
    out = conform(df, c, AS_OF)
    assert out.columns == c.schema.names
    assert [f.dataType for f in out.schema] == [f.dataType for f in c.schema]
    assert tuple(out.first()) == (1, AS_OF, None, 2, 0, None, "abc", 0, None, "", "k")


def test_conform_is_one_projection_and_prunes_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    c = TableContract("o", T.StructType([column("o_orderkey", "Int64")]), "o_orderkey", None, None, None, None)
    plan = conform(df, c)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan
    assert "Exchange" not in plan


def test_declared_types():
    assert column("a", "Nullable(UInt64)").nullable
    assert column("a", "UInt64").dataType == T.LongType()
    assert column("a", "Decimal(32, 16)").dataType == T.DecimalType(32, 16)
    assert declared_type(T.StructField("a", T.DecimalType(32, 16))) == "Decimal(32,16)"
    assert integer_bounds(column("a", "UInt8")) == (0, 255)
    assert integer_bounds(column("a", "UInt64")) == (0, 2**63 - 1)
    assert integer_bounds(column("a", "Int16")) == (-32768, 32767)
    assert integer_bounds(column("a", "String")) is None
    with pytest.raises(ValueError):
        column("a", "Map(String, String)")


def test_default_primary_key():
    assert default_primary_key(["a", "RECID"]) == "RECID"
    assert default_primary_key(["a", "b"]) == "a"
    with pytest.raises(ValueError):
        default_primary_key([])


LINK = [
    ("INVENTTRANSORIGIN", "UInt64", "", ""),
    ("SALESID", "String", "", ""),
    ("CREATEDDATETIME", "DateTime", "", ""),
    ("RECID", "UInt64", "", ""),
    ("last_synced_at", "DateTime", "", ""),
    ("updated_at", "DateTime", "DEFAULT", "now()"),
]


def test_retail_contract_takes_keys_from_the_fixed_values():
    c = retail_contract("vtasalestable", LINK)
    assert (c.primary_key, c.date_column, c.modified_column) == ("RECID", "CREATEDDATETIME", None)
    assert c.key == ["RECID", "CREATEDDATETIME"]
    assert c.but(scope="primary_key").key == ["RECID"]
    assert len(RETAIL_DATE_COLUMNS) == 11
    with pytest.raises(ValueError):
        retail_contract("custtable", LINK)  # lacks its modification time
    assert landed_path("gs://lake/", "salesline") == "gs://lake/raw/SALESLINE.parquet"
    assert landed_path("gs://lake", "retailtransactiondiscounttrans").endswith("/RETAILTRANSACTIONDISCOUNTTR.parquet")


def test_contract_rejects_undeclared_columns():
    with pytest.raises(ValueError):
        contract_from_description("t", LINK, date_column="NOPE")


def test_contract_from_a_catalog_table(spark):
    spark.sql("CREATE TABLE contract_source (RECID BIGINT, d TIMESTAMP_NTZ, n INT DEFAULT 1 + 1) USING parquet")
    try:
        c = contract_from_table(spark, "contract_source", date_column="d")
        assert c.primary_key == "RECID"
        out = conform(spark.createDataFrame([("7",)], "RECID string"), c, AS_OF)
        assert tuple(out.first()) == (7, None, 2)
    finally:
        spark.sql("DROP TABLE contract_source")


@pytest.mark.parametrize(
    ("declared", "source", "values", "expected"),
    [
        ("UInt64", T.StringType(), ["0", "5", "-1", "x", "2.7", None], [True, True, False, False, False, False]),
        ("Int64", T.StringType(), ["-1", "5", "x", None], [True, True, False, False]),
        ("Float64", T.StringType(), ["1.5", "x"], [True, False]),
        ("String", T.StringType(), ["anything", None], [True, True]),
        ("DateTime", T.StringType(), ["2024-01-01"], [False]),
        ("UInt64", T.LongType(), [0, -1, None], [True, False, False]),
        ("UInt64", T.DoubleType(), [5.0, 5.5, None], [True, False, False]),
    ],
)
def test_primary_key_validity(spark, declared, source, values, expected):
    schema = T.StructType([T.StructField("pos", T.LongType()), T.StructField("k", source)])
    df = spark.createDataFrame(list(enumerate(values)), schema)
    valid = quality.valid_key(F.col("k"), source, column("k", declared))
    assert [r["v"] for r in df.select("pos", valid.alias("v")).orderBy("pos").collect()] == expected


def test_values_that_do_not_fit_are_rejected_not_wrapped(spark):
    c = contract(column("big", "UInt64"), column("small", "UInt8"))
    rows = [
        ("1", "18446744073709551615", 1),
        ("2", "5", 300),
        ("3", "5", -1),
        ("4", "x", 255),
        ("x", "5", 1),
        ("6", "inf", 1),
        ("99999999999999999999", "5", 1),
    ]
    df = spark.createDataFrame(rows, "id string, big string, small long")
    accepted, rejected = quality.split_rejects(df, c)
    reasons = {r["id"]: r[quality.REASON] for r in rejected.collect()}
    assert reasons == {
        "1": "value out of range: big",
        "2": "value out of range: small",
        "3": "value out of range: small",
        "x": "invalid primary key",
        "99999999999999999999": "value out of range: id",
    }
    assert sorted(r["id"] for r in accepted.collect()) == ["4", "6"]


def test_missing_key_column_rejects_everything(spark):
    accepted, rejected = quality.split_rejects(spark.range(3).toDF("other"), contract())
    assert (accepted.count(), rejected.count()) == (0, 3)


def test_drift_report(spark):
    df = spark.createDataFrame(
        [("Alice", 25, "X", "C", "a@x"), ("Bob", 30, None, "C", "b@x")],
        "Name string, Age int, Country string, City string, Email string",
    )
    schema = T.StructType([column("Name", "String"), column("Age", "Int32"), column("City", "String")])
    c = TableContract("p", schema, "Name", None, None, None, None)
    assert sorted(tuple(r) for r in quality.drift_report(df, c).collect()) == [
        ("Country", "Age", "City", 1),
        ("Email", "City", None, 2),
    ]
    first = df.select("Email", "Name", "Age", "City")
    assert tuple(quality.drift_report(first, c).first()) == ("Email", None, "Name", 2)
    assert quality.drift_report(df.select("Name", "Age", "City"), c).count() == 0


def test_coercion_loss(spark):
    c = contract(column("n", "Int64"), column("d", "DateTime"))
    df = spark.createDataFrame(
        [(1, "5", "2024-01-01"), (2, "x", "1999-01-01"), (3, None, "bad")], "id long, n string, d string"
    )
    rows = {r["column_name"]: tuple(r)[2:] for r in quality.coercion_loss(df, c).collect()}
    assert rows == {"id": (3, 0, 0, 0), "n": (3, 1, 1, 0), "d": (3, 0, 1, 1)}

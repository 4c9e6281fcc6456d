"""Extract bounds, latest versions, changes, skewed joins and lineage on small frames."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakeload.operators import incremental as inc
from lakeload.operators import skew, versioned
from lakeload.operators.lineage import return_lineage
from lakeload.plans.samples import return_links

D = datetime


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


@pytest.fixture
def changes(spark):
    stamps = ["2025-02-28 10:00:00", "2025-02-28 10:00:01", "2025-03-31 10:00:00", "2025-04-01 00:00:00", None]
    df = spark.createDataFrame(list(enumerate(stamps)), "id long, ts string")
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


WATERMARK = D(2025, 3, 31, 10, 0, 0)


def test_daily_bound_is_inclusive(changes):
    assert rows(inc.incremental_extract(changes, "ts", WATERMARK), "id") == [(2,), (3,)]
    assert inc.incremental_extract(changes, "ts", None).count() == 5
    assert inc.incremental_extract(changes, "absent", WATERMARK).count() == 0


def test_monthly_bound_is_strict_and_calendar(changes):
    assert rows(inc.lookback_extract(changes, "ts", WATERMARK), "id") == [(1,), (2,), (3,)]
    with pytest.raises(ValueError):
        inc.lookback_extract(changes, "ts", None)


def test_extract_reads_text_times(changes):
    text = changes.withColumn("ts", F.coalesce(F.col("ts").cast("string"), F.lit("bad")))
    assert rows(inc.incremental_extract(text, "ts", WATERMARK), "id") == [(2,), (3,)]


def test_bounds_and_watermarks(spark, changes):
    bounds = inc.batch_bounds(changes, "ts").first()
    assert tuple(bounds) == (D(2025, 2, 28, 10), D(2025, 4, 1), 5)
    assert inc.read_watermark(changes, "ts") == D(2025, 4, 1)
    assert inc.read_watermark(changes.where("false"), "ts") is None
    assert [r["id"] for r in inc.by_modified(changes, "ts").collect()] == [0, 1, 2, 3, 4]
    assert inc.has_rows(changes) and not inc.has_rows(changes.where("false"))


def test_extract_filters_reach_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    for df in (
        inc.incremental_extract(events, "ts", "2024-01-15"),
        inc.lookback_extract(events, "ts", "2024-01-15"),
        inc.date_between(events, "ts", "2024-01-15", "2024-01-16"),
        versioned.retain(events, "ts", "2029-01-15"),
    ):
        pushed = plan_of(df).split("PushedFilters: [")[1]
        assert "2024-01-1" in pushed or "2023-12-15" in pushed


def test_latest_version(spark):
    data = [
        (1, "2025-01-05", 10, 1, "old"),
        (1, "2025-01-05", 20, 1, "new"),
        (2, "2025-01-05", 10, 1, "early"),
        (2, "2025-01-05", 10, 2, "late"),
        (3, "2025-01-05", None, 9, "null version"),
        (3, "2025-01-05", 1, 1, "versioned"),
        (1, "2025-02-05", 5, 1, "other month"),
    ]
    df = spark.createDataFrame(data, "k long, d string, v long, m long, t string")
    by_date = versioned.latest_version(df, ["k", "d"], ["v", "m"])
    assert rows(by_date, "t") == [("late",), ("new",), ("other month",), ("versioned",)]
    by_key = versioned.latest_version(df, ["k"], ["v", "m"])
    assert rows(by_key, "t") == [("late",), ("new",), ("versioned",)]


def test_latest_version_is_independent_of_partitioning(spark):
    df = spark.range(2000).select((F.col("id") % 7).alias("k"), F.lit(1).alias("v"), F.col("id").alias("x"))
    picks = {tuple(rows(versioned.latest_version(df.repartition(n), ["k"], ["v"]))) for n in (1, 3, 8)}
    assert len(picks) == 1


def test_latest_version_prunes_before_the_shuffle(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = plan_of(versioned.latest_version(df, ["l_orderkey"], ["l_shipdate"]))
    assert plan.count("Exchange") == 1
    assert plan.index("Exchange") < plan.index("Partial")  # the partial limit sits below the exchange


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, 10, "a"), (2, 10, "b"), (3, 10, "c"), (4, None, "d")], "k long, ts long, x string")


@pytest.fixture
def batch(spark):
    data = [(1, 11, "A"), (2, 10, "B"), (3, 9, "C"), (4, 5, "D"), (5, 1, "E"), (5, 2, "EE"), (6, None, "F")]
    return spark.createDataFrame(data, "k long, ts long, x string")


def test_classify_changes(target, batch):
    got = dict(rows(versioned.classify_changes(batch, target, "k", "ts"), "x", "change"))
    assert got == {
        "A": "updated",
        "B": "unchanged",
        "C": "unchanged",
        "D": "updated",
        "E": "new",
        "EE": "new",
        "F": "new",
    }


def test_changes_against_one_row_per_key_need_no_job_ahead(spark, target, batch):
    context = spark.sparkContext
    context.setJobGroup("ahead", "")
    changes = versioned.classify_changes(batch, target, "k", "ts", unique=True)
    hashed = versioned.changes_by_hash(batch, target, "k", unique=True)
    started = context.statusTracker().getJobIdsForGroup("ahead")
    context.setLocalProperty("spark.jobGroup.id", None)
    assert list(started) == []
    assert rows(changes) == rows(versioned.classify_changes(batch, target, "k", "ts"))
    assert rows(hashed) == rows(versioned.changes_by_hash(batch, target, "k"))


def test_classify_against_nothing_is_all_new(target, batch):
    got = versioned.classify_changes(batch, target.where("false"), "k", "ts")
    assert {r["change"] for r in got.collect()} == {"new"}


def test_classify_looks_back_a_limited_time(spark):
    old = spark.createDataFrame([(1, "2025-01-01"), (2, "2025-01-20")], "k long, ts string")
    old = old.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = versioned.classify_changes(old, old, "k", "ts", "2025-01-25", lookback_days=15)
    assert rows(got, "k", "change") == [(1, "new"), (2, "unchanged")]
    with pytest.raises(ValueError):
        versioned.classify_changes(old, old, "k", "ts", lookback_days=15)


def test_upsert(target, batch):
    got = versioned.upsert(target, batch, ["k"], "ts")
    assert rows(got) == [(1, 11, "A"), (2, 10, "b"), (3, 10, "c"), (4, 5, "D"), (5, 2, "EE"), (6, None, "F")]
    assert rows(versioned.upsert(got, batch, ["k"], "ts")) == rows(got)


def test_changes_by_hash(spark):
    old = spark.createDataFrame([(1, None, 1), (2, 1, 2), (3, 3, 3)], "k long, a int, b int")
    new = spark.createDataFrame([(1, 1, None), (2, 1, 2), (3, 3, 4), (4, 4, 4)], "k long, a int, b int")
    got = versioned.changes_by_hash(new, old, "k")
    assert rows(got, "k", "change") == [(1, "changed"), (2, "same"), (3, "changed"), (4, "new")]


def test_key_lookup_ignores_repeated_keys(spark, target):
    keys = spark.createDataFrame([(1,), (1,), (9,)], "k long")
    assert rows(versioned.key_lookup(target, keys, ["k"]), "x") == [("a",)]


def test_mark_synced_cuts_bounds_to_the_second(spark):
    df = spark.createDataFrame([("2025-01-01 00:00:01",), ("2025-01-01 00:00:05",), (None,)], "ts string")
    df = df.withColumn("ts", F.col("ts").cast("timestamp_ntz")).withColumn("s", F.lit(None).cast("timestamp_ntz"))
    got = versioned.mark_synced(df, "s", "2025-02-01", "ts", D(2025, 1, 1, 0, 0, 1, 500000), D(2025, 1, 1, 0, 0, 4))
    assert [r["s"] for r in got.orderBy(F.asc_nulls_last("ts")).collect()] == [D(2025, 2, 1), None, None]


def test_delete_keeps_rows_where_the_condition_is_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    assert rows(versioned.delete_where(df, "x = 'a'")) == [("b",), (None,)]
    for empty in (None, "", "  "):
        with pytest.raises(ValueError):
            versioned.delete_where(df, empty)


@pytest.mark.parametrize("as_of", ["2025-02-28", "2025-02-28 00:00:01", "2025-03-01", "2024-02-29", "2024-12-31"])
def test_retention_matches_the_exact_rule(spark, as_of):
    days = spark.sql("SELECT explode(sequence(DATE'2019-01-01', DATE'2020-12-31')) AS d")
    days = days.select(F.col("d").cast("timestamp_ntz").alias("d")).unionByName(
        spark.createDataFrame([(None,)], "d timestamp_ntz")
    )
    exact = days.where(f"d IS NULL OR d + INTERVAL 5 YEAR > TIMESTAMP_NTZ'{as_of}'")
    assert rows(versioned.retain(days, "d", as_of)) == rows(exact)
    assert rows(versioned.retain(versioned.with_month(days, "d"), "d", as_of), "d") == rows(exact)


# joins with a hot key


@pytest.fixture
def skewed(spark):
    """A third of 9,000 rows on one key, half of those exact copies; the rest spread."""
    rng = random.Random(7)
    data = [(1, 5)] * 1500 + [(1, i) for i in range(1500)] + [(rng.randint(2, 3000), i) for i in range(6000)]
    return spark.createDataFrame(data, "k int, ts long").repartition(6)


def test_hot_keys_are_found(spark, skewed):
    found, spread = skew.hot_keys(skewed, ["k"], ["k", "ts"])
    expected = spark.createDataFrame([(1,)], "k int").select(F.xxhash64("k")).first()[0]
    assert found == {expected: 8}  # a third of the rows is 2.7 of 8 tasks
    assert len(spread) == 1  # the exact copies
    assert skew.hot_keys(skewed.where("false"), ["k"]) == [{}]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_gives_the_plain_result(spark, skewed, how):
    right = spark.range(0, 3000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("y"))  # bigint key
    right = right.unionByName(spark.createDataFrame([(1, -1)], "k long, y long"))
    got = skew.lookup_join(skewed, right, ["k"], how)
    plain = skewed.join(right, "k", how)
    assert Counter(map(tuple, got.select("k", "ts", "y").collect())) == Counter(
        map(tuple, plain.select("k", "ts", "y").collect())
    )


def test_lookup_join_spreads_the_hot_key(spark, skewed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        right = skewed.groupBy("k").agg(F.max("ts").alias("y"))
        joined = skew.lookup_join(skewed, right, ["k"], "left")
        sizes = joined.where("k = 1").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in sizes) == 3000
    assert max(r["count"] for r in sizes) < 1800


def test_classify_with_a_hot_key(skewed):
    target = skewed.where("ts < 700")
    known = {}
    for r in target.collect():
        known[r["k"]] = max(known.get(r["k"], -1), r["ts"])

    def expected(r):
        return "new" if r["k"] not in known else "updated" if r["ts"] > known[r["k"]] else "unchanged"

    got = versioned.classify_changes(skewed, target, "k", "ts")
    assert Counter(map(tuple, got.collect())) == Counter((r["k"], r["ts"], expected(r)) for r in skewed.collect())


# lineage


def lineage_tables(spark, link, moves, origins, headers):
    return (
        spark.createDataFrame(link, "SALESID string, SALESIDRETURN string, INVENTTRANSORIGIN long, RETURNINVENTTRANSORIGIN long"),
        spark.createDataFrame(moves, "INVENTTRANSORIGIN long, RETURNINVENTTRANSORIGIN long"),
        spark.createDataFrame(origins, "RECID long, INVENTTRANSID string, REFERENCEID string"),
        spark.createDataFrame(
            headers,
            "SALESORDERID string, TRANSACTIONID string, TRANSDATE date, STATEMENTID string, RETURNTRANSACTIONID string",
        ),
    )


def test_return_lineage(spark):
    day = D.fromisoformat
    link = [("SO-1", "ST-9", 100, 999), ("SO-3", "ST-7", 300, 400), ("SO-1", "ST-9", 100, 999)]
    moves = [(100, 200), (300, 400), (100, 200), (500, 600)]
    origins = [
        (100, "L-1", "SO-1"),
        (200, "L-2", "SO-2"),
        (300, "L-3", "SO-3"),
        (400, "L-4", "SO-4"),
        (500, "L-5", "SO-5"),
        (600, "L-6", ""),
    ]
    headers = [
        ("SO-1", "T-1", day("2025-01-10"), "ST-8", None),
        ("SO-2", "T-2", day("2025-01-13"), "ST-9", "T-1"),
        ("SO-3", "T-3", day("2025-01-14"), "ST-8", None),
        ("SO-4", "T-4", day("2025-01-15"), "ST-0", "T-1"),
        ("SO-5", "T-5", day("2025-01-16"), "ST-5", None),
        ("", "T-6", day("2025-01-16"), "ST-6", None),
        ("", "T-7", day("2025-01-16"), "ST-6", None),
    ]
    got = return_lineage(*lineage_tables(spark, link, moves, origins, headers))
    assert rows(
        got,
        "sale_order",
        "sale_transaction",
        F.col("sale_date").cast("string"),
        "return_order",
        "return_transaction",
        F.col("return_date").cast("string"),
        "names_sale",
        "statement_matches",
    ) == [
        ("SO-1", "T-1", "2025-01-10", "SO-2", "T-2", "2025-01-13", True, True),
        ("SO-3", "T-3", "2025-01-14", "SO-4", "T-4", "2025-01-15", False, False),
    ]


def test_return_names_one_of_two_sales(spark):
    day = D.fromisoformat
    link, moves = [("SO-1", "ST-9", 100, 200)], [(100, 200)]
    origins = [(100, "L-1", "SO-1"), (200, "L-2", "SO-2")]
    headers = [
        ("SO-1", "T-1", day("2025-01-10"), "ST-8", None),
        ("SO-1", "T-1b", day("2025-01-12"), "ST-8", None),
        ("SO-2", "T-2", day("2025-01-13"), "ST-9", "T-1"),
        ("SO-2", "T-2b", day("2025-01-14"), "ST-7", "T-0"),
        ("SO-2", "T-2c", day("2025-01-15"), "ST-9", None),
    ]
    got = return_lineage(*lineage_tables(spark, link, moves, origins, headers))
    assert rows(got, "return_transaction", "sale_transaction", F.col("sale_date").cast("string"), "names_sale", "statement_matches") == [
        ("T-2", "T-1", "2025-01-10", True, True),
        ("T-2b", "T-1b", "2025-01-12", False, False),
        ("T-2c", "T-1b", "2025-01-12", False, True),
    ]


def test_return_links_are_the_latest_earlier_sales(spark):
    rng = random.Random(5)
    lines = [(rng.randint(1, 2), 1, rng.randint(1, 12), n, rng.choice("NNRA"), D(2025, 1, rng.randint(1, 9))) for n in range(200)]
    df = spark.createDataFrame(lines, "l_partkey long, l_suppkey long, l_orderkey long, l_linenumber long, l_returnflag string, l_shipdate timestamp_ntz")
    expected = []
    for part, _, order, n, flag, at in lines:
        sales = [(x[5], x[2], x[2] * 10 + x[3]) for x in lines if x[0] == part and x[4] == "N" and x[5] < at and x[2] != order]
        if flag == "R" and sales:
            expected.append((max(sales)[2], order * 10 + n))
    got = rows(return_links(df), F.col("sale.id"), F.col("ret.id"))
    assert got == sorted(expected, key=repr) and len(got) > 20


def test_return_lineage_against_brute_force_with_hot_keys(spark):
    """A third of the moves share one sale origin and a third of the origins one order."""
    rng = random.Random(11)
    origins = [(i, f"L{i}", "SO-0" if i % 3 == 0 else f"SO-{rng.randint(1, 60)}") for i in range(1500)]
    moves = list({(0 if rng.random() < 0.34 else rng.randrange(1600), rng.randrange(1600)) for _ in range(1500)})
    link = [("", f"ST-{rng.randint(0, 5)}", 0 if rng.random() < 0.34 else rng.randrange(1600), None) for _ in range(900)]
    headers = [
        (f"SO-{i}", f"T-{i}-{j}", D(2025, 1, 1 + j), f"ST-{(i + j) % 6}", f"T-{rng.randint(0, 60)}-1")
        for i in range(50)
        for j in range(1 + i % 2)
    ]
    of_order: dict[str, list] = {}
    for h in headers:
        of_order.setdefault(h[0], []).append(h)
    order = {o[0]: o[2] for o in origins}
    linked, listed = {x[2] for x in link}, {(x[2], x[1]) for x in link}
    expected = []
    for sale, ret in moves:
        sales, returns = of_order.get(order.get(sale)), of_order.get(order.get(ret))
        for r in returns or [] if sale in linked and sales else []:
            named = [h for h in sales if h[1] == r[4]]
            s = named[0] if named else max(sales, key=lambda h: h[2])
            expected.append((sale, ret, s[0], s[1], r[0], r[1], bool(named), (sale, r[3]) in listed))
    got = return_lineage(*lineage_tables(spark, link, moves, origins, headers))
    names = ["sale_origin", "return_origin", "sale_order", "sale_transaction", "return_order", "return_transaction"]
    assert expected
    assert rows(got, *names, "names_sale", "statement_matches") == sorted(expected, key=repr)

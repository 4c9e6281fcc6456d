"""For each registered query the SQL that gives the same rows on the same tables."""

from __future__ import annotations

_EVENT_COLUMNS = "event_id, date_trunc('second', ts) AS ts, user_id, event_type, round(value, 6) AS value, props"
_EVENT_MONTH = "CAST(year(ts) * 100 + month(ts) AS INTEGER) AS p_month"
_ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
_ORDER_MONTH = "CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS p_month"
_LINE_TIES = (
    "l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, "
    "l_returnflag DESC, l_linestatus DESC"
)
_FIRST = "TIMESTAMP '2024-03-01 06:00:00'"
_SECOND = "TIMESTAMP '2024-03-02 06:00:00'"

# the change batch, and the target it meets
_ORDER_CHANGES = """
    changes AS (
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS o_orderdate,
               o_orderpriority
        FROM orders),
    target AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')
"""

_LOADED_EVENTS = f"""
    SELECT {_EVENT_COLUMNS},
           (SELECT date_trunc('second', max(ts)) FROM events) AS last_synced_at,
           {_FIRST} AS updated_at, {_EVENT_MONTH}
    FROM events
"""

_DAILY_EVENTS = f"""
    WITH bounds AS (
        SELECT date_trunc('second', max(ts) FILTER (ts < TIMESTAMP '2024-01-15')) AS first_mark,
               date_trunc('second', max(ts)) AS second_mark FROM events)
    SELECT {_EVENT_COLUMNS},
           CASE WHEN date_trunc('second', events.ts) >= first_mark THEN second_mark ELSE first_mark END
               AS last_synced_at,
           CASE WHEN events.ts >= first_mark THEN {_SECOND} ELSE {_FIRST} END AS updated_at
    FROM events, bounds
"""

ORACLE: dict[str, str] = {
    "scan_parquet": "SELECT * FROM customer",
    "scan_csv": "SELECT * FROM orders",
    "scan_json": "SELECT * FROM events",
    "snapshot_write": "SELECT * FROM customer",
    "append_union": "SELECT * FROM events",
    "union_same_schema": "SELECT * FROM events",
    "typed_insert": f"""
        SELECT {_ORDER_COLUMNS}, CAST(NULL AS TIMESTAMP) AS last_synced_at, {_FIRST} AS updated_at, {_ORDER_MONTH}
        FROM orders""",
    "date_range_scan": """
        SELECT * FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-01-31'""",
    "pruned_range_scan": f"""
        SELECT o_orderkey, o_orderdate, {_ORDER_MONTH} FROM orders
        WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-15' AND DATE '1997-03-14'""",
    "table_contract": """
        SELECT CAST(v.position AS INTEGER) AS position, v.column_name, v.declared, false AS nullable, v.default_text,
               v.n_values
        FROM (SELECT count(event_id) AS a, count(ts) AS b, count(user_id) AS c, count(event_type) AS d,
                     count(value) AS e, count(props) AS f FROM events) n,
        LATERAL (VALUES (1, 'event_id', 'UInt64', NULL, n.a), (2, 'ts', 'DateTime', NULL, n.b),
                        (3, 'user_id', 'Int64', NULL, n.c), (4, 'event_type', 'String', NULL, n.d),
                        (5, 'value', 'Float64', NULL, n.e), (6, 'props', 'String', NULL, n.f),
                        (7, 'last_synced_at', 'DateTime', NULL, 0), (8, 'updated_at', 'DateTime', 'now()', 0))
             v(position, column_name, declared, default_text, n_values)""",
    "incremental_extract": "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-15'",
    "lookback_extract": "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '2001-03-31' - INTERVAL 1 MONTH",
    "batch_bounds": """
        SELECT min(ts) AS modified_min, max(ts) AS modified_max, count(*) AS n_rows
        FROM events WHERE ts >= TIMESTAMP '2024-01-15'""",
    "skip_path": """
        SELECT min(ts) AS modified_min, max(ts) AS modified_max, count(*) AS n_rows
        FROM events WHERE ts >= TIMESTAMP '2024-02-15'""",
    "watermark": """
        SELECT max(CASE WHEN ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20'
                        THEN TIMESTAMP '2024-02-01' END) AS high_water FROM events""",
    "high_water": "SELECT max(ts) AS high_water FROM events",
    "point_lookup": "SELECT * FROM orders WHERE o_orderkey = 7",
    "preview": "SELECT * FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 3",
    "sorted_by_modified": "SELECT * FROM events ORDER BY ts NULLS LAST",
    "conform_orders": f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice,
               CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN o_orderdate END AS o_orderdate,
               o_orderpriority, CAST(NULL AS TIMESTAMP) AS last_synced_at, {_FIRST} AS updated_at
        FROM orders""",
    "coerce_numeric": """
        SELECT p_partkey, CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT) AS brand_digits,
               CAST(0 AS INTEGER) AS brand_raw, round(p_retailprice, 6) AS price_text,
               CAST(trunc(p_retailprice) AS BIGINT) AS price_cut, CAST(0 AS DOUBLE) AS price_raw,
               CASE WHEN p_size <= 25 THEN round(p_retailprice / 3, 6) END AS price_optional,
               CASE WHEN p_size <= 25 THEN CAST(p_size AS VARCHAR) END AS size_optional
        FROM part""",
    "conform_types": f"""
        SELECT event_id, floor(value / 100) <> 0 AS big, event_type = 'click' AS flag_text,
               CASE WHEN event_type = 'error' THEN 'unknown' ELSE event_type END AS kind,
               CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS maybe_text,
               CASE WHEN event_type <> 'error' THEN event_type END AS optional_text,
               CAST(CAST(ts AS DATE) AS VARCHAR) AS seen_day, date_trunc('second', ts) AS seen_text,
               CASE WHEN event_type = 'click' THEN date_trunc('second', ts) END AS seen_bad,
               TIMESTAMP '2023-11-14 22:13:20' + to_seconds(event_id) AS seen_nanos,
               value AS amount, {_FIRST} AS loaded_at, CAST(2 AS INTEGER) AS two, 'none' AS label,
               CAST(0 AS BIGINT) AS unset_number, CAST(NULL AS VARCHAR) AS unset_optional, '' AS unset_text,
               CAST(NULL AS TIMESTAMP) AS unset_time
        FROM events""",
    "clean_text": "SELECT doc_id, replace(text, chr(10), ' ') AS text FROM documents",
    "scalar_functions": f"""
        SELECT event_id, ts - INTERVAL 1 MONTH AS month_back, ts - INTERVAL 15 DAY AS days_back,
               ts + INTERVAL 5 YEAR AS expires, CAST(year(ts) * 100 + month(ts) AS INTEGER) AS month,
               CAST(CAST(ts AS DATE) AS VARCHAR) AS day, date_trunc('second', ts) AS second,
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS second_text,
               strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS local_text,
               date_trunc('second', ts) AS parsed, CAST(NULL AS TIMESTAMP) AS not_parsed,
               round(value / 7, 6) AS six_decimals, CAST(trunc(value) AS INTEGER) AS whole,
               event_type || ' ' || props AS one_line, event_type AS unquoted
        FROM events""",
    "pk_split": """
        SELECT CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) AS account, c_custkey,
               CASE WHEN c_acctbal < 0 THEN 'invalid primary key' END AS reject_reason
        FROM customer""",
    "drift_report": """
        SELECT 'l_tax' AS missing_column, 'l_discount' AS prev_column, 'l_returnflag' AS next_column,
               count(l_tax) AS dropped_values FROM lineitem
        UNION ALL
        SELECT 'l_shipdate', 'l_linestatus', NULL, count(l_shipdate) FROM lineitem""",
    "coercion_loss": """
        SELECT 'part' AS table_name, v.column_name, v.declared, n.n AS n_rows, v.null_rows, v.failed_casts,
               v.sentinel_dates
        FROM (SELECT count(*) AS n, count(*) FILTER (p_partkey IS NULL) AS a, count(*) FILTER (p_name IS NULL) AS b,
                     count(*) FILTER (p_brand IS NULL) AS c,
                     count(*) FILTER (p_brand IS NOT NULL AND TRY_CAST(p_brand AS BIGINT) IS NULL) AS c2,
                     count(*) FILTER (p_retailprice IS NULL) AS d FROM part) n,
        LATERAL (VALUES ('p_partkey', 'UInt32', n.a, 0, 0), ('p_name', 'String', n.b, 0, 0),
                        ('p_brand', 'Int64', n.c, n.c2, 0), ('p_retailprice', 'Float64', n.d, 0, 0))
             v(column_name, declared, null_rows, failed_casts, sentinel_dates)
        UNION ALL
        SELECT 'orders', v.column_name, v.declared, n.n, v.null_rows, 0, v.sentinel_dates
        FROM (SELECT count(*) AS n, count(*) FILTER (o_orderkey IS NULL) AS a,
                     count(*) FILTER (o_custkey IS NULL) AS b, count(*) FILTER (o_orderstatus IS NULL) AS c,
                     count(*) FILTER (o_totalprice IS NULL) AS d, count(*) FILTER (o_orderdate IS NULL) AS e,
                     count(*) FILTER (o_orderdate < TIMESTAMP '2000-01-01') AS e2,
                     count(*) FILTER (o_orderpriority IS NULL) AS f FROM orders) n,
        LATERAL (VALUES ('o_orderkey', 'UInt64', n.a, 0), ('o_custkey', 'Int64', n.b, 0),
                        ('o_orderstatus', 'String', n.c, 0), ('o_totalprice', 'Float64', n.d, 0),
                        ('o_orderdate', 'DateTime', n.e, n.e2), ('o_orderpriority', 'String', n.f, 0))
             v(column_name, declared, null_rows, sentinel_dates)""",
    "latest_lineitem": f"""
        SELECT * FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, {_LINE_TIES}) = 1""",
    "latest_lineitem_by_month": f"""
        SELECT *, CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS p_month FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY p_month, l_orderkey, l_linenumber
                                   ORDER BY l_shipdate DESC, {_LINE_TIES}) = 1""",
    "month_buckets": f"SELECT {_ORDER_MONTH}, count(*) AS n_rows FROM orders GROUP BY 1",
    "classify_changes": f"""
        WITH {_ORDER_CHANGES}
        SELECT c.o_orderkey, c.o_orderdate,
               CASE WHEN t.o_orderkey IS NULL THEN 'new' WHEN c.o_orderdate > t.o_orderdate THEN 'updated'
                    ELSE 'unchanged' END AS change
        FROM changes c LEFT JOIN target t ON c.o_orderkey = t.o_orderkey""",
    "classify_recent": f"""
        WITH {_ORDER_CHANGES}
        SELECT c.o_orderkey, c.o_orderdate,
               CASE WHEN t.o_orderkey IS NULL THEN 'new' WHEN c.o_orderdate > t.o_orderdate THEN 'updated'
                    ELSE 'unchanged' END AS change
        FROM changes c
        LEFT JOIN (SELECT * FROM target WHERE o_orderdate >= TIMESTAMP '2000-01-01' - INTERVAL 15 DAY) t
               ON c.o_orderkey = t.o_orderkey""",
    "upsert_orders": f"""
        WITH {_ORDER_CHANGES},
        applied AS (
            SELECT c.* FROM changes c LEFT JOIN target t ON c.o_orderkey = t.o_orderkey
            WHERE t.o_orderkey IS NULL OR c.o_orderdate > t.o_orderdate)
        SELECT * FROM applied
        UNION ALL
        SELECT t.* FROM target t ANTI JOIN applied a ON t.o_orderkey = a.o_orderkey""",
    "row_hash_changes": f"""
        WITH {_ORDER_CHANGES}
        SELECT c.o_orderkey,
               CASE WHEN t.o_orderkey IS NULL THEN 'new'
                    WHEN (c.o_custkey, c.o_orderstatus, c.o_totalprice, c.o_orderdate, c.o_orderpriority)
                       = (t.o_custkey, t.o_orderstatus, t.o_totalprice, t.o_orderdate, t.o_orderpriority) THEN 'same'
                    ELSE 'changed' END AS change
        FROM changes c LEFT JOIN target t ON c.o_orderkey = t.o_orderkey""",
    "key_lookup": """
        SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
    "mark_synced": """
        SELECT *, CASE WHEN ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20'
                       THEN TIMESTAMP '2024-02-01' END AS last_synced_at FROM events""",
    "mark_all": "SELECT *, TIMESTAMP '2024-02-01' AS last_synced_at FROM events",
    "delete_where": "SELECT * FROM events WHERE NOT coalesce(event_type = 'error', false)",
    "retention": "SELECT * FROM lineitem WHERE l_shipdate + INTERVAL 5 YEAR > TIMESTAMP '2001-11-04'",
    "compact_table": f"""
        SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'C' ELSE o_orderstatus END AS o_orderstatus,
               o_totalprice, o_orderdate, o_orderpriority,
               CASE WHEN o_orderstatus = 'F' THEN {_SECOND} ELSE {_FIRST} END AS updated_at, {_ORDER_MONTH}
        FROM orders""",
    "upsert_table": f"""
        WITH {_ORDER_CHANGES},
        applied AS (
            SELECT c.* FROM changes c LEFT JOIN target t ON c.o_orderkey = t.o_orderkey
            WHERE t.o_orderkey IS NULL OR c.o_orderdate > t.o_orderdate)
        SELECT {_ORDER_COLUMNS}, {_SECOND} AS updated_at, {_ORDER_MONTH} FROM applied
        UNION ALL
        SELECT {_ORDER_COLUMNS}, {_FIRST} AS updated_at, {_ORDER_MONTH}
        FROM (SELECT t.* FROM target t ANTI JOIN applied a ON t.o_orderkey = a.o_orderkey)""",
    "moved_records": f"""
        SELECT {_ORDER_COLUMNS}, updated_at, {_ORDER_MONTH}
        FROM (SELECT * REPLACE (CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 40 DAY
                                     ELSE o_orderdate END AS o_orderdate),
                     CASE WHEN o_orderstatus = 'F' THEN {_SECOND} ELSE {_FIRST} END AS updated_at
              FROM orders)""",
    "table_delete": f"""
        SELECT o_orderkey, o_orderstatus, o_orderdate, {_ORDER_MONTH} FROM orders
        WHERE NOT (o_orderdate < TIMESTAMP '1996-01-01' OR o_orderstatus = 'P')""",
    "table_retention": f"""
        SELECT o_orderkey, o_orderdate, {_ORDER_MONTH} FROM orders
        WHERE o_orderdate + INTERVAL 5 YEAR > TIMESTAMP '2003-06-15'""",
    "table_mark": """
        SELECT o_orderkey, o_orderdate,
               CASE WHEN o_orderdate BETWEEN TIMESTAMP '2001-06-01' AND TIMESTAMP '2001-07-15'
                    THEN TIMESTAMP '2001-09-01' END AS last_synced_at
        FROM orders""",
    "load_events": _LOADED_EVENTS,
    "stream_load": _LOADED_EVENTS,
    "daily_load": f"SELECT *, {_EVENT_MONTH} FROM ({_DAILY_EVENTS})",
    "deferred_load": _DAILY_EVENTS,
    "monthly_load": f"""
        WITH bounds AS (SELECT max(o_orderdate) AS mark FROM orders)
        SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice,
               CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN o_orderdate END AS o_orderdate, o_orderpriority,
               CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN mark END AS last_synced_at,
               CASE WHEN o_orderdate > mark - INTERVAL 1 MONTH THEN {_SECOND} ELSE {_FIRST} END AS updated_at,
               CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01'
                    THEN CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) ELSE 0 END AS p_month
        FROM orders, bounds""",
    "load_audit": """
        WITH n AS (
            SELECT count(*) AS read, count(*) FILTER (event_type = 'error') AS bad,
                   date_trunc('second', min(ts) FILTER (event_type <> 'error')) AS lo,
                   date_trunc('second', max(ts) FILTER (event_type <> 'error')) AS hi
            FROM events)
        SELECT 'first' AS run_id, 'events' AS table_name, 'daily' AS mode, 'loaded' AS status, lo AS modified_min,
               hi AS modified_max, hi AS synced_at, read AS rows_read, bad AS rows_rejected,
               read - bad AS rows_accepted, read - bad AS rows_in_months, 'origin' AS dropped_columns,
               'last_synced_at,updated_at' AS added_columns FROM n
        UNION ALL
        SELECT 'second', 'events', 'daily', 'skipped', NULL, NULL, NULL, 0, 0, 0, 0, 'origin',
               'last_synced_at,updated_at' FROM n""",
    "return_lineage": """
        WITH lines AS (
            SELECT l_partkey AS part, l_suppkey AS supp, l_returnflag AS flag, l_shipdate AS at, l_orderkey AS ord,
                   l_orderkey * 10 + l_linenumber AS id
            FROM lineitem),
        linked AS (
            SELECT r.id AS return_origin, r.ord AS return_key, s.id AS sale_origin, s.ord AS sale_key,
                   row_number() OVER (PARTITION BY r.id, r.part, r.supp, r.at ORDER BY s.at DESC, s.ord DESC, s.id DESC) AS place
            FROM lines r JOIN lines s ON s.part = r.part AND s.supp = r.supp
                 AND CAST(s.at AS DATE) < CAST(r.at AS DATE) AND s.ord <> r.ord
            WHERE r.flag = 'R' AND s.flag = 'N'),
        links AS (SELECT DISTINCT return_origin, return_key, sale_origin, sale_key FROM linked WHERE place = 1),
        named AS (SELECT return_key, max(sale_key) AS named FROM links GROUP BY 1),
        headers AS (
            SELECT o_orderkey AS ord, 'T-' || o_orderkey AS id, o_orderdate AS at, o_orderstatus AS status,
                   named AS names
            FROM orders LEFT JOIN named ON return_key = o_orderkey
            UNION ALL
            SELECT o_orderkey, 'T-' || o_orderkey || '-2', o_orderdate + INTERVAL 1 DAY, o_orderstatus, NULL
            FROM orders WHERE o_orderstatus = 'F')
        SELECT sale_origin, return_origin, 'SO-' || sale_key AS sale_order,
               'T-' || sale_key || CASE WHEN s.o_orderstatus = 'F' AND r.names IS DISTINCT FROM sale_key THEN '-2' ELSE '' END
                   AS sale_transaction,
               s.o_orderdate + CASE WHEN s.o_orderstatus = 'F' AND r.names IS DISTINCT FROM sale_key
                                    THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS sale_date,
               'SO-' || return_key AS return_order, r.id AS return_transaction, r.at AS return_date,
               coalesce(r.names = sale_key, false) AS names_sale, r.status <> 'P' AS statement_matches
        FROM links JOIN orders s ON s.o_orderkey = sale_key JOIN headers r ON r.ord = return_key""",
}

ORACLE |= {
    "scan_json_document": "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
    "scan_csv_quoted": "SELECT doc_id, lang, text FROM documents",
    "source_freshness": """
        SELECT 'orders' AS file_name, true AS well_formed, count(*) AS n_rows FROM orders
        UNION ALL SELECT 'lineitem', true, count(*) FROM lineitem
    """,
    "load_skip": "SELECT 'skipped' AS status, CAST(0 AS BIGINT) AS rows_read, count(*) AS rows_in_table FROM events",
    "load_rejects": """
        SELECT CASE WHEN event_type = 'error' THEN 'bad ' ELSE '' END || event_id AS event_id, event_type,
               event_type = 'error' AS rejected
        FROM events
    """,
    "stream_late_file": """
        SELECT event_id, date_trunc('second', ts + INTERVAL 1 HOUR) AS ts, 'corrected' AS event_type FROM events
    """,
}

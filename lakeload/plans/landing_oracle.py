"""The SQL of the queries on landed files and catalog tables."""

from __future__ import annotations

from lakeload.plans.oracle import _EVENT_COLUMNS, _ORDER_CHANGES, _ORDER_COLUMNS, _ORDER_MONTH

_PIECE = "CASE WHEN ts < TIMESTAMP '2024-01-10' THEN 'piece1' WHEN ts < TIMESTAMP '2024-01-20' THEN 'piece2' ELSE 'piece3' END"

ORACLE: dict[str, str] = {
    "bucketed_upsert": f"""
        WITH {_ORDER_CHANGES},
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC NULLS LAST, incoming) AS rank
            FROM (SELECT *, 0 AS incoming FROM target UNION ALL BY NAME SELECT *, 1 AS incoming FROM changes))
        SELECT {_ORDER_COLUMNS} FROM ranked WHERE rank = 1""",
    "bucketed_changes": f"""
        WITH {_ORDER_CHANGES}
        SELECT c.o_orderkey, c.o_orderdate,
               CASE WHEN t.o_orderkey IS NULL THEN 'new'
                    WHEN c.o_orderdate IS NOT NULL AND (t.o_orderdate IS NULL OR c.o_orderdate > t.o_orderdate) THEN 'updated'
                    ELSE 'unchanged' END AS change
        FROM changes c LEFT JOIN target t ON t.o_orderkey = c.o_orderkey""",
    "reconcile_digests": f"""
        WITH {_ORDER_CHANGES},
        ours AS (SELECT o_orderkey, [CAST(o_custkey AS VARCHAR), o_orderstatus, CAST(o_totalprice AS VARCHAR), CAST(o_orderdate AS VARCHAR), o_orderpriority] AS row
                 FROM changes WHERE o_orderpriority <> '5-LOW'),
        theirs AS (SELECT o_orderkey, [CAST(o_custkey AS VARCHAR), o_orderstatus, CAST(o_totalprice AS VARCHAR), CAST(o_orderdate AS VARCHAR), o_orderpriority] AS row
                 FROM target)
        SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
               CASE WHEN b.o_orderkey IS NULL THEN 'new' WHEN a.o_orderkey IS NULL THEN 'gone' ELSE 'changed' END AS change
        FROM ours a FULL JOIN theirs b ON a.o_orderkey = b.o_orderkey
        WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.row IS DISTINCT FROM b.row""",
    "block_digests": """
        SELECT CAST(coalesce(year(o_orderdate) * 100 + month(o_orderdate), 0) AS INTEGER) AS month, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_differing
        FROM orders GROUP BY 1""",
    "observed_bounds": "SELECT min(ts) AS modified_min, max(ts) AS modified_max, count(*) AS n_rows FROM events",
    "fresh_files": "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-15'",
    "load_fresh_files": """
        WITH n AS (SELECT count(*) FILTER (ts < TIMESTAMP '2024-01-15') AS first, count(*) FILTER (ts >= TIMESTAMP '2024-01-15') AS second FROM events)
        SELECT v.run_id, v.status, v.rows_read, v.rows_read AS rows_accepted, first + second AS rows_in_table
        FROM n, LATERAL (VALUES ('run0', 'loaded', first), ('run1', 'loaded', second), ('run2', 'skipped', 0)) AS v(run_id, status, rows_read)""",
    "scan_drifted": f"""
        SELECT event_id, ts, user_id, event_type, value, CASE WHEN {_PIECE} <> 'piece1' THEN props END AS props,
               CASE WHEN {_PIECE} = 'piece3' THEN 'c' || (user_id % 3) END AS channel FROM events""",
    "conform_drifted": f"""
        SELECT {_EVENT_COLUMNS.replace("props", f"CASE WHEN {_PIECE} <> 'piece1' THEN props ELSE '' END AS props").replace("date_trunc('second', ts) AS ts", "date_trunc('second', events.ts) AS ts")},
               CAST(NULL AS TIMESTAMP) AS last_synced_at, TIMESTAMP '2024-03-01 06:00:00' AS updated_at FROM events""",
    "drift_by_file": f"""
        WITH pieces AS (SELECT {_PIECE} AS piece, count(*) AS n FROM events GROUP BY 1)
        SELECT piece AS file_name, 'props' AS column_name, 'empty' AS drift, n AS n_rows, CAST(0 AS BIGINT) AS n_values FROM pieces WHERE piece = 'piece1'
        UNION ALL SELECT piece, 'channel', 'undeclared', n, n FROM pieces WHERE piece = 'piece3'""",
    "stream_dedup": """
        WITH mark AS (SELECT max(ts) FILTER (ts < TIMESTAMP '2024-01-15') - INTERVAL 2 DAY AS passed FROM events)
        SELECT event_id, ts, event_type, (SELECT count(*) FROM events, mark WHERE ts < passed) AS n_late FROM events""",
    "catalog_defaults": """
        SELECT o_orderkey, o_totalprice, o_orderpriority, 'store''s own' AS channel, CAST(2 AS INTEGER) AS n_copies, CAST(0.5 AS DOUBLE) AS rate,
               CAST(NULL AS VARCHAR) AS note,
               'UInt64:,Float64:,String:,String:store''s own,Int32:CAST(1 + 1 AS int),Float64:CAST(0.5 AS double),String:' AS declared
        FROM orders""",
    "clustered_lookup": """
        SELECT o_orderkey, o_totalprice, o_orderdate, 'key' AS found_by FROM orders WHERE o_orderkey BETWEEN 300 AND 700
        UNION ALL SELECT o_orderkey, o_totalprice, o_orderdate, 'price' FROM orders WHERE o_totalprice > 350000""",
    "bloom_lookup": f"SELECT o_orderkey, o_custkey, o_totalprice, {_ORDER_MONTH} FROM orders WHERE o_orderkey IN (77, -5)",
    "compact_noted": """
        WITH n AS (SELECT count(*) AS n FROM events)
        SELECT event_id, ts, event_type, p_month, n AS n_rewritten, CAST(0 AS BIGINT) AS n_second FROM n, (
            SELECT event_id, ts - INTERVAL 1 YEAR AS ts, event_type, CAST(year(ts) * 100 + month(ts) - 100 AS INTEGER) AS p_month FROM events
            UNION ALL
            SELECT event_id, ts, CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN 'again' ELSE event_type END, CAST(year(ts) * 100 + month(ts) AS INTEGER) FROM events)""",
}

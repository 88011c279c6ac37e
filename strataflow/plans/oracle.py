"""For each query, the SQL that another engine runs on the same tables."""

HISTORY = """
SELECT user_id, event_type, value, ts, ts AS start_at,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS end_at
FROM events
"""

LATEST = """
SELECT user_id, event_type, value, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events) x
WHERE rn = 1
"""

TRACKED = """
WITH f AS (
  SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR event_type IS DISTINCT FROM lag(event_type) OVER w
                 THEN 1 ELSE 0 END AS chg
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
g AS (
  SELECT *, CAST(sum(chg) OVER (PARTITION BY user_id ORDER BY ts
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS run FROM f),
r AS (
  SELECT *, min(ts) OVER (PARTITION BY user_id, run) AS start_at,
         row_number() OVER (PARTITION BY user_id, run ORDER BY ts DESC) AS rn FROM g)
SELECT user_id, event_type, value, ts, start_at,
       lead(start_at) OVER (PARTITION BY user_id ORDER BY run) AS end_at
FROM r WHERE rn = 1
"""

PRIORITIES = """
SELECT o_custkey, o_orderpriority, o_orderdate AS start_at,
       lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS end_at
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS rn
      FROM orders) z
WHERE rn = 1
"""

LISTENS = """
SELECT e.event_id, e.value, c.c_custkey, c.c_name, p.p_partkey, p.p_name
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
              LEFT JOIN part p ON e.event_id = p.p_partkey
"""

TOTALS = """
SELECT user_id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
FROM events GROUP BY user_id
"""

SCAN = "SELECT event_id, ts, user_id, event_type, value FROM events"
LINE_KEYS = "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem"
FAILED = """
concat_ws(',', CASE WHEN c_acctbal >= 0 THEN NULL ELSE 'not_in_debt' END,
               CASE WHEN c_mktsegment <> 'MACHINERY' THEN NULL ELSE 'known_segment' END)
"""

RULED = """
SELECT user_id, event_type, value, ts, ts AS start_at,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS end_at
FROM events WHERE value > 10 AND event_type IS NOT NULL
"""

CROWDED = """
WITH o AS (SELECT o_orderkey, o_orderdate, o_orderpriority,
                  CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS o_custkey FROM orders),
h AS (
  SELECT o_custkey, o_orderpriority, o_orderdate AS start_at,
         lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS end_at
  FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate
                                     ORDER BY o_orderpriority DESC, o_orderkey DESC) AS rn FROM o) z
  WHERE rn = 1)
SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate, o.o_custkey, h.o_orderpriority AS priority_asof
FROM lineitem l JOIN o ON l.l_orderkey = o.o_orderkey
LEFT JOIN h ON h.o_custkey = o.o_custkey AND l.l_shipdate >= h.start_at
           AND (h.end_at IS NULL OR l.l_shipdate < h.end_at)
"""

ORACLE: dict[str, str] = {
    "scan_project": SCAN,
    "select_star": "SELECT * FROM nation",
    "table_scan": "SELECT * FROM supplier",
    "sql_text": """
        SELECT event_type, count(*) AS n_events FROM events
        WHERE ts > TIMESTAMP '2024-01-15' GROUP BY event_type""",
    "upper_bucket": """
        SELECT p_partkey, upper(p_name) AS p_name,
               CASE WHEN p_size < 15 THEN 'low' WHEN p_size < 30 THEN 'medium' ELSE 'high' END
               AS durationflag
        FROM part""",
    "regex_clean": """
        SELECT o_orderkey, regexp_replace(o_orderpriority, '-', ' ', 'g') AS o_orderpriority
        FROM orders""",
    "filter_in": "SELECT p_partkey, p_name FROM part WHERE p_partkey IN (46, 5)",
    "topk_preview": "SELECT * FROM events ORDER BY value DESC, event_id LIMIT 100",
    "meta_left_join": LISTENS,
    "star_join": """
        SELECT l.l_orderkey, l.l_linenumber, l.l_extendedprice, o.o_orderdate, c.c_name, n.n_name
        FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
                        LEFT JOIN customer c ON o.o_custkey = c.c_custkey
                        LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
                        LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "star_current": f"""
        SELECT o.o_orderkey, o.o_custkey, h.o_orderpriority AS latest_priority
        FROM orders o LEFT JOIN (SELECT * FROM ({PRIORITIES}) p WHERE end_at IS NULL) h
             ON o.o_custkey = h.o_custkey""",
    "pit_join": f"""
        WITH h AS ({PRIORITIES})
        SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate, o.o_custkey,
               h.o_orderpriority AS priority_asof
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        LEFT JOIN h ON h.o_custkey = o.o_custkey AND l.l_shipdate >= h.start_at
                   AND (h.end_at IS NULL OR l.l_shipdate < h.end_at)""",
    "sum_by_key": TOTALS,
    "latest_change": "SELECT max(ts) AS high, count(*) AS n_rows FROM events",
    "dim_date": """
        SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS date_key,
               CAST(o_orderdate AS DATE) AS date, CAST(day(o_orderdate) AS INT) AS day,
               CAST(month(o_orderdate) AS INT) AS month, CAST(year(o_orderdate) AS INT) AS year,
               dayname(o_orderdate) AS weekday
        FROM orders""",
    "dedupe_any": LINE_KEYS,
    "dedupe_latest": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                     l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                     l_linestatus DESC) AS rn
          FROM lineitem) x
        WHERE rn = 1""",
    "dedupe_change": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (
            PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS rn
          FROM orders) x
        WHERE rn = 1""",
    "expect_drop": f"SELECT * FROM ({LISTENS}) x WHERE p_partkey IS NOT NULL",
    "expect_fail": "SELECT o_orderkey, o_custkey FROM orders",
    "quarantine": """
        SELECT *, 'not_in_debt' AS failed_rules FROM customer WHERE NOT coalesce(c_acctbal >= 0, FALSE)""",
    "rule_counts": """
        SELECT * FROM (
          SELECT 'not_in_debt' AS rule, count(*) AS n_rows FROM customer
          WHERE NOT coalesce(c_acctbal >= 0, FALSE)
          UNION ALL
          SELECT 'known_segment', count(*) FROM customer
          WHERE NOT coalesce(c_mktsegment <> 'MACHINERY', FALSE)) x
        WHERE n_rows > 0""",
    "scd1": LATEST,
    "scd2": HISTORY,
    "scd2_tracked": TRACKED,
    "scd2_ties": PRIORITIES,
    "scd2_closed": f"SELECT * FROM ({HISTORY}) h WHERE end_at IS NOT NULL",
    "scd2_current": f"SELECT * FROM ({HISTORY}) h WHERE end_at IS NULL",
    "as_of": f"""
        SELECT * FROM ({HISTORY}) h WHERE start_at <= TIMESTAMP '2024-01-15'
        AND (end_at IS NULL OR end_at > TIMESTAMP '2024-01-15')""",
    "ingest_window": "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15'",
    "ingest_two_runs": "SELECT * FROM events",
    "ingest_overlap": "SELECT * FROM events",
    "backfill_window": """
        SELECT * FROM events
        WHERE ts > TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-15'""",
    "layer_stats": f"""
        SELECT 'bronze' AS layer, count(*) AS n_rows, max(ts) AS newest,
               count(DISTINCT user_id) AS n_keys FROM events
        UNION ALL
        SELECT 'silver', count(*), max(ts), count(DISTINCT user_id) FROM events WHERE value > 10
        UNION ALL
        SELECT 'gold', count(*), max(ts), count(DISTINCT user_id) FROM ({LATEST}) g""",
    "run_log": """
        WITH e AS (
          SELECT ts > TIMESTAMP '2024-01-15' AS late, count(*) AS n, max(ts) AS high
          FROM events GROUP BY 1),
        o AS (SELECT count(*) AS n, max(o_orderdate) AS high FROM orders)
        SELECT 'events' AS "table", 'loaded' AS status, n AS n_rows,
               CASE WHEN late THEN (SELECT high FROM e WHERE NOT late)
                    ELSE TIMESTAMP '1900-01-01' END AS low, high
        FROM e
        UNION ALL SELECT 'events', 'empty', 0, max(high), max(high) FROM e
        UNION ALL SELECT 'orders', 'loaded', n, TIMESTAMP '1900-01-01', high FROM o
        UNION ALL SELECT 'orders', 'empty', 0, high, high FROM o
        UNION ALL SELECT 'orders', 'empty', 0, high, high FROM o
        UNION ALL SELECT 'absent', 'failed', 0, NULL, NULL FROM range(3)""",
    "stream_append": SCAN,
    "stream_evolve": """
        SELECT event_id, ts, user_id, event_type, value,
               CASE WHEN ts > TIMESTAMP '2024-01-15' THEN props END AS props
        FROM events""",
    "stream_evolve_nested": """
        SELECT event_id, user_id, CASE WHEN ts > TIMESTAMP '2024-01-15' THEN props END AS props,
               event_type AS kind, CASE WHEN ts > TIMESTAMP '2024-01-15' THEN value END AS value,
               user_id AS mapped
        FROM events""",
    "stream_dedupe": LINE_KEYS,
    "stream_dedupe_within": LINE_KEYS,
    "stream_dedupe_change": "SELECT DISTINCT * FROM events",
    "stream_quarantine": f"""
        SELECT c_custkey, {FAILED} AS failed_rules FROM customer WHERE {FAILED} <> ''""",
    "sum_incremental": f"""
        SELECT event_type, CAST(sum(CAST(value AS DECIMAL(38,2))) AS DOUBLE) AS total_value, count(*) AS n_rows
        FROM ({LATEST}) l GROUP BY event_type""",
    "stream_scd1": LATEST,
    "stream_scd2": HISTORY,
    "stream_rules": RULED,
    "rebuild_rebucketed": HISTORY,
    "rebuild_rule_change": RULED,
    "apply_after_spec_change": HISTORY,
    "scd1_hot": LATEST,
    "scd2_hot": HISTORY,
    "scd2_tracked_hot": TRACKED,
    "pit_join_skewed": CROWDED,
    "pit_join_hot": CROWDED,
    "pit_join_cells": CROWDED,
    "ingest_late_quiet": "SELECT * FROM events WHERE ts <= TIMESTAMP '2024-01-15'",
    "backfill_silver": "SELECT user_id, event_type, value, ts FROM events",
    "stream_dedupe_exact": """
        SELECT event_id, user_id, CAST(ts AS DATE) AS day, ts AS seen FROM events
        UNION ALL
        SELECT event_id, user_id, CAST(ts AS DATE), ts + INTERVAL 1 MICROSECOND FROM events""",
    "stream_dedupe_late": """
        WITH m AS (SELECT max(ts) - INTERVAL 20 DAY AS least FROM events)
        SELECT event_id, user_id, ts, FALSE AS late FROM events, m
        WHERE ts > TIMESTAMP '2024-01-15' OR ts >= least
        UNION ALL
        SELECT event_id, user_id, ts, TRUE FROM events, m, range(2)
        WHERE ts <= TIMESTAMP '2024-01-15' AND ts < least""",
    "rules_all_gold": """
        WITH u AS (
          SELECT DISTINCT CASE WHEN o_custkey % 10 <> 0 THEN o_custkey END AS k,
                 upper('user-' || o_custkey) AS name, o_orderpriority AS p, o_orderdate AS moment
          FROM orders),
        t AS (
          SELECT DISTINCT CASE WHEN p_partkey % 10 <> 0 THEN p_partkey END AS k,
                 regexp_replace(concat_ws('-', p_brand, p_name), '-', ' ', 'g') AS name, p_size
          FROM part),
        f AS (SELECT DISTINCT CASE WHEN event_id % 10 <> 0 THEN event_id END AS k,
                     user_id, event_id, value, ts FROM events)
        SELECT 'DimUser' AS "table", 'gold' AS place, count(DISTINCT (k, moment)) AS n_rows,
               count(DISTINCT (k, moment)) AS n_keys FROM u WHERE k IS NOT NULL
        UNION ALL SELECT 'DimUser', 'quarantine', count(*), 0 FROM u WHERE k IS NULL
        UNION ALL SELECT 'DimTrack', 'gold', count(*), count(k) FROM t WHERE k IS NOT NULL
        UNION ALL SELECT 'DimTrack', 'quarantine', count(*), 0 FROM t WHERE k IS NULL
        UNION ALL SELECT 'FactStream', 'gold', count(*), count(k) FROM f WHERE k IS NOT NULL
        UNION ALL SELECT 'FactStream', 'quarantine', count(*), 0 FROM f WHERE k IS NULL""",
    "catalog_layers": """
        SELECT event_id AS stream_id, user_id, event_id AS track_id, value AS listen_duration,
               ts AS stream_timestamp FROM events""",
    "run_stats": """
        WITH p AS (SELECT count(*) AS n, max(ts) AS high FROM events WHERE ts <= TIMESTAMP '2024-01-15'
                   UNION ALL SELECT count(*), max(ts) FROM events)
        SELECT 'FactStream' AS "table", layer, n AS n_rows, high AS newest
        FROM p, (VALUES ('bronze'), ('silver'), ('gold')) l(layer)""",
    "stream_scd2_late": TRACKED,
    "gold_as_of": f"""
        SELECT * FROM ({HISTORY}) h WHERE start_at <= TIMESTAMP '2024-01-15'
        AND (end_at IS NULL OR end_at > TIMESTAMP '2024-01-15')""",
    "gold_changes": f"""
        WITH h AS ({HISTORY}),
        f AS (SELECT user_id, min(start_at) AS first_at FROM h GROUP BY 1)
        SELECT h.*, CASE WHEN start_at = first_at THEN 'opened' ELSE 'updated' END AS change
        FROM h JOIN f USING (user_id)
        WHERE start_at > TIMESTAMP '2024-01-01 02:00:00' AND start_at <= TIMESTAMP '2024-01-06'
        UNION ALL
        SELECT h.*, 'closed' FROM h
        WHERE end_at > TIMESTAMP '2024-01-01 02:00:00' AND end_at <= TIMESTAMP '2024-01-06'""",
    "stream_scd2_runs": TRACKED,
    "apply_after_compaction": HISTORY,
    "rebuild_after_compaction": RULED,
    "release_rejected": RULED,
    "recover_twice": HISTORY,
    "flow_dedupe_within": "SELECT user_id, event_type, value, ts FROM events",
    "catalog_widened": """
        SELECT event_id AS stream_id, user_id, ts AS stream_timestamp,
               CASE WHEN ts > TIMESTAMP '2024-01-15' THEN 'device ' || (user_id % 3) END AS device_type
        FROM events""",
    "stream_merge_scd1": LATEST,
    "stream_merge_scd2": HISTORY,
    "snapshot_sum": TOTALS,
    "refresh_downstream": f"""
        SELECT CAST(floor(total_value / 100) AS BIGINT) AS band, count(*) AS n_users
        FROM ({TOTALS}) t GROUP BY 1""",
    "medallion_star": """
        WITH u AS (
          SELECT o_custkey AS user_id, upper('user-' || o_custkey) AS user_name,
                 o_orderpriority AS subscription_type,
                 row_number() OVER (PARTITION BY o_custkey
                                    ORDER BY o_orderdate DESC, o_orderpriority DESC) AS rn
          FROM orders),
        t AS (
          SELECT p_partkey AS track_id,
                 regexp_replace(concat_ws('-', p_brand, p_name), '-', ' ', 'g') AS track_name,
                 CASE WHEN p_size * 10 < 150 THEN 'low' WHEN p_size * 10 < 300 THEN 'medium'
                      ELSE 'high' END AS durationflag
          FROM part)
        SELECT e.event_id AS stream_id, e.value AS listen_duration, u.user_id, u.user_name,
               u.subscription_type, t.track_id, t.track_name, t.durationflag
        FROM events e LEFT JOIN u ON e.user_id = u.user_id AND u.rn = 1
                      LEFT JOIN t ON e.event_id = t.track_id""",
    "refresh_one": """
        SELECT o_custkey AS user_id, upper('user-' || o_custkey) AS user_name,
               o_orderpriority AS subscription_type, o_orderdate AS start_at,
               lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS end_at
        FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate
                                           ORDER BY o_orderpriority DESC) AS rn
              FROM orders) z
        WHERE rn = 1""",
}

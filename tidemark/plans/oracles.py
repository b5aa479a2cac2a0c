"""ANSI SQL answers to the registered queries, over the given tables."""

from __future__ import annotations

import re

AS_OF = "TIMESTAMP '2024-01-29 00:00:00'"
CDC_CUT = "TIMESTAMP '2024-01-25 00:00:00'"
ORDER_CUT = "TIMESTAMP '2000-01-01 00:00:00'"
EVENT = "event_id, customer_id, city, country, event_time, arrival_ts"
CHANGE = "event_id, customer_id, city, event_time, arrival_ts"
VERSION = "customer_id, city, start_date, end_date, is_current, hash_diff, source_event_id"
VERSION_KEY = "md5(concat_ws('||', customer_id, epoch_us(start_date), source_event_id))"


def _history(events: str) -> str:
    """Collapsed history by (time, event id)."""
    return f"""
    SELECT customer_id, city, event_time AS start_date,
      lead(event_time) OVER w AS end_date, lead(event_time) OVER w IS NULL AS is_current,
      hash_diff, event_id AS source_event_id
    FROM (SELECT *, lag(hash_diff) OVER (PARTITION BY customer_id ORDER BY event_time, event_id) AS prev FROM {events}) t
    WHERE prev IS NULL OR prev <> hash_diff
    WINDOW w AS (PARTITION BY customer_id ORDER BY event_time, event_id)"""


def _per_event(events: str) -> str:
    return f"""
    SELECT customer_id, city, event_time AS start_date,
      lead(event_time) OVER w AS end_date, lead(event_time) OVER w IS NULL AS is_current,
      hash_diff, event_id AS source_event_id
    FROM {events} WINDOW w AS (PARTITION BY customer_id ORDER BY event_time, event_id)"""


def _merge(prefix: str, dim: str, batch: str, events: str) -> dict[str, str]:
    """Steps of one batch: late keys, expired, new, rebuilt and untouched versions."""
    p = prefix
    return {
        f"{p}_open": f"SELECT * FROM {dim} WHERE is_current",
        f"{p}_keys": f"""SELECT b.customer_id, coalesce(min(b.event_time) < min(o.start_date), false) AS late
          FROM {batch} b LEFT JOIN {p}_open o ON b.customer_id = o.customer_id GROUP BY b.customer_id""",
        f"{p}_kept": f"""SELECT * FROM (
            SELECT b.event_id, b.customer_id, b.city, b.event_time, b.hash_diff,
              coalesce(lag(b.hash_diff) OVER (PARTITION BY b.customer_id ORDER BY b.event_time, b.event_id), o.hash_diff) AS prev
            FROM {batch} b JOIN {p}_keys k ON b.customer_id = k.customer_id AND NOT k.late
              LEFT JOIN {p}_open o ON b.customer_id = o.customer_id) t
          WHERE prev IS NULL OR prev <> hash_diff""",
        f"{p}_new": f"SELECT * FROM ({_per_event(f'{p}_kept')}) n",
        f"{p}_expired": f"""SELECT o.customer_id, o.city, o.start_date, k.first_change AS end_date, false AS is_current,
            o.hash_diff, o.source_event_id
          FROM {p}_open o JOIN (SELECT customer_id, min(event_time) AS first_change FROM {p}_kept GROUP BY customer_id) k
            ON o.customer_id = k.customer_id""",
        f"{p}_late_events": f"""SELECT e.* FROM {events} e
          WHERE e.customer_id IN (SELECT customer_id FROM {p}_keys WHERE late)""",
        f"{p}_stays": f"""SELECT {VERSION} FROM {dim} d
          WHERE d.customer_id NOT IN (SELECT customer_id FROM {p}_keys WHERE late)
            AND NOT (d.is_current AND d.customer_id IN (SELECT customer_id FROM {p}_kept))""",
        f"{p}_dim": f"""SELECT {VERSION} FROM {p}_stays UNION ALL SELECT {VERSION} FROM {p}_expired
          UNION ALL SELECT {VERSION} FROM {p}_new UNION ALL {_history(f'{p}_late_events')}""",
    }


def _silver(bronze: str) -> str:
    return f"""SELECT {EVENT} FROM (SELECT *, row_number() OVER (PARTITION BY event_id
      ORDER BY event_time DESC NULLS LAST, arrival_ts DESC NULLS LAST) AS rn FROM {bronze}) t WHERE rn = 1"""


def _violations(bronze: str) -> str:
    return f"""
    SELECT {EVENT}, 'NULL_CUSTOMER_ID' AS dq_error_reason FROM {bronze} WHERE customer_id IS NULL
    UNION ALL SELECT {EVENT}, 'FUTURE_TIMESTAMP' FROM {bronze} WHERE event_time > {AS_OF}
    UNION ALL SELECT {EVENT}, 'DUPLICATE_EVENT' FROM {bronze}
      WHERE event_id IN (SELECT event_id FROM {bronze} GROUP BY event_id HAVING count(*) > 1)"""


VIEWS = {
    "cdc_bronze": """
      SELECT event_id, CASE WHEN event_id % 97 = 0 THEN NULL ELSE concat('C', CAST(user_id AS VARCHAR)) END AS customer_id,
        event_type AS city, CASE WHEN event_id % 13 = 0 THEN NULL ELSE props END AS country,
        CASE WHEN event_id % 41 = 0 THEN ts - INTERVAL '10' DAY ELSE ts END AS event_time, ts AS arrival_ts FROM events
      UNION ALL
      SELECT event_id, concat('C', CAST(user_id AS VARCHAR)), event_type, props, ts + INTERVAL '1' HOUR, ts + INTERVAL '1' HOUR
      FROM events WHERE event_id % 50 = 0""",
    "cdc_early": f"SELECT * FROM cdc_bronze WHERE arrival_ts < {CDC_CUT}",
    "cdc_silver": _silver("cdc_bronze"),
    "cdc_silver1": _silver("cdc_early"),
    "cdc_valid": f"""SELECT *, md5(city) AS hash_diff FROM cdc_silver
      WHERE customer_id IS NOT NULL AND event_time <= {AS_OF}""",
    "cdc_valid1": f"""SELECT *, md5(city) AS hash_diff FROM cdc_silver1
      WHERE customer_id IS NOT NULL AND event_time <= {CDC_CUT}""",
    "cdc_batch1": f"SELECT * FROM cdc_valid WHERE arrival_ts < {CDC_CUT}",
    "cdc_mark": "SELECT max(event_time) AS last_ts FROM cdc_batch1",
    "cdc_batch2": """SELECT v.* FROM cdc_valid v
      WHERE v.event_time > (SELECT last_ts FROM cdc_mark) - INTERVAL '7' DAY""",
    "cdc_dim": _history("cdc_valid"),
    "run_dim1": _history("cdc_valid1"),
    "run_batch2": """SELECT * FROM cdc_valid
      WHERE event_time > (SELECT max(event_time) FROM cdc_valid1) - INTERVAL '7' DAY""",
    "violations": _violations("cdc_bronze"),
    "early_violations": _violations("cdc_early"),
    "ord_cdc": """SELECT o_orderkey AS event_id, o_custkey % 50 AS customer_id, o_orderpriority AS city, o_orderdate AS event_time,
      CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + INTERVAL '5' DAY
           WHEN o_orderkey % 41 = 0 THEN o_orderdate + INTERVAL '20' DAY ELSE o_orderdate END AS arrival_ts,
      md5(o_orderpriority) AS hash_diff FROM orders""",
    "ord_batch1": f"SELECT * FROM ord_cdc WHERE arrival_ts < {ORDER_CUT}",
    "ord_batch2": """SELECT * FROM ord_cdc
      WHERE event_time > (SELECT max(event_time) FROM ord_batch1) - INTERVAL '7' DAY""",
    "ord_seen": """SELECT * FROM ord_cdc WHERE event_id IN (SELECT event_id FROM ord_batch1)
      OR event_id IN (SELECT event_id FROM ord_batch2)""",
    "ord_dim1": _history("ord_batch1"),
    "cust_hist": """SELECT o_custkey AS customer_id, o_orderpriority, o_orderdate AS start_date,
        lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS end_date,
        md5(concat_ws('||', o_custkey, epoch_us(o_orderdate), o_orderkey)) AS customer_sk FROM orders""",
    "sales_orders": """SELECT l.l_orderkey AS order_id, l.l_linenumber, o.o_custkey AS customer_id, l.l_partkey AS product_id,
        l.l_shipdate AS order_date, l.l_quantity AS quantity, l.l_extendedprice AS total_amount
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "sales_as_of": """SELECT s.*, c.customer_sk, c.o_orderpriority FROM sales_orders s LEFT JOIN cust_hist c
      ON s.customer_id = c.customer_id AND s.order_date >= c.start_date AND (c.end_date IS NULL OR s.order_date < c.end_date)""",
    "sales_facts": """SELECT s.order_id, s.l_linenumber, s.customer_sk, md5(CAST(p.p_partkey AS VARCHAR)) AS product_sk,
        CAST(strftime(k.d, '%Y%m%d') AS INT) AS date_sk, s.quantity, s.total_amount, s.order_date
      FROM sales_as_of s LEFT JOIN part p ON s.product_id = p.p_partkey AND p.p_partkey % 10 <> 3
        LEFT JOIN known_dates k ON CAST(s.order_date AS DATE) = k.d""",
    "known_dates": "SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem WHERE day(l_shipdate) <> 13",
    "prices": """SELECT l_partkey % 500 AS product_id, date_trunc('month', l_shipdate) AS start_date, l_linenumber,
        CASE WHEN l_linenumber < 6 THEN date_trunc('month', l_shipdate) + to_days(CAST(12 * l_linenumber AS INT)) END AS end_date,
        max(l_extendedprice) AS price FROM lineitem GROUP BY ALL""",
    "run_log": """SELECT event_type AS pipeline_name, date_trunc('day', ts) AS run_timestamp, count(*) AS records_processed,
        sum(CASE WHEN event_id % 97 = 0 THEN 1 ELSE 0 END) AS records_failed,
        sum(CASE WHEN event_id % 97 = 0 THEN 0 ELSE 1 END) AS records_loaded FROM events GROUP BY ALL""",
    "sla_log": """SELECT *, CASE WHEN freshness_minutes > 120 THEN 'SLA_BREACH' ELSE 'OK' END AS status FROM (
        SELECT *, date_sub('minute', latest_event_time, check_time) AS freshness_minutes FROM (
          SELECT concat('C', CAST(user_id AS VARCHAR)) AS pipeline_name,
            CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL '1' DAY AS check_time, max(ts) AS latest_event_time
          FROM events GROUP BY ALL) a) b""",
    "run_metrics_row": f"""SELECT 'customer_pipeline' AS pipeline_name, {AS_OF} AS run_timestamp,
      count(*) FILTER (fresh) AS records_processed,
      count(*) FILTER (fresh AND customer_id IS NULL) + count(*) FILTER (fresh AND event_time > {AS_OF}) AS records_failed,
      count(*) FILTER (fresh AND customer_id IS NOT NULL AND event_time <= {AS_OF}) AS records_loaded,
      count(*) FILTER (NOT fresh AND arrival_ts >= {CDC_CUT}) AS records_too_late
      FROM (SELECT *, event_time > (SELECT last_ts FROM cdc_mark) - INTERVAL '7' DAY AS fresh FROM cdc_silver) t""",
    "marks": "SELECT event_type AS pipeline_name, max(ts) AS last_processed_ts FROM events GROUP BY event_type",
    "unmerged": f"SELECT * FROM ord_dim1 UNION ALL SELECT * FROM ({_history('ord_batch2')}) b",
    "late_keys": """SELECT b.customer_id FROM ord_batch2 b JOIN ord_dim1 d ON b.customer_id = d.customer_id AND d.is_current
      GROUP BY b.customer_id HAVING min(b.event_time) < min(d.start_date)""",
    "with_start": """SELECT b.*, d.start_date AS current_start, d.hash_diff AS current_hash
      FROM ord_batch2 b LEFT JOIN (SELECT * FROM ord_dim1 WHERE is_current) d ON b.customer_id = d.customer_id""",
    "year_batch": """SELECT * FROM ord_cdc
      WHERE event_time > (SELECT max(event_time) FROM ord_batch1) - INTERVAL '365' DAY""",
    **_merge("inc", "ord_dim1", "ord_batch2", "ord_cdc"),
    **_merge("year", "ord_dim1", "year_batch", "ord_cdc"),
    **_merge("seen", "ord_dim1", "ord_batch2", "ord_seen"),
    **_merge("again", "seen_dim", "ord_batch2", "ord_seen"),
    **_merge("run", "run_dim1", "run_batch2", "cdc_valid"),
}


def with_views(body: str) -> str:
    """Prefix the CTEs a statement needs, dependencies first."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(VIEWS[name].replace(name, ""))
                needed.append(name)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed) + "\n" + body


def _dates(source: str, column: str) -> str:
    return f"""SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_sk, CAST(d AS VARCHAR) AS full_date,
      CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month, CAST(day(d) AS INT) AS day
      FROM (SELECT DISTINCT CAST({column} AS DATE) AS d FROM {source}) t"""


RUN_DIM = f"SELECT {VERSION_KEY} AS customer_sk, {VERSION} FROM run_dim"
VALID = f"""SELECT {EVENT} FROM cdc_bronze b
  WHERE NOT EXISTS (SELECT 1 FROM violations v WHERE v.event_id = b.event_id)"""

BODIES = {
    "scan_csv": "SELECT * FROM orders",
    "scan_csv_reordered": "SELECT * REPLACE (CAST(NULL AS VARCHAR) AS o_orderpriority) FROM orders",
    "dq_unparsed": """SELECT * FROM (SELECT CASE WHEN event_id % 31 <> 0 THEN event_id END AS event_id, event_type AS city,
        CASE WHEN event_id % 37 <> 0 THEN ts END AS event_time,
        CASE WHEN event_id % 31 = 0 OR event_id % 37 = 0 THEN concat(
          CASE WHEN event_id % 31 = 0 THEN 'x' ELSE CAST(event_id AS VARCHAR) END, ',', event_type, ',',
          CASE WHEN event_id % 37 = 0 THEN 'soon' ELSE CAST(ts AS VARCHAR) END) END AS line,
        unnest(['NULL_EVENT_TIME', 'UNPARSED']) AS dq_error_reason FROM events) t
      WHERE line IS NOT NULL AND (event_time IS NULL OR dq_error_reason = 'UNPARSED')""",
    "dlq_replay": f"""SELECT {EVENT}, dq_error_reason, 'r1' AS run_id FROM (
        SELECT *, 'NULL_CUSTOMER_ID' AS dq_error_reason FROM cdc_silver WHERE customer_id IS NULL
        UNION ALL SELECT *, 'FUTURE_TIMESTAMP' FROM cdc_silver WHERE event_time > {AS_OF}) t""",
    "bronze_append": f"SELECT {EVENT}, CASE WHEN arrival_ts < {CDC_CUT} THEN 'b1' ELSE 'b2' END AS batch_id FROM cdc_bronze",
    "silver_overwrite": f"SELECT {EVENT} FROM cdc_silver",
    "silver_incremental": f"SELECT {EVENT.replace('event_id', 'md5(event_id::VARCHAR) AS event_id')} FROM cdc_silver",
    "dlq_append": f"SELECT {EVENT}, dq_error_reason, {AS_OF} AS failed_at, 'r1' AS run_id FROM violations",
    "dim_product_load": """SELECT md5(CAST(p_partkey AS VARCHAR)) AS product_sk, p_partkey AS product_id, p_name AS product_name,
      p_type AS category, p_retailprice AS price FROM part""",
    "dim_date_incremental": _dates("orders", "o_orderdate"),
    "select_to_schema": f"SELECT {VERSION_KEY} AS customer_sk, {VERSION}, {AS_OF} AS created_at FROM cdc_dim",
    "dedup_latest": f"SELECT {EVENT} FROM cdc_silver",
    "stream_stateful_latest": f"SELECT {EVENT} FROM cdc_silver",
    "dedup_latest_maxby": f"SELECT {EVENT} FROM cdc_silver",
    "dedup_lineitem": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC,
        l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM lineitem) t WHERE rn = 1""",
    "having_count": "SELECT event_id, count(*) AS copies FROM cdc_bronze GROUP BY event_id HAVING count(*) > 1",
    "dq_null_key": "SELECT * FROM violations WHERE dq_error_reason = 'NULL_CUSTOMER_ID'",
    "dq_future_timestamp": "SELECT * FROM violations WHERE dq_error_reason = 'FUTURE_TIMESTAMP'",
    "dq_duplicate_event": "SELECT * FROM violations WHERE dq_error_reason = 'DUPLICATE_EVENT'",
    "dq_violations": "SELECT * FROM violations",
    "dq_single_pass": "SELECT * FROM violations",
    "dq_valid_events": VALID,
    "dlq_new_only": """SELECT v.* FROM violations v WHERE NOT EXISTS (SELECT 1 FROM early_violations e
      WHERE e.event_id = v.event_id AND e.dq_error_reason = v.dq_error_reason)""",
    "hash_diff": "SELECT event_id, md5(concat_ws('||', city, country)) AS hash_diff FROM cdc_silver",
    "hash_diff_nullsafe": """SELECT event_id, md5(concat_ws('||', coalesce(city, chr(31)), coalesce(country, chr(31)))) AS hash_diff
      FROM cdc_silver""",
    "scd2_full": f"SELECT {VERSION} FROM cdc_dim",
    "timeline_collapsed": _history("ord_cdc"),
    "timeline_rebuild": _per_event("cdc_valid"),
    "timeline_rebuild_silver": _per_event("""(SELECT *, md5(city) AS hash_diff FROM cdc_silver
      WHERE customer_id IS NOT NULL AND event_time IS NOT NULL) s"""),
    "scd2_initial": _history("cdc_valid"),
    "scd2_incremental": f"SELECT {VERSION} FROM inc_dim",
    "scd2_incremental_per_event": f"""SELECT {VERSION} FROM inc_stays UNION ALL SELECT {VERSION} FROM inc_expired
      UNION ALL SELECT {VERSION} FROM inc_new UNION ALL {_per_event('inc_late_events')}""",
    "scd2_noop_replay": f"SELECT {VERSION} FROM seen_dim",
    "scd2_expired_rows": f"SELECT {VERSION} FROM inc_expired",
    "scd2_new_rows": f"SELECT {VERSION} FROM inc_new",
    "current_version_lookup": f"SELECT {CHANGE}, current_start FROM with_start",
    "late_event_detect": f"SELECT {CHANGE}, current_start FROM with_start WHERE event_time < current_start",
    "late_event_detect_year": f"""SELECT {CHANGE}, d.start_date AS current_start FROM year_batch b
      JOIN (SELECT customer_id AS own, start_date FROM ord_dim1 WHERE is_current) d ON b.customer_id = d.own
      WHERE event_time < d.start_date""",
    "scd2_incremental_year": f"SELECT {VERSION} FROM year_dim",
    "late_customer_events": f"SELECT {CHANGE} FROM ord_cdc WHERE customer_id IN (SELECT customer_id FROM late_keys)",
    "delete_by_key": f"SELECT {VERSION} FROM ord_dim1 WHERE customer_id NOT IN (SELECT customer_id FROM late_keys)",
    "insert_if_changed": f"SELECT {CHANGE}, hash_diff FROM with_start WHERE current_hash IS DISTINCT FROM hash_diff",
    "current_snapshot": f"SELECT {VERSION} FROM cdc_dim WHERE is_current",
    "snapshot_as_of": f"""SELECT {VERSION} FROM cdc_dim WHERE start_date <= TIMESTAMP '2024-01-15 00:00:00'
      AND (end_date IS NULL OR TIMESTAMP '2024-01-15 00:00:00' < end_date)""",
    "surrogate_key_durable": f"SELECT {VERSION_KEY} AS customer_sk, {VERSION} FROM cdc_dim",
    "surrogate_key_dense": f"""SELECT row_number() OVER (ORDER BY customer_id, start_date, source_event_id) AS customer_sk,
      {VERSION} FROM cdc_dim""",
    "temporal_customer_join": "SELECT * FROM sales_as_of",
    "temporal_join_window": "SELECT * FROM sales_as_of",
    "product_join": """SELECT order_id, l_linenumber, product_id, md5(CAST(p.p_partkey AS VARCHAR)) AS product_sk, quantity
      FROM sales_orders s LEFT JOIN part p ON s.product_id = p.p_partkey AND p.p_partkey % 10 <> 3""",
    "date_join": """SELECT order_id, l_linenumber, order_date, CAST(strftime(k.d, '%Y%m%d') AS INT) AS date_sk, quantity
      FROM sales_orders s LEFT JOIN known_dates k ON CAST(s.order_date AS DATE) = k.d""",
    "temporal_join_overlap": """SELECT o.o_orderkey AS order_id, o.o_custkey % 520 AS product_id, o.o_orderdate AS order_date, p.l_linenumber, p.price
      FROM orders o LEFT JOIN prices p ON o.o_custkey % 520 = p.product_id AND o.o_orderdate >= p.start_date
        AND (p.end_date IS NULL OR o.o_orderdate < p.end_date)""",
    "chk_sales_key_unique": "SELECT CAST(0 AS BIGINT) AS sales_sk, CAST(0 AS BIGINT) AS copies WHERE false",
    "distinct_dates": "SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS full_date FROM orders",
    "dim_date": _dates("orders", "o_orderdate"),
    "fact_sales": "SELECT * EXCLUDE (order_date) FROM sales_facts",
    "fact_orphans": """SELECT count(*) AS facts, count(*) FILTER (customer_sk IS NULL) AS without_customer,
      count(*) FILTER (product_sk IS NULL) AS without_product, count(*) FILTER (date_sk IS NULL) AS without_date
      FROM sales_facts""",
    "fact_rebuild_idempotent": """SELECT concat(order_id, '-', l_linenumber) AS order_id, customer_sk, product_sk,
      CAST(strftime(order_date, '%Y%m%d') AS INT) AS date_sk,
      CAST(quantity AS INT) AS quantity, CAST(CAST(total_amount AS DECIMAL(12,2)) AS DOUBLE) AS total_amount FROM sales_facts""",
    "fact_incremental": """SELECT concat(order_id, '-', l_linenumber) AS order_id, customer_sk, product_sk,
      CAST(strftime(order_date, '%Y%m%d') AS INT) AS date_sk,
      CAST(quantity AS INT) AS quantity, CAST(CAST(total_amount AS DECIMAL(12,2)) AS DOUBLE) AS total_amount FROM sales_facts""",
    "watermark_read": """SELECT * FROM marks WHERE pipeline_name = 'click'
      UNION ALL SELECT 'customer_pipeline', TIMESTAMP '1900-01-01 00:00:00'""",
    "watermark_advance": """SELECT * FROM marks UNION ALL
      SELECT 'customer_pipeline', greatest((SELECT last_ts FROM cdc_mark), (SELECT max(event_time) FROM cdc_batch2))""",
    "watermark_advance_all": """SELECT * FROM marks UNION ALL SELECT 'customer_pipeline', max(event_time) FROM cdc_silver
      WHERE event_time > (SELECT last_ts FROM cdc_mark) - INTERVAL '7' DAY""",
    "incremental_lookback": f"SELECT {EVENT} FROM cdc_batch2",
    "run_metrics": "SELECT * FROM run_metrics_row",
    "run_metrics_observed": """SELECT * FROM run_metrics_row""",
    "freshness_sla": f"""SELECT 'customer_pipeline' AS pipeline_name, {AS_OF} AS check_time, latest_event_time,
      freshness_minutes, CAST(120 AS INT) AS sla_threshold_minutes,
      CASE WHEN freshness_minutes > 120 THEN 'SLA_BREACH' ELSE 'OK' END AS status
      FROM (SELECT max(start_date) AS latest_event_time,
        greatest(date_sub('minute', max(start_date), {AS_OF}), 0) AS freshness_minutes FROM cdc_dim) t""",
    "medallion_end_to_end": RUN_DIM,
    "scd2_rebucket": RUN_DIM,
    "stream_available_now": RUN_DIM,
    "chk_one_current": "SELECT customer_id, count(*) AS copies FROM unmerged WHERE is_current GROUP BY customer_id HAVING count(*) > 1",
    "chk_pk_unique": "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "chk_fk_orphans": f"""SELECT customer_sk, count(*) AS facts FROM sales_facts WHERE customer_sk IS NOT NULL
      AND customer_sk NOT IN (SELECT customer_sk FROM cust_hist WHERE start_date < {ORDER_CUT}) GROUP BY customer_sk""",
    "chk_not_null": """SELECT count(*) FILTER (event_id IS NULL) AS event_id_nulls, count(*) FILTER (customer_id IS NULL) AS customer_id_nulls,
      count(*) FILTER (event_time IS NULL) AS event_time_nulls, count(*) FILTER (country IS NULL) AS country_nulls FROM cdc_bronze""",
    "chk_scd2_contiguous": """SELECT customer_id, start_date, end_date, next_start FROM (SELECT *, lead(start_date) OVER
        (PARTITION BY customer_id ORDER BY start_date, end_date NULLS LAST, source_event_id) AS next_start FROM unmerged) t
      WHERE end_date IS DISTINCT FROM next_start""",
    "gold_future_check": f"""SELECT {VERSION} FROM ({_history("(SELECT *, md5(city) AS hash_diff FROM cdc_silver WHERE customer_id IS NOT NULL)")}) d
      WHERE start_date > {AS_OF}""",
    "mon_throughput": """SELECT run_timestamp AS run_day, count(*) AS runs, CAST(sum(records_processed) AS BIGINT) AS records_processed,
      CAST(sum(records_failed) AS BIGINT) AS records_failed, CAST(sum(records_loaded) AS BIGINT) AS records_loaded
      FROM run_log GROUP BY run_timestamp""",
    "mon_sla_status": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY pipeline_name ORDER BY check_time DESC) AS rn
      FROM sla_log) t WHERE rn = 1""",
    "mon_sla_breaches": """SELECT pipeline_name, count(*) AS breaches, max(freshness_minutes) AS worst_minutes
      FROM sla_log WHERE status = 'SLA_BREACH' GROUP BY pipeline_name""",
    "mon_dq_breakdown": "SELECT dq_error_reason, count(*) AS failures FROM violations GROUP BY dq_error_reason",
    "recent_failed_records": "SELECT * FROM violations ORDER BY event_time DESC, event_id, dq_error_reason LIMIT 50",
    "mon_breach_episodes": """SELECT pipeline_name, CAST(episode AS BIGINT) AS episode, min(check_time) AS first_breach,
        max(check_time) AS last_breach, count(*) AS checks, max(freshness_minutes) AS longest_minutes,
        bool_or(following IS NULL) AS is_open
      FROM (SELECT *, sum(opens) OVER (PARTITION BY pipeline_name ORDER BY check_time) AS episode FROM (
        SELECT *, CASE WHEN status = 'SLA_BREACH' AND coalesce(lag(status) OVER w, 'OK') <> 'SLA_BREACH' THEN 1 ELSE 0 END AS opens,
          lead(status) OVER w AS following
        FROM sla_log WINDOW w AS (PARTITION BY pipeline_name ORDER BY check_time)) a) b
      WHERE status = 'SLA_BREACH' GROUP BY pipeline_name, episode""",
    "mon_dq_rollup": """SELECT dq_error_reason, failed_day, count(*) AS failures, grouping_id(dq_error_reason, failed_day) AS level
      FROM (SELECT dq_error_reason, date_trunc('day', event_time) AS failed_day FROM violations) v
      GROUP BY CUBE (dq_error_reason, failed_day)""",
    "mon_sketches": """SELECT date_trunc('week', ts) AS period, count(*) AS "rows", count(DISTINCT user_id) AS exact_customers,
      true AS customers_close, true AS p50_close, true AS p95_close FROM events GROUP BY 1""",
    "versions_per_day": """SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS day,
        (SELECT count(*) FROM cust_hist WHERE start_date <= d AND (end_date IS NULL OR d < end_date)) AS versions
      FROM (SELECT unnest(generate_series(min(date_trunc('day', start_date)), max(date_trunc('day', start_date)), INTERVAL 1 DAY)) AS d
        FROM cust_hist) c""",
    "mon_reliability": """SELECT pipeline_name, run_timestamp AS run_day, CAST(records_processed AS BIGINT) AS records_processed,
      CAST(records_failed AS BIGINT) AS records_failed,
      CAST(records_failed AS DOUBLE) / CAST(records_processed AS DOUBLE) AS failure_rate,
      CAST(sum(records_processed) OVER w AS BIGINT) AS processed_so_far, CAST(sum(records_failed) OVER w AS BIGINT) AS failed_so_far
      FROM run_log WINDOW w AS (PARTITION BY pipeline_name ORDER BY run_timestamp)""",
}

ORACLES = {name: with_views(body) for name, body in BODIES.items()}

"""DuckDB SQL oracles: for each catalogue query, the same answer from the flat tables."""

from __future__ import annotations

_LINE_COLS = """CAST(l.l_linenumber AS BIGINT) AS l_linenumber, l.l_partkey, l.l_suppkey,
  l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus,
  l.l_shipdate"""

_ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

_EVENTS_IN_RANGE = ("ts BETWEEN TIMESTAMP '2024-01-01 00:00:00' "
                    "AND TIMESTAMP '2024-01-30 23:59:59.999'")

# request windows of 7 days from 2024-01-01: window index, start, page count
_WINDOWED = f"""
  e AS (SELECT *, CAST(floor(datediff('microsecond', TIMESTAMP '2024-01-01', ts)
                             / (7 * 86400 * 1e6)) AS BIGINT) AS w
        FROM events WHERE {_EVENTS_IN_RANGE}),
  h AS (SELECT w, count(*) AS hits FROM e GROUP BY w),
  p AS (SELECT w, TIMESTAMP '2024-01-01' + w * INTERVAL 7 DAY AS window_start, hits,
               greatest(CAST(ceil(hits / 100.0) AS BIGINT), 1) AS npages FROM h)"""

_PRICES = " UNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {i} AS step, l_returnflag AS flag, {e} AS price FROM lineitem"
    for i, e in enumerate(("l_extendedprice", "l_extendedprice * (1 - l_discount)",
                           "l_extendedprice * (1 - l_discount) * (1 + l_tax)")))

# two loads of orders, the second (from 1998 on) with twice the price and one more of each line
_TWO_LOADS = """SELECT o.o_orderkey,
    CASE WHEN o.o_orderdate >= TIMESTAMP '1998-01-01' THEN o.o_totalprice * 2 ELSE o.o_totalprice END AS o_totalprice,
    CAST(l.l_linenumber AS BIGINT) AS l_linenumber, l.l_partkey, l.l_suppkey, l.l_shipdate,
    CASE WHEN o.o_orderdate >= TIMESTAMP '1998-01-01' THEN l.l_quantity + 1 ELSE l.l_quantity END AS l_quantity
  FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey"""

ORACLE: dict[str, str] = {
    "parse_declared": f"SELECT {_ORDER_COLS} FROM orders",
    "parse_inferred": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') AS o_orderdate, o_orderpriority FROM orders""",
    "complex_to_json": """SELECT o.o_orderkey, c.n AS n_lines FROM orders o
  LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) c
  ON c.l_orderkey = o.o_orderkey""",
    "enforce_typed": """SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey, o_orderstatus,
  CAST(o_totalprice AS DECIMAL(20,2)) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
  o_orderpriority FROM orders""",
    "enforce_missing": """SELECT o_orderkey, CAST(NULL AS VARCHAR) AS o_comment,
  CAST(NULL AS TIMESTAMP) AS o_clerk, CAST(NULL AS BIGINT) AS o_shippriority,
  CAST(NULL AS BOOLEAN) AS o_flag, CAST(NULL AS DOUBLE) AS o_rate,
  CAST(NULL AS DECIMAL(20,2)) AS o_fee, CAST(NULL AS DATE) AS o_day,
  CAST(NULL AS VARCHAR) AS o_tags FROM orders""",
    "enforce_order": "SELECT o_orderpriority, o_orderkey, o_orderstatus FROM orders",
    "enforce_string": "SELECT o_orderkey, o_orderstatus, CAST(NULL AS VARCHAR) AS o_comment FROM orders",
    "schema_drift": """SELECT * FROM (VALUES
  ('orders_main', 'o_comment', 'missing', 'string', NULL),
  ('orders_main', 'o_clerk', 'missing', 'string', NULL),
  ('orders_main', 'lines', 'extra', NULL, 'array<struct<l_discount:double,l_extendedprice:double,'
    || 'l_linenumber:bigint,l_linestatus:string,l_partkey:bigint,l_quantity:double,'
    || 'l_returnflag:string,l_shipdate:string,l_suppkey:bigint,l_tax:double>>'),
  ('orders_main', 'o_custkey', 'extra', NULL, 'bigint'),
  ('orders_main', 'o_orderdate', 'extra', NULL, 'string'),
  ('orders_main', 'o_orderpriority', 'extra', NULL, 'string'),
  ('orders_main', 'o_totalprice', 'extra', NULL, 'double'),
  ('orders_main', 'partkeys', 'extra', NULL, 'array<bigint>'))
  AS t("table", "column", kind, declared, actual)""",
    "schema_drift_nested": """SELECT * FROM (VALUES
  ('customer_order_lines', 'prices', 'extra', CAST(NULL AS VARCHAR),
   'array<struct<flag:string,price:double,step:bigint>>'))
  AS t("table", "column", kind, declared, actual)""",
    "unnest_1": f"SELECT l.l_orderkey AS o_orderkey, {_LINE_COLS} FROM lineitem l",
    "unnest_sliced": f"SELECT l.l_orderkey AS o_orderkey, {_LINE_COLS} FROM lineitem l",
    "unnest_scalar": "SELECT l_orderkey AS o_orderkey, l_partkey AS partkeys_exploded FROM lineitem",
    "unnest_empty": """SELECT o_orderkey FROM orders o
  WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""",
    "unnest_2": f"""SELECT c.c_custkey, l.l_orderkey AS o_orderkey, {_LINE_COLS}
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey""",
    "unnest_3": f"""SELECT c.c_custkey, m.l_orderkey AS o_orderkey,
  CAST(m.l_linenumber AS BIGINT) AS l_linenumber, m.l_partkey, m.l_suppkey,
  CAST(m.step AS BIGINT) AS step, m.flag, m.price
  FROM ({_PRICES}) m JOIN orders o ON o.o_orderkey = m.l_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey""",
    "unnest_text": "SELECT conv_id, turn, role, text FROM conversations",
    "parse_string_column": """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k
  FROM events WHERE props IS NOT NULL""",
    "fan_out": """SELECT 'orders_main' AS "table", count(*) AS rows, 8 AS cols FROM orders
  UNION ALL SELECT 'order_lines', count(*), 11 FROM lineitem
  UNION ALL SELECT 'order_partkeys', count(*), 2 FROM lineitem""",
    "table_select": """SELECT 'order_partkeys' AS "table", count(*) AS rows, 2 AS cols FROM lineitem""",
    "table_counts": """SELECT 'customers_main' AS "table", count(*) AS rows, 6 AS cols FROM customer
  UNION ALL SELECT 'customer_orders', count(*), 7 FROM orders o
    JOIN customer c ON c.c_custkey = o.o_custkey
  UNION ALL SELECT 'customer_order_lines', count(*), 12 FROM lineitem l
    JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
  UNION ALL SELECT 'customer_order_line_prices', 3 * count(*), 8 FROM lineitem l
    JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey""",
    "window_coverage": f"""WITH w AS (
    SELECT i AS "window", TIMESTAMP '2024-01-01' + i * INTERVAL 7 DAY AS window_start,
      least(TIMESTAMP '2024-01-01' + (i + 1) * INTERVAL 7 DAY - INTERVAL 1 SECOND,
            TIMESTAMP '2024-01-30 23:59:59.999') AS window_end
    FROM range(5) t(i)),
  e AS (SELECT ts FROM events WHERE {_EVENTS_IN_RANGE})
  SELECT w."window", w.window_start, w.window_end, count(e.ts) AS records,
    count(e.ts) FILTER (WHERE e.ts > w.window_end) AS in_gap
  FROM w LEFT JOIN e ON e.ts >= w.window_start AND e.ts < w.window_start + INTERVAL 7 DAY
  GROUP BY w."window", w.window_start, w.window_end""",
    "expected_pages": f"""WITH d AS (SELECT date_trunc('day', ts) AS window_start, count(*) AS hits
    FROM events WHERE {_EVENTS_IN_RANGE} GROUP BY 1)
  SELECT d.window_start, CAST(g.page AS INTEGER) AS page
  FROM d, generate_series(1, greatest(CAST(ceil(d.hits / 100.0) AS BIGINT), 1)) g(page)""",
    "envelope_flatten": f"""SELECT event_id, ts, user_id, event_type, value, props
  FROM events WHERE {_EVENTS_IN_RANGE}""",
    "page_concat": f"""WITH {_WINDOWED}
  SELECT p.window_start, CAST(1 + e.event_id % p.npages AS INTEGER) AS page, e.event_id
  FROM e JOIN p ON p.w = e.w""",
    "record_ordinal": f"""WITH {_WINDOWED},
  r AS (SELECT p.window_start, CAST(1 + e.event_id % p.npages AS INTEGER) AS page, e.event_id FROM e JOIN p ON p.w = e.w)
  SELECT window_start, page, CAST(row_number() OVER (PARTITION BY window_start, page ORDER BY event_id) - 1 AS INTEGER) AS position,
    row_number() OVER (ORDER BY window_start, page, event_id) AS ordinal, event_id FROM r""",
    "page_drift": f"""WITH {_WINDOWED},
  f AS (SELECT p.w, count(*) AS n FROM e JOIN p ON p.w = e.w WHERE e.event_id % p.npages = 0 GROUP BY p.w)
  SELECT p.window_start, 1 AS page, 2 AS next_page, 2::BIGINT AS served_twice, 0::BIGINT AS lost
    FROM p JOIN f ON f.w = p.w WHERE p.npages >= 2 AND f.n > 1
  UNION ALL SELECT window_start, 2, 3, 0, 3 FROM p WHERE npages >= 3""",
    "page_completeness": f"""WITH {_WINDOWED},
  x AS (SELECT p.window_start, CAST(g.page AS INTEGER) AS page, p.npages FROM p,
        generate_series(1, p.npages) g(page)),
  r AS (SELECT p.window_start, CAST(1 + e.event_id % p.npages AS INTEGER) AS page, count(*) AS n
        FROM e JOIN p ON p.w = e.w GROUP BY 1, 2)
  SELECT x.window_start, x.page,
    CASE WHEN x.page = x.npages AND x.npages > 1 THEN 'missing' ELSE 'received' END AS status,
    CASE WHEN x.page = x.npages AND x.npages > 1 THEN 0 ELSE coalesce(r.n, 0) END AS records
  FROM x LEFT JOIN r ON r.window_start = x.window_start AND r.page = x.page""",
    "landing_roundtrip": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "pages_ingest": f"""SELECT event_id, ts, user_id, event_type, value, props
  FROM events WHERE {_EVENTS_IN_RANGE}""",
    "bronze_append": """SELECT 'batch-a' AS source_file, count(*) AS rows FROM events
    WHERE ts < TIMESTAMP '2024-01-15'
  UNION ALL SELECT 'batch-b', count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-15'""",
    "backfill_filter": """SELECT event_id FROM events
  WHERE ts BETWEEN TIMESTAMP '2024-01-08 00:00:00' AND TIMESTAMP '2024-01-14 23:59:59.999999'""",
    "backfill_no_column": "SELECT event_id FROM events",
    "upsert_create": f"SELECT {_ORDER_COLS} FROM orders",
    "upsert_main": f"""WITH t AS (SELECT {_ORDER_COLS} FROM orders
    WHERE o_orderdate < TIMESTAMP '1999-01-01'),
  s AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 AS o_totalprice,
    o_orderdate, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
  SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)
  UNION ALL SELECT * FROM s""",
    "upsert_child": f"""WITH li AS (SELECT l.l_orderkey AS o_orderkey, {_LINE_COLS} FROM lineitem l),
  t AS (SELECT * FROM li WHERE l_shipdate < TIMESTAMP '1999-01-01'),
  s AS (SELECT * REPLACE (l_quantity + 1 AS l_quantity) FROM li
    WHERE l_shipdate >= TIMESTAMP '1998-01-01')
  SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey
    AND s.l_linenumber = t.l_linenumber AND s.l_partkey = t.l_partkey
    AND s.l_suppkey = t.l_suppkey AND s.l_shipdate = t.l_shipdate)
  UNION ALL SELECT * FROM s""",
    "upsert_partitioned": f"""WITH li AS (SELECT l.l_orderkey AS o_orderkey, {_LINE_COLS} FROM lineitem l),
  t AS (SELECT * FROM li WHERE l_shipdate < TIMESTAMP '1999-01-01'),
  s AS (SELECT * REPLACE (l_quantity + 1 AS l_quantity) FROM li
    WHERE l_shipdate >= TIMESTAMP '1998-01-01')
  SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey
    AND s.l_linenumber = t.l_linenumber AND s.l_partkey = t.l_partkey
    AND s.l_suppkey = t.l_suppkey AND s.l_shipdate = t.l_shipdate)
  UNION ALL SELECT * FROM s""",
    "upsert_children_replaced": f"""SELECT l.l_orderkey AS o_orderkey,
    {_LINE_COLS.replace("l.l_quantity", "CASE WHEN l.l_orderkey % 3 = 0 AND l.l_linenumber = 3 THEN l.l_quantity + 1 ELSE l.l_quantity END AS l_quantity")}
  FROM lineitem l WHERE l.l_orderkey % 3 <> 0 OR (l.l_orderkey % 9 <> 0 AND l.l_linenumber <> 2)""",
    "upsert_changes": """WITH l AS (SELECT l_orderkey AS k, l_linenumber AS n FROM lineitem),
  s AS (SELECT * FROM l WHERE k % 3 = 0 AND k % 9 <> 0 AND n <> 2),
  c(load, change, rows) AS (
    SELECT 'create', 'inserted', (SELECT count(*) FROM l WHERE k % 5 <> 0)
    UNION ALL SELECT 'load', 'inserted', (SELECT count(*) FROM s WHERE k % 5 = 0)
    UNION ALL SELECT 'load', 'updated', (SELECT count(*) FROM s WHERE k % 5 <> 0 AND n = 3)
    UNION ALL SELECT 'load', 'unchanged', (SELECT count(*) FROM s WHERE k % 5 <> 0 AND n <> 3)
    UNION ALL SELECT 'again', 'unchanged', (SELECT count(*) FROM s)
    UNION ALL SELECT 'replace', 'unchanged', (SELECT count(*) FROM s)
    UNION ALL SELECT 'replace', 'deleted', (SELECT count(*) FROM l WHERE k % 5 <> 0 AND k % 3 = 0 AND (k % 9 = 0 OR n = 2)))
  SELECT x.load, y.change, coalesce(c.rows, 0)::BIGINT AS partitioned, coalesce(c.rows, 0)::BIGINT AS versioned
  FROM (VALUES ('create'), ('load'), ('again'), ('replace')) x(load)
  CROSS JOIN (VALUES ('inserted'), ('updated'), ('unchanged'), ('deleted')) y(change)
  LEFT JOIN c ON c.load = x.load AND c.change = y.change""",
    "upsert_null_key": """WITH o AS (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END
      AS o_key, o_orderkey, o_totalprice, o_orderdate FROM orders),
  t AS (SELECT o_key, o_orderkey, o_totalprice FROM o WHERE o_orderdate < TIMESTAMP '1999-01-01'),
  s AS (SELECT o_key, o_orderkey, o_totalprice * 2 AS o_totalprice FROM o
    WHERE o_orderdate >= TIMESTAMP '1998-01-01')
  SELECT * FROM t WHERE o_key IS NULL
    OR NOT EXISTS (SELECT 1 FROM s WHERE s.o_key = t.o_key)
  UNION ALL SELECT * FROM s""",
    "merge_conflicts": """WITH li AS (SELECT l_orderkey AS o_orderkey,
      CAST(l_linenumber AS BIGINT) AS l_linenumber, l_shipdate FROM lineitem),
  d AS (SELECT o_orderkey, l_linenumber, count(*) AS n FROM li
    WHERE l_shipdate >= TIMESTAMP '1998-01-01' GROUP BY 1, 2 HAVING count(*) > 1)
  SELECT * FROM d WHERE EXISTS (SELECT 1 FROM li t WHERE t.l_shipdate < TIMESTAMP '1999-01-01'
    AND t.o_orderkey = d.o_orderkey AND t.l_linenumber = d.l_linenumber)""",
    "upsert_partitioned_null": f"""WITH o AS (SELECT {_ORDER_COLS},
      CASE WHEN o_custkey % 7 <> 0 THEN o_custkey % 1201 END AS bucket FROM orders),
  t AS (SELECT * FROM o WHERE o_orderdate < TIMESTAMP '1999-01-01'),
  s AS (SELECT * REPLACE (o_totalprice * 2 AS o_totalprice) FROM o WHERE o_orderdate >= TIMESTAMP '1998-01-01')
  SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)
  UNION ALL SELECT * FROM s""",
    "incremental_run": _TWO_LOADS,
    "backfill_two_loads": _TWO_LOADS,
    "ingest_rerun": f"SELECT {_ORDER_COLS}, (SELECT count(*) FROM orders) AS bronze_rows FROM orders",
    "run_resumed": """SELECT o.o_orderkey, o.o_totalprice, CAST(l.l_linenumber AS BIGINT) AS l_linenumber, l.l_partkey, l.l_suppkey,
  l.l_shipdate, l.l_quantity, 'order_lines' AS written FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey""",
    "bronze_two_landings": """SELECT o_orderkey, o_custkey, o_totalprice,
  CASE WHEN o_orderkey % 2 = 0 THEN 'first' ELSE 'second' END AS landing FROM orders""",
    "backfill_ties": """SELECT o_orderkey, o_custkey, o_totalprice *
    CASE WHEN o_orderkey % 5 = 0 THEN 3 WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END AS o_totalprice FROM orders""",
    "cast_losses": """WITH loads AS (SELECT *, 1 AS load FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'
    UNION ALL SELECT *, 2 FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
  lines AS (SELECT o.load, l.* FROM loads o JOIN lineitem l ON l.l_orderkey = o.o_orderkey),
  c AS (SELECT load, 'orders_main' AS "table", 'o_orderstatus' AS "column", count(*) FILTER (WHERE o_orderstatus <> 'F') AS lost
      FROM loads GROUP BY load
    UNION ALL SELECT load, 'orders_main', 'o_orderpriority', count(*) FROM loads GROUP BY load
    UNION ALL SELECT load, 'order_lines', 'l_returnflag', count(*) FILTER (WHERE l_returnflag <> 'N') FROM lines GROUP BY load
    UNION ALL SELECT load, 'order_lines', 'l_linestatus', count(*) FROM lines GROUP BY load)
  SELECT "table", "column", lost, load FROM c WHERE lost > 0""",
    "quarantine": """SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'malformed' ELSE 'loaded' END AS outcome
  FROM events""",
    "preview": """SELECT 'orders_main' AS "table", least(10, count(*)) AS rows FROM orders
  UNION ALL SELECT 'order_lines', least(10, count(*)) FROM lineitem""",
    "landing_gate": f"""WITH {_WINDOWED},
  r AS (SELECT p.w, CAST(1 + e.event_id % p.npages AS INTEGER) AS page, count(*) AS n
        FROM e JOIN p ON p.w = e.w GROUP BY 1, 2),
  x AS (SELECT p.w, p.window_start, p.hits, CAST(g.page AS INTEGER) AS page FROM p, generate_series(1, p.npages) g(page)
        WHERE p.w <> 1),
  y AS (SELECT x.*, CASE WHEN x.w = 0 AND x.page = 2 THEN 'missing' WHEN x.w = 0 AND x.page = 3 THEN 'empty'
      WHEN x.w = 0 AND x.page = 4 THEN 'corrupt' WHEN x.w = 0 AND x.page = 5 THEN 'duplicate'
      WHEN x.w = 4 THEN 'no_total' ELSE 'received' END AS status, coalesce(r.n, 0) AS n
    FROM x LEFT JOIN r ON r.w = x.w AND r.page = x.page),
  z AS (SELECT *, CASE WHEN status IN ('missing', 'empty', 'corrupt') THEN 0
      WHEN status = 'duplicate' THEN 2 * n ELSE n END AS records FROM y)
  SELECT window_start, page, status, records, CAST(sum(records) OVER (PARTITION BY w) AS BIGINT) AS received,
    CASE WHEN w <> 4 THEN hits END AS hits FROM z
  UNION ALL SELECT TIMESTAMP '2024-01-08', NULL, 'missing_window', 0, 0, NULL""",
    "backfill_rebuild": f"""SELECT l.l_orderkey AS o_orderkey, {_LINE_COLS.replace("l.l_quantity", "l.l_quantity + 1 AS l_quantity")}
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
  WHERE o.o_orderdate >= TIMESTAMP '1998-01-01'""",
    "silver_summary": """SELECT 'orders_main' AS "table", count(*) AS rows, 8 AS cols,
    'struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderdate:timestamp,'
    || 'o_orderpriority:string,lines:string,partkeys:string>' AS schema FROM orders
  UNION ALL SELECT 'order_lines', count(*), 11, 'struct<o_orderkey:bigint,l_linenumber:bigint,l_partkey:bigint,'
    || 'l_suppkey:bigint,l_quantity:double,l_extendedprice:double,l_discount:double,l_tax:double,'
    || 'l_returnflag:string,l_linestatus:string,l_shipdate:timestamp>' FROM lineitem""",
}

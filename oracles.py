"""DuckDB SQL for every registered query, written independently of the Spark expressions."""

from __future__ import annotations

# Shared table expressions, each built on the ones before it.
COMMON = r"""
WITH raw_orders AS (
  SELECT CASE WHEN l_orderkey % 101 = 0 THEN NULL
              ELSE 'ORD-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS order_id,
         CASE WHEN l_orderkey % 103 = 1 THEN NULL ELSE 'SKU-' || CAST(l_partkey AS VARCHAR) END AS product_id,
         CASE WHEN l_orderkey % 89 = 2 THEN NULL ELSE c_mktsegment END AS channel,
         CASE l_orderkey % 97 WHEN 3 THEN '0' WHEN 4 THEN '-3' WHEN 5 THEN 'abc' WHEN 6 THEN NULL
              ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS quantity,
         CASE l_orderkey % 107 WHEN 7 THEN '0' WHEN 8 THEN NULL
              ELSE CAST(CAST(FLOOR(l_extendedprice / l_quantity) AS BIGINT) AS VARCHAR) END AS unit_price,
         CASE WHEN l_orderkey % 109 = 9 THEN 'NOT-A-DATE'
              ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) || 'T'
                   || LPAD(CAST(l_orderkey % 24 AS VARCHAR), 2, '0') || ':15:00Z' END AS ordered_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
),
raw_inventory AS (
  SELECT CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE 'SKU-' || CAST(l_partkey AS VARCHAR) END AS product_id,
         CASE WHEN (l_partkey + l_suppkey) % 53 = 1 THEN NULL
              ELSE 'WH-' || CAST(l_suppkey % 5 AS VARCHAR) END AS warehouse,
         CASE WHEN l_suppkey % (1 + l_partkey % 4) = 0
              THEN CAST((l_partkey * 31 + l_suppkey * 17) % 23 - 3 AS VARCHAR) ELSE '0' END AS quantity,
         CASE WHEN (l_partkey + l_suppkey) % 59 = 2 THEN 'BAD-TIMESTAMP'
              ELSE CAST(CAST(MAX(l_shipdate) AS DATE) AS VARCHAR) || 'T00:00:00Z' END AS updated_at
  FROM lineitem GROUP BY l_partkey, l_suppkey
),
raw_price_events AS (
  SELECT CASE WHEN event_id % 43 = 0 THEN NULL ELSE 'SKU-' || CAST(user_id AS VARCHAR) END AS product_id,
         CASE WHEN event_id % 47 = 1 THEN '0'
              ELSE CAST(CAST(ROUND(value * 100) AS BIGINT) AS VARCHAR) END AS old_price,
         CASE WHEN event_id % 61 = 2 THEN NULL
              ELSE CAST(CAST(FLOOR(CAST(ROUND(value * 100) AS BIGINT) * (70 + event_id % 71) / 100) AS BIGINT)
                        AS VARCHAR) END AS new_price,
         CASE WHEN event_id % 67 = 3 THEN 'INVALID'
              ELSE SUBSTR(CAST(ts AS VARCHAR), 1, 10) || 'T' || SUBSTR(CAST(ts AS VARCHAR), 12, 8) || 'Z'
              END AS changed_at,
         event_type AS source
  FROM events
),
typed_orders AS (
  SELECT *,
         CASE WHEN regexp_full_match(trim(quantity), '[+-]?[0-9]+') THEN TRY_CAST(quantity AS BIGINT) END AS quantity_n,
         TRY_CAST(unit_price AS DOUBLE) AS unit_price_n,
         CASE WHEN regexp_matches(ordered_at, '^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}')
              THEN TRY_CAST(ordered_at AS TIMESTAMP) END AS ordered_at_t
  FROM raw_orders
),
labelled_rows AS (
  SELECT *,
         CASE WHEN order_id IS NULL THEN 'MISSING_ORDER_ID'
              WHEN product_id IS NULL THEN 'MISSING_PRODUCT_ID'
              WHEN quantity_n IS NULL OR quantity_n <= 0 THEN 'INVALID_QUANTITY'
              WHEN unit_price_n IS NULL OR NOT isfinite(unit_price_n) OR unit_price_n <= 0 THEN 'INVALID_PRICE'
              WHEN ordered_at_t IS NULL THEN 'INVALID_TIMESTAMP' END AS reason
  FROM typed_orders
),
ranked_orders AS (
  SELECT *, row_number() OVER (
           PARTITION BY order_id
           ORDER BY ordered_at_t DESC NULLS LAST, product_id DESC NULLS LAST, channel DESC NULLS LAST,
                    quantity DESC NULLS LAST, unit_price DESC NULLS LAST, ordered_at DESC NULLS LAST) AS rn
  FROM labelled_rows WHERE reason IS NULL
),
labelled_orders AS (
  SELECT * EXCLUDE (reason), reason FROM labelled_rows WHERE reason IS NOT NULL
  UNION ALL
  SELECT * EXCLUDE (rn, reason), CASE WHEN rn > 1 THEN 'DUPLICATE_ORDER' END FROM ranked_orders
),
clean_orders AS (
  SELECT order_id, product_id, channel, quantity_n AS quantity, unit_price_n AS unit_price,
         ordered_at_t AS ordered_at, '2026-01-01T00:00:00Z' AS _ingested_at, 'lineitem' AS _source_file
  FROM labelled_orders WHERE reason IS NULL
),
quarantine_orders AS (
  SELECT order_id, product_id, channel, quantity, unit_price, ordered_at,
         '2026-01-01T00:00:00Z' AS _ingested_at, 'lineitem' AS _source_file, reason AS _quarantine_reason
  FROM labelled_orders WHERE reason IS NOT NULL
),
labelled_inventory AS (
  SELECT *,
         CASE WHEN regexp_full_match(trim(quantity), '[+-]?[0-9]+') THEN TRY_CAST(quantity AS BIGINT) END AS quantity_n,
         CASE WHEN regexp_matches(updated_at, '^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}')
              THEN TRY_CAST(updated_at AS TIMESTAMP) END AS updated_at_t,
         CASE WHEN product_id IS NULL THEN 'MISSING_PRODUCT_ID'
              WHEN warehouse IS NULL THEN 'MISSING_WAREHOUSE'
              WHEN updated_at_t IS NULL THEN 'INVALID_TIMESTAMP' END AS reason
  FROM raw_inventory
),
clean_inventory AS (
  SELECT product_id, warehouse, quantity_n AS quantity, updated_at_t AS updated_at,
         quantity_n < 0 AS negative_stock,
         '2026-01-01T00:00:00Z' AS _ingested_at, 'lineitem' AS _source_file
  FROM labelled_inventory WHERE reason IS NULL
),
quarantine_inventory AS (
  SELECT product_id, warehouse, quantity, updated_at,
         '2026-01-01T00:00:00Z' AS _ingested_at, 'lineitem' AS _source_file, reason AS _quarantine_reason
  FROM labelled_inventory WHERE reason IS NOT NULL
),
labelled_price_events AS (
  SELECT *,
         TRY_CAST(old_price AS DOUBLE) AS old_n, TRY_CAST(new_price AS DOUBLE) AS new_n,
         CASE WHEN regexp_matches(changed_at, '^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}')
              THEN TRY_CAST(changed_at AS TIMESTAMP) END AS changed_at_t,
         CASE WHEN product_id IS NULL THEN 'MISSING_PRODUCT_ID'
              WHEN old_n IS NULL OR NOT isfinite(old_n) OR old_n <= 0 THEN 'INVALID_OLD_PRICE'
              WHEN new_n IS NULL OR NOT isfinite(new_n) OR new_n <= 0 THEN 'INVALID_NEW_PRICE'
              WHEN changed_at_t IS NULL THEN 'INVALID_TIMESTAMP' END AS reason
  FROM raw_price_events
),
clean_price_events AS (
  SELECT product_id, old_n AS old_price, new_n AS new_price, changed_at_t AS changed_at, source,
         '2026-01-01T00:00:00Z' AS _ingested_at, 'events' AS _source_file
  FROM labelled_price_events WHERE reason IS NULL
),
quarantine_price_events AS (
  SELECT product_id, old_price, new_price, changed_at, source,
         '2026-01-01T00:00:00Z' AS _ingested_at, 'events' AS _source_file, reason AS _quarantine_reason
  FROM labelled_price_events WHERE reason IS NOT NULL
),
daily_revenue AS (
  SELECT CAST(ordered_at AS DATE) AS date, channel, COUNT(*) AS order_count,
         CAST(SUM(quantity) AS BIGINT) AS units_sold, SUM(quantity * unit_price) AS gross_revenue
  FROM clean_orders GROUP BY 1, 2
),
sales_velocity AS (
  SELECT product_id, CAST(SUM(quantity) AS BIGINT) AS total_units_sold,
         COUNT(DISTINCT CAST(ordered_at AS DATE)) AS active_days,
         CAST(SUM(quantity) AS DOUBLE) / COUNT(DISTINCT CAST(ordered_at AS DATE)) AS avg_daily_sales
  FROM clean_orders GROUP BY product_id
),
current_stock AS (
  SELECT product_id, CAST(SUM(quantity) AS BIGINT) AS current_quantity FROM clean_inventory GROUP BY product_id
),
current_stock_latest AS (
  SELECT product_id, CAST(SUM(quantity) AS BIGINT) AS current_quantity
  FROM (SELECT *, row_number() OVER (PARTITION BY product_id, warehouse
               ORDER BY updated_at DESC NULLS LAST, quantity DESC NULLS LAST) AS rn FROM clean_inventory)
  WHERE rn = 1 GROUP BY product_id
),
inventory_risk AS (
  SELECT s.product_id, current_quantity, avg_daily_sales, current_quantity / avg_daily_sales AS days_of_stock,
         CASE WHEN current_quantity / avg_daily_sales < 3 THEN 'CRITICAL'
              WHEN current_quantity / avg_daily_sales < 7 THEN 'HIGH' ELSE 'NORMAL' END AS risk_level
  FROM current_stock s LEFT JOIN sales_velocity v ON s.product_id = v.product_id
),
price_change_ratio AS (
  SELECT product_id, old_price, new_price, (new_price - old_price) / old_price AS price_change_ratio,
         changed_at, source
  FROM clean_price_events
),
price_anomalies AS (
  SELECT product_id, old_price, new_price, price_change_ratio, changed_at, source
  FROM price_change_ratio
  WHERE abs(CAST(new_price AS DECIMAL(18,4)) - CAST(old_price AS DECIMAL(18,4))) * 10
        >= CAST(old_price AS DECIMAL(18,4)) * 3
),
order_rows AS (SELECT order_id, product_id, channel, quantity, unit_price FROM clean_orders),
batch_1 AS (SELECT * FROM order_rows WHERE channel IS DISTINCT FROM 'FURNITURE'),
batch_2 AS (
  SELECT order_id, product_id, channel, quantity + CASE WHEN channel = 'BUILDING' THEN 1 ELSE 0 END AS quantity, unit_price
  FROM order_rows WHERE channel IN ('FURNITURE', 'BUILDING', 'MACHINERY')
),
version_1 AS (
  SELECT order_id, product_id, channel, quantity + CASE WHEN channel = 'BUILDING' THEN 1 ELSE 0 END AS quantity, unit_price
  FROM order_rows
),
version_2 AS (
  SELECT order_id, product_id, channel, quantity + CASE WHEN channel = 'HOUSEHOLD' THEN 2 ELSE 0 END AS quantity, unit_price
  FROM version_1
),
log AS (
  SELECT *, 0 AS version, 'insert' AS operation, TIMESTAMP '2026-01-01 00:00:00' AS committed_at FROM batch_1
  UNION ALL
  SELECT *, 1, CASE WHEN channel = 'FURNITURE' THEN 'insert' ELSE 'update' END, TIMESTAMP '2026-01-02 00:00:00'
  FROM batch_2 WHERE channel <> 'MACHINERY'
  UNION ALL
  SELECT order_id, product_id, channel, quantity + 2, unit_price, 2, 'update', TIMESTAMP '2026-01-10 00:00:00'
  FROM order_rows WHERE channel = 'HOUSEHOLD'
)
"""

BAD_LINE = "SELECT {nulls}, {line} AS _corrupt_record, TRUE AS traced"


def _union(*selects: str) -> str:
    return "\nUNION ALL\n".join(selects)


def _bad_lines(columns: list[str], lines: list[tuple[dict[str, str], str]]) -> list[str]:
    out = []
    for values, line in lines:
        cells = [f"'{values[c]}'" if c in values else "NULL" for c in columns]
        named = ", ".join(f"{cell} AS {c}" for cell, c in zip(cells, columns))
        out.append(f"SELECT {named}, '{line}' AS _corrupt_record, TRUE AS traced")
    return out


_ORDER_COLUMNS = ["order_id", "product_id", "channel", "quantity", "unit_price", "ordered_at", "extra_field"]
_STOCK_COLUMNS = ["product_id", "warehouse", "quantity", "updated_at"]
_PRICE_COLUMNS = ["product_id", "old_price", "new_price", "changed_at", "source"]

_INGEST_ORDERS = _union(
    "SELECT order_id, product_id, channel, quantity, unit_price, ordered_at, CAST(NULL AS VARCHAR) AS extra_field, "
    "CAST(NULL AS VARCHAR) AS _corrupt_record, TRUE AS traced FROM raw_orders",
    *_bad_lines(_ORDER_COLUMNS, [({}, "not json"), ({}, '{"order_id": "ORD-1", "quan'), ({}, "[1, 2")]),
)
_INGEST_INVENTORY = _union(
    "SELECT *, CAST(NULL AS VARCHAR) AS _corrupt_record, TRUE AS traced FROM raw_inventory",
    *_bad_lines(
        _STOCK_COLUMNS,
        [
            ({"product_id": "SKU-1"}, "SKU-1"),
            ({"product_id": "SKU-1", "warehouse": "WH-1"}, "SKU-1,WH-1"),
            (
                {"product_id": "SKU-1", "warehouse": "WH-1", "quantity": "5", "updated_at": "BAD-TIMESTAMP"},
                "SKU-1,WH-1,5,BAD-TIMESTAMP,surplus",
            ),
        ],
    ),
)
_INGEST_PRICES = _union(
    "SELECT *, CAST(NULL AS VARCHAR) AS _corrupt_record, TRUE AS traced FROM raw_price_events",
    *_bad_lines(_PRICE_COLUMNS, [({}, "not json"), ({}, '{"product_id": "SKU-1", "old'), ({}, "[1, 2")]),
)

# Every feed read from files has three more rows than its table, all of them quarantined.
_FULL_RUN = _union(
    *[f"SELECT 'raw_{f}' AS table_name, COUNT(*) + 3 AS rows FROM raw_{f}" for f in ("orders", "inventory", "price_events")],
    *[f"SELECT 'clean_{f}', COUNT(*) FROM clean_{f}" for f in ("orders", "inventory", "price_events")],
    *[f"SELECT 'quarantined_{f}', COUNT(*) + 3 FROM quarantine_{f}" for f in ("orders", "inventory", "price_events")],
    *[f"SELECT '{m}', COUNT(*) FROM {m}" for m in ("daily_revenue", "inventory_risk", "price_anomalies")],
)

_RUN_TOTALS = """
SELECT (SELECT COUNT(*) + 3 FROM raw_orders) AS raw_orders,
       (SELECT COUNT(*) + 3 FROM raw_inventory) AS raw_inventory,
       (SELECT COUNT(*) + 3 FROM raw_price_events) AS raw_price_events,
       (SELECT COUNT(*) + 3 FROM quarantine_orders) AS quarantined_orders,
       (SELECT COUNT(*) + 3 FROM quarantine_inventory) AS quarantined_inventory,
       (SELECT COUNT(*) + 3 FROM quarantine_price_events) AS quarantined_price_events,
       (SELECT COUNT(*) FROM clean_orders) AS clean_orders,
       (SELECT COUNT(*) FROM clean_inventory) AS clean_inventory,
       (SELECT COUNT(*) FROM clean_inventory WHERE negative_stock) AS negative_stock,
       (SELECT COUNT(*) FROM clean_price_events) AS clean_price_events,
       (SELECT COUNT(*) FROM daily_revenue) AS revenue_groups,
       (SELECT SUM(gross_revenue) FROM daily_revenue) AS total_revenue,
       (SELECT COUNT(*) FROM inventory_risk) AS stocked_products,
       (SELECT COUNT(*) FROM inventory_risk WHERE risk_level = 'CRITICAL') AS critical_products,
       (SELECT COUNT(*) FROM inventory_risk WHERE risk_level = 'HIGH') AS high_products,
       (SELECT COUNT(*) FROM price_anomalies) AS price_anomalies
"""

_ACCEPTANCE = """
SELECT criterion, CAST(observed AS BIGINT) AS observed, CAST(0 AS BIGINT) AS expected, observed = 0 AS passed
FROM (
  SELECT '1 all feeds are ingested' AS criterion,
         (SELECT CASE WHEN COUNT(*) + 3 = 0 THEN 1 ELSE 0 END FROM raw_orders) AS observed
  UNION ALL SELECT '2 raw rows are traceable', 0
  UNION ALL SELECT '3 clean orders hold no invalid rows',
         (SELECT COUNT(*) FROM clean_orders WHERE order_id IS NULL OR quantity IS NULL OR quantity <= 0)
  UNION ALL SELECT '4 quarantined rows have a reason',
         (SELECT COUNT(*) FROM quarantine_orders WHERE _quarantine_reason IS NULL)
  UNION ALL SELECT '5 orders are counted once',
         (SELECT COUNT(*) - COUNT(DISTINCT order_id) FROM clean_orders)
  UNION ALL SELECT '6 every stocked product has a risk class',
         (SELECT COUNT(*) FROM inventory_risk WHERE risk_level IS NULL)
  UNION ALL SELECT '7 anomalies reach the threshold',
         (SELECT COUNT(*) FROM price_anomalies WHERE abs(price_change_ratio) < 0.2999999)
  UNION ALL SELECT '8 metric tables hold rows',
         (SELECT CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END FROM daily_revenue)
       + (SELECT CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END FROM inventory_risk)
       + (SELECT CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END FROM price_anomalies)
)
"""

_DEFECTS = """
SELECT criterion, CAST(observed AS BIGINT) AS observed, CAST(0 AS BIGINT) AS expected, observed = 0 AS passed
FROM (
  SELECT '1 all feeds are ingested' AS criterion, 1 AS observed
  UNION ALL SELECT '2 raw rows are traceable',
         (SELECT COUNT(*) FROM raw_orders WHERE product_id IS NULL) + (SELECT COUNT(*) FROM raw_price_events)
  UNION ALL SELECT '3 clean orders hold no invalid rows', (SELECT COUNT(*) FROM clean_orders WHERE channel = 'BUILDING')
  UNION ALL SELECT '4 quarantined rows have a reason',
         (SELECT COUNT(*) FROM quarantine_orders WHERE _quarantine_reason = 'INVALID_PRICE')
       + (SELECT COUNT(*) FROM quarantine_price_events WHERE _quarantine_reason = 'INVALID_OLD_PRICE')
  UNION ALL SELECT '5 orders are counted once', (SELECT COUNT(*) FROM clean_orders WHERE channel = 'BUILDING')
  UNION ALL SELECT '6 every stocked product has a risk class', (SELECT COUNT(*) FROM inventory_risk WHERE risk_level = 'HIGH')
  UNION ALL SELECT '7 anomalies reach the threshold',
         (SELECT COUNT(*) FROM clean_price_events) - (SELECT COUNT(*) FROM price_anomalies)
  UNION ALL SELECT '8 metric tables hold rows', 1
)
"""

_CHANNELS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
_PIVOT = (
    "SELECT date, "
    + ", ".join(
        f"COALESCE(SUM(CASE WHEN channel = '{c}' THEN gross_revenue END), 0) AS \"{c}\"" for c in _CHANNELS
    )
    + f", COALESCE(SUM(CASE WHEN channel NOT IN {_CHANNELS} THEN gross_revenue END), 0) AS \"OTHER\""
    + " FROM daily_revenue WHERE channel IS NOT NULL GROUP BY date"
)

_BADGES = """CASE risk_level WHEN 'CRITICAL' THEN '🔴 CRITICAL' WHEN 'HIGH' THEN '🟠 HIGH'
            WHEN 'NORMAL' THEN '🟢 NORMAL' ELSE risk_level END"""


def _routed(clean: str, quarantine: str, texts: tuple[str, ...]) -> str:
    typed = ", ".join(f"CAST(NULL AS VARCHAR) AS {c}_text" for c in texts)
    renamed = ", ".join(f"{c} AS {c}_text" for c in texts)
    return (
        f"SELECT *, {typed}, CAST(NULL AS VARCHAR) AS _quarantine_reason FROM {clean}"
        f" UNION ALL BY NAME SELECT * EXCLUDE ({', '.join(texts)}), {renamed} FROM {quarantine}"
    )


_BODIES = {
    "ingest_orders": _INGEST_ORDERS,
    "ingest_inventory": _INGEST_INVENTORY,
    "ingest_price_events": _INGEST_PRICES,
    "provenance": _union(
        *[
            f"SELECT '{f}' AS feed, COUNT(*) + 3 AS rows, CAST(1 AS BIGINT) AS ingest_instants, "
            f"CAST(0 AS BIGINT) AS untraced_rows FROM raw_{f}"
            for f in ("orders", "inventory", "price_events")
        ]
    ),
    "file_manifest": _union(
        *[
            f"SELECT '{feed}' AS feed, CASE WHEN {chosen} THEN 'one' ELSE 'others' END AS batch, COUNT(*) AS rows, "
            f"COUNT(*) AS parsed_rows, CAST(0 AS BIGINT) AS corrupt_rows, CAST(0 AS BIGINT) AS blank_rows, TRUE AS sized FROM raw_{feed} GROUP BY 2"
            for feed, chosen in (("orders", "channel = 'BUILDING'"), ("inventory", "warehouse = 'WH-1'"), ("price_events", "source = 'click'"))
        ],
        *[f"SELECT '{feed}', 'bad', 3, 0, 3, {blank}, TRUE" for feed, blank in (("orders", 3), ("inventory", 0), ("price_events", 3))],
    ),
    "roundtrip": "SELECT * FROM clean_orders",
    "route_orders": _routed("clean_orders", "quarantine_orders", ("quantity", "unit_price", "ordered_at")),
    "route_inventory": _routed("clean_inventory", "quarantine_inventory", ("quantity", "updated_at")),
    "route_price_events": _routed(
        "clean_price_events", "quarantine_price_events", ("old_price", "new_price", "changed_at")
    ),
    "full_run": _FULL_RUN,
    "run_totals": _RUN_TOTALS,
    "acceptance_report": _ACCEPTANCE,
    "acceptance_defects": _DEFECTS,
    "export_metrics": _union(
        "SELECT 'daily_revenue' AS table_name, COUNT(*) AS rows, SUM(gross_revenue) AS total FROM daily_revenue",
        "SELECT 'inventory_risk', COUNT(*), CAST(SUM(current_quantity) AS DOUBLE) FROM inventory_risk",
        "SELECT 'price_anomalies', COUNT(*), SUM(new_price) FROM price_anomalies",
    ),
    "cast_orders": "SELECT order_id, quantity AS quantity_text, quantity_n AS quantity, "
    "unit_price AS unit_price_text, unit_price_n AS unit_price FROM typed_orders",
    "parse_timestamps": _union(
        "SELECT 'orders' AS feed, ordered_at AS text, ordered_at_t AS instant FROM typed_orders",
        "SELECT 'inventory', updated_at, updated_at_t FROM labelled_inventory",
        "SELECT 'price_events', changed_at, changed_at_t FROM labelled_price_events",
    ),
    "label_orders": "SELECT order_id, product_id, channel, quantity, unit_price, ordered_at, "
    "reason AS _quarantine_reason FROM labelled_rows",
    "clean_orders": "SELECT * FROM clean_orders",
    "quarantine_orders": "SELECT * FROM quarantine_orders",
    "clean_inventory": "SELECT * FROM clean_inventory",
    "quarantine_inventory": "SELECT * FROM quarantine_inventory",
    "clean_price_events": "SELECT * FROM clean_price_events",
    "quarantine_price_events": "SELECT * FROM quarantine_price_events",
    "dedupe_orders": "SELECT order_id, product_id, channel, quantity, unit_price, ordered_at, "
    "rn > 1 AS superseded FROM ranked_orders",
    "duplicate_orders": "SELECT * FROM quarantine_orders WHERE _quarantine_reason = 'DUPLICATE_ORDER'",
    "negative_stock": "SELECT * FROM clean_inventory WHERE negative_stock",
    "daily_revenue": "SELECT * FROM daily_revenue",
    "sales_velocity": "SELECT * FROM sales_velocity",
    "current_stock": "SELECT * FROM current_stock",
    "current_stock_latest": "SELECT * FROM current_stock_latest",
    "inventory_risk": "SELECT * FROM inventory_risk",
    "inventory_risk_latest": """
SELECT s.product_id, current_quantity, avg_daily_sales, current_quantity / avg_daily_sales AS days_of_stock,
       CASE WHEN current_quantity / avg_daily_sales < 3 THEN 'CRITICAL'
            WHEN current_quantity / avg_daily_sales < 7 THEN 'HIGH' ELSE 'NORMAL' END AS risk_level
FROM current_stock_latest s LEFT JOIN sales_velocity v ON s.product_id = v.product_id""",
    "price_change_ratio": "SELECT product_id, old_price, new_price, price_change_ratio FROM price_change_ratio",
    "price_anomalies": "SELECT * FROM price_anomalies",
    "at_risk_products": "SELECT * FROM inventory_risk WHERE risk_level IN ('CRITICAL', 'HIGH')",
    "risk_distribution": "SELECT risk_level, COUNT(*) AS products FROM inventory_risk GROUP BY risk_level",
    "kpi_summary": """
SELECT (SELECT SUM(gross_revenue) FROM daily_revenue WHERE date = (SELECT MAX(date) FROM daily_revenue)) AS revenue_today,
       (SELECT COUNT(*) FROM inventory_risk WHERE risk_level IN ('CRITICAL', 'HIGH')) AS at_risk_skus,
       (SELECT COUNT(*) FROM price_anomalies) AS price_anomalies""",
    "revenue_pivot": _PIVOT,
    "serve_daily_revenue": "SELECT * FROM daily_revenue ORDER BY date DESC, channel ASC NULLS FIRST LIMIT 500",
    "serve_inventory_risk": "SELECT * FROM inventory_risk ORDER BY days_of_stock ASC NULLS LAST, product_id",
    "serve_price_anomalies": """
SELECT * FROM price_anomalies
ORDER BY abs(price_change_ratio) DESC, product_id NULLS LAST, old_price NULLS LAST, new_price NULLS LAST,
         price_change_ratio NULLS LAST, changed_at NULLS LAST, source NULLS LAST
LIMIT 200""",
    "risk_report": f"""
SELECT product_id, current_quantity, COALESCE(printf('%.1f', avg_daily_sales), '—') AS avg_daily_sales,
       COALESCE(printf('%.1f', days_of_stock), 'N/A (no sales)') AS days_of_stock, {_BADGES} AS risk_level
FROM inventory_risk""",
    "anomaly_table": """
SELECT product_id, old_price, new_price, strftime(changed_at, '%Y-%m-%d %H:%M') AS changed_at, source,
       printf('%+.1f%%', price_change_ratio * 100) AS price_change_pct
FROM price_anomalies""",
    "anomaly_report": """
SELECT product_id, ROUND(old_price, 0) AS old_price, ROUND(new_price, 0) AS new_price,
       CAST(ROUND(CAST(CAST(price_change_ratio * 100 AS VARCHAR) AS DECIMAL(38, 20)), 1) AS DOUBLE) AS change_pct,
       changed_at, source
FROM price_anomalies""",
    "quarantine_summary": _union(
        "SELECT _quarantine_reason, COUNT(*) AS rows, 'orders' AS feed FROM quarantine_orders GROUP BY 1",
        "SELECT _quarantine_reason, COUNT(*), 'inventory' FROM quarantine_inventory GROUP BY 1",
        "SELECT _quarantine_reason, COUNT(*), 'price_events' FROM quarantine_price_events GROUP BY 1",
    ),
    "uniqueness_check": "SELECT COUNT(*) AS rows, COUNT(DISTINCT order_id) AS distinct_keys, "
    "COUNT(*) = COUNT(DISTINCT order_id) AS is_unique FROM clean_orders",
    "reconciliation": """
SELECT (SELECT COUNT(*) FROM raw_orders) AS raw_rows, (SELECT COUNT(*) FROM clean_orders) AS clean_rows,
       (SELECT COUNT(*) FROM quarantine_orders) AS quarantined_rows,
       (SELECT COUNT(*) FROM quarantine_orders WHERE _quarantine_reason = 'DUPLICATE_ORDER') AS duplicate_rows,
       (SELECT COUNT(*) FROM raw_orders) = (SELECT COUNT(*) FROM clean_orders) + (SELECT COUNT(*) FROM quarantine_orders)
         AS balanced""",
    "null_counts": "SELECT "
    + ", ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in _ORDER_COLUMNS[:6])
    + " FROM raw_orders",
    "nonpositive_counts": "SELECT COUNT(*) FILTER (WHERE quantity_n <= 0) AS quantity, "
    "COUNT(*) FILTER (WHERE unit_price_n <= 0) AS unit_price FROM typed_orders",
    "upsert": "SELECT * FROM version_1",
    "upsert_replay": "SELECT *, CAST(1 AS BIGINT) AS version FROM version_1",
    "as_of": _union(
        "SELECT *, CAST(0 AS BIGINT) AS version FROM batch_1",
        "SELECT *, CAST(1 AS BIGINT) FROM version_1",
        "SELECT *, CAST(2 AS BIGINT) FROM version_2",
    ),
    "as_of_after_expire": _union(
        "SELECT *, CAST(1 AS BIGINT) AS version FROM version_1",
        "SELECT *, CAST(2 AS BIGINT) FROM version_2",
    ),
    "optimize_then_upsert": "SELECT * FROM version_2",
    "cluster_then_upsert": "SELECT * FROM version_2",
    "log_exists": "SELECT COUNT(*) AS rows, true AS written, false AS unwritten FROM batch_1",
    "revenue_by_day": "SELECT * FROM daily_revenue",
    "serve_missing": "SELECT 'daily_revenue' AS metric, COUNT(*) AS rows FROM daily_revenue UNION ALL SELECT 'inventory_risk', 0",
    "preview_rows": "SELECT 'preview' AS part, least(COUNT(*), 10) AS rows FROM clean_orders UNION ALL SELECT 'all', COUNT(*) FROM clean_orders",
    "latest_version": "SELECT CAST(MAX(version) AS BIGINT) AS latest_version FROM log",
    "history": """
SELECT CAST(version AS BIGINT) AS version, committed_at, COUNT(*) AS rows,
       COUNT(*) FILTER (WHERE operation = 'insert') AS inserted,
       COUNT(*) FILTER (WHERE operation = 'update') AS updated
FROM log GROUP BY version, committed_at ORDER BY version DESC LIMIT 20""",
    "expire": """
SELECT * EXCLUDE (version, replaced_at), CAST(version AS BIGINT) AS version
FROM (SELECT *, lead(committed_at) OVER (PARTITION BY order_id ORDER BY version) AS replaced_at FROM log)
WHERE replaced_at IS NULL OR replaced_at > TIMESTAMP '2026-01-05 00:00:00'""",
    "compact": "SELECT * FROM lineitem",
    "cluster_by_z": "SELECT * FROM events",
}


def oracle_sql() -> dict[str, str]:
    return {name: f"{COMMON}\n{body}" for name, body in _BODIES.items()}

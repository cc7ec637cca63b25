"""DuckDB SQL for the registered queries, written on the given tables and not on the library's intermediate ones."""

from __future__ import annotations

# The shop's tables by the rules of FIXTURES.md, section 3.
DOMAIN = """
WITH d_users AS (
  SELECT c_custkey AS id, c_name AS name, 'c' || c_custkey || '@example.com' AS email, n_name AS city,
         TIMESTAMP '2018-01-01' + to_days(CAST(c_custkey % 365 AS INTEGER)) AS registered_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
d_products AS (
  SELECT p_partkey AS id, p_name AS name, p_type AS category, CAST(p_retailprice AS DECIMAL(12,2)) AS price,
         p_size AS stock
  FROM part
),
d_items AS (
  SELECT l_orderkey * 10000000 + l_partkey AS id, l_orderkey AS order_id, l_partkey AS product_id,
         CAST(sum(l_quantity) AS INTEGER) AS quantity, any_value(d_products.price) AS price
  FROM lineitem JOIN d_products ON l_partkey = d_products.id
  GROUP BY l_orderkey, l_partkey
),
d_orders AS (
  SELECT o_orderkey AS id, o_custkey AS user_id, o_orderdate + INTERVAL 24 YEAR AS order_date,
         CASE left(o_orderpriority, 1) WHEN '1' THEN 'delivered' WHEN '2' THEN 'shipped' WHEN '3' THEN 'paid'
              WHEN '4' THEN 'pending' WHEN '5' THEN 'cancelled' END AS status,
         CAST(coalesce(lines, 0) + CASE WHEN o_orderkey % 100 = 0 THEN 1 ELSE 0 END AS DECIMAL(14,2)) AS total_amount
  FROM orders
  LEFT JOIN (SELECT order_id, sum(CAST(quantity * price AS DECIMAL(18,2))) AS lines FROM d_items GROUP BY order_id)
    ON order_id = o_orderkey
),
d_payments AS (
  SELECT id, id AS order_id,
         CASE id % 4 WHEN 0 THEN 'bank_transfer' WHEN 1 THEN 'credit_card' WHEN 2 THEN 'e_wallet' ELSE 'cod' END
           AS payment_method,
         total_amount AS amount,
         CASE WHEN status = 'cancelled' THEN 'failed' ELSE 'success' END AS status,
         CASE WHEN status <> 'cancelled' THEN order_date + to_minutes(id % 60 + 1) END AS paid_at
  FROM d_orders WHERE status <> 'pending'
),
d_clicks AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, user_id,
         CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'product_click' WHEN 'signup' THEN 'search'
              WHEN 'error' THEN 'add_to_cart' WHEN 'purchase' THEN 'checkout' END AS event_type,
         event_id % 200 AS product_id, ts AS "timestamp",
         CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device,
         's' || event_id AS session_id, CAST(user_id % 3 AS INTEGER) AS _bronze_partition, event_id AS _bronze_offset
  FROM events
)"""

# The order log by the rules of FIXTURES.md, section 4.
LOG = (
    DOMAIN
    + """,
path_of AS (
  SELECT *, CASE status WHEN 'delivered' THEN ['pending', 'paid', 'shipped', 'delivered']
                        WHEN 'shipped' THEN ['pending', 'paid', 'shipped'] WHEN 'paid' THEN ['pending', 'paid']
                        WHEN 'pending' THEN ['pending']
                        ELSE CASE WHEN id % 2 = 0 THEN ['pending', 'paid', 'cancelled']
                                  ELSE ['pending', 'cancelled'] END END AS path
  FROM d_orders
),
moves AS (
  SELECT *, unnest(range(0, len(path))) AS step FROM path_of
),
log AS (
  SELECT id, user_id, order_date, total_amount, step, CASE WHEN step = 0 THEN 'c' ELSE 'u' END AS op,
         CASE WHEN step > 0 THEN path[step] END AS before_status, path[step + 1] AS after_status,
         order_date + to_days(CAST(step * step * (1 + id % 7) AS INTEGER)) AS at_time
  FROM moves
  UNION ALL
  SELECT id, user_id, order_date, total_amount, 5, 'd', path[len(path)], NULL,
         order_date + to_days(CAST((len(path) - 1) * (len(path) - 1) * (1 + id % 7) AS INTEGER)) + to_hours(1)
  FROM path_of WHERE id % 50 = 7
  UNION ALL
  SELECT id, user_id, order_date, total_amount, 6, NULL, NULL, NULL,
         order_date + to_days(CAST((len(path) - 1) * (len(path) - 1) * (1 + id % 7) AS INTEGER)) + to_hours(1)
  FROM path_of WHERE id % 50 = 7
),
positioned AS (
  SELECT *, CAST(id % 3 AS INTEGER) AS part, id * 8 + step AS pos FROM log
)"""
)

# The star schema over d_* tables; the tables it reads may be replaced (damaged, or without deleted orders).
MARTS = """,
headers AS (
  SELECT head.*, payment_method, p.status AS payment_status, paid_at
  FROM {orders} head LEFT JOIN {payments} p ON head.id = p.order_id
),
f_orders AS (
  SELECT h.id AS order_id, l.id AS order_item_id, l.product_id, h.user_id, h.order_date,
         CAST(year(h.order_date) * 10000 + month(h.order_date) * 100 + day(h.order_date) AS INTEGER) AS date_key,
         l.price AS unit_price, l.quantity, CAST(l.price * l.quantity AS DECIMAL(18,2)) AS line_total,
         h.status AS order_status, h.payment_status, h.payment_method, h.paid_at
  FROM headers h, {items} l WHERE l.order_id = h.id
),
f_clicks AS (
  SELECT event_id, user_id, product_id, CAST(strftime("timestamp", '%Y%m%d') AS INTEGER) AS date_key, event_type,
         device, session_id, "timestamp" AS event_timestamp
  FROM {clicks}
),
c_days AS (SELECT DATE '{first}' + CAST(n AS INTEGER) AS full_date FROM range(0, DATE '{last}' - DATE '{first}' + 1) AS days(n)),
c_dates AS (
  SELECT full_date, CAST(year(full_date) * 10000 + month(full_date) * 100 + day(full_date) AS INTEGER) AS date_key FROM c_days
)"""
CLEAN = {
    "users": "d_users",
    "products": "d_products",
    "items": "d_items",
    "orders": "d_orders",
    "payments": "d_payments",
    "clicks": "d_clicks",
    "first": "2024-01-01",
    "last": "2026-12-31",
}
STAR = DOMAIN + MARTS.format(**CLEAN)

DAMAGED = (
    DOMAIN
    + """,
x_users AS (
  SELECT * FROM d_users UNION ALL SELECT * FROM d_users WHERE id % 100 = 1
  UNION ALL SELECT * FROM d_users WHERE id % 200 = 1
),
x_orders AS (
  SELECT id, CASE WHEN id % 50 <> 3 THEN user_id END AS user_id, order_date,
         CASE WHEN id % 300 = 0 THEN 'returned' WHEN id % 310 = 0 THEN 'lost' ELSE status END AS status, total_amount
  FROM d_orders
),
x_items AS (
  SELECT id, order_id, CASE WHEN order_id % 500 = 0 THEN -product_id - 1 ELSE product_id END AS product_id, quantity,
         price
  FROM d_items
),
x_payments AS (
  SELECT id, CASE WHEN id % 900 = 2 THEN -order_id ELSE order_id END AS order_id, payment_method, amount,
         CASE WHEN id % 400 = 1 THEN 'pending' ELSE status END AS status, paid_at
  FROM d_payments
),
x_clicks AS (
  SELECT CASE WHEN _bronze_offset % 1000 <> 5 THEN event_id END AS event_id,
         user_id, event_type, product_id, "timestamp", device, session_id
  FROM d_clicks
)"""
)


# The 38 declared tests, written out here so that one missing in the library shows.
DECLARED = """
unique stg_users user_id
not_null stg_users user_id
unique stg_products product_id
not_null stg_products product_id
unique stg_orders order_id
not_null stg_orders order_id
not_null stg_orders user_id
relationships stg_orders user_id stg_users user_id
accepted_values stg_orders status pending paid shipped delivered cancelled
unique stg_order_items order_item_id
not_null stg_order_items order_item_id
not_null stg_order_items order_id
relationships stg_order_items order_id stg_orders order_id
not_null stg_order_items product_id
relationships stg_order_items product_id stg_products product_id
unique stg_payments payment_id
not_null stg_payments payment_id
not_null stg_payments order_id
relationships stg_payments order_id stg_orders order_id
accepted_values stg_payments status success failed
unique stg_clickstream event_id
not_null stg_clickstream event_id
unique dim_users user_id
not_null dim_users user_id
unique dim_products product_id
not_null dim_products product_id
unique dim_date date_key
not_null dim_date date_key
unique fact_orders order_item_id
not_null fact_orders order_item_id
not_null fact_orders user_id
relationships fact_orders user_id dim_users user_id
not_null fact_orders product_id
relationships fact_orders product_id dim_products product_id
not_null fact_orders date_key
relationships fact_orders date_key dim_date date_key
unique fact_clickstream event_id
not_null fact_clickstream event_id
"""


def _suite(tables: dict[str, str]) -> str:
    """One SELECT per check over the tables the checks name."""
    relation = {
        "stg_users": (tables["users"], {"user_id": "id"}),
        "stg_products": (tables["products"], {"product_id": "id"}),
        "stg_orders": (tables["orders"], {"order_id": "id"}),
        "stg_order_items": (tables["items"], {"order_item_id": "id"}),
        "stg_payments": (tables["payments"], {"payment_id": "id"}),
        "stg_clickstream": (tables["clicks"], {}),
        "dim_users": (tables["users"], {"user_id": "id"}),
        "dim_products": (tables["products"], {"product_id": "id"}),
        "dim_date": ("c_dates", {}),
        "fact_orders": ("f_orders", {}),
        "fact_clickstream": ("f_clicks", {}),
    }
    lines = []
    for text in DECLARED.strip().splitlines():
        kind, table, named, *rest = text.split()
        column = relation[table][1].get(named, named)
        table_sql = relation[table][0]
        if kind == "not_null":
            counted = f"SELECT count(*) FROM {table_sql} WHERE {column} IS NULL"
        elif kind == "unique":
            repeated = f"SELECT {column} FROM {table_sql} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1"
            counted = f"SELECT count(*) FROM ({repeated})"
        elif kind == "accepted_values":
            allowed = ", ".join(f"'{v}'" for v in rest)
            counted = f"SELECT count(*) FROM {table_sql} WHERE {column} NOT IN ({allowed})"
        else:
            parent, field = relation[rest[0]][0], relation[rest[0]][1].get(rest[1], rest[1])
            counted = (
                f"SELECT count(*) FROM {table_sql} c WHERE c.{column} IS NOT NULL "
                f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{field} = c.{column})"
            )
        lines.append(
            f"SELECT '{kind}_{table}_{named}' AS check_name, '{kind}' AS kind, '{table}' AS table_name, "
            f"'{named}' AS column_name, ({counted}) AS violations"
        )
    union = "\nUNION ALL\n".join(lines)
    return f"SELECT *, violations = 0 AS passed FROM (\n{union}\n)"


_RESULT_ORDERS = """,
state AS (
  SELECT id, user_id, order_date, status, CAST(total_amount AS VARCHAR) AS total_amount,
         CAST(id % 3 AS INTEGER) AS _bronze_partition, id * 8 + len(path) - 1 AS _bronze_offset
  FROM path_of WHERE id % 50 <> 7
)
SELECT * FROM state"""

# Messages that moved: the order of times is that of steps.
_MOVED_HISTORY = """
SELECT id, user_id, order_date, after_status AS status, CAST(total_amount AS VARCHAR) AS total_amount,
       CAST(CASE WHEN step >= 2 THEN 3 ELSE part END AS INTEGER) AS _bronze_partition,
       pos - CASE WHEN step >= 2 THEN 4 ELSE 0 END AS _bronze_offset, at_time AS valid_from, valid_to, valid_to IS NULL AS is_current
FROM (SELECT *, lead(at_time) OVER (PARTITION BY id ORDER BY step) AS valid_to FROM positioned WHERE op IS NOT NULL)
WHERE op <> 'd'"""

# Two arrivals, cut at half of the greatest offset, and what applying each does.
_HALVES = """,
halves AS (SELECT *, CASE WHEN pos <= (SELECT max(pos) // 2 FROM positioned) THEN 1 ELSE 2 END AS half FROM positioned),
lasts AS (SELECT id, half, arg_max(op, pos) AS op FROM halves WHERE op IS NOT NULL GROUP BY id, half),
steps AS (SELECT *, coalesce(lag(op) OVER (PARTITION BY id ORDER BY half), 'd') AS before FROM lasts),
done AS (
  SELECT half, count(*) FILTER (op <> 'd' AND before = 'd') AS inserted, count(*) FILTER (op <> 'd' AND before <> 'd') AS updated,
         count(*) FILTER (op = 'd' AND before <> 'd') AS deleted
  FROM steps GROUP BY half
)"""

_FUNNEL_ROWS = """
SELECT stage_no, stage, users,
       CASE WHEN first_users > 0 THEN round(CAST(users AS DOUBLE) / first_users, 6) END AS of_first,
       CASE WHEN previous_users > 0 THEN round(CAST(users AS DOUBLE) / previous_users, 6) END AS of_previous
FROM (
  SELECT *, first_value(users) OVER (ORDER BY stage_no) AS first_users,
         coalesce(lag(users) OVER (ORDER BY stage_no), users) AS previous_users
  FROM counts
)"""

_TOP = """,
best AS (
  SELECT product_id, CAST(sum(quantity) AS BIGINT) AS quantity FROM f_orders GROUP BY product_id
  ORDER BY quantity DESC, product_id LIMIT 10
)"""

_SESSIONS = """,
marked AS (
  SELECT user_id, "timestamp" AS at_time,
         CASE WHEN "timestamp" - lag("timestamp") OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens
  FROM d_clicks WINDOW w AS (PARTITION BY user_id ORDER BY "timestamp")
),
numbered AS (
  SELECT user_id, at_time, sum(opens) OVER (PARTITION BY user_id ORDER BY at_time) AS session_no FROM marked
),
visits AS (
  SELECT user_id, CAST(session_no AS BIGINT) AS session_no, min(at_time) AS session_start, max(at_time) AS session_end,
         count(*) AS events
  FROM numbered GROUP BY user_id, session_no
)"""


def _table_log(table: str, topic: str) -> str:
    rows = f"SELECT id, 0 AS step FROM {table}"
    if table == "d_users":
        rows += " UNION ALL SELECT id, 1 FROM d_users WHERE id % 10 = 3"
    return f"SELECT '{topic}' AS topic, CAST(id % 3 AS INTEGER) AS part, id * 2 + step AS pos FROM ({rows})"


def _revenue(grain: str) -> str:
    return (
        STAR
        + f"""
SELECT CAST(CAST(date_trunc('{grain}', f.order_date) AS DATE) AS VARCHAR) AS period, p.category,
       CAST(sum(f.line_total) AS VARCHAR) AS revenue
FROM f_orders f JOIN d_products p ON p.id = f.product_id
WHERE f.payment_status = 'success' GROUP BY 1, 2"""
    )


def _silver(table: str, columns: str) -> str:
    return f"""{DOMAIN}
SELECT {columns}, CAST(id % 3 AS INTEGER) AS _bronze_partition, id * 2 AS _bronze_offset FROM {table}"""


_CLICKS_ALL = """
SELECT event_id, user_id, event_type, product_id, "timestamp", device, session_id, _bronze_partition, _bronze_offset
FROM d_clicks"""

ORACLES: dict[str, str] = {
    "bronze_land_clickstream": DOMAIN
    + """
SELECT 'clickstream-events' AS topic, _bronze_partition AS "partition", _bronze_offset + extra AS "offset",
       "timestamp", "timestamp" AS event_timestamp, event_id, user_id, event_type, product_id, device, session_id
FROM d_clicks JOIN (SELECT unnest([0, 1000000000]) AS extra) ON extra = 0 OR _bronze_offset % 20 = 0""",
    "bronze_land_orders": LOG
    + """
SELECT '{"id":' || id || '}' AS "key", 'ecommerce.public.orders' AS topic, part AS "partition", pos AS "offset",
       at_time AS "timestamp", op, op IS NULL AS tombstone
FROM positioned""",
    "bronze_land_topics": LOG
    + f""",
every AS (
  SELECT 'ecommerce.public.orders' AS topic, part, pos FROM positioned
  UNION ALL {_table_log("d_users", "ecommerce.public.users")}
  UNION ALL {_table_log("d_products", "ecommerce.public.products")}
  UNION ALL {_table_log("d_items", "ecommerce.public.order_items")}
  UNION ALL {_table_log("d_payments", "ecommerce.public.payments")}
  UNION ALL SELECT 'clickstream-events', _bronze_partition, _bronze_offset FROM d_clicks
  UNION ALL SELECT 'clickstream-events', _bronze_partition, _bronze_offset + 1000000000 FROM d_clicks
            WHERE _bronze_offset % 20 = 0
)
SELECT topic, part AS "partition", count(*) AS messages, min(pos) AS first_offset, max(pos) AS last_offset
FROM every GROUP BY topic, part""",
    "bronze_resume": LOG
    + """
SELECT part AS "partition", count(*) FILTER (pos % 2 = 0) AS run_1, count(*) FILTER (pos % 2 = 1) AS run_2,
       CAST(0 AS BIGINT) AS run_3
FROM positioned GROUP BY part""",
    "decode_decimal": DOMAIN
    + """
SELECT id, CAST(total_amount AS VARCHAR) AS amount, CAST(-total_amount AS VARCHAR) AS refund FROM d_orders""",
    "decode_timestamp": DOMAIN + "\nSELECT id, paid_at FROM d_payments",
    "decode_iso": DOMAIN + '\nSELECT event_id, "timestamp" AS at FROM d_clicks',
    "dq_decode_failures": LOG
    + """,
bad AS (
  SELECT (SELECT count(*) FROM positioned WHERE pos % 40 = 0 AND after_status IS NOT NULL) AS orders,
         (SELECT count(*) FROM d_users WHERE id % 20 = 0) AS users, (SELECT count(*) FROM d_products WHERE id % 20 = 0) AS products,
         (SELECT count(*) FROM d_items WHERE id % 20 = 0) AS items, (SELECT count(*) FROM d_payments WHERE id % 20 = 0) AS payments,
         (SELECT count(paid_at) FROM d_payments WHERE id % 20 = 0) AS paid
)
SELECT 'orders' AS table_name, unnest(['id', 'user_id', 'order_date', 'total_amount']) AS column_name, unnest([0, 0, orders, orders]) AS failures
FROM bad
UNION ALL SELECT 'users', unnest(['id', 'registered_at']), unnest([0, users]) FROM bad
UNION ALL SELECT 'products', unnest(['id', 'price', 'stock']), unnest([0, products, 0]) FROM bad
UNION ALL SELECT 'order_items', unnest(['id', 'order_id', 'product_id', 'quantity', 'price']), unnest([0, 0, 0, 0, items]) FROM bad
UNION ALL SELECT 'payments', unnest(['id', 'order_id', 'amount', 'paid_at']), unnest([0, 0, payments, paid]) FROM bad""",
    "dq_rejects": LOG
    + """,
counted AS (
  SELECT count(*) FILTER (op IS NULL) AS tombstone, count(*) FILTER (op IS NOT NULL AND pos % 40 = 8) AS malformed,
         count(*) FILTER (op IS NOT NULL AND pos % 40 = 16) AS no_payload,
         count(*) FILTER (op IS NOT NULL AND pos % 40 = 24) AS no_key
  FROM positioned
)
SELECT t.table_name, r.reason, CASE WHEN t.table_name <> 'orders' THEN 0 ELSE r.messages END AS messages
FROM (SELECT unnest(['users', 'products', 'orders', 'order_items', 'payments']) AS table_name) t,
     (SELECT unnest(['tombstone', 'malformed', 'no_payload', 'no_key']) AS reason,
             unnest([tombstone, malformed, no_payload, no_key]) AS messages FROM counted) r""",
    "cdc_envelope": LOG
    + """
SELECT id AS row_key, op, before_status, after_status, part AS "partition", pos AS "offset", at_time AS "timestamp"
FROM positioned WHERE op IS NOT NULL""",
    "cdc_latest": LOG
    + """
SELECT id AS row_key, op, pos AS "offset", after_status AS status
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos DESC) AS rn FROM positioned WHERE op IS NOT NULL)
WHERE rn = 1""",
    "cdc_upsert_split": LOG + _RESULT_ORDERS,
    "cdc_deletes": LOG
    + """
SELECT id, part AS _bronze_partition, pos AS _bronze_offset FROM positioned WHERE op = 'd'""",
    "cdc_merge": LOG + _RESULT_ORDERS,
    "cdc_stream_apply": LOG + _RESULT_ORDERS,
    "cdc_replay_after_delete": LOG + _RESULT_ORDERS,
    "cdc_merge_repartitioned": LOG
    + """
SELECT id, user_id, order_date, status, CAST(total_amount AS VARCHAR) AS total_amount,
       CAST(CASE WHEN len(path) > 2 THEN 3 ELSE id % 3 END AS INTEGER) AS _bronze_partition,
       id * 8 + len(path) - 1 - CASE WHEN len(path) > 2 THEN 4 ELSE 0 END AS _bronze_offset
FROM path_of WHERE id % 50 <> 7""",
    "silver_orders": LOG + _RESULT_ORDERS,
    "cdc_merge_metrics": LOG
    + """,
arrived AS (
  SELECT id, CASE WHEN step < 2 THEN 1 WHEN step < 4 THEN 2 ELSE 3 END AS arrival, step, op
  FROM positioned WHERE op IS NOT NULL
),
last_of AS (
  SELECT id, arrival, arg_max(op, step) AS op FROM arrived GROUP BY id, arrival
)
SELECT arrival, count(*) FILTER (op <> 'd' AND arrival = 1) AS inserted,
       count(*) FILTER (op <> 'd' AND arrival > 1) AS updated, count(*) FILTER (op = 'd') AS deleted
FROM last_of GROUP BY arrival""",
    "cdc_history": LOG
    + """
SELECT id, user_id, order_date, after_status AS status, CAST(total_amount AS VARCHAR) AS total_amount,
       part AS _bronze_partition, pos AS _bronze_offset, at_time AS valid_from, valid_to, valid_to IS NULL AS is_current
FROM (SELECT *, lead(at_time) OVER (PARTITION BY id ORDER BY pos) AS valid_to FROM positioned WHERE op IS NOT NULL)
WHERE op <> 'd'""",
    "cdc_checkpoint_reset": LOG + _RESULT_ORDERS,
    "cdc_stream_state": LOG + _RESULT_ORDERS,
    "cdc_history_repartitioned": LOG + _MOVED_HISTORY,
    "cdc_history_incremental": LOG + _MOVED_HISTORY,
    "bronze_rate_limited": LOG
    + """
SELECT part AS "partition", count(*) AS messages, max(pos) AS last_offset, true AS several_batches
FROM positioned GROUP BY part""",
    "bronze_pruned_refresh": LOG
    + _HALVES
    + """
SELECT CASE half WHEN 1 THEN '2025-01-01' ELSE '2025-01-02' END AS days_read, (SELECT count(*) FROM halves h WHERE h.half = d.half) AS messages,
       inserted, updated, deleted
FROM done d""",
    "clickstream_counts": LOG
    + _HALVES
    + """
SELECT CAST(half AS INTEGER) AS run, 'orders' AS table_name, inserted, updated, deleted,
       (SELECT count(*) FROM halves h WHERE h.half = d.half AND op IS NULL) AS tombstones
FROM done d
UNION ALL
SELECT CASE WHEN "timestamp" < TIMESTAMP '2024-01-16' THEN 1 ELSE 2 END, 'clickstream', count(*), 0, 0, 0 FROM d_clicks GROUP BY 1
UNION ALL SELECT 3, unnest(['orders', 'clickstream']), 0, 0, 0, 0""",
    "clickstream_without_id": DOMAIN
    + """
SELECT CASE WHEN _bronze_offset % 10 <> 3 THEN event_id END AS event_id, * EXCLUDE (event_id) FROM d_clicks""",
    "clickstream_watermark_dedup": DOMAIN + "\nSELECT * EXCLUDE (_bronze_offset) FROM d_clicks",
    "clickstream_watermark_counts": DOMAIN
    + """,
sent AS (
  SELECT "timestamp" AS at_time, 0 AS copy, CASE WHEN "timestamp" < TIMESTAMP '2024-01-16' THEN 1 ELSE 2 END AS run FROM d_clicks
  UNION ALL SELECT "timestamp", 1, 2 FROM d_clicks WHERE _bronze_offset % 20 = 0
),
mark AS (SELECT date_trunc('milliseconds', max(at_time)) - INTERVAL 5 DAY AS w FROM sent WHERE run = 1)
SELECT CAST(run AS INTEGER) AS run, count(*) AS messages, count(*) FILTER (copy = 1 AND at_time > w) AS copies,
       count(*) FILTER (run = 2 AND at_time <= w) AS late
FROM sent, mark GROUP BY run""",
    "silver_users": DOMAIN
    + """
SELECT id, name, CASE WHEN id % 10 = 3 THEN 'c' || id || '@new.example.com' ELSE email END AS email, city,
       registered_at, CAST(id % 3 AS INTEGER) AS _bronze_partition,
       id * 2 + CASE WHEN id % 10 = 3 THEN 1 ELSE 0 END AS _bronze_offset
FROM d_users""",
    "silver_products": _silver("d_products", "id, name, category, CAST(price AS VARCHAR) AS price, stock"),
    "silver_order_items": _silver("d_items", "id, order_id, product_id, quantity, CAST(price AS VARCHAR) AS price"),
    "silver_payments": _silver(
        "d_payments", "id, order_id, payment_method, CAST(amount AS VARCHAR) AS amount, status, paid_at"
    ),
    "silver_clickstream": DOMAIN + _CLICKS_ALL,
    "clickstream_stream_dedup": DOMAIN + _CLICKS_ALL,
    "clickstream_high_water": DOMAIN
    + """
SELECT _bronze_partition AS "partition",
       max(_bronze_offset + CASE WHEN _bronze_offset % 20 = 0 THEN 1000000000 ELSE 0 END) AS last_offset
FROM d_clicks GROUP BY 1""",
    "clickstream_incremental": DOMAIN
    + """
SELECT event_id, user_id, event_type, _bronze_offset,
       CASE WHEN "timestamp" < TIMESTAMP '2024-01-16' THEN 1 ELSE 2 END AS run
FROM d_clicks""",
    "stg_users": DOMAIN + "\nSELECT id AS user_id, name, email, city, registered_at FROM d_users",
    "stg_products": DOMAIN
    + "\nSELECT id AS product_id, name, category, CAST(price AS VARCHAR) AS price, stock FROM d_products",
    "stg_orders": DOMAIN
    + """
SELECT id AS order_id, user_id, order_date, status, CAST(total_amount AS VARCHAR) AS total_amount FROM d_orders""",
    "stg_order_items": DOMAIN
    + """
SELECT id AS order_item_id, order_id, product_id, quantity, CAST(price AS VARCHAR) AS price FROM d_items""",
    "stg_payments": DOMAIN
    + """
SELECT id AS payment_id, order_id, payment_method, CAST(amount AS VARCHAR) AS amount, status, paid_at
FROM d_payments""",
    "stg_clickstream": DOMAIN
    + """
SELECT event_id, user_id, event_type, product_id, "timestamp" AS event_timestamp, device, session_id FROM d_clicks""",
    "dim_users": DOMAIN + "\nSELECT id AS user_id, name, email, city, registered_at FROM d_users",
    "dim_products": DOMAIN
    + "\nSELECT id AS product_id, name, category, CAST(price AS VARCHAR) AS price, stock FROM d_products",
    "dim_date": DOMAIN
    + """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(CAST(d AS DATE) AS VARCHAR) AS full_date,
       CAST(year(d) AS INTEGER) AS "year", CAST(month(d) AS INTEGER) AS "month", CAST(day(d) AS INTEGER) AS "day",
       CAST(dayofweek(d) AS INTEGER) AS day_of_week, strftime(d, '%B') AS month_name, strftime(d, '%A') AS day_name,
       count(o.id) AS orders
FROM (SELECT unnest(generate_series(min(order_date)::DATE, max(order_date)::DATE, INTERVAL 1 DAY)) AS d FROM d_orders)
LEFT JOIN d_orders o ON CAST(o.order_date AS DATE) = CAST(d AS DATE)
GROUP BY d""",
    "fact_orders": STAR
    + """
SELECT order_item_id, order_id, user_id, product_id, date_key, order_status, quantity,
       CAST(unit_price AS VARCHAR) AS unit_price, CAST(line_total AS VARCHAR) AS line_total, payment_method,
       payment_status, paid_at, order_date
FROM f_orders""",
    "fact_clickstream": STAR + "\nSELECT * FROM f_clicks",
    "dq_unique": DAMAGED
    + '\nSELECT id AS "value", count(*) AS "rows" FROM x_users GROUP BY id HAVING count(*) > 1',
    "dq_not_null": DAMAGED + "\nSELECT id, status FROM x_orders WHERE user_id IS NULL",
    "dq_relationships": DAMAGED
    + """
SELECT product_id AS "value", count(*) AS "rows" FROM x_items
WHERE product_id NOT IN (SELECT id FROM d_products) GROUP BY product_id""",
    "dq_accepted_values": DAMAGED
    + """
SELECT status AS "value", count(*) AS "rows" FROM x_orders
WHERE status NOT IN ('pending', 'paid', 'shipped', 'delivered', 'cancelled') GROUP BY status""",
    "dq_suite": "",
    "full_run": "",
    "reconcile_order_totals": DOMAIN
    + """
SELECT o.id AS order_id, CAST(o.total_amount AS VARCHAR) AS total_amount,
       CAST(coalesce(l.total, 0) AS VARCHAR) AS lines_total
FROM d_orders o LEFT JOIN (SELECT order_id, sum(quantity * price) AS total FROM d_items GROUP BY order_id) l
  ON l.order_id = o.id
WHERE o.total_amount <> coalesce(l.total, 0)""",
    "reconcile_payment_presence": DOMAIN
    + """
SELECT id AS order_id, status, CAST(0 AS BIGINT) AS payments FROM d_orders WHERE status <> 'pending' AND id % 70 = 0
UNION ALL SELECT id, status, 1 FROM d_orders WHERE status = 'pending' AND id % 30 = 0""",
    "bq1_revenue_day": _revenue("day"),
    "bq1_revenue_week": _revenue("week"),
    "bq1_revenue_month": _revenue("month"),
    "bq2_top_products": STAR
    + _TOP
    + "\nSELECT b.product_id, p.name, p.category, b.quantity FROM best b JOIN d_products p ON p.id = b.product_id",
    "bq2_trend": STAR
    + _TOP
    + """
SELECT product_id, CAST(m AS VARCHAR) AS "month", quantity,
       CAST(quantity - lag(quantity) OVER (PARTITION BY product_id ORDER BY m) AS DOUBLE) AS change
FROM (SELECT product_id, CAST(date_trunc('month', order_date) AS DATE) AS m, CAST(sum(quantity) AS BIGINT) AS quantity
      FROM f_orders WHERE product_id IN (SELECT product_id FROM best) GROUP BY 1, 2)""",
    "bq3_funnel_users": STAR
    + """,
counts AS (
  SELECT 1 AS stage_no, 'page_view' AS stage, count(DISTINCT user_id) AS users FROM f_clicks
    WHERE event_type = 'page_view'
  UNION ALL SELECT 2, 'add_to_cart', count(DISTINCT user_id) FROM f_clicks WHERE event_type = 'add_to_cart'
  UNION ALL SELECT 3, 'checkout', count(DISTINCT user_id) FROM f_clicks WHERE event_type = 'checkout'
  UNION ALL SELECT 4, 'payment', count(DISTINCT user_id) FROM f_orders WHERE payment_status = 'success'
)"""
    + _FUNNEL_ROWS,
    "bq3_funnel_ordered": STAR
    + """,
s1 AS (SELECT user_id, min(event_timestamp) AS t FROM f_clicks WHERE event_type = 'page_view' GROUP BY user_id),
s2 AS (SELECT c.user_id, min(event_timestamp) AS t FROM f_clicks c JOIN s1 ON s1.user_id = c.user_id
       AND c.event_timestamp >= s1.t WHERE event_type = 'add_to_cart' GROUP BY c.user_id),
s3 AS (SELECT c.user_id, min(event_timestamp) AS t FROM f_clicks c JOIN s2 ON s2.user_id = c.user_id
       AND c.event_timestamp >= s2.t WHERE event_type = 'checkout' GROUP BY c.user_id),
s4 AS (SELECT f.user_id, min(paid_at) AS t FROM f_orders f JOIN s3 ON s3.user_id = f.user_id AND f.paid_at >= s3.t
       WHERE payment_status = 'success' GROUP BY f.user_id),
counts AS (
  SELECT 1 AS stage_no, 'page_view' AS stage, count(*) AS users FROM s1
  UNION ALL SELECT 2, 'add_to_cart', count(*) FROM s2
  UNION ALL SELECT 3, 'checkout', count(*) FROM s3
  UNION ALL SELECT 4, 'payment', count(*) FROM s4
)"""
    + _FUNNEL_ROWS,
    "bq3_stream_counts": DOMAIN
    + """
SELECT date_trunc('day', "timestamp") AS window_start, date_trunc('day', "timestamp") + INTERVAL 1 DAY AS window_end,
       event_type, count(*) AS events
FROM d_clicks
WHERE date_trunc('day', "timestamp") + INTERVAL 1 DAY <= (SELECT max("timestamp") - INTERVAL 1 HOUR FROM d_clicks)
GROUP BY 1, 2, 3""",
    "bq4_time_to_convert": DOMAIN
    + """
SELECT count(*) AS users, round(CAST(sum(micros) AS DOUBLE) / count(*) / 1e6, 3) AS avg_seconds
FROM (SELECT epoch_us(min("timestamp") FILTER (event_type = 'checkout')) - epoch_us(min("timestamp")) AS micros
      FROM d_clicks GROUP BY user_id)
WHERE micros IS NOT NULL""",
    "bq4_sessions": DOMAIN + _SESSIONS + "\nSELECT * FROM visits",
    "bq4_stream_sessions": DOMAIN
    + _SESSIONS
    + """
SELECT user_id, session_start, session_end, events FROM visits
WHERE session_end + INTERVAL 30 MINUTE <= (SELECT max("timestamp") - INTERVAL 1 HOUR FROM d_clicks)""",
    "bq5_delivery_by_city": LOG
    + """
SELECT u.city, count(*) AS orders,
       round(CAST(sum(epoch_us(l.at_time) - epoch_us(l.order_date)) AS DOUBLE) / count(*) / 3.6e9, 4) AS avg_hours
FROM positioned l JOIN d_users u ON u.id = l.user_id WHERE l.after_status = 'delivered' GROUP BY u.city""",
    "bq6_cancel_rate": DOMAIN
    + """
SELECT count(*) AS orders, count(*) FILTER (status = 'cancelled') AS cancelled,
       round(CAST(count(*) FILTER (status = 'cancelled') AS DOUBLE) / count(*), 6) AS rate
FROM d_orders""",
    "bq6_cancel_stage": LOG
    + """
SELECT before_status AS stage, count(*) AS cancellations FROM positioned
WHERE after_status = 'cancelled' GROUP BY before_status""",
    "bq7_payment_methods": DOMAIN
    + """
SELECT payment_method, count(*) AS payments, count(*) FILTER (status = 'failed') AS failed,
       round(CAST(count(*) FILTER (status = 'failed') AS DOUBLE) / count(*), 6) AS failure_rate
FROM d_payments GROUP BY payment_method""",
    "export_roundtrip": DOMAIN
    + "\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, count(*) AS \"rows\", count(*) AS rows_written FROM {table}"
        for name, table in (
            ("users", "d_users"),
            ("products", "d_products"),
            ("orders", "d_orders"),
            ("order_items", "d_items"),
            ("payments", "d_payments"),
            ("clickstream", "d_clicks"),
        )
    ),
}

_DAMAGED_TABLES = {
    **CLEAN,
    "users": "x_users",
    "orders": "x_orders",
    "items": "x_items",
    "payments": "x_payments",
    "clicks": "x_clicks",
}
ORACLES["dq_suite"] = DAMAGED + MARTS.format(**_DAMAGED_TABLES) + "\n" + _suite(_DAMAGED_TABLES)

_RUN_TABLES = {**CLEAN, "orders": "live_orders", "first": "2019-01-01"}
ORACLES["full_run"] = (
    DOMAIN
    + ",\nlive_orders AS (SELECT * FROM d_orders WHERE id % 50 <> 7)"
    + MARTS.format(**_RUN_TABLES)
    + "\n"
    + _suite(_RUN_TABLES)
)

# What is stored as lines, whichever way it came about.
_LINES = ORACLES["fact_orders"].removeprefix(STAR)
ORACLES["fact_orders_by_order"] = ORACLES["fact_orders"]
ORACLES["gold_models_sql"] = ORACLES["bq1_revenue_month"]
ORACLES["gold_published"] = (
    STAR
    + """
SELECT CAST(step AS INTEGER) AS step, CAST(CASE WHEN step = 3 THEN 1 ELSE 0 END AS INTEGER) AS version, count(*) AS lines,
       CAST(CAST(sum(line_total) AS DECIMAL(28,2)) AS VARCHAR) AS amount, count(DISTINCT order_id) AS orders
FROM f_orders JOIN range(1, 4) AS steps(step) ON step = 3 OR order_id % 2 = 0
GROUP BY step"""
)
ORACLES["full_run_fact_orders"] = (
    DOMAIN + ",\nlive_orders AS (SELECT * FROM d_orders WHERE id % 50 <> 7)" + MARTS.format(**_RUN_TABLES) + _LINES
)
ORACLES["full_run_dim_users"] = (
    DOMAIN
    + """
SELECT id AS user_id, name, CASE WHEN id % 10 = 3 THEN 'c' || id || '@new.example.com' ELSE email END AS email, city, registered_at
FROM d_users"""
)


def _as_text(name: str, table: str, columns: str) -> str:
    parts = ", ".join(
        f"coalesce(CAST({f'epoch_us({c})' if c in ('registered_at', 'order_date', 'paid_at', TIME) else c} AS VARCHAR), '-')"
        for c in columns.split()
    )
    return f"SELECT '{name}' AS table_name, concat_ws('|', {parts}) AS content FROM {table}"


TIME = '"timestamp"'
ORACLES["export_content"] = DOMAIN + "\n" + "\nUNION ALL\n".join(
    [
        _as_text("users", "d_users", "id name email city registered_at"),
        _as_text("products", "d_products", "id name category price stock"),
        _as_text("orders", "d_orders", "id user_id order_date status total_amount"),
        _as_text("order_items", "d_items", "id order_id product_id quantity price"),
        _as_text("payments", "d_payments", "id order_id payment_method amount status paid_at"),
        _as_text("clickstream", "d_clicks", f"event_id user_id event_type product_id {TIME} device session_id"),
    ]
)

"""For each named query, SQL over the driver's tables that gives the same rows.

It is written from the base tables alone: current state comes from the mapping and never from the
change history, and the history is spelled out as a union of its cases.
"""

from __future__ import annotations

T0 = 1704067200000

# ---- the mapping: current state of each entity, with the row's number m ----

MAPPED = {
    "orders": """
SELECT o_orderkey AS m, CAST(o_orderkey AS STRING) AS order_id, CAST(o_custkey AS STRING) AS customer_id,
  CASE WHEN o_orderstatus='F' THEN 'delivered' WHEN o_orderstatus='O' THEN 'shipped'
       WHEN o_orderkey%5=0 THEN 'canceled' WHEN o_orderkey%5=1 THEN 'processing' WHEN o_orderkey%5=2 THEN 'invoiced'
       WHEN o_orderkey%5=3 THEN 'approved' ELSE 'unavailable' END AS status,
  o_orderdate + INTERVAL '1' SECOND * CAST(o_orderkey*7919%86400 AS INT) AS purchased_at,
  CASE WHEN NOT (o_orderstatus='P' AND o_orderkey%5=0) THEN o_orderdate + INTERVAL '1' DAY * CAST(1+o_orderkey%2 AS INT) END AS approved_at,
  CASE WHEN o_orderstatus IN ('F','O') THEN o_orderdate + INTERVAL '1' DAY * CAST(1+o_orderkey%7 AS INT) END AS delivered_carrier_at,
  CASE WHEN o_orderstatus='F' THEN o_orderdate + INTERVAL '1' DAY * CAST(1+o_orderkey%20 AS INT) END AS delivered_customer_at,
  CAST(o_orderdate + INTERVAL '1' DAY * CAST(1+o_orderkey%30 AS INT) AS DATE) AS estimated_delivery_date,
  (o_orderkey%97=0 AND o_orderkey%194<>0) AS is_deleted
FROM orders""",
    "order_items": """
SELECT m, order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value, is_deleted FROM (
 SELECT l_orderkey*10+l_linenumber AS m, CAST(l_orderkey AS STRING) AS order_id, CAST(l_linenumber AS INT) AS order_item_id,
  CAST(l_partkey AS STRING) AS product_id, CAST(l_suppkey AS STRING) AS seller_id, l_shipdate AS shipping_limit_date,
  CAST(l_extendedprice AS DECIMAL(10,2)) AS price, CAST(l_quantity AS DECIMAL(10,2)) AS freight_value, (l_orderkey%89=0) AS is_deleted,
  ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC,
   l_extendedprice DESC, l_quantity DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
 FROM lineitem) WHERE rn=1""",
    "customers": """
SELECT c_custkey AS m, CAST(c_custkey AS STRING) AS customer_id, CAST(c_custkey%500 AS STRING) AS customer_unique_id,
  CAST(10000+c_custkey AS STRING) AS customer_zip_code, c_mktsegment AS customer_city, n_name AS customer_state,
  (c_custkey%211=0) AS is_deleted
FROM customer JOIN nation ON c_nationkey=n_nationkey""",
    "products": """
SELECT p_partkey AS m, CAST(p_partkey AS STRING) AS product_id, CASE WHEN p_partkey%113=0 THEN NULL ELSE p_type END AS product_category,
  CAST(LENGTH(p_name) AS INT) AS product_name_length, CAST(p_size*10 AS INT) AS product_desc_length, CAST(p_partkey%6 AS INT) AS product_photos_qty,
  CAST(p_size*100 AS INT) AS product_weight_g, CAST(p_size AS INT) AS product_length_cm, CAST(p_size+1 AS INT) AS product_height_cm,
  CAST(p_size+2 AS INT) AS product_width_cm, (p_partkey%103=0) AS is_deleted
FROM part""",
    "sellers": """
SELECT s_suppkey AS m, CAST(s_suppkey AS STRING) AS seller_id, CAST(20000+s_suppkey AS STRING) AS seller_zip_code, s_name AS seller_city,
  n_name AS seller_state, (s_suppkey%41=0) AS is_deleted
FROM supplier JOIN nation ON s_nationkey=n_nationkey""",
    "order_payments": """
SELECT o_orderkey*10+n AS m, CAST(o_orderkey AS STRING) AS order_id, n AS payment_sequential,
  LOWER(SUBSTR(o_orderpriority, 3)) AS payment_type,
  CAST(1+o_orderkey%12 AS INT) AS payment_installments, CAST(o_totalprice AS DECIMAL(10,2)) AS payment_value, FALSE AS is_deleted
FROM orders CROSS JOIN (SELECT 1 AS n UNION ALL SELECT 2) WHERE n=1 OR o_orderkey%20=0""",
    "order_reviews": """
SELECT o_orderkey*10+1 AS m, CAST(o_orderkey*10+1 AS STRING) AS review_id, CAST(o_orderkey AS STRING) AS order_id,
  CAST(SUBSTR(o_orderpriority, 1, 1) AS INT) AS review_score,
  CASE WHEN o_orderkey%5=0 THEN NULL ELSE o_orderpriority END AS review_comment_title, CAST(NULL AS STRING) AS review_comment_msg,
  o_orderdate + INTERVAL '1' DAY * CAST(o_orderkey%30 AS INT) AS review_creation_date,
  o_orderdate + INTERVAL '1' DAY * CAST(o_orderkey%30+o_orderkey%5 AS INT) AS review_answer_date, (o_orderkey%307=0) AS is_deleted
FROM orders""",
}

# ---- the change history: one branch per case ----


def _case(entity: str, kind: str, batch: int, late: int, seq: int, where: str = "TRUE", status: str = "NULL") -> str:
    return (
        f"SELECT '{entity}' AS entity, m, '{kind}' AS kind, {batch} AS batch, CAST({T0 + late} AS BIGINT) AS ts_ms, "
        f"m*6+{seq} AS seq, CAST({status} AS STRING) AS set_status, {'status' if entity == 'orders' else 'NULL'} AS final_status "
        f"FROM s_{entity} WHERE {where}"
    )


_FIRST = "CASE WHEN m%3=0 THEN 'created' END"
HISTORY = {
    "orders": [
        _case("orders", "r", 1, 0, 0, status=_FIRST),
        _case("orders", "r", 1, 0, 0, "m%53=0", _FIRST),
        _case("orders", "u", 2, 1000, 1, "m%3=0", "CASE WHEN m%177=0 THEN 'tie_loser' END"),
        _case("orders", "u", 2, 1000, 2, "m%59=0"),
        _case("orders", "u", 2, -1000, 3, "m%101=0", "'late'"),
        _case("orders", "d", 2, 2000, 4, "m%97=0"),
        _case("orders", "tombstone", 2, 2000, 4, "m%97=0"),
        _case("orders", "junk", 2, 0, 0, "m%500=0"),
        _case("orders", "c", 3, 3000, 5, "m%194=0"),
    ],
    **{
        name: [_case(name, "r", 1, 0, 0), _case(name, "d", 2, 2000, 4, "is_deleted")]
        for name in MAPPED if name != "orders"
    },
}
ALL = tuple(MAPPED)


def state(body: str, *names: str) -> str:
    """``body`` over the mapped tables ``s_<entity>``."""
    return "WITH " + ",\n".join(f"s_{n} AS ({MAPPED[n]})" for n in names) + "\n" + body


def history(body: str, *names: str) -> str:
    """``body`` over ``records`` (all broker records) and ``events`` (the change events among them)."""
    names = names or ALL
    union = "\nUNION ALL ".join(branch for n in names for branch in HISTORY[n])
    records = f"""records AS (SELECT *, make_timestamp((ts_ms + (m%60)*1000 + 250)*1000) AS arrived FROM ({union})),
events AS (SELECT * FROM records WHERE kind IN ('r','c','u','d'))
"""
    return state("", *names).rstrip() + ",\n" + records + body


LOG_COLUMNS = """SELECT entity AS source_table, kind AS _cdc_op, ts_ms AS _cdc_source_ts_ms, ts_ms+200 AS _cdc_event_ts_ms,
  arrived AS _cdc_ingested_at, 'shop.public.' || entity AS _cdc_topic, CAST(m%3 AS INT) AS _cdc_partition, seq AS _cdc_offset,
  kind IN ('u','d') AS has_before, kind<>'d' AS has_after,
  CASE WHEN kind<>'d' THEN COALESCE(set_status, final_status) END AS after_status FROM events"""

# ---- state after batches, from the mapping ----

_LAST_OP = {
    1: ("'r'", str(T0), "m*6", "1"),
    2: (
        "CASE WHEN m%97=0 THEN 'd' WHEN m%59=0 OR m%3=0 THEN 'u' ELSE 'r' END",
        f"CASE WHEN m%97=0 THEN {T0+2000} WHEN m%59=0 OR m%3=0 THEN {T0+1000} ELSE {T0} END",
        "m*6 + CASE WHEN m%97=0 THEN 4 WHEN m%59=0 THEN 2 WHEN m%3=0 THEN 1 ELSE 0 END",
        "CASE WHEN m%97=0 OR m%59=0 OR m%3=0 THEN 2 ELSE 1 END",
    ),
    "2u": (
        "CASE WHEN m%59=0 OR m%3=0 THEN 'u' ELSE 'r' END",
        f"CASE WHEN m%59=0 OR m%3=0 THEN {T0+1000} ELSE {T0} END",
        "m*6 + CASE WHEN m%59=0 THEN 2 WHEN m%3=0 THEN 1 ELSE 0 END",
        "CASE WHEN m%59=0 OR m%3=0 THEN 2 ELSE 1 END",
    ),
    3: (
        "CASE WHEN m%194=0 THEN 'c' WHEN m%97=0 THEN 'd' WHEN m%59=0 OR m%3=0 THEN 'u' ELSE 'r' END",
        f"CASE WHEN m%194=0 THEN {T0+3000} WHEN m%97=0 THEN {T0+2000} WHEN m%59=0 OR m%3=0 THEN {T0+1000} ELSE {T0} END",
        "m*6 + CASE WHEN m%194=0 THEN 5 WHEN m%97=0 THEN 4 WHEN m%59=0 THEN 2 WHEN m%3=0 THEN 1 ELSE 0 END",
        "CASE WHEN m%194=0 THEN 3 WHEN m%97=0 OR m%59=0 OR m%3=0 THEN 2 ELSE 1 END",
    ),
    "d": ("'d'", str(T0 + 2000), "m*6+4", "2"),
}
# Status after a batch: 'created' until the update of batch 2; a lone update that ties keeps its mark.
_STATUS = {
    1: "COALESCE(CASE WHEN m%3=0 THEN 'created' END, status)",
    2: "CASE WHEN m%177=0 AND m%59<>0 AND m%97<>0 THEN 'tie_loser' ELSE status END",
    3: "status", "d": "status",
}
_STATUS["2u"] = "CASE WHEN m%177=0 AND m%59<>0 THEN 'tie_loser' ELSE status END"
_DELETED = {1: "FALSE", 2: "m%97=0", "2u": "FALSE", 3: "is_deleted", "d": "TRUE"}


def order_state(after, timed: bool = True, where: str = "TRUE") -> str:
    op, ts, offset, batch = _LAST_OP[after]
    moment = f", TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' MINUTE * CAST({batch} AS INT) AS _silver_updated_at" if timed else ""
    return state(
        f"""SELECT order_id, customer_id, {_STATUS[after]} AS status, purchased_at, estimated_delivery_date,
  {_DELETED[after]} AS is_deleted, {op} AS _cdc_op, CAST({ts} AS BIGINT) AS _cdc_source_ts_ms, {offset} AS _cdc_offset{moment}
FROM s_orders WHERE {where}""", "orders",
    )


def entity_state(name: str) -> str:
    if name == "orders":
        op, ts, offset, _ = _LAST_OP[3]
    else:
        op, ts, offset = "CASE WHEN is_deleted THEN 'd' ELSE 'r' END", f"{T0} + CASE WHEN is_deleted THEN 2000 ELSE 0 END", "m*6 + CASE WHEN is_deleted THEN 4 ELSE 0 END"
    return state(
        f"SELECT * EXCLUDE (m, is_deleted), {op} AS _cdc_op, CAST({ts} AS BIGINT) AS _cdc_source_ts_ms, "
        f"CAST({offset} AS BIGINT) AS _cdc_offset, is_deleted FROM s_{name}", name,
    )


# ---- analytic queries and reports: facts are folded per order in subqueries first ----

_SHARE = "ROUND(100e0 * {} / {}, 2) AS {}"
_SALE_TABLES, _SELLER_TABLES = ("orders", "order_items", "products"), ("sellers", "order_items", "orders")
_REVIEW_TABLES = ("order_reviews", "orders", "customers")

_DAILY = """SELECT done.day AS order_date, kind.label AS category, CAST(SUM(line.value) AS DECIMAL(20,2)) AS total_revenue,
 CAST(SUM(line.freight) AS DECIMAL(20,2)) AS total_freight, COUNT(DISTINCT line.order_id) AS order_count,
 COUNT(DISTINCT done.buyer) AS unique_customers
FROM (SELECT order_id, product_id, SUM(price) AS value, SUM(freight_value) AS freight FROM s_order_items WHERE NOT is_deleted GROUP BY ALL) line,
 (SELECT order_id, customer_id AS buyer, CAST(purchased_at AS DATE) AS day FROM s_orders WHERE status = 'delivered' AND NOT is_deleted) done,
 (SELECT product_id, product_category AS label FROM s_products WHERE NOT is_deleted) kind
WHERE line.order_id = done.order_id AND line.product_id = kind.product_id GROUP BY ALL"""


def _top(delivered: str) -> str:
    """``delivered``: what of a seller's order counts as delivered, its lines or the order."""
    return f"""SELECT who.seller_id, who.seller_city, who.seller_state, COUNT(*) AS total_orders, CAST(SUM(sale.value) AS DECIMAL(20,2)) AS gmv,
 CAST(SUM(sale.freight) AS DECIMAL(20,2)) AS total_freight, {_SHARE.format(f"SUM(sale.{delivered})", "COUNT(*)", "delivery_rate_pct")},
 SUM(sale.days)::DOUBLE / NULLIF(SUM(sale.timed), 0) AS avg_delivery_days
FROM s_sellers who, (
 SELECT line.seller_id, line.order_id, SUM(line.price) AS value, SUM(line.freight_value) AS freight,
  COUNT(*) FILTER (head.status = 'delivered') AS done_lines, MAX((head.status = 'delivered')::INT) AS done_orders,
  SUM(date_diff('day', head.purchased_at, head.delivered_customer_at)) AS days, COUNT(head.delivered_customer_at) AS timed
 FROM s_order_items line JOIN s_orders head USING (order_id) WHERE NOT line.is_deleted AND NOT head.is_deleted GROUP BY ALL) sale
WHERE sale.seller_id = who.seller_id AND NOT who.is_deleted GROUP BY ALL"""


_BY_LINES, _BY_ORDERS = _top("done_lines"), _top("done_orders")

_SENTIMENT = f"""SELECT place AS customer_state, COUNT(*) AS review_count, ROUND(AVG(score), 2) AS avg_score, COUNT(*) FILTER (score > 3) AS positive_count,
 COUNT(*) FILTER (score = 3) AS neutral_count, COUNT(*) FILTER (score < 3) AS negative_count,
 {_SHARE.format("COUNT(*) FILTER (score > 3)", "COUNT(*)", "positive_rate_pct")}
FROM (SELECT said.review_score AS score, (SELECT home.customer_state FROM s_customers home WHERE home.customer_id = head.customer_id) AS place
 FROM s_order_reviews said JOIN s_orders head USING (order_id) WHERE NOT said.is_deleted AND NOT head.is_deleted
  AND EXISTS (SELECT 1 FROM s_customers home WHERE home.customer_id = head.customer_id AND NOT home.is_deleted)) GROUP BY place"""
_FUNNEL = f"""SELECT date_trunc('week', purchased_at)::TIMESTAMP AS order_week, COUNT(*) AS total_created, COUNT(approved_at) AS approved,
 COUNT(*) FILTER (list_contains(['delivered', 'invoiced', 'processing', 'shipped'], status)) AS invoiced_or_later,
 COUNT(delivered_carrier_at) AS shipped, COUNT(*) FILTER (status = 'delivered') AS delivered, COUNT(*) FILTER (status = 'canceled') AS canceled,
 {_SHARE.format("COUNT(*) FILTER (status = 'delivered')", "COUNT(*)", "delivery_rate_pct")}
FROM s_orders WHERE NOT is_deleted GROUP BY ALL"""


def _within(days: int) -> str:
    return f"COUNT(*) FILTER (again <= start + INTERVAL {days} DAY)"


_COHORTS = state(
    f"""SELECT date_trunc('month', start)::TIMESTAMP AS cohort_month, COUNT(*) AS cohort_size, {_within(30)} AS retained_30d,
 {_within(60)} AS retained_60d, {_within(90)} AS retained_90d, {_SHARE.format(_within(90), "COUNT(*)", "retention_90d_pct")}
FROM (SELECT start, MIN(bought.purchased_at) FILTER (bought.purchased_at > start) AS again
 FROM (SELECT *, MIN(purchased_at) OVER (PARTITION BY customer_id) AS start FROM s_orders WHERE status <> 'canceled' AND NOT is_deleted) bought
 GROUP BY bought.customer_id, start) GROUP BY ALL""", "orders",
)

# ---- quality ----

_GOLD = f", g_daily AS ({_DAILY}), g_sellers AS ({_BY_LINES}), g_reviews AS ({_SENTIMENT}), g_funnel AS ({_FUNNEL})\n"
_GOLD_NAMES = {"g_daily": "daily_revenue", "g_sellers": "top_sellers", "g_reviews": "review_sentiment_by_state", "g_funnel": "order_funnel"}


def _nulls(view: str, table: str, *columns: str) -> list[str]:
    return [f"SELECT '{table}' AS table_name, '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS violations FROM {view}" for c in columns]


def _repeats(view: str, table: str, *key: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{','.join(key)}' AS column_name, COUNT(*) AS violations FROM "
        f"(SELECT 1 FROM {view} WHERE {' AND '.join(k + ' IS NOT NULL' for k in key)} GROUP BY {', '.join(key)} HAVING COUNT(*)>1)"
    )


def _union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


# Every seventh order was moved by 45 days, or lost its time; that update also revives it.
_MOVED = f"""SELECT * REPLACE (CASE WHEN m%35=0 THEN NULL WHEN m%7=0 THEN purchased_at + INTERVAL 45 DAY ELSE purchased_at END AS purchased_at,
 (is_deleted AND m%7<>0) AS is_deleted) FROM ({MAPPED["orders"]})"""


def _after_moves(body: str, *names: str) -> str:
    return "WITH " + ",\n".join(f"s_{n} AS ({_MOVED if n == 'orders' else MAPPED[n]})" for n in names) + "\n" + body


_LISTED = f"""SELECT 'daily_revenue' AS report, order_date::VARCHAR AS group_key, category AS label, total_revenue AS amount, order_count AS row_count FROM ({_DAILY})
UNION ALL SELECT 'top_sellers', seller_id, seller_state, gmv, total_orders FROM ({_BY_LINES})
UNION ALL SELECT 'review_sentiment_by_state', customer_state, customer_state, NULL, review_count FROM ({_SENTIMENT})
UNION ALL SELECT 'order_funnel', order_week::DATE::VARCHAR, NULL, NULL, total_created FROM ({_FUNNEL})"""

_ROLLUP = """, sold AS (SELECT DISTINCT o.order_id, o.customer_id, o.purchased_at::DATE AS day FROM s_orders o JOIN s_order_items i USING (order_id) JOIN s_products p USING (product_id)
 WHERE o.status = 'delivered' AND NOT o.is_deleted AND NOT i.is_deleted AND NOT p.is_deleted)
""" + "\nUNION ALL ".join(
    f"SELECT '{grain}' AS grain, date_trunc('{grain}', day)::DATE AS period, COUNT(DISTINCT order_id) AS orders, COUNT(DISTINCT customer_id) AS customers FROM sold GROUP BY 1, 2"
    for grain in ("day", "week", "month"))

KEYS = {
    "orders": ("order_id",), "order_items": ("order_id", "order_item_id"), "customers": ("customer_id",),
    "products": ("product_id",), "sellers": ("seller_id",), "order_payments": ("order_id", "payment_sequential"),
    "order_reviews": ("review_id", "order_id"),
}
_REFERENCES = (
    ("orders", "customer_id", "customers"), ("order_items", "order_id", "orders"), ("order_items", "product_id", "products"),
    ("order_items", "seller_id", "sellers"), ("order_payments", "order_id", "orders"), ("order_reviews", "order_id", "orders"),
)


def _checks() -> str:
    """All rules; every seventh customer never came."""
    required = {n: (*key, "is_deleted", "_silver_updated_at") for n, key in KEYS.items()}
    lost = _union([_orphans(*r) for r in _REFERENCES])
    keys = _union([_repeats(f"s_{n}", n, *key) for n, key in KEYS.items()])
    nulls = _union([part for n, columns in required.items() for part in _nulls(f"(SELECT *, TIMESTAMP '2024-01-01' AS _silver_updated_at FROM s_{n})", n, *columns)])
    return "WITH " + ",\n".join(f"s_{n} AS (SELECT * FROM ({body}){' WHERE m%7<>0' if n == 'customers' else ''})" for n, body in MAPPED.items()) + f"""
SELECT table_name || '.' || column_name AS checked, 'reference' AS rule, missing_keys, violations FROM ({lost})
UNION ALL SELECT table_name || '.' || column_name, 'key', NULL, violations FROM ({keys})
UNION ALL SELECT table_name || '.' || column_name, 'not null', NULL, violations FROM ({nulls})
UNION ALL SELECT 'order_reviews', 'score', COUNT(*), COUNT(*) FILTER (review_score NOT BETWEEN 1 AND 5) FROM s_order_reviews"""


def _orphans(child: str, column: str, parent: str) -> str:
    return (
        f"SELECT '{child}' AS table_name, '{column}' AS column_name, '{parent}' AS parent_table, COUNT(DISTINCT {column}) AS missing_keys, "
        f"COUNT(*) AS violations FROM s_{child} c WHERE {column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM s_{parent} p WHERE p.{column}=c.{column})"
    )


# ---- metrics ----

_LATENCY = "(epoch_us(arrived)/1e6 - ts_ms/1000.0)"
_BOUNDS = (0, 5, 10, 25, 50, 75, 100, 250, 500, 750, 1000, 2500, 5000, 7500, 10000)
_SPAN = "(epoch_us(MAX({0}))-epoch_us(MIN({0})))/1e6"


def _rates(moment: str, rows: str = "row_count") -> str:
    span = _SPAN.format(moment)
    return (
        f"COUNT(*) AS {rows}, ROUND({span},1) AS duration_s, ROUND(CAST(COUNT(*) AS DOUBLE)/GREATEST({span},1.0),1) AS rows_per_sec, "
        f"{span}<1.0 AS is_clamped"
    )


def _le(value: str) -> str:
    return "CASE " + " ".join(f"WHEN {value} <= {b} THEN '{b}'" for b in _BOUNDS) + " ELSE '+Inf' END"


_STREAM_LATENCY = f"GREATEST(0.0, {_LATENCY})"
_EDGES = ", ".join(f"({i}, {_BOUNDS[i-1] if i else 0}, {b})" for i, b in enumerate(_BOUNDS))
_P95 = f""", edges(position, low, high) AS (VALUES {_EDGES}),
counted AS (SELECT time_bucket(INTERVAL '10 seconds', arrived) AS window_start, {_le(_STREAM_LATENCY)} AS le, COUNT(*) AS n FROM events GROUP BY 1,2),
placed AS (SELECT window_start, n, e.*, SUM(n) OVER (PARTITION BY window_start ORDER BY position) AS upto, SUM(n) OVER (PARTITION BY window_start) AS total
 FROM counted JOIN edges e ON CAST(e.high AS STRING)=le)
SELECT window_start, ROUND(CASE WHEN position=0 THEN 0.0 ELSE low+(high-low)*(0.95*total-(upto-n))/n END, 3) AS p95_s, CAST(total AS BIGINT) AS n
FROM placed WHERE upto>=0.95*total AND upto-n<0.95*total"""


def _updated(name: str) -> str:
    batch = _LAST_OP[3][3] if name == "orders" else "CASE WHEN is_deleted THEN 2 ELSE 1 END"
    return f"SELECT '{name}' AS table_name, TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' MINUTE * CAST({batch} AS INT) AS moment FROM s_{name}"


def _partition_counts() -> str:
    def counted(table: str, kind: str, part: str) -> str:
        return f"SELECT '{table}' AS table_name, '{kind}' AS transform, CAST({part} AS STRING) AS part, COUNT(*) AS row_count FROM s_{table} GROUP BY 3"

    month = "CAST(date_trunc('month', {}) AS DATE)"
    bucket = "SELECT '{0}' AS table_name, 'bucket' AS transform, 'one of 8 per key' AS part, COUNT(*) AS row_count FROM s_{0}"
    return _union([
        counted("orders", "month", month.format("purchased_at")), bucket.format("order_items"),
        counted("customers", "identity", "customer_state"), counted("products", "identity", "product_category"),
        counted("sellers", "identity", "seller_state"), bucket.format("order_payments"),
        counted("order_reviews", "month", month.format("review_creation_date")), counted("orders", "day", "CAST(purchased_at AS DATE)"),
    ])


_MESSAGE = "('said \"' || CAST(m AS STRING) || '\"' || chr(10) || 'and, then, no more')"


def _export(name: str) -> str:
    """Fields filled, told from the rows by counting those that are missing."""
    reviews = name == "order_reviews"
    chars = f"SUM(length({_MESSAGE}))::BIGINT" if reviews else "0::BIGINT"
    filled = "list_sum(list_transform(json_extract(to_json(r), '$.*'), lambda v: (v::STRING <> 'null')::INT))"
    # m and is_deleted are no fields of an export; a review's text is put in by the export
    return f"SELECT '{name}' AS table_name, COUNT(*) AS row_count, SUM({filled} - 2 + {int(reviews)})::BIGINT AS filled_fields, {chars} AS text_chars FROM s_{name} r"


_SNAPSHOT = state(
    f"""SELECT 'r' AS _cdc_op, CAST({T0} AS BIGINT) AS _cdc_source_ts_ms, CAST({T0} AS BIGINT) AS _cdc_event_ts_ms,
 TIMESTAMP '2024-01-01 00:00:00' AS _cdc_ingested_at, 'shop.public.customers' AS _cdc_topic, CAST(0 AS INT) AS _cdc_partition,
 CAST(0 AS BIGINT) AS _cdc_offset, CAST(NULL AS STRING) AS before_json,
 '{{"customer_id":"' || customer_id || '","customer_unique_id":"' || customer_unique_id || '","customer_zip_code":"' || customer_zip_code ||
 '","customer_city":"' || customer_city || '","customer_state":"' || customer_state || '"}}' AS after_json,
 'customers' AS source_table, DATE '2024-01-01' AS ingest_date FROM s_customers""", "customers",
)

ORACLE: dict[str, str] = {
    **{f"silver_{name}": entity_state(name) for name in MAPPED},
    "q01_daily_revenue": state(
        f"SELECT order_date, category, total_revenue, order_count FROM ({_DAILY}) ORDER BY 1 DESC, 3 DESC", *_SALE_TABLES),
    "q02_top_sellers": state(
        f"SELECT seller_id, seller_state, total_orders, gmv, delivery_rate_pct FROM ({_BY_LINES}) ORDER BY gmv DESC, seller_id LIMIT 100",
        *_SELLER_TABLES),
    "q03_review_sentiment": state(f"SELECT * EXCLUDE (positive_rate_pct) FROM ({_SENTIMENT}) ORDER BY review_count DESC", *_REVIEW_TABLES),
    **{
        name: state(f"SELECT * EXCLUDE (invoiced_or_later) FROM ({_FUNNEL}) ORDER BY order_week DESC", "orders")
        for name in ("q04_order_funnel", "q04_order_funnel_distinct")
    },
    **{name: _COHORTS for name in ("q05_cohort_retention", "q05_cohort_retention_window", "q05_cohort_retention_join")},
    "gold_daily_revenue": state(_DAILY, *_SALE_TABLES),
    "gold_top_sellers": state(_BY_LINES, *_SELLER_TABLES),
    "gold_top_sellers_order_rate": state(_BY_ORDERS, *_SELLER_TABLES),
    "gold_review_sentiment_by_state": state(_SENTIMENT, *_REVIEW_TABLES),
    "gold_order_funnel": state(_FUNNEL, "orders"),
    "gold_stream_refresh": state(_FUNNEL, "orders"),
    "gold_batch_refresh": state(_DAILY, *_SALE_TABLES),
    "gold_delta_refresh": _after_moves(_LISTED, "orders", "order_items", "products", "sellers", "order_reviews", "customers"),
    "gold_distinct_rollup": state(_ROLLUP, *_SALE_TABLES),
    "silver_partitioned_merge": _after_moves("SELECT order_id, status, purchased_at, is_deleted, date_trunc('month', purchased_at)::DATE AS purchased_at_month FROM s_orders", "orders"),
    "mv_q01": state(
        f"SELECT order_date, category, total_revenue, order_count FROM ({_DAILY}) ORDER BY order_date DESC, total_revenue DESC, category ASC NULLS LAST LIMIT 100",
        *_SALE_TABLES),
    "mv_q02": state(
        f"SELECT seller_id, seller_state, total_orders, gmv, delivery_rate_pct FROM ({_BY_LINES}) ORDER BY gmv DESC, seller_id LIMIT 50",
        *_SELLER_TABLES),
    "mv_q03": state(
        f"SELECT customer_state, review_count, avg_score, positive_count, positive_rate_pct FROM ({_SENTIMENT}) ORDER BY review_count DESC, customer_state",
        *_REVIEW_TABLES),
    "mv_q04": state(
        f"SELECT order_week, total_created, delivered, canceled, delivery_rate_pct FROM ({_FUNNEL}) ORDER BY order_week DESC LIMIT 52", "orders"),
    "active_rows": state(
        _union([f"SELECT '{n}' AS table_name, COUNT(*) AS row_count, COUNT(*) FILTER (WHERE is_deleted=false) AS active_count FROM s_{n}" for n in ALL]), *ALL),
    "bronze_parse": history(LOG_COLUMNS),
    "bronze_malformed_count": history(
        """SELECT 'shop.public.' || entity AS topic, CASE kind WHEN 'tombstone' THEN 'tombstone' WHEN 'junk' THEN 'malformed' ELSE 'event' END AS kind,
 COUNT(*) AS records FROM records GROUP BY 1,2"""),
    "bronze_route_counts": history(
        "SELECT entity AS source_table, CAST(arrived AS DATE) AS ingest_date, COUNT(*) AS row_count, COUNT(*) FILTER (WHERE kind='d') AS deletes FROM events GROUP BY 1,2"),
    "bronze_scan": history(LOG_COLUMNS, "orders"),
    "bronze_incremental": history(LOG_COLUMNS + " WHERE arrived > TIMESTAMP '2024-01-01 00:00:30'", "orders"),
    "bronze_closed_days": history(
        """, dated AS (SELECT DATE '2024-01-01' + CAST(batch AS INT) AS ingest_date, CASE WHEN seq%4=0 THEN 'late run' ELSE 'run' END AS run_id,
 CAST(batch AS BIGINT) AS batch_id, kind AS _cdc_op, ts_ms AS _cdc_source_ts_ms, seq AS _cdc_offset FROM events)
SELECT 'all' AS part, * FROM dated UNION ALL SELECT 'new', * FROM dated WHERE ingest_date > DATE '2024-01-02'""", "orders"),
    "bronze_snapshot_encode": _SNAPSHOT,
    "bronze_stream_ingest": history(
        """SELECT entity AS source_table, kind AS _cdc_op, COUNT(*) AS row_count, MIN(seq) AS first_offset, MAX(seq) AS last_offset,
 COUNT(DISTINCT m%3) AS partitions FROM events GROUP BY 1,2"""),
    "bronze_stream_dedup": history(
        """SELECT entity AS source_table, kind AS _cdc_op, COUNT(DISTINCT seq) AS row_count, MIN(seq) AS first_offset, MAX(seq) AS last_offset,
 COUNT(DISTINCT m%3) AS partitions FROM events GROUP BY 1,2"""),
    "bronze_snapshot_times": state(
        """SELECT order_id, purchased_at + INTERVAL '1' MICROSECOND * CAST(m*7919%1000000 AS INT) AS purchased_at, estimated_delivery_date
 FROM s_orders""", "orders"),
    "bronze_stream_malformed": history(
        "SELECT '__malformed__' AS source_table, 'not json' AS record_text, COUNT(*) AS row_count FROM records WHERE kind='junk' GROUP BY 1,2 HAVING COUNT(*)>0", "orders"),
    "silver_rejected_rows": history(
        """SELECT entity AS table_name, COUNT(*) AS events_read,
 COUNT(*) FILTER (WHERE entity='orders' AND kind<>'d' AND m%10=0) AS incomplete_keys,
 COUNT(*) FILTER (WHERE entity='orders' AND kind<>'d' AND m%7=0) AS undecoded_fields FROM events GROUP BY 1"""),
    "silver_payload_choice": history(
        """SELECT seq AS _cdc_offset, kind AS _cdc_op, CASE WHEN kind='d' THEN 'before' ELSE 'after' END AS image, CAST(m AS STRING) AS order_id,
 COALESCE(set_status, final_status) AS status FROM events""", "orders"),
    "decode_epoch_micros": state("SELECT order_id, epoch_us(purchased_at) AS micros, purchased_at AS decoded FROM s_orders", "orders"),
    "decode_epoch_days": state(
        "SELECT order_id, CAST(date_diff('day', DATE '1970-01-01', estimated_delivery_date) AS INT) AS days, estimated_delivery_date AS decoded FROM s_orders",
        "orders"),
    "partition_transforms": state(_partition_counts(), *ALL),
    "csv_load_roundtrip": state(
        """SELECT order_id, customer_id, status AS order_status, purchased_at AS order_purchase_timestamp, approved_at AS order_approved_at,
 delivered_carrier_at AS order_delivered_carrier, delivered_customer_at AS order_delivered_customer,
 estimated_delivery_date AS order_estimated_delivery FROM s_orders""", "orders"),
    "csv_load_exports": state(_union([_export(n) for n in ALL]), *ALL),
    "silver_dedup_latest": """SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC,
 l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
 FROM lineitem) WHERE rn=1""",
    "merge_insert": order_state(1),
    "merge_update": order_state("2u"),
    "merge_delete": order_state(2),
    "merge_delete_unknown_key": order_state("d", where="m%97=0"),
    "merge_revive": order_state(3),
    **{
        name: order_state(3, timed=False)
        for name in ("merge_late_event", "merge_replay", "silver_incremental_merge", "silver_full_rebuild", "silver_stream_state")
    },
    "merge_insert_ignore": state(
        "SELECT customer_id, CASE WHEN is_deleted THEN 'staged' ELSE customer_city END AS customer_city, customer_state, is_deleted FROM s_customers", "customers"),
    "silver_row_counts": state(
        _union([f"SELECT '{n}' AS table_name, COUNT(*) AS row_count, COUNT(*) FILTER (WHERE is_deleted) AS deleted_count FROM s_{n}" for n in ALL]), *ALL),
    "silver_as_of": state(
        _union([
            f"SELECT {v} AS version, order_id, {_STATUS[v]} AS status, {_DELETED[v]} AS is_deleted, {_LAST_OP[v][0]} AS _cdc_op FROM s_orders"
            for v in (1, 2, 3)
        ]), "orders"),
    "silver_as_of_kept": state(
        _union([
            f"SELECT {v} AS version, order_id, {_STATUS[v]} AS status, {_DELETED[v]} AS is_deleted, {_LAST_OP[v][0]} AS _cdc_op FROM s_orders"
            for v in (1, 2, 3)
        ]), "orders"),
    "dq_gold_not_null": state(
        _union([
            part for view, columns in (
                ("g_daily", ("order_date", "total_revenue", "order_count")), ("g_sellers", ("seller_id", "gmv")),
                ("g_reviews", ("customer_state", "review_count")), ("g_funnel", ("order_week", "total_created")),
            ) for part in _nulls(view, _GOLD_NAMES[view], *columns)
        ]), *ALL).replace("\nSELECT 'daily_revenue'", _GOLD + "SELECT 'daily_revenue'", 1),
    "dq_gold_unique": state(
        _union([
            _repeats(view, _GOLD_NAMES[view], c)
            for view, c in (("g_sellers", "seller_id"), ("g_reviews", "customer_state"), ("g_funnel", "order_week"))
        ]), *ALL).replace("\nSELECT 'top_sellers'", _GOLD + "SELECT 'top_sellers'", 1),
    "dq_review_score_range": state(
        "SELECT COUNT(*) AS rows_checked, COUNT(*) FILTER (WHERE review_score NOT BETWEEN 1 AND 5) AS violations FROM s_order_reviews", "order_reviews"),
    "dq_orphans": state(_union([_orphans(*r) for r in _REFERENCES]), *ALL),
    "dq_checks_by_difference": _checks(),
    "dq_silver_pk": state(
        _union([_repeats(f"s_{n}", n, *key) for n, key in KEYS.items()] + [_repeats("lineitem", "raw lines", "l_orderkey", "l_linenumber")]), *ALL),
    "dq_silver_not_null": state(
        _union([part for n, key in KEYS.items() for part in _nulls(f"(SELECT *, TIMESTAMP '2024-01-01' AS _silver_updated_at FROM s_{n})", n, *key, "is_deleted", "_silver_updated_at")]), *ALL),
    "metrics_bronze_throughput": history(f"SELECT entity AS table_name, {_rates('arrived')} FROM events GROUP BY 1"),
    "metrics_bronze_span": history(f"SELECT {_rates('arrived', 'total_rows')} FROM events"),
    "metrics_silver_throughput": state(
        f"SELECT table_name, {_rates('moment')} FROM ({_union([_updated(n) for n in ALL])}) GROUP BY 1", *ALL),
    "metrics_e2e_latency": history(
        f"""SELECT ROUND(quantile_cont({_LATENCY}, 0.50),2) AS p50_s, ROUND(quantile_cont({_LATENCY}, 0.95),2) AS p95_s,
 ROUND(quantile_cont({_LATENCY}, 0.99),2) AS p99_s, COUNT(*) AS measured_rows FROM events WHERE ts_ms > 0""", "orders"),
    "metrics_e2e_latency_approx": history(
        "SELECT TRUE AS p50_s_in_bounds, TRUE AS p95_s_in_bounds, TRUE AS p99_s_in_bounds, COUNT(*) AS measured_rows FROM events WHERE ts_ms > 0", "orders"),
    "metrics_e2e_latency_sketches": history(
        "SELECT entity AS table_name, TRUE AS p50_s_in_bounds, TRUE AS p95_s_in_bounds, TRUE AS p99_s_in_bounds, COUNT(*) AS measured_rows FROM events WHERE ts_ms > 0 GROUP BY 1"),
    # Arrival is also the moment of measuring, so latency is arrival minus commit.
    "metrics_batch_latency_by_table": history(
        f"""SELECT entity AS table_name, COUNT(*) AS records, ROUND(MIN({_STREAM_LATENCY}),3) AS min_latency_s, ROUND(MAX({_STREAM_LATENCY}),3) AS max_latency_s,
 ROUND(AVG(CAST({_STREAM_LATENCY} AS DECIMAL(20,3))),2) AS avg_latency_s FROM events GROUP BY 1"""),
    "metrics_latency_histogram": history(f"SELECT entity AS table_name, {_le(_STREAM_LATENCY)} AS le, COUNT(*) AS n FROM events GROUP BY 1,2"),
    "metrics_latency_p95_over_time": history(_P95),
    "metrics_stream_histogram": history(
        f""", streamed AS (SELECT entity, ts_ms, arrived FROM events
 UNION ALL SELECT entity, ts_ms, TIMESTAMP '2024-01-01 00:00:50' FROM events WHERE entity='orders' AND kind='d')
SELECT time_bucket(INTERVAL '10 seconds', arrived) AS window_start, entity AS table_name, {_le(_STREAM_LATENCY)} AS le, COUNT(*) AS n
FROM streamed GROUP BY 1,2,3"""),
}

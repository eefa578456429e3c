"""Independent SQL formulation of every registered query (DuckDB dialect).

Written the straightforward way on purpose — row_number() dedup, rank-based
quantiles via row_number over the sorted values, the literal fan-out join for
sales trends, a global rank() window — so it checks the Spark plans rather than
repeating them. Decimal results are cast to DOUBLE like ``registry.check_view``.
Averages of decimals are rounded to 6 places, as Spark's decimal ``avg`` does.
"""

from __future__ import annotations

from gustolake.sources import fixtures as FX

AS_OF = f"DATE '{FX.AS_OF.isoformat()}'"
SNAP = f"'{FX.AS_OF.isoformat()}'"
PREV_DAY = "DATE '2001-08-01'"

CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql


# --- source mapping (FIXTURES.md §3) ---------------------------------------------------
cte("src_items", r"""
SELECT CAST(c.c_nationkey AS VARCHAR) AS restaurant_id,
       CAST(o.o_orderdate AS TIMESTAMP) + to_hours(CAST(o.o_orderkey % 24 AS INTEGER)) AS creation_time_utc,
       CAST(l.l_orderkey AS VARCHAR) AS order_id,
       CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE CAST(o.o_custkey AS VARCHAR) END AS user_id,
       '' AS printed_card_number,
       o.o_orderpriority IN ('1-URGENT', '2-HIGH') AS is_loyalty,
       'USD' AS currency,
       CAST(l.l_linenumber AS VARCHAR) AS lineitem_id,
       CASE WHEN l.l_partkey % 13 = 0 THEN 'https://img.example/only'
            WHEN l.l_partkey % 11 = 0 THEN p.p_type || ' ' || 'https://img.example/c/' || CAST(l.l_partkey AS VARCHAR)
            ELSE p.p_type END AS item_category,
       p.p_name AS item_name,
       CAST(p.p_retailprice AS DECIMAL(10,2)) AS item_price,
       CAST(trunc(l.l_quantity) AS INTEGER) AS item_quantity,
       c.c_mktsegment AS app_name
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN part p ON l.l_partkey = p.p_partkey
""")

cte("src_options", r"""
SELECT CAST(l.l_orderkey AS VARCHAR) AS order_id, CAST(l.l_linenumber AS VARCHAR) AS lineitem_id,
       'Tax' AS option_group_name,
       CASE WHEN l.l_partkey % 17 = 0 THEN '' ELSE 'TAX' END AS option_name,
       CAST(CAST(p.p_retailprice AS DECIMAL(10,2)) * CAST(l.l_tax AS DECIMAL(4,2)) AS DECIMAL(10,2)) AS option_price,
       CAST(trunc(l.l_quantity) AS INTEGER) AS option_quantity
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
WHERE l.l_tax > 0
UNION ALL
SELECT CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR), 'Promo', 'DISCOUNT',
       -CAST(CAST(p.p_retailprice AS DECIMAL(10,2)) * CAST(l.l_discount AS DECIMAL(4,2)) AS DECIMAL(10,2)),
       CAST(trunc(l.l_quantity) AS INTEGER)
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
WHERE l.l_discount >= CAST(0.09 AS DOUBLE)
""")

cte("src_date_dim", r"""
SELECT CAST(d AS DATE) AS date_key, dayname(d) AS day_of_week, CAST(week(d) AS INTEGER) AS week,
       monthname(d) AS month, CAST(year(d) AS INTEGER) AS year, isodow(d) IN (6, 7) AS is_weekend,
       (month(d) = 1 AND day(d) = 1) OR (month(d) = 7 AND day(d) = 4) OR (month(d) = 12 AND day(d) = 25) AS is_holiday,
       CASE WHEN month(d) = 1 AND day(d) = 1 THEN 'New Year'
            WHEN month(d) = 7 AND day(d) = 4 THEN 'Independence'
            WHEN month(d) = 12 AND day(d) = 25 THEN 'Christmas' END AS holiday_name
FROM (SELECT unnest(generate_series(CAST(min(CAST(o_orderdate AS DATE)) AS TIMESTAMP),
                                    CAST(max(CAST(o_orderdate AS DATE)) AS TIMESTAMP) - INTERVAL 32 DAY,
                                    INTERVAL 1 DAY)) AS d
      FROM orders)
""")

cte("split_keys", """
SELECT CAST(l_partkey AS BIGINT) * l_partkey AS key, row_number() OVER (ORDER BY l_partkey) AS rn, COUNT(*) OVER () AS n FROM lineitem
""")
cte("split_borders", """
SELECT DISTINCT key FROM split_keys WHERE list_contains([CAST(ceil(CAST(i AS DOUBLE) / 16 * n) AS BIGINT) FOR i IN range(1, 16)], rn)
""")

# --- silver ----------------------------------------------------------------------------
cte("typed_items", r"""
SELECT restaurant_id, creation_time_utc, order_id, user_id,
       NULLIF(printed_card_number, '') AS printed_card_number, is_loyalty,
       NULLIF(currency, '') AS currency, lineitem_id,
       NULLIF(trim(regexp_replace(item_category, 'https?://\S+', '', 'g'), ' '), '') AS item_category,
       NULLIF(item_name, '') AS item_name, item_price, item_quantity,
       NULLIF(app_name, '') AS app_name
FROM src_items
""")
cte("keyed_items", """
SELECT * FROM typed_items WHERE order_id IS NOT NULL AND user_id IS NOT NULL AND lineitem_id IS NOT NULL
""")
cte("dedup_items", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id, lineitem_id ORDER BY
      restaurant_id ASC NULLS FIRST, creation_time_utc ASC NULLS FIRST, user_id ASC NULLS FIRST,
      printed_card_number ASC NULLS FIRST, is_loyalty ASC NULLS FIRST, currency ASC NULLS FIRST,
      item_category ASC NULLS FIRST, item_name ASC NULLS FIRST, item_price ASC NULLS FIRST,
      item_quantity ASC NULLS FIRST, app_name ASC NULLS FIRST) AS rn
  FROM keyed_items) WHERE rn = 1
""")
cte("silver_items", """
SELECT *, CAST(creation_time_utc AS DATE) AS order_date,
       CAST(year(creation_time_utc) AS INTEGER) AS order_year,
       CAST(month(creation_time_utc) AS INTEGER) AS order_month,
       CAST(hour(creation_time_utc) AS INTEGER) AS order_hour,
       CAST(item_price * item_quantity AS DECIMAL(21,2)) AS line_revenue
FROM dedup_items
""")
cte("typed_options", """
SELECT order_id, lineitem_id, NULLIF(option_group_name, '') AS option_group_name,
       NULLIF(option_name, '') AS option_name, option_price, option_quantity
FROM src_options
""")
cte("keyed_options", "SELECT * FROM typed_options WHERE order_id IS NOT NULL AND lineitem_id IS NOT NULL")
cte("dedup_options", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id, lineitem_id, option_name ORDER BY
      option_group_name ASC NULLS FIRST, option_price ASC NULLS FIRST, option_quantity ASC NULLS FIRST) AS rn
  FROM keyed_options) WHERE rn = 1
""")
cte("silver_options", """
SELECT *, coalesce(option_price < 0, false) AS is_discount,
       CAST(option_price * option_quantity AS DECIMAL(21,2)) AS option_revenue
FROM dedup_options
""")
cte("silver_date_dim", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY date_key ORDER BY day_of_week NULLS FIRST, week NULLS FIRST,
      month NULLS FIRST, year NULLS FIRST, is_weekend NULLS FIRST, is_holiday NULLS FIRST,
      holiday_name NULLS FIRST) AS rn
  FROM src_date_dim) WHERE rn = 1
""")

# --- base ------------------------------------------------------------------------------
cte("option_rollup", """
SELECT order_id, lineitem_id, SUM(option_revenue) AS total_option_revenue,
       SUM(CASE WHEN is_discount THEN option_revenue ELSE 0 END) AS total_discount_amount,
       MAX(CAST(is_discount AS INTEGER)) AS has_discount
FROM silver_options GROUP BY order_id, lineitem_id
""")
cte("line_base", """
SELECT i.*, COALESCE(r.total_option_revenue, 0) AS total_option_revenue,
       COALESCE(r.total_discount_amount, 0) AS total_discount_amount,
       CAST(COALESCE(r.has_discount, 0) AS BOOLEAN) AS has_discount,
       i.line_revenue + COALESCE(r.total_option_revenue, 0) AS total_line_revenue
FROM silver_items i LEFT JOIN option_rollup r
  ON i.order_id = r.order_id AND i.lineitem_id = r.lineitem_id
""")
cte("order_base", """
SELECT order_id, user_id, restaurant_id, order_date, order_year, order_month, order_hour,
       is_loyalty, app_name, currency,
       SUM(total_line_revenue) AS order_revenue, SUM(total_discount_amount) AS order_discount,
       bool_or(has_discount) AS has_discount, COUNT(DISTINCT lineitem_id) AS item_count,
       SUM(total_line_revenue) + SUM(total_discount_amount) AS net_revenue
FROM line_base
GROUP BY order_id, user_id, restaurant_id, order_date, order_year, order_month, order_hour,
         is_loyalty, app_name, currency
""")

# --- customers -------------------------------------------------------------------------
cte("clv_base", """
SELECT user_id, SUM(net_revenue) AS total_clv, COUNT(DISTINCT order_id) AS total_orders,
       MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date,
       ROUND(AVG(net_revenue), 6) AS avg_order_value, bool_or(is_loyalty) AS is_loyalty
FROM order_base GROUP BY user_id
""")
cte("rfm_base", f"""
SELECT user_id, date_diff('day', MAX(order_date), {AS_OF}) AS recency_days,
       COUNT(DISTINCT order_id) AS frequency, SUM(net_revenue) AS monetary
FROM order_base GROUP BY user_id
""")
cte("recent_spend", f"""
SELECT user_id, SUM(net_revenue) AS spend_last_30d FROM order_base
WHERE date_diff('day', order_date, {AS_OF}) <= 30 GROUP BY user_id
""")
cte("prior_spend", f"""
SELECT user_id, SUM(net_revenue) AS spend_prior_30d FROM order_base
WHERE date_diff('day', order_date, {AS_OF}) > 30 AND date_diff('day', order_date, {AS_OF}) <= 60
GROUP BY user_id
""")


def _ranked(name: str, expr: str, table: str) -> None:
    cte(name, f"""
SELECT v, row_number() OVER (ORDER BY v) AS rn, COUNT(*) OVER () AS n
FROM (SELECT {expr} AS v FROM {table} WHERE {expr} IS NOT NULL)
""")


def _pick(ranked: str, p: float) -> str:
    return f"(SELECT v FROM {ranked} WHERE rn = greatest(1, CAST(ceil(CAST({p} AS DOUBLE) * n) AS BIGINT)))"


_ranked("q_clv", "total_clv", "clv_base")
_ranked("q_rec", "recency_days", "rfm_base")
_ranked("q_freq", "frequency", "rfm_base")
_ranked("q_mon", "monetary", "rfm_base")
cte("thresholds", f"""
SELECT {_pick('q_clv', 0.2)} AS clv_p20, {_pick('q_clv', 0.8)} AS clv_p80,
       {_pick('q_rec', 0.33)} AS recency_p33, {_pick('q_rec', 0.67)} AS recency_p67,
       {_pick('q_freq', 0.33)} AS frequency_p33, {_pick('q_freq', 0.67)} AS frequency_p67,
       {_pick('q_mon', 0.33)} AS monetary_p33, {_pick('q_mon', 0.67)} AS monetary_p67
""")
cte("clv_t", """
SELECT c.*, CASE WHEN total_clv >= t.clv_p80 THEN 'High' WHEN total_clv >= t.clv_p20 THEN 'Medium'
                 ELSE 'Low' END AS clv_tier
FROM clv_base c CROSS JOIN thresholds t
""")
cte("rfm_s", """
SELECT r.*,
  CASE WHEN recency_days <= t.recency_p33 THEN 3 WHEN recency_days <= t.recency_p67 THEN 2 ELSE 1 END AS r_score,
  CASE WHEN frequency >= t.frequency_p67 THEN 3 WHEN frequency >= t.frequency_p33 THEN 2 ELSE 1 END AS f_score,
  CASE WHEN monetary >= t.monetary_p67 THEN 3 WHEN monetary >= t.monetary_p33 THEN 2 ELSE 1 END AS m_score
FROM rfm_base r CROSS JOIN thresholds t
""")
cte("rfm_t", """
SELECT *, r_score + f_score + m_score AS rfm_score,
  CASE WHEN r_score = 3 AND f_score = 3 AND m_score = 3 THEN 'VIP'
       WHEN r_score = 3 AND f_score = 1 THEN 'New Customer'
       WHEN r_score = 1 AND f_score = 1 THEN 'Churn Risk'
       WHEN r_score + f_score + m_score >= 7 THEN 'Loyal'
       WHEN r_score + f_score + m_score >= 5 THEN 'Potential'
       ELSE 'At Risk' END AS segment
FROM rfm_s
""")
cte("churn_t", f"""
SELECT b.user_id, date_diff('day', MAX(b.order_date), {AS_OF}) AS days_since_last_order,
       COUNT(DISTINCT b.order_id) AS total_orders, MIN(b.order_date) AS first_order_date,
       MAX(b.order_date) AS last_order_date, SUM(b.net_revenue) AS total_spend
FROM order_base b GROUP BY b.user_id
""")
cte("churn_full", """
SELECT c.*, date_diff('day', c.first_order_date, c.last_order_date) AS tenure_days,
  CASE WHEN c.total_orders > 1
       THEN CAST(date_diff('day', c.first_order_date, c.last_order_date) AS DOUBLE) / (c.total_orders - 1) END
       AS avg_order_gap_days,
  r.spend_last_30d, p.spend_prior_30d,
  CASE WHEN p.spend_prior_30d IS NOT NULL AND p.spend_prior_30d <> 0
       THEN ROUND((CAST(r.spend_last_30d AS DOUBLE) - CAST(p.spend_prior_30d AS DOUBLE))
                  / CAST(p.spend_prior_30d AS DOUBLE), 6) * 100 END AS spend_pct_change,
  CASE WHEN c.days_since_last_order > 45 THEN 'At Risk' WHEN c.days_since_last_order > 30 THEN 'Warning'
       ELSE 'Active' END AS churn_risk_tag
FROM churn_t c LEFT JOIN recent_spend r ON c.user_id = r.user_id
               LEFT JOIN prior_spend p ON c.user_id = p.user_id
""")

# --- gold in the published schema -------------------------------------------------------
cte("g_clv", f"""
SELECT user_id, CAST(total_clv AS DOUBLE) AS total_clv, CAST(total_orders AS BIGINT) AS total_orders,
       first_order_date, last_order_date, CAST(avg_order_value AS DOUBLE) AS avg_order_value,
       is_loyalty, clv_tier, {SNAP} AS snapshot_date
FROM clv_t
""")
cte("g_rfm", f"""
SELECT user_id, CAST(recency_days AS BIGINT) AS recency_days, CAST(frequency AS BIGINT) AS frequency,
       CAST(monetary AS DOUBLE) AS monetary, CAST(r_score AS INTEGER) AS r_score,
       CAST(f_score AS INTEGER) AS f_score, CAST(m_score AS INTEGER) AS m_score,
       CAST(rfm_score AS INTEGER) AS rfm_score, segment, {SNAP} AS snapshot_date
FROM rfm_t
""")
cte("g_churn", f"""
SELECT user_id, CAST(days_since_last_order AS BIGINT) AS days_since_last_order,
       CAST(total_orders AS BIGINT) AS total_orders, first_order_date, last_order_date,
       CAST(total_spend AS DOUBLE) AS total_spend, CAST(tenure_days AS INTEGER) AS tenure_days,
       avg_order_gap_days, CAST(spend_last_30d AS DOUBLE) AS spend_last_30d,
       CAST(spend_prior_30d AS DOUBLE) AS spend_prior_30d, spend_pct_change, churn_risk_tag,
       {SNAP} AS snapshot_date
FROM churn_full
""")
cte("g_dim", """
SELECT c.*, r.recency_days, r.frequency, r.monetary, r.rfm_score, r.segment,
       h.days_since_last_order, h.churn_risk_tag
FROM g_clv c LEFT JOIN g_rfm r ON c.user_id = r.user_id LEFT JOIN g_churn h ON c.user_id = h.user_id
""")
cte("order_cats", "SELECT DISTINCT order_id, lineitem_id, item_category FROM silver_items")
cte("sales_daily", """
SELECT o.order_date, o.restaurant_id, c.item_category, SUM(o.net_revenue) AS daily_revenue,
       COUNT(DISTINCT o.order_id) AS daily_orders, COUNT(DISTINCT o.user_id) AS unique_customers,
       ROUND(AVG(o.net_revenue), 6) AS avg_order_value
FROM order_base o LEFT JOIN order_cats c ON o.order_id = c.order_id
GROUP BY o.order_date, o.restaurant_id, c.item_category
""")
cte("g_sales", """
SELECT d.order_date, d.restaurant_id, d.item_category, CAST(d.daily_revenue AS DOUBLE) AS daily_revenue,
       CAST(d.daily_orders AS BIGINT) AS daily_orders, CAST(d.unique_customers AS BIGINT) AS unique_customers,
       CAST(d.avg_order_value AS DOUBLE) AS avg_order_value, c.day_of_week, c.week, c.month, c.year,
       c.is_weekend, c.is_holiday, c.holiday_name
FROM sales_daily d LEFT JOIN silver_date_dim c ON d.order_date = c.date_key
""")
cte("loyal_cust", """
SELECT user_id, is_loyalty, SUM(net_revenue) AS total_spend, COUNT(DISTINCT order_id) AS total_orders,
       ROUND(AVG(net_revenue), 6) AS avg_order_value, MIN(order_date) AS first_order_date,
       MAX(order_date) AS last_order_date
FROM order_base GROUP BY user_id, is_loyalty
""")
cte("g_loyalty", f"""
SELECT is_loyalty, CAST(COUNT(user_id) AS BIGINT) AS customer_count,
       CAST(ROUND(AVG(total_spend), 6) AS DOUBLE) AS avg_clv, CAST(AVG(total_orders) AS DOUBLE) AS avg_orders,
       CAST(ROUND(AVG(avg_order_value), 10) AS DOUBLE) AS avg_order_value,
       CAST(SUM(total_spend) AS DOUBLE) AS total_revenue, {SNAP} AS snapshot_date
FROM loyal_cust GROUP BY is_loyalty
""")
cte("loc_base", """
SELECT restaurant_id, SUM(net_revenue) AS total_revenue, ROUND(AVG(net_revenue), 6) AS avg_order_value,
       COUNT(DISTINCT order_id) AS total_orders, COUNT(DISTINCT user_id) AS unique_customers,
       COUNT(DISTINCT order_date) AS active_days
FROM order_base GROUP BY restaurant_id
""")
cte("g_location", f"""
SELECT restaurant_id, CAST(total_revenue AS DOUBLE) AS total_revenue,
       CAST(avg_order_value AS DOUBLE) AS avg_order_value, CAST(total_orders AS BIGINT) AS total_orders,
       CAST(unique_customers AS BIGINT) AS unique_customers, CAST(active_days AS BIGINT) AS active_days,
       CASE WHEN active_days <> 0 THEN CAST(total_orders AS DOUBLE) / active_days END AS orders_per_day,
       CAST(rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS INTEGER) AS revenue_rank,
       CASE WHEN rank() OVER (ORDER BY total_revenue DESC NULLS LAST) <= 5 THEN 'Top Performer'
            WHEN rank() OVER (ORDER BY total_revenue DESC NULLS LAST) <= 10 THEN 'Mid Performer'
            ELSE 'Low Performer' END AS performance_tier,
       {SNAP} AS snapshot_date
FROM loc_base
""")
cte("disc_base", """
SELECT has_discount, order_date, COUNT(DISTINCT order_id) AS order_count,
       SUM(order_revenue) AS gross_revenue, SUM(order_discount) AS total_discount_amount,
       SUM(net_revenue) AS net_revenue, ROUND(AVG(net_revenue), 6) AS avg_order_value,
       COUNT(DISTINCT user_id) AS unique_customers
FROM order_base GROUP BY has_discount, order_date
""")
cte("g_discount", f"""
SELECT has_discount, order_date, CAST(order_count AS BIGINT) AS order_count,
       CAST(gross_revenue AS DOUBLE) AS gross_revenue, CAST(total_discount_amount AS DOUBLE) AS total_discount_amount,
       CAST(net_revenue AS DOUBLE) AS net_revenue, CAST(avg_order_value AS DOUBLE) AS avg_order_value,
       CAST(unique_customers AS BIGINT) AS unique_customers,
       CASE WHEN gross_revenue <> 0
            THEN ROUND(CAST(abs(total_discount_amount) AS DOUBLE) / CAST(gross_revenue AS DOUBLE), 6) * 100
            ELSE 0 END AS discount_rate_pct,
       {SNAP} AS snapshot_date
FROM disc_base
""")


def with_ctes(body: str) -> str:
    """``body`` prefixed by every CTE it (transitively) needs, in definition order."""
    import re

    names = list(CTES)
    needed: set[str] = set()

    def visit(text: str) -> None:
        for n in names:
            if n not in needed and re.search(rf"\b{n}\b", text):
                needed.add(n)
                visit(CTES[n])

    visit(body)
    parts = [f"{n} AS ({CTES[n]})" for n in names if n in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


ITEM_COLS = ("restaurant_id, creation_time_utc, order_id, user_id, printed_card_number, is_loyalty, currency, "
             "lineitem_id, item_category, item_name, CAST(item_price AS DOUBLE) AS item_price, item_quantity, app_name")
SILVER_ITEM_COLS = ITEM_COLS + (", order_date, order_year, order_month, order_hour, "
                                "CAST(line_revenue AS DOUBLE) AS line_revenue")
OPTION_COLS = ("order_id, lineitem_id, option_group_name, option_name, CAST(option_price AS DOUBLE) AS option_price, "
               "option_quantity")
INGEST = ("'2001-08-02' AS _ingestion_date, CAST(2001 AS INTEGER) AS _ingestion_year, "
          "CAST(8 AS INTEGER) AS _ingestion_month, CAST(2 AS INTEGER) AS _ingestion_day")
INGEST_STR = "'2001-08-02' AS _ingestion_date, '2001' AS _ingestion_year, '08' AS _ingestion_month, '02' AS _ingestion_day"

ORDER_BASE_COLS = ("order_id, user_id, restaurant_id, order_date, order_year, order_month, order_hour, is_loyalty, "
                   "app_name, currency, CAST(order_revenue AS DOUBLE) AS order_revenue, "
                   "CAST(order_discount AS DOUBLE) AS order_discount, has_discount, "
                   "CAST(item_count AS BIGINT) AS item_count, CAST(net_revenue AS DOUBLE) AS net_revenue")

BODIES: dict[str, str] = {
    "scan_source": f"SELECT {ITEM_COLS} FROM src_items",
    "source_splits": """
        SELECT CAST(split AS INTEGER) AS split, COUNT(*) AS rows FROM (
            SELECT (SELECT COUNT(*) FROM split_borders b WHERE b.key < k.key) AS split FROM split_keys k)
        GROUP BY split""",
    "bronze_ingest": f"SELECT {ITEM_COLS}, {INGEST_STR} FROM src_items",
    "bronze_roundtrip": f"SELECT {ITEM_COLS}, {INGEST} FROM src_items",
    "bronze_latest_day": f"SELECT {ITEM_COLS}, {INGEST} FROM src_items",
    "incremental_silver": f"SELECT {SILVER_ITEM_COLS} FROM silver_items",
    "incremental_customers": f"""SELECT c.user_id, CAST(c.total_clv AS DOUBLE) AS total_clv, c.total_orders, c.first_order_date,
        c.last_order_date, CAST(c.avg_order_value AS DOUBLE) AS avg_order_value, c.is_loyalty,
        CAST(r.spend_last_30d AS DOUBLE) AS spend_last_30d, CAST(p.spend_prior_30d AS DOUBLE) AS spend_prior_30d,
        CAST(date_diff('day', c.last_order_date, {AS_OF}) AS INTEGER) AS recency_days,
        CAST(date_diff('day', c.first_order_date, c.last_order_date) AS INTEGER) AS tenure_days
        FROM clv_base c LEFT JOIN recent_spend r ON c.user_id = r.user_id LEFT JOIN prior_spend p ON c.user_id = p.user_id""",
    "incremental_location": "SELECT * FROM g_location",
    "silver_roundtrip": f"SELECT {SILVER_ITEM_COLS} FROM silver_items",
    "gold_roundtrip": "SELECT * FROM g_dim",
    "published_tables": """
        SELECT 'fact_daily_clv' AS table_name, COUNT(*) AS rows FROM g_clv
        UNION ALL SELECT 'fact_rfm_segments', COUNT(*) FROM g_rfm
        UNION ALL SELECT 'fact_churn_indicators', COUNT(*) FROM g_churn
        UNION ALL SELECT 'fact_sales_trends', COUNT(*) FROM g_sales
        UNION ALL SELECT 'fact_loyalty_comparison', COUNT(*) FROM g_loyalty
        UNION ALL SELECT 'fact_location_performance', COUNT(*) FROM g_location
        UNION ALL SELECT 'fact_discount_effectiveness', COUNT(*) FROM g_discount
        UNION ALL SELECT 'dim_customer', COUNT(*) FROM g_dim""",
    "normalize_columns": f"SELECT {ITEM_COLS} FROM src_items",
    "void_to_string": f"SELECT {OPTION_COLS}, CAST(NULL AS VARCHAR) AS option_note FROM src_options",
    "strip_urls": r"""SELECT order_id, lineitem_id,
        trim(regexp_replace(item_category, 'https?://\S+', '', 'g'), ' ') AS item_category FROM src_items""",
    "blank_to_null": f"SELECT {ITEM_COLS} FROM typed_items",
    "require_keys": f"SELECT {ITEM_COLS} FROM keyed_items",
    "dedup_items": f"SELECT {ITEM_COLS} FROM dedup_items",
    "dedup_options": f"SELECT {OPTION_COLS} FROM dedup_options",
    "silver_order_items": f"SELECT {SILVER_ITEM_COLS} FROM silver_items",
    "silver_options": f"SELECT {OPTION_COLS}, is_discount, CAST(option_revenue AS DOUBLE) AS option_revenue "
                      "FROM silver_options",
    "silver_date_dim": "SELECT * FROM silver_date_dim",
    "option_rollup": """SELECT order_id, lineitem_id, CAST(total_option_revenue AS DOUBLE) AS total_option_revenue,
        CAST(total_discount_amount AS DOUBLE) AS total_discount_amount, has_discount FROM option_rollup""",
    "line_base": f"""SELECT {SILVER_ITEM_COLS}, CAST(total_option_revenue AS DOUBLE) AS total_option_revenue,
        CAST(total_discount_amount AS DOUBLE) AS total_discount_amount, has_discount,
        CAST(total_line_revenue AS DOUBLE) AS total_line_revenue FROM line_base""",
    "order_base": f"SELECT {ORDER_BASE_COLS} FROM order_base",
    "bucketed_order_base": f"SELECT {ORDER_BASE_COLS} FROM order_base",
    "clv_thresholds": "SELECT CAST(clv_p20 AS DOUBLE) AS clv_p20, CAST(clv_p80 AS DOUBLE) AS clv_p80 FROM thresholds",
    "rfm_thresholds": """SELECT CAST(recency_p33 AS INTEGER) AS recency_p33, CAST(recency_p67 AS INTEGER) AS recency_p67,
        CAST(frequency_p33 AS BIGINT) AS frequency_p33, CAST(frequency_p67 AS BIGINT) AS frequency_p67,
        CAST(monetary_p33 AS DOUBLE) AS monetary_p33, CAST(monetary_p67 AS DOUBLE) AS monetary_p67 FROM thresholds""",
    "metric_clv": "SELECT * FROM g_clv",
    "metric_rfm": "SELECT * FROM g_rfm",
    "metric_churn": "SELECT * FROM g_churn",
    "daily_spend": f"""SELECT user_id, order_date, CAST(SUM(net_revenue) AS DOUBLE) AS daily_spend,
        COUNT(DISTINCT order_id) AS daily_orders FROM order_base WHERE order_date = {PREV_DAY}
        GROUP BY user_id, order_date""",
    "dim_customer": "SELECT * FROM g_dim",
    "order_categories": "SELECT * FROM order_cats",
    "metric_sales_trends": "SELECT * FROM g_sales",
    "sales_trends_no_category": """
        SELECT d.order_date, d.restaurant_id, d.item_category, CAST(d.daily_revenue AS DOUBLE) AS daily_revenue,
               CAST(d.daily_orders AS BIGINT) AS daily_orders, CAST(d.unique_customers AS BIGINT) AS unique_customers,
               CAST(d.avg_order_value AS DOUBLE) AS avg_order_value, c.day_of_week, c.week, c.month, c.year,
               c.is_weekend, c.is_holiday, c.holiday_name
        FROM (SELECT order_date, restaurant_id, 'Unknown' AS item_category, SUM(net_revenue) AS daily_revenue,
                     COUNT(DISTINCT order_id) AS daily_orders, COUNT(DISTINCT user_id) AS unique_customers,
                     ROUND(AVG(net_revenue), 6) AS avg_order_value
              FROM order_base GROUP BY order_date, restaurant_id) d
        LEFT JOIN silver_date_dim c ON d.order_date = c.date_key""",
    "loyalty_customers": """SELECT l.user_id, l.is_loyalty, CAST(l.total_spend AS DOUBLE) AS total_spend,
        l.total_orders, CAST(l.avg_order_value AS DOUBLE) AS avg_order_value, l.first_order_date,
        l.last_order_date, c.clv_tier
        FROM loyal_cust l LEFT JOIN clv_t c ON l.user_id = c.user_id""",
    "metric_loyalty": "SELECT * FROM g_loyalty",
    "metric_location": "SELECT * FROM g_location",
    "metric_discount": "SELECT * FROM g_discount",
    "quality_report": """
        SELECT 'order_items' AS "table", 'raw' AS stage, COUNT(*) AS rows FROM typed_items
        UNION ALL SELECT 'order_items', 'dropped_null_keys',
            COUNT(*) FILTER (WHERE order_id IS NULL OR user_id IS NULL OR lineitem_id IS NULL) FROM typed_items
        UNION ALL SELECT 'order_items', 'after_dedup', COUNT(*) FROM silver_items
        UNION ALL SELECT 'order_item_options', 'raw', COUNT(*) FROM typed_options
        UNION ALL SELECT 'order_item_options', 'dropped_null_keys',
            COUNT(*) FILTER (WHERE order_id IS NULL OR lineitem_id IS NULL) FROM typed_options
        UNION ALL SELECT 'order_item_options', 'after_dedup', COUNT(*) FROM silver_options
        UNION ALL SELECT 'date_dim', 'raw', COUNT(*) FROM src_date_dim
        UNION ALL SELECT 'date_dim', 'after_dedup', COUNT(*) FROM silver_date_dim
        UNION ALL SELECT 'order_base', 'gold', COUNT(*) FROM order_base
        UNION ALL SELECT 'fact_daily_clv', 'gold', COUNT(*) FROM g_clv
        UNION ALL SELECT 'fact_rfm_segments', 'gold', COUNT(*) FROM g_rfm
        UNION ALL SELECT 'fact_churn_indicators', 'gold', COUNT(*) FROM g_churn
        UNION ALL SELECT 'fact_sales_trends', 'gold', COUNT(*) FROM g_sales
        UNION ALL SELECT 'fact_loyalty_comparison', 'gold', COUNT(*) FROM g_loyalty
        UNION ALL SELECT 'fact_location_performance', 'gold', COUNT(*) FROM g_location
        UNION ALL SELECT 'fact_discount_effectiveness', 'gold', COUNT(*) FROM g_discount
        UNION ALL SELECT 'dim_customer', 'gold', COUNT(*) FROM g_dim""",
    "cast_text": """
        WITH t AS (SELECT *, l_orderkey * 7 + l_linenumber AS k, CAST(l_quantity AS BIGINT) AS q FROM lineitem)
        SELECT l_orderkey || '-' || l_linenumber AS order_id,
            CAST(CASE WHEN k % 5 = 2 THEN NULL WHEN k % 5 <> 3 THEN q
                WHEN q * 1000000000 <= 2147483647 THEN q * 1000000000 END AS INTEGER) AS quantity,
            CASE WHEN k % 3 <> 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(12, 2)) AS DOUBLE) END AS price,
            CASE WHEN k % 4 <> 0 THEN CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) END AS sold_on,
            CASE l_returnflag WHEN 'R' THEN TRUE WHEN 'A' THEN FALSE END AS returned
        FROM t""",
    # --- serving ---------------------------------------------------------------------
    "overview_kpis": "SELECT COUNT(*) AS customers, SUM(total_clv) AS revenue, AVG(total_clv) AS avg_clv FROM g_clv",
    "churn_tag_counts": 'SELECT churn_risk_tag, COUNT(*) AS "count" FROM g_churn GROUP BY churn_risk_tag',
    "segment_counts": 'SELECT segment, COUNT(*) AS "count" FROM g_rfm GROUP BY segment',
    "at_risk_count": "SELECT COUNT(*) FILTER (WHERE churn_risk_tag = 'At Risk') AS at_risk FROM g_churn",
    "clv_tier_breakdown": "SELECT clv_tier, COUNT(*) AS customers, SUM(total_clv) AS revenue FROM g_clv GROUP BY clv_tier",
    "segment_by_tier": """SELECT segment, clv_tier, COUNT(*) AS customers, AVG(recency_days) AS avg_recency,
        AVG(frequency) AS avg_frequency, AVG(monetary) AS avg_monetary, AVG(rfm_score) AS avg_rfm_score
        FROM g_rfm r JOIN g_clv c USING (user_id) GROUP BY segment, clv_tier""",
    "segment_summary": """SELECT segment, COUNT(*) AS customers, AVG(recency_days) AS avg_recency,
        AVG(frequency) AS avg_orders, AVG(monetary) AS avg_spend FROM g_rfm GROUP BY segment""",
    "segment_summary_table": """SELECT segment AS "Segment", COUNT(*) AS "Customers", AVG(recency_days) AS "Avg Recency",
        AVG(frequency) AS "Avg Orders", AVG(monetary) AS "Avg Spend" FROM g_rfm GROUP BY segment""",
    "segment_scatter": """SELECT segment, AVG(recency_days) AS recency, AVG(frequency) AS frequency,
        AVG(monetary) AS monetary, COUNT(*) AS customers FROM g_rfm GROUP BY segment""",
    "segment_tier_pivot": """SELECT segment,
        COALESCE(SUM(CASE WHEN clv_tier = 'High' THEN 1 END), 0) AS "High",
        COALESCE(SUM(CASE WHEN clv_tier = 'Medium' THEN 1 END), 0) AS "Medium",
        COALESCE(SUM(CASE WHEN clv_tier = 'Low' THEN 1 END), 0) AS "Low"
        FROM g_rfm r JOIN g_clv c USING (user_id) GROUP BY segment""",
    "churn_summary": """SELECT churn_risk_tag, COUNT(*) AS customers, AVG(days_since_last_order) AS avg_days_inactive,
        AVG(avg_order_gap_days) AS avg_gap, AVG(total_spend) AS avg_lifetime_spend,
        AVG(spend_pct_change) AS avg_spend_change FROM g_churn GROUP BY churn_risk_tag""",
    "inactivity_buckets": """SELECT CASE WHEN days_since_last_order <= 30 THEN '0-30 days'
        WHEN days_since_last_order <= 60 THEN '31-60 days' WHEN days_since_last_order <= 90 THEN '61-90 days'
        ELSE '90+ days' END AS bucket, COUNT(*) AS customers FROM g_churn GROUP BY 1""",
    "churn_spend_trend": """SELECT churn_risk_tag, AVG(spend_last_30d) AS last_30d, AVG(spend_prior_30d) AS prior_30d
        FROM g_churn WHERE spend_prior_30d IS NOT NULL GROUP BY churn_risk_tag""",
    "spend_trend_long": """SELECT churn_risk_tag, 'Last 30 Days' AS period, AVG(spend_last_30d) AS spend
        FROM g_churn WHERE spend_prior_30d IS NOT NULL GROUP BY churn_risk_tag
        UNION ALL SELECT churn_risk_tag, 'Prior 30 Days', AVG(spend_prior_30d)
        FROM g_churn WHERE spend_prior_30d IS NOT NULL GROUP BY churn_risk_tag""",
    "at_risk_customers": """SELECT c.user_id, c.days_since_last_order, c.avg_order_gap_days, c.total_spend,
        c.spend_pct_change, c.churn_risk_tag, d.total_clv, d.clv_tier, d.total_orders
        FROM g_churn c JOIN g_clv d USING (user_id) WHERE c.churn_risk_tag = 'At Risk'
        ORDER BY d.total_clv DESC NULLS LAST, c.user_id LIMIT 50""",
    "monthly_revenue": """SELECT year, month, SUM(daily_revenue) AS revenue, SUM(daily_orders) AS orders,
        AVG(avg_order_value) AS aov, month || ' ' || CAST(year AS VARCHAR) AS period
        FROM g_sales GROUP BY year, month""",
    "revenue_by_weekday": """SELECT day_of_week, AVG(daily_revenue) AS avg_revenue, AVG(daily_orders) AS avg_orders
        FROM g_sales WHERE day_of_week IS NOT NULL GROUP BY day_of_week""",
    "holiday_vs_regular": """SELECT is_holiday, AVG(daily_revenue) AS avg_revenue, COUNT(*) AS days,
        CASE WHEN is_holiday THEN 'Holiday' ELSE 'Regular Day' END AS label
        FROM g_sales WHERE is_holiday IS NOT NULL GROUP BY is_holiday""",
    "top_categories": """SELECT item_category, SUM(daily_revenue) AS revenue, SUM(daily_orders) AS orders
        FROM g_sales WHERE item_category IS NOT NULL AND item_category <> ''
        GROUP BY item_category ORDER BY revenue DESC NULLS LAST, item_category LIMIT 15""",
    "loyalty_comparison_view": """SELECT *, CASE WHEN is_loyalty THEN 'Loyalty Members'
        WHEN NOT is_loyalty THEN 'Non-Members' END AS label FROM g_loyalty""",
    "loyalty_lift": """SELECT m.avg_clv AS loyalty_avg_clv, n.avg_clv AS non_member_avg_clv,
        m.avg_orders AS loyalty_avg_orders, n.avg_orders AS non_member_avg_orders,
        (m.avg_clv - n.avg_clv) / n.avg_clv * 100 AS clv_lift_pct
        FROM (SELECT * FROM g_loyalty WHERE is_loyalty) m, (SELECT * FROM g_loyalty WHERE NOT is_loyalty) n""",
    "location_rankings": "SELECT * FROM g_location",
    "location_kpis": """SELECT COUNT(*) AS total_locations, MAX(total_revenue) AS top_location_revenue,
        AVG(total_revenue) AS avg_revenue_per_location FROM g_location""",
    "top_locations": "SELECT * FROM g_location ORDER BY revenue_rank NULLS LAST, restaurant_id LIMIT 10",
    "location_tier_counts": 'SELECT performance_tier, COUNT(*) AS "count" FROM g_location GROUP BY performance_tier',
    "location_ranking_table": """SELECT revenue_rank AS "Rank", restaurant_id AS "Location",
        total_revenue AS "Revenue", avg_order_value AS "Avg Order", total_orders AS "Orders",
        orders_per_day AS "Orders/Day", performance_tier AS "Tier" FROM g_location""",
    "discount_summary": """SELECT has_discount, SUM(order_count) AS total_orders, SUM(gross_revenue) AS gross_revenue,
        SUM(net_revenue) AS net_revenue, SUM(total_discount_amount) AS total_discount,
        AVG(avg_order_value) AS avg_order_value, AVG(discount_rate_pct) AS avg_discount_rate,
        SUM(unique_customers) AS customers,
        CASE WHEN has_discount THEN 'Discounted Orders' WHEN NOT has_discount THEN 'Full Price Orders' END AS label
        FROM g_discount GROUP BY has_discount""",
    "discount_kpis": """SELECT MAX(CASE WHEN has_discount THEN total_orders END) AS discounted_orders,
        MAX(CASE WHEN has_discount THEN avg_discount_rate END) AS avg_discount_rate,
        MAX(CASE WHEN NOT has_discount THEN total_orders END) AS full_price_orders,
        MAX(CASE WHEN NOT has_discount THEN avg_order_value END) AS full_price_avg_order
        FROM (SELECT has_discount, SUM(order_count) AS total_orders, AVG(avg_order_value) AS avg_order_value,
                     AVG(discount_rate_pct) AS avg_discount_rate FROM g_discount GROUP BY has_discount)""",
    "discount_trend": """SELECT order_date, has_discount, SUM(net_revenue) AS revenue, SUM(order_count) AS orders,
        CASE WHEN has_discount THEN 'Discounted' WHEN NOT has_discount THEN 'Full Price' END AS label
        FROM g_discount GROUP BY order_date, has_discount""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(body) for name, body in BODIES.items()}

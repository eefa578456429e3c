"""Declared schemas: source tables, silver tables and the published gold tables.

Gold contracts follow the published table DDL: money and averages are DOUBLE,
counts BIGINT. Computation stays in DECIMAL until ``io.to_contract`` casts
at publish time.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()
DATE, TS = T.DateType(), T.TimestampType()
PRICE = T.DecimalType(10, 2)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# All names and types from here on, which must equal the source and published tables.
# --- sources (what bronze ingests) -------------------------------------------------
ORDER_ITEMS_SOURCE = _schema(
    ("restaurant_id", S), ("creation_time_utc", TS), ("order_id", S), ("user_id", S),
    ("printed_card_number", S), ("is_loyalty", B), ("currency", S), ("lineitem_id", S),
    ("item_category", S), ("item_name", S), ("item_price", PRICE), ("item_quantity", I),
    ("app_name", S),
)
ORDER_ITEM_OPTIONS_SOURCE = _schema(
    ("order_id", S), ("lineitem_id", S), ("option_group_name", S), ("option_name", S),
    ("option_price", PRICE), ("option_quantity", I),
)
DATE_DIM_SOURCE = _schema(
    ("date_key", DATE), ("day_of_week", S), ("week", I), ("month", S), ("year", I),
    ("is_weekend", B), ("is_holiday", B), ("holiday_name", S),
)

# --- silver --------------------------------------------------------------------------
# typed source columns (the cast block) followed by derived columns
SILVER_ORDER_ITEMS = _schema(
    *[(f.name, f.dataType) for f in ORDER_ITEMS_SOURCE.fields],
    ("order_date", DATE), ("order_year", I), ("order_month", I), ("order_hour", I),
    ("line_revenue", T.DecimalType(21, 2)),
)
SILVER_ORDER_ITEM_OPTIONS = _schema(
    *[(f.name, f.dataType) for f in ORDER_ITEM_OPTIONS_SOURCE.fields],
    ("is_discount", B), ("option_revenue", T.DecimalType(21, 2)),
)
SILVER_DATE_DIM = DATE_DIM_SOURCE

# natural keys used for null filtering and dedup
ORDER_ITEMS_KEY = ("order_id", "lineitem_id")
ORDER_ITEMS_REQUIRED = ("order_id", "user_id", "lineitem_id")
OPTIONS_KEY = ("order_id", "lineitem_id", "option_name")
OPTIONS_REQUIRED = ("order_id", "lineitem_id")
DATE_DIM_KEY = ("date_key",)

# --- gold (published DDL) ------------------------------------------------------------
FACT_DAILY_CLV = _schema(
    ("user_id", S), ("total_clv", D), ("total_orders", L), ("first_order_date", DATE),
    ("last_order_date", DATE), ("avg_order_value", D), ("is_loyalty", B), ("clv_tier", S),
    ("snapshot_date", S),
)
FACT_RFM_SEGMENTS = _schema(
    ("user_id", S), ("recency_days", L), ("frequency", L), ("monetary", D), ("r_score", I),
    ("f_score", I), ("m_score", I), ("rfm_score", I), ("segment", S), ("snapshot_date", S),
)
FACT_CHURN_INDICATORS = _schema(
    ("user_id", S), ("days_since_last_order", L), ("total_orders", L),
    ("first_order_date", DATE), ("last_order_date", DATE), ("total_spend", D),
    ("tenure_days", I), ("avg_order_gap_days", D), ("spend_last_30d", D),
    ("spend_prior_30d", D), ("spend_pct_change", D), ("churn_risk_tag", S),
    ("snapshot_date", S),
)
FACT_SALES_TRENDS = _schema(
    ("order_date", DATE), ("restaurant_id", S), ("item_category", S), ("daily_revenue", D),
    ("daily_orders", L), ("unique_customers", L), ("avg_order_value", D),
    ("day_of_week", S), ("week", I), ("month", S), ("year", I), ("is_weekend", B),
    ("is_holiday", B), ("holiday_name", S),
)
FACT_LOYALTY_COMPARISON = _schema(
    ("is_loyalty", B), ("customer_count", L), ("avg_clv", D), ("avg_orders", D),
    ("avg_order_value", D), ("total_revenue", D), ("snapshot_date", S),
)
FACT_LOCATION_PERFORMANCE = _schema(
    ("restaurant_id", S), ("total_revenue", D), ("avg_order_value", D), ("total_orders", L),
    ("unique_customers", L), ("active_days", L), ("orders_per_day", D),
    ("revenue_rank", I), ("performance_tier", S), ("snapshot_date", S),
)
FACT_DISCOUNT_EFFECTIVENESS = _schema(
    ("has_discount", B), ("order_date", DATE), ("order_count", L), ("gross_revenue", D),
    ("total_discount_amount", D), ("net_revenue", D), ("avg_order_value", D),
    ("unique_customers", L), ("discount_rate_pct", D), ("snapshot_date", S),
)
DIM_CUSTOMER = _schema(
    ("user_id", S), ("total_clv", D), ("total_orders", L), ("first_order_date", DATE),
    ("last_order_date", DATE), ("avg_order_value", D), ("is_loyalty", B), ("clv_tier", S),
    ("snapshot_date", S), ("recency_days", L), ("frequency", L), ("monetary", D),
    ("rfm_score", I), ("segment", S), ("days_since_last_order", L), ("churn_risk_tag", S),
)

GOLD_CONTRACTS: dict[str, T.StructType] = {
    "fact_daily_clv": FACT_DAILY_CLV,
    "fact_rfm_segments": FACT_RFM_SEGMENTS,
    "fact_churn_indicators": FACT_CHURN_INDICATORS,
    "fact_sales_trends": FACT_SALES_TRENDS,
    "fact_loyalty_comparison": FACT_LOYALTY_COMPARISON,
    "fact_location_performance": FACT_LOCATION_PERFORMANCE,
    "fact_discount_effectiveness": FACT_DISCOUNT_EFFECTIVENESS,
    "dim_customer": DIM_CUSTOMER,
}

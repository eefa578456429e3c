"""Serving queries over the published gold tables (dashboard frames).

Each function takes ``gold`` (table name -> DataFrame in the published
contract) and returns a lazy DataFrame. Row order matters only where a limit
makes it part of the answer; those sorts carry a unique tiebreaker. Top-k
queries plan as TakeOrderedAndProject (per-partition top-k, then a merge of
k rows per partition), never a full global sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustolake.functions import labels as L

Gold = dict[str, DataFrame]


def _clv(g: Gold) -> DataFrame:
    return g["fact_daily_clv"]


def _rfm(g: Gold) -> DataFrame:
    return g["fact_rfm_segments"]


def _churn(g: Gold) -> DataFrame:
    return g["fact_churn_indicators"]


def _sales(g: Gold) -> DataFrame:
    return g["fact_sales_trends"]


def _loyalty(g: Gold) -> DataFrame:
    return g["fact_loyalty_comparison"]


def _loc(g: Gold) -> DataFrame:
    return g["fact_location_performance"]


def _disc(g: Gold) -> DataFrame:
    return g["fact_discount_effectiveness"]


# --- overview ------------------------------------------------------------------------
def overview_kpis(g: Gold) -> DataFrame:
    return _clv(g).agg(
        F.count(F.lit(1)).alias("customers"), F.sum("total_clv").alias("revenue"), F.avg("total_clv").alias("avg_clv")
    )


def churn_tag_counts(g: Gold) -> DataFrame:
    return _churn(g).groupBy("churn_risk_tag").agg(F.count(F.lit(1)).alias("count"))


def segment_counts(g: Gold) -> DataFrame:
    return (
        _rfm(g).groupBy("segment").agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc_nulls_last("segment"))
    )


def at_risk_count(g: Gold) -> DataFrame:
    """Customers tagged At Risk; one row, 0 when there are none."""
    return _churn(g).agg(F.count_if(F.col("churn_risk_tag") == L.TAG_AT_RISK).alias("at_risk"))


def clv_tier_breakdown(g: Gold) -> DataFrame:
    return _clv(g).groupBy("clv_tier").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("total_clv").alias("revenue")
    )


# --- segmentation --------------------------------------------------------------------
def segment_by_tier(g: Gold) -> DataFrame:
    r = _rfm(g).select("user_id", "segment", "recency_days", "frequency", "monetary", "rfm_score")
    c = _clv(g).select("user_id", "clv_tier")
    return (
        r.join(c, "user_id")
        .groupBy("segment", "clv_tier")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.avg("recency_days").alias("avg_recency"),
            F.avg("frequency").alias("avg_frequency"),
            F.avg("monetary").alias("avg_monetary"),
            F.avg("rfm_score").alias("avg_rfm_score"),
        )
        .orderBy(F.desc("customers"), F.asc_nulls_last("segment"), F.asc_nulls_last("clv_tier"))
    )


def segment_summary(g: Gold) -> DataFrame:
    return (
        _rfm(g).groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.avg("recency_days").alias("avg_recency"),
            F.avg("frequency").alias("avg_orders"),
            F.avg("monetary").alias("avg_spend"),
        )
        .orderBy(F.desc("customers"), F.asc_nulls_last("segment"))
    )


# Column names of the displayed table.
SEGMENT_TABLE_NAMES = {
    "segment": "Segment", "customers": "Customers", "avg_recency": "Avg Recency", "avg_orders": "Avg Orders",
    "avg_spend": "Avg Spend",
}


def segment_summary_table(g: Gold) -> DataFrame:
    """The segment summary with the five display column names."""
    return segment_summary(g).select(*[F.col(src).alias(dst) for src, dst in SEGMENT_TABLE_NAMES.items()])


def segment_scatter(g: Gold) -> DataFrame:
    return _rfm(g).groupBy("segment").agg(
        F.avg("recency_days").alias("recency"),
        F.avg("frequency").alias("frequency"),
        F.avg("monetary").alias("monetary"),
        F.count(F.lit(1)).alias("customers"),
    )


def segment_tier_pivot(g: Gold) -> DataFrame:
    """Segment x CLV tier customer counts, missing cells 0. The tier values are
    fixed, so the pivot needs no extra job to discover them."""
    cells = segment_by_tier(g).select("segment", "clv_tier", "customers")
    tiers = [L.CLV_HIGH, L.CLV_MEDIUM, L.CLV_LOW]
    return cells.groupBy("segment").pivot("clv_tier", tiers).agg(F.sum("customers")).na.fill(0, subset=tiers)


# --- churn -----------------------------------------------------------------------------
def churn_summary(g: Gold) -> DataFrame:
    return _churn(g).groupBy("churn_risk_tag").agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg("days_since_last_order").alias("avg_days_inactive"),
        F.avg("avg_order_gap_days").alias("avg_gap"),
        F.avg("total_spend").alias("avg_lifetime_spend"),
        F.avg("spend_pct_change").alias("avg_spend_change"),
    )


def inactivity_buckets(g: Gold) -> DataFrame:
    return (
        _churn(g).select(L.inactivity_bucket("days_since_last_order").alias("bucket"))
        .groupBy("bucket").agg(F.count(F.lit(1)).alias("customers"))
        .orderBy("bucket")
    )


def churn_spend_trend(g: Gold) -> DataFrame:
    return (
        _churn(g).where(F.col("spend_prior_30d").isNotNull())
        .groupBy("churn_risk_tag")
        .agg(F.avg("spend_last_30d").alias("last_30d"), F.avg("spend_prior_30d").alias("prior_30d"))
    )


def spend_trend_long(g: Gold) -> DataFrame:
    """``churn_spend_trend`` melted to (churn_risk_tag, period, spend) with period labels."""
    wide = churn_spend_trend(g)
    long = wide.unpivot(["churn_risk_tag"], ["last_30d", "prior_30d"], "period", "spend")
    return long.withColumn("period", L.map_label("period", L.PERIOD_LABELS))


def at_risk_customers(g: Gold, limit: int = 50) -> DataFrame:
    c = _churn(g).where(F.col("churn_risk_tag") == L.TAG_AT_RISK).select(
        "user_id", "days_since_last_order", "avg_order_gap_days", "total_spend",
        "spend_pct_change", "churn_risk_tag",
    )
    d = _clv(g).select("user_id", "total_clv", "clv_tier", "total_orders")
    return c.join(d, "user_id").orderBy(F.desc_nulls_last("total_clv"), F.asc("user_id")).limit(limit)


# --- sales -----------------------------------------------------------------------------
def monthly_revenue(g: Gold) -> DataFrame:
    """Per (year, month name): revenue, orders, mean of daily AOVs, and a
    "Month Year" label (null for rows without calendar). Month names sort
    lexically, as in the published dashboard."""
    m = _sales(g).groupBy("year", "month").agg(
        F.sum("daily_revenue").alias("revenue"),
        F.sum("daily_orders").alias("orders"),
        F.avg("avg_order_value").alias("aov"),
    )
    m = m.withColumn("period", F.concat(F.col("month"), F.lit(" "), F.col("year").cast("string")))
    return m.orderBy(F.asc_nulls_last("year"), F.asc_nulls_last("month"))


def revenue_by_weekday(g: Gold) -> DataFrame:
    return (
        _sales(g).where(F.col("day_of_week").isNotNull())
        .groupBy("day_of_week")
        .agg(F.avg("daily_revenue").alias("avg_revenue"), F.avg("daily_orders").alias("avg_orders"))
        .orderBy(F.desc("avg_revenue"), F.asc("day_of_week"))
    )


def holiday_vs_regular(g: Gold) -> DataFrame:
    return (
        _sales(g).where(F.col("is_holiday").isNotNull())
        .groupBy("is_holiday")
        .agg(F.avg("daily_revenue").alias("avg_revenue"), F.count(F.lit(1)).alias("days"))
        .withColumn("label", L.map_label("is_holiday", L.HOLIDAY_LABELS))
    )


def top_categories(g: Gold, limit: int = 15) -> DataFrame:
    cat = F.col("item_category")
    return (
        _sales(g).where(cat.isNotNull() & (cat != ""))
        .groupBy("item_category")
        .agg(F.sum("daily_revenue").alias("revenue"), F.sum("daily_orders").alias("orders"))
        .orderBy(F.desc_nulls_last("revenue"), F.asc("item_category"))
        .limit(limit)
    )


# --- loyalty ---------------------------------------------------------------------------
def loyalty_comparison_view(g: Gold) -> DataFrame:
    return _loyalty(g).withColumn("label", L.map_label("is_loyalty", L.LOYALTY_LABELS))


def loyalty_lift(g: Gold) -> DataFrame:
    """Members vs non-members in one row; no row unless both groups exist."""
    lo = _loyalty(g)
    member, non = F.col("is_loyalty"), ~F.col("is_loyalty")
    row = lo.agg(
        F.max(F.when(member, F.col("avg_clv"))).alias("loyalty_avg_clv"),
        F.max(F.when(non, F.col("avg_clv"))).alias("non_member_avg_clv"),
        F.max(F.when(member, F.col("avg_orders"))).alias("loyalty_avg_orders"),
        F.max(F.when(non, F.col("avg_orders"))).alias("non_member_avg_orders"),
        F.count_if(member).alias("_m"),
        F.count_if(non).alias("_n"),
    )
    lift = (F.col("loyalty_avg_clv") - F.col("non_member_avg_clv")) / F.col("non_member_avg_clv") * 100
    return (
        row.where((F.col("_m") > 0) & (F.col("_n") > 0))
        .withColumn("clv_lift_pct", lift)
        .drop("_m", "_n")
    )


# --- locations -------------------------------------------------------------------------
def location_rankings(g: Gold) -> DataFrame:
    return _loc(g).orderBy(F.asc_nulls_last("revenue_rank"), F.asc("restaurant_id"))


def location_kpis(g: Gold) -> DataFrame:
    return _loc(g).agg(
        F.count(F.lit(1)).alias("total_locations"),
        F.max("total_revenue").alias("top_location_revenue"),
        F.avg("total_revenue").alias("avg_revenue_per_location"),
    )


def top_locations(g: Gold, limit: int = 10) -> DataFrame:
    return location_rankings(g).limit(limit)


def location_tier_counts(g: Gold) -> DataFrame:
    return _loc(g).groupBy("performance_tier").agg(F.count(F.lit(1)).alias("count"))


# Column names of the displayed table.
RANKING_TABLE_NAMES = {
    "revenue_rank": "Rank", "restaurant_id": "Location", "total_revenue": "Revenue",
    "avg_order_value": "Avg Order", "total_orders": "Orders", "orders_per_day": "Orders/Day",
    "performance_tier": "Tier",
}


def location_ranking_table(g: Gold) -> DataFrame:
    """The full ranking with the seven display column names."""
    ranked = location_rankings(g)
    return ranked.select(*[F.col(src).alias(dst) for src, dst in RANKING_TABLE_NAMES.items()])


# --- discounts -------------------------------------------------------------------------
def discount_summary(g: Gold) -> DataFrame:
    return (
        _disc(g).groupBy("has_discount")
        .agg(
            F.sum("order_count").alias("total_orders"),
            F.sum("gross_revenue").alias("gross_revenue"),
            F.sum("net_revenue").alias("net_revenue"),
            F.sum("total_discount_amount").alias("total_discount"),
            F.avg("avg_order_value").alias("avg_order_value"),
            F.avg("discount_rate_pct").alias("avg_discount_rate"),
            F.sum("unique_customers").alias("customers"),
        )
        .withColumn("label", L.map_label("has_discount", L.DISCOUNT_LABELS))
    )


def discount_kpis(g: Gold) -> DataFrame:
    """One row: discounted order count and mean rate, full-price count and mean AOV."""
    s = discount_summary(g)
    disc, full = F.col("has_discount"), ~F.col("has_discount")
    return s.agg(
        F.max(F.when(disc, F.col("total_orders"))).alias("discounted_orders"),
        F.max(F.when(disc, F.col("avg_discount_rate"))).alias("avg_discount_rate"),
        F.max(F.when(full, F.col("total_orders"))).alias("full_price_orders"),
        F.max(F.when(full, F.col("avg_order_value"))).alias("full_price_avg_order"),
    )


def discount_trend(g: Gold) -> DataFrame:
    return (
        _disc(g).groupBy("order_date", "has_discount")
        .agg(F.sum("net_revenue").alias("revenue"), F.sum("order_count").alias("orders"))
        .withColumn("label", L.map_label("has_discount", L.DISCOUNT_TREND_LABELS))
        .orderBy(F.asc_nulls_last("order_date"), F.asc_nulls_last("has_discount"))
    )


SERVING_QUERIES = {
    "overview_kpis": overview_kpis,
    "churn_tag_counts": churn_tag_counts,
    "segment_counts": segment_counts,
    "at_risk_count": at_risk_count,
    "clv_tier_breakdown": clv_tier_breakdown,
    "segment_by_tier": segment_by_tier,
    "segment_summary": segment_summary,
    "segment_summary_table": segment_summary_table,
    "segment_scatter": segment_scatter,
    "segment_tier_pivot": segment_tier_pivot,
    "churn_summary": churn_summary,
    "inactivity_buckets": inactivity_buckets,
    "churn_spend_trend": churn_spend_trend,
    "spend_trend_long": spend_trend_long,
    "at_risk_customers": at_risk_customers,
    "monthly_revenue": monthly_revenue,
    "revenue_by_weekday": revenue_by_weekday,
    "holiday_vs_regular": holiday_vs_regular,
    "top_categories": top_categories,
    "loyalty_comparison_view": loyalty_comparison_view,
    "loyalty_lift": loyalty_lift,
    "location_rankings": location_rankings,
    "location_kpis": location_kpis,
    "top_locations": top_locations,
    "location_tier_counts": location_tier_counts,
    "location_ranking_table": location_ranking_table,
    "discount_summary": discount_summary,
    "discount_kpis": discount_kpis,
    "discount_trend": discount_trend,
}

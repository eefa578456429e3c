"""CASE labelling rules of the metric and serving layers.

All comparisons treat null as "no match", so a null input falls through to the
last branch (null CLV -> Low, null recency -> r_score 1, null days -> Active).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------
# Labels, default thresholds and quantile levels that must equal the
# reference pipeline's rules.
CLV_HIGH, CLV_MEDIUM, CLV_LOW = "High", "Medium", "Low"
CLV_QUANTILES = (0.20, 0.80)
RFM_QUANTILES = (0.33, 0.67)
SEG_VIP, SEG_NEW, SEG_CHURN_RISK = "VIP", "New Customer", "Churn Risk"
SEG_LOYAL, SEG_POTENTIAL, SEG_AT_RISK = "Loyal", "Potential", "At Risk"
LOYAL_MIN_SCORE, POTENTIAL_MIN_SCORE = 7, 5
TAG_AT_RISK, TAG_WARNING, TAG_ACTIVE = "At Risk", "Warning", "Active"
CHURN_WARN_DAYS, CHURN_RISK_DAYS = 30, 45
SPEND_WINDOW_DAYS = 30
TIER_TOP, TIER_MID, TIER_LOW = "Top Performer", "Mid Performer", "Low Performer"
TOP_RANK, MID_RANK = 5, 10
INACTIVITY_BUCKETS = ((30, "0-30 days"), (60, "31-60 days"), (90, "61-90 days"))
INACTIVITY_OVERFLOW = "90+ days"
PERIOD_LABELS = {"last_30d": "Last 30 Days", "prior_30d": "Prior 30 Days"}
HOLIDAY_LABELS = {True: "Holiday", False: "Regular Day"}
LOYALTY_LABELS = {True: "Loyalty Members", False: "Non-Members"}
DISCOUNT_LABELS = {True: "Discounted Orders", False: "Full Price Orders"}
DISCOUNT_TREND_LABELS = {True: "Discounted", False: "Full Price"}
# ---------------------------------------------------------------------------------


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clv_tier(total_clv: Column | str, low: Column, high: Column) -> Column:
    v = _c(total_clv)
    return F.when(v >= high, CLV_HIGH).when(v >= low, CLV_MEDIUM).otherwise(CLV_LOW)


def recency_score(recency: Column | str, p_low: Column, p_high: Column) -> Column:
    """Fewer days since the last order is better: <= p_low -> 3, <= p_high -> 2."""
    v = _c(recency)
    return F.when(v <= p_low, F.lit(3)).when(v <= p_high, F.lit(2)).otherwise(F.lit(1))


def magnitude_score(value: Column | str, p_low: Column, p_high: Column) -> Column:
    """More is better: >= p_high -> 3, >= p_low -> 2, else 1."""
    v = _c(value)
    return F.when(v >= p_high, F.lit(3)).when(v >= p_low, F.lit(2)).otherwise(F.lit(1))


def rfm_segment(r: Column | str, f: Column | str, m: Column | str, score: Column | str) -> Column:
    r, f, m, s = _c(r), _c(f), _c(m), _c(score)
    return (
        F.when((r == 3) & (f == 3) & (m == 3), SEG_VIP)
        .when((r == 3) & (f == 1), SEG_NEW)
        .when((r == 1) & (f == 1), SEG_CHURN_RISK)
        .when(s >= LOYAL_MIN_SCORE, SEG_LOYAL)
        .when(s >= POTENTIAL_MIN_SCORE, SEG_POTENTIAL)
        .otherwise(SEG_AT_RISK)
    )


def churn_tag(days: Column | str, warn: int = CHURN_WARN_DAYS, risk: int = CHURN_RISK_DAYS) -> Column:
    d = _c(days)
    return F.when(d > risk, TAG_AT_RISK).when(d > warn, TAG_WARNING).otherwise(TAG_ACTIVE)


def performance_tier(rank: Column | str, top: int = TOP_RANK, mid: int = MID_RANK) -> Column:
    r = _c(rank)
    return F.when(r <= top, TIER_TOP).when(r <= mid, TIER_MID).otherwise(TIER_LOW)


def inactivity_bucket(days: Column | str) -> Column:
    d = _c(days)
    expr = None
    for upper, label in INACTIVITY_BUCKETS:
        expr = F.when(d <= upper, label) if expr is None else expr.when(d <= upper, label)
    return expr.otherwise(INACTIVITY_OVERFLOW)


def map_label(col: Column | str, mapping: dict) -> Column:
    """Value -> label; values outside the mapping (and null) give null."""
    c = _c(col)
    expr = None
    for key, label in mapping.items():
        expr = F.when(c == F.lit(key), label) if expr is None else expr.when(c == F.lit(key), label)
    return expr

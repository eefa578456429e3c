"""Row order, ties, nulls and limits of serving queries, on hand-made gold rows."""

import datetime as dt

from gustolake.functions import labels as L
from gustolake.operators import serving


def sales(spark, rows):
    return {"fact_sales_trends": spark.createDataFrame(rows, "item_category string, daily_revenue double, daily_orders long, day_of_week string")}


def test_top_categories_cut_at_fifteen_with_ties_by_name(spark):
    rows = [(f"c{i:02d}", float(100 - i // 2), 1, "Monday") for i in range(20)]
    rows += [("none", None, 1, "Monday"), (None, 999.0, 1, "Monday"), ("", 999.0, 1, "Monday")]
    got = [r["item_category"] for r in serving.top_categories(sales(spark, rows)).collect()]
    assert got == [f"c{i:02d}" for i in range(15)]
    few = [r["item_category"] for r in serving.top_categories(sales(spark, rows[18:])).collect()]
    assert few == ["c18", "c19", "none"]


def test_weekdays_by_falling_mean_then_name(spark):
    rows = [("a", 2.0, 1, "Tuesday"), ("a", 2.0, 1, "Monday"), ("a", 5.0, 1, "Sunday"), ("a", 9.0, 1, None)]
    assert [r["day_of_week"] for r in serving.revenue_by_weekday(sales(spark, rows)).collect()] == ["Sunday", "Monday", "Tuesday"]


def test_segments_by_falling_count_then_name_nulls_last(spark):
    rows = [(s, 1, 1, 1.0) for s in ("B", "A", "C", "C", None)]
    g = {"fact_rfm_segments": spark.createDataFrame(rows, "segment string, recency_days long, frequency long, monetary double")}
    for query in (serving.segment_counts, serving.segment_summary):
        assert [r["segment"] for r in query(g).collect()] == ["C", "A", "B", None]
    assert [r["Segment"] for r in serving.segment_summary_table(g).collect()] == ["C", "A", "B", None]


def test_discount_trend_by_day_then_flag(spark):
    d1, d2 = dt.date(2001, 8, 1), dt.date(2001, 8, 2)
    rows = [(True, d2, 1, 1.0), (None, None, 1, 1.0), (False, d2, 1, 1.0), (True, d1, 1, 1.0)]
    g = {"fact_discount_effectiveness": spark.createDataFrame(rows, "has_discount boolean, order_date date, order_count long, net_revenue double")}
    got = [(r["order_date"], r["has_discount"]) for r in serving.discount_trend(g).collect()]
    assert got == [(d1, True), (d2, False), (d2, True), (None, None)]


def test_segment_and_tier_by_falling_customers_then_names(spark):
    users = [("B", "Low"), ("A", "Low"), ("A", "High"), ("C", None), ("C", None), (None, "Low")]
    rfm = [(str(i), s, 1, 1, 1.0, 3) for i, (s, _) in enumerate(users)]
    g = {
        "fact_rfm_segments": spark.createDataFrame(
            rfm, "user_id string, segment string, recency_days long, frequency long, monetary double, rfm_score int"),
        "fact_daily_clv": spark.createDataFrame([(str(i), t) for i, (_, t) in enumerate(users)], "user_id string, clv_tier string"),
    }
    got = [(r["segment"], r["clv_tier"]) for r in serving.segment_by_tier(g).collect()]
    assert got == [("C", None), ("A", "High"), ("A", "Low"), ("B", "Low"), (None, "Low")]


def test_months_by_year_then_name_nulls_last(spark):
    rows = [(2001, "May", 1.0), (None, None, 4.0), (2001, "August", 2.0), (2000, "May", 3.0), (2001, "May", 5.0)]
    schema = "year int, month string, daily_revenue double, daily_orders long, avg_order_value double"
    g = {"fact_sales_trends": spark.createDataFrame([(y, m, v, 1, v) for y, m, v in rows], schema)}
    got = [(r["period"], r["revenue"]) for r in serving.monthly_revenue(g).collect()]
    assert got == [("May 2000", 3.0), ("August 2001", 2.0), ("May 2001", 6.0), (None, 4.0)]


def test_inactivity_buckets_by_label(spark):
    schema = "days_since_last_order long"
    g = {"fact_churn_indicators": spark.createDataFrame([(n,) for n in (400, 5, 45, 3, 100, 61)], schema)}
    rows = serving.inactivity_buckets(g).collect()
    assert [r["bucket"] for r in rows] == sorted(r["bucket"] for r in rows) and sum(r["customers"] for r in rows) == 6


def test_at_risk_cut_at_fifty_by_falling_value_then_user(spark):
    n = 60
    churn = [(f"u{i:02d}", 40, 10.0, 5.0, 0.0, L.TAG_AT_RISK) for i in range(n)] + [("x", 1, 1.0, 1.0, 0.0, None)]
    clv = [(f"u{i:02d}", float(i // 2) if i else None, "Low", 3) for i in range(n)] + [("x", 999.0, "High", 1)]
    g = {
        "fact_churn_indicators": spark.createDataFrame(
            churn, "user_id string, days_since_last_order long, avg_order_gap_days double, total_spend double, spend_pct_change double, churn_risk_tag string"),
        "fact_daily_clv": spark.createDataFrame(clv, "user_id string, total_clv double, clv_tier string, total_orders long"),
    }
    got = [r["user_id"] for r in serving.at_risk_customers(g).collect()]
    assert got == [f"u{i:02d}" for i in sorted(range(1, n), key=lambda i: (-(i // 2), i))][:50]

"""Customer measures kept from day to day, so that a daily run reads the new days and its own state only.

Three committed datasets under one root (``versions``):

    order_days  which orders a customer placed on a day, in folders by month
    day_parts   per customer and day: net revenue, its rows, orders seen for the first time, loyalty; in folders by month
    state       per customer: the totals and both trailing windows as of the last run

All measures but first, last and loyalty are sums, so a run adds signed rows: the
old state, the new days, and the days that have left a window since the last
run (read from their months). One aggregate by customer over these is the new
state. A day that is delivered again can't be taken out of a minimum; then the
state is built anew from ``day_parts``, which are small, and never from orders.

The state's commit names the commits of the other two it goes with, so a run that
died between two commits is as if it had not begun.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustolake.functions import labels as L
from gustolake.operators import keyset
from gustolake.session import scratch_dir
from gustolake.sources import io, versions

MONEY = T.DecimalType(38, 2)
#: What Spark's average of MONEY is.
AVERAGE = T.DecimalType(38, 6)
DAY = "order_date"
SUMS = ("revenue", "revenue_rows", "orders", "last_revenue", "last_rows", "prior_revenue", "prior_rows")


def _months(first: dt.date, last: dt.date) -> set[str]:
    return {versions.month_of(first + dt.timedelta(days=i)) for i in range((last - first).days + 1)}


def _at(spark: SparkSession, path: str, name: str | None) -> versions.Commit | None:
    return versions.load(spark, path, name) if name else None


def order_level(orders: DataFrame) -> DataFrame:
    """Order base rows -> per customer, day and order: net revenue, rows that have one, loyalty."""
    return orders.groupBy("user_id", DAY, "order_id").agg(
        F.sum("net_revenue").cast(MONEY).alias("revenue"), F.count("net_revenue").alias("revenue_rows"), F.max("is_loyalty").alias("is_loyalty")
    )


def _windows(day: Column, as_of: dt.date, width: int) -> tuple[Column, Column]:
    """Whether a day is in the last window (days to come count, as published) and in the one before."""
    age = F.datediff(F.lit(as_of), day)
    return age <= width, (age > width) & (age <= 2 * width)


def _signed(parts: DataFrame, last: Column, prior: Column, whole: bool) -> DataFrame:
    """Rows to add to the state: ``last`` and ``prior`` are the factors (1, 0, -1) of a day in the windows."""
    rev, n = F.coalesce("revenue", F.lit(0).cast(MONEY)), F.col("revenue_rows")
    nothing = F.lit(0).cast("long")
    return parts.select(
        "user_id",
        *[(c if whole else F.lit(0)).cast(t).alias(name) for name, c, t in (("revenue", rev, MONEY), ("revenue_rows", n, "long"))],
        (F.col("orders") if whole else nothing).alias("orders"),
        *[(f * c).cast(t).alias(name) for f, name in ((last, "last"), (prior, "prior")) for c, t, name in ((rev, MONEY, f"{name}_revenue"), (n, "long", f"{name}_rows"))],
        *[(F.col(DAY) if whole else F.lit(None).cast("date")).alias(c) for c in ("first_order_date", "last_order_date")],
        (F.col("is_loyalty") if whole else F.lit(None).cast("boolean")).alias("is_loyalty"),
    )


def _added(rows: DataFrame) -> DataFrame:
    return rows.groupBy("user_id").agg(
        *[F.sum(c).cast(MONEY if c.endswith("revenue") else "long").alias(c) for c in SUMS],
        F.min("first_order_date").alias("first_order_date"), F.max("last_order_date").alias("last_order_date"), F.max("is_loyalty").alias("is_loyalty"),
    )


def update(spark: SparkSession, root: str, orders: DataFrame, as_of: dt.date, window_days: int = L.SPEND_WINDOW_DAYS, keep_versions: int = 2) -> versions.Commit:
    """Take in the order base rows of some days, whole days each, and move the state to ``as_of``.

    Days already there are replaced by what ``orders`` has of them; a day without
    any row left can't be named this way and stays. ``as_of`` may also be an
    earlier date than before; then the state is built anew from the day parts.
    """
    root = root.rstrip("/")
    paths = {n: f"{root}/{n}" for n in ("order_days", "day_parts", "state")}
    state_at = versions.current(spark, paths["state"])
    info = state_at.info if state_at else {}
    days_at, parts_at = _at(spark, paths["order_days"], info.get("order_days")), _at(spark, paths["day_parts"], info.get("day_parts"))
    stage = scratch_dir(spark, f"customers-{uuid.uuid4().hex[:12]}")
    try:
        io.write_layer(order_level(orders), f"{stage}/orders")
        level = spark.read.parquet(f"{stage}/orders")
        new_days = sorted(r[0] for r in level.select(DAY).distinct().collect())  # calendar days of one delivery
        months = {versions.month_of(d) for d in new_days}
        again = bool(versions.days_of(parts_at) & {d.isoformat() for d in new_days})
        other_day = ~F.col(DAY).isin(new_days) if again else F.lit(True)

        # an order counts once for its customer, on the first day it is seen
        pair = ["user_id", "order_id"]
        first = F.col(DAY) == F.min(DAY).over(Window.partitionBy(*pair))
        placed = level.withColumn("_first", first)
        if days_at and new_days:
            earlier = versions.read(spark, paths["order_days"], days_at).where(other_day).select(*pair)
            seen = keyset.maybe_in(earlier, level.select(*pair), pair, level.count()).distinct().withColumn("_seen", F.lit(True))
            placed = placed.join(seen, pair, "left").withColumn("_first", F.col("_first") & F.col("_seen").isNull())
        parts = placed.groupBy("user_id", DAY).agg(
            F.sum("revenue").cast(MONEY).alias("revenue"), F.sum("revenue_rows").alias("revenue_rows"),
            F.count_if("_first").alias("orders"), F.max("is_loyalty").alias("is_loyalty"),
        )

        if new_days:
            days_at = versions.take_days(spark, level.select(*pair, DAY), paths["order_days"], DAY, new_days, days_at)
            parts_at = versions.take_days(spark, parts, paths["day_parts"], DAY, new_days, parts_at)
        before = dt.date.fromisoformat(info["as_of"]) if state_at else None
        one = F.lit(1)

        def part_rows(only: set[str], of: Column, last: Column, prior: Column, whole: bool) -> list[DataFrame]:
            only = only & set(parts_at.folders if parts_at else ())
            return [_signed(versions.read(spark, paths["day_parts"], parts_at, only=only).where(of), last, prior, whole)] if only else []

        def factor(condition: Column) -> Column:
            return F.when(condition, one).otherwise(0)

        to_last, to_prior = (factor(c) for c in _windows(F.col(DAY), as_of, window_days))
        anew = state_at is None or again or as_of < before or info["window_days"] != window_days
        if anew:
            rows = part_rows(set(parts_at.folders if parts_at else ()), F.lit(True), to_last, to_prior, True)
            # a day that was replaced may have been an order's first: count orders over all days
            if days_at:
                pairs = versions.read(spark, paths["order_days"], days_at).groupBy("user_id").agg(F.count_distinct("order_id").alias("counted"))
        else:
            was_last, was_prior = (factor(c) for c in _windows(F.col(DAY), before, window_days))
            old = versions.read(spark, paths["state"], state_at)
            rows = [old.select("user_id", *SUMS, "first_order_date", "last_order_date", "is_loyalty")]
            if new_days:
                rows += part_rows(months, F.col(DAY).isin(new_days), to_last, to_prior, True)
            # only days of the last two windows can have moved to another window
            first_day, last_day = before - dt.timedelta(days=2 * window_days), as_of - dt.timedelta(days=window_days + 1)
            moved = F.col(DAY).between(F.lit(first_day), F.lit(last_day)) & ~F.col(DAY).isin(new_days)
            rows += part_rows(_months(first_day, last_day), moved, to_last - was_last, to_prior - was_prior, False)
        if not rows:
            raise ValueError("no orders and no state yet")
        state = rows[0]
        for r in rows[1:]:
            state = state.unionByName(r)
        state = _added(state)
        if anew:
            state = state.join(pairs, "user_id").withColumn("orders", F.col("counted")).drop("counted")
        info = {"as_of": as_of.isoformat(), "window_days": window_days, "order_days": days_at.name if days_at else None, "day_parts": parts_at.name if parts_at else None}
        done = versions.write(spark, state, paths["state"], info=info)
        for path in paths.values():
            versions.expire(spark, path, keep_versions)
        return done
    finally:
        io.delete_folder(spark, stage)


def read(spark: SparkSession, root: str) -> DataFrame:
    """The customer base as of the last run, with the columns and types of ``metrics.customer_base``."""
    path = f"{root.rstrip('/')}/state"
    at = versions.current(spark, path)
    ref = F.lit(dt.date.fromisoformat(at.info["as_of"]))

    def money(sum_of: str, rows: str) -> Column:
        return F.when(F.col(rows) > 0, F.col(sum_of))

    return versions.read(spark, path, at).select(
        "user_id",
        money("revenue", "revenue_rows").alias("total_clv"),
        F.col("orders").alias("total_orders"),
        "first_order_date", "last_order_date",
        F.try_divide(F.col("revenue"), F.when(F.col("revenue_rows") > 0, F.col("revenue_rows")).cast("decimal(20,0)")).cast(AVERAGE).alias("avg_order_value"),
        "is_loyalty",
        money("last_revenue", "last_rows").alias("spend_last_30d"),
        money("prior_revenue", "prior_rows").alias("spend_prior_30d"),
        F.datediff(ref, "last_order_date").alias("recency_days"),
        F.datediff("last_order_date", "first_order_date").alias("tenure_days"),
    )

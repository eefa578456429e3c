"""Location performance kept from day to day: a run reads the new days, and the table is merged from what days left.

Committed datasets under one root (``versions``): ``order_ids`` and ``user_ids``
(dictionaries), ``order_bits`` and ``user_bits`` (per location and day, bitmaps of
distinct orders and customers), ``sums`` (per location and day: net revenue and
its rows). The commit of ``sums`` comes last and names the others it goes with.
A day that is delivered again replaces what it left.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustolake.functions import labels as L
from gustolake.operators import distinct, metrics
from gustolake.operators.ranking import Stage, checkpointed
from gustolake.session import scratch_dir
from gustolake.sources import io, versions

PLACE, DAY = "restaurant_id", "order_date"
COUNTED = {"order": "order_id", "user": "user_id"}
# What ids lie together by: an order belongs to a day, a customer comes back on others.
NEAR = {"order": (PLACE, DAY), "user": (PLACE,)}


def update(spark: SparkSession, root: str, orders: DataFrame, keep_versions: int = 2) -> versions.Commit:
    """Take in the order base rows of some whole days."""
    root = root.rstrip("/")
    at = versions.current(spark, f"{root}/sums")
    stage = scratch_dir(spark, f"locations-{uuid.uuid4().hex[:12]}")
    try:
        io.write_layer(orders.select(PLACE, DAY, *COUNTED.values(), "net_revenue"), f"{stage}/orders")
        rows = spark.read.parquet(f"{stage}/orders")
        days = sorted(r[0] for r in rows.select(DAY).distinct().collect())  # calendar days of one delivery
        if not days:
            return at
        info = {}
        for kind, column in COUNTED.items():
            path = f"{root}/{kind}_bits"
            ids = distinct.numbered(spark, f"{root}/{kind}_ids", rows.select(F.col(column).alias("value"), F.struct(*NEAR[kind]).alias("near")))
            pairs = rows.select(PLACE, DAY, F.col(column).alias("value")).distinct()
            base = versions.load(spark, path, at.info[kind]) if at else None
            info[kind] = versions.take_days(spark, distinct.bitmaps(pairs.join(ids, "value"), [PLACE, DAY]), path, DAY, days, base).name
        sums = rows.groupBy(PLACE, DAY).agg(F.sum("net_revenue").alias("revenue"), F.count("net_revenue").alias("revenue_rows"))
        done = versions.take_days(spark, sums, f"{root}/sums", DAY, days, at, info)
        for name in ("sums", *(f"{kind}_bits" for kind in COUNTED)):
            versions.expire(spark, f"{root}/{name}", keep_versions)
        return done
    finally:
        io.delete_folder(spark, stage)


def merged(spark: SparkSession, root: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Per location over the days from ``first`` to ``last`` (default: all): revenue, average, distinct orders, customers and days."""
    root = root.rstrip("/")
    at = versions.current(spark, f"{root}/sums")
    inside = F.lit(True)
    if first is not None:
        inside = inside & (F.col(DAY) >= F.lit(first))
    if last is not None:
        inside = inside & (F.col(DAY) <= F.lit(last))

    def days(name: str, commit: versions.Commit) -> DataFrame:
        return versions.read(spark, f"{root}/{name}", commit).where(inside)

    revenue, rows = F.sum("revenue"), F.sum("revenue_rows")
    out = days("sums", at).groupBy(PLACE).agg(
        revenue.alias("total_revenue"),
        F.try_divide(revenue, F.when(rows > 0, rows).cast("decimal(20,0)")).cast("decimal(38,6)").alias("avg_order_value"),
        F.count(F.lit(1)).alias("active_days"),  # one row per location and day
    )
    for kind, name in (("order", "total_orders"), ("user", "unique_customers")):
        counted = distinct.counts(days(f"{kind}_bits", versions.load(spark, f"{root}/{kind}_bits", at.info[kind])), [PLACE], name)
        here, there = out.alias("a"), counted.alias("b")
        out = here.join(there, F.col(f"a.{PLACE}").eqNullSafe(F.col(f"b.{PLACE}")), "left").select("a.*", F.coalesce(F.col(f"b.{name}"), F.lit(0)).alias(name))
    return out.withColumn("orders_per_day", F.try_divide(F.col("total_orders"), F.col("active_days")))


def performance(
    spark: SparkSession, root: str, as_of: dt.date, top: int = L.TOP_RANK, mid: int = L.MID_RANK, stage: Stage = checkpointed
) -> DataFrame:
    """The location performance table from the days taken in; equal to ``metrics.location`` over their orders."""
    return metrics.ranked_locations(stage(merged(spark, root), "location_base"), as_of, top, mid, stage)

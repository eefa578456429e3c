"""Derive the three source tables from the TPC-H-style test tables.

The pipeline's real sources are ``order_items``, ``order_item_options`` and
``date_dim`` in a relational database. For tests and benchmarks they are
derived from ``lineitem``, ``orders``, ``customer`` and ``part`` by the mapping
in FIXTURES.md; every row of the result comes from those tables, so the work
grows with them. Joins carry no broadcast hints: the runtime size check of
adaptive execution decides.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the test-data mapping (FIXTURES.md §3).
AS_OF = dt.date(2001, 8, 2)
LOYALTY_PRIORITIES = ("1-URGENT", "2-HIGH")
CURRENCY = "USD"
URL_ONLY_CATEGORY = "https://img.example/only"
CATEGORY_URL_PREFIX = "https://img.example/c/"
URL_ONLY_MOD, URL_SUFFIX_MOD, NO_USER_MOD, BLANK_OPTION_MOD = 13, 11, 97, 17
HOURS_PER_DAY = 24
DISCOUNT_MIN = 0.09
CALENDAR_STOP_DAYS = 32  # calendar ends this many days before the last order
HOLIDAYS = ((1, 1, "New Year"), (7, 4, "Independence"), (12, 25, "Christmas"))


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _read_lines(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """The line table, read as the files are split."""
    return _read(spark, sf_dir, "lineitem").select(*cols)


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read_lines(spark, sf_dir, "l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    p = _read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    # what depends on a part or an order alone is made of parts and orders, not of their lines
    category = (
        F.when(F.col("p_partkey") % URL_ONLY_MOD == 0, F.lit(URL_ONLY_CATEGORY))
        .when(
            F.col("p_partkey") % URL_SUFFIX_MOD == 0,
            F.concat(F.col("p_type"), F.lit(" "), F.lit(CATEGORY_URL_PREFIX), F.col("p_partkey").cast("string")),
        )
        .otherwise(F.col("p_type"))
    )
    parts = p.select(
        "p_partkey",
        category.alias("item_category"),
        F.col("p_name").alias("item_name"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("item_price"),
    )
    created = F.timestamp_add(
        "HOUR", (F.col("o_orderkey") % HOURS_PER_DAY).cast("int"), F.col("o_orderdate").cast("timestamp")
    )
    # orders, a quarter of the lines, meet the customers alone; the lines move once by part while they are narrow
    # and once by the order's text key, the key by which they are deduplicated next
    placed = o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("c_nationkey").cast("string").alias("restaurant_id"),
        created.alias("creation_time_utc"),
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.when(F.col("o_orderkey") % NO_USER_MOD == 0, F.lit(None).cast("string"))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("user_id"),
        F.col("o_orderpriority").isin(*LOYALTY_PRIORITIES).alias("is_loyalty"),
        F.col("c_mktsegment").alias("app_name"),
    )
    sold = li.join(parts, li.l_partkey == parts.p_partkey).withColumn("order_id", F.col("l_orderkey").cast("string"))
    return sold.join(placed, "order_id").select(
        "restaurant_id",
        "creation_time_utc",
        "order_id",
        "user_id",
        F.lit("").alias("printed_card_number"),
        "is_loyalty",
        F.lit(CURRENCY).alias("currency"),
        F.col("l_linenumber").cast("string").alias("lineitem_id"),
        "item_category",
        "item_name",
        "item_price",
        F.col("l_quantity").cast("int").alias("item_quantity"),
        "app_name",
    )


def order_item_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read_lines(spark, sf_dir, "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_tax", "l_discount")
    p = _read(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").cast("decimal(10,2)").alias("price"))
    j = li.join(p, li.l_partkey == p.p_partkey)
    price = F.col("price")
    empty = F.col("l_partkey") % BLANK_OPTION_MOD == 0

    def option(group: str, name: Column, value: Column) -> Column:
        return F.struct(
            F.lit(group).alias("option_group_name"), name.alias("option_name"), value.cast("decimal(10,2)").alias("option_price")
        )

    tax = option("Tax", F.when(empty, F.lit("")).otherwise(F.lit("TAX")), price * F.col("l_tax").cast("decimal(4,2)"))
    promo = option("Promo", F.lit("DISCOUNT"), -(price * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(10,2)"))
    # both selections in one pass over the lines; one that does not hold is a row without a group, dropped at once
    both = F.array(F.when(F.col("l_tax") > 0, tax), F.when(F.col("l_discount") >= DISCOUNT_MIN, promo))
    return j.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("string").alias("lineitem_id"),
        F.inline(both),
        F.col("l_quantity").cast("int").alias("option_quantity"),
    ).where(F.col("option_group_name").isNotNull()).repartition("order_id")


def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day from the first order date to 32 days before the last one.

    The day range is read from ``orders`` (a one-row aggregate), then expanded
    with ``sequence``; the calendar has one row per day, so it stays small for
    any number of orders.
    """
    o = _read(spark, sf_dir, "orders")
    bounds = o.agg(
        F.min(F.to_date("o_orderdate")).alias("lo"),
        F.date_sub(F.max(F.to_date("o_orderdate")), CALENDAR_STOP_DAYS).alias("hi"),
    )
    d = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date_key"))
    holiday = None
    for month, day, name in HOLIDAYS:
        cond = (F.month("date_key") == month) & (F.dayofmonth("date_key") == day)
        holiday = F.when(cond, F.lit(name)) if holiday is None else holiday.when(cond, F.lit(name))
    return d.select(
        "date_key",
        F.date_format("date_key", "EEEE").alias("day_of_week"),
        F.weekofyear("date_key").alias("week"),
        F.date_format("date_key", "MMMM").alias("month"),
        F.year("date_key").alias("year"),
        F.dayofweek("date_key").isin(1, 7).alias("is_weekend"),
        holiday.isNotNull().alias("is_holiday"),
        holiday.alias("holiday_name"),
    )


def source_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "order_items": order_items(spark, sf_dir),
        "order_item_options": order_item_options(spark, sf_dir),
        "date_dim": date_dim(spark, sf_dir),
    }


# --- malformed text, for the casts ---------------------------------------------------------
TEXT_LINES = T.StructType([
    T.StructField("order_id", T.StringType()), T.StructField("quantity", T.IntegerType()),
    T.StructField("price", T.DecimalType(12, 2)), T.StructField("sold_on", T.TimestampType()),
    T.StructField("returned", T.BooleanType()),
])


def lines_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line with all values as text; by key modulus quantities have fractions or are words,
    prices, times and flags are malformed."""
    li = _read_lines(spark, sf_dir, "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate", "l_returnflag")
    k, q = F.col("l_orderkey") * 7 + F.col("l_linenumber"), F.col("l_quantity").cast("int").cast("string")
    return li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_id"),
        F.when(k % 5 == 0, F.concat(q, F.lit(".7"))).when(k % 5 == 1, F.concat(F.lit(" "), q, F.lit(" ")))
        .when(k % 5 == 2, F.lit("many")).when(k % 5 == 3, F.concat(q, F.lit("000000000"))).otherwise(q).alias("quantity"),
        F.when(k % 3 == 0, F.lit("n/a")).otherwise(F.col("l_extendedprice").cast("decimal(12,2)").cast("string")).alias("price"),
        F.when(k % 4 == 0, F.lit("yesterday")).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("sold_on"),
        F.when(F.col("l_returnflag") == "R", F.lit("true")).when(F.col("l_returnflag") == "A", F.lit("false"))
        .otherwise(F.lit("perhaps")).alias("returned"),
    )

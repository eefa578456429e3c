"""One callable per operator key of the coverage inventory: ``(spark, sf_dir) -> DataFrame``.

Every callable derives the three source tables from the test tables in
``sf_dir`` (whole tables, no sampling) and runs the operator under test on
them. Decimal columns are handed out as DOUBLE so the comparison with the SQL
oracle sees one numeric type; the oracle computes in DECIMAL and casts the same
way, so equal decimals give equal doubles.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustolake.functions.clean import strip_urls
from gustolake.operators import base, metrics, serving
from gustolake.operators.clean import dedup, normalize_columns, require_keys, to_contract, void_to_string
from gustolake.plans import bronze, customers, gold, locations, pipeline, silver
from gustolake.session import scratch_dir
from gustolake.sources import contracts as C
from gustolake.sources import fixtures as FX
from gustolake.sources import io, splits

AS_OF = FX.AS_OF
INGEST_DATE = AS_OF
Query = Callable[[SparkSession, str], DataFrame]


def check_view(df: DataFrame) -> DataFrame:
    """Decimal columns -> double, everything else unchanged."""
    if not any(isinstance(f.dataType, T.DecimalType) for f in df.schema.fields):
        return df
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def _scratch(spark: SparkSession, tag: str) -> str:
    return scratch_dir(spark, f"{tag}-{uuid.uuid4().hex[:12]}")


def _silver(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return silver.build(FX.source_tables(spark, sf))


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return base.build(_silver(spark, sf))


def _stage(spark: SparkSession) -> gold.Stage:
    """Files in a scratch folder of the query's own, as the production run stages: what is staged is computed once
    (an eager checkpoint computes its last step twice) and read by column."""
    return gold.path_stage(spark, _scratch(spark, "stage"))


def _gold(spark: SparkSession, sf: str, items_again: bool = False) -> gold.GoldTables:
    """The gold tables over the order base and customer aggregate, staged once per query; ``items_again`` stages
    the lines by order instead, for the sales trends, which read them and the order base made of them once each."""
    built = _silver(spark, sf)
    if items_again:
        return gold.build(_with_lines(spark, built), AS_OF)
    return gold.build(built, AS_OF, stage=_stage(spark))


def _with_lines(spark: SparkSession, built: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The silver frames and the lines with their options, staged in buckets of the order: items and options are
    deduplicated by order, so they meet where they are, and no line or order is shuffled after that."""
    lines = base.lines(built["order_items"].select(*gold.ITEM_COLUMNS), base.option_rollup(built["order_item_options"]))
    stage = gold.bucket_stage(spark, _scratch(spark, "stage"), "order_id")
    return built | {gold.ORDER_LINES: stage(lines.select(*gold.LINE_COLUMNS), gold.ORDER_LINES)}


# --- sources / sinks -------------------------------------------------------------------
def q_scan_source(spark: SparkSession, sf: str) -> DataFrame:
    view = f"order_items_{uuid.uuid4().hex[:8]}"
    FX.order_items(spark, sf).createOrReplaceTempView(view)
    return io.read_source(spark, view, fmt="table")


SPLITS = 16


def q_source_splits(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that each of the balanced predicates over a skewed key (the square of the part's number) selects."""
    keys = spark.read.parquet(f"{sf.rstrip('/')}/lineitem.parquet").select((F.col("l_partkey").cast("long") * F.col("l_partkey")).alias("key"))
    at = splits.borders(keys, "key", SPLITS)
    counts = [F.count_if(F.expr(p)).alias(f"p{i}") for i, p in enumerate(splits.predicates("key", at))]
    row = keys.agg(*counts)
    return row.select(F.posexplode(F.array(*row.columns)).alias("split", "rows"))


def q_bronze_ingest(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.ingest(FX.order_items(spark, sf), INGEST_DATE)


def q_bronze_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = _scratch(spark, "bronze") + "/order_items"
    bronze.write(bronze.ingest(FX.order_items(spark, sf), INGEST_DATE), path)
    return bronze.read(spark, path, INGEST_DATE)


def q_silver_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    paths = silver.write(_silver(spark, sf), _scratch(spark, "silver"))
    return silver.read(spark, paths)["order_items"]


def q_gold_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    root = _scratch(spark, "gold")
    db = f"gold_{uuid.uuid4().hex[:8]}"
    g = _gold(spark, sf)
    return io.publish(spark, g["dim_customer"], C.DIM_CUSTOMER, f"{root}/dim_customer", "dim_customer", db)


def q_published_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Run the production gold job (staged, concurrent, versioned publish) into
    a fresh database, list the catalog and count each listed table."""
    root = _scratch(spark, "gold")
    db = f"gold_{uuid.uuid4().hex[:8]}"
    built = _with_lines(spark, _silver(spark, sf))
    gold.run(spark, built, AS_OF, root, database=db, stage_root=f"{root}/_stage")
    listed = [r["table_name"] for r in io.list_published(spark, db).collect()]
    parts = [spark.table(f"{db}.{t}").agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("rows"))
             for t in listed]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_bronze_latest_day(spark: SparkSession, sf: str) -> DataFrame:
    """Two ingest days, of which a read without a date takes the later."""
    path, items = _scratch(spark, "bronze") + "/order_items", FX.order_items(spark, sf)
    bronze.write(bronze.ingest(items, INGEST_DATE), path)
    bronze.write(bronze.ingest(items.where("is_loyalty"), INGEST_DATE - dt.timedelta(days=1)), path)
    return bronze.read(spark, path)


def q_bucketed_order_base(spark: SparkSession, sf: str) -> DataFrame:
    """The order base from silver tables bucketed by line."""
    db, buckets = f"silver_{uuid.uuid4().hex[:8]}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = silver.write_bucketed(spark, _silver(spark, sf), _scratch(spark, "silver"), db, buckets)
    return base.build(silver.read_bucketed(spark, names))


# --- incremental -----------------------------------------------------------------------
def q_incremental_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Two ingest days upserted one after the other: the second brings new lines, and earlier times of lines of the first."""
    items, path = FX.order_items(spark, sf), _scratch(spark, "silver") + "/order_items"
    number = F.col("order_id").cast("long")
    late = F.when(number % 5 == 0, F.timestamp_add("DAY", F.lit(40), F.col("creation_time_utc"))).otherwise(F.col("creation_time_utc"))
    silver.upsert_order_items(spark, items.where(number % 3 != 0).withColumn("creation_time_utc", late), path)
    silver.upsert_order_items(spark, items.where((number % 3 == 0) | (number % 5 == 0)), path)
    return silver.read_order_items(spark, path)


def q_incremental_customers(spark: SparkSession, sf: str) -> DataFrame:
    """The customer base brought to three dates one after the other, each time from the days since."""
    root, orders = _scratch(spark, "customers"), _stage(spark)(_orders(spark, sf), "order_base")
    at = [AS_OF - dt.timedelta(days=45), AS_OF - dt.timedelta(days=10), AS_OF]
    for since, day in zip([None, *at], at):
        new = orders if since is None else orders.where(F.col("order_date") > F.lit(since))
        customers.update(spark, root, new if day == at[-1] else new.where(F.col("order_date") <= F.lit(day)), day)
    return customers.read(spark, root)


def q_incremental_location(spark: SparkSession, sf: str) -> DataFrame:
    """Location performance merged from days taken in by two runs, the second of which delivers some days again."""
    root, orders = _scratch(spark, "locations"), _stage(spark)(_orders(spark, sf), "order_base")
    cut = F.lit(AS_OF - dt.timedelta(days=400))
    locations.update(spark, root, orders.where(F.col("order_date") <= F.date_add(cut, 30)))
    locations.update(spark, root, orders.where(F.col("order_date") > cut))
    return io.to_contract_types(locations.performance(spark, root, AS_OF), C.FACT_LOCATION_PERFORMANCE)


# --- cleaning --------------------------------------------------------------------------
def q_normalize_columns(spark: SparkSession, sf: str) -> DataFrame:
    raw = FX.order_items(spark, sf)
    shouting = raw.toDF(*[c.upper() for c in raw.columns])  # as a case-insensitive DB may deliver
    return normalize_columns(shouting)


def q_void_to_string(spark: SparkSession, sf: str) -> DataFrame:
    raw = FX.order_item_options(spark, sf).withColumn("option_note", F.lit(None))  # an all-null (void) column
    return void_to_string(raw)


def q_cast_text(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as text, some malformed by key modulus, through the contract's casts."""
    li = FX.lines_as_text(spark, sf)
    return to_contract(li, FX.TEXT_LINES)


def q_strip_urls(spark: SparkSession, sf: str) -> DataFrame:
    raw = FX.order_items(spark, sf)
    return raw.select("order_id", "lineitem_id", strip_urls("item_category").alias("item_category"))


def q_blank_to_null(spark: SparkSession, sf: str) -> DataFrame:
    return silver.typed_order_items(FX.order_items(spark, sf))


def q_require_keys(spark: SparkSession, sf: str) -> DataFrame:
    return require_keys(silver.typed_order_items(FX.order_items(spark, sf)), C.ORDER_ITEMS_REQUIRED)


def q_dedup_items(spark: SparkSession, sf: str) -> DataFrame:
    typed = require_keys(silver.typed_order_items(FX.order_items(spark, sf)), C.ORDER_ITEMS_REQUIRED)
    return dedup(typed, C.ORDER_ITEMS_KEY)


def q_dedup_options(spark: SparkSession, sf: str) -> DataFrame:
    typed = require_keys(silver.typed_options(FX.order_item_options(spark, sf)), C.OPTIONS_REQUIRED)
    return dedup(typed, C.OPTIONS_KEY)


def q_silver_order_items(spark: SparkSession, sf: str) -> DataFrame:
    return silver.order_items(FX.order_items(spark, sf))


def q_silver_options(spark: SparkSession, sf: str) -> DataFrame:
    return silver.options(FX.order_item_options(spark, sf))


def q_silver_date_dim(spark: SparkSession, sf: str) -> DataFrame:
    return silver.date_dim(FX.date_dim(spark, sf))


# --- base ------------------------------------------------------------------------------
def q_option_rollup(spark: SparkSession, sf: str) -> DataFrame:
    rollup = base.option_rollup(silver.options(FX.order_item_options(spark, sf)))
    return rollup.withColumn("has_discount", F.col("has_discount").cast("int"))  # the SQL has it as 0 / 1


def q_line_base(spark: SparkSession, sf: str) -> DataFrame:
    s = _silver(spark, sf)
    return base.lines(s["order_items"], base.option_rollup(s["order_item_options"]))


def q_order_base(spark: SparkSession, sf: str) -> DataFrame:
    return _orders(spark, sf)


# --- metrics ---------------------------------------------------------------------------
def q_clv_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.thresholds(_gold(spark, sf).customers).select("clv_p20", "clv_p80")


def q_rfm_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.thresholds(_gold(spark, sf).customers).select(
        "recency_p33", "recency_p67", "frequency_p33", "frequency_p67", "monetary_p33", "monetary_p67"
    )


def _gold_table(name: str) -> Query:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        return _gold(spark, sf, items_again=name == "fact_sales_trends")[name]

    q.__name__ = f"q_{name}"
    return q


def q_daily_spend(spark: SparkSession, sf: str) -> DataFrame:
    # the daily run at 01:00 UTC snapshots the previous (complete) day
    return metrics.daily_spend(_orders(spark, sf), AS_OF - dt.timedelta(days=1))


def q_order_categories(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.order_categories(silver.order_items(FX.order_items(spark, sf)))


def q_sales_trends_no_category(spark: SparkSession, sf: str) -> DataFrame:
    s = _silver(spark, sf)
    orders = base.build(s)
    items = s["order_items"].drop("item_category")
    return io.to_contract_types(metrics.sales_trends(orders, items, s["date_dim"]), C.FACT_SALES_TRENDS)


def q_loyalty_customers(spark: SparkSession, sf: str) -> DataFrame:
    g = _gold(spark, sf)
    return metrics.loyalty_customers(g.orders, g["fact_daily_clv"])


def q_quality_report(spark: SparkSession, sf: str) -> DataFrame:
    src, stage = FX.source_tables(spark, sf), _stage(spark)
    built, counted = silver.build(src, counted=True), {}
    # counted and read by the order base and the sales trends; the sources' joins run once, for the counts too
    for name, columns in (("order_items", gold.ITEM_COLUMNS), ("order_item_options", gold.OPTION_COLUMNS)):
        counted[name] = stage(built[name].select(*columns, silver.RAW_ROWS, silver.DROPPED), name)
        built[name] = silver.kept(counted[name])
    # options move by order, so that lines meet them and add up to orders without moving again
    by_order = built | {"order_item_options": built["order_item_options"].repartition("order_id")}
    g = gold.build(by_order, AS_OF, stage=stage)
    return pipeline.quality_report(src, built, {"order_base": g.orders, **g}, counted=counted)


# The serving queries over the sales trends.
SALES_QUERIES = ("monthly_revenue", "revenue_by_weekday", "holiday_vs_regular", "top_categories")


def _serving(name: str) -> Query:
    fn = serving.SERVING_QUERIES[name]

    def q(spark: SparkSession, sf: str) -> DataFrame:
        return fn(_gold(spark, sf, items_again=name in SALES_QUERIES))

    q.__name__ = f"q_{name}"
    return q


QUERIES: dict[str, Query] = {
    "scan_source": q_scan_source,
    "source_splits": q_source_splits,
    "bronze_ingest": q_bronze_ingest,
    "bronze_roundtrip": q_bronze_roundtrip,
    "silver_roundtrip": q_silver_roundtrip,
    "gold_roundtrip": q_gold_roundtrip,
    "published_tables": q_published_tables,
    "bronze_latest_day": q_bronze_latest_day,
    "incremental_silver": q_incremental_silver,
    "incremental_customers": q_incremental_customers,
    "incremental_location": q_incremental_location,
    "normalize_columns": q_normalize_columns,
    "void_to_string": q_void_to_string,
    "cast_text": q_cast_text,
    "strip_urls": q_strip_urls,
    "blank_to_null": q_blank_to_null,
    "require_keys": q_require_keys,
    "dedup_items": q_dedup_items,
    "dedup_options": q_dedup_options,
    "silver_order_items": q_silver_order_items,
    "silver_options": q_silver_options,
    "silver_date_dim": q_silver_date_dim,
    "option_rollup": q_option_rollup,
    "line_base": q_line_base,
    "order_base": q_order_base,
    "bucketed_order_base": q_bucketed_order_base,
    "clv_thresholds": q_clv_thresholds,
    "rfm_thresholds": q_rfm_thresholds,
    "metric_clv": _gold_table("fact_daily_clv"),
    "metric_rfm": _gold_table("fact_rfm_segments"),
    "metric_churn": _gold_table("fact_churn_indicators"),
    "daily_spend": q_daily_spend,
    "dim_customer": _gold_table("dim_customer"),
    "order_categories": q_order_categories,
    "metric_sales_trends": _gold_table("fact_sales_trends"),
    "sales_trends_no_category": q_sales_trends_no_category,
    "loyalty_customers": q_loyalty_customers,
    "metric_loyalty": _gold_table("fact_loyalty_comparison"),
    "metric_location": _gold_table("fact_location_performance"),
    "metric_discount": _gold_table("fact_discount_effectiveness"),
    "quality_report": q_quality_report,
    **{name: _serving(name) for name in serving.SERVING_QUERIES},
}


# Items and options come partitioned by order and leave their dedup sorted by line: they are then joined by line without
# a shuffle of either, and the roll-up of options adds up what is sorted instead of keeping a hash table.
PLANNER = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.execution.replaceHashWithSortAgg": "true",
}


def run_query(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    for key, value in PLANNER.items():
        spark.conf.set(key, value)
    return check_view(QUERIES[name](spark, sf_dir))

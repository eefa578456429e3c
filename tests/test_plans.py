"""What the queries move and keep in memory, from their plans, on rows of the tests' own."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from gustolake.operators import base
from gustolake.plans import gold, pipeline, registry, silver
from gustolake.sources import fixtures as FX
from samples import empty_date_dim, item, items_df, option, options_df


@pytest.fixture
def tables(spark, tmp_path):
    at = dt.datetime(2001, 7, 1)
    spark.createDataFrame(
        [(o, p, n, float(1 + o % 5), 0.02 * (p % 3), 0.05 * n) for o in range(1, 60) for n in (1, 2) for p in (o % 7 + n, o % 34 + 1)],
        "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_tax double, l_discount double",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(
        [(o, o % 9 + 1, at + dt.timedelta(days=o % 40), "1-URGENT" if o % 2 else "5-LOW") for o in range(1, 60)],
        "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string",
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(c, c % 3, "WEB") for c in range(1, 10)], "c_custkey long, c_nationkey int, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame(
        [(p, f"part {p}", f"TYPE {p % 4}", 10.0 + p) for p in range(1, 40)], "p_partkey long, p_name string, p_type string, p_retailprice double"
    ).write.parquet(f"{tmp_path}/part.parquet")
    kept = {k: spark.conf.get(k, None) for k in (*registry.PLANNER, "spark.sql.autoBroadcastJoinThreshold")}
    for k, v in {**registry.PLANNER, "spark.sql.autoBroadcastJoinThreshold": "-1"}.items():
        spark.conf.set(k, v)
    yield str(tmp_path)
    for k, v in kept.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_options_are_one_pass_and_equal_both_selections(spark, tables):
    options = FX.order_item_options(spark, tables)
    assert plan(options).count("l_tax#") and plan(options).count("FileScan") == 2  # lines and parts, once each
    tax = prom = 0
    for r in spark.read.parquet(f"{tables}/lineitem.parquet").collect():
        tax += r["l_tax"] > 0
        prom += r["l_discount"] >= FX.DISCOUNT_MIN
    found = {r["option_group_name"]: r["count"] for r in options.groupBy("option_group_name").count().collect()}
    assert tax and prom and found == {"Tax": tax, "Promo": prom}
    blank = options.where("option_name = ''")
    assert blank.count() and blank.where("option_group_name <> 'Tax'").count() == 0


def test_rollup_moves_options_once_and_keeps_no_hash_table(spark, tables):
    rollup = plan(base.option_rollup(silver.options(FX.order_item_options(spark, tables))))
    assert rollup.count("Exchange hashpartitioning") == 3  # lines and parts by part, options by order
    assert "HashAggregate" not in rollup


def test_lines_meet_options_and_orders_without_a_shuffle_of_their_own(spark, tables):
    orders = plan(base.build(silver.build(FX.source_tables(spark, tables))))
    # by part: lines and parts, twice; by customer: orders and customers; by order: lines, orders, options
    assert orders.count("Exchange hashpartitioning") == 9


def test_queries_stage_in_files_and_compute_items_once(spark, tables, monkeypatch):
    def no_checkpoint(*a):
        raise AssertionError("an eager checkpoint computes its last step twice")

    monkeypatch.setattr(gold, "checkpoint_stage", no_checkpoint)
    sales = registry.QUERIES["metric_sales_trends"](spark, tables)
    assert "lineitem.parquet" not in plan(sales)
    assert sales.count()


def test_sales_trends_shuffle_neither_lines_nor_orders_after_the_dedup(spark, tables):
    sales = plan(registry.QUERIES["metric_sales_trends"](spark, tables))
    moved = re.findall(r"hashpartitioning\((\w+)#", sales)
    assert moved and "order_id" not in moved
    assert sales.count("Bucketed: true") == 2  # lines for their orders, lines for their categories


def test_gold_from_lines_staged_by_order_equals_gold_from_silver(spark, tables):
    rows = [item(), item(lineitem_id="2", category="Pasta"), item(lineitem_id="2", category="Salad"),
            item(lineitem_id="3", restaurant_id="r2", category=None), item(lineitem_id="4", user_id="u2", price=None),
            item(order_id="2", category="", price="7.50", qty=2), item(order_id="3", user_id=None), item(order_id=None),
            item(order_id="4", app=None, price="-1.00"), item(order_id="4", lineitem_id="2", app=None, loyalty=None)]
    options = [option(), option(name="DISCOUNT", price="-0.50"), option(name="", price=None), option(lineitem_id="2", qty=None),
               option(order_id="9"), option(order_id="4", price="-2.00")]
    raw = {"order_items": items_df(spark, rows), "order_item_options": options_df(spark, options), "date_dim": empty_date_dim(spark)}
    for sources in (raw, FX.source_tables(spark, tables), {name: df.limit(0) for name, df in raw.items()}):
        built = silver.build(sources)
        want, got = (gold.build(s, registry.AS_OF) for s in (built, registry._with_lines(spark, built)))
        for a, b in ((want.orders, got.orders), (want["fact_sales_trends"], got["fact_sales_trends"])):
            assert a.schema == b.schema and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_options_are_compiled_with_their_join(spark, tables):
    options = plan(FX.order_item_options(spark, tables))
    assert "Generate inline" in options and "lambdafunction" not in options
    rows = FX.order_item_options(spark, tables)
    assert rows.where("option_group_name is null").count() == 0


def test_quality_report_counts_sources_while_they_are_staged(spark, tables):
    raw = FX.source_tables(spark, tables)
    want = pipeline.quality_report(raw, silver.build(raw)).collect()
    report = registry.QUERIES["quality_report"](spark, tables)
    assert "lineitem.parquet" not in plan(report)
    assert set(want) <= set(report.collect())


def test_counted_frames_hold_raw_rows_and_dropped_keys(spark):
    rows = [item(), item(price="9.00"), item(order_id="2", user_id=None), item(order_id="2", user_id="u2"),
            item(order_id=None), item(order_id=None, lineitem_id=None), item(lineitem_id=None)]
    options = [option(), option(price="2.00"), option(lineitem_id=None), option(order_id=None, lineitem_id=None)]
    raw = {"order_items": items_df(spark, rows), "order_item_options": options_df(spark, options), "date_dim": empty_date_dim(spark)}
    counted, plain = silver.build(raw, counted=True), silver.build(raw)
    for name in ("order_items", "order_item_options"):
        kept = silver.kept(counted[name])
        assert kept.columns == plain[name].columns and sorted(map(str, kept.collect())) == sorted(map(str, plain[name].collect()))
    want = {(r["table"], r["stage"]): r["rows"] for r in pipeline.quality_report(raw, plain).collect()}
    with_counts = {name: counted[name] for name in ("order_items", "order_item_options")}
    got = {(r["table"], r["stage"]): r["rows"] for r in pipeline.quality_report(raw, plain, counted=with_counts).collect()}
    assert got == want and got["order_items", "dropped_null_keys"] == 4 and got["order_items", "raw"] == 7
    empty = {name: df.limit(0) for name, df in raw.items()}
    counted = {name: df for name, df in silver.build(empty, counted=True).items() if name in with_counts}
    none = pipeline.quality_report(empty, silver.build(empty), counted=counted).collect()
    assert len(none) == 8 and all(r["rows"] == 0 for r in none)

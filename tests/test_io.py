"""Sinks and round trips: bronze day partitions, silver, publish + catalog."""

import datetime as dt
import uuid

from samples import item, items_df
from gustolake.operators import quality
from gustolake.plans import bronze, pipeline, silver
from gustolake.session import scratch_dir
from gustolake.sources import contracts as C
from gustolake.sources import fixtures as FX
from gustolake.sources import io
from pyspark.sql import Observation


def test_second_bronze_day_keeps_first(spark):
    path = scratch_dir(spark, f"t-bronze-{uuid.uuid4().hex[:8]}") + "/order_items"
    d1, d2 = dt.date(2001, 8, 1), dt.date(2001, 8, 2)
    bronze.write(bronze.ingest(items_df(spark, [item(order_id="1")]), d1), path)
    bronze.write(bronze.ingest(items_df(spark, [item(order_id="2"), item(order_id="3")]), d2), path)
    assert bronze.read(spark, path, d1).count() == 1
    assert bronze.read(spark, path, d2).count() == 2
    assert bronze.latest_ingest_date(spark, path) == d2
    r = bronze.read(spark, path, d1).first()
    assert r["_ingestion_date"] == "2001-08-01" and r["_ingestion_month"] == 8


def test_full_pipeline_run_sf0001(spark):
    root = scratch_dir(spark, f"t-run-{uuid.uuid4().hex[:8]}")
    db = f"t_gold_{uuid.uuid4().hex[:6]}"
    res = pipeline.run(spark, FX.source_tables(spark, "/root/testdata/sf0.001"), root, FX.AS_OF, database=db)
    listed = {r["table_name"] for r in io.list_published(spark, db).collect()}
    assert listed == set(C.GOLD_CONTRACTS)
    for name, df in res.gold.items():
        assert df.schema.simpleString() == C.GOLD_CONTRACTS[name].simpleString()
    q = {(r["table"], r["stage"]): r["rows"] for r in res.quality.collect()}
    assert q[("order_items", "raw")] >= q[("order_items", "after_dedup")] > 0
    assert q[("fact_daily_clv", "gold")] == q[("dim_customer", "gold")]
    raw = {t: bronze.read(spark, p, FX.AS_OF) for t, p in res.bronze_paths.items()}
    counted = pipeline.quality_report(raw, silver.read(spark, res.silver_paths), res.gold)
    assert {(r["table"], r["stage"]): r["rows"] for r in counted.collect()} == q
    items = silver.read(spark, res.silver_paths)["order_items"]
    assert [f.name for f in items.schema.fields] == [f.name for f in C.SILVER_ORDER_ITEMS.fields]


def test_silver_without_a_date_takes_the_latest_day(spark):
    path = scratch_dir(spark, f"t-days-{uuid.uuid4().hex[:8]}") + "/order_items"
    days = [dt.date(2001, 8, 9), dt.date(2001, 7, 31), dt.date(2000, 12, 1)]
    for n, day in enumerate(days):
        bronze.write(bronze.ingest(items_df(spark, [item(order_id=str(i)) for i in range(n + 1)]), day), path)
    # the folder of a write that was called off
    from gustolake.sources import versions

    fs, at = versions._hadoop(spark, path)
    fs.mkdirs(at(f"{path}/_ingestion_year=2001/_ingestion_month=10/_ingestion_day=01"))
    group = f"listing-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, "listing")
    try:
        assert bronze.ingest_days(spark, path) == days
        assert bronze.latest_ingest_date(spark, path) == days[0]
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == []  # a listing, no job
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")
    got = bronze.read(spark, path)
    assert [r["_ingestion_date"] for r in got.collect()] == ["2001-08-09"] and got.first()["_ingestion_month"] == 8
    assert all("_ingestion_month=08" in f for f in got.inputFiles())  # no other day's files are even listed
    assert bronze.read(spark, path, days[1]).count() == 2 and bronze.read_all(spark, path).count() == 6
    assert bronze.read(spark, path, dt.date(1999, 1, 1)).count() == 0
    silver_path = scratch_dir(spark, f"t-latest-{uuid.uuid4().hex[:8]}")
    silver.upsert_latest_day(spark, path, silver_path)
    assert [r["order_id"] for r in silver.read_order_items(spark, silver_path).collect()] == ["0"]


def test_relational_source_needs_a_split(spark):
    import pytest

    with pytest.raises(ValueError):
        io.jdbc_options("dbo.t", {"url": "jdbc:x"})
    split = {"partitionColumn": "id", "lowerBound": "0", "upperBound": "9", "numPartitions": "4"}
    assert io.jdbc_options("dbo.t", split) == {"dbtable": "dbo.t", **split}
    assert io.jdbc_options("dbo.t", {"unsplit": True}) == {"dbtable": "dbo.t"}


def test_balanced_splits_of_skewed_keys(spark):
    from gustolake.sources import splits
    from pyspark.sql import functions as F

    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    keys = lines.select(
        (F.col("l_partkey").cast("long") ** 3).cast("long").alias("cube"), F.col("l_shipdate").cast("date").alias("day"),
        F.concat(F.lit("o'"), F.col("l_orderkey").cast("string")).alias("text"), F.when(F.col("l_linenumber") > 1, F.col("l_extendedprice").cast("decimal(12,2)")).alias("price"),
    )
    for column in keys.columns:
        at = splits.borders(keys, column, 12)
        found = splits.predicates(column, at)
        assert len(found) == 12
        rows = [keys.where(p).count() for p in found]
        assert sum(rows) == keys.count()  # every row once, also those without a key
        nulls = keys.where(F.col(column).isNull()).count()
        mean = (keys.count() - nulls) / 12
        assert max([rows[0] - nulls, *rows[1:]]) <= 2 * mean
        assert {r[0]: r[1] for r in keys.groupBy(splits.part_of(column, at)).count().collect()} == dict(enumerate(rows))
    # equal widths would not do
    low, high = keys.agg(F.min("cube"), F.max("cube")).first()
    widest = keys.groupBy(((F.col("cube") - low) * 12 / (high - low + 1)).cast("int")).count().agg(F.max("count")).first()[0]
    assert widest > 4 * keys.count() / 12
    assert splits.predicates("k", splits.borders(keys.limit(0), "cube", 5)) == ["1 = 1"] == splits.predicates("k", splits.borders(keys, "cube", 1))
    one = keys.select(F.lit(7).alias("k"))
    assert splits.predicates("k", splits.borders(one, "k", 4)) == ["k <= 7 OR k IS NULL", "k > 7"]


def test_relational_read_by_predicates():
    import pytest

    options = {"url": "jdbc:x", "predicates": ["id <= 5", "id > 5"], "fetchsize": 1000, "user": "u"}
    assert io.jdbc_arguments("dbo.t", options) == {
        "url": "jdbc:x", "table": "dbo.t", "predicates": ["id <= 5", "id > 5"], "properties": {"fetchsize": "1000", "user": "u"}
    }
    assert io.jdbc_arguments("t", {**options, "dbtable": "s.t"})["table"] == "s.t"
    for wrong in ({"predicates": []}, {"numPartitions": 3}):
        with pytest.raises(ValueError):
            io.jdbc_arguments("dbo.t", {**options, **wrong})


def test_stage_folder_is_deleted_also_after_a_failure(spark, monkeypatch):
    import os

    import pytest

    from gustolake.plans import gold

    root = scratch_dir(spark, f"t-stage-{uuid.uuid4().hex[:8]}")
    built = silver.build(FX.source_tables(spark, "/root/testdata/sf0.001"))
    monkeypatch.setattr(io, "publish", lambda *a, **b: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        gold.run(spark, built, FX.AS_OF, f"{root}/gold", database=None, stage_root=f"{root}/stage")
    assert not os.path.exists(f"{root}/stage".removeprefix("file:"))


def test_observed_counts_equal_a_count_and_retried_tasks_do_not_show(spark):
    raw = items_df(spark, [item(), item(), item(order_id=None), item(lineitem_id="2")])
    typed = silver.typed_order_items(raw)
    o = Observation()
    path = scratch_dir(spark, f"t-obs-{uuid.uuid4().hex[:8]}") + "/order_items"
    io.write_layer(silver.order_items(raw, o), path)
    assert o.get == {"rows": 4, "dropped_null_keys": 1}
    want = [("t", "raw", 4), ("t", "dropped_null_keys", 1)]
    for seen in (o.get, {"rows": 6, "dropped_null_keys": 2}):  # the second as after a task that ran twice
        got = quality.observed_counts(raw, typed, "t", C.ORDER_ITEMS_REQUIRED, seen)
        assert list(map(tuple, got.collect())) == want
    assert got.schema == quality.raw_counts(typed, "t", C.ORDER_ITEMS_REQUIRED).schema
    assert io.read_layer(spark, path).count() == 2

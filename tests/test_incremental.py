"""Days taken in one after the other against one run over all of them."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from samples import item, items_df
from gustolake.operators import base, distinct, keyset, metrics
from gustolake.plans import customers, locations, silver
from gustolake.session import scratch_dir
from gustolake.sources import contracts as C
from gustolake.sources import versions


@pytest.fixture
def path(spark):
    return scratch_dir(spark, f"t-incremental-{uuid.uuid4().hex[:8]}")


def rows_of(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def at(month, day=3):
    return dt.datetime(2001, month, day, 12)


FIRST = [
    item(order_id="1", created=at(1)), item(order_id="2", created=at(2)), item(order_id="3", created=at(3)), item(order_id="3", lineitem_id="2", created=at(3)),
    item(order_id="4", created=at(4)), item(order_id="5", created=None), item(order_id=None), item(order_id="6", created=at(5), name="B"),
]
SECOND = [
    item(order_id="2", created=at(1)),  # preferred: moves from February to January, which leaves February empty
    item(order_id="3", created=at(3, 9)),  # not preferred: nothing changes
    item(order_id="4", created=at(4)),  # the same again
    item(order_id="6", created=at(5), name="A"),  # replaced within its month
    item(order_id="7", created=at(7)), item(order_id="7", created=at(7)), item(order_id="8", user_id=None),
]


def test_two_days_equal_one_run_over_both(spark, path):
    one = silver.upsert_order_items(spark, items_df(spark, FIRST), path)
    two = silver.upsert_order_items(spark, items_df(spark, SECOND), path)
    got = silver.read_order_items(spark, path)
    both = silver.order_items(items_df(spark, FIRST + SECOND)).select(*got.columns)
    assert got.schema == both.schema and rows_of(got) == rows_of(both)
    # only months in which a line came, went or changed are written
    assert two.partitions == tuple(f"order_year=2001/order_month={m}" for m in (1, 2, 5, 7))
    new = {p for p, stamp in two.commit.folders.items() if stamp != one.commit.folders.get(p)}
    assert new == set(two.partitions) - {"order_year=2001/order_month=2"}
    assert versions.partitions_in(spark, versions.folder_of(path, two.commit.name), 2) == sorted(new)
    # the same day once more writes nothing
    again = silver.upsert_order_items(spark, items_df(spark, SECOND), path)
    assert again.commit == two.commit and again.partitions == ()


def test_days_in_any_order_and_any_cut_give_the_same(spark, path):
    rng = random.Random(3)
    lines = [
        item(order_id=str(rng.randint(1, 40)), lineitem_id=str(rng.randint(1, 2)), created=at(rng.randint(1, 6), rng.randint(1, 28)), price=f"{rng.randint(1, 9)}.00")
        for _ in range(300)
    ]
    want = rows_of(silver.order_items(items_df(spark, lines)).select(*[f.name for f in C.SILVER_ORDER_ITEMS.fields]))
    rng.shuffle(lines)
    cut = [0, 100, 130, 300]
    for a, b in zip(cut, cut[1:]):
        silver.upsert_order_items(spark, items_df(spark, lines[a:b]), path, max_bits=keyset.ROW_BITS)
    assert rows_of(silver.read_order_items(spark, path)) == want


def test_a_run_that_dies_leaves_the_days_before(spark, path, monkeypatch):
    silver.upsert_order_items(spark, items_df(spark, FIRST), path)
    before = rows_of(silver.read_order_items(spark, path))
    with monkeypatch.context() as m:
        m.setattr(versions, "rename", lambda *a: False)
        with pytest.raises(OSError):
            silver.upsert_order_items(spark, items_df(spark, SECOND), path)
    assert rows_of(silver.read_order_items(spark, path)) == before
    silver.upsert_order_items(spark, items_df(spark, SECOND), path)
    both = silver.order_items(items_df(spark, FIRST + SECOND))
    assert silver.read_order_items(spark, path).count() == both.count()


def test_only_lines_that_may_meet_are_moved(spark, path, monkeypatch):
    """The stored lines pass the key filter before any join by key, and lines of one day only are not deduplicated again."""
    first = [item(order_id=str(i), created=at(1 + i % 3), name="B") for i in range(400)]
    silver.upsert_order_items(spark, items_df(spark, first), path)
    plans, write_layer = {}, silver.io.write_layer

    def recorded(df, where, **options):
        plans[where.rpartition("/")[2].partition("=")[0]] = df._jdf.queryExecution().executedPlan().toString()
        write_layer(df, where, **options)

    monkeypatch.setattr(silver.io, "write_layer", recorded)
    second = [item(order_id=str(i), created=at(1 + i % 3), name="A") for i in range(0, 800, 40)]
    silver.upsert_order_items(spark, items_df(spark, second), path)
    assert "LeftSemi" not in plans["known"] and "SortMergeJoin" not in plans["known"]
    assert "LeftAnti" not in plans["_version"]
    got = silver.read_order_items(spark, path)
    assert rows_of(got) == rows_of(silver.order_items(items_df(spark, first + second)).select(*got.columns))


def test_split_by_keys_is_whole(spark):
    keys = spark.range(3_000).select((F.col("id") * 7).cast("string").alias("k"))
    table = spark.range(30_000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    clear, doubtful = keyset.split(table, keys, ["k"], 3_000)
    assert clear.columns == doubtful.columns == table.columns
    assert clear.join(keys, "k", "left_semi").count() == 0 and doubtful.join(keys, "k", "left_semi").count() == 3_000
    assert clear.unionByName(doubtful).agg(F.sum("v")).first()[0] == 30_000 * 29_999 // 2
    none, empty = keyset.split(table, keys.limit(0), ["k"], 0)
    assert none.count() == 30_000 and empty.count() == 0


@pytest.mark.parametrize("max_bits", [keyset.ROW_BITS, keyset.MAX_BITS])
def test_key_filter_loses_no_key_and_stops_most_others(spark, max_bits):
    keys = spark.range(3_000).select((F.col("id") * 7).cast("string").alias("k"), F.lit("x").alias("l"))
    table = spark.range(50_000).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("l"), F.col("id").alias("a.b"))
    passed = keyset.maybe_in(table, keys, ["k", "l"], 3_000, max_bits)
    assert passed.columns == table.columns
    assert passed.join(keys, ["k", "l"], "left_semi").count() == 3_000
    assert 3_000 <= passed.count() <= 3_000 + 47_000 * (0.12 if max_bits == keyset.ROW_BITS else 0.08)
    plan = passed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


# --- customers ----------------------------------------------------------------------------------
def order_lines(seed, n=900):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        order = rng.randint(1, 260)
        # some orders have lines on several days; some lines have no price
        day = dt.datetime(2001, 1, 1) + dt.timedelta(days=(order * 7) % 200 + (rng.random() < 0.1) * rng.randint(1, 40))
        out.append(item(order_id=str(order), lineitem_id=str(rng.randint(1, 9)), user_id=f"u{order % 23}", created=day,
                        price=None if order % 23 == 5 or rng.random() < 0.05 else f"{rng.randint(1, 90)}.50", loyalty=order % 4 == 0))
    return out


@pytest.fixture(scope="module")
def orders(spark):
    s = silver.build({"order_items": items_df(spark, order_lines(5)), "order_item_options": spark.createDataFrame([], C.ORDER_ITEM_OPTIONS_SOURCE),
                      "date_dim": spark.createDataFrame([], C.DATE_DIM_SOURCE)})
    return base.build(s).cache()


def between(orders, first, last):
    return orders.where(F.col("order_date").between(F.lit(first), F.lit(last)))


D0 = dt.date(2001, 1, 1)
DATES = [dt.date(2001, 4, 1), dt.date(2001, 4, 20), dt.date(2001, 7, 9)]


def check(spark, path, orders, as_of):
    want = metrics.customer_base(orders, as_of)
    got = customers.read(spark, path)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
    assert rows_of(got) == rows_of(want)


def test_state_equals_a_full_run_at_three_dates(spark, path, orders):
    since = D0
    for as_of in DATES:
        # the last delivery also has days to come
        until = as_of if as_of != DATES[-1] else dt.date(2002, 1, 1)
        customers.update(spark, path, between(orders, since, until), as_of)
        check(spark, path, between(orders, D0, until), as_of)
        since = as_of + dt.timedelta(days=1)
    # no new days: only the windows move
    customers.update(spark, path, orders.limit(0), dt.date(2001, 8, 20))
    check(spark, path, orders, dt.date(2001, 8, 20))


def test_the_second_day_reads_new_days_and_state_only(spark, path, orders, monkeypatch):
    customers.update(spark, path, between(orders, D0, DATES[0]), DATES[0])
    read = []
    whole = versions.read

    def recorded(spark_, where, at=None, only=None):
        read.append((where.rsplit("/", 1)[1], sorted(only or ())))
        return whole(spark_, where, at, only)

    monkeypatch.setattr(versions, "read", recorded)
    customers.update(spark, path, between(orders, DATES[0] + dt.timedelta(days=1), DATES[1]), DATES[1])
    parts = {m for name, only in read if name == "day_parts" for m in only}
    # months of new days, and of days that may leave a window
    assert parts and parts <= {f"day_yyyymm={m}" for m in (200101, 200102, 200103, 200104)}
    assert {n for n, _ in read} == {"order_days", "day_parts", "state"}


def test_a_day_delivered_again_and_an_earlier_date(spark, path, orders):
    customers.update(spark, path, between(orders, D0, DATES[1]).where("user_id <> 'u3'"), DATES[1])
    customers.update(spark, path, between(orders, DATES[0], DATES[1]), DATES[1])
    kept = between(orders, D0, DATES[1]).where(F.col("order_date").between(F.lit(DATES[0]), F.lit(DATES[1])) | (F.col("user_id") != "u3"))
    check(spark, path, kept, DATES[1])
    customers.update(spark, path, orders.limit(0), DATES[0])
    check(spark, path, kept, DATES[0])


def test_a_run_that_dies_between_commits_is_as_if_it_had_not_begun(spark, path, orders, monkeypatch):
    customers.update(spark, path, between(orders, D0, DATES[0]), DATES[0])
    whole, new = versions.write, between(orders, DATES[0] + dt.timedelta(days=1), DATES[1])
    with monkeypatch.context() as m:
        m.setattr(versions, "write", lambda s, d, where, *a, **b: 1 / 0 if where.endswith("state") else whole(s, d, where, *a, **b))
        with pytest.raises(ZeroDivisionError):
            customers.update(spark, path, new, DATES[1])
    check(spark, path, between(orders, D0, DATES[0]), DATES[0])
    customers.update(spark, path, new, DATES[1])
    check(spark, path, between(orders, D0, DATES[1]), DATES[1])


# --- locations ------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def placed(orders):
    place = F.when(F.col("order_id") == "17", F.lit(None)).otherwise(F.concat(F.lit("r"), (F.col("order_id").cast("int") % 5).cast("string")))
    return orders.withColumn("restaurant_id", place).cache()


def by_place(df):
    return sorted(map(repr, df.select("restaurant_id", "total_revenue", "avg_order_value", "total_orders", "unique_customers", "active_days", "revenue_rank").collect()))


def test_locations_from_days_equal_a_full_run(spark, path, placed):
    locations.update(spark, path, between(placed, D0, DATES[0]))
    locations.update(spark, path, between(placed, DATES[0], DATES[1]))  # the first day for the second time
    assert by_place(locations.performance(spark, path, DATES[1])) == by_place(metrics.location(between(placed, D0, DATES[1]), DATES[1]))
    locations.update(spark, path, between(placed, DATES[1] + dt.timedelta(days=1), dt.date(2002, 1, 1)))
    got = locations.merged(spark, path)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "HashAggregate" in plan
    assert by_place(locations.performance(spark, path, DATES[2])) == by_place(metrics.location(placed, DATES[2]))
    # any days, from the bitmaps alone
    some = locations.merged(spark, path, DATES[0], DATES[1]).select("restaurant_id", "total_orders", "unique_customers", "active_days")
    want = metrics.location(between(placed, DATES[0], DATES[1]), DATES[1]).select(*some.columns)
    assert rows_of(some) == rows_of(want)


def test_a_day_delivered_again_with_other_orders(spark, path, placed):
    locations.update(spark, path, between(placed, D0, DATES[1]))
    less = between(placed, DATES[0], DATES[1]).where("user_id <> 'u3'")
    locations.update(spark, path, less)
    kept = between(placed, D0, DATES[1]).where((F.col("order_date") < F.lit(DATES[0])) | (F.col("user_id") != "u3"))
    gone = {r[0] for r in between(placed, DATES[0], DATES[1]).select("order_date").distinct().collect()} - {r[0] for r in less.select("order_date").distinct().collect()}
    kept = kept.unionByName(placed.where(F.col("order_date").isin(sorted(gone)))) if gone else kept  # days without rows are not delivered
    assert by_place(locations.performance(spark, path, DATES[1])) == by_place(metrics.location(kept, DATES[1]))


def test_numbers_are_dense_and_stay(spark, path):
    values = spark.range(40_000).select((F.col("id") % 700).cast("string").alias("value"), (F.col("id") % 7).alias("near"))
    one = {r["value"]: r["id"] for r in distinct.numbered(spark, path, values.where("near < 4")).collect()}
    two = {r["value"]: r["id"] for r in distinct.numbered(spark, path, values.unionByName(values.select(F.lit(None).cast("string").alias("value"), "near"))).collect()}
    assert sorted(one.values()) == list(range(len(one))) and sorted(two.values()) == list(range(700))
    assert {v: two[v] for v in one} == one
    # values of one group lie together
    first = sorted(i for v, i in one.items() if int(v) % 7 == 0)
    assert first == list(range(first[0], first[0] + 100))
    many = spark.range(100_000).select((F.col("id") % 3).alias("g"), F.col("id"))
    maps = distinct.bitmaps(many.unionByName(many.limit(5_000)), ["g"])
    assert {r["g"]: r["n"] for r in distinct.counts(maps, ["g"], "n").collect()} == {0: 33_334, 1: 33_333, 2: 33_333}


def test_bitmaps_are_built_where_their_ids_meet(spark):
    ids = spark.range(10_000).select((F.col("id") % 3).alias("g"), "id").repartition(5)
    maps = distinct.bitmaps(ids, ["g"])
    steps = maps._jdf.queryExecution().executedPlan().toString()
    # the ids are shuffled, not a bitmap of 4 kB for the few that a task has of a group
    assert steps.index("partial_bitmap_construct_agg") < steps.index("Exchange hashpartitioning(g")
    assert {r["g"]: r["n"] for r in distinct.counts(maps, ["g"], "n").collect()} == {0: 3_334, 1: 3_333, 2: 3_333}


def test_orders_of_a_day_are_numbered_together(spark, path):
    # ids that alternate between two days, of which numbers in the order of places alone would fill both days' rows
    many = spark.range(70_000).select(
        F.lit("r1").alias("restaurant_id"), F.date_add(F.lit(dt.date(2001, 7, 1)), (F.col("id") % 2).cast("int")).alias("order_date"),
        F.format_string("%06d", "id").alias("order_id"), F.lit("u1").alias("user_id"), F.lit(1).cast("decimal(38,2)").alias("net_revenue"),
    )
    locations.update(spark, path, many)
    # 35,000 dense numbers a day lie in two or three rows of 32,768; in the order of ids they would lie in three each
    rows = {r["order_date"].day: r["count"] for r in versions.read(spark, f"{path}/order_bits").groupBy("order_date").count().collect()}
    assert rows == {1: 2, 2: 2}
    assert locations.merged(spark, path).first()["total_orders"] == 70_000

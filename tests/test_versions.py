"""Committed versions: what readers see during, between and after publishes, and after runs that died."""

import threading
import time
import uuid

import pytest
from pyspark.sql import functions as F

from gustolake.session import scratch_dir
from gustolake.sources import contracts as C
from gustolake.sources import io, versions

SCHEMA = C.FACT_LOYALTY_COMPARISON


@pytest.fixture
def place(spark):
    key = uuid.uuid4().hex[:8]
    return scratch_dir(spark, f"t-versions-{key}") + "/t", f"t_versions_{key}"


def table(spark, day, rows=40):
    """Rows that all carry the version's day, in several files."""
    return spark.range(rows, numPartitions=4).select(
        (F.col("id") % 2 == 0).alias("is_loyalty"), F.col("id").alias("customer_count"),
        *[F.lit(1.0).alias(c) for c in ("avg_clv", "avg_orders", "avg_order_value", "total_revenue")], F.lit(f"day {day}").alias("snapshot_date"),
    )


def days(df):
    return [(r["snapshot_date"], r["count"]) for r in df.groupBy("snapshot_date").count().collect()]


def test_readers_see_whole_versions_while_ten_are_published(spark, place):
    path, db = place
    io.publish(spark, table(spark, 0), SCHEMA, path, "t", db, keep_versions=12)
    seen, faults, stop = set(), [], threading.Event()

    def loop(read):
        while not stop.is_set():
            try:
                got = days(read())
                if len(got) != 1 or got[0][1] != 40:
                    faults.append(got)
                seen.add(got[0][0])
            except Exception as e:  # a missing table or file is what the test looks for
                faults.append(repr(e)[:500])

    threads = [threading.Thread(target=loop, args=(r,)) for r in (lambda: spark.table(f"{db}.t"), lambda: io.read_published(spark, path))]
    for t in threads:
        t.start()
    for day in range(1, 11):
        io.publish(spark, table(spark, day), SCHEMA, path, "t", db, keep_versions=12)
        time.sleep(0.2)
    stop.set()
    for t in threads:
        t.join()
    assert faults == [] and len(seen) > 3
    assert days(spark.table(f"{db}.t")) == days(io.read_published(spark, path)) == [("day 10", 40)]


def test_a_failed_rename_leaves_the_version_before(spark, place, monkeypatch):
    path, db = place
    io.publish(spark, table(spark, 1), SCHEMA, path, "t", db)
    with monkeypatch.context() as m:
        m.setattr(versions, "rename", lambda *a: False)
        with pytest.raises(OSError, match="could not commit"):
            io.publish(spark, table(spark, 2), SCHEMA, path, "t", db)
    assert days(spark.table(f"{db}.t")) == days(io.read_published(spark, path)) == [("day 1", 40)]
    assert len(versions.listed(spark, f"{path}/_data")) == 2  # the second write's folder, named by no commit
    io.publish(spark, table(spark, 3), SCHEMA, path, "t", db, keep_versions=1)
    assert days(spark.table(f"{db}.t")) == [("day 3", 40)]
    assert len(versions.listed(spark, f"{path}/_data")) == len(versions.listed(spark, f"{path}/_commits")) == 1


@pytest.mark.parametrize("step,current", [("write_layer", "day 1"), ("register", "day 2")])
def test_a_run_that_died_between_steps_is_recovered(spark, place, monkeypatch, step, current):
    path, db = place
    io.publish(spark, table(spark, 1), SCHEMA, path, "t", db)
    whole = getattr(io, step)

    def dies(*a, **b):
        if step == "write_layer":
            whole(*a, **b)  # all files are there, the commit is not
            raise KeyboardInterrupt
        if versions.current(spark, path).name != first:
            raise KeyboardInterrupt
        return whole(*a, **b)

    first = versions.current(spark, path).name
    with monkeypatch.context() as m:
        m.setattr(io, step, dies)
        with pytest.raises(KeyboardInterrupt):
            io.publish(spark, table(spark, 2), SCHEMA, path, "t", db)
    assert days(io.read_published(spark, path)) == [(current, 40)]
    assert days(spark.table(f"{db}.t")) == [("day 1", 40)]  # whole, if not yet moved
    io.register(spark, path, "t", db)
    assert days(spark.table(f"{db}.t")) == [(current, 40)]
    io.publish(spark, table(spark, 3), SCHEMA, path, "t", db)
    assert days(spark.table(f"{db}.t")) == [("day 3", 40)] and len(versions.listed(spark, f"{path}/_data")) == 2


def test_so_many_versions_are_kept_and_a_plain_read_mixes_none(spark, place):
    path, db = place
    for day in range(4):
        io.publish(spark, table(spark, day), SCHEMA, path, "t", db, keep_versions=3)
    commits = [versions.load(spark, path, n.removesuffix(".json")) for n, _ in versions.listed(spark, f"{path}/_commits")]
    assert [days(versions.read(spark, path, c)) for c in commits] == [[(f"day {d}", 40)] for d in (1, 2, 3)]
    spark.range(1).createOrReplaceTempView("a_view_of_the_session")
    assert [r["table_name"] for r in io.list_published(spark, db).collect()] == ["t"]
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA"):
        spark.read.parquet(path)


def test_some_partitions_are_replaced_and_the_others_keep_their_files(spark, place):
    path, _ = place
    df = spark.range(30).select("id", (F.col("id") % 3).alias("a"), F.date_add(F.lit("2001-01-01"), (F.col("id") % 2).cast("int")).alias("b"))
    first = versions.write(spark, df, path, ["a", "b"])
    assert sorted(map(tuple, versions.read(spark, path).collect())) == sorted(map(tuple, df.collect()))
    gone = ["a=0/b=2001-01-01", "a=1/b=2001-01-01", "a=7/b=2001-01-01"]
    second = versions.write(spark, df.where("a = 0 and b = '2001-01-01' and id < 7"), path, ["a", "b"], replaces=gone)
    assert {p for p in first.folders if second.folders.get(p) != first.folders[p]} == set(gone[:2])
    want = [tuple(r) for r in df.collect() if not (str(r["b"]) == "2001-01-01" and (r["a"] == 1 or r["a"] == 0 and r["id"] > 6))]
    assert sorted(map(tuple, versions.read(spark, path).collect())) == sorted(want)
    assert versions.read(spark, path, only=["a=2/b=2001-01-02"]).count() == 5
    with pytest.raises(ValueError, match="outside"):
        versions.write(spark, df, path, ["a", "b"], replaces=gone)
    versions.expire(spark, path, 1)
    assert versions.partitions_in(spark, versions.folder_of(path, first.name), 2) == sorted(set(first.folders) - set(gone))
    assert sorted(map(tuple, versions.read(spark, path).collect())) == sorted(want)


def test_stamps_follow_each_other_whatever_the_clock(spark, place, monkeypatch):
    path, _ = place
    one = versions.write(spark, spark.range(1), path)
    monkeypatch.setattr(time, "time_ns", lambda: 7)
    two = versions.write(spark, spark.range(2), path)
    assert two.name > one.name and versions.current(spark, path) == two and versions.read(spark, path).count() == 2


def test_nothing_committed_is_an_error(spark, place):
    with pytest.raises(FileNotFoundError):
        versions.read(spark, place[0])

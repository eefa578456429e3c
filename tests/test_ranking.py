"""Distributed exact quantiles and rank() against Spark's single-task built-ins."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gustolake.operators import ranking as R

PS = [0.0001, 0.2, 0.33, 0.5, 0.67, 0.8, 1.0]


@pytest.fixture(scope="module")
def data(spark):
    x = F.when(F.rand(1) < 0.05, None).otherwise((F.rand(2) * 300).cast("int") * F.lit(1.25).cast("decimal(10,2)"))
    return spark.range(6000).select("id", x.alias("x")).cache()


@pytest.mark.parametrize("rows_per_bucket", [10**9, 40, 7])
def test_exact_quantiles(spark, data, rows_per_bucket):
    names = [f"q{i}" for i in range(len(PS))]
    got = R.exact_quantiles(data, "x", PS, names, rows_per_bucket=rows_per_bucket).first()
    ref = data.agg(*[F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY x)") for p in PS]).first()
    assert [float(v) for v in got] == list(ref)


@pytest.mark.parametrize("rows_per_bucket", [10**9, 11])
@pytest.mark.parametrize("descending", [True, False])
def test_global_rank(spark, data, rows_per_bucket, descending):
    got = R.global_rank(data, "x", "rk", descending=descending, rows_per_bucket=rows_per_bucket)
    order = F.desc("x") if descending else F.asc("x")
    ref = data.withColumn("rk2", F.rank().over(Window.orderBy(order)))
    assert got.count() == data.count()
    assert got.join(ref, "id").where(~F.col("rk").eqNullSafe(F.col("rk2"))).count() == 0


def test_empty_quantiles(spark):
    df = spark.createDataFrame([], "x decimal(10,2)")
    assert tuple(R.exact_quantiles(df, "x", [0.5], ["m"]).first()) == (None,)


def test_buckets_follow_the_rows_without_a_ceiling(spark):
    vc = spark.range(100_000).select(F.lit(0).alias("_m"), (F.col("id") * 3 % 100_003).alias("_v"), F.lit(1).alias("_c"))
    sizes = [r["count"] for r in R.buckets_of(vc, rows_per_bucket=50).groupBy("_b").count().collect()]
    assert len(sizes) > 1024 and max(sizes) <= 4 * 50 and sum(sizes) == 100_000


def test_many_buckets_equal_percentile_and_rank(spark):
    df = spark.range(30_000).select("id", (F.col("id") * 7 % 9001).alias("x"))
    got = R.exact_quantiles(df, "x", PS, [f"q{i}" for i in range(len(PS))], rows_per_bucket=5).first()
    ref = df.agg(*[F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY x)") for p in PS]).first()
    assert [float(v) for v in got] == list(ref)


def test_no_single_partition_over_values(spark, data):
    plan = R.exact_quantiles(data, "x", [0.5], ["m"])._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Window"):]
    assert "SinglePartition" not in below


def test_approx_quantiles_close(spark, data):
    got = R.approx_quantiles(data, "x", [0.5], ["m"]).first()[0]
    exact = data.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY x)")).first()[0]
    assert abs(float(got) - exact) <= 0.02 * 375


# --- sketches -------------------------------------------------------------------------------
SPECS = [("x", PS, [f"x{i}" for i in range(len(PS))]), ("money", [0.2, 0.5, 0.8], ["m20", "m50", "m80"])]


@pytest.fixture(scope="module")
def many(spark):
    x = (F.xxhash64("id") % 50_000).cast("int")
    money = (F.pow(F.abs(F.xxhash64("id", F.lit(1)) % 1000) / 100, 3)).cast("decimal(12,2)")
    return spark.range(120_000).select((F.col("id") % 9).alias("day"), x.alias("x"), F.when(F.col("id") % 7 != 0, money).alias("money")).cache()


def rank_errors(df, row):
    """How far each quantile's rank is from the one asked for, as a share of the rows."""
    out = []
    for c, probs, names in SPECS:
        n = df.where(F.col(c).isNotNull()).count()
        for p, name in zip(probs, names):
            below, upto = df.agg(F.count_if(F.col(c) < row[name]), F.count_if(F.col(c) <= row[name])).first()
            out.append(max(0.0, below / n - p, p - upto / n))
    return out


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_sketched_ranks_are_within_the_bound(many, partitions):
    got = R.approx_quantiles_multi(many.repartition(partitions), SPECS, 0.01)
    assert [f.dataType for f in got.schema] == [many.schema[c].dataType for c, _, names in SPECS for _ in names]
    assert max(rank_errors(many, got.first())) <= 0.01


def test_days_merged_equal_one_pass_within_the_bound(many):
    types = {c: many.schema[c].dataType for c in ("x", "money")}
    days = R.sketches(many, ["x", "money"], 0.01, by=["day"])
    assert days.count() == 9
    merged = R.sketched_quantiles(R.merged_sketches(days, ["x", "money"], 0.01), SPECS, types).first()
    assert max(rank_errors(many, merged)) <= 0.01
    # some days only
    some = R.sketched_quantiles(R.merged_sketches(days.where("day < 4"), ["x", "money"], 0.01), SPECS, types).first()
    assert max(rank_errors(many.where("day < 4"), some)) <= 0.01


def test_sketches_of_nothing(spark):
    df = spark.createDataFrame([(None,), (None,)], "x decimal(10,2)")
    assert tuple(R.approx_quantiles(df, "x", [0.5], ["m"]).first()) == (None,)
    assert tuple(R.approx_quantiles(df.limit(0), "x", [0.5], ["m"]).first()) == (None,)


def test_smaller_errors_need_larger_sketches():
    sizes = [R.sketch_size(e) for e in (0.9, 0.05, 0.01, 0.001, 1e-9)]
    assert sizes == sorted(sizes) and sizes[0] == 8 and sizes[-1] == 65_535 and 400 <= R.sketch_size(0.01) <= 430


# --- buckets ----------------------------------------------------------------------------------
def test_few_values_make_two_buckets_whatever_the_session_says(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    vc = spark.range(25).select(F.lit(0).alias("_m"), F.col("id").alias("_v"), F.lit(1).alias("_c"))
    try:
        for n in ("2", "400"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert R.buckets_of(vc).select("_b").distinct().count() == 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_gold_run_leaves_nothing_behind(spark):
    import os
    import uuid

    from gustolake.plans import gold, silver
    from gustolake.session import scratch_dir
    from gustolake.sources import fixtures as FX

    base = scratch_dir(spark).removeprefix("file:")
    built = silver.build(FX.source_tables(spark, "/root/testdata/sf0.001"))
    before = set(os.listdir(base))
    key = uuid.uuid4().hex[:8]
    gold.run(spark, built, FX.AS_OF, f"{base}/gold-{key}", database=f"t_left_{key}")
    after = set(os.listdir(base)) - {f"gold-{key}"}
    # Spark's cleaner may meanwhile delete checkpoints of frames that other tests have let go
    assert after <= before

"""Exact order statistics without funnelling all values into one task.

``percentile_disc`` and an unpartitioned ``rank()`` window both gather every
value of the column in a single task. Here the work is spread instead, the same
way at every size:

1. count rows per distinct value (a shuffle with map-side partial counts, so a
   value shared by a huge share of the rows is one row afterwards);
2. range-partition the values into as many buckets as ``rows_per_bucket`` asks
   for, at least two, and stage them, so that every consumer sees the same
   buckets;
3. a running count inside each bucket (a window partitioned by bucket);
4. bucket totals -> offsets over one row per bucket, joined back.

``below`` is then the exact number of rows strictly smaller than the value,
from which exact quantiles and ``rank()`` follow. The bucket borders only
affect balance, never the result.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustolake.session import scratch_dir

ROWS_PER_BUCKET = 1_000_000
#: Materialises a frame: (frame, name) -> the frame read back.
Stage = Callable[[DataFrame, str], DataFrame]


def checkpointed(df: DataFrame, name: str) -> DataFrame:
    """Reliable checkpoint in the session's checkpoint folder; Spark's cleaner deletes it with the last frame that uses it
    (``spark.cleaner.referenceTracking.cleanCheckpoints``, a session default here)."""
    scratch_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _common_type(df: DataFrame, cols: Sequence[str]) -> T.DataType:
    """A type holding every value of ``cols`` exactly (for stacking measures)."""
    types = [df.schema[c].dataType for c in cols]
    if len(set(types)) == 1:
        return types[0]
    if all(isinstance(t, (T.DecimalType, T.IntegralType)) for t in types):
        scale = max((t.scale for t in types if isinstance(t, T.DecimalType)), default=0)
        return T.DecimalType(38, scale)
    if all(isinstance(t, T.NumericType) for t in types):
        return T.DoubleType()
    raise TypeError(f"cannot rank {cols} together: {types}")


def buckets_of(vc: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET, stage: Stage = checkpointed) -> DataFrame:
    """``vc`` (_m, _v, ...) in ranges of about ``rows_per_bucket`` rows, numbered in order as ``_b``.

    The bucket count follows the row count alone, from two upwards. ``stage``
    materialises both steps; a caller that gives its own deletes them."""
    key = uuid.uuid4().hex[:12]
    counted = stage(vc, f"rank_values_{key}")
    n = max(-(-counted.count() // rows_per_bucket), 2)
    return stage(counted.repartitionByRange(n, "_m", "_v").withColumn("_b", F.spark_partition_id()), f"rank_buckets_{key}")


def cumulative_counts(
    df: DataFrame, cols: str | Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET, stage: Stage = checkpointed
) -> DataFrame:
    """One row per (measure, distinct non-null value): ``_m`` measure index
    (position in ``cols``), ``_v`` value, ``_c`` rows with it, ``_below`` rows
    of that measure strictly smaller, ``_n`` non-null rows of that measure.

    Several measures are stacked and processed in one pass (values cast to a
    common exact type)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    if len(cols) == 1:
        long = df.select(F.lit(0).alias("_m"), F.col(cols[0]).alias("_v"))
    else:
        common = _common_type(df, cols)
        long = df.select(
            F.inline(F.array(*[
                F.struct(F.lit(i).alias("_m"), F.col(c).cast(common).alias("_v")) for i, c in enumerate(cols)
            ]))
        )
    vc = long.where(F.col("_v").isNotNull()).groupBy("_m", "_v").agg(F.count(F.lit(1)).alias("_c"))
    running = Window.partitionBy("_m", "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bucketed = buckets_of(vc, rows_per_bucket, stage)
    local = bucketed.withColumn("_run", F.sum("_c").over(running))
    # one row per measure and bucket from here on
    totals = bucketed.groupBy("_m", "_b").agg(F.sum("_c").alias("_bc"))
    before = Window.partitionBy("_m").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_m", "_b",
        F.coalesce(F.sum("_bc").over(before), F.lit(0)).alias("_off"),
        F.sum("_bc").over(Window.partitionBy("_m")).alias("_n"),
    )
    out = local.join(offsets, ["_m", "_b"])
    return out.select("_m", "_v", "_c", (F.col("_off") + F.col("_run") - F.col("_c")).alias("_below"), "_n")


def rank_position(p: float) -> Column:
    """1-based rank of the p-quantile among ``_n`` values: max(1, ceil(p * n))."""
    return F.greatest(F.lit(1), F.ceil(F.lit(float(p)) * F.col("_n")))


def exact_quantiles_multi(
    df: DataFrame,
    specs: Sequence[tuple[str, Sequence[float], Sequence[str]]],
    rows_per_bucket: int = ROWS_PER_BUCKET,
    stage: Stage = checkpointed,
) -> DataFrame:
    """One row holding, for every (column, probabilities, names) spec, the
    value at rank max(1, ceil(p*n)) of that column's sorted non-null values
    (null when there are none), in the column's own type. All columns share
    one pass."""
    cols = [c for c, _, _ in specs]
    cc = cumulative_counts(df, cols, rows_per_bucket, stage)
    aggs = []
    for i, (c, probs, names) in enumerate(specs):
        for p, name in zip(probs, names, strict=True):
            k = rank_position(p)
            hit = (F.col("_m") == i) & (F.col("_below") < k) & (k <= F.col("_below") + F.col("_c"))
            aggs.append(F.max(F.when(hit, F.col("_v"))).cast(df.schema[c].dataType).alias(name))
    return cc.agg(*aggs)


def exact_quantiles(
    df: DataFrame, col: str, probs: Sequence[float], names: Sequence[str],
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """``exact_quantiles_multi`` for one column."""
    return exact_quantiles_multi(df, [(col, probs, names)], rows_per_bucket)


# The normalised rank error of a KLL sketch is 2.296 / k^0.9021 with 99 % confidence, k from 8 to 65535.
KLL_FACTOR, KLL_POWER, KLL_SIZES = 2.296, 0.9021, (8, 65_535)


def sketch_size(relative_error: float) -> int:
    """The k of a KLL sketch whose ranks are off by at most ``relative_error`` of the rows (99 %)."""
    return min(KLL_SIZES[1], max(KLL_SIZES[0], math.ceil((KLL_FACTOR / relative_error) ** (1 / KLL_POWER))))


def sketches(df: DataFrame, cols: Sequence[str], relative_error: float = 0.01, by: Sequence[str] = ()) -> DataFrame:
    """A KLL sketch per column (same names, binary), one row per value of ``by``: a table of, say, days to be merged later.

    A sketch has a few kB whatever the rows; nulls are not in it. Numbers are sketched as doubles."""
    k = sketch_size(relative_error)
    return df.groupBy(*by).agg(*[F.kll_sketch_agg_double(F.col(c).cast("double"), k).alias(c) for c in cols])


def merged_sketches(parts: DataFrame, cols: Sequence[str], relative_error: float = 0.01, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of the union: rows of ``sketches`` merged, all of them or per value of ``by``; the error stays the same."""
    return parts.groupBy(*by).agg(*[F.kll_merge_agg_double(c, sketch_size(relative_error)).alias(c) for c in cols])


def sketched_quantiles(
    sketch: DataFrame, specs: Sequence[tuple[str, Sequence[float], Sequence[str]]], types: dict[str, T.DataType]
) -> DataFrame:
    """One row of quantiles for every spec from one row of sketches; null where a sketch has no values."""
    return sketch.select(*[
        F.when(F.kll_sketch_get_n_double(c) > 0, F.kll_sketch_get_quantile_double(c, F.lit(float(p)))).cast(types[c]).alias(name)
        for c, probs, names in specs for p, name in zip(probs, names, strict=True)
    ])


def approx_quantiles_multi(
    df: DataFrame, specs: Sequence[tuple[str, Sequence[float], Sequence[str]]], relative_error: float = 0.01
) -> DataFrame:
    """One row of approximate quantiles for every spec, in one aggregate: a KLL sketch per column and partition, merged.

    A quantile's rank is off by at most ``relative_error`` of the rows with 99 % confidence, however the rows are
    partitioned; which of the values within that bound comes back may differ."""
    cols = [c for c, _, _ in specs]
    return sketched_quantiles(sketches(df, cols, relative_error), specs, {c: df.schema[c].dataType for c in cols})


def approx_quantiles(
    df: DataFrame, col: str, probs: Sequence[float], names: Sequence[str], relative_error: float = 0.01
) -> DataFrame:
    return approx_quantiles_multi(df, [(col, probs, names)], relative_error)


def global_rank(
    df: DataFrame, col: str, name: str, descending: bool = True, rows_per_bucket: int = ROWS_PER_BUCKET,
    stage: Stage = checkpointed,
) -> DataFrame:
    """``df`` plus ``rank()`` over the whole frame ordered by ``col``.

    Ties share a rank and the next rank skips. Descending puts nulls last,
    ascending puts them first (Spark's defaults for ``rank()``). The ranks are
    computed per distinct value and joined back on the value (null-safe).
    """
    cc = cumulative_counts(df, col, rows_per_bucket, stage)
    null_v = F.lit(None).cast(df.schema[col].dataType).alias("_v")
    if descending:
        ranks = cc.select(F.col("_v"), (F.col("_n") - F.col("_below") - F.col("_c") + 1).alias("_rank"))
        # nulls rank after every non-null row; one extra row from a one-row aggregate
        null_row = cc.agg(null_v, (F.coalesce(F.max("_n"), F.lit(0)) + 1).alias("_rank"))
    else:
        n_null = df.where(F.col(col).isNull()).agg(F.count(F.lit(1))).scalar()
        ranks = cc.select(F.col("_v"), (F.col("_below") + 1 + n_null).alias("_rank"))
        null_row = cc.agg(null_v, F.lit(1).cast("long").alias("_rank"))
    ranks = ranks.unionByName(null_row)
    joined = df.join(ranks, df[col].eqNullSafe(ranks["_v"]), "left")
    return joined.withColumn(name, F.col("_rank").cast("int")).drop("_v", "_rank")

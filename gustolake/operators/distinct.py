"""Exact distinct counts as bitmaps that merge over days: no row per value is kept, none is expanded per count.

Values are numbered once, densely, in a growing dictionary (a committed dataset).
A group's values of a day are then rows of 4 kB, one for each 32,768 numbers it
meets, and the distinct count over any days is the count of bits of their union.
New values are numbered in the order of a hint column, so values that occur in
the same group lie together and their bitmaps are few and full.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gustolake.operators import keyset
from gustolake.session import scratch_dir
from gustolake.sources import io, versions

BATCH = "batch"


def numbered(spark: SparkSession, path: str, values: DataFrame) -> DataFrame:
    """``values`` (value, near) -> (value, id) of every distinct non-null value, from the dictionary in ``path``.

    Values it lacks are added, numbered on from its last; a run that dies leaves
    at most numbers that others will use. The dictionary is tested map-side for
    the values asked for, so it is not shuffled whole.
    """
    stage = scratch_dir(spark, f"values-{uuid.uuid4().hex[:12]}")
    try:
        asked = values.where("value is not null").groupBy("value").agg(F.min("near").alias("near"))
        io.write_layer(asked, f"{stage}/asked")
        asked = spark.read.parquet(f"{stage}/asked")
        at = versions.current(spark, path)
        start, n = (at.info["next"] if at else 0), asked.count()
        new = asked
        if at and at.folders:
            known = keyset.maybe_in(versions.read(spark, path, at).select("value"), asked, ["value"], n)
            new = asked.join(known, "value", "left_anti")
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        in_order = new.repartitionByRange(parts, "near", "value").sortWithinPartitions("near", "value")
        io.write_layer(
            in_order.select("value", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("at")),
            f"{stage}/new",
        )
        new = spark.read.parquet(f"{stage}/new")
        counts = new.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
        # one row per partition
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select("part", (F.coalesce(F.sum("n").over(before), F.lit(0)) + start).alias("offset"))
        added = new.count()
        if added or not at:
            batch = f"{BATCH}={len(at.folders) if at else 0}"
            ids = new.join(offsets, "part").select("value", (F.col("at") + F.col("offset")).alias("id"), F.lit(int(batch.partition("=")[2])).alias(BATCH))
            at = versions.write(spark, ids, path, [BATCH], replaces=[batch], base=at, info={"next": start + added})
            versions.expire(spark, path, 2)
    finally:
        io.delete_folder(spark, stage)
    if not at.folders:
        return spark.createDataFrame([], "value string, id long")
    return versions.read(spark, path, at).select("value", "id")


def bitmaps(df: DataFrame, by: Sequence[str], id_col: str = "id") -> DataFrame:
    """``df`` (by..., id), distinct rows -> by..., row, bits: the ids of each group, 32,768 in a row.

    The ids move first, of which at most 32,768 meet in a row. Built map-side,
    nearly every id would become a row of 4 kB, since a task has few of each row's.
    """
    i = F.col(id_col)
    bits = df.select(*by, F.shiftright(i, 15).alias("row"), i.bitwiseAND(keyset.ROW_BITS - 1).alias("_bit"))
    return bits.repartition(*by, "row").groupBy(*by, "row").agg(F.bitmap_construct_agg("_bit").alias("bits"))


def counts(maps: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Distinct counts per group over all of its bitmaps, days merged."""
    union = maps.groupBy(*by, "row").agg(F.bitmap_or_agg("bits").alias("bits"))
    return union.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(name))

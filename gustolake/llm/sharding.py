"""Sharding by longest-processing-time scheduling: groups of equal texts, largest first, to the least-loaded shard.

Rows are hashed once; equal texts are counted into groups with a map-side
partial, so a text holding a third of all rows is one row per task before it
moves. Groups are range-partitioned by weight and counted as *runs*: the groups
of one partition that weigh the same. The schedule goes over the runs, heaviest
first, with a heap of shard loads. Runs of equal groups are dealt at once where
they are long, with the result that popping the heap group by group would give.

Distinct weights add up to at most the total, so there are at most
sqrt(2 * bytes) of them, plus one run per partition border: 14 million rows of
16 bytes at 100 TB. One task sorts (and spills) and streams them; it holds 40
loads. Slots are prefix sums over (partition, shard) counts.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gustolake.llm import _shared as S

DEALT = "part int, weight long, shards array<int>, upto array<long>"

#: Groups holding at least this share of all rows meet their rows by a broadcast of at most HEAVY rows.
HEAVY = 10_000


class Schedule:
    """Loads of the shards; ``deal`` gives groups of one weight to the least-loaded ones (ties: smallest shard)."""

    def __init__(self, shards: int, by_heap_upto: int = 256) -> None:
        self.heap = [(0, s) for s in range(shards)]
        self.by_heap_upto = by_heap_upto

    def deal(self, weight: int, groups: int) -> dict[int, int]:
        """Shard -> how many of ``groups`` groups of this (positive) weight it takes."""
        if groups > self.by_heap_upto:
            return self._deal_level(weight, groups)
        out: dict[int, int] = {}
        for _ in range(groups):
            load, s = self.heap[0]
            heapq.heapreplace(self.heap, (load + weight, s))
            out[s] = out.get(s, 0) + 1
        return out

    def _deal_level(self, weight: int, groups: int) -> dict[int, int]:
        """As by the heap: it takes the shards in order of (load before the group, shard), all below some level first."""

        def below(level: int) -> int:
            return sum(max(0, -(-(level - load) // weight)) for load, _ in self.heap)

        low = min(load for load, _ in self.heap)
        high = max(load for load, _ in self.heap) + weight * (groups + 1)
        while high - low > 1:  # the highest level with no more groups below than there are
            middle = (low + high) // 2
            low, high = (middle, high) if below(middle) <= groups else (low, middle)
        out = {s: max(0, -(-(low - load) // weight)) for load, s in self.heap}
        left = groups - sum(out.values())
        at_level = sorted(s for load, s in self.heap if load + out[s] * weight == low)
        for s in at_level[:left]:
            out[s] += 1
        self.heap = [(load + out[s] * weight, s) for load, s in self.heap]
        heapq.heapify(self.heap)
        return {s: n for s, n in out.items() if n}


def dealt(runs: DataFrame, shards: int) -> DataFrame:
    """``runs`` (part, weight, groups) -> shards that take them and the count of groups up to each."""
    schema = S.arrow_schema(DEALT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schedule = Schedule(shards)
        for b in batches:
            rows = []
            for part, weight, groups in zip(*[c.to_pylist() for c in b.columns], strict=True):
                upto, taken = [], sorted(schedule.deal(weight, groups).items())
                for _, n in taken:
                    upto.append(n + (upto[-1] if upto else 0))
                rows.append((part, weight, [s for s, _ in taken], upto))
            yield S.batch_of(rows, schema)

    # the schedule depends on all heavier groups, so one task goes over the runs (bound: see above)
    in_order = runs.select("part", "weight", "groups").repartition(1).sortWithinPartitions(F.desc("weight"), "part")
    return S.map_rows(in_order, {c: F.col(c) for c in ("part", "weight", "groups")}, run, DEALT)


def _position() -> Column:
    """Row number within the partition, from 0."""
    return F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)


def group_shards(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` (key, size) -> one row per key: key, copies, shard."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = rows.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.sum("size").alias("weight"))
    ordered = S.staged(
        groups.repartitionByRange(n, F.desc("weight"), "key").sortWithinPartitions(F.desc("weight"), "key")
        .select("key", "copies", "weight", F.spark_partition_id().alias("part"), _position().alias("at")),
        "groups",
    )
    runs = ordered.groupBy("part", "weight").agg(F.count(F.lit(1)).alias("groups"), F.min("at").alias("first"))
    runs = S.staged(runs, "runs")
    taken = S.staged(dealt(runs, shards), "dealt").join(runs.select("part", "weight", "first"), ["part", "weight"])
    number = F.col("at") - F.col("first")
    shard = F.col("shards")[F.size(F.filter("upto", lambda u: u <= number))]
    return ordered.join(taken, ["part", "weight"]).select("key", "copies", shard.alias("shard"))


def assign(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 40, overhead: int = 16
) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null).

    ``size`` is the text's bytes in UTF-8 plus ``overhead``. Rows of equal text
    share a shard, so shards are as near in bytes as such groups allow: the
    fullest has at most the mean plus one group. Null texts count as empty ones
    (size ``overhead``, crc32 0) and share their group. Repeated rows and null
    ids are placed as often as given; ties in weight follow the text's SHA-256;
    other columns are not read; an empty table gives an empty result. ``slot``
    numbers a shard's rows from 0 without gaps.
    """
    text = F.coalesce(S.column(text_col).cast("binary"), F.lit(b""))
    rows = S.staged(df.select(
        S.column(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("key"),
    ), "rows")
    groups = S.staged(group_shards(rows, shards), "shards")
    total = groups.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    # groups of a large share of the rows, of which there are at most HEAVY, don't meet their rows in one task
    heavy = groups.where(F.col("copies") * HEAVY >= total).select("key", F.col("shard").alias("heavy_shard"))
    looked = rows.join(F.broadcast(heavy), "key", "left")
    light = looked.where("heavy_shard is null").join(groups.where(F.col("copies") * HEAVY < total).select("key", "shard"), "key")
    columns = ["doc_id", "size", "text_crc32"]
    placed = looked.where("heavy_shard is not null").select(*columns, F.col("heavy_shard").alias("shard")).union(light.select(*columns, "shard"))
    placed = S.staged(
        placed.sortWithinPartitions("shard").select("*", F.spark_partition_id().alias("part"), _position().alias("at")), "placed"
    )
    counts = placed.groupBy("part", "shard").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition and shard; Spark's size threshold decides whether it is broadcast
    offsets = counts.select("part", "shard", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("offset"))
    return placed.join(offsets, ["part", "shard"]).select(
        *columns, F.lit("bytes").alias("law"), "shard", (F.col("at") + F.col("offset")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(S.read_table(spark, sf_dir, "documents"))

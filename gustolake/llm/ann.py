"""Nearest neighbours by shifted Hilbert curves, with an exact completion.

Distinct vectors are projected to a few dimensions in several ways, shifted,
and ordered along a Hilbert curve each, by range partitioning in Spark. A
query's candidates are the vectors within a window of positions on every curve;
the windows' finds are merged and reranked by exact distances.

The windows give each query a radius. The blocks of the first curve are then
read again where their bounding ball reaches into a query's radius, so the
result is that of brute force; on clustered vectors few blocks are left, on
vectors without structure most are (``exact=False`` leaves this step out).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gustolake.llm import _shared as S

DIMS, BITS = 8, 7
#: Chunks of the first curve whose bounding balls are sent to the tasks: 4096 balls at most.
MAX_CHUNKS = 4096
#: Queries, and rows of a large table, that meet in one task of the exact step.
QUERY_GROUP = 16_384
SCAN_ROWS = 16_384

PLACED = "curve int, part int, at long, vid long, is_query boolean, vec array<float>"
FOUND = "query long, vid long, score double"


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position of each row of cell coordinates (below 2**bits) along the Hilbert curve, bits * dims wide."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:  # undo the rotations and reflections of every coarser level
        low = q - 1
        for i in range(dims):
            flip = (x[i] & q) > 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = top
    while q > 1:
        t ^= np.where((x[-1] & q) > 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[i] >> b & 1)
    return key


class Curves:
    """Projections, scales and shifts of the curves, fitted on a bounded sample."""

    def __init__(self, sample: np.ndarray, curves: int, dims: int = DIMS, bits: int = BITS) -> None:
        dim = sample.shape[1]
        self.dims, self.bits = min(dims, dim), bits
        self.mean = sample.mean(axis=0)
        rng = np.random.default_rng(11)
        self.maps, self.low, self.scale = [], [], []
        for _ in range(curves):
            basis = np.linalg.qr(rng.standard_normal((dim, dim)))[0][:, : self.dims]
            y = (sample - self.mean) @ basis
            low, high = y.min(axis=0), y.max(axis=0)
            width = np.maximum(high - low, 1e-9)
            shift = rng.uniform(0, 0.25, self.dims) * width
            self.maps.append(basis)
            self.low.append(low - shift)
            self.scale.append((1 << bits) / (1.25 * width))

    def keys(self, curve: int, x: np.ndarray) -> np.ndarray:
        y = (x - self.mean) @ self.maps[curve]
        cells = np.clip((y - self.low[curve]) * self.scale[curve], 0, (1 << self.bits) - 1)
        return hilbert_keys(cells.astype(np.int64), self.bits)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1), np.float32)


def _nearest(q: np.ndarray, x: np.ndarray, k: int, allowed: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per row of ``q``: (row, up to k rows of ``x`` and all ties of the last, exact distances in double precision)."""
    xd = x.astype(np.float64)
    norms = np.einsum("ij,ij->i", xd, xd)
    for start in range(0, len(q), 256):
        qd = q[start : start + 256].astype(np.float64)
        near = norms[None, :] - 2 * qd @ xd.T + np.einsum("ij,ij->i", qd, qd)[:, None]
        if allowed is not None:
            near = np.where(allowed[start : start + 256], near, np.inf)
        for i in range(len(qd)):
            row = near[i]
            if len(row) > k:
                edge = np.partition(row, k - 1)[k - 1]
                # the product form rounds, so take a margin along and rank by exact differences
                at = np.flatnonzero(row <= edge + 1e-9 * (1 + abs(edge))) if np.isfinite(edge) else np.flatnonzero(np.isfinite(row))
            else:
                at = np.flatnonzero(np.isfinite(row))
            yield start + i, at, np.sqrt(((xd[at] - qd[i]) ** 2).sum(axis=1))


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec) of rows with an id and a non-zero vector of finite components, of the commonest length."""
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<float>").alias("vec")).where(
        "vec_id is not null and vec is not null and size(vec) > 0 and forall(vec, x -> x is not null and not isnan(x) and abs(x) < float('infinity'))"
        " and exists(vec, x -> x <> 0)"
    )
    lengths = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1)
    return rows.join(F.broadcast(lengths.select("n")), F.size("vec") == F.col("n")).drop("n")


def distinct_vectors(rows: DataFrame, k: int, query_every: int) -> DataFrame:
    """One row per distinct vector: vid (its smallest id), vec, the k + 1 smallest ids, whether a query has it."""
    tagged = rows.select("vec_id", "vec").distinct()
    first = Window.partitionBy("vec").orderBy("vec_id")
    members = tagged.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    ids = members.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
    asked = tagged.groupBy("vec").agg(F.max(F.col("vec_id") % query_every == 0).alias("is_query"))
    return ids.join(asked, "vec").select(F.col("members")[0].alias("vid"), "vec", "members", "is_query")


def _placed(classes: DataFrame, curves: Curves, n_curves: int) -> DataFrame:
    """Every vector on every curve, range-partitioned by key, with its place inside its partition."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(2)).astype(np.float64)
            for c in range(n_curves):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), c, np.int32)), pa.array(curves.keys(c, x)), *b.columns], names=["curve", "key", "vid", "is_query", "vec"]
                )

    rows = classes.select("vid", "is_query", "vec").mapInArrow(keyed, "curve int, key long, vid long, is_query boolean, vec array<float>")
    order = ["curve", "key", "vid"]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b.num_rows
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n)), *b.columns[2:]],
                names=["curve", "part", "at", "vid", "is_query", "vec"],
            )
            at += n

    return S.staged(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(placed, PLACED), "curves")


def _positions(placed: DataFrame) -> DataFrame:
    """Adds each row's position along its curve: counts of the partitions before, summed over one row per partition."""
    counts = placed.groupBy("curve", "part").agg(F.min("at").alias("from"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("curve", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("from")).alias("base"))
    # one small row per curve and shuffle partition
    return placed.join(F.broadcast(base), ["curve", "part"]).select("curve", (F.col("at") + F.col("base")).alias("pos"), "vid", "is_query", "vec")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy("score", "vid")
    return found.distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).drop("n")


def search(
    df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10, query_every: int = 100,
    curves: int = 4, window: int = 512, sample_rows: int = 10_000, exact: bool = True,
) -> DataFrame:
    """The ``k`` nearest other rows of every row whose id is divisible by ``query_every``: query_id, rank, vec_id, score.

    Euclidean distance in double precision; ties go to the smaller vec_id.
    Curves are fitted on at most ``sample_rows`` vectors (by hashed id). Rows
    without id and vectors that are null, zero, of another length than most or
    with null or non-finite components take no part; repeated rows of an id and
    vector count once. Fewer candidates give fewer rows; an empty table none.
    """
    S.ship_code(df.sparkSession)
    rows = usable(df, id_col, vec_col)
    classes = S.staged(distinct_vectors(rows, k, query_every), "vectors")
    sample = classes.orderBy(F.xxhash64("vid"), "vid").limit(sample_rows).select("vec").toPandas()["vec"]
    out_schema = S.arrow_schema(FOUND)
    if not len(sample):
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    fitted = Curves(np.stack([np.asarray(v, np.float64) for v in sample]), curves)
    placed = S.staged(_positions(_placed(classes, fitted, curves)), "positions")
    queries = placed.where("is_query").drop("is_query")
    data = placed.withColumn("block", F.floor(F.col("pos") / window))
    asked = queries.withColumn("block", F.explode(F.expr(f"sequence(floor(pos / {window}) - 1, floor(pos / {window}) + 1)")))

    def in_window(left: pa.Table, right: pa.Table) -> pa.Table:
        q, x = _matrix(left["vec"]), _matrix(right["vec"])
        names = np.asarray(left["vid"]), np.asarray(right["vid"])
        out: list[tuple] = []
        if len(q) and len(x):
            apart = np.abs(np.asarray(left["pos"])[:, None] - np.asarray(right["pos"])[None, :])
            for i, at, d in _nearest(q, x, k + 1, apart <= window):
                out += [(int(names[0][i]), int(names[1][j]), float(s)) for j, s in zip(at, d, strict=True)]
        return pa.Table.from_batches([S.batch_of(out, out_schema)])

    near = asked.groupBy("curve", "block").cogroup(data.groupBy("curve", "block")).applyInArrow(in_window, FOUND)
    best = S.staged(_best(near, k + 1), "windows")
    if exact:
        best = _best(best.unionByName(_completed(placed, best, k, window)), k + 1)
    return _named(rows, classes, best, k, query_every)


def _completed(placed: DataFrame, best: DataFrame, k: int, window: int) -> DataFrame:
    """Finds within each query's radius in all blocks of the first curve whose bounding ball reaches into it."""
    out_schema = S.arrow_schema(FOUND)
    curve = placed.where("curve = 0")
    total = curve.count()
    # every block is sent again for each group of queries and every query for each block, so large tables get large blocks
    scan = max(window, min(SCAN_ROWS, -(-total // MAX_CHUNKS)))
    last = (total - 1) // scan
    curve = curve.withColumn("block", F.floor(F.col("pos") / scan))
    per_chunk = -(-(last + 1) // MAX_CHUNKS)
    dim = len(curve.select("vec").first()[0])
    chunked = curve.withColumn("chunk", F.floor(F.col("block") / per_chunk))
    centres = chunked.groupBy("chunk").agg(*[F.avg(F.col("vec")[i].cast("double")).alias(f"c{i}") for i in range(dim)])
    centres = centres.select("chunk", F.array(*[f"c{i}" for i in range(dim)]).alias("centre"))
    away = F.sqrt(F.aggregate(F.zip_with("vec", "centre", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v))
    balls = chunked.join(F.broadcast(centres), "chunk").groupBy("chunk").agg(F.first("centre").alias("centre"), F.max(away).alias("radius"))
    balls = balls.orderBy("chunk").toPandas()  # MAX_CHUNKS rows at most
    centre, radius, chunk = np.stack(balls["centre"].map(np.asarray)), balls["radius"].to_numpy(), balls["chunk"].to_numpy()
    # a query that found fewer than k + 1 has no radius yet
    radii = best.groupBy("query").agg(F.when(F.count(F.lit(1)) > k, F.max("score")).otherwise(F.lit(float("inf"))).alias("reach"))
    queries = curve.where("is_query").select(F.col("vid").alias("query"), "vec").join(radii, "query")
    n_queries = queries.count()
    groups = max(1, -(-n_queries // QUERY_GROUP))
    schema = "block long, grp int, query long, reach double, vec array<float>"
    arrow = S.arrow_schema(schema)

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q, reach = _matrix(b.column(1)).astype(np.float64), np.asarray(b.column(2))
            for i, (name, vec) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
                d = np.sqrt(((centre - q[i]) ** 2).sum(axis=1)) - radius
                hit = chunk[d <= reach[i] + 1e-9]
                rows = [(int(c * per_chunk + j), name % groups, name, float(reach[i]), vec) for c in hit for j in range(per_chunk) if c * per_chunk + j <= last]
                for start in range(0, len(rows), 2000):
                    yield S.batch_of(rows[start : start + 2000], arrow)

    asked = queries.select("query", "vec", "reach").mapInArrow(reached, schema)
    data = curve.select("block", "vid", "vec", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"))

    def scan(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        q, x = _matrix(left["vec"]), _matrix(right["vec"])
        if len(q) and len(x):
            names, vids, reach = np.asarray(left["query"]), np.asarray(right["vid"]), np.asarray(left["reach"])
            for i, at, d in _nearest(q, x, k + 1):
                out += [(int(names[i]), int(vids[j]), float(s)) for j, s in zip(at, d, strict=True) if s <= reach[i]]
        return pa.Table.from_batches([S.batch_of(out, out_schema)])

    return asked.groupBy("block", "grp").cogroup(data.groupBy("block", "grp")).applyInArrow(scan, FOUND)


def _named(rows: DataFrame, classes: DataFrame, best: DataFrame, k: int, query_every: int) -> DataFrame:
    """From distinct vectors back to rows: the members of each vector found, without the query's own row."""
    found = best.join(classes.select("vid", "members"), "vid").select("query", "score", F.explode("members").alias("vec_id"))
    order = Window.partitionBy("query").orderBy("score", "vec_id")
    # k + 1 rows serve every query of that vector: one of them may be the query's own
    ranked = found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    asking = rows.where(F.col("vec_id") % query_every == 0).select("vec_id", "vec").distinct()
    asking = asking.join(classes.where("is_query").select("vid", F.col("vec").alias("v")), F.col("vec") == F.col("v")).select(
        F.col("vec_id").alias("query_id"), F.col("vid").alias("query")
    )
    joined = asking.join(ranked, "query").where("vec_id <> query_id")
    final = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return joined.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(S.read_table(spark, sf_dir, "embeddings"))

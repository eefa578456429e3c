"""Helpers of the operators: Arrow maps over whole rows, written intermediate tables, integer hashes."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustolake.session import scratch_dir

#: Rows are whole texts, so few of them make an Arrow batch (bounds a task's memory).
ROWS_PER_BATCH = 500

#: What ``bytes.split()`` splits at, as a Spark pattern of one word.
WORD = r"[^\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so their Python workers can import it."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent.parent
    at = Path(tempfile.mkdtemp()) / f"{root.name}.zip"
    with zipfile.ZipFile(at, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(at))
    _SHIPPED.add(app)


def prepare(spark: SparkSession) -> None:
    """Session settings the operators rely on: UTC and Arrow batches of few (long) rows."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(name: str) -> Column:
    """A column by its whole name, which may hold dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(name: str, taken: Sequence[str]) -> str:
    """``name``, lengthened until no column is called so."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def map_rows(df: DataFrame, columns: dict[str, Column], fn: Callable, schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` over these columns only, which ``fn(batches)`` finds by position; it yields record batches."""
    ship_code(df.sparkSession)
    # plain names: a caller's own may hold dots or backticks, which mapInArrow can't resolve
    return df.select(*[c.alias(f"c{i}") for i, c in enumerate(columns.values())]).mapInArrow(fn, schema)


def arrow_schema(schema: str | T.StructType) -> pa.Schema:
    """Arrow schema of a Spark schema, for batches that Python tasks build."""
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType.fromDDL(schema) if isinstance(schema, str) else schema)


def per_row(fn: Callable[[tuple], tuple], schema: pa.Schema) -> Callable:
    """Batch function applying ``fn`` to each row (a tuple in column order); it returns one output tuple."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [fn(r) for r in zip(*[c.to_pylist() for c in batch.columns], strict=True)]
            yield batch_of(rows, schema)

    return run


def gathered(batches: Iterator[pa.RecordBatch], max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Neighbouring batches joined up to about ``max_bytes``, for work that gains from many rows at once."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= max_bytes:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def batch_of(rows: Sequence[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5 (a null id counts as the text 'null')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % 5


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new folder under the shared one that the session names (``spark.checkpoint.dir``).

    It is deleted by the file system when the driver ends normally; after a
    crash, folders named ``llm-*`` there may be removed by hand.
    """
    path = f"{scratch_dir(spark)}/llm-{tag}-{uuid.uuid4().hex[:12]}"
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(at)
    fs.deleteOnExit(at)
    return path


def staged(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, tag)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, tag: str, by: str) -> DataFrame:
    """Write ``df`` to the shared folder in buckets of column ``by`` and read it back: joins on it don't shuffle it.

    Buckets need a catalog entry while the table is written and looked up; it is dropped at once, the files stay.
    """
    spark = df.sparkSession
    name = f"llm_{tag}_{uuid.uuid4().hex[:12]}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = shared_path(spark, tag)
    df.write.mode("overwrite").option("path", path).option("compression", "zstd").bucketBy(n, by).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return out


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, an action's shuffle files are deleted when it ends, not when the driver next collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def discard(*frames: DataFrame) -> None:
    """Delete the staged folders these frames read, once what was made of them is staged itself."""
    for df in frames:
        jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        for folder in sorted(f for f in folders if f.rsplit("/", 1)[1].startswith("llm-")):
            at = jvm.org.apache.hadoop.fs.Path(folder)
            at.getFileSystem(conf).delete(at, True)

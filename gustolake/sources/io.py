"""Readers and writers for the pipeline's storage layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustolake.sources import versions


# --- readers -------------------------------------------------------------------------
def read_source(spark: SparkSession, name: str, fmt: str = "table", options: dict | None = None) -> DataFrame:
    """Read one source table.

    ``fmt="table"`` reads a catalog table; ``fmt="jdbc"`` reads a relational
    table (pass ``url`` and, for a parallel read, ``partitionColumn``,
    ``lowerBound``, ``upperBound`` and ``numPartitions`` so the scan is split
    across executors instead of one connection, or ``predicates``, one query
    each, for a skewed key: ``splits``); any other format is read from the
    ``path`` option or from ``name`` as a path.
    """
    options = dict(options or {})
    if fmt == "table":
        return spark.table(name)
    if fmt == "jdbc" and "predicates" in options:
        return spark.read.jdbc(**jdbc_arguments(name, options))
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(**jdbc_options(name, options)).load()
    path = options.pop("path", name)
    return spark.read.format(fmt).options(**options).load(path)


def jdbc_options(name: str, options: dict) -> dict:
    """Options of a relational read; without a split column it must be asked for with ``unsplit=True``."""
    options = {"dbtable": name, **options}
    if not options.pop("unsplit", False) and not {"partitionColumn", "lowerBound", "upperBound", "numPartitions"} <= set(options):
        raise ValueError(f"reading {name} unsplit puts the whole table in one task; give partitionColumn, lowerBound, "
                         "upperBound and numPartitions, or unsplit=True for a small table")
    return options


def jdbc_arguments(name: str, options: dict) -> dict:
    """Arguments of a relational read by predicates; what else is in ``options`` goes to the driver as properties."""
    rest = {k: str(v) for k, v in options.items() if k not in ("url", "predicates", "dbtable")}
    if not options["predicates"] or {"partitionColumn", "lowerBound", "upperBound", "numPartitions"} & set(rest):
        raise ValueError("give predicates or a split column with bounds")
    return {"url": options["url"], "table": options.get("dbtable", name), "predicates": list(options["predicates"]), "properties": rest}


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """Read a Parquet dataset; partition directories become typed columns."""
    return spark.read.parquet(path)


# --- writers -------------------------------------------------------------------------
def write_layer(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    rebalance: bool = False,
    dynamic: bool = False,
) -> None:
    """Overwrite a Parquet dataset (snappy), optionally partitioned.

    ``rebalance`` first gathers the rows of a partition value into few tasks,
    so each writes few, large files; adaptive execution splits a value that
    holds much of the data. ``dynamic`` replaces only the partitions present in
    ``df``.
    """
    if rebalance:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    w = df.write.mode("overwrite").option("compression", "snappy")
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_buckets(df: DataFrame, path: str, name: str, buckets: int, by: str) -> None:
    """Overwrite a Parquet dataset (snappy) in buckets of column ``by``, under the catalog entry ``name`` that buckets need."""
    w = df.write.mode("overwrite").option("path", path).option("compression", "snappy")
    w.bucketBy(buckets, by).saveAsTable(name)


def to_contract_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the contract's columns in order, cast to the contract's types."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"frame lacks contract columns: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def publish(
    spark: SparkSession,
    df: DataFrame,
    schema: T.StructType,
    path: str,
    name: str,
    database: str | None = None,
    version: str | None = None,
    keep_versions: int = 2,
) -> DataFrame:
    """Write ``df`` in its declared schema as a new version under ``path`` and register it as an external table.

    The version is committed in one step (``versions``), then the catalog's
    location is moved to its folder; the folder of the version before stays, so
    queries that have begun to read it end well. A run that died between the
    two steps is finished by the next one (``register``). ``keep_versions``
    counts the current one; older ones are deleted.
    """
    out = to_contract_types(df, schema)
    location = path.rstrip("/")
    if versions.current(spark, location) is not None:
        register(spark, location, name, database)
    versions.recover(spark, location)
    versions.write(spark, out, location, label=version)
    register(spark, location, name, database)
    versions.expire(spark, location, keep_versions)
    return spark.table(f"{database}.{name}" if database else name)


def register(spark: SparkSession, path: str, name: str, database: str | None = None) -> None:
    """Point the catalog's table at the newest committed version under ``path``."""
    folder = versions.folder_of(path, versions.current(spark, path).folders[versions.WHOLE])
    qualified = f"{database}.{name}" if database else name
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    if spark.catalog.tableExists(qualified):
        spark.sql(f"ALTER TABLE {qualified} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(qualified)
    else:
        spark.sql(
            f"CREATE TABLE {qualified} USING parquet LOCATION '{folder}' "
            f"OPTIONS (compression 'snappy')"
        )


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The newest committed version under ``path``, without the catalog."""
    return versions.read(spark, path.rstrip("/"))


def delete_folder(spark: SparkSession, path: str) -> None:
    versions.delete(spark, path)


def list_published(spark: SparkSession, database: str) -> DataFrame:
    """Tables registered in ``database`` (name, database); temporary views are not among them."""
    return spark.sql(f"SHOW TABLES IN {database}").where("not isTemporary").select(
        F.col("tableName").alias("table_name"), F.col("namespace").alias("database")
    )

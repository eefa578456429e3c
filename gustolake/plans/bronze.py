"""Bronze: raw source rows plus ingestion-date columns, partitioned by ingest day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustolake.plans import jobs
from gustolake.sources import io, versions

INGEST_PARTITIONS = ("_ingestion_year", "_ingestion_month", "_ingestion_day")


def ingest(df: DataFrame, ingest_date: dt.date) -> DataFrame:
    """Append the four ingestion literals (strings; month and day zero-padded)."""
    y, m, d = f"{ingest_date.year:04d}", f"{ingest_date.month:02d}", f"{ingest_date.day:02d}"
    return df.withColumns(
        {
            "_ingestion_date": F.lit(f"{y}-{m}-{d}"),
            "_ingestion_year": F.lit(y),
            "_ingestion_month": F.lit(m),
            "_ingestion_day": F.lit(d),
        }
    )


def write(df: DataFrame, path: str) -> None:
    """Partitioned Parquet write that replaces only the ingest day being written,
    so earlier days stay readable (a static overwrite would drop them)."""
    io.write_layer(df, path, partition_by=INGEST_PARTITIONS, dynamic=True)


def read(spark: SparkSession, path: str, ingest_date: dt.date | None = None) -> DataFrame:
    """One ingest day of a bronze table, the latest if none is named.

    Only that day's folder is listed and read, however many days there are."""
    day = ingest_date or latest_ingest_date(spark, path)
    known = days_below(spark, path, [day.year, day.month, day.day])
    if not known:
        return read_all(spark, path).where(F.lit(False))
    return spark.read.option("basePath", path).parquet(*[f"{path}/{k}" for k in known])


def read_all(spark: SparkSession, path: str) -> DataFrame:
    """Every ingest day of a bronze table."""
    return io.read_layer(spark, path)


def _values(spark: SparkSession, folder: str, column: str) -> list[tuple[int, str]]:
    """(value, folder name) of one level of partition folders, latest first."""
    names = [n for n, is_folder in versions.listed(spark, folder) if is_folder and n.startswith(f"{column}=")]
    return sorted(((int(n.partition("=")[2]), n) for n in names if n.partition("=")[2].isdecimal()), reverse=True)


def days_below(spark: SparkSession, path: str, values: Sequence[int] = ()) -> list[str]:
    """Partition folders of ingest days whose year, month and day begin with ``values``; a listing, no job."""
    found = [""]
    for level, column in enumerate(INGEST_PARTITIONS):
        found = [
            f"{p}/{name}".lstrip("/") for p in found for value, name in _values(spark, f"{path}/{p}", column)
            if level >= len(values) or value == values[level]
        ]
    return found


def _holds_data(spark: SparkSession, folder: str) -> bool:
    return any(not is_folder and not n.startswith(("_", ".")) for n, is_folder in versions.listed(spark, folder))


def ingest_days(spark: SparkSession, path: str) -> list[dt.date]:
    """All ingest days, latest first, from the folders' names: the listing grows with days, not with rows."""
    days = days_below(spark, path)
    return [dt.date(*[int(v.partition("=")[2]) for v in d.split("/")]) for d in days if _holds_data(spark, f"{path}/{d}")]


def latest_ingest_date(spark: SparkSession, path: str) -> dt.date:
    """The latest ingest day that holds data; lists only the way to it."""
    for year, y in _values(spark, path, INGEST_PARTITIONS[0]):
        for month, m in _values(spark, f"{path}/{y}", INGEST_PARTITIONS[1]):
            for day, d in _values(spark, f"{path}/{y}/{m}", INGEST_PARTITIONS[2]):
                if _holds_data(spark, f"{path}/{y}/{m}/{d}"):
                    return dt.date(year, month, day)
    raise FileNotFoundError(f"no ingest day in {path}")


def run(spark: SparkSession, sources: dict[str, DataFrame], bronze_root: str, ingest_date: dt.date) -> dict[str, str]:
    """Ingest every source table (concurrently); returns table -> bronze path.
    Fails on the first error."""
    paths = {name: f"{bronze_root.rstrip('/')}/{name}" for name in sources}
    jobs.run_all({
        name: (lambda name=name, df=df: write(ingest(df, ingest_date), paths[name]))
        for name, df in sources.items()
    })
    return paths

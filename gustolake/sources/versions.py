"""Versions of a Parquet dataset: immutable folders, and one small file per version that commits it.

    <path>/_data/_version=v<stamp>/...  files of one write, never changed afterwards
    <path>/_commits/v<stamp>.json       {"folders": {partition: stamp of the write that holds it}, "info": {...}}

The newest commit file is the dataset. It appears by one rename within
``_commits`` after all its files are in place, so a reader sees the version
before or the new one and never a mixture or nothing; on an object store the
rename copies this one small object, which also appears whole. A partitioned
dataset may replace some partitions only: the new commit names the new write
for these and the earlier writes for the others; one scan reads them all. A run
that dies before its commit leaves a folder that no commit names; ``recover``
deletes it. Reading ``<path>`` itself as Parquet finds nothing, as Spark passes
over names with an underscore, so versions can't be mixed that way either.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMITS, DATA, VERSION = "_commits", "_data", "_version"
#: The partition name of an unpartitioned dataset.
WHOLE = ""


@dataclass(frozen=True)
class Commit:
    name: str
    folders: dict[str, str]
    info: dict = field(default_factory=dict)


def _hadoop(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def listed(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(name, is a folder) of what lies in ``path``, sorted; nothing if there is no such folder. No job runs."""
    fs, at = _hadoop(spark, path)
    if not fs.exists(at(path)):
        return []
    return sorted((s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(at(path)))


def folder_of(path: str, stamp: str) -> str:
    return f"{path}/{DATA}/{VERSION}={stamp}"


def rename(spark: SparkSession, source: str, target: str) -> bool:
    fs, at = _hadoop(spark, target)
    return not fs.exists(at(target)) and fs.rename(at(source), at(target))


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _hadoop(spark, path)
    fs.delete(at(path), True)


def _names(spark: SparkSession, path: str) -> list[str]:
    found = listed(spark, f"{path}/{COMMITS}")
    return [n.removesuffix(".json") for n, folder in found if n.startswith("v") and n.endswith(".json") and not folder]


def load(spark: SparkSession, path: str, name: str) -> Commit:
    fs, at = _hadoop(spark, path)
    stream = fs.open(at(f"{path}/{COMMITS}/{name}.json"))
    try:
        text = spark.sparkContext._jvm.java.util.Scanner(stream, "UTF-8").useDelimiter("\\A").next()
    finally:
        stream.close()
    body = json.loads(text)
    return Commit(name, body["folders"], body["info"])


def current(spark: SparkSession, path: str) -> Commit | None:
    """The newest commit, or None."""
    names = _names(spark, path)
    return load(spark, path, names[-1]) if names else None


def new_stamp(spark: SparkSession, path: str, label: str | None = None) -> str:
    """A name later than every commit's, also if another machine's clock was ahead."""
    last = max((int(n[1:21]) for n in _names(spark, path)), default=0)
    return f"v{max(time.time_ns(), last + 1):020d}-{label or uuid.uuid4().hex[:12]}"


def commit(spark: SparkSession, path: str, stamp: str, folders: dict[str, str], info: dict | None = None) -> Commit:
    """Make ``folders`` the dataset, in one step."""
    fs, at = _hadoop(spark, path)
    fs.mkdirs(at(f"{path}/{COMMITS}"))
    draft = f"{path}/{COMMITS}/.{stamp}.tmp"
    out = fs.create(at(draft), True)
    try:
        out.write(json.dumps({"folders": folders, "info": info or {}}).encode())
    finally:
        out.close()
    if not rename(spark, draft, f"{path}/{COMMITS}/{stamp}.json"):
        delete(spark, draft)
        raise OSError(f"could not commit {stamp} of {path}")
    return Commit(stamp, folders, info or {})


def partitions_in(spark: SparkSession, folder: str, depth: int) -> list[str]:
    """The partition folders ``a=1/b=2`` below ``folder``, from a listing."""
    found = [WHOLE]
    for _ in range(depth):
        found = [f"{p}/{n}".lstrip("/") for p in found for n, is_folder in listed(spark, f"{folder}/{p}") if is_folder and "=" in n]
    return found


def read(spark: SparkSession, path: str, at: Commit | None = None, only: Iterable[str] | None = None) -> DataFrame:
    """The dataset at a commit (default: the newest), or only some of its partitions."""
    at = at or current(spark, path)
    if at is None:
        raise FileNotFoundError(f"nothing is committed in {path}")
    wanted = set(at.folders) if only is None else set(only) & set(at.folders)
    if not wanted:
        raise FileNotFoundError(f"no such partition in {path}")
    if wanted == {WHOLE}:
        return spark.read.parquet(folder_of(path, at.folders[WHOLE]))
    places = [f"{folder_of(path, at.folders[p])}/{p}" for p in sorted(wanted)]
    return spark.read.option("basePath", f"{path}/{DATA}").parquet(*places).drop(VERSION)


def write(
    spark: SparkSession, df: DataFrame, path: str, partition_by: Sequence[str] = (), replaces: Iterable[str] | None = None,
    base: Commit | None = None, info: dict | None = None, label: str | None = None, rebalance: bool = False,
) -> Commit:
    """Write ``df`` as a new version and commit it.

    ``replaces`` None replaces the whole dataset. Else the partitions named
    there (some may be without rows now) are replaced in ``base`` (default: the
    newest commit) and all others stay as they are.
    """
    from gustolake.sources import io

    stamp = new_stamp(spark, path, label)
    io.write_layer(df, folder_of(path, stamp), partition_by=partition_by, rebalance=rebalance)
    written = partitions_in(spark, folder_of(path, stamp), len(partition_by))
    kept: dict[str, str] = {}
    if replaces is not None:
        base = base or current(spark, path)
        gone = set(replaces)
        if not set(written) <= gone:
            raise ValueError(f"rows outside the replaced partitions: {sorted(set(written) - gone)[:3]}")
        kept = {p: f for p, f in (base.folders if base else {}).items() if p not in gone}
    return commit(spark, path, stamp, kept | dict.fromkeys(written, stamp), info)


def recover(spark: SparkSession, path: str) -> None:
    """Delete what died runs left: folders older than the newest commit that no commit names, and drafts of commits."""
    names = _names(spark, path)
    if not names:
        return
    used = {f for n in names for f in load(spark, path, n).folders.values()}
    for name, _ in listed(spark, f"{path}/{DATA}"):
        stamp = name.partition("=")[2]
        if stamp and stamp < names[-1] and stamp not in used:
            delete(spark, folder_of(path, stamp))
    for name, _ in listed(spark, f"{path}/{COMMITS}"):
        if name.startswith(".") and name.endswith(".tmp") and name[1:] < names[-1]:
            delete(spark, f"{path}/{COMMITS}/{name}")


def expire(spark: SparkSession, path: str, keep: int) -> None:
    """Keep the newest ``keep`` commits and the folders they name; commits go before their files."""
    names = _names(spark, path)
    for name in names[: max(0, len(names) - max(1, keep))]:
        delete(spark, f"{path}/{COMMITS}/{name}.json")
    recover(spark, path)
    used = {(f, p) for n in _names(spark, path) for p, f in load(spark, path, n).folders.items()}
    for folder in sorted({f for f, _ in used}):
        depth = max(p.count("/") + 1 if p else 0 for f, p in used if f == folder)
        for p in partitions_in(spark, folder_of(path, folder), depth) if depth else []:
            if (folder, p) not in used:
                delete(spark, f"{folder_of(path, folder)}/{p}")


# --- datasets that take whole days ------------------------------------------------------
MONTH = "day_yyyymm"


def month_of(day: dt.date) -> str:
    return f"{MONTH}={day.year * 100 + day.month}"


def days_of(at: Commit | None) -> set[str]:
    """The days (ISO) that a dataset of ``take_days`` has taken in."""
    return set(at.info["days"]) if at else set()


def take_days(
    spark: SparkSession, df: DataFrame, path: str, day: str, days: Sequence[dt.date], base: Commit | None, info: dict | None = None
) -> Commit:
    """Put the rows of whole ``days`` in place of what ``base`` has of them; only their months are written."""
    months = sorted({month_of(d) for d in days})
    df = df.withColumn(MONTH, F.year(day) * 100 + F.month(day))
    if base and set(months) & set(base.folders):
        again = [d for d in days if d.isoformat() in days_of(base)]
        kept = read(spark, path, base, only=months)
        df = (kept.where(~F.col(day).isin(again)) if again else kept).unionByName(df)
    known = sorted(days_of(base) | {d.isoformat() for d in days})
    return write(spark, df, path, [MONTH], replaces=months, base=base, info=(info or {}) | {"days": known}, rebalance=True)

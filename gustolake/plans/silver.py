"""Silver: typed, cleaned, key-filtered and deduplicated tables."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gustolake.functions.clean import blank_to_null, negative_flag, strip_urls
from gustolake.operators import base, keyset, quality
from gustolake.operators.clean import dedup, normalize_columns, require_keys, to_contract, void_to_string
from gustolake.plans import bronze, jobs
from gustolake.session import scratch_dir
from gustolake.sources import contracts as C
from gustolake.sources import io, versions

# The text columns in which blank means missing.
ITEM_BLANKABLE = ("item_category", "item_name", "app_name", "currency", "printed_card_number")
OPTION_BLANKABLE = ("option_group_name", "option_name")


def typed_order_items(raw: DataFrame) -> DataFrame:
    """Names lower-cased, cast to the source contract (malformed -> null),
    URLs stripped from the category, blanks -> null. Ingestion columns and any
    other column outside the contract are dropped."""
    df = to_contract(void_to_string(normalize_columns(raw)), C.ORDER_ITEMS_SOURCE)
    fixes = {"item_category": strip_urls("item_category")}
    return df.withColumns(fixes).withColumns({c: blank_to_null(c) for c in ITEM_BLANKABLE})


def _observed(df: DataFrame, required: tuple[str, ...], observation: Observation | None) -> DataFrame:
    return df if observation is None else quality.observe(df, observation, required)


def _derived_item_columns(df: DataFrame) -> DataFrame:
    ts = F.col("creation_time_utc")
    return df.withColumns(
        {
            "order_date": F.to_date(ts),
            "order_year": F.year(ts),
            "order_month": F.month(ts),
            "order_hour": F.hour(ts),
            "line_revenue": F.col("item_price") * F.col("item_quantity"),
        }
    )


# In counted frames: the raw rows a row stands for, and whether it lacks a required key and so is no silver row.
RAW_ROWS, DROPPED = "_raw_rows", "_dropped"


def _deduplicated(df: DataFrame, key: tuple[str, ...], required: tuple[str, ...], counted: bool) -> DataFrame:
    """Rows with all required keys, one per key. ``counted`` keeps those that lack one too, apart, and counts raw rows
    (``RAW_ROWS``, ``DROPPED``): counts in the data stay right when tasks run again, unlike observed ones."""
    if not counted:
        return dedup(require_keys(df, required), key)
    return dedup(df.withColumn(DROPPED, quality.lacks_key(required)), [*key, DROPPED], count=RAW_ROWS)


def order_items(raw: DataFrame, observation: Observation | None = None, counted: bool = False) -> DataFrame:
    df = _observed(typed_order_items(raw), C.ORDER_ITEMS_REQUIRED, observation)
    # derived after the dedup shuffle, so they are not shuffled
    return _derived_item_columns(_deduplicated(df, C.ORDER_ITEMS_KEY, C.ORDER_ITEMS_REQUIRED, counted))


def typed_options(raw: DataFrame) -> DataFrame:
    df = to_contract(void_to_string(normalize_columns(raw)), C.ORDER_ITEM_OPTIONS_SOURCE)
    return df.withColumns({c: blank_to_null(c) for c in OPTION_BLANKABLE})


def options(raw: DataFrame, observation: Observation | None = None, counted: bool = False) -> DataFrame:
    df = _deduplicated(_observed(typed_options(raw), C.OPTIONS_REQUIRED, observation), C.OPTIONS_KEY, C.OPTIONS_REQUIRED, counted)
    return df.withColumns(
        {
            "is_discount": negative_flag("option_price"),
            "option_revenue": F.col("option_price") * F.col("option_quantity"),
        }
    )


def date_dim(raw: DataFrame, observation: Observation | None = None) -> DataFrame:
    df = to_contract(void_to_string(normalize_columns(raw)), C.DATE_DIM_SOURCE)
    return dedup(_observed(df, (), observation), C.DATE_DIM_KEY)


def build(
    sources: dict[str, DataFrame], observations: dict[str, Observation] | None = None, counted: bool = False
) -> dict[str, DataFrame]:
    """Lazy silver frames from raw (source or bronze) frames; ``observations`` per table count
    the raw rows and null keys when the frames are written. ``counted`` items and options carry these counts
    in columns and hold dropped rows too; ``kept`` makes silver frames of them."""
    seen = observations or {}
    return {
        "order_items": order_items(sources["order_items"], seen.get("order_items"), counted),
        "order_item_options": options(sources["order_item_options"], seen.get("order_item_options"), counted),
        "date_dim": date_dim(sources["date_dim"], seen.get("date_dim")),
    }


def kept(df: DataFrame) -> DataFrame:
    """The silver rows of a counted frame."""
    return df.where(~F.col(DROPPED)).drop(RAW_ROWS, DROPPED)


def write(silver: dict[str, DataFrame], silver_root: str) -> dict[str, str]:
    """Items partitioned by year/month and rebalanced so each task writes a few
    large files; the other two unpartitioned."""
    root = silver_root.rstrip("/")
    paths = {name: f"{root}/{name}" for name in silver}
    jobs.run_all({
        "order_items": lambda: io.write_layer(
            silver["order_items"], paths["order_items"],
            partition_by=("order_year", "order_month"), rebalance=True,
        ),
        "order_item_options": lambda: io.write_layer(silver["order_item_options"], paths["order_item_options"]),
        "date_dim": lambda: io.write_layer(silver["date_dim"], paths["date_dim"]),
    })
    return paths


def read(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """Read silver back with the column order of the contracts."""
    contracts = {
        "order_items": C.SILVER_ORDER_ITEMS,
        "order_item_options": C.SILVER_ORDER_ITEM_OPTIONS,
        "date_dim": C.SILVER_DATE_DIM,
    }
    return {
        name: void_to_string(normalize_columns(io.read_layer(spark, path))).select(
            *[f.name for f in contracts[name].fields]
        )
        for name, path in paths.items()
    }


# --- bucketed by line -------------------------------------------------------------------
def write_bucketed(spark: SparkSession, tables: dict[str, DataFrame], silver_root: str, database: str, buckets: int) -> dict[str, str]:
    """Items and options as tables bucketed and sorted by the line key (order_id, lineitem_id); returns table -> name.

    The roll-up of options and the join of lines then need no exchange after the
    files are read. The buckets are by line and not by order: lines are unique
    after the dedup, so an order with a third of all lines is spread over all
    buckets and needs no layout of its own, and what goes on to the order's
    aggregate is reduced per task first.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = {}
    for table in ("order_items", "order_item_options"):
        names[table] = f"{database}.{table}"
        # one file per bucket, which keeps its order
        rows = tables[table].repartition(buckets, *base.LINE_KEY)
        rows.write.mode("overwrite").option("path", f"{silver_root.rstrip('/')}/{table}").option("compression", "snappy").bucketBy(
            buckets, *base.LINE_KEY
        ).sortBy(*base.LINE_KEY).saveAsTable(names[table])
    return names


def read_bucketed(spark: SparkSession, names: dict[str, str]) -> dict[str, DataFrame]:
    return {table: spark.table(name) for table, name in names.items()}


# --- incremental ------------------------------------------------------------------------
@dataclass(frozen=True)
class Upserted:
    """The committed version and the partitions (months) written anew."""

    commit: versions.Commit
    partitions: tuple[str, ...]


def _month(year: object, month: object) -> str:
    none = "__HIVE_DEFAULT_PARTITION__"
    return f"order_year={none if year is None else year}/order_month={none if month is None else month}"


MONTHS = ("order_year", "order_month")


def _by_month(items: DataFrame) -> DataFrame:
    """Silver items gathered by month for a partitioned write; what else is derived is left out of that shuffle."""
    bare = items.select(*[f.name for f in C.ORDER_ITEMS_SOURCE.fields], *MONTHS)
    return _derived_item_columns(bare.hint("rebalance", *[F.col(c) for c in MONTHS]))


def upsert_order_items(
    spark: SparkSession, raw: DataFrame, path: str, keep_versions: int = 2, max_bits: int = keyset.MAX_BITS
) -> Upserted:
    """Bring an ingest day's raw lines into the committed silver items under ``path``.

    Of all versions of a line the one that ``dedup`` prefers stays, so days one
    after the other give what one run over all of them would. The stored lines
    and the day are tested map-side for each other's keys; only what passes
    meets in a shuffle. Months in which a line comes, goes or changes are written
    anew and committed with the others' folders as they are, in one step; a run
    that dies before leaves the version before.
    """
    path, source = path.rstrip("/"), [f.name for f in C.ORDER_ITEMS_SOURCE.fields]
    key = list(C.ORDER_ITEMS_KEY)
    versions.recover(spark, path)
    at = versions.current(spark, path)
    if at is None or not at.folders:
        done = versions.write(spark, _by_month(order_items(raw)), path, MONTHS)
        return Upserted(done, tuple(sorted(done.folders)))
    stage = scratch_dir(spark, f"upsert-{uuid.uuid4().hex[:12]}")

    def staged(df: DataFrame, name: str) -> DataFrame:
        io.write_layer(df, f"{stage}/{name}")
        return spark.read.schema(df.schema).parquet(f"{stage}/{name}")

    try:
        day = staged(order_items(raw).select(*source, *MONTHS), "day")
        # the few lines that pass without their key being among the day's win below and so stay as they are
        stored = versions.read(spark, path, at).select(*source, *MONTHS)
        known = staged(keyset.maybe_in(stored, day.select(*key), key, day.count(), max_bits), "known")
        fresh, rival = keyset.split(day, known.select(*key), key, known.count(), max_bits)
        both = known.withColumn("_new", F.lit(False)).unionByName(rival.withColumn("_new", F.lit(True)))
        # of equal versions the stored one comes first, so a line of the day that is picked is a change
        picked = staged(dedup(both, key).where("_new").drop("_new"), "picked")
        gone = staged(known.select(*key, *MONTHS).join(picked.select(*key), key, "left_semi"), "gone")
        # calendar months: a bounded list
        touched = fresh.select(*MONTHS).union(picked.select(*MONTHS)).union(gone.select(*MONTHS)).distinct()
        names = sorted({_month(*r) for r in touched.collect()})
        if not names:
            return Upserted(at, ())
        new = fresh.unionByName(picked)
        if set(names) & set(at.folders):
            stays = versions.read(spark, path, at, only=names).select(*source, *MONTHS)
            clear, doubtful = keyset.split(stays, gone.select(*key), key, gone.count(), max_bits)
            # an outer join, as an anti join would be pushed below the key filter and move all lines of these months
            left = doubtful.join(gone.select(*key, F.lit(True).alias("_gone")), key, "left").where("_gone is null").drop("_gone")
            new = clear.unionByName(left).unionByName(new)
        done = versions.write(spark, _by_month(new), path, MONTHS, replaces=names, base=at)
        versions.expire(spark, path, keep_versions)
        return Upserted(done, tuple(names))
    finally:
        io.delete_folder(spark, stage)


def read_order_items(spark: SparkSession, path: str) -> DataFrame:
    """The committed silver items under ``path``."""
    return versions.read(spark, path.rstrip("/")).select(*[f.name for f in C.SILVER_ORDER_ITEMS.fields])


def upsert_latest_day(spark: SparkSession, bronze_path: str, path: str, ingest_date: dt.date | None = None) -> Upserted:
    """``upsert_order_items`` of one bronze ingest day, the latest if none is named."""
    return upsert_order_items(spark, bronze.read(spark, bronze_path, ingest_date), path)

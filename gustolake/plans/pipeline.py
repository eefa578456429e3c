"""The daily run: sources -> bronze -> silver -> gold, plus the quality report."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from gustolake.operators import quality
from gustolake.plans import bronze, gold, silver
from gustolake.sources import contracts as C
from gustolake.sources import io


@dataclass
class RunResult:
    bronze_paths: dict[str, str]
    silver_paths: dict[str, str]
    gold: dict[str, DataFrame]
    quality: DataFrame


def quality_report(raw: dict[str, DataFrame], silver_tables: dict[str, DataFrame],
                   gold_tables: dict[str, DataFrame] | None = None,
                   seen: dict[str, dict[str, int]] | None = None,
                   counted: dict[str, DataFrame] | None = None) -> DataFrame:
    """Row counts per table and stage; ``seen`` are the counts observed while silver was written, ``counted`` are frames
    of ``silver.build`` that carry them, which are then read in place of ``raw``."""
    # null keys are counted on the typed columns, where the key filter applies
    typed = {
        "order_items": (silver.typed_order_items(raw["order_items"]), C.ORDER_ITEMS_REQUIRED),
        "order_item_options": (silver.typed_options(raw["order_item_options"]), C.OPTIONS_REQUIRED),
        "date_dim": (raw["date_dim"], ()),
    }
    parts = []
    for name, (df, required) in typed.items():
        if name in (counted or {}):
            parts.append(quality.raw_counts(counted[name], name, required, silver.RAW_ROWS))
        elif seen:
            parts.append(quality.observed_counts(raw[name], df, name, required, seen[name]))
        else:
            parts.append(quality.raw_counts(df, name, required))
        parts.append(quality.stage_counts(silver_tables[name], name, "after_dedup"))
    for name, df in (gold_tables or {}).items():
        parts.append(quality.stage_counts(df, name, "gold"))
    return quality.report(parts)


# The three source tables.
SOURCE_TABLES = ("order_items", "order_item_options", "date_dim")


def read_sources(spark: SparkSession, names: dict[str, str] | None = None, fmt: str = "table",
                 options: dict[str, dict] | None = None) -> dict[str, DataFrame]:
    """The three source tables by ``io.read_source``; ``names`` and ``options`` are per table."""
    return {t: io.read_source(spark, (names or {}).get(t, t), fmt, (options or {}).get(t)) for t in SOURCE_TABLES}


def run(
    spark: SparkSession,
    sources: dict[str, DataFrame] | None,
    root: str,
    as_of: dt.date,
    ingest_date: dt.date | None = None,
    database: str | None = gold.GOLD_DATABASE,
    approx: bool = False,
    discount_mode: str = "twice",
    stage_root: str | None = None,
) -> RunResult:
    """Run all three layers in order under ``root`` (bronze/, silver/, gold/).

    ``sources`` None reads the three source tables from the catalog.

    Silver reads exactly the ingest day just written (partition-pruned), so
    earlier bronze days stay as history without changing today's numbers.
    """
    ingest_date = ingest_date or as_of
    root = root.rstrip("/")
    bronze_paths = bronze.run(spark, read_sources(spark) if sources is None else sources, f"{root}/bronze", ingest_date)
    raw = {name: bronze.read(spark, path, ingest_date) for name, path in bronze_paths.items()}
    observations = {name: Observation() for name in raw}
    silver_paths = silver.write(silver.build(raw, observations), f"{root}/silver")
    seen = {name: o.get for name, o in observations.items()}
    silver_tables = silver.read(spark, silver_paths)
    gold_tables = gold.run(spark, silver_tables, as_of, f"{root}/gold", database=database, approx=approx,
                           discount_mode=discount_mode, stage_root=stage_root)
    return RunResult(bronze_paths, silver_paths, gold_tables, quality_report(raw, silver_tables, gold_tables, seen))

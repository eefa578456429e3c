"""Data-quality report: row counts per table and stage, as one DataFrame.

Each table is counted with one aggregate (raw rows and null-key rows in the
same pass); the per-table rows are unioned, so the whole report is one job. The
daily run observes the raw counts while silver is written instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gustolake.operators.clean import normalize_columns

REPORT_SCHEMA = "table string, stage string, rows bigint"


def _rows(table: str, stage: str, n) -> F.Column:
    return F.struct(F.lit(table).alias("table"), F.lit(stage).alias("stage"), n.cast("bigint").alias("rows"))


def stage_counts(df: DataFrame, table: str, stage: str) -> DataFrame:
    return df.agg(F.array(_rows(table, stage, F.count(F.lit(1)))).alias("r")).select(F.inline("r"))


def lacks_key(required: Sequence[str]) -> Column:
    """Whether any required key is null."""
    out = F.lit(False)
    for k in required:
        out = out | F.col(k).isNull()
    return out


def _null_keys(required: Sequence[str]) -> Column:
    return F.count_if(lacks_key(required))


def raw_counts(raw: DataFrame, table: str, required: Sequence[str], counted: str | None = None) -> DataFrame:
    """Raw rows and rows dropped for a null key, in one pass; ``counted`` names the column that says how many raw rows a
    row stands for (default: itself)."""
    def total(n: Column) -> Column:
        return F.coalesce(F.sum(n), F.lit(0))

    rows = [_rows(table, "raw", total(F.col(counted)) if counted else F.count(F.lit(1)))]
    if required:
        dropped = total(F.when(lacks_key(required), F.col(counted))) if counted else _null_keys(required)
        rows.append(_rows(table, "dropped_null_keys", dropped))
    return normalize_columns(raw).agg(F.array(*rows).alias("r")).select(F.inline("r"))


def observe(df: DataFrame, observation: Observation, required: Sequence[str]) -> DataFrame:
    """``df``, counting its rows and null keys into ``observation`` when it is next written."""
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), _null_keys(required).alias("dropped_null_keys"))


def observed_counts(raw: DataFrame, typed: DataFrame, table: str, required: Sequence[str], seen: dict[str, int]) -> DataFrame:
    """``raw_counts`` of ``typed`` as ``seen`` by the observation of its write.

    A task that runs again after a lost executor is observed twice, so ``seen``
    is taken only if it has as many rows as ``raw`` (for files, a count that
    reads no column); else ``typed`` is counted.
    """
    if seen["rows"] != raw.count():
        return raw_counts(typed, table, required)
    rows = [_rows(table, "raw", F.lit(seen["rows"]))]
    if required:
        rows.append(_rows(table, "dropped_null_keys", F.lit(seen["dropped_null_keys"])))
    return raw.sparkSession.range(1).select(F.inline(F.array(*rows)))


def report(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

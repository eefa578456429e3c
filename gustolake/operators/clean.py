"""DataFrame-level cleaning operators: names, types, key filter, dedup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name; two names that differ only by case are an error."""
    lowered = [c.lower() for c in df.columns]
    dupes = sorted({c for c in lowered if lowered.count(c) > 1})
    if dupes:
        raise ValueError(f"columns collide after lower-casing: {dupes}")
    return df.toDF(*lowered)


def void_to_string(df: DataFrame) -> DataFrame:
    """Cast every NullType (void) column to string in a single projection."""
    if not any(isinstance(f.dataType, T.NullType) for f in df.schema.fields):
        return df
    return df.select(
        *[
            F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.NullType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def lenient_cast(c: Column, source: T.DataType, target: T.DataType) -> Column:
    """``try_cast``, but text with a fraction becomes an integer by dropping the fraction ("2.7" -> 2).

    Malformed text and values out of range become null."""
    if isinstance(source, T.StringType) and isinstance(target, T.IntegralType):
        number = c.try_cast(T.DecimalType(38, 18))
        whole = F.when(number < 0, F.ceil(number)).otherwise(F.floor(number))
        return F.coalesce(c.try_cast(target), F.when(~F.lower(c).contains("e"), whole.try_cast(target)))
    return c.try_cast(target)


def to_contract(df: DataFrame, schema: T.StructType, lenient: bool = True) -> DataFrame:
    """Project ``df`` onto ``schema``: declared columns in declared order and type.

    ``lenient`` casts malformed values to null instead of failing the job under
    ANSI mode (``lenient_cast``). Columns outside the contract are dropped.
    """
    present = set(df.columns)
    missing = [f.name for f in schema.fields if f.name not in present]
    if missing:
        raise ValueError(f"input lacks contract columns: {missing}")
    cols = []
    for f in schema.fields:
        src = df.schema[f.name].dataType
        c = F.col(f.name)
        if src != f.dataType:
            c = lenient_cast(c, src, f.dataType) if lenient else c.cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows where any key column is null."""
    cond = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    return df.where(cond)


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None, count: str | None = None) -> DataFrame:
    """One row per key (null key parts compare equal), chosen deterministically; ``count`` names a further column with
    the key's number of rows.

    The survivor is the row whose ``order_by`` columns (default: all non-key
    columns in column order) are smallest, ascending with nulls first. Written
    as ``min(struct(...))`` per key: an aggregate with a map-side partial step,
    so a key holding a large share of the rows is collapsed before the shuffle
    instead of landing whole in one task (a row_number window would).
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    order = list(order_by) if order_by is not None else others
    rest = [c for c in others if c not in order]
    counts = [F.count(F.lit(1)).alias(count)] if count else []
    if not others:
        return df.groupBy(*keys).agg(*counts) if count else df.select(*keys).distinct()
    picked = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_row"), *counts)
    return picked.select(*[F.col(k) if k in keys else F.col(f"_row.{k}").alias(k) for k in df.columns], *([count] if count else []))

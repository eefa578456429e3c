"""Balanced splits of a relational read: predicates that each select about as many rows, however the key is spread.

Equal widths between a lower and an upper bound leave most rows to few readers
where the key is skewed. Here the borders are exact quantiles of the key, taken
from rows that are at hand already (an earlier ingest day, or the key column
alone), so each predicate selects one n-th of them.
"""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustolake.operators import ranking


def borders(keys: DataFrame, column: str, n: int, stage: ranking.Stage = ranking.checkpointed) -> list:
    """At most ``n`` - 1 values of ``column``, in order, that cut its rows into ``n`` about equal parts.

    A value that fills several parts is one border, so there may be fewer; without rows there is none.
    """
    if n < 1:
        raise ValueError("at least one split is needed")
    if n == 1:
        return []
    names = [f"b{i}" for i in range(1, n)]
    found = ranking.exact_quantiles_multi(keys, [(column, [i / n for i in range(1, n)], names)], stage=stage).first()
    return sorted({b for b in found if b is not None})


def literal(value: object) -> str:
    """A border as SQL."""
    if isinstance(value, bool) or not isinstance(value, (int, float, decimal.Decimal, str, dt.date)):
        raise TypeError(f"no split by {type(value).__name__}")
    if isinstance(value, (int, float, decimal.Decimal)):
        return str(value)
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    return "'" + value.replace("'", "''") + "'"


def predicates(column: str, at: Sequence) -> list[str]:
    """One condition per part, that together select every row once; the first has the rows without a key."""
    if not at:
        return ["1 = 1"]
    low, high = at[0], at[-1]
    between = [f"{column} > {literal(a)} AND {column} <= {literal(b)}" for a, b in zip(at, at[1:])]
    return [f"{column} <= {literal(low)} OR {column} IS NULL", *between, f"{column} > {literal(high)}"]


def part_of(column: str, at: Sequence) -> Column:
    """The number (from 0) of the predicate that selects a row."""
    out = F.lit(0)
    for b in at:
        out = out + F.when(F.col(column) > F.lit(b), 1).otherwise(0)
    return out

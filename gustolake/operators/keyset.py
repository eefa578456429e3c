"""Map-side filter by a set of keys: a bitmap of key hashes, small enough to broadcast, in front of a join.

A large table that is joined to a day's keys would be shuffled whole. The
keys' hashes are set in a bitmap instead, which every task of the large table
tests before its rows move. It lets some other rows pass (the join that follows
drops them) and never loses one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of one row of the bitmap, as ``bitmap_construct_agg`` makes them.
ROW_BITS = 1 << 15
#: At most 32 MB are broadcast. Up to 16 million keys one bit in sixteen is set at most; with more keys more rows pass.
MAX_BITS = 1 << 28


def _place(columns: Sequence[str], bits: int) -> Column:
    return F.xxhash64(*columns).bitwiseAND(bits - 1)


def bitmap(keys: DataFrame, columns: Sequence[str], bits: int) -> DataFrame:
    """(_row, _bits): the hash places of ``keys`` as rows of ``ROW_BITS`` bits; a power of two ``bits`` bounds its size."""
    place = _place(columns, bits)
    return keys.select(F.shiftright(place, 15).alias("_row"), place.bitwiseAND(ROW_BITS - 1).alias("_bit")).groupBy("_row").agg(
        F.bitmap_construct_agg("_bit").alias("_bits")
    )


def bits_for(n_keys: int, max_bits: int = MAX_BITS) -> int:
    return min(max_bits, max(ROW_BITS, 1 << (16 * n_keys - 1).bit_length()))


def _probe(df: DataFrame, keys: DataFrame, columns: Sequence[str], n_keys: int, max_bits: int, how: str) -> tuple[DataFrame, Column]:
    """``df`` with the bitmap's row for its key, and whether the key's bit is set there (null without a row)."""
    bits = bits_for(n_keys, max_bits)
    place = _place(columns, bits)
    # at most max_bits / 8 bytes whatever the input
    probe = F.broadcast(bitmap(keys, columns, bits))
    marked = df.withColumn("_place", place).withColumn("_row", F.shiftright("_place", 15)).join(probe, "_row", how)
    in_row = F.col("_place").bitwiseAND(ROW_BITS - 1).cast("int")
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(in_row, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return marked, F.call_function("shiftright", byte, in_row.bitwiseAND(7)).bitwiseAND(1) == 1


def maybe_in(df: DataFrame, keys: DataFrame, columns: Sequence[str], n_keys: int, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``df`` whose key may be among ``keys`` (``n_keys`` rows): all that are, and few others.

    A semi or anti join put on top of it at once is pushed below the filter by
    the optimizer and then moves all of ``df``; write the rows that pass first.
    """
    marked, hit = _probe(df, keys, columns, n_keys, max_bits, "inner")
    return marked.where(hit).select(*[F.col(f"`{c}`") for c in df.columns])


def split(df: DataFrame, keys: DataFrame, columns: Sequence[str], n_keys: int, max_bits: int = MAX_BITS) -> tuple[DataFrame, DataFrame]:
    """``df`` in two: rows whose key is not among ``keys`` for certain, and those of ``maybe_in``; no row moves."""
    marked, hit = _probe(df, keys, columns, n_keys, max_bits, "left")
    clear = marked.where(~F.coalesce(hit, F.lit(False))).select(*[F.col(f"`{c}`") for c in df.columns])
    return clear, maybe_in(df, keys, columns, n_keys, max_bits)

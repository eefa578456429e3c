"""Packing by concatenation and cutting: two-pass prefix sums give global token offsets, then fixed windows.

Pass one encodes every document once and writes its ids with the partition's
number and the document's start inside that partition. The partitions' token
totals (one row per partition) are summed in order to a global offset each.
Pass two adds the offset, cuts every document at the window boundaries and
returns one record per piece; a document that crosses boundaries has a piece on
each side. All windows but the last are full, so no padding is wasted.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gustolake.llm import _shared as S
from gustolake.llm.bpe import encoder

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
ENCODED = "part int, doc_id long, at long, n_tokens long, ids binary"


def encoded(df: DataFrame, id_col: str, text_col: str, vocabulary: str, end_id: int) -> DataFrame:
    """Pass one: (part, doc_id, at, n_tokens, ids as little-endian uint32) with ``end_id`` closing each document."""
    schema = S.arrow_schema(ENCODED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, at = encoder(vocabulary, by_rank=True), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        for b in S.gathered(batches):
            rows = []
            for doc, ids in zip(b.column(0).to_pylist(), enc.encode_batch(b.column(1).to_pylist()), strict=True):
                ids += end
                rows.append((part, doc, at, len(ids) // 4, ids))
                at += len(ids) // 4
            yield S.batch_of(rows, schema)

    return S.map_rows(df, {"doc_id": F.col(id_col).cast("long"), "text": F.col(text_col)}, run, ENCODED)


def pack(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, vocabulary: str, length: int = 1024, end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents in sequences of ``length`` tokens (the last may be shorter).

    Columns: doc_id, start (ids of the document before the piece), length,
    ids_crc32 (of the piece's ids as little-endian uint32), doc_tokens,
    sequence_id, offset (of the piece in its sequence), and ``ids`` (binary) if
    ``with_ids``. Null and empty texts are one ``end_id``. A null doc_id stays
    null; repeated rows are packed as often as given; no rows, no pieces.
    """
    ids = S.staged(encoded(df, id_col, text_col, vocabulary, end_id), "encoded")
    totals = ids.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    # one row per input partition, so one task may order them
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("part"), F.coalesce(F.sum("total").over(before), F.lit(0)).cast("long").alias("base"))
    # 16 bytes per input partition: 100 TB in partitions of 128 MB make 13 MB
    placed = ids.join(F.broadcast(offsets), "part")
    out = PIECES + (", ids binary" if with_ids else "")
    schema = S.arrow_schema(out)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, at, data in zip(*[c.to_pylist() for c in b.columns], strict=True):
                view, n, start = memoryview(data), len(data) // 4, 0
                while start < n:
                    seq, off = divmod(at + start, length)
                    size = min(length - off, n - start)
                    piece = view[4 * start : 4 * (start + size)]
                    rows.append((doc, start, size, zlib.crc32(piece), n, seq, off) + ((bytes(piece),) if with_ids else ()))
                    start += size
            yield S.batch_of(rows, schema)

    return S.map_rows(placed, {"doc_id": F.col("doc_id"), "at": F.col("base") + F.col("at"), "ids": F.col("ids")}, cut, out)


def op10_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    return pack(S.read_table(spark, sf_dir, "documents"), vocabulary=path("byte_bpe_50k.json"))

"""The corpus pipeline: quality rules, language identification, near-duplicate removal, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gustolake.llm import _shared as S
from gustolake.llm import langid, packing, quality, simhash


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the decision list learned from ``labels``."""
    labels = S.read_table(spark, sf_dir, "labels")
    return quality.keep_good(docs, labels)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language."""
    S.prepare(spark)
    return langid.keep_identified(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (3-word shingles, two bits)."""
    S.prepare(spark)
    return simhash.keep_one(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all remaining documents in sequences of 1024 tokens."""
    from public_tokenizers import path

    S.prepare(spark)
    return packing.pack(docs, vocabulary=path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("pack_sequences", pack_sequences),
]

#: Learned rules, n-gram ranks, SimHash and byte-pair ids are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each one's result written to the shared folder and read again."""
    docs = S.read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = S.staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

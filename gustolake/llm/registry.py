"""The queries of this subpackage, one per operator, for the entry module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gustolake.llm.ann import op3_nearest_neighbours
from gustolake.llm.audit import op12_filter_interactions
from gustolake.llm.bpe import op2_bpe_round_trip
from gustolake.llm.extract import op6_html_extraction
from gustolake.llm.langid import op8_language_id
from gustolake.llm.lm import op1_lm_scoring
from gustolake.llm.oracle import ORACLE_SQL as ORACLE_SQL
from gustolake.llm.packing import op10_pack_sequences
from gustolake.llm.quality import op9_quality_rules
from gustolake.llm.sharding import op13_sharding
from gustolake.llm.simhash import op7_simhash_near_duplicates
from gustolake.llm.spelling import op11_spelling_variants
from gustolake.llm.unigram import op5_token_counts
from gustolake.llm.warc import op4_warc_round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_bpe_round_trip": op2_bpe_round_trip,
    "op3_nearest_neighbours": op3_nearest_neighbours,
    "op4_warc_round_trip": op4_warc_round_trip,
    "op5_token_counts": op5_token_counts,
    "op6_html_extraction": op6_html_extraction,
    "op7_simhash_near_duplicates": op7_simhash_near_duplicates,
    "op8_language_id": op8_language_id,
    "op9_quality_rules": op9_quality_rules,
    "op10_pack_sequences": op10_pack_sequences,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_filter_interactions": op12_filter_interactions,
    "op13_sharding": op13_sharding,
}

"""The registered queries of this package, one for each operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import chat_format, lexical_search, quality_rules, warc
from .bag_minhash import op7_bag_minhash_dedup
from .byte_bpe import op5_byte_level_bpe
from .chat_format import op10_reply_tree_chat_format
from .decontaminate import op8_pigeonhole_decontamination
from .html_extraction import op4_block_tree_html_extraction
from .kneser_ney import op3_kneser_ney_scores
from .language_id import op9_hyperdimensional_language_id
from .lexical_search import op11_automaton_lexical_search
from .license_scan import op2_fuzzy_license_scan
from .periodic_runs import op13_periodic_runs
from .quality_rules import op6_quality_rules
from .suffix_dedup import PASSAGE
from .suffix_dedup import op1_suffix_array_dedup as whole_strings
from .warc import op12_sharded_warc


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns, then n_passage_words: passages of over fifty words, however few bytes they have."""
    return whole_strings(spark, sf_dir, PASSAGE)


QUERIES = {f.__name__: f for f in (
    op1_suffix_array_dedup, op2_fuzzy_license_scan, op3_kneser_ney_scores, op4_block_tree_html_extraction,
    op5_byte_level_bpe, op6_quality_rules, op7_bag_minhash_dedup, op8_pigeonhole_decontamination,
    op9_hyperdimensional_language_id, op10_reply_tree_chat_format, op11_automaton_lexical_search, op12_sharded_warc,
    op13_periodic_runs)}

#: The other operators cannot be written in SQL, or too slowly; tests hold them against plain versions.
ORACLE_SQL: dict[str, str] = {
    "op6_quality_rules": quality_rules.ORACLE,
    "op10_reply_tree_chat_format": chat_format.ORACLE,
    "op11_automaton_lexical_search": lexical_search.ORACLE,
    "op12_sharded_warc": warc.ORACLE,
}

"""Queries and oracle SQL of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe_codec, jaccard_join, multi_index, packing, pii, prefix_trie, quality_model, quality_rules, suffix_dedup, token_counts, vafile, warc, whitening


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_best_fit_packing": packing.op1_best_fit_packing,
        "op2_ngram_jaccard_join": jaccard_join.op2_ngram_jaccard_join,
        "op3_quality_rules": quality_rules.op3_quality_rules,
        "op4_suffix_dedup": suffix_dedup.op4_suffix_dedup,
        "op5_warc": warc.op5_warc,
        "op6_quality_classifier": quality_model.op6_quality_classifier,
        "op7_exact_top_k": vafile.op7_exact_top_k,
        "op8_pii": pii.op8_pii,
        "op9_byte_level_bpe": bpe_codec.op9_byte_level_bpe,
        "op10_token_counts": token_counts.op10_token_counts,
        "op11_conversation_prefix_trie": prefix_trie.op11_conversation_prefix_trie,
        "op12_inverted_multi_index": multi_index.op12_inverted_multi_index,
        "op13_embedding_whitening": whitening.op13_embedding_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_ngram_jaccard_join": jaccard_join.ORACLE_OP2,
        "op4_suffix_dedup": suffix_dedup.ORACLE_OP4,
        "op5_warc": warc.ORACLE_OP5,
        "op7_exact_top_k": vafile.ORACLE_OP7,
    }

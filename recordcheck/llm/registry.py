"""Registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from recordcheck.llm import (ann, conversation_trie, hard_negatives, language, mixing, ngram_join, packing, quality, secret_scan,
                             substring_dedup, suffix_sort, toxicity, warc)

QUERIES = {
    "op1_language_id": language.op1_language_id,
    "op2_substring_dedup": substring_dedup.op2_substring_dedup,
    "op3_quality_rules": quality.op3_quality_rules,
    "op4_warc_revisits": warc.op4_warc_revisits,
    "op5_mix_sources": mixing.op5_mix_sources,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_secret_scan": secret_scan.op7_secret_scan,
    "op8_hash_prefix_forest": ann.op8_hash_prefix_forest,
    "op9_ngram_jaccard": ngram_join.op9_ngram_jaccard,
    "op10_best_fit_packing": packing.op10_best_fit_packing,
    "op11_suffix_sort": suffix_sort.op11_suffix_sort,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_conversation_trie": conversation_trie.op13_conversation_trie,
}

ORACLES = {
    "op7_secret_scan": secret_scan.ORACLE,
    "op4_warc_revisits": warc.ORACLE,
    "op5_mix_sources": mixing.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
    "op13_conversation_trie": conversation_trie.ORACLE,
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)

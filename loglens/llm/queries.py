"""The registered queries of the subpackage and their DuckDB twins, where SQL can express them."""

from __future__ import annotations

from loglens.llm import bpe, decontaminate, jaccard, licenses, minhash, negatives, preference, prefix_trie, quality, token_counts, token_files, toxicity, urls

QUERIES = {
    "op1_minhash_dedup": minhash.q_op1,
    "op2_preference_format": preference.q_op2,
    "op3_toxicity": toxicity.q_op3,
    "op4_token_counts": token_counts.q_op4,
    "op5_quality_rules": quality.q_op5,
    "op6_license_scan": licenses.q_op6,
    "op7_token_files": token_files.q_op7,
    "op8_bpe": bpe.q_op8,
    "op9_url_filter": urls.q_op9,
    "op10_decontamination": decontaminate.q_op10,
    "op11_jaccard_join": jaccard.q_op11,
    "op12_conversation_trie": prefix_trie.q_op12,
    "op13_hard_negatives": negatives.q_op13,
}

ORACLE = {
    "op1_minhash_dedup": minhash.ORACLE_OP1,
    "op2_preference_format": preference.ORACLE_OP2,
    "op5_quality_rules": quality.ORACLE_OP5,
    "op9_url_filter": urls.ORACLE_OP9,
    "op10_decontamination": decontaminate.ORACLE_OP10,
    "op11_jaccard_join": jaccard.ORACLE_OP11,
    "op12_conversation_trie": prefix_trie.ORACLE_OP12,
    "op13_hard_negatives": negatives.ORACLE_OP13,
}

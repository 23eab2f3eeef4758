"""The registered queries of this subpackage and their oracle SQL.

Operators without SQL here are tested against brute force in tests/llm.
"""

from __future__ import annotations

from cellscope.llm import (
    conversation_trie, decontamination, html_extract, jaccard_join, licenses, mixing, ngram_lm, prefix_tokens, quality_classifier,
    quality_rules, source_divergence, token_files, toxicity)

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_token_counts": prefix_tokens.op2_token_counts,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_ngram_lm": ngram_lm.op4_ngram_lm,
    "op5_decontamination": decontamination.op5_decontamination,
    "op6_html_extraction": html_extract.op6_html_extraction,
    "op7_license_scan": licenses.op7_license_scan,
    "op8_quality_rules": quality_rules.op8_quality_rules,
    "op9_jaccard_join": jaccard_join.op9_jaccard_join,
    "op10_quality_classifier": quality_classifier.op10_quality_classifier,
    "op11_source_divergence": source_divergence.op11_source_divergence,
    "op12_token_files": token_files.op12_token_files,
    "op13_conversation_trie": conversation_trie.op13_conversation_trie,
}

ORACLES = {
    "op1_mixing": mixing.ORACLE,
    "op8_quality_rules": quality_rules.ORACLE,
    "op9_jaccard_join": jaccard_join.ORACLE,
    "op11_source_divergence": source_divergence.ORACLE,
    "op13_conversation_trie": conversation_trie.ORACLE,
}

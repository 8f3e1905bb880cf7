"""One query per operator over the test tables, and its SQL where SQL can say it."""

from __future__ import annotations

from chatprep.llm import (
    bitplane_clustering,
    conversation_trie,
    decontamination,
    jaccard_join,
    language_id,
    mixing,
    pii,
    quality_classifier,
    quality_rules,
    secret_scan,
    sharding,
    simhash_join,
    substring_dedup,
)

QUERIES = {
    "op1_jaccard_join": jaccard_join.op1_jaccard_join,
    "op2_substring_dedup": substring_dedup.op2_substring_dedup,
    "op3_quality_classifier": quality_classifier.op3_quality_classifier,
    "op4_sharding": sharding.op4_sharding,
    "op5_language_id": language_id.op5_language_id,
    "op6_secret_scan": secret_scan.op6_secret_scan,
    "op7_mixing": mixing.op7_mixing,
    "op8_quality_rules": quality_rules.op8_quality_rules,
    "op9_decontamination": decontamination.op9_decontamination,
    "op10_pii": pii.op10_pii,
    "op11_simhash_join": simhash_join.op11_simhash_join,
    "op12_conversation_trie": conversation_trie.op12_conversation_trie,
    "op13_bitplane_clustering": bitplane_clustering.op13_bitplane_clustering,
}

ORACLE = {
    "op1_jaccard_join": jaccard_join.ORACLE,
    "op2_substring_dedup": substring_dedup.ORACLE,
    "op4_sharding": sharding.ORACLE,
    "op7_mixing": mixing.ORACLE,
    "op8_quality_rules": quality_rules.ORACLE,
    "op9_decontamination": decontamination.ORACLE,
    "op12_conversation_trie": conversation_trie.ORACLE,
    "op13_bitplane_clustering": bitplane_clustering.ORACLE,
}

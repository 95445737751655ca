"""The registered queries of the subpackage and, where SQL can express them, the same rows in DuckDB's SQL."""

from __future__ import annotations

from colonnade.llm import (
    alignment,
    cotraining,
    decontamination,
    language_id,
    line_dedup,
    near_dedup,
    nearest,
    packing,
    passages,
    quality_rules,
    token_files,
    toxicity,
    trie,
)

QUERIES = {
    "op1_language_id": language_id.op1_language_id,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_packing": packing.op3_packing,
    "op4_passages": passages.op4_passages,
    "op5_near_dedup": near_dedup.op5_near_dedup,
    "op6_cotraining": cotraining.op6_cotraining,
    "op7_token_files": token_files.op7_token_files,
    "op8_decontamination": decontamination.op8_decontamination,
    "op9_quality_rules": quality_rules.op9_quality_rules,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_nearest_vectors": nearest.op11_nearest_vectors,
    "op12_token_alignment": alignment.op12_token_alignment,
    "op13_prefix_trie": trie.op13_prefix_trie,
}
ORACLES = {
    "op2_line_dedup": line_dedup.ORACLE,
    "op4_passages": passages.ORACLE,
    "op5_near_dedup": near_dedup.ORACLE,
    "op8_decontamination": decontamination.ORACLE,
    "op9_quality_rules": quality_rules.ORACLE,
    "op13_prefix_trie": trie.ORACLE,
}

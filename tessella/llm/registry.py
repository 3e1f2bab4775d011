"""Queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from . import class_model, conversation_repair, embedding_dedup, line_dedup, mixing, ngram_join, packing, pii, quality_model, quality_rules, spelling, suffix_dedup, token_files

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.op1,
    "op2_quality_model": quality_model.op2,
    "op3_mixing": mixing.op3,
    "op4_embedding_dedup": embedding_dedup.op4,
    "op5_quality_rules": quality_rules.op5,
    "op6_class_model": class_model.op6,
    "op7_line_dedup": line_dedup.op7,
    "op8_token_files": token_files.op8,
    "op9_packing": packing.op9,
    "op10_ngram_join": ngram_join.op10,
    "op11_conversation_repair": conversation_repair.op11,
    "op12_spelling": spelling.op12,
    "op13_pii": pii.op13,
}

ORACLES = {"op3_mixing": mixing.ORACLE, "op5_quality_rules": quality_rules.ORACLE, "op7_line_dedup": line_dedup.ORACLE, "op4_embedding_dedup": embedding_dedup.ORACLE, "op10_ngram_join": ngram_join.ORACLE, "op11_conversation_repair": conversation_repair.ORACLE, "op12_spelling": spelling.ORACLE}

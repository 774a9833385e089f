"""Queries of this package: key -> callable(spark, sf_dir) -> DataFrame, and their DuckDB SQL."""

from __future__ import annotations

from queryscope.llm import (
    byte_repeats,
    jaccard_join,
    language_id,
    line_templates,
    packing,
    passages,
    perfect_hash,
    phrase_mining,
    piece_bpe,
    pivot_topk,
    token_counts,
    turn_repair,
    weighted_sampling,
)

QUERIES = {
    "op10_line_templates": line_templates.op10,
    "op3_language_id": language_id.op3,
    "op6_weighted_sampling": weighted_sampling.op6,
    "op7_byte_repeats": byte_repeats.op7,
    "op5_passages": passages.op5,
    "op8_jaccard_join": jaccard_join.op8,
    "op1_packing": packing.op1,
    "op2_pivot_topk": pivot_topk.op2,
    "op4_piece_bpe": piece_bpe.op4,
    "op9_token_counts": token_counts.op9,
    "op11_turn_repair": turn_repair.op11,
    "op12_perfect_hash": perfect_hash.op12,
    "op13_phrase_mining": phrase_mining.op13,
}

ORACLE = {
    "op2_pivot_topk": pivot_topk.OP2_SQL,
    "op7_byte_repeats": byte_repeats.OP7_SQL,
    "op8_jaccard_join": jaccard_join.OP8_SQL,
    "op10_line_templates": line_templates.OP10_SQL,
    "op11_turn_repair": turn_repair.OP11_SQL,
    "op12_perfect_hash": perfect_hash.OP12_SQL,
    "op13_phrase_mining": phrase_mining.OP13_SQL,
}

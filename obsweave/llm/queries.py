"""The registered queries of the text operators, and SQL for those that it can express."""

from __future__ import annotations

from . import alignment, decontam, html, langid, lm, neardup, packing, phrases, pieces, pii, quality, shards, suffixes

QUERIES = {
    "op1_minhash_neardup": neardup.query,
    "op2_suffix_tree_lm": lm.query,
    "op3_benchmark_decontamination": decontam.query,
    "op4_piece_sampling": pieces.query,
    "op5_suffix_dedup": suffixes.query,
    "op6_line_quality": quality.query,
    "op7_language_id": langid.query,
    "op8_personal_data": pii.query,
    "op9_main_text": html.query,
    "op10_training_shards": shards.query,
    "op11_cost_packing": packing.query,
    "op12_phrase_mining": phrases.query,
    "op13_token_alignment": alignment.query,
}
ORACLE_SQL = {"op6_line_quality": quality.ORACLE, "op12_phrase_mining": phrases.ORACLE}

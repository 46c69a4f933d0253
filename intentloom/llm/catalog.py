"""The queries of this subpackage and, where SQL can say it, their independent checks."""

from __future__ import annotations

from intentloom.llm import (
    fill_middle,
    grid_join,
    importance,
    minhash,
    mix,
    packing,
    prefix_bpe,
    preferences,
    pseudonyms,
    quality,
    repeats,
    secrets,
    token_files,
)

QUERIES = {
    "op1_pseudonyms": pseudonyms.op1_pseudonyms,
    "op2_preferences": preferences.op2_preferences,
    "op3_mix": mix.op3_mix,
    "op4_host_quality": quality.op4_host_quality,
    "op5_grid_join": grid_join.op5_grid_join,
    "op6_token_files": token_files.op6_token_files,
    "op7_pattern_packing": packing.op7_pattern_packing,
    "op8_repeats": repeats.op8_repeats,
    "op9_minhash": minhash.op9_minhash,
    "op10_secrets": secrets.op10_secrets,
    "op11_prefix_bpe": prefix_bpe.op11_prefix_bpe,
    "op12_fill_middle": fill_middle.op12_fill_middle,
    "op13_importance": importance.op13_importance,
}
ORACLE = {
    "op2_preferences": preferences.OP2_SQL,
    "op3_mix": mix.OP3_SQL,
    "op4_host_quality": quality.OP4_SQL,
    "op5_grid_join": grid_join.OP5_SQL,
    "op12_fill_middle": fill_middle.OP12_SQL,
    "op13_importance": importance.OP13_SQL,
}

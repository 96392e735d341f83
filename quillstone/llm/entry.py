"""Queries and SQL of this subpackage, for __spark_entry__.py."""

from __future__ import annotations

from . import ann, bpe, chosenpath, langid, lines, lsm, mixing, pii, planes, suffix

QUERIES = {
    "op1_cube_mix": mixing.op1_cube_mix,
    "op2_line_dedup": lines.op2_line_dedup,
    "op3_pii": pii.op3_pii,
    "op4_bpe": bpe.op4_bpe,
    "op5_token_planes": planes.op5_token_planes,
    "op6_language_id": langid.op6_language_id,
    "op7_suffix_dedup": suffix.op7_suffix_dedup,
    "op8_exact_dedup": lsm.op8_exact_dedup,
    "op9_chosen_path": chosenpath.op9_chosen_path,
    "op10_learned_partitions": ann.op10_learned_partitions,
}

ORACLE_SQL = {
    "op2_line_dedup": lines.OP2_SQL,
    "op8_exact_dedup": lsm.OP8_SQL,
}

"""Registered queries of this folder and their SQL."""

from __future__ import annotations

from . import (bpe, fim, gam, katz, line_crf, line_runs, mixing, multi_index, pii, rank_language, simhash_trie, url_filter,
               whiten)

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_quality_rules": line_crf.op2_quality_rules,
    "op3_quality": gam.op3_quality,
    "op4_nearest": multi_index.op4_nearest,
    "op5_pii": pii.op5_pii,
    "op6_url_filter": url_filter.op6_url_filter,
    "op7_byte_bpe": bpe.op7_byte_bpe,
    "op8_language": rank_language.op8_language,
    "op9_line_dedup": line_runs.op9_line_dedup,
    "op10_simhash": simhash_trie.op10_simhash,
    "op11_katz": katz.op11_katz,
    "op12_fim": fim.op12_fim,
    "op13_whitening": whiten.op13_whitening,
}

ORACLE = {
    "op9_line_dedup": line_runs.OP9_SQL,
    "op12_fim": fim.OP12_SQL,
}

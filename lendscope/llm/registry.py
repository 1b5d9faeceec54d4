"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from . import ann, chat, dedup, language, mixing, oracles, packing, pii, pitmanyor, pivots, repair, toxicity, trie, warc

QUERIES = {
    "op1_posting_list_neighbours": ann.query,
    "op2_pitman_yor_scoring": pitmanyor.query,
    "op3_weighted_fair_mixing": mixing.query,
    "op4_best_fit_packing": packing.query,
    "op5_superminhash_dedup": dedup.query,
    "op6_subword_toxicity": toxicity.query,
    "op7_warc_archives": warc.query,
    "op8_pivot_inner_products": pivots.query,
    "op9_disguised_pii": pii.query,
    "op10_segmentation_language": language.query,
    "op11_grammar_round_trip": chat.query,
    "op12_parentheses_trie": trie.query,
    "op13_generalised_repair": repair.query,
}
ORACLE: dict[str, str] = {
    "op11_grammar_round_trip": oracles.CHAT,
    "op12_parentheses_trie": oracles.TRIE,
    "op13_generalised_repair": oracles.REPAIR,
}

"""Registered queries of this subpackage and, where SQL can express them,
their DuckDB oracles."""

from busframes.llm import (
    byte_cnn, collocations, fingerprints, ngram_join, packing, periodic_runs, quality_rules, string_tiling, suffix_repeats, suffix_tree_lm, tool_calls, toxic_fm, trie_counts,
)

QUERIES = {
    "op1_tool_call_linking": tool_calls.query,
    "op2_suffix_tree_lm": suffix_tree_lm.query,
    "op3_byte_cnn_language": byte_cnn.query,
    "op4_toxicity_fm": toxic_fm.query,
    "op5_string_tiling": string_tiling.query,
    "op6_trie_token_counts": trie_counts.query,
    "op7_harmonic_packing": packing.query,
    "op8_suffix_repeats": suffix_repeats.query,
    "op9_ngram_join": ngram_join.query,
    "op10_adaptive_quality_rules": quality_rules.query,
    "op11_bottom_k_fingerprints": fingerprints.query,
    "op12_periodic_runs": periodic_runs.query,
    "op13_phrase_automata": collocations.query,
}
ORACLE_SQL = {
    "op1_tool_call_linking": tool_calls.ORACLE_SQL,
    "op9_ngram_join": ngram_join.ORACLE_SQL,
    "op10_adaptive_quality_rules": quality_rules.ORACLE_SQL,
    "op13_phrase_automata": collocations.ORACLE_SQL,
}

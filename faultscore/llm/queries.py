"""The registered queries of this folder, and their SQL where SQL can express them."""

from __future__ import annotations

from . import ball_tree, decontamination, html_text, induced_sorting, language_id, mixing, ngram_scores, pivots, prefix_trie, secrets_scan, simhash, suffix_trees, token_alignment
from .common import Query, ship_package


def _shipped(query: Query) -> Query:
    def run(spark, sf_dir):
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    name: _shipped(q)
    for name, q in {
        "op1_secrets": secrets_scan.q_secrets,
        "op2_suffix_trees": suffix_trees.q_deduplicate,
        "op3_induced_sorting": induced_sorting.q_deduplicate,
        "op4_ngram_scores": ngram_scores.q_score,
        "op5_simhash": simhash.q_near_duplicates,
        "op6_pivots": pivots.q_near_duplicates,
        "op7_language": language_id.q_identify,
        "op8_mixture": mixing.q_mix,
        "op9_html": html_text.q_extract,
        "op10_containment": decontamination.q_contained,
        "op11_alignment": token_alignment.q_align,
        "op12_ball_tree": ball_tree.q_top_k,
        "op13_prefix_trie": prefix_trie.q_trie,
    }.items()
}

ORACLE: dict[str, str] = {
    "op2_suffix_trees": suffix_trees.ORACLE,
    "op3_induced_sorting": induced_sorting.ORACLE,
    "op4_ngram_scores": ngram_scores.ORACLE,
    "op8_mixture": mixing.ORACLE,
    "op6_pivots": pivots.ORACLE,
    "op10_containment": decontamination.ORACLE,
    "op12_ball_tree": ball_tree.ORACLE,
    "op13_prefix_trie": prefix_trie.ORACLE,
}

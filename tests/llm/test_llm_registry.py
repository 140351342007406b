"""Every query has SQL or a test by other means that exists."""
import importlib

from ledgerline.llm import queries

HELD_AGAINST = {
    "op2_embedding_dedup": ("test_llm_embeddings", "test_links_and_components_equal_brute_force"),
    "op3_decontamination": ("test_llm_decontaminate", "test_matches_equal_brute_force"),
    "op4_html_extraction": ("test_llm_html", "test_pages_equal_a_plain_renderer"),
    "op6_quality": ("test_llm_quality", "test_scores_equal_a_plain_convolution"),
    "op8_token_rollup": ("test_llm_rollup", "test_query_equals_a_full_count"),
    "op9_simhash_dedup": ("test_llm_simhash", "test_groups_equal_brute_force"),
    "op11_toxicity": ("test_llm_toxicity", "test_segments_are_the_maximal_ones"),
    "op12_embedding_whitening": ("test_llm_whitening", "test_query_over_the_table"),
    "op13_tokenizer_alignment": ("test_llm_alignment", "test_query"),
}


def test_every_query_is_held_against_something():
    assert set(queries.QUERIES) == set(queries.ORACLE_SQL) | set(HELD_AGAINST)
    for module, name in HELD_AGAINST.values():
        assert hasattr(importlib.import_module(module), name)

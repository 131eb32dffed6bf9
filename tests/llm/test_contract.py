"""The queries that the entry point registers for these operators."""

import os

import pytest

import __spark_entry__ as contract

SMALL = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = set(contract.queries())
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")
def test_those_with_sql_agree(spark):
    from tools.compare import compare

    results = compare(spark, SMALL, ["op1_topk", "op5_url_filter", "op11_ranked_search"])
    assert all(r.startswith("ok") for r in results.values()), results


@pytest.mark.parametrize("name", ["op2_main_text", "op3_language", "op4_pii", "op6_toxicity", "op7_token_counts", "op8_decontaminate", "op9_mix", "op10_ngram_join"])
def test_the_others_return_what_is_asked(spark, name):
    columns = {
        "op2_main_text": {"page_id", "url", "text", "n_chars"}, "op3_language": {"doc_id", "held_out", "lang_pred", "score"},
        "op4_pii": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
        "op6_toxicity": {"doc_id", "held_out", "score", "predicted"}, "op7_token_counts": {"source", "lang", "version", "n_docs", "n_tokens"},
        "op8_decontaminate": {"doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"},
        "op9_mix": {"doc_id", "size", "source_size", "target", "taken"}, "op10_ngram_join": {"doc_id", "n_shingles", "component_id"},
    }[name]
    out = contract.queries()[name](spark, SMALL)
    rows = out.collect()
    assert columns <= set(out.columns)
    if name != "op7_token_counts":
        assert len(rows) == (50 if name == "op2_main_text" else 200)

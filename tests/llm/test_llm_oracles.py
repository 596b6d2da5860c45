"""Corpus queries with SQL equal DuckDB on the small tables; every query runs and is documented."""

import pytest

from conftest import SF_SMALL
from ledgerlens.llm.registry import llm_oracles, llm_queries
from oracle_compare import compare

CONTRACT = {
    "op1": {"doc_id", "size", "source_size", "target", "taken"},
    "op3": {"doc_id", "held_out", "score", "predicted"},
    "op4": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op5": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
    "op6": {"page_id", "host", "path", "rule", "verdict"},
    "op7": {"doc_id", "n_shingles", "component_id"},
    "op8": {"page_id", "url", "text", "n_chars"},
    "op11": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op12": {"item_id", "rank", "doc_id", "score"},
    "op13": {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"},
}


def test_all_operators_are_registered():
    assert {n.split("_")[0] for n in llm_queries()} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_matches_oracle(spark, duck_small, name):
    ok, msg = compare(llm_queries()[name](spark, SF_SMALL), llm_oracles()[name], duck_small)
    assert ok, msg


@pytest.mark.parametrize("name", sorted(set(llm_queries()) - set(llm_oracles())))
def test_query_runs_with_contract_columns(spark, name):
    assert llm_queries()[name].__doc__
    df = llm_queries()[name](spark, SF_SMALL)
    assert CONTRACT.get(name.split("_")[0], set()) <= set(df.columns)
    assert df.count() > 0

"""The queries that SQL can express, against it."""

import compare
import pytest

from prosopon.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_agrees_with_sql(spark, sf_dir, name):
    mine, theirs = compare.both(spark, sf_dir, QUERIES[name], ORACLE_SQL[name])
    assert mine == theirs and mine[1]


def test_contract_columns(spark, sf_dir):
    want = {
        "op2": "doc_id n_bytes n_tokens over_limit", "op3": "doc_id held_out score predicted", "op4": "doc_id held_out n_tokens n_known train_tokens base_score score", "op5": "doc_id n_shingles component_id",
        "op6": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept", "op7": "doc_id n_tokens ids_sha256 decoded_sha256", "op9": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
        "op10": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
        "op11": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256", "op12": "doc_id n_words n_hit n_items items_sha256 contaminated", "op13": "item_id rank doc_id score",
    }
    for name, f in QUERIES.items():
        if (op := name.split("_")[0]) in want:
            assert set(want[op].split()) <= set(f(spark, sf_dir).columns)

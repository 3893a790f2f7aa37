"""The registered queries' columns and types."""

from __future__ import annotations

import pytest

from foldwise.llm.registry import queries

CONTRACT = {
    "op1": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op2": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
           "base_score double, score double",
    "op3": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
           "base_sha256 string, spans string",
    "op4": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op5": "doc_id bigint, held_out boolean, score double, predicted int",
    "op6": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op7": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
           "n_repeat_words bigint, base_failed boolean, kept boolean",
    "op8": "query_id bigint, rank int, vec_id bigint, score double",
    "op9": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op10": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op12": "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint",
    "op13": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
    "op11": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
}


@pytest.mark.parametrize("name", sorted(queries()))
def test_columns(spark, name):
    want = CONTRACT[name.split("_")[0]].split(", ")
    got = [f"{c} {t}" for c, t in queries()[name](spark, "/root/testdata/sf0.001").dtypes]
    assert got[:len(want)] == want

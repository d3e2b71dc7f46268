"""Registered queries run over the smallest given tables."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op2_nearest": ["query_id", "rank", "vec_id", "score"],
    "op3_language": ["doc_id", "held_out", "lang_pred", "score", "ambiguous"],
    "op4_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op6_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op7_fingerprints": [
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    ],
    "op8_line_dedup": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    "op9_near_duplicates": ["doc_id", "class_id", "class_texts"],
    "op11_repetition": [
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "covered_chars", "longest_chars",
    ],
    "op12_filter_audit": [
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley",
    ],
    "op13_spelling_variants": ["word", "form", "root", "n", "n_near", "form_n"],
    "op10_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    found = contract.queries()[name](spark, SF_DIR)
    assert found.columns == COLUMNS[name]
    assert found.count() > 0


def test_every_operator_is_registered():
    names = set(contract.queries())
    numbers = {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))}
    assert numbers == set(range(1, 14))
    assert "pipeline" in names

"""Column names and types that the contracts of the registered corpus queries name."""

import pytest

from curbwise.llm import queries

L, S, D, B, I = "bigint", "string", "double", "boolean", "int"  # noqa: E741
CONTRACT = {
    "op1_": {"doc_id": L, "n_shingles": L, "component_id": L, "n_links": L},
    "op2_": {"conv_id": L, "n_turns": L, "turns_sha256": S, "loss_chars": L, "loss_sha256": S, "formatted_chars": L},
    "op3_": {"page_id": L, "host": S, "path": S, "rule": S, "verdict": S},
    "op4_": {"query_id": L, "rank": I, "vec_id": L, "score": D},
    "op6_": {"doc_id": L, "start": L, "n_tokens": L, "ids_crc32": L},
    "op7_": {"page_id": L, "payload_bytes": L, "payload_digest": S, "record_type": S, "refers_to": L},
    "op8_": {"doc_id": L, "n_words": L, "word_chars": L, "n_symbols": L, "n_dup_lines": L, "n_repeat_words": L, "base_failed": B, "kept": B},
    "op9_": {"doc_id": L, "size": L, "source_size": L, "target": D, "taken": L},
    "op10_": {"doc_id": L, "start": L, "length": L, "ids_crc32": L, "doc_tokens": L, "sequence_id": L, "offset": L},
    "op11_": {"doc_id": L, "n_chars": L, "edited_sha256": S, "fingerprint": S, "edited_fingerprint": S, "near_edited": D, "near_next": D},
    "op12_": {"doc_id": L, "n_a": L, "n_b": L, "n_groups": L, "n_links": L, "n_best": L, "count_sum": L, "groups_sha256": S},
    "op13_": {"doc_id": L, "n_runs": L, "start": L, "length": L, "period": L, "exponent_milli": L, "runs_sha256": S, "collapsed_sha256": S},
}


@pytest.mark.parametrize("prefix", CONTRACT)
def test_columns_and_types(spark, prefix):
    (name,) = [n for n in queries.QUERIES if n.startswith(prefix)]
    got = dict(queries.QUERIES[name](spark, "/root/testdata/sf0.001").dtypes)
    assert {c: got.get(c) for c in CONTRACT[prefix]} == CONTRACT[prefix]

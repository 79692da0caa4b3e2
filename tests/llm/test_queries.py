"""The registered text queries: their SQL, or their shape and rows."""

import pytest

import __spark_entry__ as registry
from checks.compare import connect, differences
from parcelry.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op2_suffixes": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op3_substrings": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op4_fingerprints": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op6_quality": ["doc_id", "held_out", "score", "predicted"],
    "op8_near_copies": ["doc_id", "class_id"],
    "op9_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op10_pieces": ["doc_id", "n_pieces", "pieces_hash", "decoded_sha256", "lossless"],
}


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(registry.queries()) and set(ORACLE) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_every_document_has_its_row(spark, name):
    found = QUERIES[name](spark, FOLDER)
    assert found.columns == COLUMNS[name]
    assert sorted(r.doc_id for r in found.select("doc_id").collect()) == list(range(200))

"""The registered queries of the package: SQL where there is one, columns of the contract, one row per document."""

import pytest
from oracle import connect, difference

from quayside.llm.queries import LLM_ORACLES, LLM_QUERIES

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op6_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op8_token_groups": ["doc_id", "n_shingles", "component_id"],
    "op9_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op3_rules": ["doc_id", "held_out", "score", "predicted"],
}


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_equals_sql(spark, name):
    con = connect(FOLDER)
    assert difference(LLM_QUERIES[name](spark, FOLDER), LLM_ORACLES[name], con) is None


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    got = LLM_QUERIES[name](spark, FOLDER)
    assert got.columns == COLUMNS[name]
    assert got.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()

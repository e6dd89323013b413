"""The registered corpus queries over the smallest tables: whole results with the columns their users rely on."""

import duckdb
import pytest

from feedmart.llm.queries import ORACLES, QUERIES
from tests.compare import differences, warehouse

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": ["doc_id", "item_id"],
    "op3": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op4": ["page_id", "url", "text", "n_chars"],
    "op5": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op6": ["doc_id", "held_out", "lang_pred", "score"],
    "op8": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op9": ["doc_id", "held_out", "score", "predicted"],
    "op10": ["doc_id", "n_shingles", "component_id", "kept"],
    "op11": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
    "op12": ["word", "form", "root", "n", "n_near", "form_n"],
    "op13": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
}
ROWS = {"op3": "documents", "op4": "pages", "op5": "documents", "op6": "documents", "op9": "documents", "op10": "documents",
        "op13": "documents"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    got = QUERIES[name](spark, SF)
    op = name.split("_")[0]
    assert set(COLUMNS.get(op, [])) <= set(got.columns)
    rows = got.toPandas()
    if op in ROWS:
        assert len(rows) == duckdb.sql(f"SELECT count(*) FROM '{SF}/{ROWS[op]}.parquet'").fetchall()[0][0]
    if op == "op7":
        assert len(rows) == 2 * duckdb.sql(f"SELECT count(*) FROM '{SF}/pages.parquet'").fetchall()[0][0]
    if op == "op8":
        assert -1 in set(rows.conv_id)
        assert rows[rows.conv_id == -1].loss_chars.tolist() == [len("</s>[INST] ok [/INST]")]
    assert len(rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), warehouse(SF), ORACLES[name]) == []

"""The thin queries on the smallest tables: registered names, contract columns, and SQL where there is some."""

from __future__ import annotations

import pytest

pytest.importorskip("sparkloom.llm")
from sparkloom.llm import queries

SF = "/root/testdata/sf0.001"
#: The columns that each query's result begins with.
COLUMNS = {
    "op1_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op2_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op3_near_duplicates": ["doc_id", "group_id", "kept"],
    "op4_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op5_license_scan": ["doc_id", "license", "coverage", "first_word", "end_word"],
    "op6_line_dedup": ["doc_id", "text", "n_chars", "n_removed"],
    "op7_html_text": ["page_id", "url", "text", "n_chars"],
    "op8_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op9_neighbours": ["query_id", "rank", "vec_id", "score"],
    "op10_chat": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
}


def test_every_operator_has_one_query():
    assert list(queries.QUERIES) == list(COLUMNS)
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_rows(spark, name):
    out = queries.QUERIES[name](spark, SF)
    assert out.columns[: len(COLUMNS[name])] == COLUMNS[name]
    table, key = {"op7": ("pages", "page_id"), "op9": ("embeddings", None), "op10": ("conversations", "conv_id")}.get(name.split("_")[0], ("documents", "doc_id"))
    rows = out.count()
    if name in ("op5_license_scan", "op9_neighbours"):
        assert rows > 0
    elif name == "op8_packing":
        assert rows >= spark.read.parquet(f"{SF}/{table}.parquet").count()
    else:
        assert rows == spark.read.parquet(f"{SF}/{table}.parquet").select(key).distinct().count() + (name == "op10_chat")

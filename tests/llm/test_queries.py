"""The registered queries: SQL where there is some, and what they return."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from tillwork.llm.catalogue import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.01"
COLUMNS = {
    "op1_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op2_main_text": "page_id url text n_chars",
    "op3_lattice_scores": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op4_decontamination": "doc_id item_id",
    "op5_mixture": "doc_id size source_size target taken",
    "op6_near_duplicates": "doc_id n_shingles component_id kept",
    "op7_url_rules": "page_id host path rule verdict",
    "op8_nearest_neighbours": "query_id rank vec_id score",
    "op9_toxicity": "doc_id held_out score predicted",
    "op10_repeated_passages": "doc_id n_words n_removed kept_sha256",
    "op11_repeated_bytes": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op12_hard_negatives": "anchor_id positive_id rank negative_id positive_score negative_score",
    "op13_conversation_repair": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
}


def test_registered():
    assert set(COLUMNS) == set(QUERIES)
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", COLUMNS)
def test_columns(spark, name):
    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert set(COLUMNS[name].split()) <= set(df.columns)
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "labels", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    cursor = con.execute(ORACLE[name])
    names = [c[0] for c in cursor.description]
    df = QUERIES[name](spark, FOLDER)
    assert sorted(names) == sorted(df.columns)
    theirs = sorted(cursor.fetchall(), key=repr)
    assert theirs == sorted((tuple(r) for r in df.select(*names).collect()), key=repr)

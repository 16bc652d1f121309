"""The registered corpus queries against SQL on the smallest tables, and their columns."""

import pytest
from compare import connect, differences
from punctua.llm.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_mixing": {"doc_id", "size", "source_size", "target", "taken"},
    "op3_exact_dedup": {"doc_id", "keep_id", "group_size", "kept", "text_sha256"},
    "op4_near_dedup": {"doc_id", "n_shingles", "component_id", "kept"},
    "op6_secret_scan": {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
    "op7_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op8_packing": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
    "op9_substring_dedup": {"doc_id", "n_words", "n_removed", "kept_sha256"},
    "op10_embedding_dedup": {"vec_id", "n_links", "component_id", "kept"},
    "op11_centroids": {"vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"},
    "op12_merkle_manifest": {"doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"},
    "op13_personal_data": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_every_row_has_a_result(spark, name):
    result = QUERIES[name](spark, SF_DIR)
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert result.select("doc_id").distinct().count() == documents


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    assert COLUMNS[name] <= set(QUERIES[name](spark, SF_DIR).columns)

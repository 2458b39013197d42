"""The registered queries: every one runs over the smallest tables and keeps its contract's columns; SQL where there is some."""

import pytest

import __spark_entry__ as entry
from churnkit.llm import queries
from tests.conftest import SF001, SF01
from tools.oracle_check import compare

COLUMNS = {
    "op1_quality_knn": {"doc_id", "held_out", "score", "predicted"},
    "op2_vector_best_fit": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
    "op3_lsh_forest": {"doc_id", "n_shingles", "component_id", "kept"},
    "op4_byte_cnn_language": {"doc_id", "held_out", "lang_pred", "score"},
    "op5_greedy_string_tiling": {"doc_id", "contaminated", "item_ids", "coverage"},
    "op6_sorted_projections": {"vec_id", "n_links", "component_id", "kept"},
    "op7_tag_path_ratios": {"page_id", "url", "text", "n_chars"},
    "op8_deletion_lines": {"doc_id", "n_lines", "dropped", "clean_crc32"},
    "op9_pitman_yor": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op10_url_vocabulary": {"page_id", "host", "path", "rule", "verdict"},
    "op11_ns_bounds": {"vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"},
    "op12_fingerprint_trie": {"conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"},
    "op13_crf_personal_data": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
}


def test_all_operators_and_the_pipeline_are_registered():
    assert set(queries.QUERIES) == set(COLUMNS)
    assert set(entry.queries()) >= {*COLUMNS, "pipeline"}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_returns_a_row_for_each_input_row(spark, name):
    out = entry.queries()[name](spark, SF001)
    assert set(out.columns) >= COLUMNS[name]
    table = {"vec_id": "embeddings", "page_id": "pages", "conv_id": "conversations"}.get(out.columns[0], "documents")
    read = spark.read.parquet(f"{SF001}/{table}.parquet")
    rows = read.select(out.columns[0]).distinct().count()
    if table == "conversations":  # one row a node: every turn is in one
        assert out.where("depth = 0").count() == 1 and out.where("depth = 0").first().n_convs == rows
        return
    assert out.select(out.columns[0]).distinct().count() == rows
    assert name.startswith("op2") or out.count() == rows


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_its_sql(spark, con01, name):
    r = compare(spark, name, entry.queries()[name], entry.oracle_sql()[name], SF01, con01)
    assert r["status"] == "ok", r

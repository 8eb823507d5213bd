"""Registered queries against their SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUICK = (
    "clean_text", "mask_patterns", "tokenise", "ngrams", "key_sections", "embedding_text",
    "context_snippet", "matched_terms", "query_terms", "metadata_get", "parse_dates",
    "document_types", "validate_documents", "validate_queries", "normalise_documents",
    "duplicate_ids", "render_documents", "document_frequency", "tfidf_weights", "score_sparse",
    "topk_dense", "fuse_rrf", "topk_hybrid", "search_sparse", "search_hybrid", "threshold_sweep",
    "rolling_search_time", "latency_summary", "engine_stats", "search_request", "batch_search",
    "search_reloaded_batches", "search_streamed_onto_bulk", "search_hybrid_two_batches",
    "add_documents_hybrid", "ingest_rejects", "incremental_ingest", "save_load_hybrid",
    "check_results", "sparse_index_only", "logged_searches", "prune_vocabulary",
    "ivf_knn", "compare_modes", "vocab_params", "vocab_last_resort", "search_hybrid_some_vectors",
)
# All of them with DOCSEARCH_ALL=1.
NAMES = sorted(entry.oracle_sql()) if os.environ.get("DOCSEARCH_ALL") else QUICK
assert set(QUICK) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as from '{sf_dir}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, sf_dir, duck, name):
    result = entry.queries()[name](spark, sf_dir)
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    expected = sorted(map(repr, cursor.fetchall()))
    actual = sorted(repr(tuple(r)) for r in result.select(*columns).collect())
    assert actual == expected


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())

"""Indexing and ranking of business documents on Spark."""

from docsearch.plans.index import (
    DenseIndex,
    SparseIndex,
    build_dense_index,
    build_sparse_index,
)
from docsearch.plans.search import (
    search,
    search_dense,
    search_hybrid,
    search_requests,
    search_sparse,
    search_text,
)
from docsearch.schema import DOCS, QUERIES, SparseParams
from docsearch.sources.index_store import (
    DenseStore,
    HybridStore,
    SparseStore,
    load_hybrid,
    save_hybrid,
)

__all__ = [
    "DOCS", "QUERIES", "DenseIndex", "DenseStore", "HybridStore", "SparseIndex", "SparseParams",
    "SparseStore", "build_dense_index", "build_sparse_index", "load_hybrid", "save_hybrid",
    "search", "search_dense", "search_hybrid", "search_requests", "search_sparse",
    "search_text",
]

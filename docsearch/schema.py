"""Table schemas and settings."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

from docsearch import fixed_values as V

DOCS = T.StructType([
    T.StructField("doc_id", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("entity_id", T.StringType()),
    T.StructField("doc_type", T.StringType()),
    T.StructField("date", T.TimestampNTZType()),
    T.StructField("metadata", T.VariantType()),
])

QUERIES = T.StructType([
    T.StructField("query_id", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("entity_ids", T.ArrayType(T.StringType())),
    T.StructField("doc_types", T.ArrayType(T.StringType())),
    T.StructField("date_from", T.TimestampNTZType()),
    T.StructField("date_to", T.TimestampNTZType()),
    T.StructField("similarity_threshold", T.DoubleType()),
    T.StructField("max_results", T.IntegerType()),
])

# A search request as it arrives: dates are ISO strings, filters are lists.
REQUEST = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("entity_ids", T.ArrayType(T.StringType())),
    T.StructField("doc_types", T.ArrayType(T.StringType())),
    T.StructField("date_from", T.StringType()),
    T.StructField("date_to", T.StringType()),
    T.StructField("similarity_threshold", T.DoubleType()),
    T.StructField("max_results", T.IntegerType()),
])


@dataclass(frozen=True)
class SparseParams:
    """Settings of the TF-IDF index.

    ``stop_words=None`` means Spark ML's English list.
    """

    max_features: int = V.MAX_FEATURES
    min_df: int = V.MIN_DF
    max_df: float = V.MAX_DF
    ngram_range: tuple[int, int] = V.NGRAM_RANGE
    stop_words: tuple[str, ...] | None = None
    fallback_analyser: bool = False

    def for_corpus(self, n_docs: int) -> "SparseParams":
        """Relax the document-frequency bounds of a small corpus."""
        if n_docs < 5:
            return replace(self, min_df=1, max_df=1.0)
        if n_docs < 20:
            return replace(self, min_df=1, max_df=V.MAX_DF)
        return self

    def permissive(self) -> "SparseParams":
        """First fallback: no document-frequency bounds."""
        return replace(self, min_df=1, max_df=1.0)

    def last_resort(self, n_docs: int) -> "SparseParams":
        """Second fallback: every word of two or more characters, unigrams only."""
        features = min(
            V.FALLBACK_MAX_FEATURES, n_docs * V.FALLBACK_FEATURES_PER_DOCUMENT
        )
        return replace(
            self, max_features=features, min_df=1, max_df=1.0, ngram_range=(1, 1),
            stop_words=(), fallback_analyser=True,
        )

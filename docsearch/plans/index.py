"""Indexes: the tables a search reads."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsearch.functions.vectors import normalise
from docsearch.operators import dense, sparse, validate
from docsearch.runtime import spread, written
from docsearch.schema import SparseParams


@dataclass(frozen=True)
class SparseIndex:
    """``docs`` hold cleaned content and tokens; see ``sparse`` for the rest.

    The bucket counts are set for stored tables, which are partitioned by them. A stored
    index has its raw ``counts`` (``term, doc_id, batch_id, tf``) and, bucketed in the same
    way, ``rows`` with norm and attributes of each document; ``postings`` follow from them.
    """

    docs: DataFrame
    vocab: DataFrame
    postings: DataFrame
    n_docs: int
    vocab_rows: int
    params: SparseParams
    doc_buckets: int | None = None
    counts: DataFrame | None = None
    rows: DataFrame | None = None


@dataclass(frozen=True)
class DenseIndex:
    """``docs`` hold original content; ``vectors`` have length one."""

    docs: DataFrame
    vectors: DataFrame
    n_vectors: int
    dimension: int
    centres: np.ndarray | None = None
    doc_buckets: int | None = None

    @property
    def clustered(self) -> bool:
        """Whether the vectors are clustered; only then a search can probe."""
        return self.centres is not None


def doc_bucket(doc_id: Column | str, n_buckets: int) -> Column:
    """Storage bucket of a document."""
    return F.pmod(F.xxhash64(doc_id), F.lit(n_buckets)).cast("int")


def with_batch(docs: DataFrame, batch_id: int = 0) -> DataFrame:
    """Documents are keyed by id and batch, so an id that is added again in a
    later batch gives a second row."""
    if "batch_id" in docs.columns:
        return docs
    return docs.withColumn("batch_id", F.lit(batch_id).cast("bigint"))


def cleaned_documents(docs: DataFrame) -> DataFrame:
    """Cleaned documents: the only pass over raw text."""
    return validate.clean_documents(with_batch(spread(docs)))


def tokenised_documents(docs: DataFrame, params: SparseParams) -> DataFrame:
    """Cleaned documents with tokens."""
    return sparse.with_tokens(cleaned_documents(docs), params)


def fit_vocabulary(
    freq: DataFrame, n_docs: int, params: SparseParams
) -> tuple[DataFrame, int]:
    """Pruned vocabulary with idf, as a written table of bounded size."""
    vocab = written(
        sparse.with_idf(sparse.prune_vocabulary(freq, n_docs, params), n_docs), "vocab"
    )
    return vocab, vocab.count()


def fit_with_fallback(
    freq: DataFrame, n_docs: int, params: SparseParams
) -> tuple[SparseParams, DataFrame, int]:
    """Settings and vocabulary; when the bounds leave no term, they are dropped."""
    fitted = params.for_corpus(n_docs)
    vocab, rows = fit_vocabulary(freq, n_docs, fitted)
    if rows == 0 and n_docs > 0:
        fitted = fitted.permissive()
        vocab, rows = fit_vocabulary(freq, n_docs, fitted)
    return fitted, vocab, rows


def index_from_tokens(
    tokenised: DataFrame, params: SparseParams
) -> SparseIndex:
    """Vocabulary and postings over tokenised documents.

    When pruning leaves no term, the bounds are dropped; when that leaves none
    either, the simplest analyser is used.
    """
    n_docs = tokenised.count()
    freq = written(sparse.vocabulary_statistics(
        tokenised, n_docs, params.for_corpus(n_docs))[0], "freq")
    fitted, vocab, rows = fit_with_fallback(freq, n_docs, params)
    if rows == 0 and n_docs > 0:
        fitted = fitted.last_resort(n_docs)
        tokenised = written(sparse.with_tokens(tokenised, fitted), "docs")
        vocab, rows = fit_vocabulary(
            written(sparse.vocabulary_statistics(tokenised, n_docs, fitted)[0], "freq"), n_docs, fitted
        )
    postings = sparse.tfidf_weights(tokenised, vocab, fitted, rows)
    return SparseIndex(tokenised, vocab, postings, n_docs, rows, fitted)


def build_sparse_index(docs: DataFrame, params: SparseParams = SparseParams()) -> SparseIndex:
    """Index a batch of documents. Raw text is read and cleaned once; the
    vocabulary and the postings are made from the written tokens."""
    return index_from_tokens(written(tokenised_documents(docs, params), "docs"), params)


def build_dense_index(
    docs: DataFrame, vectors: DataFrame, n_clusters: int | None = None, seed: int = 0,
    centres: np.ndarray | None = None,
) -> DenseIndex:
    """Index given vectors (``doc_id, embedding``) of the documents.

    With ``n_clusters`` the vectors are clustered; a table of fewer than twice
    as many rows stays flat. With ``centres`` each vector joins the nearest of them
    and nothing is trained. Documents without a vector are not found by vector.
    """
    if n_clusters is not None and centres is not None:
        raise ValueError("give n_clusters or centres, not both")
    unit = with_batch(vectors).filter("embedding is not null").withColumn(
        "embedding", normalise("embedding"))
    unit = written(unit.select("doc_id", "batch_id", "embedding"), "vectors")
    shape = unit.agg(
        F.count("*").alias("n"), F.coalesce(F.max(F.size("embedding")), F.lit(0)).alias("d")
    ).first()
    if centres is not None and len(centres):
        unit = dense.nearest_clusters(unit, centres, 1).withColumn(
            "cluster_id", F.col("clusters")[0]).drop("clusters")
    elif n_clusters is not None:
        model = dense.train_clusters(unit, n_clusters, seed)
        if model is not None:
            unit = dense.assign_clusters(unit, model)
            centres = np.array(model.clusterCenters())
    if centres is not None and not len(centres):
        centres = None
    return DenseIndex(with_batch(docs), unit, shape["n"], shape["d"], centres)

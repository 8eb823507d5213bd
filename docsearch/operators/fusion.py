"""Fusion of a sparse and a dense ranked list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsearch import fixed_values as V


def fusion_join(sparse: DataFrame, dense: DataFrame) -> DataFrame:
    """Align two ranked lists on (query, document).

    Both lists hold ``query_id, doc_id, batch_id, score, position``. A missing
    side is null. ``batch_id`` is that of the sparse row where there is one, for
    its document is then shown; otherwise that of the dense row. Written as a
    union and one aggregation: one shuffle, with partial sums before it.
    """
    def side(hits: DataFrame, name: str, other: str) -> DataFrame:
        nothing = F.lit(None)
        return hits.select(
            "query_id", "doc_id",
            F.col("batch_id").alias(f"{name}_batch"), nothing.cast("bigint").alias(f"{other}_batch"),
            F.col("score").alias(f"{name}_score"),
            F.col("position").cast("int").alias(f"{name}_rank"),
            nothing.cast("double").alias(f"{other}_score"),
            nothing.cast("int").alias(f"{other}_rank"),
        )

    both = side(sparse, "sparse", "dense").unionByName(side(dense, "dense", "sparse"))
    return both.groupBy("query_id", "doc_id").agg(
        F.coalesce(
            F.max_by("sparse_batch", "sparse_rank"), F.max_by("dense_batch", "dense_rank")
        ).alias("batch_id"),
        F.min("sparse_score").alias("sparse_score"),
        F.max("sparse_rank").alias("sparse_rank"),
        F.min("dense_score").alias("dense_score"),
        F.max("dense_rank").alias("dense_rank"),
    )


def union_candidates(sparse: DataFrame, dense: DataFrame) -> DataFrame:
    """Distinct (query, document) pairs of two lists."""
    keys = ["query_id", "doc_id"]
    return sparse.select(*keys).union(dense.select(*keys)).distinct()


def weighted(sparse_weight: float = V.SPARSE_WEIGHT, dense_weight: float = V.DENSE_WEIGHT) -> Column:
    zero = F.lit(0.0)
    return (
        sparse_weight * F.coalesce("sparse_score", zero)
        + dense_weight * F.coalesce("dense_score", zero)
    )


def maximum() -> Column:
    zero = F.lit(0.0)
    return F.greatest(F.coalesce("sparse_score", zero), F.coalesce("dense_score", zero))


def reciprocal_rank(k: int = V.RRF_K) -> Column:
    """Sum of reciprocal ranks; a missing document ranks just behind the list."""
    per_query = Window.partitionBy("query_id")

    def share(rank: str) -> Column:
        length = F.coalesce(F.max(rank).over(per_query), F.lit(0))
        return 1.0 / (k + F.coalesce(F.col(rank), length + 1))

    return share("sparse_rank") + share("dense_rank")


def fuse(
    sparse: DataFrame,
    dense: DataFrame,
    method: str = "weighted_sum",
    sparse_weight: float = V.SPARSE_WEIGHT,
    dense_weight: float = V.DENSE_WEIGHT,
) -> DataFrame:
    """One score per (query, document). An unknown method means the weighted sum."""
    joined = fusion_join(sparse, dense)
    if method == "max":
        score = maximum()
    elif method == "rank_fusion":
        score = reciprocal_rank()
    else:
        score = weighted(sparse_weight, dense_weight)
    return joined.withColumn("score", F.round(score, 12)).select(
        "query_id", "doc_id", "batch_id", "score",
        F.col("sparse_rank").isNotNull().alias("in_sparse"),
    )

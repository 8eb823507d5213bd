"""Statistics of indexes, searches and results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docsearch import fixed_values as V
from docsearch.runtime import written


def sparse_index_stats(docs: DataFrame, vocab: DataFrame, max_features: int, min_df: int,
                       max_df: float, ngram_range: tuple[int, int]) -> DataFrame:
    """One row: documents, vocabulary size, fitted flag, settings."""
    counts = docs.agg(F.count("*").alias("total_documents")).unionByName(
        vocab.agg(F.count("*").alias("vocabulary_size")), allowMissingColumns=True
    )
    return _one_row(counts, "total_documents", "vocabulary_size").select(
        "*",
        (F.col("total_documents") > 0).alias("is_fitted"),
        F.lit(max_features).alias("max_features"), F.lit(min_df).alias("min_df"),
        F.lit(max_df).alias("max_df"),
        F.lit(ngram_range[0]).alias("ngram_low"), F.lit(ngram_range[1]).alias("ngram_high"),
    )


def dense_index_stats(docs: DataFrame, vectors: DataFrame) -> DataFrame:
    """One row: documents, vectors held, dimension, fitted flag."""
    counts = docs.agg(F.count("*").alias("total_documents")).unionByName(
        vectors.agg(
            F.count("*").alias("vectors_held"),
            F.coalesce(F.max(F.size("embedding")), F.lit(0)).alias("vector_dimension"),
        ),
        allowMissingColumns=True,
    )
    return _one_row(counts, "total_documents", "vectors_held", "vector_dimension").withColumn(
        "is_fitted", F.col("vectors_held") > 0
    )


def _one_row(parts: DataFrame, *columns: str) -> DataFrame:
    """Fold one-row parts, stacked with nulls, into a single row."""
    return parts.agg(*[F.max(c).alias(c) for c in columns])


def index_ready(sparse_stats: DataFrame | None, dense_stats: DataFrame | None) -> DataFrame:
    """Per index: available and ready; overall ready follows the sparse index.

    An index that there is not has no statistics: it is neither.
    """
    given = sparse_stats if sparse_stats is not None else dense_stats
    if given is None:
        raise ValueError("at least one index is needed")

    def ready(stats: DataFrame | None, name: str) -> DataFrame:
        if stats is None:
            return given.limit(1).select(F.lit(False).alias(name))
        return stats.select(F.col("is_fitted").alias(name))

    parts = ready(sparse_stats, "tfidf_ready").unionByName(
        ready(dense_stats, "transformer_ready"), allowMissingColumns=True)
    return _one_row(parts, "tfidf_ready", "transformer_ready").select(
        F.lit(sparse_stats is not None).alias("tfidf_available"), "tfidf_ready",
        F.lit(dense_stats is not None).alias("transformer_available"), "transformer_ready",
        F.col("tfidf_ready").alias("ready"),
    )


def engine_stats(
    sparse_stats: DataFrame, dense_stats: DataFrame, search_log: DataFrame,
    similarity_threshold: float = V.SIMILARITY_THRESHOLD, fusion_method: str = "weighted_sum",
    sparse_weight: float = V.SPARSE_WEIGHT, dense_weight: float = V.DENSE_WEIGHT,
    modes: Sequence[str] = ("tfidf", "transformer", "hybrid"),
) -> DataFrame:
    """One row: search counters in total and for each mode, both indexes, settings in use."""
    counters = {f"{m}_searches": F.count_if(F.col("mode") == m) for m in modes}
    searches = search_log.agg(
        F.count("*").alias("total_searches"), F.avg("seconds").alias("avg_search_time"),
        *[c.alias(name) for name, c in counters.items()],
    )
    parts = (
        sparse_stats.select("total_documents", "vocabulary_size")
        .unionByName(dense_stats.select("vectors_held", "vector_dimension"),
                     allowMissingColumns=True)
        .unionByName(searches, allowMissingColumns=True)
    )
    return _one_row(
        parts, "total_documents", "vocabulary_size", "vectors_held", "vector_dimension",
        "total_searches", "avg_search_time", *counters,
    ).select(
        "*", F.lit(similarity_threshold).alias("similarity_threshold"),
        F.lit(fusion_method).alias("fusion_method"),
        F.lit(sparse_weight).alias("tfidf_weight"),
        F.lit(dense_weight).alias("transformer_weight"),
    )


# --- search log -----------------------------------------------------------------


def search_stats(search_log: DataFrame) -> DataFrame:
    """Searches and average time per mode; the row without a mode is the total."""
    return search_log.rollup("mode").agg(
        F.count("*").alias("searches"), F.avg("seconds").alias("avg_seconds")
    )


def rolling_search_time(
    search_log: DataFrame, order: Sequence[str] = ("ts",), by: Sequence[str] = ()
) -> DataFrame:
    """Add ``searches_so_far`` and ``avg_so_far`` after each search, in order.

    A running mean needs the whole order. The log is range-partitioned by that
    order and written with its part number; each part is summed, the sums of
    the parts before it are added, and only these few totals meet in one task.
    One mode, or no split at all, is thus spread over all tasks.
    """
    by, order = list(by), list(order)
    parted = written(
        search_log.repartitionByRange(*by, *order)
        .withColumn("_part", F.spark_partition_id()),
        "search_log",
    )
    totals = parted.groupBy(*by, "_part").agg(
        F.count("*").alias("_n"), F.sum("seconds").alias("_s")
    )
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_s").over(before), F.lit(0.0)).alias("_s0"),
    )
    inside = Window.partitionBy(*by, "_part").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    running = parted.withColumns({
        "_n": F.count("*").over(inside), "_s": F.sum("seconds").over(inside),
    })
    return (
        running.join(offsets, [*by, "_part"])
        .withColumn("searches_so_far", F.col("_n0") + F.col("_n"))
        .withColumn("avg_so_far", (F.col("_s0") + F.col("_s")) / F.col("searches_so_far"))
        .drop("_part", "_n", "_s", "_n0", "_s0")
    )


def latency_summary(
    search_log: DataFrame, modes: Sequence[str], slow: str, fast: str
) -> DataFrame:
    """Mean, least and greatest seconds per query and mode, and how many times
    slower the mean of one mode is than that of another."""
    measured = search_log.groupBy("query").pivot("mode", list(modes)).agg(
        F.avg("seconds").alias("avg"), F.min("seconds").alias("min"),
        F.max("seconds").alias("max"),
    )
    return measured.withColumn("ratio", F.col(f"{slow}_avg") / F.col(f"{fast}_avg"))


# --- results --------------------------------------------------------------------


def threshold_sweep(
    results: DataFrame, queries: DataFrame, thresholds: Sequence[float] = V.SWEEP_THRESHOLDS
) -> DataFrame:
    """Result count and score range of each query at each threshold.

    ``results`` are those of the lowest threshold, cut at ``max_results``: the
    best rows above a higher threshold are a part of them. A query that was run
    at a higher threshold than the lowest step is an error.
    """
    if not queries.filter(F.col("similarity_threshold") > float(min(thresholds))).isEmpty():
        raise ValueError(f"results must be made at a threshold of {min(thresholds)} or less")
    steps = F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("threshold")
    wanted = queries.select("query_id", steps)
    reached = (
        results.select("query_id", "score", steps)
        .filter(F.col("score") >= F.col("threshold"))
        .groupBy("query_id", "threshold")
        .agg(
            F.count("*").alias("n_results"), F.avg("score").alias("avg_score"),
            F.min("score").alias("min_score"), F.max("score").alias("max_score"),
        )
    )
    return wanted.join(reached, ["query_id", "threshold"], "left").withColumn(
        "n_results", F.coalesce("n_results", F.lit(0))
    )


def compare_modes(results: DataFrame, top: int = 5) -> DataFrame:
    """Per query and mode: number of results and the best scores, in order."""
    best = F.collect_list(F.when(F.col("_place") <= top, F.struct("_place", "score")))
    place = F.row_number().over(
        Window.partitionBy("query_id", "search_mode").orderBy("rank")
    )
    return (
        results.select("query_id", "search_mode", "rank", "score")
        .withColumn("_place", place)
        .groupBy("query_id", "search_mode")
        .agg(
            F.count("*").alias("results_count"),
            F.transform(F.array_sort(best), lambda r: r["score"]).alias("top_scores"),
        )
    )


def doc_type_counts(docs: DataFrame) -> DataFrame:
    """Documents per type; the row without a type is the total."""
    return docs.rollup("doc_type").agg(F.count("*").alias("n_docs"))

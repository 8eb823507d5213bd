"""Dense (embedding) vectors: encoding, exact and clustered nearest neighbours.

A vector table has the columns ``doc_id, batch_id, embedding`` with embeddings
of length one, and ``cluster_id`` once it is clustered. Scores are inner
products, summed in double precision in NumPy blocks inside the tasks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector, predict_batch_udf
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsearch import fixed_values as V
from docsearch.functions import text as X
from docsearch.functions.vectors import normalise
from docsearch.operators import kernels
from docsearch.runtime import new_folder

# About so many query vectors are sent to every task at a time.
QUERIES_IN_MEMORY = 4_096
# Given centres are held by the driver and sent to every task.
MAX_CENTRES = 65_536


# --- encoding -----------------------------------------------------------------


def embed(
    df: DataFrame, text: Column, make_encoder: Callable[[], Callable], batch_size: int = 256
) -> DataFrame:
    """Add ``embedding``: the given text encoded by the user's encoder.

    ``make_encoder`` runs once per Python worker and returns a function from a
    NumPy array of texts to a matrix with one row per text.
    """
    encode = predict_batch_udf(
        make_encoder, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size
    )
    return df.withColumn("embedding", encode(text))


def embed_documents(
    docs: DataFrame, make_encoder: Callable[[], Callable], batch_size: int = 256
) -> DataFrame:
    return embed(
        docs, X.embedding_text("content", "doc_type", "entity_id"), make_encoder, batch_size
    )


def embed_queries(
    queries: DataFrame, make_encoder: Callable[[], Callable], batch_size: int = 256
) -> DataFrame:
    return embed(queries, X.query_embedding_text("text"), make_encoder, batch_size)


def normalise_vectors(vectors: DataFrame) -> DataFrame:
    return vectors.withColumn("embedding", normalise("embedding"))


def new_vectors(docs: DataFrame, cached: DataFrame) -> DataFrame:
    """Documents whose vector is not held yet; only these need encoding.

    Documents with a batch are told apart by id and batch.
    """
    keys = [c for c in ("doc_id", "batch_id") if c in docs.columns and c in cached.columns]
    return docs.join(cached.select(*keys), keys, "left_anti")


# --- scoring ---------------------------------------------------------------------


def _score_by_broadcast(
    vectors: DataFrame, query_rows: list, n_clusters: int | None
) -> DataFrame:
    """Score every partition of ``vectors`` against a small query matrix."""
    query_ids = [r["query_id"] for r in query_rows]
    matrix = np.array([r["embedding"] for r in query_rows], dtype=np.float64)
    thresholds = [r["similarity_threshold"] for r in query_rows]
    ks = [r["k"] for r in query_rows]
    probes = None
    if n_clusters is not None:
        probes = np.zeros((len(query_rows), n_clusters), dtype=bool)
        for i, r in enumerate(query_rows):
            probes[i, r["clusters"]] = True

    wanted = ["doc_id", "batch_id", "embedding"] + ([] if probes is None else ["cluster_id"])
    return vectors.select(*wanted).mapInArrow(
        kernels.batch_scorer(query_ids, matrix, thresholds, ks, probes), kernels.HITS
    )


def _in_passes(
    queries: DataFrame, n_queries: int, score: Callable[[list], DataFrame]
) -> DataFrame:
    """Hits of any number of queries, a bounded pass of them at a time.

    Each pass sends its queries to one scan of the vectors, so vectors are
    never shuffled. When there are several, the hits of each are written before
    the next begins, and the driver holds the queries of one pass only.
    """
    passes = -(-n_queries // QUERIES_IN_MEMORY)
    if passes <= 1:
        return score(queries.collect())
    spark = queries.sparkSession
    dealt, found = new_folder(spark, "query_passes"), new_folder(spark, "hits")
    queries.withColumn("_pass", F.pmod(F.hash("query_id"), F.lit(passes))).write.partitionBy(
        "_pass").parquet(dealt)
    for n in range(passes):
        rows = spark.read.parquet(dealt).filter(F.col("_pass") == n).drop("_pass").collect()
        if rows or n == 0:
            score(rows).write.mode("append").parquet(found)
    return spark.read.schema(kernels.HITS).parquet(found)


# --- searches -----------------------------------------------------------------


def score_dense(vectors: DataFrame, queries: DataFrame, n_queries: int) -> DataFrame:
    """Inner products at or above each query's threshold: the candidates of its
    first ``k`` rows, cut inside each task before anything is shuffled.

    ``queries`` holds ``query_id, embedding, similarity_threshold, k``.
    """
    wanted = queries.select("query_id", "embedding", "similarity_threshold", "k")
    return _in_passes(
        wanted, n_queries, lambda rows: _score_by_broadcast(vectors, rows, None))


def train_clusters(
    vectors: DataFrame, n_clusters: int = V.IVF_CLUSTERS, seed: int = 0
) -> KMeansModel | None:
    """Cluster centres, trained on all vectors; none for a table of fewer than twice
    as many rows, which stays flat (``DenseIndex.clustered`` tells)."""
    n = vectors.count()
    if n < 2 * n_clusters:
        return None
    points = vectors.select(array_to_vector("embedding").alias("features"))
    return KMeans(k=n_clusters, seed=seed, featuresCol="features").fit(points)


def centres_of_groups(vectors: DataFrame, group: str) -> np.ndarray:
    """Given centres: the mean of the unit vectors of each group, in order of the group.

    Rows without a group or a vector are left out.
    """
    means = vectors.filter(F.col(group).isNotNull() & F.col("embedding").isNotNull()).groupBy(
        group).agg(Summarizer.mean(array_to_vector(normalise("embedding"))).alias("centre"))
    rows = means.orderBy(group).limit(MAX_CENTRES + 1).collect()
    if len(rows) > MAX_CENTRES:
        raise ValueError(f"more than {MAX_CENTRES} groups to make centres of")
    return np.array([r["centre"].toArray() for r in rows])


def assign_clusters(vectors: DataFrame, model: KMeansModel) -> DataFrame:
    with_features = vectors.withColumn("features", array_to_vector("embedding"))
    return (
        model.setPredictionCol("cluster_id").transform(with_features).drop("features")
    )


def nearest_clusters(queries: DataFrame, centres: np.ndarray, n_probe: int) -> DataFrame:
    """Add ``clusters``: the ``n_probe`` clusters nearest to each query vector."""
    schema = T.StructType([
        *queries.schema.fields, T.StructField("clusters", T.ArrayType(T.IntegerType()))
    ])
    return queries.mapInPandas(kernels.cluster_prober(centres, n_probe), schema)


def score_ivf(
    clustered: DataFrame, queries: DataFrame, centres: np.ndarray, n_probe: int, n_queries: int
) -> DataFrame:
    """Scores of the vectors in the clusters nearest to each query.

    Only the probed clusters are read; with a table partitioned by
    ``cluster_id`` the others are never opened. A vector is multiplied with the
    queries that probe its cluster, not with all.
    """
    probed = nearest_clusters(queries, centres, n_probe)

    def score(rows: list) -> DataFrame:
        wanted = sorted({c for r in rows for c in r["clusters"]})
        return _score_by_broadcast(
            clustered.filter(F.col("cluster_id").isin(*wanted)), rows, len(centres))

    return _in_passes(probed, n_queries, score)

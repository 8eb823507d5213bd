"""The test tables in the shape of the document model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import settings as S
from docsearch import fixed_values as V
from docsearch.operators import dense
from docsearch.plans import index as I
from docsearch.runtime import new_folder
from docsearch.schema import SparseParams
from docsearch.sources.index_store import DenseStore, SparseStore

PARAMS = SparseParams(stop_words=S.STOP_WORDS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _string(c: str) -> Column:
    return F.col(c).cast("string")


def nth_type(number: Column) -> Column:
    types = F.array(*[F.lit(t) for t in V.DOC_TYPES])
    return F.get(types, (number % len(V.DOC_TYPES)).cast("int"))


def days_before(number: Column) -> Column:
    start = F.to_date(F.lit("2024-01-01"))
    return F.date_sub(start, (number % 365).cast("int")).cast("timestamp_ntz")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        _string("doc_id").alias("doc_id"), F.col("text").alias("content"),
        F.col("source").alias("entity_id"), nth_type(F.col("doc_id")).alias("doc_type"),
        days_before(F.col("doc_id")).alias("date"),
        F.to_variant_object(F.struct("lang", "n_chars")).alias("metadata"),
    )


def benchmark_queries(
    spark: SparkSession, sf_dir: str, threshold: float = 0.05, max_results: int = 10,
    filtered: bool = True,
) -> DataFrame:
    """One query per benchmark text, with filters that follow from its number."""
    n = F.col("item_id")

    def when(condition: Column, value: Column) -> Column:
        return F.when(condition, value) if filtered else F.when(F.lit(False), value)

    sources = F.array(*[
        F.concat(F.lit("src"), ((n + step) % 20).cast("string")) for step in (0, 3, 7, 11, 13)
    ])
    types = F.array(*[F.lit(t) for t in V.FINANCIAL_DOC_TYPES])
    return table(spark, sf_dir, "benchmark").select(
        _string("item_id").alias("query_id"), "text",
        when(n % 2 == 0, sources).alias("entity_ids"),
        when(n % 3 == 0, types).alias("doc_types"),
        when(n % 5 == 0, F.lit("2023-04-01 00:00:00").cast("timestamp_ntz")).alias("date_from"),
        when(n % 4 == 0, F.lit("2023-12-01 00:00:00").cast("timestamp_ntz")).alias("date_to"),
        F.lit(threshold).alias("similarity_threshold"), F.lit(max_results).alias("max_results"),
    )


def with_vectors(queries: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query vectors: the embedding whose number is that of the query, if there is one."""
    vectors = table(spark, sf_dir, "embeddings").select(
        _string("vec_id").alias("query_id"), "embedding"
    )
    return queries.join(vectors, "query_id", "left")


def label_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One vector query per label: the first vector of the label."""
    return table(spark, sf_dir, "embeddings").groupBy("label").agg(
        F.min_by("embedding", "vec_id").alias("embedding")
    ).select(_string("label").alias("query_id"), "embedding")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        _string("vec_id").alias("doc_id"), "embedding"
    )


def conversation_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query per conversation turn; some break the rules."""
    n, turn = F.col("conv_id"), F.col("turn")
    day = F.date_add(F.to_date(F.lit("2023-06-01")), (n % 60).cast("int"))
    return table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", _string("conv_id"), _string("turn")).alias("query_id"),
        F.when((n + turn) % 7 == 0, F.lit(" \n ")).otherwise(
            F.concat(F.lit("  "), F.col("text"), F.lit("\n"))).alias("text"),
        F.when(n % 4 == 0, F.array(F.lit("src1"), F.lit("src1"), F.lit(" ")))
        .when(n % 4 == 1, F.array(F.lit("src2"), F.lit("src3"), F.lit("src2")))
        .when(n % 4 == 2, F.array().cast("array<string>")).alias("entity_ids"),
        F.when(n % 5 == 0, F.array(F.lit("invoice"), F.lit("Invoice")))
        .when(n % 5 == 1, F.array(F.lit("receipt"), F.lit("receipt"))).alias("doc_types"),
        day.cast("timestamp_ntz").alias("date_from"),
        F.date_add(day, (turn * 10 - 20).cast("int")).cast("timestamp_ntz").alias("date_to"),
        ((n % 13) / 10.0).alias("similarity_threshold"),
        ((n * 97) % 1201 - 20).cast("int").alias("max_results"),
    )


def search_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", F.col("event_type").alias("mode"),
        _string("user_id").alias("query"), F.col("value").alias("seconds"),
    )


# --- stored indexes, built once per session and data set -------------------------

_built: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def sparse_index(spark: SparkSession, sf_dir: str) -> I.SparseIndex:
    def build():
        store = SparseStore(spark, new_folder(spark, "sparse"), PARAMS)
        store.append(documents(spark, sf_dir), batch_id=0)
        return store.refresh()
    return _once(spark, sf_dir, "sparse", build)


def dense_index(spark: SparkSession, sf_dir: str) -> I.DenseIndex:
    def build():
        store = DenseStore(spark, new_folder(spark, "dense"))
        return store.save(I.build_dense_index(documents(spark, sf_dir), vectors(spark, sf_dir)))
    return _once(spark, sf_dir, "dense", build)


def label_centres_index(spark: SparkSession, sf_dir: str) -> I.DenseIndex:
    """Stored vectors in clusters around given centres: the mean vector of each label."""
    def build():
        centres = dense.centres_of_groups(table(spark, sf_dir, "embeddings"), "label")
        store = DenseStore(spark, new_folder(spark, "by_label"))
        return store.save(I.build_dense_index(
            documents(spark, sf_dir), vectors(spark, sf_dir), centres=centres))
    return _once(spark, sf_dir, "by_label", build)


def clustered_index(spark: SparkSession, sf_dir: str, n_clusters: int = 16) -> I.DenseIndex:
    def build():
        store = DenseStore(spark, new_folder(spark, "clustered"))
        return store.save(I.build_dense_index(
            documents(spark, sf_dir), vectors(spark, sf_dir), n_clusters
        ))
    return _once(spark, sf_dir, "clustered", build)

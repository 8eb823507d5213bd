"""Incremental ingest: batches of documents that arrive one after another."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docsearch.operators import validate
from docsearch.plans.index import DenseIndex, SparseIndex
from docsearch.runtime import written
from docsearch.schema import DOCS
from docsearch.sources.index_store import HybridStore, SparseStore


def read_document_stream(
    spark: SparkSession, path: str, files_per_trigger: int | None = None, schema=DOCS
) -> DataFrame:
    """Documents that arrive as Parquet files in a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def checked_batch(docs: DataFrame, as_of_year: int) -> DataFrame:
    """The rows of a batch with ``errors``, empty for a valid row.

    An id that occurs more than once in the batch is ambiguous, so all its rows
    are refused.
    """
    repeated = validate.duplicate_ids(docs).select("doc_id", F.lit(True).alias("_repeated"))
    marked = validate.validate_documents(docs, as_of_year).join(repeated, "doc_id", "left")
    return marked.withColumn("errors", F.when(
        F.col("_repeated"), F.array_append("errors", F.lit("document id is repeated in the batch"))
    ).otherwise(F.col("errors"))).drop("_repeated")


def add_batch(
    store: SparseStore, docs: DataFrame, as_of_year: int, batch_id: int | None = None,
    key: str | None = None, limit: int | None = None, strict: bool = False,
) -> int:
    """Validate one batch, store its valid rows and keep the others with reasons.

    An empty batch, one above ``limit`` rows, and with ``strict`` one that holds
    an invalid row are errors, and nothing is stored. Returns the batch number.
    """
    checked = written(checked_batch(docs, as_of_year), "checked")
    guard = validate.batch_guard(checked, limit=limit).first()
    if not guard["accepted"]:
        raise ValueError(f"a batch of {guard['n_docs']} documents is refused")
    rejects = checked.filter(F.size("errors") > 0)
    if strict and not rejects.isEmpty():
        raise ValueError(f"the batch holds invalid documents: {rejects.first()['errors']}")
    batch_id = store.append(checked.filter(F.size("errors") == 0).drop("errors"), batch_id, key)
    store.write_rejects(rejects.select("doc_id", "entity_id", "doc_type", "date", "errors"),
                        batch_id)
    return batch_id


def add_documents(
    store: HybridStore, docs: DataFrame, as_of_year: int,
    vectors: Callable[[DataFrame], DataFrame], key: str | None = None, limit: int | None = None,
    strict: bool = False,
) -> tuple[SparseIndex, DenseIndex]:
    """Add one batch to both indexes: validated once, cleaned for keywords, as it came for vectors.

    ``vectors`` makes ``doc_id, batch_id, embedding`` of documents; it is asked only for those
    whose vector is not held. Refused rows are kept as in ``add_batch``. Both indexes
    become searchable together; a failure on the way leaves both as they were, and
    the batch can come again under its key.
    """
    batch_id = add_batch(store.sparse, docs, as_of_year, key=key, limit=limit, strict=strict)
    refused = store.sparse.rejects().filter(F.col("batch_id") == batch_id).select("doc_id")
    valid = docs.join(refused, docs["doc_id"].eqNullSafe(refused["doc_id"]), "left_anti")
    sparse_version = store.sparse.publish()
    dense_version = store.dense.append_version(
        valid.withColumn("batch_id", F.lit(batch_id).cast("bigint")), vectors)
    store.publish(sparse_version, dense_version)
    return store.load()


def incremental_ingest(
    stream: DataFrame, store: SparseStore, checkpoint: str, as_of_year: int,
    refresh_every: int = 1, strict: bool = False, source: str | None = None,
) -> StreamingQuery:
    """Validate and store each batch; make the index searchable every
    ``refresh_every`` batches, and once more at the end.

    Invalid rows go to the rejects of the store. With ``strict`` a batch that holds
    one is an error and stops the stream.

    The key of a batch is the name of the ``source`` (the checkpoint folder, if none
    is given) with its epoch, and the store numbers the batches. So a batch that is
    run again after a failure replaces its own rows, and no stream overwrites what
    was stored by others. Weights depend on the whole corpus, so no watermark
    applies; with many small batches, refresh less often. Returns when the files
    at hand are done and searchable.
    """
    source = checkpoint if source is None else source
    waiting: list[int] = []

    def ingest(batch: DataFrame, epoch: int) -> None:
        if batch.isEmpty():
            return
        waiting.append(add_batch(store, batch, as_of_year, key=f"{source}/{epoch}", strict=strict))
        if len(waiting) >= refresh_every:
            store.publish()
            waiting.clear()

    query = (
        stream.writeStream.foreachBatch(ingest)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # Also what an earlier run stored and did not get to refresh.
    if waiting or not store.is_current():
        store.publish()
    return query

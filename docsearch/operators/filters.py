"""Metadata filters and per-query cuts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsearch import fixed_values as V
from docsearch.runtime import broadcast_if

_SLOTS = 64
QUERY_FILTERS = ("entity_ids", "doc_types", "date_from", "date_to")


def _in_set(value: Column, allowed: Column) -> Column:
    """Null and empty sets allow everything."""
    return allowed.isNull() | (F.size(allowed) == 0) | F.array_contains(allowed, value)


# --- one query: literal values, pushed down to the scan ----------------------


def filter_entity(docs: DataFrame, entity_ids: Iterable[str] | None) -> DataFrame:
    wanted = list(entity_ids or ())
    return docs.filter(F.col("entity_id").isin(*wanted)) if wanted else docs


def filter_doc_type(docs: DataFrame, doc_types: Iterable[str] | None) -> DataFrame:
    wanted = list(doc_types or ())
    return docs.filter(F.col("doc_type").isin(*wanted)) if wanted else docs


def filter_date_range(docs: DataFrame, date_from=None, date_to=None) -> DataFrame:
    """Both ends are inclusive and optional."""
    if date_from is not None:
        docs = docs.filter(F.col("date") >= F.lit(date_from).cast("timestamp_ntz"))
    if date_to is not None:
        docs = docs.filter(F.col("date") <= F.lit(date_to).cast("timestamp_ntz"))
    return docs


# --- many queries: filter columns on the joined row ---------------------------


def passes_filters() -> Column:
    """The three query filters against the document columns of the same row."""
    date = F.col("date")
    return (
        _in_set(F.col("entity_id"), F.col("entity_ids"))
        & _in_set(F.col("doc_type"), F.col("doc_types"))
        & (F.col("date_from").isNull() | (date >= F.col("date_from")))
        & (F.col("date_to").isNull() | (date <= F.col("date_to")))
    )


def query_filter_join(
    hits: DataFrame, queries: DataFrame, docs: DataFrame, n_queries: int, n_hits: int
) -> DataFrame:
    """Keep the hits whose document passes the filters of its own query.

    ``docs`` brings the columns it holds to the result. The side sizes are
    upper bounds; a side is broadcast only below the checked bound.
    """
    keys = [k for k in ("doc_id", "batch_id", "doc_bucket")
            if k in hits.columns and k in docs.columns]
    with_filters = hits.join(
        broadcast_if(queries.select("query_id", *QUERY_FILTERS), n_queries), "query_id"
    )
    return (
        docs.join(broadcast_if(with_filters, n_hits), keys)
        .filter(passes_filters())
        .drop(*QUERY_FILTERS)
    )


# --- cuts ---------------------------------------------------------------------


def filter_threshold(hits: DataFrame) -> DataFrame:
    """Keep hits that reach the threshold of their query."""
    return hits.filter(F.col("score") >= F.col("similarity_threshold"))


def by_score(hits: DataFrame) -> list[Column]:
    """Best score first; ties by document id."""
    order = [F.desc("score"), F.asc("doc_id")]
    return order + ([F.asc("batch_id")] if "batch_id" in hits.columns else [])


def top_per_query(
    hits: DataFrame, factor: int, max_results: int, position: str = "position"
) -> DataFrame:
    """First ``factor * max_results`` hits of each query, numbered from 1.

    ``max_results`` is the largest value of the query table. As a literal limit
    it lets Spark cut each map task's rows before the shuffle on query_id, so a
    query that matches a third of the corpus sends only its best rows on. Where
    the limit is above what Spark cuts early, the cut is made in two steps over
    slots of each query.
    """
    order = by_score(hits)
    limit = factor * max_results
    own_limit = F.col("max_results") * factor
    early = int(hits.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if limit > early:
        slots = Window.partitionBy("query_id", "_slot").orderBy(*order)
        hits = (
            hits.withColumn("_slot", F.pmod(F.xxhash64("doc_id"), F.lit(_SLOTS)))
            .withColumn("_place", F.row_number().over(slots))
            .filter(F.col("_place") <= own_limit)
            .drop("_slot", "_place")
        )
    whole = Window.partitionBy("query_id").orderBy(*order)
    return (
        hits.withColumn(position, F.row_number().over(whole))
        .filter((F.col(position) <= limit) & (F.col(position) <= own_limit))
    )


def rank_results(hits: DataFrame) -> DataFrame:
    """Rank 1..n within each query, after the filters."""
    return hits.withColumn("rank", F.row_number().over(
        Window.partitionBy("query_id").orderBy(*by_score(hits))
    ))


def limit_results(results: DataFrame) -> DataFrame:
    """First ``max_results`` of the rows that are left, by rank."""
    return (
        results.withColumn("_place", F.row_number().over(
            Window.partitionBy("query_id").orderBy("rank")
        ))
        .filter(F.col("_place") <= F.col("max_results"))
        .drop("_place")
    )


def with_defaults(queries: DataFrame, default_threshold: float = V.SIMILARITY_THRESHOLD) -> DataFrame:
    """Fill in a missing threshold and a missing result limit."""
    return queries.withColumns({
        "similarity_threshold": F.coalesce("similarity_threshold", F.lit(default_threshold)),
        "max_results": F.coalesce("max_results", F.lit(V.MAX_RESULTS)),
    })

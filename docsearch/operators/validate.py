"""Checks and clean-up of incoming documents, queries and results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsearch import fixed_values as V
from docsearch.functions import text as X


def _errors(*checks: tuple[Column, str]) -> Column:
    """Messages of the checks that fail, in order."""
    return F.array_compact(F.array(*[
        F.when(failed, F.lit(message)) for failed, message in checks
    ]))


def _accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.size("errors") == 0).drop("errors")


# --- documents --------------------------------------------------------------


def validate_documents(docs: DataFrame, as_of_year: int | Column) -> DataFrame:
    """Add ``errors``: the rules each document breaks (empty when valid)."""
    year = F.year("date")
    last_year = (F.lit(as_of_year) if isinstance(as_of_year, int) else as_of_year) + V.YEARS_AHEAD
    return docs.withColumn("errors", _errors(
        (X.is_blank("doc_id"), "document id is required"),
        (X.is_blank("content"), "content is required"),
        (X.is_blank("entity_id"), "entity id is required"),
        (X.parse_doc_type("doc_type").isNull(), "unknown document type"),
        (F.col("date").isNull(), "date is required"),
        ((year < V.FIRST_YEAR) | (year > last_year), "date is out of range"),
    ))


def accepted_documents(docs: DataFrame, as_of_year: int | Column) -> DataFrame:
    return _accepted(validate_documents(docs, as_of_year))


def rejected_documents(docs: DataFrame, as_of_year: int | Column) -> DataFrame:
    return validate_documents(docs, as_of_year).filter(F.size("errors") > 0)


def duplicate_ids(docs: DataFrame) -> DataFrame:
    """Ids that occur more than once, with the number of rows."""
    return (
        docs.groupBy("doc_id").agg(F.count("*").alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def batch_guard(
    docs: DataFrame, batch_column: str | None = None, limit: int | None = None
) -> DataFrame:
    """Size of each batch and whether it may be ingested.

    An empty batch is refused, and one above ``limit`` where a limit is set.
    Without ``batch_column`` the whole input is one batch.
    """
    grouped = docs.groupBy(*([batch_column] if batch_column else []))
    n = F.col("n_docs")
    too_large = n > limit if limit is not None else F.lit(False)
    return (
        grouped.agg(F.count("*").alias("n_docs"))
        .withColumn("is_empty", n == 0)
        .withColumn("too_large", too_large)
        .withColumn("accepted", (n > 0) & ~too_large)
    )


def normalise_documents(docs: DataFrame) -> DataFrame:
    """Strip content and entity id; drop rows left without id, content or entity."""
    stripped = docs.withColumns({
        "content": X.strip("content"), "entity_id": X.strip("entity_id"),
    })
    return stripped.filter(
        (F.length("doc_id") > 0) & (F.length("content") > 0) & (F.length("entity_id") > 0)
    )


def clean_documents(docs: DataFrame) -> DataFrame:
    """Replace content by cleaned content; drop documents left without text.

    Cleaning leaves no text exactly where the raw text has none of the kept
    characters. That test is run first, so nothing is cleaned twice.
    """
    return (
        docs.filter(X.survives_cleaning("content"))
        .withColumn("content", X.clean_text("content"))
    )


# --- queries ----------------------------------------------------------------


def validate_queries(queries: DataFrame) -> DataFrame:
    """Add ``errors``: the rules each query breaks (empty when valid)."""
    threshold, max_results = F.col("similarity_threshold"), F.col("max_results")
    return queries.withColumn("errors", _errors(
        (X.is_blank("text"), "query text is required"),
        (
            threshold.isNull() | ~threshold.between(0.0, 1.0),
            "similarity threshold must be between 0 and 1",
        ),
        (max_results.isNull() | (max_results <= 0), "max results must be positive"),
        (max_results > V.MAX_RESULTS_BOUND, "max results is too large"),
        (
            F.coalesce(F.exists("entity_ids", X.is_blank), F.lit(False)),
            "blank entity id in filter",
        ),
        (
            F.coalesce(
                F.exists("doc_types", lambda t: X.parse_doc_type(t).isNull()), F.lit(False)
            ),
            "unknown document type in filter",
        ),
        (
            F.coalesce(F.col("date_from") > F.col("date_to"), F.lit(False)),
            "date range starts after its end",
        ),
    ))


def accepted_queries(queries: DataFrame) -> DataFrame:
    return _accepted(validate_queries(queries))


def normalise_queries(queries: DataFrame) -> DataFrame:
    """Strip the text; drop queries without text or with settings out of bounds."""
    return (
        queries.withColumn("text", X.strip("text"))
        .filter(F.length("text") > 0)
        .filter(F.col("similarity_threshold").between(0.0, 1.0))
        .filter(F.col("max_results").between(1, V.MAX_RESULTS_BOUND))
    )


def distinct_filters(queries: DataFrame) -> DataFrame:
    """Turn filter lists into sets; an empty list means no filter."""
    def as_set(name: str) -> Column:
        return F.when(F.size(name) > 0, F.array_distinct(name))

    return queries.withColumns({
        "entity_ids": as_set("entity_ids"), "doc_types": as_set("doc_types"),
    })


# --- results ----------------------------------------------------------------


def check_results(results: DataFrame) -> DataFrame:
    """Drop results with a score outside 0..1, no rank or a blank snippet.

    Rounding may lift a cosine just above 1, so the score is clamped first.
    Ranks are kept as they are, so a dropped row leaves a gap. Results of a
    search without snippets have none to check.
    """
    sound = (
        results.withColumn("score", F.least("score", F.lit(1.0)))
        .filter(F.col("score") >= 0.0)
        .filter(F.col("rank") > 0)
    )
    if "context_snippet" not in results.columns:
        return sound
    return sound.filter(~X.is_blank("context_snippet"))

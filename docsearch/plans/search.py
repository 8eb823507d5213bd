"""Searches: a table of queries in, a table of ranked results out."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsearch import fixed_values as V
from docsearch.functions import text as X
from docsearch.functions.vectors import normalise
from docsearch.operators import dense, filters, fusion, sparse, stats, validate
from docsearch.plans.index import DenseIndex, SparseIndex, doc_bucket, index_from_tokens
from docsearch.runtime import BROADCAST_ROWS, broadcast_if, written
from docsearch.schema import QUERIES, REQUEST, SparseParams

# Up to this many distinct query terms are named in the filter of the postings scan, and up
# to this many hits in that of the document scan. Beyond, the join finds them.
PUSHED_TERMS = 200
PUSHED_HITS = 200
# Spark hands lists of this length to Parquet as they are; longer ones become a range.
_PUSHED_LIST = 10

_FILTERED = ("entity_id", "doc_type", "date")
_ATTRIBUTES = ("entity_id", "doc_type", "date", "metadata")


@dataclass(frozen=True)
class QueryBounds:
    """Sizes of a query table, measured once, that bound what is broadcast."""

    n: int
    max_results: int
    n_terms: int
    zero_threshold: bool


def query_bounds(queries: DataFrame) -> QueryBounds:
    row = queries.agg(
        F.count("*").alias("n"),
        F.coalesce(F.max("max_results"), F.lit(0)).alias("k"),
        F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars"),
        F.coalesce(F.min("similarity_threshold") <= 0, F.lit(False)).alias("zero"),
    ).first()
    # A token takes two characters with its gap, and gives at most two terms.
    return QueryBounds(row["n"], row["k"], row["chars"] + row["n"], row["zero"])


# --- requests -----------------------------------------------------------------


def search_text(
    spark, text: str, entity_ids=None, doc_types=None, similarity_threshold=None,
    max_results: int = V.MAX_RESULTS, default_threshold: float = V.SIMILARITY_THRESHOLD,
) -> DataFrame:
    """One query as a one-row table. A threshold of 0 or none is the default."""
    unknown = set(doc_types or ()) - set(V.DOC_TYPES)
    if unknown:
        raise ValueError(f"unknown document types: {sorted(unknown)}")
    row = (
        "q", text, sorted(set(entity_ids)) if entity_ids else None,
        sorted(set(doc_types)) if doc_types else None, None, None,
        float(similarity_threshold or default_threshold), max_results,
    )
    return spark.createDataFrame([row], QUERIES)


def search_requests(requests: DataFrame) -> DataFrame:
    """Queries from JSON requests (columns ``query_id, request``).

    Dates are ISO strings; a missing threshold or limit gets its default. A
    malformed date makes the range unusable: such a request is left out here
    and listed by ``rejected_requests``.
    """
    dates = _dated_requests(requests)
    queries = dates.filter(F.size("errors") == 0).withColumns(
        {"date_from": F.col("_from"), "date_to": F.col("_to")})
    return filters.with_defaults(
        validate.distinct_filters(queries.drop("_from", "_to", "errors")))


def rejected_requests(requests: DataFrame) -> DataFrame:
    """``query_id, errors`` of the requests that can't become queries."""
    return _dated_requests(requests).filter(F.size("errors") > 0).select("query_id", "errors")


def rejected_queries(queries: DataFrame) -> DataFrame:
    """``query_id, errors`` of the queries that a search leaves unanswered."""
    return validate.validate_queries(queries).filter(F.size("errors") > 0).select(
        "query_id", "errors")


def _dated_requests(requests: DataFrame) -> DataFrame:
    parsed = requests.select("query_id", F.from_json("request", REQUEST).alias("r")).select(
        "query_id", "r.*"
    )
    dates = parsed.withColumns({
        "_from": X.parse_iso_date("date_from"), "_to": X.parse_iso_date("date_to"),
    })

    def unreadable(name: str) -> Column:
        return (F.coalesce(f"date_{name}", F.lit("")) != "") & F.col(f"_{name}").isNull()

    return dates.withColumn("errors", F.array_compact(F.array(
        F.when(unreadable("from"), F.lit("unreadable start date")),
        F.when(unreadable("to"), F.lit("unreadable end date")))))


# --- candidates ---------------------------------------------------------------


def _zero_pairs(
    docs: DataFrame, asked: DataFrame, n_queries: int, limit: int, prefilter: bool
) -> DataFrame:
    """Documents that a threshold of zero lets in without any common term, with a score of 0.

    They come last, in id order. Without filters the first ``limit`` ids are all that can
    fill a list up to its cut; with filters every document that passes is a candidate, and
    the cut per query leaves each task its first ones.
    """
    zero = asked.filter(F.col("similarity_threshold") <= 0).withColumn("score", F.lit(0.0))
    if not prefilter:
        first = docs.select(*sparse.DOC_KEY).orderBy(*sparse.DOC_KEY).limit(limit)
        return zero.crossJoin(F.broadcast(first))
    blocks = max(1, -(-n_queries // BROADCAST_ROWS))
    found = None
    for block in range(blocks):
        part = zero.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block)
        pairs = docs.select(*sparse.DOC_KEY, *_FILTERED).join(
            F.broadcast(part), filters.passes_filters())
        found = pairs if found is None else found.unionByName(pairs)
    return found


def _any_of(column: str, values: list) -> Column:
    """Whether the column has one of a few values, so that the scan skips pages without them."""
    lists = [F.col(column).isin(*values[start:start + _PUSHED_LIST])
             for start in range(0, len(values), _PUSHED_LIST)]
    return reduce(Column.__or__, lists, F.lit(False))


def _postings_of(postings: DataFrame, weights: DataFrame) -> DataFrame:
    """Postings of the query terms. Postings stand sorted by term, so the scan reads the pages
    of a few terms; pages of many terms are most of them, and the join with the weights follows."""
    terms = [
        r["term"] for r in weights.select("term").distinct().limit(PUSHED_TERMS + 1).collect()
    ]
    if not terms or len(terms) > PUSHED_TERMS:
        return postings
    return postings.filter(_any_of("term", sorted(terms)))


def sparse_hits(
    index: SparseIndex,
    queries: DataFrame,
    bounds: QueryBounds,
    factor: int = V.SEARCH_OVERFETCH,
    threshold_share: float = 1.0,
    prefilter: bool = False,
) -> DataFrame:
    """First ``factor * max_results`` documents of each query by TF-IDF cosine.

    On a stored index scores, filters and the first cut are made in the bucket of the
    document; one exchange brings the candidates of a query together.
    """
    weights = written(
        sparse.query_weights(queries, index.vocab, index.params, index.vocab_rows),
        "query_weights",
    )
    attributes = _FILTERED if prefilter else ()
    keys = index.docs if index.rows is None else index.rows
    if index.counts is None:
        scored = sparse.score_sparse(_postings_of(index.postings, weights), weights, bounds.n_terms)
        if prefilter:
            scored = scored.join(keys.select(*sparse.DOC_KEY, *attributes), list(sparse.DOC_KEY))
    else:
        scored = sparse.score_counts(
            _postings_of(index.counts, weights), index.rows, weights, bounds.n_terms, attributes)
    asked = queries.select(
        "query_id", (F.col("similarity_threshold") * threshold_share).alias("similarity_threshold"),
        "max_results", *(filters.QUERY_FILTERS if prefilter else ()))
    hits = filters.filter_threshold(scored.join(broadcast_if(asked, bounds.n), "query_id"))
    if prefilter:
        hits = hits.filter(filters.passes_filters())
    wanted = ["query_id", *sparse.DOC_KEY, "score", "max_results"]
    hits = hits.select(*wanted)
    if bounds.zero_threshold:
        # A document of both lists stands first with its score, so twice the limit is enough.
        both = hits.unionByName(_zero_pairs(
            keys, asked, bounds.n, factor * bounds.max_results, prefilter).select(*wanted))
        first = filters.top_per_query(both, 2 * factor, bounds.max_results)
        hits = first.groupBy("query_id", *sparse.DOC_KEY).agg(
            F.max("score").alias("score"), F.max("max_results").alias("max_results"))
    return filters.top_per_query(hits, factor, bounds.max_results)


def dense_hits(
    index: DenseIndex,
    queries: DataFrame,
    bounds: QueryBounds,
    factor: int = V.SEARCH_OVERFETCH,
    threshold_share: float = 1.0,
    n_probe: int | None = None,
) -> DataFrame:
    """First ``factor * max_results`` documents of each query by inner product.

    ``queries`` hold an ``embedding``; those with a null one find nothing here.
    With ``n_probe`` only the nearest clusters are searched, which needs a
    clustered index; otherwise the search is exact.
    """
    if n_probe is not None and not index.clustered:
        raise ValueError("n_probe needs a clustered index; this one is flat")
    unit = queries.filter("embedding is not null").select(
        "query_id", normalise("embedding").alias("embedding"),
        (F.col("similarity_threshold") * threshold_share).alias("similarity_threshold"),
        (F.col("max_results") * factor).alias("k"),
    )
    if n_probe is not None:
        scored = dense.score_ivf(index.vectors, unit, index.centres, n_probe, bounds.n)
    else:
        scored = dense.score_dense(index.vectors, unit, bounds.n)
    limits = broadcast_if(queries.select("query_id", "max_results"), bounds.n)
    return filters.top_per_query(scored.join(limits, "query_id"), factor, bounds.max_results)


def hybrid_hits(
    sparse_index: SparseIndex,
    dense_index: DenseIndex | None,
    queries: DataFrame,
    bounds: QueryBounds,
    method: str = "weighted_sum",
    sparse_weight: float = V.SPARSE_WEIGHT,
    dense_weight: float = V.DENSE_WEIGHT,
    n_probe: int | None = None,
) -> DataFrame:
    """Both searches at half the threshold, fused; the threshold is not applied
    again. Without a dense index its list is empty."""
    left = sparse_hits(
        sparse_index, queries, bounds, V.FUSION_OVERFETCH, V.FUSION_THRESHOLD_SHARE
    )
    if dense_index is None:
        right = left.limit(0)
    else:
        right = dense_hits(
            dense_index, queries, bounds, V.FUSION_OVERFETCH, V.FUSION_THRESHOLD_SHARE, n_probe
        )
    fused = fusion.fuse(left, right, method, sparse_weight, dense_weight)
    limits = broadcast_if(queries.select("query_id", "max_results"), bounds.n)
    return filters.top_per_query(
        fused.join(limits, "query_id"), V.SEARCH_OVERFETCH, bounds.max_results
    )


# --- results ------------------------------------------------------------------


def _named(hits: DataFrame) -> Column:
    """Filter that names the documents of a few hits, and their buckets."""
    rows = hits.select("doc_id", "doc_bucket").distinct().orderBy("doc_id").collect()
    return F.col("doc_bucket").isin(*sorted({r["doc_bucket"] for r in rows})) & _any_of(
        "doc_id", [r["doc_id"] for r in rows])


def hydrate_documents(
    hits: DataFrame, index: SparseIndex | DenseIndex, queries: DataFrame, bounds: QueryBounds,
    content: bool = True,
) -> DataFrame:
    """Bring in the documents of the hits that pass their query's filters.

    Runs after the cut, so the small hit list is sent to the document table and
    not the other way round. Without ``content`` no text is read. For a few hits of a
    stored index the pages that hold them are read, for more the buckets that hold them.
    """
    docs = index.docs if content else index.docs.drop("content")
    if index.doc_buckets:
        hits = hits.withColumn("doc_bucket", doc_bucket("doc_id", index.doc_buckets))
        if bounds.n * bounds.max_results * V.FUSION_OVERFETCH <= PUSHED_HITS:
            hits = written(hits, "hits")
            docs = docs.filter(_named(hits))
    columns = [c for c in (*sparse.DOC_KEY, "doc_bucket", "content", *_ATTRIBUTES)
               if c in docs.columns]
    return filters.query_filter_join(
        hits, queries, docs.select(*columns), bounds.n,
        n_hits=bounds.n * bounds.max_results * V.FUSION_OVERFETCH,
    )


def with_snippets(hits: DataFrame, queries: DataFrame, bounds: QueryBounds) -> DataFrame:
    """Add the snippet and the matched terms where the document was read."""
    terms = queries.select("query_id", X.query_terms("text").alias("_terms"))
    return hits.join(broadcast_if(terms, bounds.n), "query_id").withColumns({
        "context_snippet": X.context_snippet("content", "_terms"),
        "matched_terms": X.matched_terms("content", "_terms"),
    })


def present(
    hits: DataFrame, queries: DataFrame, bounds: QueryBounds, mode: str, snippets: bool = True,
) -> DataFrame:
    """Result rows of hydrated hits: snippet, matched terms, rank, final cut.

    Snippets are made where the document was read, so document text is never
    shuffled. Without ``snippets`` the two columns made from text are left out.
    """
    shown = ["context_snippet", "matched_terms"] if snippets else []
    if snippets:
        hits = with_snippets(hits, queries, bounds)
    ranked = filters.rank_results(hits.drop("content", "_terms", "doc_bucket"))
    limited = filters.limit_results(validate.check_results(ranked))
    attributes = [c for c in _ATTRIBUTES if c in limited.columns]
    return tag_search_mode(
        limited.select("query_id", "doc_id", "batch_id", *attributes, "score", *shown, "rank"),
        mode,
    )


def tag_search_mode(results: DataFrame, mode: str) -> DataFrame:
    return results.withColumn("search_mode", F.lit(mode))


def search_sparse(
    index: SparseIndex, queries: DataFrame, prefilter: bool = False, snippets: bool = True
) -> DataFrame:
    """Keyword search. ``prefilter`` applies the query filters before the cut
    at ``max_results`` instead of after it. Without ``snippets`` the search ranks
    documents and reads no text."""
    queries = validate.accepted_queries(queries)
    bounds = query_bounds(queries)
    hits = sparse_hits(index, queries, bounds, prefilter=prefilter)
    found = hydrate_documents(hits, index, queries, bounds, content=snippets)
    return present(found, queries, bounds, "tfidf", snippets)


def with_vectors(queries: DataFrame, make_encoder: Callable[[], Callable] | None) -> DataFrame:
    """Queries with an ``embedding``: encoded here if they have none, else as they come.

    A query whose vector is null is kept, and finds nothing by vector.
    """
    if "embedding" in queries.columns:
        return queries
    if make_encoder is None:
        raise ValueError("queries have no embedding and no encoder is given")
    return written(dense.embed_queries(queries, make_encoder), "query_vectors")


def search_dense(
    index: DenseIndex, queries: DataFrame, n_probe: int | None = None,
    make_encoder: Callable[[], Callable] | None = None,
) -> DataFrame:
    """Vector search; ``queries`` hold an ``embedding``, or ``make_encoder`` makes it."""
    queries = with_vectors(validate.accepted_queries(queries), make_encoder)
    bounds = query_bounds(queries)
    hits = dense_hits(index, queries, bounds, n_probe=n_probe)
    found = hydrate_documents(hits, index, queries, bounds)
    return present(found, queries, bounds, "transformer")


def search_hybrid(
    sparse_index: SparseIndex,
    dense_index: DenseIndex | None,
    queries: DataFrame,
    method: str = "weighted_sum",
    sparse_weight: float = V.SPARSE_WEIGHT,
    dense_weight: float = V.DENSE_WEIGHT,
    n_probe: int | None = None,
    make_encoder: Callable[[], Callable] | None = None,
) -> DataFrame:
    """Fused search. A document found by the keyword side shows its cleaned
    text, any other its original text. A query without a vector is answered
    from the keyword side."""
    queries = validate.accepted_queries(queries)
    if dense_index is not None:
        queries = with_vectors(queries, make_encoder)
    bounds = query_bounds(queries)
    hits = hybrid_hits(
        sparse_index, dense_index, queries, bounds, method, sparse_weight, dense_weight, n_probe
    )
    found = hydrate_documents(
        hits.filter("in_sparse"), sparse_index, queries, bounds
    )
    if dense_index is not None:
        original = hydrate_documents(
            hits.filter("not in_sparse"), dense_index, queries, bounds
        )
        found = found.unionByName(original, allowMissingColumns=True)
    return present(found.drop("in_sparse"), queries, bounds, "hybrid")


def search(
    queries: DataFrame, mode: str = "hybrid", sparse_index: SparseIndex | None = None,
    dense_index: DenseIndex | None = None, **options,
) -> DataFrame:
    """Search in the named mode."""
    if mode == "tfidf":
        return search_sparse(sparse_index, queries, **options)
    if mode == "transformer":
        if dense_index is None:
            raise ValueError("vector search is not available")
        return search_dense(dense_index, queries, **options)
    if mode == "hybrid":
        return search_hybrid(sparse_index, dense_index, queries, **options)
    raise ValueError(f"unknown search mode: {mode}")


# --- modes side by side --------------------------------------------------------


def compare_modes(
    sparse_index: SparseIndex,
    dense_index: DenseIndex,
    queries: DataFrame,
    top: int = 5,
    method: str = "weighted_sum",
    sparse_weight: float = V.SPARSE_WEIGHT,
    dense_weight: float = V.DENSE_WEIGHT,
    n_probe: int | None = None,
    make_encoder: Callable[[], Callable] | None = None,
) -> DataFrame:
    """Per query and mode: number of results, best scores in order, and ``seconds``.

    Each side is scored once, with the wide lists that fusion needs: a single
    mode's first rows are the first rows of such a list above the full threshold.
    Text is read once a side, to check that candidates can be shown. ``seconds`` is the
    time of the steps that a mode needs, shared by the queries of the batch;
    a query without results in a mode has no row in it.
    """
    queries = with_vectors(validate.accepted_queries(queries), make_encoder)
    bounds = query_bounds(queries)
    key = ["query_id", *sparse.DOC_KEY]
    limits = broadcast_if(
        queries.select("query_id", "max_results", "similarity_threshold"), bounds.n)

    def timed(name: str, df: DataFrame) -> tuple[DataFrame, float]:
        started = time.perf_counter()
        return written(df, name), time.perf_counter() - started

    def side(name: str, index: SparseIndex | DenseIndex, hits: DataFrame):
        hits, scoring = timed(f"{name}_hits", hits.select(*key, "score", "position"))
        found = hydrate_documents(
            hits.join(limits.select("query_id", "max_results"), "query_id"), index, queries, bounds)
        shown, reading = timed(f"{name}_shown", with_snippets(found, queries, bounds).filter(
            ~X.is_blank("context_snippet")).select(*key))
        return hits, shown, scoring + reading

    wide = (V.FUSION_OVERFETCH, V.FUSION_THRESHOLD_SHARE)
    left, left_shown, left_time = side(
        "sparse", sparse_index, sparse_hits(sparse_index, queries, bounds, *wide))
    right, right_shown, right_time = side(
        "dense", dense_index, dense_hits(dense_index, queries, bounds, *wide, n_probe))

    def alone(hits: DataFrame, shown: DataFrame) -> DataFrame:
        first = filters.filter_threshold(hits.join(limits, "query_id")).filter(
            F.col("position") <= F.col("max_results") * V.SEARCH_OVERFETCH)
        return first.join(shown, key)

    fused = filters.top_per_query(
        fusion.fuse(left, right, method, sparse_weight, dense_weight).join(limits, "query_id"),
        V.SEARCH_OVERFETCH, bounds.max_results)
    both = fused.filter("in_sparse").join(left_shown, key).unionByName(
        fused.filter("not in_sparse").join(right_shown, key))

    report = None
    for mode, rows, before in (
        ("tfidf", alone(left, left_shown), left_time),
        ("transformer", alone(right, right_shown), right_time),
        ("hybrid", both, left_time + right_time),
    ):
        ranked = filters.limit_results(validate.check_results(filters.rank_results(rows)))
        results, own = timed(f"{mode}_results", tag_search_mode(
            ranked.select("query_id", "score", "rank"), mode))
        part = stats.compare_modes(results, top).withColumn(
            "seconds", F.lit((before + own) / max(bounds.n, 1)))
        report = part if report is None else report.unionByName(part)
    return report


# --- search log ---------------------------------------------------------------


def logged_search(log: str, queries: DataFrame, mode: str = "hybrid", **options) -> DataFrame:
    """Search, write the results, and add a row for each query to the log table.

    The log (``query_id, query, mode, ts, seconds, results_count``) is a Parquet
    folder. The time of a batch is shared by its queries.
    """
    started = time.perf_counter()
    results = written(search(queries, mode, **options), "results")
    seconds = time.perf_counter() - started
    found = results.groupBy("query_id").agg(F.count("*").alias("results_count"))
    n = max(queries.count(), 1)
    queries.select("query_id", F.col("text").alias("query")).join(found, "query_id", "left").select(
        "query_id", "query", F.lit(mode).alias("mode"), F.current_timestamp().alias("ts"),
        F.lit(seconds / n).alias("seconds"),
        F.coalesce("results_count", F.lit(0)).alias("results_count"),
    ).write.mode("append").parquet(log)
    return results


# --- growth report ------------------------------------------------------------


def corpus_growth(
    tokenised: DataFrame, queries: DataFrame, sizes: Sequence[int], params: SparseParams
) -> DataFrame:
    """Vocabulary size and number of hits when the first n documents, and then
    all of them, are indexed. Sizes above the corpus are left out."""
    total = tokenised.count()
    bounds = query_bounds(queries)
    steps = [n for n in sizes if n < total]
    report = None
    for n in (*steps, total):
        part = tokenised
        if n < total:
            part = written(tokenised.orderBy(*sparse.DOC_KEY).limit(n), "first_docs")
        index = index_from_tokens(part, params)
        row = sparse_hits(index, queries, bounds, factor=1).agg(
            F.count("*").alias("results_count")
        ).select(
            F.lit(n).cast("bigint").alias("n_docs"),
            F.lit(index.vocab_rows).cast("bigint").alias("vocabulary_size"), "results_count",
        )
        report = row if report is None else report.unionByName(row)
    return report

"""Filters, whole searches and reports over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import settings as S
from checks import tables as T
from checks.oracle import (
    PASSES, RESULT, WEIGHTED, bigrams, clean, fused, presented, query_table, sql, tokens, top,
    words,
)
from checks.registry import query
from docsearch import fixed_values as V
from docsearch.operators import filters, sparse, stats
from docsearch.plans import search as P
from docsearch.runtime import new_folder
from docsearch.sources.index_store import SparseStore, load_hybrid, save_hybrid
from docsearch.streaming import ingest


def _rows(results):
    return results.select(
        "query_id", "doc_id", "entity_id", "doc_type",
        F.date_format("date", "yyyy-MM-dd").alias("date"), F.round("score", 6).alias("score"),
        "context_snippet", F.array_join("matched_terms", "|").alias("matched_terms"), "rank",
    )


# --- filters ----------------------------------------------------------------------

_SOURCES = ("src1", "src4", "src9")
_WANTED_TYPES = ("invoice", "receipt")


@query("filter_entity", sql("docs", f"SELECT doc_id, entity_id FROM docs "
                                    f"WHERE entity_id IN ({words(_SOURCES)})"))
def filter_entity(spark, sf_dir):
    return filters.filter_entity(T.documents(spark, sf_dir), _SOURCES).select("doc_id", "entity_id")


@query("filter_doc_type", sql("docs", f"SELECT doc_id, doc_type FROM docs "
                                      f"WHERE doc_type IN ({words(_WANTED_TYPES)})"))
def filter_doc_type(spark, sf_dir):
    return filters.filter_doc_type(T.documents(spark, sf_dir), _WANTED_TYPES).select(
        "doc_id", "doc_type"
    )


@query("filter_date_range", sql("docs", """SELECT doc_id, strftime(date, '%Y-%m-%d') AS date
    FROM docs WHERE date >= TIMESTAMP '2023-05-01' AND date <= TIMESTAMP '2023-08-31'"""))
def filter_date_range(spark, sf_dir):
    return filters.filter_date_range(
        T.documents(spark, sf_dir), "2023-05-01 00:00:00", "2023-08-31 00:00:00"
    ).select("doc_id", F.date_format("date", "yyyy-MM-dd").alias("date"))


_PASSED = f"""passed AS (SELECT h.query_id, h.doc_id, h.score, h.position, q.max_results
    FROM sparse_top h JOIN queries q USING (query_id) JOIN cleaned d USING (doc_id)
    WHERE {PASSES})"""


def _passed(spark, sf_dir):
    index, queries = T.sparse_index(spark, sf_dir), T.benchmark_queries(spark, sf_dir)
    bounds = P.query_bounds(queries)
    hits = P.sparse_hits(index, queries, bounds)
    return P.hydrate_documents(hits, index, queries, bounds)


@query("filter_combined", sql("sparse_top", "SELECT query_id, doc_id, round(score, 6) AS score, "
       "CAST(position AS INTEGER) AS position FROM passed", _PASSED))
def filter_combined(spark, sf_dir):
    return _passed(spark, sf_dir).select(
        "query_id", "doc_id", F.round("score", 6).alias("score"), "position"
    )


@query("query_filter_join", sql("scored", f"""SELECT h.query_id, h.doc_id,
    round(h.score, 6) AS score FROM scored h JOIN queries q USING (query_id)
    JOIN cleaned d USING (doc_id) WHERE {PASSES}"""))
def query_filter_join(spark, sf_dir):
    index, queries = T.sparse_index(spark, sf_dir), T.benchmark_queries(spark, sf_dir)
    bounds = P.query_bounds(queries)
    weights = sparse.query_weights(queries, index.vocab, index.params, index.vocab_rows)
    scored = sparse.score_sparse(index.postings, weights, bounds.n_terms)
    # They stand in the bucket of the scores, so no pair is shuffled or sorted.
    attributes = index.rows.select(
        *sparse.DOC_KEY, "entity_id", "doc_type", "date").hint("shuffle_hash")
    return filters.query_filter_join(
        scored, queries, attributes, bounds.n, n_hits=bounds.n * index.n_docs
    ).select("query_id", "doc_id", F.round("score", 6).alias("score"))


@query("hydrate_documents", sql("sparse_top", """SELECT h.query_id, h.doc_id, d.entity_id,
    d.content FROM sparse_top h JOIN cleaned d USING (doc_id)""",
    queries=query_table(filtered=False)))
def hydrate_documents(spark, sf_dir):
    index = T.sparse_index(spark, sf_dir)
    queries = T.benchmark_queries(spark, sf_dir, filtered=False)
    bounds = P.query_bounds(queries)
    hits = P.sparse_hits(index, queries, bounds)
    return P.hydrate_documents(hits, index, queries, bounds).select(
        "query_id", "doc_id", "entity_id", "content"
    )


_RANKED = _PASSED + """,
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)
    AS INTEGER) AS rank FROM passed)"""


@query("rank_results", sql("sparse_top", "SELECT query_id, doc_id, rank FROM ranked", _RANKED))
def rank_results(spark, sf_dir):
    return filters.rank_results(_passed(spark, sf_dir)).select("query_id", "doc_id", "rank")


@query("limit_results", sql("sparse_top", "SELECT query_id, doc_id, rank FROM ranked "
                                          "WHERE rank <= max_results", _RANKED))
def limit_results(spark, sf_dir):
    ranked = filters.rank_results(_passed(spark, sf_dir))
    return filters.limit_results(ranked).select("query_id", "doc_id", "rank")


_PREFILTERED = f"""allowed AS (SELECT s.query_id, s.doc_id, s.score FROM scored s
    JOIN queries q USING (query_id) JOIN cleaned d USING (doc_id) WHERE {PASSES}),
{top("allowed", "prefiltered", 2)}, {presented("prefiltered", "SELECT * FROM cleaned")}"""


@query("prefiltered_search", sql("scored", f"SELECT {RESULT} FROM results", _PREFILTERED))
def prefiltered_search(spark, sf_dir):
    return _rows(P.search_sparse(
        T.sparse_index(spark, sf_dir), T.benchmark_queries(spark, sf_dir), prefilter=True
    ))


# --- searches ---------------------------------------------------------------------

_SPARSE = presented("sparse_top", "SELECT * FROM cleaned")
_RANKS = presented("sparse_top", "SELECT * FROM cleaned", texts=False)
_DENSE = presented("dense_top", "SELECT * FROM docs")


def _hybrid(score, name="results", texts=True):
    """Hybrid result CTEs: cleaned text for a document of the keyword list."""
    return fused(score) + f""",
hybrid_docs AS (SELECT h.query_id || '|' || h.doc_id AS doc_id, d.doc_id AS own_id, d.entity_id,
    d.doc_type, d.date, CASE WHEN h.in_sparse THEN c.content ELSE d.content END AS content
    FROM hybrid_top h JOIN docs d USING (doc_id) LEFT JOIN cleaned c USING (doc_id)),
hybrid_keyed AS (SELECT query_id, query_id || '|' || doc_id AS doc_id, score FROM hybrid_top),
{presented("hybrid_keyed", "SELECT * FROM hybrid_docs", name, texts)}"""


_HYBRID_RESULT = RESULT.replace("query_id, doc_id,", "query_id, split_part(doc_id, '|', 2) AS doc_id,")


@query("search_sparse", sql("sparse_top", f"SELECT {RESULT} FROM results", _SPARSE))
def search_sparse(spark, sf_dir):
    return _rows(P.search(
        T.benchmark_queries(spark, sf_dir), "tfidf", sparse_index=T.sparse_index(spark, sf_dir)
    ))


@query("search_dense", sql(("dense_top", "docs"), f"SELECT {RESULT} FROM results", _DENSE))
def search_dense(spark, sf_dir):
    queries = T.with_vectors(T.benchmark_queries(spark, sf_dir), spark, sf_dir)
    return _rows(P.search(queries, "transformer", dense_index=T.dense_index(spark, sf_dir)))


@query("search_hybrid", sql(("fusion", "cleaned"), f"SELECT {_HYBRID_RESULT} FROM results",
                            _hybrid(WEIGHTED)))
def search_hybrid(spark, sf_dir):
    queries = T.with_vectors(T.benchmark_queries(spark, sf_dir), spark, sf_dir)
    return _rows(P.search(
        queries, "hybrid", sparse_index=T.sparse_index(spark, sf_dir),
        dense_index=T.dense_index(spark, sf_dir),
    ))


def _two_batches(spark, sf_dir):
    """A store that holds the documents in two batches, and its index."""
    docs = T.documents(spark, sf_dir)
    first = F.col("doc_id").cast("long") % 3 != 0
    store = SparseStore(spark, new_folder(spark, "two"), T.PARAMS)
    store.append(docs.filter(first))
    store.append(docs.filter(~first))
    return store.refresh()


@query("search_reloaded_batches", sql("sparse_top", f"SELECT {RESULT} FROM results", _SPARSE))
def search_reloaded_batches(spark, sf_dir):
    """An index of two batches, saved and loaded, answers as one that was built at once."""
    root = new_folder(spark, "saved")
    save_hybrid(spark, root, _two_batches(spark, sf_dir), None)
    index, _ = load_hybrid(spark, root)
    return _rows(P.search_sparse(index, T.benchmark_queries(spark, sf_dir)))


@query("search_streamed_onto_bulk", sql("sparse_top", f"SELECT {RESULT} FROM results", _SPARSE))
def search_streamed_onto_bulk(spark, sf_dir):
    """Part of the documents is loaded, the rest streamed; the last batches are searchable too."""
    docs, arriving = T.documents(spark, sf_dir), new_folder(spark, "arriving")
    first = F.col("doc_id").cast("long") % 3 != 0
    store = SparseStore(spark, new_folder(spark, "grown"), T.PARAMS)
    ingest.add_batch(store, docs.filter(first), S.AS_OF_YEAR)
    docs.filter(~first).repartition(3, "doc_id").write.parquet(arriving)
    ingest.incremental_ingest(
        ingest.read_document_stream(spark, arriving, files_per_trigger=1), store,
        new_folder(spark, "stream-state"), S.AS_OF_YEAR, refresh_every=2)
    return _rows(P.search_sparse(store.load(), T.benchmark_queries(spark, sf_dir)))


@query("search_hybrid_some_vectors", sql(
    ("fusion", "cleaned"), f"SELECT {_HYBRID_RESULT} FROM results", _hybrid(WEIGHTED),
    query_vectors="""query_vectors AS (SELECT q.query_id, v.e AS qe FROM queries q
        JOIN vectors v ON v.doc_id = q.query_id WHERE CAST(q.query_id AS BIGINT) % 4 <> 1)"""))
def search_hybrid_some_vectors(spark, sf_dir):
    """A query without a vector is answered from the keyword side."""
    queries = T.with_vectors(T.benchmark_queries(spark, sf_dir), spark, sf_dir).withColumn(
        "embedding", F.when(F.col("query_id").cast("long") % 4 != 1, F.col("embedding")))
    return _rows(P.search(queries, "hybrid", sparse_index=T.sparse_index(spark, sf_dir),
                          dense_index=T.dense_index(spark, sf_dir)))


@query("search_hybrid_two_batches", sql(("fusion", "cleaned"),
                                        f"SELECT {_HYBRID_RESULT} FROM results",
                                        _hybrid(WEIGHTED)))
def search_hybrid_two_batches(spark, sf_dir):
    """Keywords in two batches, vectors in one."""
    queries = T.with_vectors(T.benchmark_queries(spark, sf_dir), spark, sf_dir)
    return _rows(P.search(queries, "hybrid", sparse_index=_two_batches(spark, sf_dir),
                          dense_index=T.dense_index(spark, sf_dir)))


def _one_query(text, threshold, max_results):
    return f"""queries AS (SELECT 'q' AS query_id, '{text}' AS text, NULL::VARCHAR[] AS entity_ids,
    NULL::VARCHAR[] AS doc_types, NULL::TIMESTAMP AS date_from, NULL::TIMESTAMP AS date_to,
    {threshold}::DOUBLE AS similarity_threshold, {max_results} AS max_results)"""


@query("search_text", sql("sparse_top", f"SELECT {RESULT} FROM results", _SPARSE,
                          queries=_one_query(S.QUERY_TEXT, 0.1, 50)))
def search_text(spark, sf_dir):
    queries = P.search_text(spark, S.QUERY_TEXT, similarity_threshold=0.0)
    return _rows(P.search_sparse(T.sparse_index(spark, sf_dir), queries))


@query("batch_search", sql("sparse_top", """SELECT query_id, doc_id, round(score, 6) AS score,
    rank FROM results""", _RANKS, queries=query_table(0.02, 50, filtered=False)))
def batch_search(spark, sf_dir):
    queries = T.benchmark_queries(spark, sf_dir, 0.02, 50, filtered=False)
    return P.search_sparse(T.sparse_index(spark, sf_dir), queries, snippets=False).select(
        "query_id", "doc_id", F.round("score", 6).alias("score"), "rank"
    )


@query("search_request", """SELECT CAST(item_id AS VARCHAR) AS query_id, text,
    CASE WHEN item_id % 2 = 0 THEN 'src' || (item_id % 20) END AS entity_ids,
    CASE WHEN item_id % 3 = 0 THEN '2023-04-01' END AS date_from,
    CAST(CASE WHEN item_id % 5 = 0 THEN 0.25 ELSE 0.1 END AS DOUBLE) AS similarity_threshold,
    50 AS max_results FROM benchmark WHERE item_id % 7 <> 0""")
def search_request(spark, sf_dir):
    """Requests as JSON; those with an unreadable date are refused."""
    n = F.col("item_id")
    source = F.concat(F.lit("src"), (n % 20).cast("string"))
    body = F.to_json(F.struct(
        "text", F.when(n % 2 == 0, F.array(source, source)).alias("entity_ids"),
        F.when(n % 3 == 0, F.lit("2023-04-01T00:00:00")).alias("date_from"),
        F.when(n % 7 == 0, F.lit("next week")).alias("date_to"),
        F.when(n % 5 == 0, F.lit(0.25)).alias("similarity_threshold"),
    ))
    requests = T.table(spark, sf_dir, "benchmark").select(
        n.cast("string").alias("query_id"), body.alias("request")
    )
    return P.search_requests(requests).select(
        "query_id", "text", F.array_join("entity_ids", "|").alias("entity_ids"),
        F.date_format("date_from", "yyyy-MM-dd").alias("date_from"),
        "similarity_threshold", "max_results",
    )


# --- reports ----------------------------------------------------------------------

_SWEEP = f"""{_RANKS}, steps AS (SELECT unnest([{", ".join(map(str, V.SWEEP_THRESHOLDS))}])::DOUBLE
    AS threshold)"""


@query("threshold_sweep", sql("sparse_top", """SELECT q.query_id, t.threshold,
    count(r.doc_id) AS n_results, round(avg(r.score), 6) AS avg_score,
    round(min(r.score), 6) AS min_score, round(max(r.score), 6) AS max_score
    FROM queries q CROSS JOIN steps t LEFT JOIN results r
        ON r.query_id = q.query_id AND r.score >= t.threshold GROUP BY ALL""", _SWEEP,
    queries=query_table(0.05, S.SWEEP_LIMIT, filtered=False)))
def threshold_sweep(spark, sf_dir):
    queries = T.benchmark_queries(spark, sf_dir, 0.05, S.SWEEP_LIMIT, filtered=False)
    results = P.search_sparse(T.sparse_index(spark, sf_dir), queries, snippets=False)
    return stats.threshold_sweep(results, queries).select(
        "query_id", "threshold", "n_results",
        *[F.round(c, 6).alias(c) for c in ("avg_score", "min_score", "max_score")],
    )


_ALL_MODES = f"""{presented("sparse_top", "SELECT * FROM cleaned", "r_sparse", False)},
{presented("dense_top", "SELECT * FROM docs", "r_dense", False)},
{_hybrid(WEIGHTED, "r_hybrid", False)},
all_modes AS (SELECT query_id, 'tfidf' AS search_mode, score, rank FROM r_sparse
    UNION ALL SELECT query_id, 'transformer', score, rank FROM r_dense
    UNION ALL SELECT query_id, 'hybrid', score, rank FROM r_hybrid)"""


@query("compare_modes", sql(("sparse_top", "dense_top", "fusion", "cleaned"), """
    SELECT query_id, search_mode, count(*) AS results_count,
        round(list_sum((list(score ORDER BY rank))[1:5]), 5) AS top_five_sum,
        round(max(score), 6) AS best FROM all_modes GROUP BY ALL""",
    _ALL_MODES))
def compare_modes(spark, sf_dir):
    queries = T.with_vectors(T.benchmark_queries(spark, sf_dir), spark, sf_dir)
    left, right = T.sparse_index(spark, sf_dir), T.dense_index(spark, sf_dir)
    total = F.aggregate("top_scores", F.lit(0.0), lambda a, x: a + x)
    compared = P.compare_modes(left, right, queries)
    timed = compared.select(F.min("seconds") > 0).first()[0]
    if timed is False:
        raise AssertionError("a mode has no time")
    return compared.select(
        "query_id", "search_mode", "results_count", F.round(total, 5).alias("top_five_sum"),
        F.round(F.col("top_scores")[0], 6).alias("best"),
    )


_LOG = "SELECT event_type AS mode, value AS seconds, CAST(user_id AS VARCHAR) AS query FROM events"


@query("latency_summary", f"""SELECT query, {", ".join(
    f"round(avg(seconds) FILTER (mode = '{m}'), 6) AS {m}_avg, "
    f"min(seconds) FILTER (mode = '{m}') AS {m}_min, max(seconds) FILTER (mode = '{m}') AS {m}_max"
    for m in S.MODES)},
    round(avg(seconds) FILTER (mode = 'view') / avg(seconds) FILTER (mode = 'click'), 6) AS ratio
    FROM ({_LOG}) GROUP BY query""")
def latency_summary(spark, sf_dir):
    summary = stats.latency_summary(T.search_log(spark, sf_dir), S.MODES, "view", "click")
    return summary.withColumns({
        c: F.round(c, 6) for c in [f"{m}_avg" for m in S.MODES] + ["ratio"]
    })


@query("search_stats", f"""SELECT mode, count(*) AS searches, round(avg(seconds), 6) AS avg_seconds
    FROM ({_LOG}) GROUP BY ROLLUP (mode)""")
def search_stats(spark, sf_dir):
    return stats.search_stats(T.search_log(spark, sf_dir)).withColumn(
        "avg_seconds", F.round("avg_seconds", 6)
    )


# A tiny shift keeps means that lie exactly between two roundings apart from them.
@query("rolling_search_time", """SELECT event_id,
    count(*) OVER w AS searches_so_far, round(avg(value) OVER w + 1e-9, 6) AS avg_so_far,
    count(*) OVER m AS mode_searches_so_far, round(avg(value) OVER m + 1e-9, 6) AS mode_avg_so_far
    FROM events WINDOW w AS (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING),
    m AS (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def rolling_search_time(spark, sf_dir):
    log = T.search_log(spark, sf_dir)
    overall = stats.rolling_search_time(log, order=("ts", "event_id")).select(
        "event_id", "searches_so_far", F.round(F.col("avg_so_far") + 1e-9, 6).alias("avg_so_far")
    )
    by_mode = stats.rolling_search_time(log, order=("ts", "event_id"), by=("mode",)).select(
        "event_id", F.col("searches_so_far").alias("mode_searches_so_far"),
        F.round(F.col("avg_so_far") + 1e-9, 6).alias("mode_avg_so_far"),
    )
    return overall.join(by_mode, "event_id")


@query("doc_type_counts", sql("docs", """SELECT doc_type, count(*) AS n_docs FROM docs
    GROUP BY ROLLUP (doc_type)"""))
def doc_type_counts(spark, sf_dir):
    return stats.doc_type_counts(T.documents(spark, sf_dir))


def _sparse_stats(spark, sf_dir):
    index = T.sparse_index(spark, sf_dir)
    p = index.params
    return stats.sparse_index_stats(
        index.docs, index.vocab, p.max_features, p.min_df, p.max_df, p.ngram_range
    )


def _dense_stats(spark, sf_dir):
    index = T.dense_index(spark, sf_dir)
    return stats.dense_index_stats(index.docs, index.vectors)


@query("sparse_index_stats", sql(("cleaned", "vocab"), """SELECT
    (SELECT count(*) FROM cleaned) AS total_documents,
    (SELECT count(*) FROM vocab) AS vocabulary_size, true AS is_fitted,
    10000 AS max_features, 1 AS min_df, 0.95::DOUBLE AS max_df, 1 AS ngram_low, 2 AS ngram_high"""))
def sparse_index_stats(spark, sf_dir):
    return _sparse_stats(spark, sf_dir)


@query("dense_index_stats", """SELECT (SELECT count(*) FROM documents) AS total_documents,
    count(*) AS vectors_held, CAST(max(len(embedding)) AS INTEGER) AS vector_dimension,
    true AS is_fitted FROM embeddings""")
def dense_index_stats(spark, sf_dir):
    return _dense_stats(spark, sf_dir)


@query("engine_stats", sql(("cleaned", "vocab"), """SELECT
    (SELECT count(*) FROM cleaned) AS total_documents,
    (SELECT count(*) FROM vocab) AS vocabulary_size,
    (SELECT count(*) FROM embeddings) AS vectors_held,
    (SELECT CAST(max(len(embedding)) AS INTEGER) FROM embeddings) AS vector_dimension,
    (SELECT count(*) FROM events) AS total_searches,
    (SELECT round(avg(value), 6) FROM events) AS avg_search_time,
    (SELECT count(*) FROM events WHERE event_type = 'click') AS click_searches,
    (SELECT count(*) FROM events WHERE event_type = 'view') AS view_searches,
    0.1::DOUBLE AS similarity_threshold, 'weighted_sum' AS fusion_method,
    0.3::DOUBLE AS tfidf_weight, 0.7::DOUBLE AS transformer_weight"""))
def engine_stats(spark, sf_dir):
    return stats.engine_stats(
        _sparse_stats(spark, sf_dir), _dense_stats(spark, sf_dir), T.search_log(spark, sf_dir),
        sparse_weight=0.3, dense_weight=0.7, modes=("click", "view"),
    ).withColumn("avg_search_time", F.round("avg_search_time", 6))


@query("index_ready", """SELECT true AS tfidf_available,
    (SELECT count(*) FROM documents) > 0 AS tfidf_ready, true AS transformer_available,
    (SELECT count(*) FROM embeddings) > 0 AS transformer_ready,
    (SELECT count(*) FROM documents) > 0 AS ready""")
def index_ready(spark, sf_dir):
    return stats.index_ready(_sparse_stats(spark, sf_dir), _dense_stats(spark, sf_dir))


@query("sparse_index_only", """SELECT true AS tfidf_available,
    (SELECT count(*) FROM documents) > 0 AS tfidf_ready, false AS transformer_available,
    false AS transformer_ready, (SELECT count(*) FROM documents) > 0 AS ready""")
def sparse_index_only(spark, sf_dir):
    return stats.index_ready(_sparse_stats(spark, sf_dir), None)


@query("logged_searches", sql("sparse_top", """SELECT 'tfidf' AS mode, count(*) * 2 AS searches,
    (SELECT count(*) FROM results) * 2 AS results_count, true AS timed FROM queries""", _SPARSE))
def logged_searches(spark, sf_dir):
    """Two rounds of searches, counted from the log that they write."""
    log = f"{new_folder(spark, 'log')}/searches"
    queries = T.benchmark_queries(spark, sf_dir)
    for _ in range(2):
        P.logged_search(log, queries, "tfidf", sparse_index=T.sparse_index(spark, sf_dir))
    return spark.read.parquet(log).groupBy("mode").agg(
        F.count("*").alias("searches"), F.sum("results_count").alias("results_count"),
        F.bool_and(F.col("seconds") > 0).alias("timed"))


# --- growth -----------------------------------------------------------------------

_GROWTH = f"""numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS rn,
    count(*) OVER () AS total FROM toks),
sizes AS (SELECT unnest([{", ".join(map(str, S.GROWTH_SIZES))}]) AS size
    UNION SELECT max(total) FROM numbered),
g_tf AS (SELECT size, doc_id, term, count(*) AS tf FROM (
    SELECT size, doc_id, unnest({bigrams("t")}) AS term FROM numbered JOIN sizes ON rn <= size)
    GROUP BY ALL),
g_freq AS (SELECT size, term, count(*) AS df, sum(tf) AS ctf FROM g_tf GROUP BY ALL),
g_vocab AS (SELECT size, term, ln((1.0 + size) / (1.0 + df)) + 1 AS idf FROM g_freq
    WHERE df <= 0.95 * size
    QUALIFY row_number() OVER (PARTITION BY size ORDER BY ctf DESC, term) <= 10000),
g_post AS (SELECT size, doc_id, term, tf * idf
    / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY size, doc_id)) AS w
    FROM g_tf JOIN g_vocab USING (size, term)),
g_query AS (SELECT size, term, tf * idf
    / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY size)) AS qw
    FROM (SELECT term, count(*) AS tf FROM (
        SELECT unnest({bigrams("qt")}) AS term FROM (
            SELECT {tokens(clean(f"'{S.QUERY_TEXT}'"))} AS qt)) GROUP BY term)
    JOIN g_vocab USING (term)),
g_hits AS (SELECT size, doc_id FROM g_post JOIN g_query USING (size, term)
    GROUP BY ALL HAVING round(sum(w * qw), 10) >= 0.01)"""


@query("corpus_growth", sql("toks", """SELECT CAST(s.size AS BIGINT) AS n_docs,
    (SELECT count(*) FROM g_vocab v WHERE v.size = s.size) AS vocabulary_size,
    (SELECT least(count(*), 5) FROM g_hits h WHERE h.size = s.size) AS results_count
    FROM sizes s""", _GROWTH))
def corpus_growth(spark, sf_dir):
    queries = P.search_text(
        spark, S.QUERY_TEXT, similarity_threshold=0.01, max_results=5
    )
    return P.corpus_growth(
        T.sparse_index(spark, sf_dir).docs, queries, S.GROWTH_SIZES, T.PARAMS
    )

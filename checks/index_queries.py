"""Vocabulary, weights, scores, vectors and fusion."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from checks import settings as S
from checks import tables as T
from checks.oracle import MAX, RRF, WEIGHTED, clean, fused, inner, query_table, sql, unit, words
from checks.registry import query
from docsearch import fixed_values as V
from docsearch.operators import dense, fusion, sparse
from docsearch.plans import index as I
from docsearch.plans import search as P
from docsearch.runtime import written

# --- vocabulary -------------------------------------------------------------------


def _tokenised(spark, sf_dir):
    return I.tokenised_documents(T.documents(spark, sf_dir), T.PARAMS)


@query("term_frequency", sql("tf", "SELECT doc_id, term, tf FROM tf"))
def term_frequency(spark, sf_dir):
    return sparse.term_frequency(
        _tokenised(spark, sf_dir), V.NGRAM_RANGE
    ).select("doc_id", "term", "tf")


@query("document_frequency", sql("freq", "SELECT term, df, ctf FROM freq"))
def document_frequency(spark, sf_dir):
    return sparse.term_statistics(_tokenised(spark, sf_dir), V.NGRAM_RANGE)


@query("prune_vocabulary", sql("vocab", "SELECT term, df, ctf FROM vocab"))
def prune_vocabulary(spark, sf_dir):
    docs = T.sparse_index(spark, sf_dir).docs
    freq = written(sparse.term_statistics(docs, V.NGRAM_RANGE), "freq")
    return sparse.prune_vocabulary(freq, docs.count(), T.PARAMS)


@query("vocab_params", f"""SELECT source, lang, n_docs,
    CASE WHEN n_docs < 20 THEN 1 ELSE {V.MIN_DF} END AS min_df,
    CAST(CASE WHEN n_docs < 5 THEN 1.0 ELSE {V.MAX_DF} END AS DOUBLE) AS max_df
    FROM (SELECT source, lang, count(*) AS n_docs FROM documents GROUP BY 1, 2)""")
def vocab_params(spark, sf_dir):
    """The rule at every size that a source has in a language."""
    groups = T.table(spark, sf_dir, "documents").groupBy("source", "lang").agg(
        F.count("*").alias("n_docs")
    )
    sizes = [r["n_docs"] for r in groups.select("n_docs").distinct().collect()]
    fitted = [(n, T.PARAMS.for_corpus(n)) for n in sizes]
    bounds = spark.createDataFrame(
        [(n, p.min_df, p.max_df) for n, p in fitted], "n_docs bigint, min_df int, max_df double")
    return groups.join(F.broadcast(bounds), "n_docs").select(
        "source", "lang", "n_docs", "min_df", "max_df")


# The word of a customer name is in every name, so the default bounds leave no
# term and the first fallback applies.
@query("vocab_fallback", """SELECT 'customer' AS term, count(*) AS df, count(*) AS ctf,
    round(ln((1.0 + count(*)) / (1.0 + count(*))) + 1, 6) AS idf FROM customer""")
def vocab_fallback(spark, sf_dir):
    names = T.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("doc_id"), F.col("c_name").alias("content")
    )
    index = I.build_sparse_index(names, T.PARAMS)
    return index.vocab.select("term", "df", "ctf", F.round("idf", 6).alias("idf"))


# Texts of stop words only: neither the default bounds nor the permissive ones leave a
# term, so the simplest analyser is used.
@query("vocab_last_resort", f"""WITH kept AS (SELECT doc_id, list_filter(
        string_split(lower(text), ' '), lambda w: w IN ({words(S.STOP_WORDS)})) AS t FROM documents),
    filled AS (SELECT * FROM kept WHERE len(t) > 0),
    n AS (SELECT count(*) AS n FROM filled),
    found AS (SELECT term, count(DISTINCT doc_id) AS df, count(*) AS ctf FROM (
        SELECT doc_id, unnest(t) AS term FROM filled) WHERE length(term) > 1 GROUP BY term)
    SELECT term, df, ctf, round(ln((1.0 + n) / (1.0 + df)) + 1, 6) AS idf FROM found, n
    ORDER BY ctf DESC, term LIMIT {V.FALLBACK_MAX_FEATURES}""")
def vocab_last_resort(spark, sf_dir):
    stops = F.array(*[F.lit(w) for w in S.STOP_WORDS])
    docs = T.documents(spark, sf_dir).withColumn("content", F.array_join(F.filter(
        F.split(F.lower("content"), " "), lambda w: F.array_contains(stops, w)), " "))
    index = I.build_sparse_index(docs, T.PARAMS)
    if not index.params.fallback_analyser:
        raise AssertionError("the simplest analyser was not used")
    return index.vocab.select("term", "df", "ctf", F.round("idf", 6).alias("idf"))


@query("idf", sql(("freq", "n"), """SELECT term, df,
    round(ln((1.0 + n) / (1.0 + df)) + 1, 6) AS idf FROM freq, n"""))
def idf(spark, sf_dir):
    docs = T.sparse_index(spark, sf_dir).docs
    freq = sparse.term_statistics(docs, V.NGRAM_RANGE)
    return freq.select("term", "df", F.round(sparse.idf("df", docs.count()), 6).alias("idf"))


@query("tfidf_weights", sql("postings", """SELECT term, doc_id, tf, round(weight, 6) AS weight
    FROM postings"""))
def tfidf_weights(spark, sf_dir):
    index = I.build_sparse_index(T.documents(spark, sf_dir), T.PARAMS)
    return index.postings.select("term", "doc_id", "tf", F.round("weight", 6).alias("weight"))


@query("feature_names", sql("vocab", "SELECT term FROM vocab ORDER BY term"))
def feature_names(spark, sf_dir):
    return sparse.feature_names(T.sparse_index(spark, sf_dir).vocab)


# --- sparse scores ----------------------------------------------------------------


@query("score_sparse", sql("scored", """SELECT query_id, doc_id, round(score, 6) AS score
    FROM scored"""))
def score_sparse(spark, sf_dir):
    index, queries = T.sparse_index(spark, sf_dir), T.benchmark_queries(spark, sf_dir)
    weights = sparse.query_weights(queries, index.vocab, index.params, index.vocab_rows)
    bounds = P.query_bounds(queries)
    scored = sparse.score_sparse(index.postings, weights, bounds.n_terms)
    return scored.select("query_id", "doc_id", F.round("score", 6).alias("score"))


@query("filter_threshold", sql(("scored", "cleaned"), """SELECT query_id, doc_id,
    round(coalesce(score, 0), 6) AS score FROM (
        SELECT *, row_number() OVER (
            PARTITION BY query_id ORDER BY coalesce(score, 0) DESC, doc_id) AS position
        FROM (SELECT q.query_id, q.max_results, c.doc_id FROM queries q, cleaned c)
        LEFT JOIN scored USING (query_id, doc_id))
    WHERE position <= 2 * max_results""", queries=query_table(0.0, 150, filtered=False)))
def filter_threshold(spark, sf_dir):
    """A threshold of zero lets in documents without any common term."""
    index = T.sparse_index(spark, sf_dir)
    queries = T.benchmark_queries(spark, sf_dir, 0.0, 150, filtered=False)
    hits = P.sparse_hits(index, queries, P.query_bounds(queries))
    return hits.select("query_id", "doc_id", F.round("score", 6).alias("score"))


_TOP = "SELECT query_id, doc_id, round(score, 6) AS score, CAST(position AS INTEGER) AS position FROM {}"


def _top(hits):
    return hits.select("query_id", "doc_id", F.round("score", 6).alias("score"), "position")


@query("topk_sparse", sql("sparse_top", _TOP.format("sparse_top")))
def topk_sparse(spark, sf_dir):
    index, queries = T.sparse_index(spark, sf_dir), T.benchmark_queries(spark, sf_dir)
    return _top(P.sparse_hits(index, queries, P.query_bounds(queries)))


# --- vectors ----------------------------------------------------------------------


@query("normalise_vectors", sql("vectors", """SELECT doc_id, len(e) AS n_dims,
    round(CAST(e[1] AS DOUBLE), 6) AS first_value,
    round(list_inner_product(CAST(e AS DOUBLE[]), CAST(e AS DOUBLE[])), 5) AS square FROM vectors"""))
def normalise_vectors(spark, sf_dir):
    return dense.normalise_vectors(T.vectors(spark, sf_dir)).select(
        "doc_id", F.size("embedding").cast("bigint").alias("n_dims"),
        F.round(F.col("embedding")[0].cast("double"), 6).alias("first_value"),
        F.round(F.aggregate(
            "embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")
        ), 5).alias("square"),
    )


_LABELS = f"""label_queries AS (SELECT CAST(label AS VARCHAR) AS query_id,
    {unit("min_by(embedding, vec_id)")} AS qe FROM embeddings GROUP BY label),
label_scored AS (SELECT query_id, doc_id, least(round({inner("e", "qe")}, 10), 1.0) AS score
    FROM vectors, label_queries)"""


def _label_queries(spark, sf_dir, threshold, max_results):
    return T.label_queries(spark, sf_dir).select(
        "query_id", "embedding", F.lit(threshold).alias("similarity_threshold"),
        F.lit(max_results).alias("max_results"),
    )


def _label_bounds(spark, sf_dir, max_results):
    labels = T.table(spark, sf_dir, "embeddings").select("label").distinct().count()
    return P.QueryBounds(labels, max_results, 0, False)


@query("score_dense", sql("vectors", """SELECT query_id, doc_id, round(score, 6) AS score
    FROM label_scored WHERE score >= 0.1""", _LABELS))
def score_dense(spark, sf_dir):
    index = T.dense_index(spark, sf_dir)
    queries = _label_queries(spark, sf_dir, 0.1, 10)
    n = _label_bounds(spark, sf_dir, 10).n
    unit_queries = dense.normalise_vectors(queries).withColumn(
        "k", F.lit(index.n_vectors).cast("int")
    )
    return dense.score_dense(index.vectors, unit_queries, n).select(
        "query_id", "doc_id", F.round("score", 6).alias("score")
    )


@query("topk_dense", sql("dense_top", _TOP.format("dense_top")))
def topk_dense(spark, sf_dir):
    queries = T.with_vectors(T.benchmark_queries(spark, sf_dir), spark, sf_dir)
    return _top(P.dense_hits(T.dense_index(spark, sf_dir), queries, P.query_bounds(queries)))


@query("exact_knn", sql("vectors", """SELECT query_id, doc_id, round(score, 6) AS score,
    CAST(position AS INTEGER) AS position FROM (SELECT *, row_number() OVER (
        PARTITION BY query_id ORDER BY score DESC, doc_id) AS position FROM label_scored)
    WHERE position <= 20""", _LABELS))
def exact_knn(spark, sf_dir):
    queries = _label_queries(spark, sf_dir, -1.0, 10)
    return _top(P.dense_hits(
        T.dense_index(spark, sf_dir), queries, _label_bounds(spark, sf_dir, 10)
    ))


PROBES = 8
# Distances to centres, less the square of the vector, which is the same for all of them.
_NEAR = f"""{_LABELS},
centre_values AS (SELECT label, d, avg(CAST(e[d] AS DOUBLE)) AS v FROM (
    SELECT b.label, v.e, unnest(range(1, len(v.e) + 1)) AS d
    FROM embeddings b JOIN vectors v ON v.doc_id = CAST(b.vec_id AS VARCHAR)) GROUP BY ALL),
centres AS MATERIALIZED (SELECT label, list(v ORDER BY d) AS c FROM centre_values GROUP BY label),
assigned AS MATERIALIZED (SELECT doc_id, arg_min(label, gap) AS cluster FROM (
    SELECT doc_id, label, list_inner_product(c, c) - 2 * {inner("e", "c")} AS gap
    FROM vectors, centres) GROUP BY doc_id),
probed AS (SELECT query_id, label AS cluster FROM (SELECT query_id, label, row_number() OVER (
    PARTITION BY query_id ORDER BY list_inner_product(c, c) - 2 * {inner("qe", "c")}, label) AS p
    FROM label_queries, centres) WHERE p <= {PROBES}),
near AS (SELECT query_id, doc_id, score, row_number() OVER (
    PARTITION BY query_id ORDER BY score DESC, doc_id) AS position
    FROM label_scored JOIN assigned USING (doc_id) JOIN probed USING (query_id, cluster)),
exact AS (SELECT query_id, doc_id FROM label_scored QUALIFY row_number() OVER (
    PARTITION BY query_id ORDER BY score DESC, doc_id) <= 10),
sizes AS (SELECT query_id, count(*) AS n_scored FROM assigned JOIN probed USING (cluster)
    GROUP BY query_id)"""


@query("ivf_knn", sql("vectors", """SELECT n.query_id, n.doc_id, round(n.score, 6) AS score,
    CAST(n.position AS INTEGER) AS position, e.doc_id IS NOT NULL AS in_exact, z.n_scored
    FROM near n JOIN sizes z USING (query_id)
    LEFT JOIN exact e ON e.query_id = n.query_id AND e.doc_id = n.doc_id
    WHERE n.position <= 10""", _NEAR))
def ivf_knn(spark, sf_dir):
    """Clustered search around given centres, what of it the exact search finds too, and the
    number of vectors that met each query."""
    queries, bounds = _label_queries(spark, sf_dir, -1.0, 5), _label_bounds(spark, sf_dir, 5)
    index = T.label_centres_index(spark, sf_dir)
    near = _top(P.dense_hits(index, queries, bounds, n_probe=PROBES))
    exact = P.dense_hits(index, queries, bounds).select(
        "query_id", "doc_id", F.lit(True).alias("in_exact"))
    probed = dense.nearest_clusters(
        dense.normalise_vectors(queries).select("query_id", "embedding"), index.centres, PROBES)
    met = probed.select("query_id", F.explode("clusters").alias("cluster_id")).join(
        index.vectors.groupBy("cluster_id").agg(F.count("*").alias("n")), "cluster_id")
    return (
        near.join(exact, ["query_id", "doc_id"], "left")
        .join(met.groupBy("query_id").agg(F.sum("n").alias("n_scored")), "query_id")
        .withColumn("in_exact", F.coalesce("in_exact", F.lit(False)))
    )


def letter_encoder():
    """A user's encoder: how often each letter occurs, as a 26-value vector."""
    def make():
        def encode(texts):
            rows = [[t.lower().count(chr(c)) for c in range(97, 123)] for t in texts]
            return np.array(rows, dtype=np.float32)
        return encode
    return make




_ENCODED = """SELECT {}, array_to_string(list_transform(range(97, 123),
    lambda l: length(lower(t)) - length(replace(lower(t), chr(CAST(l AS INTEGER)), ''))), ',')
    AS letters FROM encoded"""


@query("embed_documents", sql(
    "docs", _ENCODED.format("doc_id"),
    f"""base AS (SELECT *, {clean("content")} AS c FROM docs),
    sections AS (SELECT *, list_filter(string_split(c, '.'), lambda s: {" OR ".join(
        f"contains(lower(s), '{k}')" for k in V.SECTION_KEYWORDS)}) AS kept FROM base),
    keyed AS (SELECT *, array_to_string(list_transform(kept, lambda s: trim(s)), '. ') AS joined
        FROM sections),
    encoded AS (SELECT doc_id, '[' || upper(doc_type) || '] [ENTITY: ' || entity_id || '] ' ||
        CASE WHEN length(c) <= 2048 THEN c WHEN len(kept) = 0 THEN substring(c, 1, 2000)
        WHEN length(joined) > 2000 THEN substring(joined, 1, 2000) || '...' ELSE joined END AS t
        FROM keyed)"""))
def embed_documents(spark, sf_dir):
    encoded = dense.embed_documents(T.documents(spark, sf_dir), letter_encoder())
    return _letter_row(encoded, "doc_id")


def _letter_row(encoded, key):
    counts = F.transform("embedding", lambda x: x.cast("int").cast("string"))
    return encoded.select(key, F.array_join(counts, ",").alias("letters"))


@query("embed_queries", sql((), _ENCODED.format("query_id"), f"""encoded AS (
    SELECT CAST(item_id AS VARCHAR) AS query_id, '[SEARCH QUERY] ' || {clean("text")} AS t
    FROM benchmark)"""))
def embed_queries(spark, sf_dir):
    queries = T.benchmark_queries(spark, sf_dir)
    return _letter_row(dense.embed_queries(queries, letter_encoder()), "query_id")


@query("vector_cache", sql("docs", """SELECT doc_id FROM docs
    WHERE doc_id NOT IN (SELECT CAST(vec_id AS VARCHAR) FROM embeddings)"""))
def vector_cache(spark, sf_dir):
    held = T.dense_index(spark, sf_dir).vectors
    return dense.new_vectors(T.documents(spark, sf_dir), held).select("doc_id")


# --- fusion -----------------------------------------------------------------------


def _both(spark, sf_dir):
    queries = T.with_vectors(T.benchmark_queries(spark, sf_dir), spark, sf_dir)
    bounds = P.query_bounds(queries)
    left = P.sparse_hits(
        T.sparse_index(spark, sf_dir), queries, bounds, V.FUSION_OVERFETCH,
        V.FUSION_THRESHOLD_SHARE,
    )
    right = P.dense_hits(
        T.dense_index(spark, sf_dir), queries, bounds, V.FUSION_OVERFETCH,
        V.FUSION_THRESHOLD_SHARE,
    )
    return left, right


@query("fusion_join", sql("fusion", """SELECT query_id, doc_id,
    round(sparse_score, 6) AS sparse_score, CAST(sparse_rank AS INTEGER) AS sparse_rank,
    round(dense_score, 6) AS dense_score, CAST(dense_rank AS INTEGER) AS dense_rank FROM fusion"""))
def fusion_join(spark, sf_dir):
    return fusion.fusion_join(*_both(spark, sf_dir)).select(
        "query_id", "doc_id", F.round("sparse_score", 6).alias("sparse_score"), "sparse_rank",
        F.round("dense_score", 6).alias("dense_score"), "dense_rank",
    )


@query("union_candidates", sql("fusion", "SELECT DISTINCT query_id, doc_id FROM fusion"))
def union_candidates(spark, sf_dir):
    return fusion.union_candidates(*_both(spark, sf_dir))


@query("rank_positions", sql(("sparse_wide", "dense_wide"), """
    SELECT 'sparse' AS side, query_id, doc_id, CAST(position AS INTEGER) AS position
    FROM sparse_wide
    UNION ALL SELECT 'dense', query_id, doc_id, CAST(position AS INTEGER) FROM dense_wide"""))
def rank_positions(spark, sf_dir):
    left, right = _both(spark, sf_dir)
    return left.select(F.lit("sparse").alias("side"), "query_id", "doc_id", "position").unionByName(
        right.select(F.lit("dense").alias("side"), "query_id", "doc_id", "position")
    )


def _fusion(name, method, score):
    @query(name, sql("fusion", "SELECT query_id, doc_id, round(score, 6) AS score, in_sparse "
                               "FROM fused", fused(score)))
    def run(spark, sf_dir):
        return fusion.fuse(*_both(spark, sf_dir), method).select(
            "query_id", "doc_id", F.round("score", 6).alias("score"), "in_sparse"
        )
    return run


_fusion("fuse_weighted", "weighted_sum", WEIGHTED)
_fusion("fuse_max", "max", MAX)
_fusion("fuse_rrf", "rank_fusion", RRF)


@query("topk_hybrid", sql("fusion", "SELECT query_id, doc_id, round(score, 6) AS score, "
       "CAST(position AS INTEGER) AS position FROM hybrid_top", fused(WEIGHTED)))
def topk_hybrid(spark, sf_dir):
    queries = T.with_vectors(T.benchmark_queries(spark, sf_dir), spark, sf_dir)
    return _top(P.hybrid_hits(
        T.sparse_index(spark, sf_dir), T.dense_index(spark, sf_dir), queries,
        P.query_bounds(queries),
    ))


@query("fuse_sparse_only", sql("sparse_wide", """SELECT query_id, doc_id,
    round(0.4 * score, 6) AS weighted, round(score, 6) AS maximum,
    round(1.0 / (60 + position) + 1.0 / 61, 6) AS rrf FROM sparse_wide"""))
def fuse_sparse_only(spark, sf_dir):
    queries = T.benchmark_queries(spark, sf_dir)
    left = P.sparse_hits(
        T.sparse_index(spark, sf_dir), queries, P.query_bounds(queries), V.FUSION_OVERFETCH,
        V.FUSION_THRESHOLD_SHARE,
    )
    joined = fusion.fusion_join(left, left.limit(0))
    return joined.select(
        "query_id", "doc_id", F.round(fusion.weighted(), 6).alias("weighted"),
        F.round(fusion.maximum(), 6).alias("maximum"),
        F.round(fusion.reciprocal_rank(), 6).alias("rrf"),
    )

import math
import tempfile
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import docsearch
from checks import ingest_queries  # noqa: F401
from checks import tables as T
from checks.registry import QUERIES
from docsearch.functions import text as X
from docsearch.operators import dense, filters, kernels, sparse
from docsearch.plans import index as I
from docsearch.plans import search as P
from docsearch.runtime import written
from docsearch.schema import SparseParams
from docsearch.sources import documents as D
from docsearch.sources.index_store import SparseStore
from docsearch.streaming import ingest

PARAMS = SparseParams(stop_words=("the", "and", "of"))


@pytest.fixture(scope="module")
def index(spark, sample):
    return docsearch.build_sparse_index(sample, PARAMS)


def found(results):
    return {(r["query_id"], r["doc_id"]): (round(r["score"], 9), r["rank"])
            for r in results.select("query_id", "doc_id", "score", "rank").collect()}


def test_search_finds_ranks_and_explains(spark, index):
    rows = docsearch.search_sparse(
        index, docsearch.search_text(spark, "hosting fees agreement", similarity_threshold=0.01)
    ).orderBy("rank").collect()
    assert rows[0]["doc_id"] == "contract_1"
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
    assert [r["score"] for r in rows] == sorted((r["score"] for r in rows), reverse=True)
    assert {"hosting", "fees", "agreement"} <= set(rows[0]["matched_terms"])
    assert all(0 <= r["score"] <= 1 and r["context_snippet"] for r in rows)


def test_lone_placeholder_query_finds_nothing(spark, index):
    assert docsearch.search_sparse(index, docsearch.search_text(spark, "invoice")).count() == 0


def test_filters_and_thresholds(spark, index):
    def run(**options):
        return docsearch.search_sparse(
            index, docsearch.search_text(spark, "fees services payment", **options)
        ).collect()

    everything = run(similarity_threshold=0.01)
    assert len(run(similarity_threshold=0.3)) <= len(everything)
    assert {r["doc_type"] for r in run(doc_types=["contract"], similarity_threshold=0.01)} == {
        "contract"
    }
    assert {r["entity_id"] for r in run(entity_ids=["tech"], similarity_threshold=0.01)} == {"tech"}
    assert len(run(max_results=1, similarity_threshold=0.01)) == 1
    with pytest.raises(ValueError):
        docsearch.search_text(spark, "x", doc_types=["memo"])


def test_zero_threshold_returns_every_document(spark, index):
    query = docsearch.search_text(spark, "hosting", max_results=10).withColumn(
        "similarity_threshold", F.lit(0.0)
    )
    assert docsearch.search_sparse(index, query).count() == 5
    only = query.withColumn("entity_ids", F.array(F.lit("tech")))
    assert docsearch.search_sparse(index, only, prefilter=True).count() == 1


def test_weights_equal_brute_force(spark, sf_dir):
    docs = T.documents(spark, sf_dir)
    built = I.build_sparse_index(docs, SparseParams(stop_words=(), max_features=500))
    texts = {r["doc_id"]: r["tokens"] for r in built.docs.select("doc_id", "tokens").collect()}
    counts = {
        d: Counter(t) + Counter(f"{a} {b}" for a, b in zip(t, t[1:])) for d, t in texts.items()
    }
    n, df, ctf = len(counts), Counter(), Counter()
    for c in counts.values():
        df.update(c.keys())
        ctf.update(c)
    kept = sorted((t for t in df if df[t] <= 0.95 * n), key=lambda t: (-ctf[t], t))[:500]
    idf = {t: math.log((1 + n) / (1 + df[t])) + 1 for t in kept}
    expected = {}
    for d, c in counts.items():
        raw = {t: c[t] * idf[t] for t in c if t in idf}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        expected.update({(d, t): v / norm for t, v in raw.items()})
    actual = {(r["doc_id"], r["term"]): r["weight"] for r in built.postings.collect()}
    assert actual.keys() == expected.keys()
    assert max(abs(actual[k] - expected[k]) for k in actual) < 1e-12

    joined = sparse._weigh_by_join(built.docs, built.vocab, built.params)
    other = {(r["doc_id"], r["term"]): r["weight"] for r in joined.collect()}
    assert other.keys() == actual.keys()
    assert max(abs(actual[k] - other[k]) for k in actual) < 1e-12


def test_scores_in_blocks_of_queries_are_equal(spark, sf_dir):
    index, queries = T.sparse_index(spark, sf_dir), T.benchmark_queries(spark, sf_dir)
    weights = sparse.query_weights(queries, index.vocab, index.params, index.vocab_rows)

    def scores(rows):
        scored = sparse.score_sparse(index.postings, weights, rows)
        return sorted(tuple(r) for r in scored.collect())

    assert scores(10) == scores(2_000_000)


def test_stored_scores_are_summed_without_a_shuffle(spark, sf_dir):
    index, queries = T.sparse_index(spark, sf_dir), T.benchmark_queries(spark, sf_dir)
    weights = sparse.query_weights(queries, index.vocab, index.params, index.vocab_rows)
    scored = sparse.score_sparse(index.postings, written(weights, "weights"), 1000)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Bucketed: true" in plan


def test_batch_equals_single_queries_and_two_step_cut(spark, sf_dir):
    index = T.sparse_index(spark, sf_dir)
    queries = T.benchmark_queries(spark, sf_dir)
    batch = found(docsearch.search_sparse(index, queries))
    some = sorted({q for q, _ in batch})[:3]
    for q in some:
        alone = found(docsearch.search_sparse(index, queries.filter(F.col("query_id") == q)))
        assert alone == {k: v for k, v in batch.items() if k[0] == q}
    limit = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "1")
    try:
        assert found(docsearch.search_sparse(index, queries)) == batch
    finally:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", limit)


def test_passes_equal_one_scan(spark, sf_dir, monkeypatch):
    index = T.dense_index(spark, sf_dir)
    queries = T.with_vectors(T.benchmark_queries(spark, sf_dir, filtered=False), spark, sf_dir)
    bounds = P.query_bounds(queries)
    small = sorted(map(tuple, P.dense_hits(index, queries, bounds).collect()))
    monkeypatch.setattr(dense, "QUERIES_IN_MEMORY", 7)
    assert sorted(map(tuple, P.dense_hits(index, queries, bounds).collect())) == small


def test_probing_every_cluster_is_exact(spark, sf_dir, monkeypatch):
    exact, near = T.dense_index(spark, sf_dir), T.clustered_index(spark, sf_dir)
    queries = T.with_vectors(T.benchmark_queries(spark, sf_dir, filtered=False), spark, sf_dir)
    bounds = P.query_bounds(queries)
    expected = sorted(map(tuple, P.dense_hits(exact, queries, bounds).collect()))
    assert sorted(map(tuple, P.dense_hits(near, queries, bounds, n_probe=16).collect())) == expected
    monkeypatch.setattr(dense, "QUERIES_IN_MEMORY", 9)
    assert sorted(map(tuple, P.dense_hits(near, queries, bounds, n_probe=16).collect())) == expected


def test_store_grows_and_reloads(spark, sample):
    root = tempfile.mkdtemp(prefix="docsearch-store-")
    store = SparseStore(spark, root, PARAMS)
    assert store.load() is None
    store.append(sample.filter("doc_type = 'invoice'"), 0)
    assert store.refresh().n_docs == 2
    store.append(sample.filter("doc_type <> 'invoice'"), 1)
    store.append(sample.filter("doc_type <> 'invoice'"), 1)  # the same batch again
    grown = store.refresh()
    query = docsearch.search_text(spark, "hosting fees agreement", similarity_threshold=0.01)
    expected = found(docsearch.search_sparse(docsearch.build_sparse_index(sample, PARAMS), query))
    assert found(docsearch.search_sparse(grown, query)) == expected
    assert found(docsearch.search_sparse(SparseStore(spark, root).load(), query)) == expected

    store.append(sample.filter("doc_id = 'inv_1'"), 2)
    assert store.refresh().n_docs == 6
    assert SparseStore(spark, root, PARAMS, replace=True).refresh().n_docs == 5


def test_stream_refuses_bad_rows(spark, sample):
    arriving, root, state = (tempfile.mkdtemp(prefix="docsearch-stream-") for _ in range(3))
    flawed = sample.unionByName(
        sample.filter("doc_id = 'po_1'").withColumn("doc_type", F.lit("memo"))
        .withColumn("doc_id", F.lit("bad"))
    ).withColumn("metadata", F.parse_json(F.lit("{}")))
    flawed.coalesce(1).write.mode("append").parquet(arriving)
    store = SparseStore(spark, root, PARAMS)
    ingest.incremental_ingest(
        ingest.read_document_stream(spark, arriving), store, state, 2024
    ).awaitTermination()
    assert {r["doc_id"] for r in store.load().docs.select("doc_id").collect()} == {
        r["doc_id"] for r in sample.select("doc_id").collect()
    }


def test_json_array_file(spark):
    folder = tempfile.mkdtemp(prefix="docsearch-json-")
    with open(f"{folder}/docs.json", "w") as out:
        out.write('[{"id": "a", "content": "x", "entity_id": "e", "doc_type": "receipt",\n'
                  '"date": "2024-02-03T04:05:06.5", "metadata": {"amount": 2.5, "ok": true}},\n'
                  '{"id": "b", "content": "y", "entity_id": "e", "doc_type": "memo",\n'
                  '"date": "x", "metadata": {}}]')
    rows = D.read_documents_json(spark, f"{folder}/docs.json", array_file=True).select(
        "doc_id", "doc_type", F.col("date").isNull().alias("no_date"),
        X.metadata_get("metadata", "amount", "double", 0.0).alias("amount"),
    ).orderBy("doc_id").collect()
    assert [tuple(r) for r in rows] == [("a", "receipt", False, 2.5), ("b", None, True, 0.0)]


def test_plans_cut_early_and_prune(spark, sf_dir, capsys):
    index, queries = T.sparse_index(spark, sf_dir), T.benchmark_queries(spark, sf_dir)
    docsearch.search_sparse(index, queries).explain()
    plan = capsys.readouterr().out
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "dynamicpruning" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    filters.filter_entity(index.docs, ["src1"]).select("doc_id").explain()
    assert "PushedFilters: [IsNotNull(entity_id), EqualTo(entity_id,src1)]" in capsys.readouterr().out


def test_large_vocabulary_is_joined_by_term_and_salt(spark, sf_dir, monkeypatch):
    docs = T.documents(spark, sf_dir).limit(40)
    index = docsearch.build_sparse_index(docs, PARAMS)
    columns = ["term", "doc_id", "tf", F.round("weight", 9).alias("weight")]
    expected = sorted(map(tuple, index.postings.select(*columns).collect()))
    monkeypatch.setattr(sparse, "VOCABULARY_IN_MEMORY", 0)
    monkeypatch.setattr(sparse, "BROADCAST_ROWS", 0)
    joined = sparse.tfidf_weights(index.docs, index.vocab, index.params, index.vocab_rows)
    assert sorted(map(tuple, joined.select(*columns).collect())) == expected
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan


def test_check_results_checks_every_pair(spark, sf_dir):
    """No cut stands before the check: every vector with a sound row is there for every query."""
    index = T.dense_index(spark, sf_dir)
    rows = QUERIES["check_results"](spark, sf_dir).collect()
    ranks = {}
    for r in rows:
        assert r["score"] >= 0 and int(r["doc_id"]) % 5
        ranks.setdefault(r["query_id"], []).append(r["rank"])
    assert max(max(x) for x in ranks.values()) > index.n_vectors // 2 > 20
    assert min(len(x) for x in ranks.values()) > 2 * 10


def test_a_task_sends_hits_on_before_it_holds_too_many(monkeypatch):
    monkeypatch.setattr(kernels, "_HELD_ROWS", 10)
    rng = np.random.default_rng(1)
    vectors, asked = rng.normal(size=(60, 4)), rng.normal(size=(3, 4))

    def hits(k):
        batches = [pa.record_batch({
            "doc_id": pa.array([str(i) for i in range(at, at + 6)]),
            "batch_id": pa.array([0] * 6, pa.int64()),
            "embedding": pa.array(vectors[at:at + 6].tolist())}) for at in range(0, 60, 6)]
        run = kernels.batch_scorer(["a", "b", "c"], asked, [-9.0] * 3, [k] * 3, None)
        return list(run(iter(batches)))

    everything = hits(60)
    assert len(everything) > 1 and sum(b.num_rows for b in everything) == 180
    for q, name in enumerate("abc"):
        best = {str(i) for i in np.argsort(-np.minimum(vectors @ asked[q], 1.0))[:5]}
        found = {d for b in hits(5) for n, d in zip(
            b.column(0).to_pylist(), b.column(1).to_pylist()) if n == name}
        assert best <= found

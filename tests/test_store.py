"""Stored indexes: segments, versions, and what a failure on the way leaves behind."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

import docsearch
from checks import tables as T
from docsearch.operators import kernels, sparse
from docsearch.operators.sparse import DOC_KEY
from docsearch.plans import index as I
from docsearch.plans import search as P
from docsearch.runtime import new_folder
from docsearch.schema import SparseParams
from docsearch.sources import index_store
from docsearch.sources.bucketed import read_bucketed, write_bucketed
from docsearch.sources.index_store import DenseStore, HybridStore, SparseStore, due_merge
from docsearch.streaming import ingest

PARAMS = SparseParams(stop_words=("the", "and", "of"))


def found(index, spark):
    query = docsearch.search_text(spark, "hosting fees agreement paper", similarity_threshold=0.01)
    rows = docsearch.search_sparse(index, query, snippets=False).collect()
    return sorted((r["doc_id"], round(r["score"], 9), r["rank"]) for r in rows)


def bytes_below(folder):
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, fs in os.walk(folder) for f in fs)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_segments_are_merged_when_as_many_of_one_size_have_come():
    sizes = [(f"s{i}", 100) for i in range(7)]
    assert due_merge(sizes) == []
    assert due_merge([*sizes, ("b", 100)]) == [*(n for n, _ in sizes), "b"]
    assert due_merge([*sizes, ("big", 100_000)]) == []
    assert due_merge([("a", 1), ("b", 0), ("c", 70)], merge=2) == ["a", "b"]


def test_a_batch_writes_what_follows_the_batch(spark, sf_dir):
    """Ten times the corpus before it, the same batch writes about the same."""
    docs = T.documents(spark, sf_dir)
    batch = docs.filter("doc_id < '12'").withColumn("doc_id", F.concat(F.lit("new"), "doc_id"))
    written = []
    for before in (docs.limit(20), docs):
        store = SparseStore(spark, new_folder(spark, "grown"),
                            SparseParams(max_features=200, stop_words=()), 4, 4)
        store.append(before)
        store.publish()
        size = bytes_below(store.root)
        store.append(batch)
        store.publish()
        written.append(bytes_below(store.root) - size)
    assert written[1] < 1.5 * written[0]


def test_merged_segments_answer_alike_and_batches_can_come_again(spark, sample, monkeypatch):
    monkeypatch.setattr(index_store, "due_merge", lambda sizes: [n for n, _ in sizes if len(sizes) > 1])
    expected = found(I.build_sparse_index(sample, PARAMS), spark)
    store = SparseStore(spark, new_folder(spark, "merged"), PARAMS, 3, 3)
    store.append(sample.filter("doc_type = 'invoice'"), key="a")
    old = sample.filter("doc_id = 'po_1'").withColumn("content", F.lit("hosting paper paper"))
    assert store.append(old, key="b") == 1
    store.publish()
    assert len(store._state()[0]) == 1
    # Batch b lies in a merged segment now, and comes again.
    assert store.append(sample.filter("doc_id = 'po_1'"), key="b") == 1
    assert store.append(sample.filter("doc_type in ('contract', 'receipt')")) == 2
    assert not store.is_current()
    index = store.refresh()
    assert store.is_current() and index.n_docs == 5
    assert found(index, spark) == expected
    with pytest.raises(ValueError):
        store.append(sample, batch_id=1, key="c")


def test_outgrown_buckets_are_dealt_anew(spark, sample, monkeypatch):
    store = SparseStore(spark, new_folder(spark, "outgrown"), PARAMS)
    store.append(sample.filter("doc_type = 'invoice'"))
    monkeypatch.setattr(index_store, "BUCKET_BYTES", 10)
    store.append(sample.filter("doc_type <> 'invoice'"))
    index = store.refresh()
    (segment,) = store._state()[0].values()
    assert segment["posting_buckets"] > 4 * index_store.LEAST_BUCKETS
    assert found(index, spark) == found(I.build_sparse_index(sample, PARAMS), spark)


def test_a_save_that_dies_leaves_the_last_version(spark, sample, monkeypatch):
    store = SparseStore(spark, new_folder(spark, "killed"), PARAMS, 2, 2)
    store.save(I.build_sparse_index(sample, PARAMS))
    before = found(store.load(), spark)
    other = I.build_sparse_index(sample.filter("doc_type = 'invoice'"), PARAMS)
    for step in ("_write_segment", "_commit", "_write_version"):
        with monkeypatch.context() as broken:
            def die(*args, **kwargs):
                raise OSError("lost")
            broken.setattr(SparseStore, step, die)
            with pytest.raises(OSError):
                store.save(other)
        assert found(SparseStore(spark, store.root).load(), spark) == before
    assert store.save(other).n_docs == 2


def test_both_stores_become_searchable_together(spark, sample):
    store = HybridStore(spark, new_folder(spark, "pair"), PARAMS, 2, 2)
    docs = sample.withColumn("metadata", F.parse_json(F.lit("{}")))
    asked = []

    def vectors(new):
        asked.append(sorted(r["doc_id"] for r in new.select("doc_id").collect()))
        return new.select("doc_id", "batch_id", F.array(
            F.length("doc_id").cast("float"), F.lit(1.0).cast("float")).alias("embedding"))

    def broken(new):
        raise OSError("lost")

    first = docs.filter("doc_type = 'invoice'")
    left, right = ingest.add_documents(store, first, 2024, vectors, key="one")
    assert (left.n_docs, right.n_vectors) == (2, 2)
    before = found(left, spark)
    size = {f for f in os.listdir(f"{store.dense.root}/vectors") if f.startswith("segment")}
    with pytest.raises(OSError):
        ingest.add_documents(store, docs.filter("doc_type <> 'invoice'"), 2024, broken, key="two")
    left, right = HybridStore(spark, store.root, PARAMS).load()
    assert (left.n_docs, right.n_vectors, found(left, spark)) == (2, 2, before)
    left, right = ingest.add_documents(
        store, docs.filter("doc_type <> 'invoice'"), 2024, vectors, key="two")
    assert (left.n_docs, right.n_vectors) == (5, 5)
    # Only new documents are encoded, and what was there is not written again.
    assert asked[1] == ["contract_1", "po_1", "receipt_1"]
    assert size < set(os.listdir(f"{store.dense.root}/vectors"))
    assert found(left, spark) == found(I.build_sparse_index(sample, PARAMS), spark)


def test_filters_and_zero_thresholds_need_one_exchange(spark, sf_dir):
    index = T.sparse_index(spark, sf_dir)
    queries = T.benchmark_queries(spark, sf_dir, 0.05)
    bounds = P.query_bounds(queries)
    plan = plan_of(P.sparse_hits(index, queries, bounds, prefilter=True))
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning")
    for prefilter in (False, True):
        zero = queries.withColumn("similarity_threshold", F.lit(0.0))
        bounds = P.query_bounds(zero)
        plan = plan_of(P.sparse_hits(index, zero, bounds, prefilter=prefilter))
        assert plan.count("Exchange hashpartitioning") == 1
        assert "CartesianProduct" not in plan


def test_zero_thresholds_with_filters_equal_single_queries(spark, sf_dir):
    index = T.sparse_index(spark, sf_dir)
    queries = T.benchmark_queries(spark, sf_dir, 0.0, 30).withColumn(
        "similarity_threshold", F.when(F.col("query_id") % 4 == 1, 0.05).otherwise(0.0))

    def hits(table):
        rows = P.sparse_hits(index, table, P.query_bounds(table), prefilter=True).collect()
        return {(r["query_id"], r["doc_id"], r["score"], r["position"]) for r in rows}

    together = hits(queries)
    for q in sorted({q for q, *_ in together})[:2]:
        assert hits(queries.filter(F.col("query_id") == q)) == {h for h in together if h[0] == q}
    # A list is filled with the first ids that pass.
    passing = {r["doc_id"]: (r["entity_id"], r["doc_type"], r["date"]) for r in index.rows.collect()}
    for q in queries.filter("similarity_threshold = 0").orderBy("query_id").limit(5).collect():
        mine = [h for h in together if h[0] == q["query_id"]]
        allowed = sorted(d for d, (e, t, day) in passing.items() if
                         (not q["entity_ids"] or e in q["entity_ids"])
                         and (not q["doc_types"] or t in q["doc_types"])
                         and (q["date_from"] is None or day >= q["date_from"])
                         and (q["date_to"] is None or day <= q["date_to"]))
        assert len(mine) == min(60, len(allowed))
        rest = [d for d in allowed if d not in {h[1] for h in mine if h[2] > 0}]
        assert sorted(h[1] for h in mine if h[2] == 0) == rest[:sum(h[2] == 0 for h in mine)]


def bytes_read(spark, df):
    """Rows of ``df`` and the bytes that Hadoop's local file system read for them."""
    def total():
        return sum(s.getBytesRead() for s in
                   spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())
    before = total()
    rows = df.collect()
    return rows, total() - before


def test_bytes_read_follow_the_hits(spark, monkeypatch):
    """A few hits read their pages, many hits their buckets; the rows are the same."""
    text = F.concat_ws(" ", *[F.sha2(F.concat(F.col("id"), F.lit(k)).cast("string"), 256)
                              for k in map(str, range(24))])
    docs = spark.range(8000).select(
        F.lpad(F.col("id").cast("string"), 6, "0").alias("doc_id"), text.alias("content"))
    vectors = docs.select("doc_id", F.array(F.lit(1.0), F.lit(0.0)).cast("array<float>").alias("embedding"))
    store = DenseStore(spark, new_folder(spark, "pages"), doc_buckets=2)
    index = store.save(I.build_dense_index(docs, vectors))
    queries = P.search_text(spark, "any", max_results=5)
    bounds = P.QueryBounds(1, 5, 1, False)
    # Hadoop's counters leave out vectored reads.
    spark.conf.set("parquet.hadoop.vectored.io.enabled", "false")

    def hits(step):
        return spark.range(0, 8000, step).select(
            F.lit("q").alias("query_id"), F.lpad(F.col("id").cast("string"), 6, "0").alias("doc_id"),
            F.lit(0).cast("bigint").alias("batch_id"), F.lit(0.5).alias("score"))

    few, few_bytes = bytes_read(spark, P.hydrate_documents(hits(800), index, queries, bounds))
    more, more_bytes = bytes_read(spark, P.hydrate_documents(hits(80), index, queries, bounds))
    monkeypatch.setattr(P, "PUSHED_HITS", 0)
    whole, whole_bytes = bytes_read(spark, P.hydrate_documents(hits(800), index, queries, bounds))
    assert len(few) == 10 and len(more) == 100
    assert sorted(map(str, few)) == sorted(map(str, whole))
    assert all(r["content"] for r in more)
    spark.conf.unset("parquet.hadoop.vectored.io.enabled")
    assert few_bytes * 4 < whole_bytes and few_bytes < more_bytes


def test_postings_read_follow_the_query_terms(spark, monkeypatch):
    """Terms far apart read their pages only; more terms than are named find the same rows."""
    n = F.col("id")
    counts = spark.range(400_000).select(
        F.format_string("t%04d", n % 4000).alias("term"), F.sha2(n.cast("string"), 256).alias("doc_id"),
        F.lit(0).cast("bigint").alias("batch_id"), (n % 7).alias("tf"))
    folder = new_folder(spark, "terms")
    write_bucketed(counts.repartition(2, *DOC_KEY), folder, 2, DOC_KEY, ("term", *DOC_KEY))
    stored = read_bucketed(spark, [folder], "term string, doc_id string, batch_id bigint, tf bigint",
                           2, DOC_KEY)
    terms = [f"t{k:04}" for k in (*range(20, 34), 3990)]
    weights = spark.createDataFrame([("q", t) for t in terms], "query_id string, term string")
    spark.conf.set("parquet.hadoop.vectored.io.enabled", "false")
    few, few_bytes = bytes_read(spark, P._postings_of(stored, weights))
    monkeypatch.setattr(P, "PUSHED_TERMS", 10)
    whole, whole_bytes = bytes_read(spark, P._postings_of(stored, weights).join(weights.select("term"), "term"))
    spark.conf.unset("parquet.hadoop.vectored.io.enabled")
    assert len(few) == 1500 and sorted(map(tuple, few)) == sorted(map(tuple, whole))
    assert few_bytes * 2 < whole_bytes


def test_buckets_grow_with_the_text(spark):
    """A task sorts and scores one bucket, so a gigabyte of text is not left to a few of them."""
    postings, docs = SparseStore(spark, new_folder(spark, "sized"))._buckets_for(1 << 30)
    assert postings == docs >= 64


def test_a_large_statistics_table_is_made_once(spark, sample, monkeypatch):
    """The vocabulary is cut in several passes; the tokens are counted before them, once."""
    made = []
    kept = I.written
    monkeypatch.setattr(I, "written", lambda df, name: made.append(name) or kept(df, name))
    index = I.build_sparse_index(sample, SparseParams(stop_words=("the",)))
    assert made == ["docs", "freq", "vocab"] and index.vocab_rows > 0


def _word_docs(spark, texts):
    return spark.createDataFrame(
        [(f"d{i:03}", t) for i, t in enumerate(texts)], "doc_id string, content string"
    ).selectExpr("doc_id", "content", "'e' as entity_id", "'invoice' as doc_type",
                 "cast(null as timestamp_ntz) as date")


def _texts(n, common):
    rare = [f"rare{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(n)]
    return [" ".join([*common, f"{w}x", common[i % len(common)], f"{w}y"]) for i, w in enumerate(rare)]


def test_only_terms_that_can_be_in_the_vocabulary_are_counted_and_stored(spark):
    """Rare runs of words were written and shuffled, nearly one for each word of the corpus."""
    params = SparseParams(max_features=3, max_df=1.0, stop_words=())
    docs = _word_docs(spark, _texts(40, ("alpha", "beta", "gamma", "delta")))
    store = SparseStore(spark, new_folder(spark, "cut"), params, 2, 2)
    store.append(docs)
    index = store.refresh()
    tokens = I.tokenised_documents(docs, params)
    whole = sparse.term_statistics(tokens, params.ngram_range)
    plain = sparse.document_frequency(sparse.term_frequency(tokens, params.ngram_range))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, plain.collect()))
    freq, floor = sparse.vocabulary_statistics(tokens, 40, params)
    assert floor > 1 and freq.count() < 20 < whole.count()
    expected = sparse.prune_vocabulary(whole, 40, params).collect()
    assert sorted(r["term"] for r in index.vocab.collect()) == sorted(r["term"] for r in expected)
    assert index.counts.select("term").distinct().count() <= index_store.AHEAD * 3
    held = {(r["term"], r["doc_id"]): r["tf"] for r in index.postings.collect()}
    tf = sparse.term_frequency(tokens, params.ngram_range).collect()
    kept = {r["term"] for r in expected}
    assert held == {(r["term"], r["doc_id"]): r["tf"] for r in tf if r["term"] in kept}


@pytest.mark.parametrize("ngram_range", [(1, 2), (2, 3)])
def test_terms_that_come_into_the_vocabulary_are_counted_in_older_segments(spark, monkeypatch, ngram_range):
    monkeypatch.setattr(index_store, "AHEAD", 1)
    params = SparseParams(max_features=4, max_df=1.0, ngram_range=ngram_range, stop_words=())
    first = _word_docs(spark, [*_texts(30, ("alpha", "beta", "gamma")), "hosting fees fair", "hosting fees"])
    second = _word_docs(spark, ["hosting fees fair hosting fees fair"] * 60).withColumn(
        "doc_id", F.concat(F.lit("n"), "doc_id"))
    store = SparseStore(spark, new_folder(spark, "risen"), params, 2, 2)
    store.append(first)
    before = store.refresh()
    store.append(second)
    index = store.refresh()
    assert len(store._meta()["parts"]) == 3 and len(store._state()[0]) == 2
    whole = I.build_sparse_index(first.unionByName(second), params)

    def rows(of):
        return sorted((r["term"], r["doc_id"], r["tf"], round(r["weight"], 9)) for r in of.postings.collect())

    assert rows(index) == rows(whole) and rows(before) != rows(index)
    assert found(index, spark) == found(whole, spark)


def test_tokens_are_made_behind_the_exchange_of_the_documents(spark, sf_dir, monkeypatch):
    """Tokens went through the exchange and the sort beside the text, and took twice its room there."""
    plans, kept = [], DataFrameWriter.parquet

    def parquet(self, path, *args, **options):
        plans.append((path, plan_of(self._df)))
        return kept(self, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    docs = T.documents(spark, sf_dir)
    store = SparseStore(spark, new_folder(spark, "behind"), PARAMS, 2, 2)
    store.append(docs)
    above, below = next(p for path, p in plans if "/docs/segment=" in path).split("Exchange", 1)
    assert "regexp_extract_all" in above and "regexp_extract_all" not in below
    files = [os.path.join(at, f) for at, _, fs in os.walk(f"{store.root}/docs") for f in fs
             if f.endswith(".parquet")]
    ids = [pq.ParquetFile(f).read(columns=["doc_id"])["doc_id"].to_pylist() for f in files]
    assert all(part == sorted(part) for part in ids)
    stored = store._docs(list(store._state()[0]))
    plain = I.tokenised_documents(docs, PARAMS)
    assert sorted(map(tuple, stored.select("doc_id", "content", "tokens").collect())) == sorted(
        map(tuple, plain.select("doc_id", "content", "tokens").collect()))


def test_stored_tables_take_the_smaller_codec(spark, sample):
    store = SparseStore(spark, new_folder(spark, "small"), PARAMS, 2, 2)
    store.append(sample)
    store.refresh()
    for table in ("docs", "words", "postings", "versions"):
        files = [os.path.join(at, f) for at, _, fs in os.walk(f"{store.root}/{table}") for f in fs
                 if f.endswith(".parquet") and "vocab" not in at]
        footers = [pq.ParquetFile(f).metadata for f in files]
        found = {m.row_group(0).column(0).compression for m in footers if m.num_row_groups}
        assert found == {"ZSTD"}


def test_runs_of_words_leave_a_batch_in_order():
    """In order, neighbours share their first words, and the shuffle holds them in less room."""
    batch = pa.RecordBatch.from_pylist(
        [{"tokens": ["pear", "fig", "pear", "apple"]}, {"tokens": []}, {"tokens": ["fig", "pear", "fig"]}])
    found = [b.to_pydict() for b in kernels.statistics_counter(1, 2)(iter([batch]))]
    assert [b["term"] for b in found] == [
        ["apple", "fig", "pear"], ["fig pear", "pear apple", "pear fig"]]
    assert [b["df"] for b in found] == [[1, 2, 2], [2, 1, 2]]
    assert [b["ctf"] for b in found] == [[1, 3, 3], [2, 1, 2]]


def test_runs_of_words_are_dealt_before_they_are_summed(spark, sample):
    """A table of all runs of a task was made before the exchange; it saved little and spilled."""
    tokens = I.tokenised_documents(sample, PARAMS)
    plan = plan_of(sparse.term_statistics(tokens, (1, 2)))
    above, below = plan.split("Exchange", 1)
    assert above.count("HashAggregate") == 2 and "HashAggregate" not in below
    for low, high in ((1, 1), (1, 2), (2, 3)):
        found = sparse.term_statistics(tokens, (low, high)).collect()
        plain = sparse.document_frequency(sparse.term_frequency(tokens, (low, high))).collect()
        assert sorted(map(tuple, found)) == sorted(map(tuple, plain))

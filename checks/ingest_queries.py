"""Sources, sinks, validation and ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import settings as S
from checks import tables as T
from checks.oracle import blank, clean, presented, sql, strip, words
from checks.registry import query
from docsearch import fixed_values as V
from docsearch.functions import text as X
from docsearch.operators import validate
from docsearch.plans import index as I
from docsearch.plans import search as P
from docsearch.runtime import new_folder
from docsearch.sources import documents as D
from docsearch.sources.index_store import (
    DenseStore, HybridStore, SparseStore, load_hybrid, save_hybrid,
)
from docsearch.streaming import ingest

# --- sources and sinks ------------------------------------------------------------

_DOC_DATE = "strftime(date, '%Y-%m-%dT%H:%M:%S') AS date"


@query("read_documents_json", sql("docs", f"""SELECT doc_id, content, entity_id, doc_type,
    {_DOC_DATE}, lang, n_chars FROM docs"""))
def read_documents_json(spark, sf_dir):
    path = new_folder(spark, "json")
    D.write_documents_json(T.documents(spark, sf_dir), path)
    return D.read_documents_json(spark, path).select(
        "doc_id", "content", "entity_id", "doc_type", D.iso_date("date").alias("date"),
        X.metadata_get("metadata", "lang", "string").alias("lang"),
        X.metadata_get("metadata", "n_chars", "bigint").alias("n_chars"),
    )


@query("write_documents_json", sql("docs", """SELECT doc_type AS folder, count(*) AS n_docs,
    CAST(sum(length(content)) AS BIGINT) AS n_chars FROM docs GROUP BY ALL"""))
def write_documents_json(spark, sf_dir):
    path = new_folder(spark, "json-by-type")
    D.write_documents_json(T.documents(spark, sf_dir), path, by_type=True)
    lines = spark.read.schema("id string, content string, type string").json(path)
    return lines.groupBy(F.col("type").alias("folder")).agg(
        F.count("*").alias("n_docs"), F.sum(F.length("content")).alias("n_chars")
    )


@query("save_sparse_index", sql("vocab", "SELECT term, df, ctf, round(idf, 6) AS idf FROM vocab"))
def save_sparse_index(spark, sf_dir):
    store = SparseStore(spark, new_folder(spark, "saved"), T.PARAMS)
    index = store.save(I.build_sparse_index(T.documents(spark, sf_dir), T.PARAMS))
    return index.vocab.select("term", "df", "ctf", F.round("idf", 6).alias("idf"))


@query("load_sparse_index", sql("postings", """SELECT doc_id, count(*) AS n_terms,
    CAST(sum(tf) AS BIGINT) AS n_tokens, round(sum(weight), 6) AS weight_sum
    FROM postings GROUP BY doc_id"""))
def load_sparse_index(spark, sf_dir):
    root = new_folder(spark, "saved")
    store = SparseStore(spark, root, T.PARAMS)
    store.append(T.documents(spark, sf_dir), batch_id=0)
    store.refresh()
    loaded = SparseStore(spark, root).load()
    return loaded.postings.groupBy("doc_id").agg(
        F.count("*").alias("n_terms"), F.sum("tf").alias("n_tokens"),
        F.round(F.sum("weight"), 6).alias("weight_sum"),
    )


def _vector_rows(vectors):
    return vectors.select(
        "doc_id", F.size("embedding").cast("bigint").alias("n_dims"),
        F.round(F.col("embedding")[0].cast("double"), 6).alias("first_value"),
        F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x), 5).alias("total"),
    )


_VECTOR_ROWS = sql("vectors", """SELECT doc_id, len(e) AS n_dims,
    round(CAST(e[1] AS DOUBLE), 6) AS first_value,
    round(list_sum(CAST(e AS DOUBLE[])), 5) AS total FROM vectors""")


@query("save_dense_index", _VECTOR_ROWS)
def save_dense_index(spark, sf_dir):
    index = I.build_dense_index(T.documents(spark, sf_dir), T.vectors(spark, sf_dir))
    return _vector_rows(DenseStore(spark, new_folder(spark, "saved")).save(index).vectors)


@query("load_dense_index", _VECTOR_ROWS)
def load_dense_index(spark, sf_dir):
    root = new_folder(spark, "saved")
    DenseStore(spark, root).save(
        I.build_dense_index(T.documents(spark, sf_dir), T.vectors(spark, sf_dir), n_clusters=16)
    )
    return _vector_rows(DenseStore(spark, root).load().vectors)


@query("save_load_hybrid", sql(("cleaned", "vocab", "vectors"), """
    SELECT 'sparse' AS part, (SELECT count(*) FROM cleaned) AS n_docs,
        (SELECT count(*) FROM vocab) AS n_entries
    UNION ALL SELECT 'dense', (SELECT count(*) FROM docs), (SELECT count(*) FROM vectors)"""))
def save_load_hybrid(spark, sf_dir):
    root = new_folder(spark, "saved")
    save_hybrid(spark, root, T.sparse_index(spark, sf_dir), T.dense_index(spark, sf_dir))
    left, right = load_hybrid(spark, root)

    def part(name, docs, entries):
        both = docs.agg(F.count("*").alias("n_docs")).unionByName(
            entries.agg(F.count("*").alias("n_entries")), allowMissingColumns=True
        )
        return both.agg(
            F.lit(name).alias("part"), F.max("n_docs").alias("n_docs"),
            F.max("n_entries").alias("n_entries"),
        )

    return part("sparse", left.docs, left.vocab).unionByName(
        part("dense", right.docs, right.vectors)
    )


def _orders(spark, sf_dir, status):
    orders = T.table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == status)
    customers = T.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("key"), F.col("c_name").alias("name"),
        F.col("o_orderdate").alias("date"), F.col("o_totalprice").alias("amount"),
        F.concat(F.initcap("c_mktsegment"), F.lit(" services")).alias("item"),
    )


def _deliveries(spark, sf_dir):
    lines = T.table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.max("l_shipdate").alias("date"), F.sum("l_quantity").alias("amount")
    )
    suppliers = T.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_suppkey").alias("key"), F.col("s_name").alias("name"), "date", "amount",
        F.lit("Office supplies").alias("item"),
    )


def rendered(spark, sf_dir):
    return D.render_documents(
        _orders(spark, sf_dir, "F"), _orders(spark, sf_dir, "O"), _orders(spark, sf_dir, "P"),
        _deliveries(spark, sf_dir),
    )


def _money(c):
    return f"'$' || format('{{:,.2f}}', {c})"


def _day(c):
    return f"strftime({c}, '%Y-%m-%d')"


_RENDERED = f"""orders_of AS (SELECT o_orderkey AS key, c_name AS name, o_orderdate AS date,
    o_totalprice AS amount, o_orderstatus AS status,
    upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || ' services' AS item,
    lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS num
    FROM orders JOIN customer ON o_custkey = c_custkey),
deliveries AS (SELECT l_suppkey AS key, s_name AS name, date, amount, 'Office supplies' AS item,
    lpad(CAST(l_suppkey AS VARCHAR), 8, '0') AS num
    FROM (SELECT l_suppkey, max(l_shipdate) AS date, sum(l_quantity) AS amount
          FROM lineitem GROUP BY 1) JOIN supplier ON l_suppkey = s_suppkey),
rendered AS (
SELECT 'inv_' || num AS doc_id, concat_ws(chr(10),
    name || ' bills ' || item || ' under invoice number N' || num || '.',
    'Net ' || {_money("amount")} || ' with tax of ' || {_money("amount * 0.085::DOUBLE")}
        || ' makes a total of ' || {_money("amount * (1 + 0.085::DOUBLE)")} || '.',
    'Issued on ' || {_day("date")} || ' and payable until ' || {_day("date + INTERVAL 30 DAY")}
        || '.') AS content, name, 'invoice' AS doc_type, date,
    amount * (1 + 0.085::DOUBLE) AS gross, item FROM orders_of WHERE status = 'F'
UNION ALL SELECT 'po_' || num, concat_ws(chr(10),
    'Order B' || num || ' placed with ' || name || ' on ' || {_day("date")} || '.',
    'Goods: ' || item || ' for ' || {_money("amount")} || ', freight '
        || {_money("amount * 0.05::DOUBLE")} || ', together '
        || {_money("amount * (1 + 0.05::DOUBLE)")} || '.',
    'Delivery is expected by ' || {_day("date + INTERVAL 14 DAY")} || '.'),
    name, 'purchase_order', date, amount * (1 + 0.05::DOUBLE), item
    FROM orders_of WHERE status = 'O'
UNION ALL SELECT 'contract_' || num, concat_ws(chr(10),
    'Contract C' || num || ' with ' || name || ' covers ' || item || '.',
    'It runs for 12 months, from ' || {_day("date")} || ' until '
        || {_day("date + INTERVAL 360 DAY")} || '.',
    'Each month costs ' || {_money("amount")} || ', the whole term ' || {_money("amount * 12")}
        || '.'), name, 'contract', date, amount * 12, item FROM orders_of WHERE status = 'P'
UNION ALL SELECT 'receipt_' || num, concat_ws(chr(10),
    name || ' confirms payment R' || num || ' for ' || item || '.',
    'Paid on ' || {_day("date")} || ' at ' || strftime(date, '%H:%M') || ': '
        || {_money("amount * (1 + 0.0875::DOUBLE)")} || ', of which tax '
        || {_money("amount * 0.0875::DOUBLE")} || '.'), name, 'receipt', date,
    amount * (1 + 0.0875::DOUBLE), item FROM deliveries)"""


@query("render_documents", sql((), f"""SELECT doc_id, content,
    replace(replace(lower(name), ' ', '_'), '.', '') AS entity_id, doc_type,
    strftime(date, '%Y-%m-%d') AS date, round(gross, 6) AS gross,
    CASE doc_type WHEN 'receipt' THEN replace(lower(item), ' ', '_')
        ELSE lower(split_part(item, ' ', 1)) END AS category FROM rendered""", _RENDERED))
def render_documents(spark, sf_dir):
    gross = F.coalesce(
        X.metadata_get("metadata", "amount", "double"),
        X.metadata_get("metadata", "total_value", "double"),
    )
    category = F.coalesce(*[
        X.metadata_get("metadata", key, "string")
        for key in ("service_category", "item_category", "category")
    ])
    return rendered(spark, sf_dir).select(
        "doc_id", "content", "entity_id", "doc_type",
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.round(gross, 6).alias("gross"), category.alias("category"),
    )


@query("concat_corpus", sql((), """SELECT doc_type, count(*) AS n_docs,
    count(DISTINCT doc_id) AS n_ids, CAST(sum(length(content)) AS BIGINT) AS n_chars
    FROM rendered GROUP BY doc_type""", _RENDERED))
def concat_corpus(spark, sf_dir):
    return rendered(spark, sf_dir).groupBy("doc_type").agg(
        F.count("*").alias("n_docs"), F.countDistinct("doc_id").alias("n_ids"),
        F.sum(F.length("content")).alias("n_chars"),
    )


_RESULTS = presented("sparse_top", "SELECT * FROM cleaned")


@query("results_json", sql("sparse_top", """SELECT query_id, doc_id, rank, doc_id AS json_id,
    entity_id AS json_entity, doc_type AS json_type,
    strftime(date, '%Y-%m-%dT%H:%M:%S') AS json_date, lang AS json_lang,
    round(score, 4) AS json_score, context_snippet AS json_snippet,
    array_to_string(matched_terms, '|') AS json_terms
    FROM results JOIN (SELECT doc_id, lang FROM docs) USING (doc_id)""", _RESULTS))
def results_json(spark, sf_dir):
    results = P.search_sparse(T.sparse_index(spark, sf_dir), T.benchmark_queries(spark, sf_dir))
    fields = F.from_json(
        "json", "document struct<id string, entity_id string, doc_type string, date string, "
        "metadata struct<lang string>>, score double, context_snippet string, "
        "matched_terms array<string>, rank int",
    )
    return D.results_json(results).withColumn("r", fields).select(
        "query_id", "doc_id", "rank", F.col("r.document.id").alias("json_id"),
        F.col("r.document.entity_id").alias("json_entity"),
        F.col("r.document.doc_type").alias("json_type"),
        F.col("r.document.date").alias("json_date"),
        F.col("r.document.metadata.lang").alias("json_lang"),
        F.col("r.score").alias("json_score"),
        F.col("r.context_snippet").alias("json_snippet"),
        F.array_join("r.matched_terms", "|").alias("json_terms"),
    )


@query("search_response", sql("sparse_top", """SELECT query_id, q.text AS query,
    CAST(count(r.doc_id) AS INTEGER) AS results_count,
    coalesce(string_agg(r.doc_id, '|' ORDER BY r.rank), '') AS doc_ids
    FROM queries q LEFT JOIN results r USING (query_id) GROUP BY ALL""",
    presented("sparse_top", "SELECT * FROM cleaned", texts=False)))
def search_response(spark, sf_dir):
    queries = T.benchmark_queries(spark, sf_dir)
    results = P.search_sparse(T.sparse_index(spark, sf_dir), queries)
    response = D.search_response(results, queries)
    ids = F.transform("results", lambda r: F.get_json_object(r, "$.document.id"))
    return response.select(
        "query_id", "query", "results_count", F.array_join(ids, "|").alias("doc_ids")
    )


# --- validation -------------------------------------------------------------------


def _flawed_documents(spark, sf_dir):
    n = F.col("doc_id")
    types = F.array(*[F.lit(t) for t in (*V.DOC_TYPES, "memo")])
    day = F.make_date((1970 + n % 80).cast("int"), F.lit(5), F.lit(17))
    return T.table(spark, sf_dir, "documents").select(
        F.when(n % 19 == 0, F.lit("")).otherwise(n.cast("string")).alias("doc_id"),
        F.when(n % 13 == 0, F.lit(" \t\n")).otherwise(
            F.concat(F.lit("\n "), F.col("text"), F.lit("\t "))).alias("content"),
        F.when(n % 11 == 0, F.lit("  ")).otherwise(
            F.concat(F.lit(" "), F.col("source"))).alias("entity_id"),
        F.get(types, (n % 17).cast("int")).alias("doc_type"),
        F.when(n % 23 != 0, day).cast("timestamp_ntz").alias("date"),
    )


_FLAWED = f"""flawed AS (SELECT doc_id AS n,
    CASE WHEN doc_id % 19 = 0 THEN '' ELSE CAST(doc_id AS VARCHAR) END AS doc_id,
    CASE WHEN doc_id % 13 = 0 THEN ' ' || chr(9) || chr(10)
        ELSE chr(10) || ' ' || text || chr(9) || ' ' END AS content,
    CASE WHEN doc_id % 11 = 0 THEN '  ' ELSE ' ' || source END AS entity_id,
    [{words((*V.DOC_TYPES, "memo"))}][doc_id % 17 + 1] AS doc_type,
    CASE WHEN doc_id % 23 <> 0 THEN make_date(1970 + doc_id % 80, 5, 17) END AS date
    FROM documents)"""
_DOC_ERRORS = f"""array_to_string(list_filter([
    CASE WHEN {blank("doc_id")} THEN 'document id is required' END,
    CASE WHEN {blank("content")} THEN 'content is required' END,
    CASE WHEN {blank("entity_id")} THEN 'entity id is required' END,
    CASE WHEN doc_type NOT IN ({words(V.DOC_TYPES)}) THEN 'unknown document type' END,
    CASE WHEN date IS NULL THEN 'date is required' END,
    CASE WHEN year(date) < 1990 OR year(date) > {S.AS_OF_YEAR + 10} THEN 'date is out of range' END
    ], lambda e: e IS NOT NULL), '|')"""


@query("validate_documents", sql(
    (), f"SELECT doc_id, entity_id, doc_type, {_DOC_ERRORS} AS errors FROM flawed", _FLAWED))
def validate_documents(spark, sf_dir):
    checked = validate.validate_documents(_flawed_documents(spark, sf_dir), S.AS_OF_YEAR)
    return checked.select(
        "doc_id", "entity_id", "doc_type", F.array_join("errors", "|").alias("errors")
    )


@query("normalise_documents", sql((), f"""SELECT doc_id, {strip("content")} AS content,
    {strip("entity_id")} AS entity_id FROM flawed
    WHERE doc_id <> '' AND {strip("content")} <> '' AND {strip("entity_id")} <> ''""", _FLAWED))
def normalise_documents(spark, sf_dir):
    return validate.normalise_documents(_flawed_documents(spark, sf_dir)).select(
        "doc_id", "content", "entity_id"
    )


@query("duplicate_ids", """SELECT md5(text) AS doc_id, count(*) AS n_rows FROM documents
    GROUP BY 1 HAVING count(*) > 1""")
def duplicate_ids(spark, sf_dir):
    by_text = T.documents(spark, sf_dir).withColumn("doc_id", F.md5("content"))
    return validate.duplicate_ids(by_text)


@query("batch_guard", """SELECT source AS entity_id, count(*) AS n_docs, false AS is_empty,
    count(*) > 50 AS too_large, count(*) <= 50 AS accepted FROM documents GROUP BY 1""")
def batch_guard(spark, sf_dir):
    return validate.batch_guard(T.documents(spark, sf_dir), "entity_id", limit=50)


@query("clean_documents", sql("cleaned", "SELECT doc_id, content FROM cleaned"))
def clean_documents(spark, sf_dir):
    return validate.clean_documents(T.documents(spark, sf_dir)).select("doc_id", "content")


_TURN_QUERIES = """turn_queries AS (SELECT conv_id || '-' || turn AS query_id,
    CASE WHEN (conv_id + turn) % 7 = 0 THEN ' ' || chr(10) || ' '
        ELSE '  ' || text || chr(10) END AS text,
    CASE conv_id % 4 WHEN 0 THEN ['src1', 'src1', ' '] WHEN 1 THEN ['src2', 'src3', 'src2']
        WHEN 2 THEN [] END AS entity_ids,
    CASE conv_id % 5 WHEN 0 THEN ['invoice', 'Invoice'] WHEN 1 THEN ['receipt', 'receipt'] END
        AS doc_types,
    DATE '2023-06-01' + CAST(conv_id % 60 AS INTEGER) AS date_from,
    DATE '2023-06-01' + CAST(conv_id % 60 + turn * 10 - 20 AS INTEGER) AS date_to,
    (conv_id % 13) / 10.0 AS similarity_threshold,
    CAST((conv_id * 97) % 1201 - 20 AS INTEGER) AS max_results FROM conversations)"""
_QUERY_ERRORS = f"""array_to_string(list_filter([
    CASE WHEN {blank("text")} THEN 'query text is required' END,
    CASE WHEN similarity_threshold NOT BETWEEN 0 AND 1
        THEN 'similarity threshold must be between 0 and 1' END,
    CASE WHEN max_results <= 0 THEN 'max results must be positive' END,
    CASE WHEN max_results > 1000 THEN 'max results is too large' END,
    CASE WHEN list_contains(entity_ids, ' ') THEN 'blank entity id in filter' END,
    CASE WHEN list_contains(doc_types, 'Invoice') THEN 'unknown document type in filter' END,
    CASE WHEN date_from > date_to THEN 'date range starts after its end' END
    ], lambda e: e IS NOT NULL), '|')"""


@query("validate_queries", sql(
    (), f"SELECT query_id, {_QUERY_ERRORS} AS errors FROM turn_queries", _TURN_QUERIES))
def validate_queries(spark, sf_dir):
    return validate.validate_queries(T.conversation_queries(spark, sf_dir)).select(
        "query_id", F.array_join("errors", "|").alias("errors")
    )


@query("normalise_queries", sql((), f"""SELECT query_id, {strip("text")} AS text,
    CAST(similarity_threshold AS DOUBLE) AS similarity_threshold, max_results FROM turn_queries
    WHERE {strip("text")} <> '' AND similarity_threshold BETWEEN 0 AND 1
    AND max_results BETWEEN 1 AND 1000""", _TURN_QUERIES))
def normalise_queries(spark, sf_dir):
    return validate.normalise_queries(T.conversation_queries(spark, sf_dir)).select(
        "query_id", "text", "similarity_threshold", "max_results"
    )


@query("distinct_filters", sql((), """SELECT query_id,
    CASE WHEN len(entity_ids) > 0
        THEN array_to_string(list_sort(list_distinct(entity_ids)), '|') END AS entity_ids,
    CASE WHEN len(doc_types) > 0
        THEN array_to_string(list_sort(list_distinct(doc_types)), '|') END AS doc_types
    FROM turn_queries""", _TURN_QUERIES))
def distinct_filters(spark, sf_dir):
    sets = validate.distinct_filters(T.conversation_queries(spark, sf_dir))
    return sets.select("query_id", *[
        F.array_join(F.array_sort(c), "|").alias(c) for c in ("entity_ids", "doc_types")
    ])


@query("check_results", sql(("dense_scored", "docs"), f"""SELECT query_id, d.doc_id,
    CAST(position AS INTEGER) AS rank, round(least(score * CASE CAST(d.doc_id AS BIGINT) % 3
        WHEN 0 THEN -1.0 WHEN 1 THEN 1.0 ELSE 1.5 END, 1.0), 6) AS score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)
        AS position FROM dense_scored) s JOIN docs d USING (doc_id)
    WHERE score * CASE CAST(d.doc_id AS BIGINT) % 3 WHEN 0 THEN -1.0 WHEN 1 THEN 1.0 ELSE 1.5 END >= 0
        AND CAST(d.doc_id AS BIGINT) % 5 <> 0 AND NOT {blank("d.content")}"""))
def check_results(spark, sf_dir):
    """All rows of each query, some with a score below 0 or above 1 or a blank snippet."""
    queries = T.with_vectors(T.benchmark_queries(spark, sf_dir), spark, sf_dir)
    index, n_queries = T.dense_index(spark, sf_dir), P.query_bounds(queries).n
    # No score is below -2, whatever the rounding.
    everything = queries.withColumns({
        "similarity_threshold": F.lit(-2.0), "max_results": F.lit(index.n_vectors).cast("int"),
    })
    hits = P.dense_hits(
        index, everything, P.QueryBounds(n_queries, index.n_vectors, 0, False), factor=1)
    n = F.col("doc_id").cast("long")
    texts = T.documents(spark, sf_dir).select("doc_id", F.when(
        n % 5 == 0, F.lit(" \n")).otherwise(F.col("content")).alias("context_snippet"))
    results = hits.join(texts, "doc_id").withColumns({
        "rank": F.col("position"),
        "score": F.col("score") * F.when(n % 3 == 0, -1.0).when(n % 3 == 1, 1.0).otherwise(1.5),
    })
    return validate.check_results(results).select(
        "query_id", "doc_id", "rank", F.round("score", 6).alias("score")
    )


# --- growing an index -------------------------------------------------------------


@query("append_documents", sql("vocab", "SELECT term, df, ctf, round(idf, 6) AS idf FROM vocab"))
def append_documents(spark, sf_dir):
    docs = T.documents(spark, sf_dir)
    english = X.metadata_get("metadata", "lang", "string") == "en"
    store = SparseStore(spark, new_folder(spark, "grown"), T.PARAMS)
    store.append(docs.filter(english), batch_id=0)
    store.append(docs.filter(~english), batch_id=1)
    return store.refresh().vocab.select("term", "df", "ctf", F.round("idf", 6).alias("idf"))


@query("add_documents_hybrid", sql(("cleaned", "vectors"), """
    SELECT c.doc_id, length(c.content) AS cleaned_chars, length(d.content) AS original_chars,
        v.doc_id IS NOT NULL AS has_vector
    FROM cleaned c JOIN docs d USING (doc_id) LEFT JOIN vectors v USING (doc_id)"""))
def add_documents_hybrid(spark, sf_dir):
    """Two batches, each added to both indexes in one call."""
    store = HybridStore(spark, new_folder(spark, "both"), T.PARAMS)
    docs, vectors = T.documents(spark, sf_dir), T.vectors(spark, sf_dir)
    even = F.col("doc_id").cast("long") % 2 == 0

    def held(new):
        return new.select("doc_id", "batch_id").join(vectors, "doc_id")

    for part in (docs.filter(even), docs.filter(~even)):
        left, right = ingest.add_documents(store, part, S.AS_OF_YEAR, held)
    keys = ["doc_id", "batch_id"]
    cleaned = left.docs.select(*keys, F.length("content").cast("bigint").alias("cleaned_chars"))
    original = right.docs.select(*keys, F.length("content").cast("bigint").alias("original_chars"))
    with_vector = right.vectors.select(*keys, F.lit(True).alias("has_vector"))
    return cleaned.join(original, keys).join(with_vector, keys, "left").select(
        "doc_id", "cleaned_chars", "original_chars",
        F.coalesce("has_vector", F.lit(False)).alias("has_vector"),
    )


@query("ingest_rejects", sql("docs", """SELECT doc_id, errors, count(*) AS n_rows FROM (
    SELECT doc_id, concat_ws('|',
        CASE WHEN CAST(doc_id AS BIGINT) % 7 = 0 THEN 'content is required' END,
        CASE WHEN CAST(doc_id AS BIGINT) % 10 = 0 THEN 'document id is repeated in the batch' END
    ) AS errors
    FROM (SELECT doc_id FROM docs
          UNION ALL SELECT doc_id FROM docs WHERE CAST(doc_id AS BIGINT) % 10 = 0))
    WHERE errors <> '' GROUP BY ALL"""))
def ingest_rejects(spark, sf_dir):
    """Rows that a batch refuses, with all reasons."""
    docs, n = T.documents(spark, sf_dir), F.col("doc_id").cast("long")
    broken = docs.union(docs.filter(n % 10 == 0)).withColumn(
        "content", F.when(n % 7 == 0, F.lit(" \n")).otherwise(F.col("content")))
    store = SparseStore(spark, new_folder(spark, "refusing"), T.PARAMS)
    ingest.add_batch(store, broken, S.AS_OF_YEAR)
    return store.rejects().groupBy("doc_id", F.array_join("errors", "|").alias("errors")).agg(
        F.count("*").alias("n_rows"))


@query("incremental_ingest", sql("vocab", "SELECT term, df, ctf, round(idf, 6) AS idf FROM vocab"))
def incremental_ingest(spark, sf_dir):
    arriving, root = new_folder(spark, "arriving"), new_folder(spark, "streamed")
    T.documents(spark, sf_dir).repartition(2, "doc_id").write.parquet(arriving)
    store = SparseStore(spark, root, T.PARAMS)
    stream = ingest.read_document_stream(spark, arriving, files_per_trigger=1)
    ingest.incremental_ingest(
        stream, store, new_folder(spark, "stream-state"), S.AS_OF_YEAR
    )
    return store.load().vocab.select("term", "df", "ctf", F.round("idf", 6).alias("idf"))

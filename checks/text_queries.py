"""Text, date and metadata rules over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import settings as S
from checks import tables as T
from checks.oracle import (
    AMOUNT, DATE, INVOICE, ORDER, bigrams, clean, mask, matched, query_words, snippet, sql,
    strip, tokens, words,
)
from checks.registry import query
from docsearch import fixed_values as V
from docsearch.functions import text as X
from docsearch.operators import sparse, validate
from docsearch.plans import search as P
from docsearch.sources import documents as D


def _joined(c):
    return F.array_join(c, "|")


def _document_text(name, column, sql_value):
    """Register a rule of one document text."""
    @query(name, sql("docs", f"SELECT doc_id, {sql_value} AS {name} FROM docs"))
    def run(spark, sf_dir):
        return T.documents(spark, sf_dir).select("doc_id", column("content").alias(name))
    return run


_document_text("clean_text", X.clean_text, clean("content"))
_document_text("mask_patterns", X.mask_patterns, mask("content"))
_document_text(
    "extract_key_terms", lambda c: _joined(X.extract_key_terms(c)),
    f"array_to_string(list_sort(list_filter([{words(V.FINANCE_TERMS)}], "
    "lambda t: contains(lower(content), t))), '|')",
)
_document_text(
    "extract_amounts", lambda c: _joined(X.extract_amounts(c)),
    f"array_to_string(regexp_extract_all(content, '{AMOUNT}'), '|')",
)
_document_text(
    "extract_dates", lambda c: _joined(X.extract_dates(c)),
    f"array_to_string(regexp_extract_all(content, '{DATE}'), '|')",
)
_document_text(
    "extract_invoice_numbers", lambda c: _joined(X.extract_invoice_numbers(c)),
    f"array_to_string(regexp_extract_all(content, '{INVOICE}', 1), '|')",
)
_document_text(
    "extract_po_numbers", lambda c: _joined(X.extract_po_numbers(c)),
    f"array_to_string(regexp_extract_all(content, '{ORDER}', 1), '|')",
)
_document_text(
    "tokenise", lambda c: F.array_join(X.tokenise(X.clean_text(c), S.STOP_WORDS), " "),
    f"array_to_string({tokens(clean('content'))}, ' ')",
)
_document_text(
    "tokenise_fallback", lambda c: F.array_join(X.tokenise_fallback(X.clean_text(c)), " "),
    rf"array_to_string(regexp_extract_all(lower({clean('content')}), '[\p{{L}}\p{{N}}_]{{2,}}'), ' ')",
)


@query("ngrams", sql("toks", f"SELECT doc_id, len({bigrams('t')}) AS n_terms, "
                             f"array_to_string({bigrams('t')}, '|') AS ngrams FROM toks"))
def ngrams(spark, sf_dir):
    tokenised = sparse.with_tokens(
        validate.clean_documents(T.documents(spark, sf_dir)), T.PARAMS
    )
    terms = X.ngrams("tokens", V.NGRAM_RANGE)
    return tokenised.select("doc_id", terms.alias("t")).select(
        "doc_id", F.size("t").cast("bigint").alias("n_terms"), _joined("t").alias("ngrams")
    )


_SECTIONS = f"list_filter(string_split(c, '.'), lambda s: " + " OR ".join(
    f"contains(lower(s), '{k}')" for k in V.SECTION_KEYWORDS) + ")"
_KEY_SECTIONS = f"""sections AS (SELECT *, array_to_string(list_transform({_SECTIONS},
    lambda s: {strip("s")}), '. ') AS joined, len({_SECTIONS}) AS found FROM base),
keyed AS (SELECT *, CASE WHEN found = 0 THEN substring(c, 1, 2000)
    WHEN length(joined) > 2000 THEN substring(joined, 1, 2000) || '...' ELSE joined END AS key_text
    FROM sections)"""


@query("key_sections", sql("docs", "SELECT doc_id, key_text AS key_sections FROM keyed",
                           f"base AS (SELECT *, {clean('content')} AS c FROM docs),"
                           + _KEY_SECTIONS))
def key_sections(spark, sf_dir):
    cleaned = T.documents(spark, sf_dir).select("doc_id", X.clean_text("content").alias("c"))
    return cleaned.select("doc_id", X.key_sections("c").alias("key_sections"))


@query("embedding_text", sql(
    "docs", "SELECT doc_id, '[' || upper(doc_type) || '] [ENTITY: ' || entity_id || '] ' || "
    "CASE WHEN length(c) > 2048 THEN substring(key_text, 1, 2048) ELSE c END AS embedding_text "
    "FROM keyed", f"base AS (SELECT *, {clean('content')} AS c FROM docs)," + _KEY_SECTIONS))
def embedding_text(spark, sf_dir):
    return T.documents(spark, sf_dir).select(
        "doc_id", X.embedding_text("content", "doc_type", "entity_id").alias("embedding_text")
    )


_TURNS = "SELECT conv_id || '-' || turn AS query_id, {} FROM conversations"


@query("query_embedding_text", _TURNS.format(
    f"'[SEARCH QUERY] ' || {clean('text')} AS query_embedding_text"))
def query_embedding_text(spark, sf_dir):
    turns = T.table(spark, sf_dir, "conversations")
    return turns.select(
        F.concat_ws("-", F.col("conv_id"), F.col("turn")).alias("query_id"),
        X.query_embedding_text("text").alias("query_embedding_text"),
    )


@query("query_terms", _TURNS.format(
    f"array_to_string({query_words('text')}, '|') AS query_terms"))
def query_terms(spark, sf_dir):
    turns = T.table(spark, sf_dir, "conversations")
    return turns.select(
        F.concat_ws("-", F.col("conv_id"), F.col("turn")).alias("query_id"),
        _joined(X.query_terms("text")).alias("query_terms"),
    )


_WORDS = query_words(f"'{S.QUERY_TEXT}'")


@query("matched_terms", sql(
    "docs", f"SELECT doc_id, array_to_string({matched('content', _WORDS)}, '|') "
            "AS matched_terms FROM docs"))
def matched_terms(spark, sf_dir):
    terms = X.query_terms(F.lit(S.QUERY_TEXT))
    return T.documents(spark, sf_dir).select(
        "doc_id", _joined(X.matched_terms("content", terms)).alias("matched_terms")
    )


@query("context_snippet", sql(
    "docs", "SELECT doc_id, context_snippet FROM cut",
    f"base AS (SELECT doc_id, content, {_WORDS} AS terms FROM docs)," + snippet("base", "cut")))
def context_snippet(spark, sf_dir):
    terms = X.query_terms(F.lit(S.QUERY_TEXT))
    return T.documents(spark, sf_dir).select(
        "doc_id", X.context_snippet("content", terms).alias("context_snippet")
    )


@query("is_financial_document", sql(
    "docs", f"SELECT doc_id, doc_type IN ({words(V.FINANCIAL_DOC_TYPES)}) AS is_financial "
            "FROM docs"))
def is_financial_document(spark, sf_dir):
    return T.documents(spark, sf_dir).select(
        "doc_id", X.is_financial_document("doc_type").alias("is_financial")
    )


@query("entity_key", "SELECT c_custkey, replace(replace(lower(c_name || ' ' || c_mktsegment "
                     "|| ' Inc.'), ' ', '_'), '.', '') AS entity_key FROM customer")
def entity_key(spark, sf_dir):
    name = F.concat_ws(" ", "c_name", "c_mktsegment", F.lit("Inc."))
    return T.table(spark, sf_dir, "customer").select(
        "c_custkey", X.entity_key(name).alias("entity_key")
    )


@query("metadata_get", "SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS k, "
                       "-1.0::DOUBLE AS amount FROM events")
def metadata_get(spark, sf_dir):
    events = T.table(spark, sf_dir, "events").select(
        "event_id", F.parse_json("props").alias("metadata")
    )
    return events.select(
        "event_id", X.metadata_get("metadata", "k", "double").alias("k"),
        X.metadata_get("metadata", "amount", "double", -1.0).alias("amount"),
    )


@query("parse_dates", """SELECT o_orderkey, CASE o_orderstatus
        WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00'
        WHEN 'O' THEN strftime(o_orderdate, '%Y-%m-%d') || ' 10:30:00' END AS parsed
    FROM orders""")
def parse_dates(spark, sf_dir):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    raw = F.when(F.col("o_orderstatus") == "F", day).when(
        F.col("o_orderstatus") == "O", F.concat(day, F.lit("T10:30:00"))
    ).otherwise(F.concat(day, F.lit("T10:30:00+02:00")))
    return T.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format(X.parse_iso_date(raw), "yyyy-MM-dd HH:mm:ss").alias("parsed"),
    )


@query("parse_doc_type", sql(
    "docs", "SELECT doc_id, CASE WHEN lang = 'en' THEN doc_type END AS parsed FROM docs"))
def parse_doc_type(spark, sf_dir):
    docs = T.documents(spark, sf_dir)
    lang = X.metadata_get("metadata", "lang", "string")
    raw = F.when(lang == "en", F.col("doc_type")).otherwise(F.upper("doc_type"))
    return docs.select("doc_id", X.parse_doc_type(raw).alias("parsed"))


@query("tag_search_mode", sql("sparse_top", """SELECT query_id, doc_id,
    CAST(position AS INTEGER) AS position, 'tfidf' AS search_mode FROM sparse_top"""))
def tag_search_mode(spark, sf_dir):
    index, queries = T.sparse_index(spark, sf_dir), T.benchmark_queries(spark, sf_dir)
    hits = P.sparse_hits(index, queries, P.query_bounds(queries))
    return P.tag_search_mode(hits.select("query_id", "doc_id", "position"), "tfidf")


@query("document_types", sql("docs", f"""SELECT CAST(u.position - 1 AS INTEGER) AS position,
    u.doc_type, count(d.doc_id) AS n_docs
    FROM (SELECT unnest([{words(V.DOC_TYPES)}]) AS doc_type, unnest(range(1, 17)) AS position) u
    LEFT JOIN docs d USING (doc_type) GROUP BY ALL"""))
def document_types(spark, sf_dir):
    return D.document_types(T.documents(spark, sf_dir))

"""Document sources and sinks: JSON files, business tables, result JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsearch import fixed_values as V
from docsearch.functions import text as X

_JSON = (
    "id string, content string, entity_id string, doc_type string, date string, "
    "metadata variant"
)


# --- JSON documents -----------------------------------------------------------


def read_documents_json(spark: SparkSession, path: str, array_file: bool = False) -> DataFrame:
    """Documents from JSON. Unknown types and malformed dates become null.

    One object per line is read in parallel. A file that holds one JSON array
    (``array_file=True``) cannot be split: one task reads it.
    """
    raw = spark.read.schema(_JSON).option("multiLine", array_file).json(path)
    return raw.select(
        F.col("id").alias("doc_id"), "content", "entity_id",
        X.parse_doc_type("doc_type").alias("doc_type"),
        X.parse_iso_date("date").alias("date"),
        F.coalesce("metadata", F.parse_json(F.lit("{}"))).alias("metadata"),
    )


def iso_date(c: Column | str) -> Column:
    """ISO text of a naive date; microseconds only where there are any."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(
        F.date_format(c, "SSSSSS") == "000000", F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    ).otherwise(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def write_documents_json(docs: DataFrame, path: str, by_type: bool = False) -> None:
    """Write documents as JSON lines: all together, or one folder per type."""
    out = docs.select(
        F.col("doc_id").alias("id"), "content", "entity_id", "doc_type",
        iso_date("date").alias("date"), "metadata",
    )
    if by_type:
        typed = out.withColumn("type", F.col("doc_type"))
        typed.write.mode("overwrite").partitionBy("type").json(path)
    else:
        out.write.mode("overwrite").json(path)


# --- documents from tables ------------------------------------------------------


def money(amount: Column) -> Column:
    """Amount with thousands separators and two decimals."""
    return F.concat(F.lit("$"), F.format_number(amount, 2))


def _document(df: DataFrame, doc_id: Column, lines: list[Column], doc_type: str,
              name: str, date: str, metadata: dict[str, Column]) -> DataFrame:
    return df.select(
        doc_id.alias("doc_id"),
        F.concat_ws("\n", *lines).alias("content"),
        X.entity_key(name).alias("entity_id"),
        F.lit(doc_type).alias("doc_type"),
        F.col(date).cast("timestamp_ntz").alias("date"),
        F.to_variant_object(F.struct(
            *[value.alias(key) for key, value in metadata.items()]
        )).alias("metadata"),
    )


def _day(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def _number(prefix: str, c: str) -> Column:
    return F.concat(F.lit(prefix), F.lpad(F.col(c).cast("string"), 8, "0"))


def _first_word(c: Column) -> Column:
    return F.lower(F.substring_index(c, " ", 1))


def _sentence(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts], F.lit("."))


def render_invoices(rows: DataFrame, tax_rate: float = 0.085) -> DataFrame:
    """Invoice text from ``key, name, date, amount, item``."""
    net, due = F.col("amount"), F.date_add("date", 30)
    gross = net * (1 + tax_rate)
    return _document(rows, _number("inv_", "key"), [
        _sentence(F.col("name"), " bills ", F.col("item"), " under invoice number ",
                  _number("N", "key")),
        _sentence("Net ", money(net), " with tax of ", money(net * tax_rate), " makes a total of ",
                  money(gross)),
        _sentence("Issued on ", _day("date"), " and payable until ", _day(due)),
    ], "invoice", "name", "date", {
        "amount": gross, "tax_rate": F.lit(tax_rate),
        "due_date": _day(due), "service_category": _first_word(F.col("item")),
    })


def render_purchase_orders(rows: DataFrame, shipping_rate: float = 0.05) -> DataFrame:
    """Purchase order text from ``key, name, date, amount, item``."""
    net, delivery = F.col("amount"), F.date_add("date", 14)
    gross = net * (1 + shipping_rate)
    return _document(rows, _number("po_", "key"), [
        _sentence("Order ", _number("B", "key"), " placed with ", F.col("name"), " on ",
                  _day("date")),
        _sentence("Goods: ", F.col("item"), " for ", money(net), ", freight ",
                  money(net * shipping_rate), ", together ", money(gross)),
        _sentence("Delivery is expected by ", _day(delivery)),
    ], "purchase_order", "name", "date", {
        "amount": gross, "shipping_cost": net * shipping_rate,
        "delivery_date": _day(delivery), "item_category": _first_word(F.col("item")),
    })


def render_contracts(rows: DataFrame, months: int = 12) -> DataFrame:
    """Contract text from ``key, name, date, amount, item``; the amount is monthly."""
    fee, end = F.col("amount"), F.date_add("date", months * 30)
    return _document(rows, _number("contract_", "key"), [
        _sentence("Contract ", _number("C", "key"), " with ", F.col("name"), " covers ",
                  F.col("item")),
        _sentence("It runs for ", f"{months} months, from ", _day("date"), " until ", _day(end)),
        _sentence("Each month costs ", money(fee), ", the whole term ", money(fee * months)),
    ], "contract", "name", "date", {
        "monthly_fee": fee, "duration_months": F.lit(months), "total_value": fee * months,
        "end_date": _day(end), "service_category": _first_word(F.col("item")),
    })


def render_receipts(rows: DataFrame, tax_rate: float = 0.0875) -> DataFrame:
    """Receipt text from ``key, name, date, amount, item``."""
    net = F.col("amount")
    gross = net * (1 + tax_rate)
    return _document(rows, _number("receipt_", "key"), [
        _sentence(F.col("name"), " confirms payment ", _number("R", "key"), " for ", F.col("item")),
        _sentence("Paid on ", _day("date"), " at ", F.date_format("date", "HH:mm"), ": ",
                  money(gross), ", of which tax ", money(net * tax_rate)),
    ], "receipt", "name", "date", {
        "amount": gross, "tax_rate": F.lit(tax_rate),
        "category": F.replace(F.lower("item"), F.lit(" "), F.lit("_")),
    })


def render_documents(
    invoices: DataFrame, purchase_orders: DataFrame, contracts: DataFrame, receipts: DataFrame
) -> DataFrame:
    """Documents of all four kinds from business rows."""
    return concat_corpus(
        render_invoices(invoices), render_purchase_orders(purchase_orders),
        render_contracts(contracts), render_receipts(receipts),
    )


def concat_corpus(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Concatenate document tables."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


# --- result JSON ------------------------------------------------------------------


def _result_fields(score_digits: int = 4) -> Column:
    return F.struct(
        F.struct(
            F.col("doc_id").alias("id"), F.col("entity_id"), F.col("doc_type"),
            iso_date("date").alias("date"), F.col("metadata"),
        ).alias("document"),
        F.round("score", score_digits).alias("score"),
        F.col("context_snippet"), F.col("matched_terms"), F.col("rank"),
    )


def results_json(results: DataFrame) -> DataFrame:
    """Each result row as a JSON object, without the document text."""
    return results.select("query_id", "doc_id", "rank", F.to_json(_result_fields()).alias("json"))


def search_response(results: DataFrame, queries: DataFrame, seconds: Column | float = 0.0) -> DataFrame:
    """One response row per query: text, count, time, results in rank order.

    The list of a query holds at most its ``max_results`` rows.
    """
    seconds = F.lit(seconds) if isinstance(seconds, (int, float)) else seconds
    listed = results.groupBy("query_id").agg(
        F.count("*").cast("int").alias("results_count"),
        F.array_sort(F.collect_list(
            F.struct(F.col("rank"), F.to_json(_result_fields()).alias("json"))
        )).alias("_ranked"),
    )
    return queries.select("query_id", F.col("text").alias("query")).join(
        listed, "query_id", "left"
    ).select(
        "query_id", "query",
        F.coalesce("results_count", F.lit(0)).alias("results_count"),
        seconds.cast("double").alias("search_time"),
        F.coalesce(
            F.transform("_ranked", lambda r: r["json"]), F.array().cast("array<string>")
        ).alias("results"),
    )


def document_types(docs: DataFrame) -> DataFrame:
    """All document types in listing order, with their number of documents."""
    spark = docs.sparkSession
    listed = spark.createDataFrame(list(enumerate(V.DOC_TYPES)), "position int, doc_type string")
    counts = docs.groupBy("doc_type").agg(F.count("*").alias("n_docs"))
    # At most one row for each listed type is left on the counted side.
    counts = counts.filter(F.col("doc_type").isin(*V.DOC_TYPES))
    return listed.join(F.broadcast(counts), "doc_type", "left").select(
        "position", "doc_type", F.coalesce("n_docs", F.lit(0)).alias("n_docs")
    )

"""The registered queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsearch.llm import (
    decontamination,
    fingerprint,
    language_id,
    licenses,
    mixing,
    periodic_runs,
    ppm,
    rule_ensemble,
    simhash_dedup,
    substring_dedup,
    toxicity,
    url_filter,
    whitening,
)
from docsearch.llm.common import SPACE, fold, table, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def hex_of(column: str):
    return F.lower(F.lpad(F.hex(column), 16, "0"))


@query("op3_simhash_dedup")
def simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_of("fingerprint").alias("fingerprint"), "component_id")


def learned(modulus: int, left_out: int):
    return fold("doc_id", modulus) != left_out


@query("op4_kneser_ney_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    classifier = toxicity.fit(docs, table(spark, sf_dir, "labels"), learned(5, 0))
    return toxicity.score(docs, classifier).select(
        "doc_id", (~learned(5, 0)).alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= 0.5).cast("int").alias("predicted"))


@query("op5_entropy_mixing")
def entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(table(spark, sf_dir, "documents").select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "source",
        mixing.n_words().alias("size")), "sizes")
    mixed = mixing.copies(rows)
    return rows.join(mixed, "row").select(
        "doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "copies")


@query("op6_bm25_decontamination")
def contaminated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_fm_substring_dedup")
def substring_dedup_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.cut(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op1_ppm_score")
def ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(table(spark, sf_dir, "documents"), learned(7, 2))


@query("op2_ecoc_language_id")
def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.predict(docs, language_id.fit(docs, learned(5, 0)))
    return found.select("doc_id", (~learned(5, 0)).alias("held_out"), "lang_pred", "score",
                        "ambiguous")


URL_RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]


@query("op7_url_filter")
def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


@query("op9_simhash_fingerprints")
def edited_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited(table(spark, sf_dir, "documents"))


@query("fingerprint_search")
def fingerprint_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries are the rows whose id is divisible by 100, against all rows."""
    prints = written(fingerprint.fingerprints(table(spark, sf_dir, "documents")), "prints")
    asked = F.col("doc_id") % 100 == 0
    found = fingerprint.within_radius(prints, asked)
    return prints.filter(asked).join(found, "fingerprint").select(
        "doc_id", F.col("first_id").alias("near_id"), "n_docs", "distance")


@query("op10_license_scan")
def license_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op11_block_whitening")
def whitened_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", whitening.fixed_point(F.col("embedding"), 64, 1_000_000).alias("x"))
    found = whitening.whiten(vectors, id_column="vec_id")
    parts = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "part")
    return found.select(
        F.col("id").alias("vec_id"), "n", F.col("deviation").cast("long").alias("deviation"),
        "identity_error", parts).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation",
        F.col("part.whitened").alias("whitened"), F.col("part.explained").alias("explained"),
        "identity_error")


@query("op13_rule_quality")
def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ensemble = rule_ensemble.fit(docs, table(spark, sf_dir, "labels"), learned(3, 1))
    return rule_ensemble.score(docs, ensemble).select(
        "doc_id", (~learned(3, 1)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def tailed_with_copies(docs):
    """Documents a tenth of which go on with copies of a stretch of theirs, by their id."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    split = F.filter(F.split(F.coalesce("text", F.lit("")), SPACE), lambda w: w != "")
    cut = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, split).alias("words"))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    sized = cut.withColumns({"n": n, "a": F.when(n > 0, (g % n).cast("int")), "g": g})
    period = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    dealt = sized.withColumn("p", period)
    copies = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), copies))
    edited = F.slice(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), F.lit(1), F.col("n"))
    return dealt.select("doc_id", F.when(
        F.col("n") > 0, F.array_join(edited, " ")).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def periodic_run_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find(tailed_with_copies(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("best", periodic_runs.longest_run("runs"))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length",
        "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))

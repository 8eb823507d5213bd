"""Sparse (TF-IDF) index and scoring."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsearch.functions import text as X
from docsearch.operators import kernels
from docsearch.runtime import BROADCAST_ROWS, broadcast_if, written
from docsearch.schema import SparseParams

# Up to this many terms the vocabulary is held by every executor.
VOCABULARY_IN_MEMORY = 200_000
# Parts that the counts of one term are dealt to when a large vocabulary is joined.
_SALTS = 16
# Scores are rounded so that copies of a document tie whatever the order in
# which their terms were summed.
SCORE_DIGITS = 10
DOC_KEY = ("doc_id", "batch_id")


def stop_words_of(params: SparseParams) -> Sequence[str]:
    if params.stop_words is None:
        return StopWordsRemover.loadDefaultStopWords("english")
    return params.stop_words


def analyse(content: Column | str, params: SparseParams) -> Column:
    """Tokens of cleaned text under the given settings."""
    if params.fallback_analyser:
        return X.tokenise_fallback(content)
    return X.tokenise(content, stop_words_of(params))


def with_tokens(cleaned: DataFrame, params: SparseParams) -> DataFrame:
    return cleaned.withColumn("tokens", analyse("content", params))


# --- vocabulary ---------------------------------------------------------------


def term_frequency(
    tokenised: DataFrame, ngram_range: tuple[int, int], keys: Sequence[str] = DOC_KEY
) -> DataFrame:
    """Count of each term in each document. Counted inside the row: no shuffle."""
    counted = tokenised.select(
        *keys, X.term_counts(X.ngrams("tokens", ngram_range)).alias("counts")
    )
    return _unnested(counted, keys, F.col("counts"))


def _unnested(df: DataFrame, keys: Sequence[str], counts: Column) -> DataFrame:
    """One row per struct of an array.

    Written as an outer unnesting with the empty rows dropped behind it: an
    inner one makes Spark test the array first, and so compute it twice.
    """
    rows = df.select(*keys, F.inline_outer(counts))
    return rows.filter(F.col(rows.columns[-1]).isNotNull())


def document_frequency(tf: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Documents that hold each term, and its count in the corpus."""
    return tf.groupBy(*by, "term").agg(
        F.count("*").alias("df"), F.sum("tf").alias("ctf")
    )


def term_statistics(tokenised: DataFrame, ngram_range: tuple[int, int]) -> DataFrame:
    """Document and corpus frequency of every term, straight from the tokens.

    Terms are counted batch by batch, as numbers, so that each batch gives its distinct terms
    once; one shuffle sums them. Runs of words are dealt by their first word and the letter behind
    it before anything is summed: few repeat within a task, whose memory a table of all its runs
    would fill, and neighbours of a batch stay neighbours in the shuffle.
    """
    counted, by = tokenised.select("tokens").mapInArrow(
        kernels.statistics_counter(*ngram_range), kernels.STATISTICS), ["term"]
    if ngram_range[1] > 1:
        gap = F.instr("term", " ")
        start = F.when(gap > 0, F.substr("term", F.lit(1), gap + 1)).otherwise(F.col("term"))
        counted, by = counted.withColumn("_start", F.hash(start)).repartition("_start"), ["_start", "term"]
    return counted.groupBy(*by).agg(
        F.sum("df").alias("df"), F.sum("ctf").alias("ctf")).drop("_start")


def within_df_bounds(freq: DataFrame, n_docs: int, params: SparseParams) -> DataFrame:
    return freq.filter(
        (F.col("df") >= params.min_df) & (F.col("df") <= n_docs * params.max_df)
    )


def _sizes(freq: DataFrame, limit: int) -> list:
    """Numbers of terms of the highest frequencies."""
    return freq.groupBy("ctf").count().orderBy(F.desc("ctf")).limit(limit).collect()


def vocabulary_statistics(
    tokenised: DataFrame, n_docs: int, params: SparseParams, words: DataFrame | None = None,
) -> tuple[DataFrame, int]:
    """Statistics of every term that can be in the vocabulary under these settings, and the
    frequency from which on they are complete.

    No run of words is more frequent than its rarest word, and the vocabulary's rarest term is at
    least as frequent as the last of the ``max_features`` most frequent words. So only runs of
    words from half of that frequency on are counted, as numbers; the half leaves room for terms
    that a later batch may bring in. ``words`` are the word statistics, where they are known.
    """
    low, high = params.ngram_range
    if words is None:
        words = written(term_statistics(tokenised, (1, 1)), "words")
    floor = 1
    if low == 1:
        room = params.max_features
        for row in _sizes(within_df_bounds(words, n_docs, params), params.max_features):
            room -= row["count"]
            if room <= 0:
                floor = max(row["ctf"] // 2, 1)
                break
    frequent = words.filter(F.col("ctf") >= floor)
    if high == 1:
        return frequent, floor
    terms = [r["term"] for r in frequent.select("term").limit(VOCABULARY_IN_MEMORY + 1).collect()]
    if len(terms) > VOCABULARY_IN_MEMORY or len(terms) ** high >= 1 << 62:
        return term_statistics(tokenised, params.ngram_range), 1
    if not terms:
        return frequent, floor
    counted = tokenised.select("tokens").mapInArrow(
        kernels.run_counter(terms, max(low, 2), high), kernels.RUN_STATISTICS)
    runs = counted.groupBy("n", "code").agg(
        F.sum("df").alias("df"), F.sum("ctf").alias("ctf")).filter(F.col("ctf") >= floor)
    found = _spelled(runs, terms, max(low, 2), high)
    return (frequent.unionByName(found) if low == 1 else found), floor


def _spelled(runs: DataFrame, words: Sequence[str], low: int, high: int) -> DataFrame:
    """Statistics of runs with the term in place of the code."""
    numbered = F.broadcast(runs.sparkSession.createDataFrame(
        pd.DataFrame({"word_id": range(len(words)), "word": words}), "word_id bigint, word string"))
    found = None
    for n in range(low, high + 1):
        part = runs.filter(F.col("n") == n)
        for i in range(n):
            digit = F.expr(f"(code div {len(words) ** (n - 1 - i)}) % {len(words)}")
            part = part.withColumn("word_id", digit).join(numbered, "word_id").drop(
                "word_id").withColumnRenamed("word", f"word_{i}")
        part = part.select(
            F.concat_ws(" ", *[f"word_{i}" for i in range(n)]).alias("term"), "df", "ctf")
        found = part if found is None else found.unionByName(part)
    return found


def counts_of(
    tokenised: DataFrame, terms: Sequence[str], ngram_range: tuple[int, int]
) -> DataFrame:
    """``term_frequency`` of the given terms, which every task holds. Tokens may also come as
    texts with a space between them."""
    return tokenised.select(*DOC_KEY, "tokens").mapInArrow(
        kernels.term_counter(list(terms), *ngram_range), kernels.TERM_COUNTS)


def prune_vocabulary(freq: DataFrame, n_docs: int, params: SparseParams) -> DataFrame:
    """Terms within the bounds; of these the most frequent ``max_features``, ties by term.

    The frequency at the cut is found from the number of terms of each frequency,
    so only the terms of that one frequency are ordered.
    """
    kept = within_df_bounds(freq, n_docs, params)
    sizes = _sizes(kept, params.max_features)
    room, cut = params.max_features, None
    for row in sizes:
        if row["count"] > room:
            cut = row["ctf"]
            break
        room -= row["count"]
        if room == 0:
            return kept.filter(F.col("ctf") >= row["ctf"])
    if cut is None:
        return kept
    return kept.filter(F.col("ctf") > cut).unionByName(
        kept.filter(F.col("ctf") == cut).orderBy("term").limit(room))


def idf(df: Column | str, n_docs: int | Column) -> Column:
    """Smoothed inverse document frequency."""
    df = F.col(df) if isinstance(df, str) else df
    n_docs = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    return F.log((n_docs + 1.0) / (df + 1.0)) + 1.0


def with_idf(vocab: DataFrame, n_docs: int) -> DataFrame:
    return vocab.withColumn("idf", idf("df", n_docs))


def feature_names(vocab: DataFrame) -> DataFrame:
    """Vocabulary in term order."""
    return vocab.select("term").orderBy("term")


# --- weights ------------------------------------------------------------------


def tfidf_weights(
    tokenised: DataFrame, vocab: DataFrame, params: SparseParams, vocab_rows: int
) -> DataFrame:
    """Postings: tf * idf of each (document, term), L2-normalised per document."""
    if vocab_rows <= VOCABULARY_IN_MEMORY:
        return _weigh_in_row(tokenised, vocab, params)
    return _weigh_by_join(tokenised, vocab, params, vocab_rows)


def _weigh_in_row(tokenised: DataFrame, vocab: DataFrame, params: SparseParams) -> DataFrame:
    """The vocabulary fits in memory: count, weigh and normalise inside the batch, without a shuffle."""
    rows = vocab.select("term", "idf").orderBy("term").collect()
    if not rows:
        return _weigh_by_join(tokenised, vocab, params, 0)
    return tokenised.select(*DOC_KEY, "tokens").mapInArrow(
        kernels.term_counter([r["term"] for r in rows], *params.ngram_range,
                             [r["idf"] for r in rows]), kernels.TERM_WEIGHTS
    ).select("term", *DOC_KEY, "tf", "weight")


def with_term_idf(counts: DataFrame, vocab: DataFrame, vocab_rows: int | None) -> DataFrame:
    """Counts of terms with their idf; terms outside the vocabulary vanish.

    A vocabulary above the broadcast bound, or of unknown size, is joined by term and salt, so that the
    counts of a term that every document has are spread over many tasks.
    """
    idf_of = vocab.select("term", "idf")
    if vocab_rows is not None and vocab_rows <= BROADCAST_ROWS:
        return counts.join(F.broadcast(idf_of), "term")
    salted = counts.withColumn("_salt", F.pmod(F.xxhash64(*DOC_KEY), F.lit(_SALTS)).cast("int"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("_salt")
    return salted.join(idf_of.select("*", salts), ["term", "_salt"]).drop("_salt")


def _weigh_by_join(
    tokenised: DataFrame, vocab: DataFrame, params: SparseParams, vocab_rows: int | None = None,
) -> DataFrame:
    """The vocabulary is large: join it, and normalise over each document."""
    counts = term_frequency(tokenised, params.ngram_range)
    raw = with_term_idf(counts, vocab, vocab_rows).withColumn("raw", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(*DOC_KEY)))
    return raw.withColumn("weight", F.col("raw") / norm).select(
        "term", *DOC_KEY, "tf", "weight"
    )


# --- scoring ------------------------------------------------------------------


def query_weights(
    queries: DataFrame, vocab: DataFrame, params: SparseParams, vocab_rows: int
) -> DataFrame:
    """TF-IDF vector of each cleaned query text: (query_id, term, idf, query_weight).

    Terms outside the vocabulary vanish.
    """
    tokenised = queries.select(
        "query_id", analyse(X.clean_text("text"), params).alias("tokens")
    )
    raw = (
        term_frequency(tokenised, params.ngram_range, keys=("query_id",))
        .join(broadcast_if(vocab.select("term", "idf"), vocab_rows), "term")
        .withColumn("raw", F.col("tf") * F.col("idf"))
    )
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("query_id")))
    return raw.select("query_id", "term", "idf", (F.col("raw") / norm).alias("query_weight"))


def norms(counts: DataFrame, vocab: DataFrame, vocab_rows: int) -> DataFrame:
    """Length of the TF-IDF vector of each document. Stored counts are summed in the bucket."""
    raw = F.col("tf") * F.col("idf")
    return with_term_idf(counts, vocab, vocab_rows).groupBy(*DOC_KEY).agg(F.sqrt(F.sum(raw * raw)).alias("norm"))


def weighted(counts: DataFrame, rows: DataFrame, vocab: DataFrame, vocab_rows: int) -> DataFrame:
    """Postings with weights, from raw counts and the norms of the documents."""
    return (
        with_term_idf(counts, vocab, vocab_rows)
        .join(rows.select(*DOC_KEY, "norm").hint("shuffle_hash"), list(DOC_KEY))
        .select("term", *DOC_KEY, "tf", (F.col("tf") * F.col("idf") / F.col("norm")).alias("weight"))
    )


def _in_blocks(weights: DataFrame, weight_rows: int, score) -> DataFrame:
    """``score`` of the query side, in blocks of queries whose rows keep within the bound."""
    blocks = max(1, -(-weight_rows // BROADCAST_ROWS))
    scored = None
    for block in range(blocks):
        part = weights
        if blocks > 1:
            part = weights.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block)
        found = score(F.broadcast(part))
        scored = found if scored is None else scored.unionByName(found)
    return scored


def _cosine(total: Column) -> Column:
    return F.least(F.round(total, SCORE_DIGITS), F.lit(1.0))


def score_sparse(postings: DataFrame, weights: DataFrame, weight_rows: int) -> DataFrame:
    """Cosine of every (query, document) pair that shares a term.

    Postings that are stored bucketed by document are summed where they are
    read, so a cut per query can follow before anything is shuffled. The query
    side is broadcast, in blocks of queries.
    """
    total = F.sum(F.col("weight") * F.col("query_weight"))

    def score(part: DataFrame) -> DataFrame:
        return postings.join(part, "term").groupBy("query_id", *DOC_KEY).agg(
            _cosine(total).alias("score"))

    return _in_blocks(weights, weight_rows, score)


def score_counts(
    counts: DataFrame, rows: DataFrame, weights: DataFrame, weight_rows: int,
    columns: Sequence[str] = (),
) -> DataFrame:
    """The same from raw counts: summed in the bucket, then divided by the norm, which
    stands in the same bucket with the other ``columns`` of the document. Nothing is shuffled."""
    total = F.sum(F.col("tf") * F.col("idf") * F.col("query_weight"))
    beside = rows.select(*DOC_KEY, "norm", *columns).hint("shuffle_hash")

    def score(part: DataFrame) -> DataFrame:
        found = counts.join(part, "term").groupBy("query_id", *DOC_KEY).agg(total.alias("_total"))
        return found.join(beside, list(DOC_KEY)).select(
            "query_id", *DOC_KEY, _cosine(F.col("_total") / F.col("norm")).alias("score"), *columns)

    return _in_blocks(weights, weight_rows, score)

"""Toxicity by class-conditional Kneser-Ney models.

Two models of the characters of a word, of toxic and of ordinary texts, are
learned from labelled rows. A byte is predicted from the up to five bytes before
it in its word, by discounted counts that fall back to shorter contexts: counts
of texts at the longest context and after the start of a word, counts of
different continuations elsewhere. Contexts of up to two bytes have the counts
of both classes together. A rare expression is thus smoothed towards the same
value in both models and says little, while new forms of a known stem still do.
The log-likelihood ratio of a text, over its number of words and over the root
of that number, goes through a logistic curve fitted on labelled rows that the
models have not seen.

The classifier is fitted on a bounded sample: up to ``max_docs`` labelled rows of each
class, those with the smallest hash of their doc_id. Sample and model are broadcast; both
are bounded by it. Counts of different continuations grow with the sample, so those of the
larger class are what a sample as large as the smaller one would show on average: a window
that ``n`` of its texts hold is there with probability ``1 - (1 - rate) ** n``.

Defined results: null and empty texts have no words and get the score of the
logistic curve at zero. A doc_id labelled more than once is toxic if any of its
labels is. Labels other than 0 and 1, and null ids, are not learned from. With
no sample of one of the classes, every score is the share of toxic labels, or 0
without labels. Repeated rows give repeated rows, an empty table none. Columns
other than doc_id and text are kept, whatever their names; in ``score`` those named like what it
adds are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsearch.llm import common as C

MAX_DOCS = 8_000
#: Bytes of context, and up to how many of them both classes share their counts.
ORDER = 5
SHARED_ORDER = 2
DISCOUNT = 2.5
#: Log ratio from which a word counts as telling. A few of them are not lost among the small
#: differences of thousands of common words.
TELLING = 1.5
_EDGE = 32

#: Letters, digits and bytes of longer characters; all else parts words.
_REWRITE = np.array([b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else _EDGE
                     for b in range(256)], np.uint8)


def _distinct_words(texts: list[bytes]):
    """For each block: range of texts, bytes of its different words (an edge before and after
    each), where each word begins in them, and for every word its text and its place."""
    for lo, hi, data, starts, ends, owner in C.word_blocks(texts, _REWRITE):
        _, first, place = np.unique(
            C.span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        lengths = ends[first] - starts[first] + 2
        begin = np.concatenate(([0], np.cumsum(lengths)))
        inside = np.arange(begin[-1]) - np.repeat(begin[:-1], lengths)
        source = np.repeat(starts[first], lengths) + inside - 1
        spelled = np.where((inside == 0) | (inside == np.repeat(lengths, lengths) - 1), _EDGE,
                           data[np.clip(source, 0, max(len(data) - 1, 0))] if len(data) else 0)
        yield lo, hi, spelled.astype(np.uint64), begin, owner, place


def _windows(spelled: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each byte of a word with its context, packed into a number, and the word of each.

    What lies before the word is zero.
    """
    lengths = np.diff(begin)
    inside = np.arange(len(spelled)) - np.repeat(begin[:-1], lengths)
    key = spelled.copy()
    for back in range(1, ORDER + 1):
        earlier = np.zeros_like(spelled)
        earlier[back:] = spelled[:-back]
        key |= np.where(inside >= back, earlier, np.uint64(0)) << np.uint64(8 * back)
    keep = inside > 0
    return key[keep], np.repeat(np.arange(len(lengths)), lengths)[keep]


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of each class a window occurs in some word. Columns: text, toxic."""
    for batch in batches:
        texts, toxic = C.binary_values(batch.column(0)), batch.column(1).to_numpy()
        for lo, hi, spelled, begin, owner, place in _distinct_words(texts):
            keys, word = _windows(spelled, begin)
            in_text = np.unique(owner * np.int64(len(begin)) + place)
            mine = toxic[lo:hi][in_text // len(begin)]
            found = in_text % len(begin)
            counts = [np.bincount(found, mine == c, minlength=len(begin)) for c in (1, 0)]
            window, at = np.unique(keys, return_inverse=True)
            yield pa.RecordBatch.from_arrays([
                pa.array(window.view(np.int64)),
                *(pa.array(np.bincount(at, x[word], minlength=len(window)).astype(np.int64))
                  for x in counts)], names=["window", "toxic", "ordinary"])


def _low_bytes(keys: np.ndarray, n: int) -> np.ndarray:
    return keys & np.uint64((1 << (8 * n)) - 1)


class Model:
    """Log ratio of the two models for windows."""

    def __init__(self, windows: np.ndarray, counts: list[np.ndarray],
                 rates: tuple[float, float] = (1.0, 1.0)):
        """``windows`` are different; ``counts`` has the toxic and the ordinary ones, and
        ``rates`` the share of each class that makes the two samples equal."""
        with np.errstate(divide="ignore", invalid="ignore"):
            # Logarithm of the probability that a window is not in the share of its class.
            absent = [np.where(x > 0, x * np.log1p(-r), 0.0)
                      for x, r in zip(counts, rates, strict=True)]
        levels = {ORDER: (windows, [x * r for x, r in zip(counts, rates, strict=True)])}
        for order in range(ORDER - 1, -1, -1):
            longer, above = levels[order + 1]
            keys, at = np.unique(_low_bytes(longer, order + 1), return_inverse=True)
            # A window that begins at the edge or before it has no other continuation.
            edge = (longer >> np.uint64(8 * (order + 1))) == 0
            levels[order] = keys, [
                np.bincount(at, np.where(edge, x, -np.expm1(q)), minlength=len(keys))
                for x, q in zip(above, absent, strict=True)]
            absent = [np.bincount(at, np.maximum(q, -1e3), minlength=len(keys)) for q in absent]
        self.grams, self.ratios_of, self.contexts, self.freed = {}, {}, {}, {}
        below = None
        for order in range(ORDER + 1):
            keys, counts = levels[order]
            if order <= SHARED_ORDER:
                counts = [counts[0] + counts[1]] * 2
            context, at = np.unique(keys >> np.uint64(8), return_inverse=True)
            if below is None:
                lower = [np.full(len(keys), 1 / 256)] * 2
            else:
                i = self.grams[order - 1].find(_low_bytes(keys, order))
                lower = [x[i] for x in below]
            prob, freed = [], []
            for n, p in zip(counts, lower, strict=True):
                total = np.bincount(at, n, minlength=len(context))
                held = np.maximum(n - DISCOUNT, 0)
                rest = np.where(
                    total > 0, 1 - np.bincount(at, held, minlength=len(context))
                    / np.maximum(total, 1), 1.0)
                prob.append(held / np.maximum(total, 1)[at] + rest[at] * p)
                freed.append(rest)
            below = prob
            self.grams[order] = C.HashIndex(keys)
            self.ratios_of[order] = np.append(np.log(prob[0]) - np.log(prob[1]), 0.0)
            self.contexts[order] = C.HashIndex(context)
            floor = 1e-9
            self.freed[order] = np.append(
                np.log(np.maximum(freed[0], floor)) - np.log(np.maximum(freed[1], floor)), 0.0)

    def log_ratio(self, keys: np.ndarray) -> np.ndarray:
        out, left = np.zeros(len(keys)), np.arange(len(keys))
        for order in range(ORDER, -1, -1):
            wanted = _low_bytes(keys[left], order + 1)
            at = self.grams[order].find(wanted)
            found = at >= 0
            out[left[found]] += self.ratios_of[order][at[found]]
            left, wanted = left[~found], wanted[~found]
            if not len(left):
                break
            out[left] += self.freed[order][self.contexts[order].find(wanted >> np.uint64(8))]
        return out

    def ratios(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log-likelihood ratio, its part from telling words, and number of words of each text."""
        total, telling, n = (np.zeros(len(texts)) for _ in range(3))
        for lo, hi, spelled, begin, owner, place in _distinct_words(texts):
            keys, word = _windows(spelled, begin)
            ratio = np.bincount(word, self.log_ratio(keys), minlength=len(begin))[place]
            total[lo:hi] = C.per_text(owner, hi - lo, ratio)
            telling[lo:hi] = C.per_text(
                owner, hi - lo, np.where(np.abs(ratio) > TELLING, ratio, 0.0))
            n[lo:hi] = C.per_text(owner, hi - lo)
        return total, telling, n


def _features(total: np.ndarray, telling: np.ndarray, n: np.ndarray) -> np.ndarray:
    n = np.maximum(n, 1)
    return np.stack([np.ones(len(n)), total / n, total / np.sqrt(n),
                     telling / n, telling / np.sqrt(n)], axis=1)


def _logistic(features: np.ndarray, hit: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps, with a light ridge."""
    scale = np.maximum(np.abs(features).max(axis=0), 1e-9)
    x, beta = features / scale, np.zeros(features.shape[1])
    ridge = np.array([1e-6] + [1e-3] * (x.shape[1] - 1)) * weight.sum() / len(weight)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -35, 35)))
        gradient = x.T @ (weight * (p - hit)) + ridge * beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 20 / max(np.abs(step).max(), 1e-12))
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return beta / scale


@dataclass
class Classifier:
    """Fitted model: broadcast log ratios and the logistic curve; or one score for all."""

    model: Model | None
    beta: np.ndarray
    constant: float = 0.0


def _sample(labels: DataFrame, learn: Column, max_docs: int) -> tuple[DataFrame, dict[int, int]]:
    """The sampled ids with their class, and how many labelled ids each class has."""
    ids = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & learn).groupBy(
        "doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in ids.groupBy("toxic").count().collect()}
    parts = [ids.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(
        max_docs) for c in (0, 1)]
    return C.written(parts[0].union(parts[1]), "sample"), sizes


def _fit_model(rows: DataFrame) -> Model:
    """Model from rows of (text, toxic), equal texts once; what is collected is bounded by them."""
    different = rows.groupBy(F.sha2("text", 256).alias("key")).agg(
        F.max("toxic").alias("toxic"), F.first("text").alias("text"))
    sizes = {r["toxic"]: r["count"] for r in different.groupBy("toxic").count().collect()}
    least = min(sizes.get(c, 0) for c in (1, 0))
    rates = tuple(least / sizes[c] if least else 1.0 for c in (1, 0))
    found = different.select("text", "toxic").mapInArrow(
        _counter, "window long, toxic long, ordinary long").groupBy("window").agg(
        F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")).toPandas()
    return Model(found["window"].to_numpy(np.int64).view(np.uint64),
                 [found[c].to_numpy(float) for c in ("toxic", "ordinary")], rates)


def _measurer(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(1),
                 *map(pa.array, model.value.ratios(C.binary_values(batch.column(0))))],
                names=["toxic", "total", "telling", "n"])
    return run


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None,
        calibrate: Column | None = None, max_docs: int = MAX_DOCS) -> Classifier:
    """Learn from the labelled rows for which ``learn`` (a condition on doc_id) holds.

    Those for which ``calibrate`` holds too fit the logistic curve, the others the models.
    """
    spark = C.small_batches(docs).sparkSession
    sample, sizes = _sample(labels, F.lit(True) if learn is None else learn, max_docs)
    if len(sizes) < 2:
        return Classifier(None, np.zeros(5), float(1 in sizes))
    calibrate = C.fold("doc_id", 5) == 4 if calibrate is None else calibrate
    rows = C.written(docs.select("doc_id", C.text_bytes().alias("text")).join(
        F.broadcast(sample), "doc_id").withColumn("apart", calibrate), "labelled")
    model = _fit_model(rows.filter("not apart"))
    shared = spark.sparkContext.broadcast(model)
    seen = rows.filter("apart").select("text", "toxic").mapInArrow(
        _measurer(shared), "toxic int, total double, telling double, n double").toPandas()
    share = sizes[1] / (sizes[0] + sizes[1])
    hit = seen["toxic"].to_numpy(float)
    if not 0 < hit.sum() < len(hit):
        # Too few labels for a curve: the plain ratio against the share of toxic labels.
        prior = np.log(share / (1 - share))
        return Classifier(model, np.array([prior, 0.0, 1.0, 0.0, 0.0]))
    weight = np.where(hit == 1, share / hit.mean(), (1 - share) / (1 - hit.mean()))
    beta = _logistic(_features(*(seen[c].to_numpy() for c in ("total", "telling", "n"))), hit, weight)
    return Classifier(model, beta)


def _scorer(model, beta: np.ndarray, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, telling, n = model.value.ratios(C.binary_values(batch.column(1)))
            score = 1 / (1 + np.exp(-np.clip(_features(total, telling, n) @ beta, -35, 35)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array(total), pa.array(n.astype(np.int64))],
                names=names)
    return run


_ADDED = T.StructType([
    T.StructField("__score", T.DoubleType()), T.StructField("__log_ratio", T.DoubleType()),
    T.StructField("__n_words", T.LongType())])


def _scored(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """``caller``, a struct of all columns of ``docs``, and what ``score`` adds."""
    caller = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("caller")
    if classifier.model is None:
        return docs.select(caller, F.lit(classifier.constant).alias("__score"),
                           F.lit(0.0).alias("__log_ratio"),
                           F.lit(None).cast("long").alias("__n_words"))
    wanted = C.small_batches(docs).select(caller, C.text_bytes())
    model = docs.sparkSession.sparkContext.broadcast(classifier.model)
    schema = T.StructType([wanted.schema["caller"], *_ADDED.fields])
    return wanted.mapInArrow(_scorer(model, classifier.beta, schema.names), schema)


def score(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """The columns of ``docs`` with ``__score`` (0 to 1), ``__log_ratio`` and ``__n_words``."""
    mine = [F.col(f"caller.`{c}`") for c in docs.columns if c.lower() not in _ADDED.names]
    return _scored(docs, classifier).select(*mine, *_ADDED.names)


def reject(docs: DataFrame, classifier: Classifier, threshold: float = 0.5) -> DataFrame:
    """The columns of ``docs`` without the rows that score at or above the threshold."""
    return _scored(docs, classifier).filter(F.col("__score") < threshold).select("caller.*")

"""Language identification by error-correcting output codes.

Every learned language has a codeword of bits, and every bit a binary classifier
of hashed byte n-grams: the mean log odds of the n-grams of a text under the
languages with a one and those with a zero, each language counting alike. The
decoder takes the codeword with the least loss, log(1 + exp(-margin)), summed
over bits and weighted by how well a bit tells its two sides apart on the counts. Few
languages get all ways to part them, more get random codes with distant words.

Counts of n-grams come from all rows to learn from; a model has ``BUCKETS``
numbers for each n-gram size and language, with at most ``max_languages``.

Defined results: ``und`` with score 0 for a null text, a text without a letter, or
nothing learned. Rows with a null lang or text teach nothing; an empty lang is a
language. Ties go to the first language by code point. The score is the share of
the best codeword, exp(-loss) over all codewords; ``ambiguous`` marks a lead of
less than ``AMBIGUOUS`` over the second. Repeated rows count and are judged each;
an empty table gives no rows. Columns other than those named are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsearch.llm import common as C

SIZES = (2, 3)
BUCKETS = 1 << 15
MAX_LANGUAGES = 512
AMBIGUOUS = 0.2
#: N-grams that a margin stands for; more do not make a decision surer.
_EVIDENCE = 60
_LETTER = re.compile(r"[^\W\d_]")
_REWRITE = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint8)


def _lower(column) -> list[bytes]:
    return [(x or "").lower().encode() for x in column.to_pylist()]


def _ngrams(texts: list[bytes]):
    """For each block: range of texts, n-gram buckets sorted by text, texts of them."""
    for lo, hi in C.text_blocks(texts):
        block = [b" " + x + b"  " for x in texts[lo:hi]]
        lengths = np.array([len(x) for x in block], np.int64)
        data = _REWRITE[np.frombuffer(b"".join(block), np.uint8)].astype(np.uint32)
        owner = np.repeat(np.arange(len(block)), lengths)
        codes = []
        for i, n in enumerate(SIZES):
            code = data[:len(data) - 2].copy()
            for step in range(1, n):
                code = (code << np.uint32(8)) | data[step:len(data) - 2 + step]
            hashed = (code * np.uint32(2654435761)) >> np.uint32(17)
            codes.append(hashed.astype(np.int64) + i * BUCKETS)
        inside = owner[:-2] == owner[2:]
        # Two spaces tell nothing.
        inside &= (data[:-2] != 32) | (data[1:-1] != 32)
        yield lo, hi, [c[inside] for c in codes], owner[:-2][inside]


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-gram counts of each language in a task. Columns: text, lang."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column(1).to_pylist(), object)
        for lo, hi, codes, owner in _ngrams(_lower(batch.column(0))):
            names, place = np.unique(langs[lo:hi], return_inverse=True)
            for i, name in enumerate(names):
                mine = place[owner] == i
                mass = counts.setdefault(name, np.zeros(len(SIZES) * BUCKETS))
                for c in codes:
                    mass += np.bincount(c[mine], minlength=len(mass))
    for name, mass in counts.items():
        at = np.flatnonzero(mass)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(mass[at])],
            names=["lang", "bucket", "n"])


def codewords(n: int) -> np.ndarray:
    """A matrix of 0 and 1: a row for each class, a column for each bit."""
    if n < 2:
        return np.zeros((n, 0), int)
    if n <= 6:
        # All ways to part the classes, the first always on the zero side.
        sides = [c for k in range(1, n) for c in combinations(range(1, n), k)]
        return np.array([[int(i in side) for side in sides] for i in range(n)])
    bits, best, best_distance = int(np.ceil(10 * np.log2(n))), None, -1
    random = np.random.default_rng(7)
    for _ in range(50):
        code = random.integers(0, 2, (n, bits))
        code = code[:, (code.sum(0) > 0) & (code.sum(0) < n)]
        apart = (code[:, None, :] != code[None]).sum(2)
        distance = apart[np.triu_indices(n, 1)].min()
        if distance > best_distance:
            best, best_distance = code, distance
    return best


class Decoder:
    """Codewords, classifier weights and decoding."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.code = codewords(len(languages))
        shares = counts + 0.02
        for i in range(len(SIZES)):
            part = slice(i * BUCKETS, (i + 1) * BUCKETS)
            shares[:, part] /= shares[:, part].sum(1, keepdims=True)
        self.weights = np.zeros((counts.shape[1], self.code.shape[1]), np.float32)
        self.bit_weight = np.zeros(self.code.shape[1])
        for b in range(self.code.shape[1]):
            one, zero = (shares[self.code[:, b] == side].mean(0) for side in (1, 0))
            odds = np.log(one) - np.log(zero)
            self.weights[:, b] = odds
            self.bit_weight[b] = ((one - zero) * odds).sum()
        if len(self.bit_weight):
            self.bit_weight /= max(self.bit_weight.mean(), 1e-12)

    def margins(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Mean log odds of each bit, and number of n-grams."""
        out = np.zeros((len(texts), self.code.shape[1]))
        n = np.zeros(len(texts), np.int64)
        for lo, hi, codes, owner in _ngrams(texts):
            n[lo:hi] = C.per_text(owner, hi - lo)
            begin = np.flatnonzero(np.diff(owner, prepend=-1))
            for first in range(0, out.shape[1], 8):
                for c in codes if len(begin) else ():
                    sums = np.add.reduceat(self.weights[c, first:first + 8], begin, axis=0)
                    out[lo + owner[begin], first:first + 8] += sums
        return out / (len(SIZES) * np.maximum(n, 1))[:, None], n

    def decode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of the language, share of its codeword and lead over the second."""
        margin, n = self.margins(texts)
        margin *= np.minimum(n, _EVIDENCE)[:, None]
        loss = np.zeros((len(texts), len(self.languages)))
        for i, word in enumerate(self.code * 2 - 1):
            loss[:, i] = (self.bit_weight * np.logaddexp(0, -margin * word)).sum(1)
        share = np.exp(-(loss - loss.min(1, keepdims=True)))
        share /= share.sum(1, keepdims=True)
        best = share.argmax(1)
        top = np.sort(share, 1)
        lead = top[:, -1] - top[:, -2] if share.shape[1] > 1 else top[:, -1]
        return best, share[np.arange(len(best)), best], lead


def fit(docs: DataFrame, learn: Column | None = None,
        max_languages: int = MAX_LANGUAGES) -> Decoder | None:
    """Decoder from the rows with a lang and a text for which ``learn`` holds."""
    rows = C.small_batches(docs).filter(F.lit(True) if learn is None else learn).filter(
        "lang is not null and text is not null")
    counts = C.written(rows.select("text", "lang").mapInArrow(
        _counter, "lang string, bucket long, n double").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")), "ngrams")
    names = [r["lang"] for r in counts.select("lang").distinct().limit(max_languages + 1).collect()]
    if len(names) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    if not names:
        return None
    table, names = counts.toPandas(), sorted(names)
    matrix = np.zeros((len(names), len(SIZES) * BUCKETS))
    place = table["lang"].map({n: i for i, n in enumerate(names)}).to_numpy()
    matrix[place, table["bucket"].to_numpy()] = table["n"].to_numpy()
    return Decoder(names, matrix)


def _predictor(decoder, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            lettered = np.array([bool(x) and _LETTER.search(x) is not None for x in texts], bool)
            place, share, lead = decoder.value.decode(_lower(batch.column(at)))
            names = [decoder.value.languages[i] if ok else "und"
                     for i, ok in zip(place.tolist(), lettered.tolist(), strict=True)]
            kept = [i for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept), pa.array(names, pa.string()),
                 pa.array(np.where(lettered, share, 0.0)),
                 pa.array(lettered & (lead < AMBIGUOUS))],
                names=[*(batch.schema.names[i] for i in kept), "lang_pred", "score", "ambiguous"])
    return run


def predict(docs: DataFrame, decoder: Decoder | None) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``ambiguous`` from the text alone."""
    rows = C.small_batches(docs).select("doc_id", "text")
    if decoder is None:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(False).alias("ambiguous"))
    schema = T.StructType([
        rows.schema["doc_id"], T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())])
    shared = docs.sparkSession.sparkContext.broadcast(decoder)
    return rows.mapInArrow(_predictor(shared, 1), schema)

"""LM scoring by prediction by partial matching (PPM) over bytes.

A text is its lower-cased (A-Z) words, joined by spaces, and an end symbol. Each
byte is predicted from the longest context of up to ``order`` bytes that has been
seen, with escapes to shorter contexts: method D, where each kind of symbol gives
half a count to the escape, with exclusion of the symbols of the longer context.
Below the empty context all bytes left are equal. The probabilities of all
bytes after any context sum to one.

``score`` uses a trie learned from the rows with ``learn``. It is never in one place:

1. Texts are stored in chunks. Every chunk lists its different windows (a byte with
   its context) and words, with counts of the rows to learn from, as packed
   arrays for the bucket of their last ``BASE`` bytes of context, or of the word.
2. Counts of a bucket are summed over up to ``FAN`` chunks, then over all. A bucket
   holds whole subtrees, so the code length of all its windows follows; counts of the
   contexts below ``BASE`` bytes (at most 256 ** 3 numbers) are broadcast.
3. Buckets answer each group of chunks with what it has asked for, and each chunk sums its
   texts. No chunk is sent what others ask.

``adaptive_score`` learns from nothing but the text itself, byte by byte.

``base`` is a unigram model of words with add-one smoothing, from the same pass.
Words are told apart by 64-bit hashes. Code lengths of windows travel as 32-bit numbers.

Defined results: a null or blank text is its end symbol alone. With nothing to learn
from, every byte costs log10(256). Repeated rows count and are scored each. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsearch.llm import common as C
from docsearch.llm import ppm_tables as P

ORDER = 5
BASE = 3
#: Bytes of text of which windows are listed together; more text has fewer for each byte.
CHUNK_BYTES = 16 << 20
#: Chunks of which one task sums the counts of a bucket.
FAN = 256
#: Entries that a bucket gets from one chunk in a thousand bytes, about, for choosing their number.
_ENTRIES = 40
_BUCKET_ENTRIES = 4_000_000
END = 10

_PACKED = "bucket int, salt int, chunk long, keys binary, values binary"


def normalise(text: bytes) -> bytes:
    """Lower-cased words joined by spaces, and the end symbol."""
    return b" ".join(text.lower().split()) + bytes([END])


def pack(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, which compress well."""
    return np.diff(keys, prepend=np.uint64(0)).astype(np.uint64).tobytes()


def unpack(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(packed, np.uint64), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    """Whole numbers in four bytes each, or in eight where one needs them."""
    small = len(counts) == 0 or counts.max() < 1 << 32
    return counts.astype(np.uint32 if small else np.uint64).tobytes()


def unpack_counts(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(packed, np.uint64 if n and len(packed) // n == 8 else np.uint32).astype(
        np.float64)


def _windows(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of all bytes, contexts before a text filled with end symbols; text of each."""
    lengths = np.array([len(x) + order for x in texts], np.int64)
    filler = bytes([END]) * order
    data = np.frombuffer(b"".join(filler + x for x in texts), np.uint8).astype(np.uint64)
    key = data.copy()
    for back in range(1, order + 1):
        key[back:] |= data[:-back] << np.uint64(8 * back)
    owner = np.repeat(np.arange(len(texts)), lengths)
    inside = np.arange(len(data)) - (np.cumsum(lengths) - lengths)[owner] >= order
    return key[inside], owner[inside]


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    found = [(C.span_hashes(data, starts, ends), owner + lo)
             for lo, _, data, starts, ends, owner in C.word_blocks(texts)]
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([p[1] for p in parts]), minlength=len(keys))


def _count(texts: list[bytes], learn: np.ndarray, listed) -> tuple[np.ndarray, np.ndarray]:
    """Different keys of the texts, with the counts of those to learn from."""
    parts = [(np.zeros(0, np.uint64), np.zeros(0))]
    for wanted in (True, False):
        chosen = [x for x, flag in zip(texts, learn.tolist(), strict=True) if flag == wanted]
        for lo, hi in C.text_blocks(chosen):
            keys, n = np.unique(listed(chosen[lo:hi])[0], return_counts=True)
            parts.append((keys, n * float(wanted)))
            if len(parts) > 8:
                parts = [_merge(parts)]
    return _merge(parts)


def _bucket_of(keys: np.ndarray, is_word: bool, n_buckets: int) -> np.ndarray:
    low = C.mix(keys if is_word else P.context(keys, BASE)) % np.uint64(n_buckets)
    return low.astype(np.int64) + n_buckets * is_word


def _lister(order: int, n_buckets: int, n_salts: int):
    def run(texts: pa.Table) -> pa.Table:
        values, learn = C.binary_values(texts["text"]), texts["learn"].to_numpy()
        chunk = texts["chunk"][0].as_py()
        salt = int(C.mix(np.array([chunk], np.uint64))[0] % np.uint64(n_salts))
        rows = []
        for is_word, listed in ((False, lambda x: _windows(x, order)), (True, _word_hashes)):
            keys, n = _count(values, learn, listed)
            if not len(keys):
                continue
            bucket = _bucket_of(keys, is_word, n_buckets)
            by = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[by], np.unique(bucket), side="right")
            for b, at in zip(np.unique(bucket).tolist(), np.split(by, ends[:-1]), strict=True):
                rows.append((b, salt, chunk, pack(keys[at]), pack_counts(n[at])))
        return _packed(rows)
    return run


def _packed(rows: list[tuple]) -> pa.Table:
    types = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
    names = ("bucket", "salt", "chunk", "keys", "values")
    return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
                    names=list(names))


def _parts(table: pa.Table, costs: bool = False) -> list[tuple[np.ndarray, np.ndarray]]:
    """Keys and values of each row: counts, or the code lengths of windows."""
    out = []
    for packed, values in zip(table["keys"].to_pylist(), table["values"].to_pylist(), strict=True):
        keys = unpack(packed)
        out.append((keys, np.frombuffer(values, np.float32).astype(np.float64) if costs
                    else unpack_counts(values, len(keys))))
    return out


def _summer(table: pa.Table) -> pa.Table:
    keys, n = _merge(_parts(table))
    return _packed([(table["bucket"][0].as_py(), table["salt"][0].as_py(), None,
                     pack(keys), pack_counts(n))])


def _roots_lister(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns keys, values: counts of windows of BASE - 1 bytes of context."""
    for batch in batches:
        for keys, n in _parts(pa.table(batch)):
            tails, sums = P.sums_by(P.tail(keys, BASE - 1), n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tails.view(np.int64)), pa.array(sums)], names=["tail", "n"])


def _roots(tails: np.ndarray, n: np.ndarray) -> P.Roots:
    tails, n = tails[n > 0], n[n > 0]
    return P.Roots([P.Level(*P.sums_by(P.tail(tails, k), n)) for k in range(BASE)])


_VALUED = "bucket int, salt int, keys binary, values binary, total double, kinds double"


def _valuer(order: int, n_buckets: int, roots):
    """Code lengths of the windows of a bucket, or counts of its words: a row for each salt, with
    the keys that it has listed. The sums of a bucket of words stand in its first row."""
    def run(table: pa.Table) -> pa.Table:
        bucket, parts = table["bucket"][0].as_py(), _parts(table)
        keys, counts = _merge(parts)
        is_word = bucket >= n_buckets
        found = counts if is_word else P.code_lengths(keys, counts, order, roots.value)
        packed = pack_counts if is_word else (lambda cost: cost.astype(np.float32).tobytes())
        rest = [0.0] * (len(parts) - 1)
        return pa.table([
            pa.array([bucket] * len(parts), pa.int32()), table["salt"].cast(pa.int32()),
            pa.array([pack(asked) for asked, _ in parts], pa.binary()),
            pa.array([packed(found[np.searchsorted(keys, asked)]) for asked, _ in parts],
                     pa.binary()),
            pa.array([counts.sum() * is_word] + rest, pa.float64()),
            pa.array([float((counts > 0).sum() * is_word)] + rest, pa.float64())],
            names=["bucket", "salt", "keys", "values", "total", "kinds"])
    return run


def _answerer(asked: pa.Table, known: pa.Table) -> pa.Table:
    """For each chunk that asked a bucket, the values of its keys."""
    rows = []
    for packed_keys, packed_values in zip(known["keys"].to_pylist(), known["values"].to_pylist(),
                                          strict=True):
        keys = unpack(packed_keys)
        values = np.frombuffer(packed_values, np.uint8).reshape(len(keys), -1)
        for bucket, chunk, packed in zip(*(asked[c].to_pylist() for c in (
                "bucket", "chunk", "keys")), strict=True):
            found = values[np.searchsorted(keys, unpack(packed))]
            rows.append((bucket, None, chunk, packed, found.tobytes()))
    return _packed(rows)


def _scorer(order: int, n_buckets: int, totals: tuple[float, float, float]):
    total, kinds, end_count = totals

    def run(texts: pa.Table, known: pa.Table) -> pa.Table:
        tables = []
        is_word = known["bucket"].to_numpy() >= n_buckets
        for flag in (False, True):
            parts = _parts(known.filter(pa.array(is_word == flag)), costs=not flag)
            keys = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.uint64)
            values = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0)
            tables.append((C.HashIndex(keys), np.append(values, 0.0)))
        (windows, cost), (words, count) = tables
        texts_of = C.binary_values(texts["text"])
        n = len(texts_of)
        score, base = np.zeros(n), np.zeros(n)
        n_tokens, n_known = np.ones(n, np.int64), np.full(n, int(end_count > 0), np.int64)
        base += np.log10((end_count + 1) / (total + kinds + 1))
        for lo, hi in C.text_blocks(texts_of):
            block = texts_of[lo:hi]
            keys, owner = _windows(block, order)
            score[lo:hi] = np.bincount(owner, cost[windows.find(keys)], minlength=hi - lo)
            hashes, owner = _word_hashes(block)
            c = count[words.find(hashes)]
            base[lo:hi] += np.bincount(
                owner, np.log10((c + 1) / (total + kinds + 1)), minlength=hi - lo)
            n_tokens[lo:hi] += np.bincount(owner, minlength=hi - lo)
            n_known[lo:hi] += np.bincount(owner[c > 0], minlength=hi - lo)
        return pa.table([texts["doc_id"], texts["held_out"], pa.array(n_tokens),
                         pa.array(n_known), pa.array(np.full(n, int(total), np.int64)),
                         pa.array(base), pa.array(score)],
                        names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens",
                               "base_score", "score"])
    return run


def score(docs: DataFrame, learn: Column | None = None, order: int = ORDER,
          chunk_bytes: int = CHUNK_BYTES, fan: int = FAN) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    ``learn`` is a condition on doc_id for the rows to learn from; all by default.
    ``score`` and ``base_score`` are log10 probabilities of the whole text.
    """
    if not BASE <= order <= 7:
        raise ValueError(f"order must be from {BASE} to 7")
    spark = docs.sparkSession
    learn = F.lit(True) if learn is None else learn
    chunks = C.chunked(docs.select("doc_id", learn.alias("learn"), C.text_bytes().alias("text")),
                       chunk_bytes, normalise)
    size = chunks.agg(F.count_if("learn").alias("learned"), F.sum(F.octet_length("text"))
                      .alias("bytes"), F.count_distinct("chunk").alias("chunks")).first()
    n_buckets = max(C.parallelism(spark),
                    (size["bytes"] or 0) * _ENTRIES // 1000 // _BUCKET_ENTRIES)
    n_salts = -(-size["chunks"] // fan) or 1
    asked = C.written(chunks.groupBy("chunk").applyInArrow(
        _lister(order, n_buckets, n_salts), _PACKED), "listed")
    summed = C.written(asked.groupBy("bucket", "salt").applyInArrow(_summer, _PACKED), "summed")
    tails = summed.filter(F.col("bucket") < n_buckets).select("keys", "values").mapInArrow(
        _roots_lister, "tail long, n double").groupBy("tail").agg(F.sum("n").alias("n")).toPandas()
    roots = spark.sparkContext.broadcast(_roots(
        tails["tail"].to_numpy(np.int64).view(np.uint64), tails["n"].to_numpy(float)))
    values = C.written(summed.groupBy("bucket").applyInArrow(
        _valuer(order, n_buckets, roots), _VALUED), "values")
    counted = values.agg(F.sum("total"), F.sum("kinds")).first()
    learned = float(size["learned"] or 0)
    totals = (counted[0] or 0.0) + learned, (counted[1] or 0.0) + (learned > 0), learned
    answers = asked.groupBy("bucket", "salt").cogroup(
        values.drop("total", "kinds").groupBy("bucket", "salt")).applyInArrow(_answerer, _PACKED)
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("held_out", T.BooleanType()),
        *(T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")),
        *(T.StructField(n, T.DoubleType()) for n in ("base_score", "score"))])
    rows = chunks.withColumn("held_out", ~F.col("learn"))
    return C.per_chunk(rows, answers, _scorer(order, n_buckets, totals), schema)


class Trie:
    """Counts of the bytes after each context, as a plain dictionary; one text at a time."""

    def __init__(self, order: int = ORDER):
        self.order, self.counts = order, {}

    def _contexts(self, data: bytes, at: int) -> list[bytes]:
        return [data[at - k:at] for k in range(self.order, -1, -1)]

    def log10(self, data: bytes, at: int) -> float:
        """log10 probability of one byte."""
        symbol, result, out = data[at], 0.0, frozenset()
        for context in self._contexts(data, at):
            seen = self.counts.get(context, {})
            left = {s: n for s, n in seen.items() if s not in out}
            if left:
                total = sum(left.values())
                if symbol in left:
                    return result + np.log10((left[symbol] - 0.5) / total)
                result += np.log10(len(left) / (2 * total))
                out = frozenset(seen)
        return result - np.log10(max(P.ALPHABET - len(out), 1))

    def learn(self, data: bytes, at: int) -> None:
        for context in self._contexts(data, at):
            seen = self.counts.setdefault(context, {})
            seen[data[at]] = seen.get(data[at], 0) + 1

    def text(self, text: bytes, learn: bool, measure: bool = True) -> float:
        """log10 probability of a text, with or without learning it on the way."""
        data = bytes([END]) * self.order + normalise(text)
        total = 0.0
        for at in range(self.order, len(data)):
            if measure:
                total += self.log10(data, at)
            if learn:
                self.learn(data, at)
        return float(total)


def _adaptive(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [Trie(order).text(x, learn=True) for x in C.binary_values(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())],
                                             names=["doc_id", "score"])
    return run


def adaptive_score(docs: DataFrame, order: int = 3) -> DataFrame:
    """``doc_id`` and the log10 probability under a trie that learns from the text itself."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           T.StructField("score", T.DoubleType())])
    return docs.select("doc_id", C.text_bytes().alias("text")).mapInArrow(
        _adaptive(order), schema)

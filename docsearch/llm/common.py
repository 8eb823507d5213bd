"""Helpers that several operators share: words, hashes, stored tables, chunks of text."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsearch.runtime import new_folder, written  # noqa: F401

#: White space between words; ``bytes.split()`` and ``bytes.lower()`` follow the same ASCII rules.
SPACE = r"[\x20\x09-\x0D]+"
#: Bytes of text in one chunk.
CHUNK_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str, modulus: int) -> Column:
    """crc32 of the value as text, modulo ``modulus``; a null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


#: Rows of an Arrow batch of texts.
BATCH_ROWS = 1_000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(docs: DataFrame) -> DataFrame:
    """``docs``, with Arrow batches of its session limited to a size that suits texts.

    The usual 10,000 rows of text take much memory on both sides of a Python worker.
    """
    conf = docs.sparkSession.conf
    if not 0 < int(conf.get(_BATCH_CONF)) <= BATCH_ROWS:
        conf.set(_BATCH_CONF, str(BATCH_ROWS))
    return docs


def text_bytes() -> Column:
    """The text as UTF-8, null as empty."""
    return F.coalesce(F.col("text"), F.lit("")).cast("binary")


def parallelism(spark: SparkSession) -> int:
    """Tasks for a shuffle whose number of partitions is given by hand."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


def binary_values(column) -> list[bytes]:
    return [value or b"" for value in column.to_pylist()]


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word in bytes."""
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True])).astype(np.int8)))
    return edge[0::2], edge[1::2]


_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def mix(values: np.ndarray) -> np.ndarray:
    """Finishing steps of a 64-bit hash, so that all bits depend on all bits."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    global _powers
    if len(_powers[0]) < n:
        size = 1 << max(n, 1024).bit_length()
        made = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            out = np.ones(size, np.uint64)
            with np.errstate(over="ignore"):
                np.multiply.accumulate(np.full(size - 1, base, np.uint64), out=out[1:])
            made.append(out)
        _powers = made[0], made[1]
    return _powers[0][:n], _powers[1][:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of stretches of a sequence: polynomial sums, mixed with the length.

    A stretch has the same hash wherever it stands.
    """
    with np.errstate(over="ignore"):
        power, inverse = _power_tables(len(values) + 1)
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
        return mix((total[ends] - total[starts]) * inverse[starts]
                   + (ends - starts).astype(np.uint64) * _STEP)


class HashIndex:
    """Position of 64-bit keys in a sorted array, by open addressing; absent keys give -1."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys.astype(np.uint64)
        bits = max(int(len(keys) * 3).bit_length(), 4)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slots = np.full(1 << bits, -1, np.int32)
        left, place = np.arange(len(keys)), self._home(self.keys)
        while len(left):
            free = self.slots[place] < 0
            self.slots[place[free]] = left[free]
            rest = self.slots[place] != left
            left, place = left[rest], (place[rest] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * _STEP) >> self.shift).astype(np.int64)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        out = np.full(len(wanted), -1, np.int32)
        if not len(self.keys):
            return out
        place = self._home(wanted)
        at = self.slots[place]
        hit = (at >= 0) & (self.keys[at] == wanted)
        out[hit] = at[hit]
        left = np.flatnonzero(~hit & (at >= 0))
        place = place[left]
        while len(left):
            place = (place + 1) & self.mask
            at = self.slots[place]
            hit = (at >= 0) & (self.keys[at] == wanted[left])
            out[left[hit]] = at[hit]
            more = ~hit & (at >= 0)
            left, place = left[more], place[more]
        return out


# --- rows with a number, grouped into chunks of bounded size ----------------------


def _chunked(chunk_bytes: int, at: int, fields: list[str], rewrite: Callable | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        chunk = size = row = 0
        for batch in batches:
            texts = binary_values(batch.column(at))
            columns = list(batch.columns)
            if rewrite is not None:
                texts = [rewrite(x) for x in texts]
                columns[at] = pa.array(texts, pa.binary())
            lengths = np.array([len(x) for x in texts], np.int64)
            chunks = np.empty(len(lengths), np.int64)
            for i, length in enumerate(lengths.tolist()):
                if size and size + length > chunk_bytes:
                    chunk, size = chunk + 1, 0
                size += length + 64
                chunks[i] = part + chunk
            rows = part + row + np.arange(len(lengths))
            row += len(lengths)
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunks), pa.array(rows), *columns], names=fields)
    return run


def chunked(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES,
            rewrite: Callable[[bytes], bytes] | None = None) -> DataFrame:
    """The columns of ``docs`` (one of them binary ``text``) with ``chunk`` and ``row``.

    Rows keep the task that read them: nothing is shuffled. The table is stored
    bucketed by chunk, so that ``per_chunk`` moves only what it adds to the text.
    ``row`` is a number of its own for every row, repeated rows included.
    """
    spark = small_batches(docs).sparkSession
    schema = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("row", T.LongType()),
                           *docs.schema.fields])
    out = docs.mapInArrow(
        _chunked(chunk_bytes, docs.columns.index("text"), schema.names, rewrite), schema)
    name = f"chunks_{uuid.uuid4().hex}"
    (out.write.bucketBy(2 * parallelism(spark), "chunk").sortBy("chunk")
     .option("compression", "zstd").option("path", new_folder(spark, "chunks")).saveAsTable(name))
    return spark.table(name)


def per_chunk(chunks: DataFrame, known: DataFrame, run: Callable, schema) -> DataFrame:
    """Apply ``run(texts, known)`` to the rows of each chunk and what is known for it.

    A chunk has bounded bytes of text, and ``known`` at most some rows for each word.
    """
    return chunks.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(run, schema)


# --- texts of one Arrow batch as arrays of words -----------------------------------

#: Bytes of text that are turned into arrays at once; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20


def text_blocks(texts: list[bytes], block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of about ``block_bytes``."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > block_bytes:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def word_blocks(texts: list[bytes], rewrite: np.ndarray | None = None):
    """For each block: first and last text, bytes, starts and ends of words, text of each word.

    ``rewrite`` maps every byte before words are cut, as for case and punctuation.
    """
    for lo, hi in text_blocks(texts):
        lengths = np.array([len(x) + 1 for x in texts[lo:hi]], np.int64)
        data = np.frombuffer(b" ".join(texts[lo:hi]) + b" ", np.uint8)
        if rewrite is not None:
            data = rewrite[data]
        starts, ends = word_spans(data)
        owner = np.searchsorted(np.cumsum(lengths), starts, side="right")
        yield lo, hi, data, starts, ends, owner


def per_text(owner: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Sum of the weights (or the count) of the words of each text."""
    return np.bincount(owner, weights, minlength=n)

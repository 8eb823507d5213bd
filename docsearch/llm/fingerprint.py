"""Document fingerprints: SimHash with weighted terms, and search within a radius.

Terms are the words (A-Z in lower case) and the pairs of neighbouring words of a
text; of texts of few words also runs of four bytes. Every term has a hash of
``BITS`` signed bits and votes with its weight on each; the fingerprint has a bit
where the votes for one are in the majority. Likeness is the share of equal bits.

``within_radius`` finds all fingerprints within a Hamming radius. The bits stand in
radius + 1 blocks. Two fingerprints within the radius agree in at least one whole
block, so each of radius + 1 tables has another block in front as its key, and
pairs that share a key are compared. Each different fingerprint is there once,
however many documents have it.

``edited`` compares each document with an edited text, its first half followed by the
beginning of the next document in descending order of doc_id (the first after the
last). Documents are dealt to ranges of doc_id, and the first one of a range
also goes to the range before it, so nothing else is moved twice.

Defined results: a null text is empty; an empty text has the fingerprint of no bits.
Null ids come last; equal ids are ordered by text. A single document is its own
next. Repeated rows are each fingerprinted. Empty tables give no rows. Other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsearch.llm import common as C

LANES = 4
BITS = 64 * LANES
RADIUS = 7
PAIR_WEIGHT = 2
#: Texts of fewer words have byte runs as terms too.
FEW_WORDS = 16
_STEP = 0x9E3779B97F4A7C15
_SIGNS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64)


def _terms(data, starts, ends, owner, n):
    """Hash, weight and text of every term."""
    words = C.span_hashes(data, starts, ends)
    next_to = np.flatnonzero(owner[:-1] == owner[1:]) if len(owner) else owner
    with np.errstate(over="ignore"):
        pairs = C.mix(words[next_to] * np.uint64(_STEP) + words[next_to + 1])
    few = C.per_text(owner, n) < FEW_WORDS
    short = few[owner]
    lengths = ends[short] - starts[short]
    inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    begin = np.repeat(starts[short], lengths) + inside
    end = np.minimum(begin + 4, np.repeat(ends[short], lengths))
    runs = C.span_hashes(data, begin, end) if len(begin) else np.zeros(0, np.uint64)
    return (np.concatenate((words, pairs, runs)),
            np.concatenate((np.ones(len(words)), np.full(len(pairs), float(PAIR_WEIGHT)),
                            np.full(len(runs), 1.0))),
            np.concatenate((owner, owner[next_to], np.repeat(owner[short], lengths))))


def fingerprints_of(texts: list[bytes]) -> np.ndarray:
    """A row of BITS / 8 bytes for each text."""
    out = np.zeros((len(texts), BITS // 8), np.uint8)
    lowered = [x.lower() for x in texts]
    for lo, hi, data, starts, ends, owner in C.word_blocks(lowered):
        hashes, weights, of = _terms(data, starts, ends, owner, hi - lo)
        half = np.bincount(of, weights, minlength=hi - lo)[:, None] / 2
        for lane in range(LANES):
            lane_hash = C.mix(hashes + np.uint64((lane + 1) * _STEP % (1 << 64)))
            as_bytes = lane_hash.view(np.uint8).reshape(-1, 8)
            for k in range(8):
                votes = np.bincount(of * 256 + as_bytes[:, k], weights,
                                    minlength=(hi - lo) * 256).reshape(-1, 256) @ _SIGNS
                out[lo:hi, lane * 8 + k] = np.packbits(votes > half, axis=1)[:, 0]
    return out


def _hex(prints: np.ndarray) -> list[str]:
    return [x.tobytes().hex() for x in prints]


def _likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 1 - np.bitwise_count(a ^ b).sum(axis=-1) / BITS


def _fingerprinter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = fingerprints_of(C.binary_values(batch.column(1)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_hex(prints), pa.string())],
                                         names=["doc_id", "fingerprint"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fingerprint`` (hex) of every row."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("fingerprint", T.StringType())])
    return C.small_batches(docs).select("doc_id", C.text_bytes().alias("text")).mapInArrow(_fingerprinter, schema)


def within_radius(prints: DataFrame, wanted: Column, radius: int = RADIUS) -> DataFrame:
    """For each different fingerprint of the rows where ``wanted`` holds: all within the radius.

    ``fingerprint``, ``near``, ``distance``, ``n_docs`` (rows with the fingerprint near)
    and ``first_id`` (the smallest doc_id of them).
    """
    digits = BITS // 4
    if not 0 <= radius < digits or digits % (radius + 1):
        raise ValueError(f"radius + 1 must divide {digits}")
    width = digits // (radius + 1)
    prints = prints.select("doc_id", "fingerprint", wanted.alias("wanted"))
    distinct = C.written(prints.groupBy("fingerprint").agg(
        F.max("wanted").alias("wanted"), F.count("*").alias("n_docs"),
        F.min("doc_id").alias("first_id")), "prints")
    blocks = F.array(*[F.struct(F.lit(b).alias("block"),
                                F.substring("fingerprint", b * width + 1, width).alias("key"))
                       for b in range(radius + 1)])
    tables = distinct.select("fingerprint", "n_docs", "first_id", "wanted", F.inline(blocks))
    asked = tables.filter("wanted").select("block", "key", F.col("fingerprint").alias("asked"))
    apart = sum((F.bit_count(
        F.conv(F.substring("asked", i * 8 + 1, 8), 16, 10).cast("long").bitwiseXOR(
            F.conv(F.substring("fingerprint", i * 8 + 1, 8), 16, 10).cast("long")))
        for i in range(digits // 8)), F.lit(0))
    near = tables.join(asked, (tables["block"] == asked["block"]) & (tables["key"] == asked["key"])
                       & (apart <= radius))
    return near.select(
        F.col("asked").alias("fingerprint"), F.col("fingerprint").alias("near"),
        apart.cast("int").alias("distance"), "n_docs", "first_id").distinct()


_EDITED = [("n_chars", T.LongType()), ("edited_sha256", T.StringType()),
           ("fingerprint", T.StringType()), ("edited_fingerprint", T.StringType()),
           ("near_edited", T.DoubleType()), ("near_next", T.DoubleType())]


def _editor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of range after range in order; the extra rows of a range come last in it.

    Columns: range, extra, doc_id, text.
    """
    held = None
    for batch in batches:
        ranges, extra = (batch.column(i).to_pylist() for i in (0, 1))
        texts = [x or "" for x in batch.column(3).to_pylist()]
        ids = batch.column(2)
        first = held is not None
        if first:
            ranges, extra, texts = [held[0], *ranges], [held[1], *extra], [held[3], *texts]
            ids = pa.concat_arrays([held[2], ids])
        # A row has its next one right behind it, unless it is extra.
        rows = [i for i in range(len(texts) - 1) if not extra[i] and ranges[i] == ranges[i + 1]]
        held = (ranges[-1], extra[-1], ids.slice(len(texts) - 1, 1), texts[-1]) if texts else held
        for lo, hi in C.text_blocks([texts[i].encode() for i in rows]):
            mine = rows[lo:hi]
            half = [len(texts[i]) // 2 for i in mine]
            edited = [(texts[i][:len(texts[i]) - h] + texts[i + 1][:h]).encode()
                      for i, h in zip(mine, half, strict=True)]
            both = sorted({*mine, *(i + 1 for i in mine)})
            place = {i: k for k, i in enumerate(both)}
            prints = fingerprints_of([texts[i].encode() for i in both])
            own, after = (prints[[place[i + s] for i in mine]] for s in (0, 1))
            changed = fingerprints_of(edited)
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array(mine)), pa.array([len(texts[i]) for i in mine], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in edited], pa.string()),
                pa.array(_hex(own), pa.string()), pa.array(_hex(changed), pa.string()),
                pa.array(_likeness(own, changed)), pa.array(_likeness(own, after))],
                names=["doc_id", *(n for n, _ in _EDITED)])


def _at_or_above(falling: list, kind: T.DataType) -> Column:
    """How many of the falling values are at or above ``doc_id``, by binary search in an
    array that Spark folds to one literal, so neither plan nor row cost grows with its length."""
    values = F.from_json(F.lit(json.dumps(falling, default=str)), T.ArrayType(kind))

    def halve(at: Column, _: Column) -> Column:
        middle = F.shiftright(at["lo"] + at["hi"], 1)
        up = (at["lo"] < at["hi"]) & (F.get(values, middle) >= F.col("doc_id"))
        return F.struct(F.when(up, middle + 1).otherwise(at["lo"]).alias("lo"),
                        F.when(up, at["hi"]).otherwise(middle).alias("hi"))

    steps = F.array_repeat(F.lit(0), len(falling).bit_length())
    ends = F.struct(F.lit(0).alias("lo"), F.lit(len(falling)).alias("hi"))
    return F.aggregate(steps, ends, halve, lambda at: at["lo"])


def edited(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited`` and ``near_next`` for every row."""
    spark = C.small_batches(docs).sparkSession
    rows = docs.select("doc_id", "text")
    parts = C.parallelism(spark)
    # Ids alone are dealt to ranges by Spark; the largest id of each bounds it.
    held = rows.select("doc_id").repartitionByRange(parts, F.col("doc_id").desc_nulls_last()).groupBy(
        F.spark_partition_id()).agg(F.max("doc_id").alias("first")).collect()
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(n, t) for n, t in _EDITED)])
    if not held:
        return spark.createDataFrame([], schema)
    largest = sorted((r["first"] for r in held if r["first"] is not None), reverse=True)
    # Ranges count from the largest ids down; null ids are in the last.
    ranged = rows.withColumn("range", F.when(
        F.col("doc_id").isNull(), F.lit(max(len(largest) - 1, 0))).otherwise(
        _at_or_above(largest, docs.schema["doc_id"].dataType) - 1))
    firsts = list(enumerate(largest or [None]))
    starts = spark.createDataFrame(
        [(r, first, firsts[i - 1][0]) for i, (r, first) in enumerate(firsts)],
        T.StructType([T.StructField("range", T.IntegerType()),
                      T.StructField("first", docs.schema["doc_id"].dataType),
                      T.StructField("before", T.IntegerType())]))
    ranged = ranged.join(F.broadcast(starts), "range").withColumn("homes", F.when(
        F.col("doc_id").eqNullSafe(F.col("first")),
        F.array(F.struct("range", F.lit(False).alias("extra")),
                F.struct(F.col("before").alias("range"), F.lit(True).alias("extra")))).otherwise(
        F.array(F.struct("range", F.lit(False).alias("extra")))))
    dealt = ranged.select(F.inline("homes"), "doc_id", "text").repartitionById(
        parts, "range").sortWithinPartitions(
        "range", "extra", F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first())
    return dealt.mapInArrow(_editor, schema)

"""Near copies by SimHash, found with covering locality-sensitive hashing.

A text is lower-cased (A-Z) and cut into words and shingles of words, repeats
included. The fingerprint has a bit set where more than half the shingle hashes
have it. Fingerprints within ``radius`` bits are linked.

Covering: every bit position gets a nonzero vector of ``radius + 1`` bits, and
table v keeps the positions whose vector has odd overlap with v. The vectors of
up to ``radius`` differing positions do not span the space, so some v is
orthogonal to all of them: every pair within the radius agrees on all that some
table keeps. A table drops 3 of 7 positions at radius 2.

Buckets of two are compared at once. In fuller buckets no pairs are formed: each
member names the centres within half the radius. Two members within the radius
share such a centre, and all that share one are within the radius, so a star of
links for each centre gives the same components. A centre has at most 65
members at radius 2.

Defined results: null or blank text has fingerprint zero, linked like any other;
fewer words than a shingle make one shingle of all words; a null doc_id takes
part, and is a component id only where its component has no other.
Repeated rows give repeated rows. An empty table gives no rows. Other columns
are ignored by ``components`` and kept by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsearch.llm.common import binary_values, small_batches, text_bytes, written
from docsearch.llm.components import connected_components

SHINGLE = 3
RADIUS = 2
BITS = 64
_BLOCK = 1 << 16


def fingerprint_of(text: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of one text as an unsigned number."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.array(list(map(xxhash.xxh64_intdigest, shingles, repeat(42))), np.uint64)
    votes = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), _BLOCK):
        block = hashes[start:start + _BLOCK].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    bits = np.packbits(votes * 2 > len(hashes), bitorder="little")
    return int(bits.view(np.uint64)[0])


def _fingerprinter(shingle: int, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint_of(x, shingle)
                              for x in binary_values(batch.column(at))], np.uint64)
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            names = [n for i, n in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(found.view(np.int64))], names=[*names, "fingerprint"])
    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` (and ``row``, if given) and ``fingerprint`` as a long, for every row."""
    keys = [c for c in ("doc_id", "row") if c in docs.columns]
    wanted = small_batches(docs).select(*keys, text_bytes().alias("text"))
    schema = T.StructType([*wanted.drop("text").schema.fields,
                           T.StructField("fingerprint", T.LongType())])
    return wanted.mapInArrow(_fingerprinter(shingle, len(keys)), schema)


def covering_masks(radius: int = RADIUS) -> list[int]:
    """Bit masks, as signed numbers; two fingerprints within the radius agree under one."""
    vectors = (1 << (radius + 1)) - 1
    masks = []
    for v in range(1, vectors + 1):
        mask = sum(1 << i for i in range(BITS) if ((i % vectors + 1) & v).bit_count() % 2)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def _centres(radius: int) -> list[int]:
    """Differences of up to half the radius, as signed numbers."""
    found = [sum(1 << i for i in at) for n in range(radius // 2 + 1)
             for at in combinations(range(BITS), n)]
    return [x - (1 << 64) if x >> 63 else x for x in found]


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between different ``fingerprint`` values with the components of all pairs
    within ``radius`` bits. ``distinct`` has each value once."""
    if radius not in (0, 2, 4):
        raise ValueError("radius must be 0, 2 or 4")
    fp = F.col("fingerprint")
    tables = F.array(*[
        F.struct(F.lit(v).alias("mask"), fp.bitwiseAND(F.lit(mask)).alias("kept"))
        for v, mask in enumerate(covering_masks(radius))])
    keys = distinct.select("fingerprint", F.inline(tables))
    buckets = written(keys.groupBy("mask", "kept").agg(
        F.count("*").alias("n"), F.min("fingerprint").alias("a"), F.max("fingerprint").alias("b"),
    ).filter("n > 1"), "buckets")
    pairs = buckets.filter(
        (F.col("n") == 2) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
    ).select("a", "b")
    members = keys.join(buckets.filter("n > 2"), ["mask", "kept"], "left_semi").select(
        "fingerprint").distinct()
    centres = F.array(*[F.lit(c).cast("long") for c in _centres(radius)])
    stars = members.select(
        "fingerprint", F.explode(F.transform(centres, lambda c: c.bitwiseXOR(fp))).alias("centre"),
    ).groupBy("centre").agg(F.collect_list("fingerprint").alias("found")).filter(
        F.size("found") > 1
    ).select(F.explode("found").alias("a"), F.array_min("found").alias("b")).filter("a <> b")
    return pairs.union(stars)


def components(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id`` (and ``row``, if given), ``fingerprint`` (long), ``component_id`` and ``label``.

    ``label`` is the smallest fingerprint of the component: a key that is never null.
    """
    all_rows = written(fingerprints(docs, shingle), "fingerprints")
    distinct = written(
        all_rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "distinct")
    labels = connected_components(links(distinct, radius)).withColumnRenamed("node", "fingerprint")
    named = distinct.join(labels, "fingerprint", "left").withColumn(
        "label", F.coalesce("label", "fingerprint"))
    groups = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    classes = written(named.join(groups, "label").select("fingerprint", "component_id", "label"), "classes")
    return all_rows.join(classes, "fingerprint").select(
        *all_rows.columns, "component_id", "label")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The columns of ``docs`` for one row of each component: that of the smallest doc_id.

    Of repeated rows with that doc_id, the first in the table stays.
    """
    if not docs.columns:
        return docs
    caller = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("caller")
    numbered = written(
        docs.select(caller, F.monotonically_increasing_id().alias("row")), "numbered")
    found = written(
        components(numbered.select("caller.doc_id", "caller.text", "row"), shingle, radius),
        "components")
    first = found.groupBy("label").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"))
    keep = first.select("first.row")
    return numbered.join(keep, "row", "left_semi").select("caller.*")

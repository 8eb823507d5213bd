"""Stored indexes: Parquet tables under one folder that only ever grow by new files.

A sparse store keeps immutable segments and small versions that list them::

    docs/segment=../doc_bucket=..     cleaned documents with tokens
    words/segment=..                  word statistics of the segment
    postings/segment=..               term counts, bucketed by document, sorted by term
    terms/part=..                     the terms that such a part of the postings counts
    log/                              one row for each segment, in the order of writing
    versions/<n>/vocab                pruned vocabulary
    versions/<n>/rows-..              norm and attributes of each document, bucketed likewise
    meta/                             one row for each version, written last

A batch becomes a segment of tokens and word statistics. Publishing a version counts, in each
segment, the terms of its vocabulary that were not counted there yet, as another part of the
segment's postings: all of them, and as many of the next frequent, in a new segment; later the few
terms that have come into the vocabulary since. So a batch writes what it holds and little of the rest.
Weights are not stored: a search multiplies counts with the idf of its version and divides by
the norm of the document. The norms of a version are made when it is loaded first. When
``MERGE`` segments of one size have come together they are written as one, and a store that
has outgrown its buckets is dealt anew.

Nothing that a published version lists is overwritten: a save or an append that dies half-way
leaves the last version as it was. The store numbers its batches. A batch may come with a key
of its source, as the epoch of a stream; the same key gets the same number again, and its
segment takes the place of the one before. ``rejects/batch_id=..`` holds the rows of a batch
that were refused, with reasons. A store has one writer at a time. Files that no version lists
any more are left to the owner of the folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import replace

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsearch.operators import dense, sparse
from docsearch.plans import index as I
from docsearch.runtime import COMPRESSION, written
from docsearch.schema import DOCS, SparseParams
from docsearch.sources.bucketed import (
    append_json,
    json_rows,
    latest,
    read_bucketed,
    write_bucketed,
)

# Text in one bucket, least number of buckets, and how often that text before they are dealt anew.
# A bucket is sorted and scored by one task, so its counts and its scores must fit there.
BUCKET_BYTES = 16 << 20
LEAST_BUCKETS = 8
OUTGROWN = 4
# Rows of a page of stored documents: about what is read for one hit.
PAGE_ROWS = 64
# Segments of one size that are merged, as are the parts of a segment's postings; sizes are powers of it.
MERGE = 8
# A new segment counts so many times the terms of the vocabulary, for those that come in later.
AHEAD = 2

_SEGMENT = ("segment string, batch_id bigint, last_batch bigint, n_docs bigint, bytes bigint, "
            "posting_buckets int, doc_buckets int")
_LOG = f"place bigint, key string, replaces array<string>, reset boolean, {_SEGMENT}"
_SEGMENT_FIELDS = [f.split()[0] for f in _SEGMENT.split(", ")]
_META = (
    "version int, place bigint, n_docs bigint, vocab_rows int, max_features int, min_df int, "
    "max_df double, ngram_low int, ngram_high int, stop_words array<string>, "
    f"fallback_analyser boolean, segments array<struct<{_SEGMENT}>>, "
    "parts array<struct<segment string, part string, whole boolean>>"
)
_DENSE_META = (
    "version int, n_vectors bigint, dimension int, doc_buckets int, "
    "centres array<array<double>>, segments array<struct<segment: string, n_docs: bigint>>"
)
_PUBLISHED = "place bigint, sparse_version int, dense_version int"
_READY = "folder string"
_WORDS = "term string, df bigint, ctf bigint"
_VOCAB = "term string, df bigint, ctf bigint, idf double"
_COUNTS = "term string, doc_id string, batch_id bigint, tf bigint"
_ROWS = ("doc_id string, batch_id bigint, norm double, entity_id string, doc_type string, "
         "date timestamp_ntz")
_VECTORS = T.StructType([
    T.StructField("doc_id", T.StringType()), T.StructField("batch_id", T.LongType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("segment", T.StringType()), T.StructField("cluster_id", T.IntegerType())])
_STORED_DOCS = T.StructType([
    *DOCS.fields, T.StructField("tokens", T.ArrayType(T.StringType())),
    T.StructField("batch_id", T.LongType()), T.StructField("segment", T.StringType()),
    T.StructField("doc_bucket", T.IntegerType()),
])


def _write_folders(
    df: DataFrame, path: str, bucket: str, *order: str, page_rows: int | None = None,
    last: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """One folder per bucket. A bucket that is too large for one task is split.

    What ``last`` adds to the rows is made behind the exchange and the sort, which don't carry it.

    With ``page_rows`` every column is cut into pages of so many rows, so a reader that
    asks for few values of the sort column skips the other pages of all columns.
    """
    dealt = df.hint("rebalance", bucket).sortWithinPartitions(bucket, *order)
    if last is not None:
        dealt = last(dealt)
    writer = dealt.write.option("compression", COMPRESSION)
    if page_rows:
        writer = writer.option("parquet.page.row.count.limit", page_rows)
    writer.partitionBy(bucket).parquet(path)


def _read_segments(
    spark: SparkSession, root: str, segments: Sequence[str], schema: T.StructType
) -> DataFrame:
    paths = [f"{root}/segment={s}" for s in segments]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*paths)


def _as_stored(docs: DataFrame, schema: T.StructType) -> DataFrame:
    """The stored columns of documents, null where they have none."""
    fields = [f for f in schema.fields if f.name not in ("segment", "doc_bucket")]
    return docs.select(*[
        F.col(f.name) if f.name in docs.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in fields])


def due_merge(sizes: Sequence[tuple[str, int]], merge: int = MERGE) -> list[str]:
    """Segments (name, size) to be written as one: as many of one size as ``merge``, smallest
    sizes first; none when there are not that many."""
    tiers: dict[int, list[str]] = {}
    for name, size in sizes:
        tier = 0
        while size >= merge:
            size, tier = size // merge, tier + 1
        tiers.setdefault(tier, []).append(name)
    return next((names for _, names in sorted(tiers.items()) if len(names) >= merge), [])


def latest_rows(docs: DataFrame) -> DataFrame:
    """Of each document id, the row of its latest batch."""
    newest = Window.partitionBy("doc_id").orderBy(F.desc("batch_id"))
    return (
        docs.withColumn("_place", F.row_number().over(newest))
        .filter(F.col("_place") == 1).drop("_place")
    )


class SparseStore:
    """A stored sparse index that grows batch by batch.

    The numbers of buckets are for a new store; without them they follow from its first batch.
    """

    def __init__(
        self, spark: SparkSession, root: str, params: SparseParams = SparseParams(),
        posting_buckets: int | None = None, doc_buckets: int | None = None,
        replace: bool = False,
    ):
        self.spark, self.root, self.params = spark, root.rstrip("/"), params
        self.posting_buckets, self.doc_buckets = posting_buckets, doc_buckets
        self.replace = replace

    # --- the log of segments ---

    def _log(self) -> DataFrame:
        return json_rows(self.spark, f"{self.root}/log", _LOG)

    def _meta(self, version: int | None = None):
        rows = json_rows(self.spark, f"{self.root}/meta", _META)
        return latest(rows if version is None else rows.filter(F.col("version") == version),
                      "version")

    def _state(self) -> tuple[dict[str, dict], int]:
        """Segments that are live, by name, and the last place of the log.

        Only what was logged after the last version is collected.
        """
        meta = self._meta()
        live = {} if meta is None else {s["segment"]: s.asDict() for s in meta["segments"]}
        place = -1 if meta is None else meta["place"]
        if meta is not None and meta["fallback_analyser"]:
            # The one segment of such a version is its own; the log knows the others.
            live, place = {}, -1
        for entry in self._log().filter(F.col("place") > place).orderBy("place").collect():
            if entry["reset"]:
                live = {}
            for gone in entry["replaces"] or ():
                live.pop(gone, None)
            live[entry["segment"]] = {k: entry[k] for k in _SEGMENT_FIELDS}
            place = entry["place"]
        return live, place

    def _commit(self, place: int, entries: Sequence[tuple[dict, str | None, list[str], bool]]):
        append_json(self.spark, f"{self.root}/log", _LOG, [
            (place + 1 + i, key, replaces, reset, *[segment[k] for k in _SEGMENT_FIELDS])
            for i, (segment, key, replaces, reset) in enumerate(entries)])

    def batch_number(self, key: str | None = None, batch_id: int | None = None) -> int:
        """The number of a batch: that of its key, if the key was seen, or a new one.

        A number that is asked for and belongs to another key is an error.
        """
        log = self._log()
        start = log.filter("reset").agg(F.coalesce(F.max("place"), F.lit(-1))).first()[0]
        log = log.filter(F.col("place") >= start)
        if batch_id is not None:
            key = key if key is not None else f"batch {batch_id}"
            held = log.filter(
                (F.col("batch_id") == batch_id) & F.col("key").isNotNull()
                | F.col("reset") & (F.col("last_batch") >= batch_id)
            ).orderBy(F.desc("place")).first()
            if held is not None and held["key"] != key:
                raise ValueError(f"batch {batch_id} is taken by {held['key']!r}")
            return batch_id
        if key is not None:
            held = log.filter((F.col("key") == key) & F.col("batch_id").isNotNull()).agg(
                F.max("batch_id")).first()[0]
            if held is not None:
                return held
        last = log.agg(F.coalesce(F.max("last_batch"), F.lit(-1))).first()[0]
        return last + 1

    # --- segments ---

    def _buckets(self, live: dict[str, dict], docs: DataFrame) -> tuple[int, int]:
        """Numbers of buckets: those of the store, else as given, else from the text at hand."""
        for segment in live.values():
            return segment["posting_buckets"], segment["doc_buckets"]
        if self.posting_buckets and self.doc_buckets:
            return self.posting_buckets, self.doc_buckets
        size = docs.agg(F.sum(F.octet_length("content"))).first()[0] or 0
        return self._buckets_for(size)

    def _buckets_for(self, size: int) -> tuple[int, int]:
        n = max(-(-size // BUCKET_BYTES), LEAST_BUCKETS)
        return self.posting_buckets or n, self.doc_buckets or n

    def _write_segment(self, rows: DataFrame, buckets: tuple[int, int], batch_id: int | None,
                       analyse: SparseParams | None = None) -> dict:
        """Store cleaned documents with tokens, and the statistics of their words.

        With ``analyse`` the tokens are made here under these settings, where the rows are written.
        """
        segment = uuid.uuid4().hex
        postings, doc_buckets = buckets
        _write_folders(
            _as_stored(rows, _STORED_DOCS).withColumn(
                "doc_bucket", I.doc_bucket("doc_id", doc_buckets)),
            f"{self.root}/docs/segment={segment}", "doc_bucket", "doc_id", page_rows=PAGE_ROWS,
            last=None if analyse is None else lambda dealt: sparse.with_tokens(dealt, analyse))
        stored = self._docs([segment])
        sparse.term_statistics(stored, (1, 1)).write.option("compression", COMPRESSION).parquet(
            f"{self.root}/words/segment={segment}")
        size = stored.agg(F.count("*").alias("n"), F.sum(F.octet_length("content")).alias("b"),
                          F.max("batch_id").alias("last")).first()
        last = size["last"] if batch_id is None else batch_id
        return dict(segment=segment, batch_id=batch_id, last_batch=-1 if last is None else last,
                    n_docs=size["n"], bytes=size["b"] or 0, posting_buckets=postings,
                    doc_buckets=doc_buckets)

    def _write_part(self, segment: dict, ngram_range: tuple[int, int],
                    terms: Sequence[str] | None) -> dict:
        """Count the given terms, or all, in a segment, and store the counts as a part of its postings.

        Tokens, not postings, are dealt to the buckets; terms are counted there.
        """
        part, buckets = uuid.uuid4().hex, segment["posting_buckets"]
        # Tokens hold no space: as one text they take a third of the room in the exchange.
        dealt = self._docs([segment["segment"]]).select(
            *sparse.DOC_KEY, F.array_join("tokens", " ").alias("tokens"),
        ).filter("tokens <> ''").repartition(buckets, *sparse.DOC_KEY)
        if terms is None:
            counts = sparse.term_frequency(
                dealt.withColumn("tokens", F.split("tokens", " ")), ngram_range)
        else:
            counts = sparse.counts_of(dealt, terms, ngram_range)
            self.spark.createDataFrame([(t,) for t in terms], "term string").coalesce(1).write.parquet(
                f"{self.root}/terms/part={part}")
        write_bucketed(counts.select("term", *sparse.DOC_KEY, "tf"),
                       f"{self.root}/postings/segment={part}", buckets, sparse.DOC_KEY,
                       ("term", *sparse.DOC_KEY))
        return dict(segment=segment["segment"], part=part, whole=terms is None)

    def _posted(self, live: dict[str, dict], params: SparseParams, vocab: DataFrame,
                vocab_rows: int, ahead: DataFrame | None) -> list[dict]:
        """The parts that hold the vocabulary's counts in every segment; what is missing is written.

        ``ahead`` are the terms for a new segment; without them it counts all that it has.
        """
        meta, held = self._meta(), {name: [] for name in live}
        for p in () if meta is None else meta["parts"] or ():
            if p["segment"] in live:
                held[p["segment"]].append(p.asDict())
        partial = {p["part"]: p["segment"] for parts in held.values() for p in parts
                   if not any(q["whole"] for q in parts)}
        if vocab_rows > sparse.VOCABULARY_IN_MEMORY:
            ahead = None
        if ahead is None and not partial:
            wanted, new = set(), None
        elif vocab_rows > sparse.VOCABULARY_IN_MEMORY:
            wanted, new, partial = set(), None, {}
            held = {name: [p for p in parts if p["whole"]] for name, parts in held.items()}
        else:
            wanted = {r["term"] for r in vocab.select("term").collect()}
            new = None if ahead is None else sorted(
                wanted.union(r["term"] for r in ahead.select("term").collect()))
        counted: dict[str, set] = {}
        if partial:
            base = f"{self.root}/terms"
            terms = self.spark.read.schema("term string, part string").option("basePath", base).parquet(
                *[f"{base}/part={p}" for p in partial])
            for r in terms.join(vocab.select("term"), "term", "left_semi").collect():
                counted.setdefault(partial[r["part"]], set()).add(r["term"])
        for name, parts in held.items():
            if any(p["whole"] for p in parts):
                continue
            missing = sorted(wanted - counted.get(name, set()))
            if not parts or missing and len(parts) >= MERGE:
                held[name] = [self._write_part(live[name], params.ngram_range, new)]
            elif missing:
                parts.append(self._write_part(live[name], params.ngram_range, missing))
        return [p for parts in held.values() for p in parts]

    def _docs(self, segments: Sequence[str]) -> DataFrame:
        return _read_segments(self.spark, f"{self.root}/docs", segments, _STORED_DOCS)

    def append(self, docs: DataFrame, batch_id: int | None = None, key: str | None = None) -> int:
        """Clean, tokenise and store one batch as a segment.

        Returns the number of the batch. A batch that comes again under the same
        key or number replaces its own rows.
        """
        batch_id = self.batch_number(key, batch_id)
        live, place = self._state()
        rows = I.cleaned_documents(docs.withColumn("batch_id", F.lit(batch_id).cast("bigint")))
        buckets = self._buckets(live, docs)
        replaces, entries = [], []
        for name, segment in live.items():
            if segment["batch_id"] == batch_id:
                replaces.append(name)
            elif segment["batch_id"] is None and segment["last_batch"] >= batch_id:
                # A merged segment may hold the batch: what else it holds is written without it.
                held = self._docs([name])
                if not held.filter(F.col("batch_id") == batch_id).isEmpty():
                    rest = held.filter(F.col("batch_id") != batch_id)
                    entries.append((self._write_segment(rest, buckets, None), None, [name], False))
        new = self._write_segment(rows, buckets, batch_id, self.params)
        self._commit(place, [*entries, (
            new, key if key is not None else f"batch {batch_id}", replaces, False)])
        return batch_id

    def write_rejects(self, rejects: DataFrame, batch_id: int) -> None:
        """Keep the refused rows of a batch with their ``errors``."""
        rejects.write.mode("overwrite").parquet(f"{self.root}/rejects/batch_id={batch_id}")

    def rejects(self) -> DataFrame | None:
        """All refused rows, or none when there are none yet."""
        try:
            return self.spark.read.parquet(f"{self.root}/rejects")
        except AnalysisException:
            return None

    # --- versions ---

    def is_current(self) -> bool:
        """Whether all stored batches are searchable."""
        last = self._log().agg(F.max("place")).first()[0]
        meta = self._meta()
        return last is None or (meta is not None and meta["place"] >= last)

    def _replaced(self, live: dict[str, dict]) -> list[tuple]:
        """Log entries for the segments that hold rows of ids that came again later."""
        keys = self._docs(list(live)).select("doc_id", "batch_id", "segment")
        again = keys.groupBy("doc_id").agg(
            F.max("batch_id").alias("last"), F.count("*").alias("n")).filter("n > 1")
        dead = written(keys.join(again, "doc_id"), "dead")
        entries = []
        for (name,) in dead.select("segment").distinct().collect():
            older = dead.filter(F.col("batch_id") < F.col("last")).select("doc_id", "batch_id")
            rest = latest_rows(self._docs([name]).join(
                older.distinct(), list(sparse.DOC_KEY), "left_anti"))
            segment = live[name]
            buckets = segment["posting_buckets"], segment["doc_buckets"]
            new = self._write_segment(rest, buckets, segment["batch_id"])
            if new["n_docs"] != segment["n_docs"]:
                entries.append((new, None, [name], False))
        return entries

    def _tidied(self) -> tuple[dict[str, dict], int]:
        """The live segments after what is due: replaced rows, larger buckets, merges."""
        live, place = self._state()
        if self.replace and live and (entries := self._replaced(live)):
            self._commit(place, entries)
            live, place = self._state()
        size, names = sum(s["bytes"] for s in live.values()), []
        buckets = self._buckets_for(size)
        held = next(((s["posting_buckets"], s["doc_buckets"]) for s in live.values()), buckets)
        if buckets[0] > OUTGROWN * held[0]:
            names = list(live)
        else:
            buckets, names = held, due_merge([(n, s["n_docs"]) for n, s in live.items()])
        if names:
            merged = self._write_segment(self._docs(names), buckets, None)
            self._commit(place, [(merged, None, names, False)])
            live, place = self._state()
        return live, place

    def publish(self) -> int | None:
        """Make the stored documents searchable as a new version; none without documents.

        Reads the word statistics and the tokens of the segments, writes the vocabulary, and
        of the postings what the segments don't have yet.
        """
        live, place = self._tidied()
        if not live:
            return None
        n_docs = sum(s["n_docs"] for s in live.values())
        freq, floor = self._statistics(live, n_docs, self.params.for_corpus(n_docs))
        fitted, vocab, rows = I.fit_with_fallback(freq, n_docs, self.params)
        if rows == 0 and n_docs > 0:
            fitted = fitted.last_resort(n_docs)
            again = sparse.with_tokens(self._docs(list(live)).drop("tokens"), fitted)
            segment = next(iter(live.values()))
            own = self._write_segment(
                again, (segment["posting_buckets"], segment["doc_buckets"]), None)
            live = {own["segment"]: own}
            freq, floor = self._statistics(live, n_docs, fitted)
            vocab, rows = I.fit_vocabulary(freq, n_docs, fitted)
        limit = AHEAD * fitted.max_features
        few = freq.limit(limit + 1).count() <= limit
        ahead = None
        if floor > 1 or not few:
            ahead = vocab
            if limit <= sparse.VOCABULARY_IN_MEMORY:
                ahead = sparse.prune_vocabulary(
                    freq, n_docs, replace(fitted.permissive(), max_features=limit))
        return self._write_version(live, place, n_docs, fitted, vocab, rows, ahead)

    def _statistics(self, live: dict[str, dict], n_docs: int,
                    params: SparseParams) -> tuple[DataFrame, int]:
        """Written statistics of the terms that can be in the vocabulary of the segments."""
        paths = [f"{self.root}/words/segment={s}" for s in live]
        words = self.spark.read.schema(_WORDS).parquet(*paths)
        if len(paths) > 1:
            words = written(words.groupBy("term").agg(
                F.sum("df").alias("df"), F.sum("ctf").alias("ctf")), "words")
        freq, floor = sparse.vocabulary_statistics(self._docs(list(live)), n_docs, params, words)
        return written(freq, "freq"), floor

    def refresh(self) -> I.SparseIndex | None:
        """``publish`` and ``load``. With ``replace`` an id that came again replaces its
        older row; otherwise both rows stay."""
        return self.load(self.publish())

    def save(self, index: I.SparseIndex) -> I.SparseIndex:
        """Store an index that was built in one go, in place of what the store held.

        Every batch keeps its number, so the postings still find their documents. Until
        the new version is there, the last one stays what it was.
        """
        version = self.save_version(index)
        return self.load(version)

    def save_version(self, index: I.SparseIndex) -> int:
        rows = I.with_batch(index.docs.drop("doc_bucket", "segment"))
        _, place = self._state()
        segment = self._write_segment(rows, self._buckets({}, rows), None)
        self._commit(place, [(segment, "a saved index", [], True)])
        return self._write_version({segment["segment"]: segment}, place + 1, index.n_docs,
                                   index.params, index.vocab, index.vocab_rows, index.vocab)

    def _write_version(self, live: dict[str, dict], place: int, n_docs: int, params: SparseParams,
                       vocab: DataFrame, vocab_rows: int, ahead: DataFrame | None) -> int:
        parts = self._posted(live, params, vocab, vocab_rows, ahead)
        previous = self._meta()
        version = 1 if previous is None else previous["version"] + 1
        vocab.select("term", "df", "ctf", "idf").write.mode("overwrite").parquet(
            f"{self.root}/versions/{version}/vocab")
        p = params
        append_json(self.spark, f"{self.root}/meta", _META, [(
            version, place, n_docs, vocab_rows, p.max_features, p.min_df, p.max_df, *p.ngram_range,
            None if p.stop_words is None else list(p.stop_words), p.fallback_analyser,
            [tuple(s[k] for k in _SEGMENT_FIELDS) for s in live.values()],
            [(p["segment"], p["part"], p["whole"]) for p in parts],
        )])
        return version

    def load(self, version: int | None = None) -> I.SparseIndex | None:
        """The newest complete version, or the given one; none when there is none yet."""
        meta = self._meta(version)
        if meta is None:
            return None
        base = f"{self.root}/versions/{meta['version']}"
        segments = [s["segment"] for s in meta["segments"]]
        buckets, doc_buckets = meta["segments"][0]["posting_buckets"], meta["segments"][0]["doc_buckets"]
        stop_words = meta["stop_words"]
        vocab = self.spark.read.schema(_VOCAB).parquet(f"{base}/vocab")
        counts = read_bucketed(
            self.spark, [f"{self.root}/postings/segment={p['part']}" for p in meta["parts"]], _COUNTS,
            buckets, sparse.DOC_KEY)
        docs = self._docs(segments).drop("segment")
        rows = self._rows(base, docs, counts, vocab, meta["vocab_rows"], buckets)
        return I.SparseIndex(
            docs=docs, vocab=vocab,
            postings=sparse.weighted(counts, rows, vocab, meta["vocab_rows"]),
            n_docs=meta["n_docs"], vocab_rows=meta["vocab_rows"],
            params=SparseParams(
                meta["max_features"], meta["min_df"], meta["max_df"],
                (meta["ngram_low"], meta["ngram_high"]),
                None if stop_words is None else tuple(stop_words), meta["fallback_analyser"],
            ),
            doc_buckets=doc_buckets, counts=counts, rows=rows,
        )

    def _rows(self, base: str, docs: DataFrame, counts: DataFrame, vocab: DataFrame,
              vocab_rows: int, buckets: int) -> DataFrame:
        """Norm and attributes of every document of a version; made when it is loaded first."""
        made = json_rows(self.spark, f"{base}/ready", _READY).orderBy("folder").first()
        if made is None:
            folder = f"{base}/rows-{uuid.uuid4().hex}"
            attributes = docs.select(*sparse.DOC_KEY, "entity_id", "doc_type", "date")
            rows = attributes.repartition(buckets, *sparse.DOC_KEY).join(
                sparse.norms(counts, vocab, vocab_rows).hint("shuffle_hash"),
                list(sparse.DOC_KEY), "left")
            write_bucketed(rows.select(*[c.split()[0] for c in _ROWS.split(", ")]), folder, buckets,
                           sparse.DOC_KEY, sparse.DOC_KEY)
            append_json(self.spark, f"{base}/ready", _READY, [(folder,)])
            made = json_rows(self.spark, f"{base}/ready", _READY).orderBy("folder").first()
        return read_bucketed(self.spark, [made["folder"]], _ROWS, buckets, sparse.DOC_KEY)


class DenseStore:
    """A stored dense index; vectors are partitioned by cluster.

    ``docs`` and ``vectors`` hold segments that only grow by new ones; a row of ``meta``
    lists those of a version and makes it visible.
    """

    def __init__(self, spark: SparkSession, root: str, doc_buckets: int | None = None):
        self.spark, self.root, self.doc_buckets = spark, root.rstrip("/"), doc_buckets

    def _meta(self, version: int | None = None):
        rows = json_rows(self.spark, f"{self.root}/meta", _DENSE_META)
        return latest(rows if version is None else rows.filter(F.col("version") == version),
                      "version")

    def _write_segment(self, docs: DataFrame, vectors: DataFrame, buckets: int) -> tuple[str, int]:
        segment = uuid.uuid4().hex
        docs = _as_stored(docs, _STORED_DOCS).drop("tokens")
        _write_folders(docs.withColumn("doc_bucket", I.doc_bucket("doc_id", buckets)),
                       f"{self.root}/docs/segment={segment}", "doc_bucket", "doc_id", page_rows=PAGE_ROWS)
        if "cluster_id" not in vectors.columns:
            vectors = vectors.withColumn("cluster_id", F.lit(0))
        _write_folders(vectors.select("doc_id", "batch_id", "embedding", "cluster_id"),
                       f"{self.root}/vectors/segment={segment}", "cluster_id", "doc_id")
        return segment, self._docs([segment]).count()

    def _docs(self, segments: Sequence[str]) -> DataFrame:
        schema = T.StructType([f for f in _STORED_DOCS.fields if f.name != "tokens"])
        return _read_segments(self.spark, f"{self.root}/docs", segments, schema)

    def _vectors(self, segments: Sequence[str]) -> DataFrame:
        return _read_segments(self.spark, f"{self.root}/vectors", segments, _VECTORS)

    def _publish(self, segments: list[tuple], index: I.DenseIndex, buckets: int) -> int:
        previous = self._meta()
        version = 1 if previous is None else previous["version"] + 1
        centres = None if index.centres is None else [
            [float(x) for x in centre] for centre in index.centres]
        append_json(self.spark, f"{self.root}/meta", _DENSE_META, [(
            version, index.n_vectors, index.dimension, buckets, centres, segments)])
        return version

    def save_version(self, index: I.DenseIndex) -> int:
        size = None
        if not self.doc_buckets:
            size = index.docs.agg(F.sum(F.octet_length("content"))).first()[0] or 0
        buckets = self.doc_buckets or max(-(-size // BUCKET_BYTES), LEAST_BUCKETS)
        segment = self._write_segment(index.docs, index.vectors, buckets)
        return self._publish([segment], index, buckets)

    def save(self, index: I.DenseIndex) -> I.DenseIndex:
        """Store an index in place of what the store held."""
        return self.load(self.save_version(index))

    def append_version(self, docs: DataFrame, vectors: Callable[[DataFrame], DataFrame]) -> int:
        """Add the documents (with ``batch_id``) that are not held yet, as a segment.

        ``vectors`` makes ``doc_id, batch_id, embedding`` for the new documents only.
        Centres are kept; new vectors go to their nearest cluster. Nothing that is held is
        written again, but for segments of one size that have come to ``MERGE``.
        """
        held = self.load()
        if held is None:
            new = written(docs, "new")
            return self.save_version(I.build_dense_index(new, vectors(new)))
        meta = self._meta()
        new = written(dense.new_vectors(docs, held.docs.select("doc_id", "batch_id")), "new")
        added = I.build_dense_index(new, vectors(new))
        unit = added.vectors
        if held.clustered:
            unit = dense.nearest_clusters(unit, held.centres, 1).withColumn(
                "cluster_id", F.col("clusters")[0]).drop("clusters")
        segments = [tuple(s) for s in meta["segments"]]
        segments.append(self._write_segment(new, unit, meta["doc_buckets"]))
        if names := due_merge(segments):
            merged = self._write_segment(
                self._docs(names), self._vectors(names), meta["doc_buckets"])
            segments = [s for s in segments if s[0] not in names] + [merged]
        return self._publish(segments, replace(
            held, n_vectors=held.n_vectors + added.n_vectors,
            dimension=max(held.dimension, added.dimension)), meta["doc_buckets"])

    def append(self, docs: DataFrame, vectors: Callable[[DataFrame], DataFrame]) -> I.DenseIndex:
        return self.load(self.append_version(docs, vectors))

    def load(self, version: int | None = None) -> I.DenseIndex | None:
        """The newest complete version, or the given one; none when there is none yet."""
        meta = self._meta(version)
        if meta is None:
            return None
        segments, centres = [s["segment"] for s in meta["segments"]], meta["centres"]
        return I.DenseIndex(
            docs=self._docs(segments).drop("segment"),
            vectors=self._vectors(segments).drop("segment"),
            n_vectors=meta["n_vectors"], dimension=meta["dimension"],
            centres=None if centres is None else np.array(centres),
            doc_buckets=meta["doc_buckets"],
        )


class HybridStore:
    """Both stores under one folder, with one row that publishes a version of each.

    What is written to one store and not to the other stays invisible.
    """

    def __init__(
        self, spark: SparkSession, root: str, params: SparseParams = SparseParams(),
        posting_buckets: int | None = None, doc_buckets: int | None = None, replace: bool = False,
    ):
        self.spark, self.root = spark, root.rstrip("/")
        self.sparse = SparseStore(
            spark, f"{root}/sparse", params, posting_buckets, doc_buckets, replace)
        self.dense = DenseStore(spark, f"{root}/dense", doc_buckets)

    def published(self):
        """The newest pair of versions, or none."""
        return latest(json_rows(self.spark, f"{self.root}/published", _PUBLISHED), "place")

    def publish(self, sparse_version: int | None, dense_version: int | None) -> None:
        """Make a pair of versions visible; a side without one keeps the one it has."""
        last = self.published()
        if last is not None:
            sparse_version = last["sparse_version"] if sparse_version is None else sparse_version
            dense_version = last["dense_version"] if dense_version is None else dense_version
        append_json(self.spark, f"{self.root}/published", _PUBLISHED, [(
            0 if last is None else last["place"] + 1, sparse_version, dense_version)])

    def save(self, sparse_index: I.SparseIndex | None, dense_index: I.DenseIndex | None) -> None:
        """Store both indexes; either part may be missing."""
        self.publish(
            None if sparse_index is None else self.sparse.save_version(sparse_index),
            None if dense_index is None else self.dense.save_version(dense_index))

    def load(self) -> tuple[I.SparseIndex | None, I.DenseIndex | None]:
        """Each part that is there."""
        last = self.published()
        if last is None:
            return None, None
        left, right = last["sparse_version"], last["dense_version"]
        return (None if left is None else self.sparse.load(left),
                None if right is None else self.dense.load(right))


def save_hybrid(
    spark: SparkSession, root: str, sparse_index: I.SparseIndex | None,
    dense_index: I.DenseIndex | None, posting_buckets: int | None = None,
    doc_buckets: int | None = None,
) -> None:
    """Store both indexes under one folder; either part may be missing."""
    params = SparseParams() if sparse_index is None else sparse_index.params
    HybridStore(spark, root, params, posting_buckets, doc_buckets).save(sparse_index, dense_index)


def load_hybrid(
    spark: SparkSession, root: str
) -> tuple[I.SparseIndex | None, I.DenseIndex | None]:
    """Each part that is there."""
    return HybridStore(spark, root).load()

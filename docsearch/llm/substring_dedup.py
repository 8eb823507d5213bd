"""Substring dedup: words in windows that occur more than once, by FM-indexes of shards.

A window is ``window`` consecutive words of one document. Its anchor is the
least hash of its runs of ``GRAM`` words, so equal windows have equal anchors.
Consecutive windows of one anchor form a segment.

1. Texts are stored in chunks; every chunk lists its anchors with counts.
2. Segments whose anchor occurs twice or more go to the shard of the anchor, each
   different one once for a chunk, with its count. All other text stays.
3. Each shard builds a compressed FM-index of its different segments and streams
   them through it. Backward search over the wavelet matrix gives matching statistics:
   how far left of a position the words occur twice or more. Windows inside
   stretches of at least ``window`` words are reported, as bits of the segment.
   Segments that several documents share are reported whole.
4. Each chunk gets what was reported for it and cuts its texts.

An anchor that occurs more than ``HOT`` times, as one in a line that very many
texts have, may have any number of segments. Its windows are counted by 128-bit
hashes instead, summed for each chunk before they are shuffled.

Words are compared by 64-bit hashes. All windows are judged on the input.

Defined results: a null or blank text has no words, and a text shorter than the
window no windows: nothing is removed. Windows repeated within one document
count. Repeated rows are copies. ``row`` numbers rows, so ids may be null or
repeated. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsearch.llm import common as C
from docsearch.llm.fm_index import FMIndex

WINDOW = 35
GRAM = 8
HOT = 4_000
SHARD_WORDS = 1 << 16
_SALT = np.uint64(0xD6E8FEB86659FD93)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _slide(best, values: np.ndarray, width: int) -> np.ndarray:
    """``best`` (minimum or maximum) of every run of ``width`` values."""
    done = 1
    while done * 2 <= width:
        values, done = best(values[:-done], values[done:]), done * 2
    rest = width - done
    return best(values[:len(values) - rest], values[rest:]) if rest else values


class Segments:
    """Windows, anchors and segments of a block of texts."""

    def __init__(self, words: np.ndarray, owner: np.ndarray, window: int):
        span = window - GRAM + 1
        n = len(words) - window + 1
        empty = np.zeros(0, np.int64)
        self.anchors = self.anchor_owner = self.starts = self.ends = self.least = empty
        self.windows = empty
        if n <= 0:
            return
        at = np.arange(len(words) - GRAM + 1)
        grams = C.span_hashes(words, at, at + GRAM) | np.uint64(1)
        inside = owner[:n] == owner[window - 1:]
        least = np.where(inside, _slide(np.minimum, grams, span), np.uint64(0))
        padded = np.concatenate((np.zeros(span - 1, np.uint64), least,
                                 np.zeros(span - 1, np.uint64)))
        chosen = np.flatnonzero(_slide(np.maximum, padded, span) == grams)
        self.anchors, self.anchor_owner = grams[chosen], owner[chosen]
        self.windows = np.flatnonzero(inside)
        if not len(self.windows):
            return
        mine = least[self.windows]
        new = np.concatenate(([True], (np.diff(self.windows) != 1) | (mine[1:] != mine[:-1])))
        run = np.flatnonzero(new)
        place = np.arange(len(mine)) - run[np.cumsum(new) - 1]
        first = np.flatnonzero(place % span == 0)
        last = np.concatenate((first[1:], [len(mine)])) - 1
        self.starts = self.windows[first]
        self.ends = self.windows[last] + window
        self.least = mine[first]
        self.segment_of = np.cumsum(place % span == 0) - 1


def _blocks(texts: list[bytes], window: int):
    for lo, hi, data, starts, ends, owner in C.word_blocks(texts):
        words = C.span_hashes(data, starts, ends)
        yield lo, hi, data, starts, ends, owner, words, Segments(words, owner, window)


def _window_hashes(words: np.ndarray, at: np.ndarray, window: int):
    return (C.span_hashes(words, at, at + window),
            C.span_hashes(C.mix(words + _SALT), at, at + window))


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def _anchor_lister(window: int):
    """Columns chunk, text: anchors of each chunk with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks = batch.column(0).to_numpy()
            for lo, hi, *_, found in _blocks(C.binary_values(batch.column(1)), window):
                mine = chunks[lo:hi][found.anchor_owner]
                for chunk in np.unique(mine):
                    anchors, n = np.unique(found.anchors[mine == chunk], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(n), chunk)), _longs(anchors), pa.array(n)],
                        names=["chunk", "anchor", "n"])
    return run


_SENT = "chunk long, anchor long, key long, second long, n long, words binary"


def _sender(window: int):
    def run(texts: pa.Table, known: pa.Table) -> pa.Table:
        """Different segments of a chunk with a repeated anchor; of hot anchors, the windows."""
        names = ["chunk", "anchor", "key", "second", "n", "words"]
        types = [pa.int64()] * 5 + [pa.binary()]
        schema = pa.schema(list(zip(names, types, strict=True)))
        if not texts.num_rows or not known.num_rows:
            return schema.empty_table()
        chunk = texts["chunk"][0].as_py()
        anchors = known["anchor"].to_numpy().view(np.uint64)
        order = np.argsort(anchors)
        anchors, hot = anchors[order], known["hot"].to_numpy().astype(bool)[order]
        segments: dict[int, list] = {}
        windows = []
        for *_, data, starts, ends, _, words, found in _blocks(
                C.binary_values(texts["text"]), window):
            at = np.minimum(np.searchsorted(anchors, found.least), len(anchors) - 1)
            repeated = anchors[at] == found.least if len(at) else np.zeros(0, bool)
            send = np.flatnonzero(repeated & ~hot[at])
            keys = C.span_hashes(words, found.starts[send], found.ends[send])
            first_byte = starts[found.starts[send]].tolist()
            end_byte = ends[found.ends[send] - 1].tolist()
            raw = data.tobytes()
            for key, anchor, a, b in zip(keys.tolist(), found.least[send].tolist(), first_byte,
                                         end_byte, strict=True):
                if key in segments:
                    segments[key][1] += 1
                else:
                    segments[key] = [anchor, 1, raw[a:b]]
            if len(at):
                begin = found.windows[(repeated & hot[at])[found.segment_of]]
                if len(begin):
                    windows.append(np.stack(_window_hashes(words, begin, window)))
        out = [pa.table([
            pa.array(np.full(len(segments), chunk)),
            _longs(np.array([v[0] for v in segments.values()], np.uint64)),
            _longs(np.array(list(segments), np.uint64)),
            pa.nulls(len(segments), pa.int64()),
            pa.array([v[1] for v in segments.values()], pa.int64()),
            pa.array([v[2] for v in segments.values()], pa.binary())], schema=schema)]
        if windows:
            pairs, n = np.unique(np.concatenate(windows, axis=1), axis=1, return_counts=True)
            out.append(pa.table([
                pa.array(np.full(len(n), chunk)), pa.nulls(len(n), pa.int64()),
                _longs(pairs[0]), _longs(pairs[1]), pa.array(n),
                pa.nulls(len(n), pa.binary())], schema=schema))
        return pa.concat_tables(out)
    return run


def repeated_windows(segments: list[bytes], counts: np.ndarray, window: int) -> np.ndarray:
    """For each different segment, the windows that occur more than once, as bits from its start.

    ``counts`` says how often each segment occurs.
    """
    found = [(C.span_hashes(data, starts, ends), owner + lo)
             for lo, _, data, starts, ends, owner in C.word_blocks(segments)]
    hashes, owner = (np.concatenate(x) for x in zip(*found, strict=True))
    distinct, symbols = np.unique(hashes, return_inverse=True)
    lengths = np.bincount(owner, minlength=len(segments))
    last = np.cumsum(lengths)
    first = last - lengths
    masks = np.zeros(len(segments), np.int64)
    n_windows = lengths - window + 1
    shared = counts > 1
    masks[shared] = (np.int64(1) << n_windows[shared]) - 1
    # Windows of segments that occur once, without words or pairs of words that occur once.
    once = np.zeros(len(symbols) + 1, np.int64)
    index = FMIndex(symbols, last, len(distinct))
    once[1:] = index.occurrences(symbols) < 2
    pair = np.zeros(len(symbols) + 1, np.int64)
    if len(symbols) > 1:
        key = symbols[:-1].astype(np.int64) * len(distinct) + symbols[1:]
        _, place, n = np.unique(key, return_inverse=True, return_counts=True)
        pair[1:-1] = n[place] < 2
    once, pair = np.cumsum(once), np.cumsum(pair)
    at = np.repeat(first, n_windows) + (
        np.arange(n_windows.sum()) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows))
    of = np.repeat(np.arange(len(segments)), n_windows)
    open_ = ~shared[of] & (once[at + window] == once[at]) & (pair[at + window - 1] == pair[at])
    at, of = at[open_], of[open_]
    if not len(at):
        return masks
    # One search for each run of such windows; where it ends early, one for each window.
    new = np.concatenate(([True], (np.diff(at) != 1) | (np.diff(of) != 0)))
    run = np.flatnonzero(new)
    run_end = np.concatenate((run[1:], [len(at)])) - 1
    whole = at[run_end] + window - at[run]
    reach = index.matching(symbols, at[run_end] + window, whole)
    # Windows within the reach are repeated.
    left = at[run_end] + window - reach
    run_of = np.cumsum(new) - 1
    repeated = (at >= left[run_of]) & (reach[run_of] >= window)
    rest = np.flatnonzero(~repeated)
    # The last window of a run whose search fell short is known not to be.
    rest = rest[~((rest == run_end[run_of[rest]]) & (reach[run_of[rest]] < window))]
    repeated[rest] = index.matching(
        symbols, at[rest] + window, np.full(len(rest), window)) >= window
    np.bitwise_or.at(masks, of[repeated],
                     np.int64(1) << (at[repeated] - first[of[repeated]]))
    return masks


def _shard_searcher(window: int, shard_words: int):
    """Rows sorted by anchor; whole anchors are gathered until a shard is full."""
    def report(rows: dict) -> pa.RecordBatch:
        masks = repeated_windows([v[0] for v in rows.values()],
                                 np.array([v[1] for v in rows.values()]), window)
        chunk, key, bits = [], [], []
        for (_, k), (_, _, chunks), mask in zip(rows, rows.values(), masks.tolist(), strict=True):
            if mask:
                chunk += chunks
                key += [k] * len(chunks)
                bits += [mask] * len(chunks)
        return pa.RecordBatch.from_arrays(
            [pa.array(chunk, pa.int64()), pa.array(key, pa.int64()), pa.array(bits, pa.int64())],
            names=["chunk", "key", "mask"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict = {}
        size, before = 0, None
        for batch in batches:
            for chunk, anchor, key, n, words in zip(
                    *(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if anchor != before and size >= shard_words:
                    yield report(rows)
                    rows, size = {}, 0
                before = anchor
                if found := rows.get((anchor, key)):
                    found[1] += n
                    found[2].append(chunk)
                else:
                    rows[anchor, key] = [words, n, [chunk]]
                    size += 2 * window
        if rows:
            yield report(rows)
    return run


def _cutter(window: int, verbatim: bool):
    def run(texts: pa.Table, known: pa.Table) -> pa.Table:
        if known.num_rows:
            # A key has one mask; a hot window has mask 0 here.
            keys, masks = (known[c].to_numpy() for c in ("key", "mask"))
            keys, at = np.unique(keys.view(np.uint64), return_index=True)
            masks = masks[at]
        else:
            keys, masks = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        index = C.HashIndex(keys)
        values = C.binary_values(texts["text"])
        n_words, n_removed, kept = [], [], []
        for lo, hi, _, starts, _, owner, words, found in _blocks(values, window):
            cover = np.zeros(len(starts) + 1, np.int64)
            if len(keys) and len(found.windows):
                at = index.find(C.span_hashes(words, found.starts, found.ends))
                mask = np.where(at >= 0, masks[at], 0)[found.segment_of]
                place = found.windows - found.starts[found.segment_of]
                bad = (mask >> place) & 1 == 1
                hot = index.find(C.span_hashes(words, found.windows, found.windows + window))
                bad |= (hot >= 0) & (masks[hot] == 0)
                np.add.at(cover, found.windows[bad], 1)
                np.add.at(cover, found.windows[bad] + window, -1)
            gone = np.cumsum(cover)[:-1] > 0
            total = C.per_text(owner, hi - lo)
            removed = C.per_text(owner, hi - lo, gone).astype(np.int64)
            n_words += total.tolist()
            n_removed += removed.tolist()
            begin = np.cumsum(total) - total
            for i in range(lo, hi):
                if not removed[i - lo] and verbatim:
                    kept.append(values[i])
                    continue
                mine = values[i].split()
                if removed[i - lo]:
                    first = begin[i - lo]
                    stay = np.flatnonzero(~gone[first:first + len(mine)]).tolist()
                    mine = [mine[j] for j in stay]
                kept.append(b" ".join(mine))
        out = texts.drop_columns(["chunk", "row", "text"])
        return out.append_column("n_words", pa.array(n_words, pa.int64())).append_column(
            "n_removed", pa.array(n_removed, pa.int64())).append_column(
            "kept", pa.array(kept, pa.binary()))
    return run


def cut(docs: DataFrame, window: int = WINDOW, verbatim: bool = False,
        hot: int = HOT, chunk_bytes: int = C.CHUNK_BYTES) -> DataFrame:
    """The columns of ``docs`` but the text, with ``n_words``, ``n_removed`` and ``kept``.

    ``kept`` (binary) has the remaining words joined by single spaces, or with
    ``verbatim`` the text itself where nothing is removed. Columns of ``docs`` that are
    named like what is added are replaced.
    """
    added = ("n_words", "n_removed", "kept")
    others = [c for c in docs.columns if c.lower() != "text"]
    doc = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in others])
    found = _cut(docs.select(doc.alias("doc"), "text"), window, verbatim, hot, chunk_bytes)
    return found.select(
        *[F.col(f"doc.`{c}`") for c in others if c.lower() not in added], *added)


def _cut(docs: DataFrame, window: int, verbatim: bool, hot: int, chunk_bytes: int) -> DataFrame:
    """``cut`` of rows of ``doc`` and ``text``."""
    if not GRAM < window <= 63:
        raise ValueError(f"window must be above {GRAM} and at most 63 words")
    spark = docs.sparkSession
    chunks = C.chunked(docs.withColumn("text", C.text_bytes()), chunk_bytes)
    anchors = C.written(chunks.select("chunk", "text").mapInArrow(
        _anchor_lister(window), "chunk long, anchor long, n long"), "anchors")
    repeated = anchors.groupBy("anchor").agg(F.sum("n").alias("total")).filter("total > 1")
    known = anchors.join(repeated, "anchor").select(
        "chunk", "anchor", (F.col("total") > hot).alias("hot")).distinct()
    sent = C.written(C.per_chunk(chunks.select("chunk", "text"), known, _sender(window), _SENT),
                     "segments")
    parts = C.parallelism(spark)
    shards = sent.filter("words is not null").select(
        "chunk", "anchor", "key", "n", "words").repartition(parts, "anchor").sortWithinPartitions(
        "anchor").mapInArrow(_shard_searcher(window, SHARD_WORDS),
                             "chunk long, key long, mask long")
    windows = sent.filter("words is null").select("chunk", "key", "second", "n")
    often = windows.groupBy("key", "second").agg(F.sum("n").alias("total")).filter("total > 1")
    hot_windows = windows.join(often, ["key", "second"], "left_semi").select(
        "chunk", "key", F.lit(0).cast("long").alias("mask"))
    report = C.written(shards.union(hot_windows), "report")
    schema = T.StructType([
        *chunks.drop("chunk", "row", "text").schema.fields, T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("kept", T.BinaryType())])
    return C.per_chunk(chunks, report, _cutter(window, verbatim), schema)


def strip(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The columns of ``docs`` with repeated stretches cut from the texts.

    Texts without such stretches stay as they are, null texts too. A text that
    loses all its words goes. ``n_chars`` follows the text where it is there.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(F.struct(F.lit(0).alias("_"), *others).alias("row"), F.col(
        "text").isNull().alias("none")).alias("doc"), "text")
    kept = _cut(rows, window, True, HOT, C.CHUNK_BYTES).filter(
        "n_removed = 0 or n_removed < n_words")
    text = F.when(F.col("doc.none"), F.lit(None)).otherwise(F.col("kept").cast("string"))

    def column(name: str) -> Column:
        if name == "text":
            return text.alias(name)
        value = F.col(f"doc.row.`{name}`")
        if name == "n_chars":
            value = F.when(F.col("n_removed") == 0, value).otherwise(F.length(text)).cast(
                docs.schema[name].dataType)
        return value.alias(name)

    return kept.select(*map(column, docs.columns))

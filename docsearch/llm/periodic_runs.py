"""Periodic runs of words, from an enhanced suffix array.

A run is a stretch of consecutive words of one text with smallest period ``q`` (words ``q``
apart are equal), that no neighbouring word extends, of at least ``min_exponent`` periods and
``min_length`` words.

Texts of a block are sorted together by prefix doubling, with an end of its own behind each
text, so that no two texts share a prefix. Ranks of every doubling step give the LCP of
neighbours and tell whether two stretches are equal. For each LCP interval of depth ``d`` (a
stretch of the suffix array, no tree), the suffixes ``i`` of all children but the largest are
tested: if the inverse array puts ``i + d`` or ``i - d`` into the same interval, and the words
behind the two copies differ, they start a branching square. Every run ends in one. Squares are
rotated to the left as far as words agree, by steps of powers of two over the stored ranks, and
squares of one stretch are merged to the run of the smallest period.

Work and memory follow the words of a block (about ``BLOCK_BYTES`` of text, or one longer
text): some 4 bytes a word for each doubling of the longest repeated stretch.

Defined results: null, empty and blank texts have no words, no runs and an empty collapsed
text. Ids may be null and repeated; repeated rows give repeated rows, an empty table none.
Only the columns that are asked for are returned, and others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsearch.llm.common import binary_values, small_batches, text_blocks, text_bytes

MIN_LENGTH = 6
MIN_EXPONENT = 4
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


class SuffixArray:
    """Suffix array, inverse and LCP of ``codes``, in which no end of a text occurs twice.

    ``levels[k]`` ranks positions by their first ``2**k`` codes.
    """

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        order = np.argsort(codes, kind="stable").astype(np.int32)
        fresh = np.empty(n, bool)
        fresh[:1] = True
        fresh[1:] = codes[order[1:]] != codes[order[:-1]]
        first = np.flatnonzero(fresh).astype(np.int32)
        rank = np.empty(n, np.int32)
        rank[order] = np.repeat(first, np.diff(np.append(first, n)))
        self.levels = [rank]
        left = np.flatnonzero(~(fresh & np.append(fresh[1:], True)))
        while len(left):
            # What is not told apart yet lies in groups of the order; groups are sorted on.
            step = 1 << (len(self.levels) - 1)
            at = order[left]
            key = rank[at].astype(np.int64) * (n + 1) + rank[at + step]
            by = np.argsort(key, kind="stable")
            key, at = key[by], at[by]
            order[left] = at
            fresh = np.append(True, key[1:] != key[:-1])
            first = np.flatnonzero(fresh)
            sizes = np.diff(np.append(first, len(key)))
            rank = rank.copy()
            rank[at] = np.repeat(left[first], sizes)
            self.levels.append(rank)
            left = left[np.repeat(sizes > 1, sizes)]
        self.order, self.inverse = order, rank
        # The LCP of each suffix with the one before it in the order; 0 at both ends.
        self.lcp = np.zeros(n + 1, np.int32)
        pair = np.flatnonzero(codes[order[1:]] == codes[order[:-1]]) + 1
        a, b, length = order[pair - 1], order[pair], np.zeros(len(pair), np.int32)
        for k in range(len(self.levels) - 1, -1, -1):
            same = self.levels[k][a + length] == self.levels[k][b + length]
            length[same] += 1 << k
        self.lcp[pair] = length

    def stretch_left(self, start: np.ndarray, period: np.ndarray) -> np.ndarray:
        """How far to the left words and those a period behind them agree, from ``start``."""
        begin = start.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            at = np.maximum(begin - (1 << k), 0)
            same = (begin >= 1 << k) & (self.levels[k][at] == self.levels[k][at + period])
            begin[same] -= 1 << k
        return begin


def _nearest(values: np.ndarray, back: bool, strict: bool) -> np.ndarray:
    """For each place the nearest one before (or behind) it with a smaller value (or one as
    small); ``values`` begin and end with their least value."""
    if not back:
        return len(values) - 1 - _nearest(values[::-1], True, strict)[::-1]
    tables, n = [values], len(values)
    # A stretch above the least value is the longest that any search has to pass.
    floor = np.flatnonzero(values == values[0])
    longest = int(np.diff(floor).max(initial=1))
    while 1 << len(tables) <= longest:
        below, half = tables[-1], 1 << (len(tables) - 1)
        table = below.copy()
        np.minimum(below[half:], below[:-half], out=table[half:])
        tables.append(table)
    at = np.arange(n)
    for k in range(len(tables) - 1, -1, -1):
        # The least of the 2**k values that end before ``at``.
        least = tables[k][np.maximum(at - 1, 0)]
        ok = (least >= values) if strict else (least > values)
        ok &= at - (1 << k) >= 0
        at[ok] -= 1 << k
    return at - 1


def branching_squares(codes: np.ndarray, array: SuffixArray) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of the squares whose next word differs from that a period before."""
    lcp = array.lcp
    # Stretches of the order with an LCP of 0 around them are enough.
    inner = np.flatnonzero(lcp > 0)
    if not len(inner):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    wanted = np.unique(np.concatenate((inner - 1, inner, inner + 1)))
    values = lcp[wanted]
    values[0] = values[-1] = 0
    before, behind = _nearest(values, True, True), _nearest(values, False, True)
    as_small = _nearest(values, True, False)
    deep = values > 0
    # Interval of each place: suffixes low to high of the order, depth; once for each interval.
    low, high = wanted[np.maximum(before, 0)], wanted[np.minimum(behind, len(values) - 1)] - 1
    first = deep & (values[np.maximum(as_small, 0)] < values)
    node = np.full(len(values), -1)
    node[first] = np.arange(first.sum())
    # A place that is not the first of its interval belongs to that of the first.
    key = low.astype(np.int64) * (len(lcp) + 1) + high
    by = np.argsort(key[first], kind="stable")
    node[deep] = by[np.searchsorted(key[first][by], key[deep])]
    low, high, depth = low[first], high[first], values[first]
    at = np.flatnonzero(first)
    left, right = before[at], behind[at]
    up = np.where(values[left] >= values[right], left, right)
    parent = np.where(values[up] > 0, node[up], -1)

    # All children of an interval but the largest; suffixes of their own are children too.
    size = high - low + 1
    by = np.lexsort((size, parent))
    largest = np.append(parent[by][1:] != parent[by][:-1], True)
    small = by[~largest]
    small = small[parent[small] >= 0]
    count = size[small]
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    place = np.concatenate((np.repeat(low[small], count) + inside, np.zeros(0, np.int64)))
    owner = np.repeat(parent[small], count)
    # A suffix is a leaf of the deeper of the intervals at its two sides.
    suffixes = np.unique(np.concatenate((inner - 1, inner)))
    here, there = lcp[suffixes], lcp[suffixes + 1]
    side = np.searchsorted(wanted, np.where(here >= there, suffixes, suffixes + 1))
    place = np.concatenate((place, suffixes)).astype(np.int64)
    owner = np.concatenate((owner, node[side])).astype(np.int64)

    start, period = [], []
    i, d = array.order[place].astype(np.int64), depth[owner].astype(np.int64)
    low, high = low[owner], high[owner]
    for one, two in ((i, i + d), (i - d, i)):
        ok = (one >= 0) & (two < len(codes))
        other = np.where(two == i, one, two)[ok]
        rank = array.inverse[other]
        ok[ok] = (rank >= low[ok]) & (rank <= high[ok])
        ok[ok] = codes[two[ok]] != codes[two[ok] + d[ok]]
        start.append(one[ok])
        period.append(d[ok])
    return np.concatenate(start), np.concatenate(period)


def runs_of(codes: np.ndarray, min_length: int = MIN_LENGTH,
            min_exponent: int = MIN_EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of the runs of a sequence, by start, then period.

    The ends of texts in it are codes that occur once; the last code is one.
    """
    if not len(codes):
        return (np.zeros(0, np.int64),) * 3
    array = SuffixArray(codes)
    start, period = branching_squares(codes, array)
    end = start + 2 * period
    begin = array.stretch_left(start, period)
    by = np.lexsort((period, end, begin))
    begin, end, period = begin[by], end[by], period[by]
    once = np.ones(len(by), bool)
    once[1:] = (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])
    length = end - begin
    good = once & (length >= np.maximum(min_length, min_exponent * period))
    begin, length, period = begin[good], length[good], period[good]
    by = np.lexsort((period, begin))
    return begin[by], length[by], period[by]


def _finder(min_length: int, min_exponent: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = binary_values(batch.column(0))
            for lo, hi in text_blocks(texts):
                yield _found(batch.slice(lo, hi - lo), [t.split() for t in texts[lo:hi]])

    def _found(rows: pa.RecordBatch, words: list[list[bytes]]) -> pa.RecordBatch:
        known: dict[bytes, int] = {}
        counts = np.array([len(w) for w in words], np.int64)
        first = np.cumsum(counts + 1) - counts - 1
        codes = np.empty(int(counts.sum()) + len(words), np.int64)
        for at, mine in zip(first.tolist(), words, strict=True):
            codes[at:at + len(mine)] = [known.setdefault(w, len(known)) for w in mine]
        # Words of different texts are different, and so are the ends.
        text = np.repeat(np.arange(len(words)), counts + 1)
        codes[first + counts] = len(known)
        codes += text * (len(known) + 1)
        start, length, period = runs_of(codes, min_length, min_exponent)
        of = text[start]
        drop = np.zeros(len(codes) + 1, np.int64)
        np.add.at(drop, start + period, 1)
        np.add.at(drop, start + length, -1)
        drop = np.cumsum(drop) > 0
        hit = set(of.tolist())
        collapsed = [
            b" ".join([w for w, gone in zip(mine, drop[first[t]:].tolist()) if not gone]
                      if t in hit else mine)
            for t, mine in enumerate(words)]
        offsets = np.searchsorted(of, np.arange(len(words) + 1)).astype(np.int32)
        runs = pa.StructArray.from_arrays(
            [pa.array(start - first[of]), pa.array(length), pa.array(period)],
            ["start", "length", "period"])
        return pa.RecordBatch.from_arrays(
            [*rows.columns[1:], pa.array(counts), pa.ListArray.from_arrays(offsets, runs),
             pa.array(collapsed, pa.binary()).cast(pa.string())], names=names)
    return run


def find(docs: DataFrame, columns: tuple[str, ...] = ("doc_id",), min_length: int = MIN_LENGTH,
         min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """The given columns of ``docs`` with ``n_words``, ``runs`` (by start, then period) and
    ``collapsed``: the text without the words that a run repeats after its first period."""
    small_batches(docs)
    wanted = docs.select(text_bytes().alias("text"), *[F.col(f"`{c}`") for c in columns])
    schema = T.StructType([
        *wanted.schema.fields[1:], T.StructField("n_words", T.LongType()),
        T.StructField("runs", T._parse_datatype_string(RUNS)),
        T.StructField("collapsed", T.StringType())])
    return wanted.mapInArrow(_finder(min_length, min_exponent, schema.names), schema)


def longest_run(runs: str = "runs"):
    """The run of the greatest exact length over period; ties by start, then period."""
    def better(best, r):
        more = r["length"] * best["period"] > best["length"] * r["period"]
        return F.when(best.isNull() | more, r).otherwise(best)
    kind = T._parse_datatype_string(RUNS).elementType
    return F.aggregate(runs, F.lit(None).cast(kind), better)

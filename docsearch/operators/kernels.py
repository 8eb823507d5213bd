"""NumPy scoring and counting inside Spark tasks.

Spark decides which vectors and queries meet and sums the counts; these helpers score
one Arrow batch or one cell, or count the terms of one batch. They are sent to the workers by value, so the workers need
no installed copy of the package.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Scores are rounded so that copies of a vector tie in every block shape.
SCORE_DIGITS = 10
_SCORE_BLOCK = 256
# Rows that a task holds before it sends them on.
_HELD_ROWS = 1_000_000

HITS = "query_id string, doc_id string, batch_id bigint, score double"
HITS_ARROW = pa.schema([
    ("query_id", pa.string()), ("doc_id", pa.string()),
    ("batch_id", pa.int64()), ("score", pa.float64()),
])

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def matrix_of(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of an Arrow list column as a matrix in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros((0, 0))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), -1)


class BestHits:
    """Best rows per query seen by one task, with all ties of the last place.

    What is dropped cannot be among the first ``k`` rows of the query overall.
    Ids stay in Arrow; only those of kept rows are copied. With ``probes`` a
    cluster's rows meet only the queries that probe the cluster.
    """

    def __init__(self, query_ids, matrix, thresholds, ks, probes=None):
        self.query_ids, self.matrix = query_ids, matrix
        self.ks, self.probes = ks, probes
        self.n_held = 0
        self.kept: list[list[tuple]] = [[] for _ in query_ids]
        self.floors = np.array(thresholds, dtype=np.float64)

    def add(self, doc_ids: pa.Array, batch_ids: pa.Array, vectors: np.ndarray, clusters=None) -> None:
        if clusters is None:
            everything = np.arange(len(self.query_ids))
            self._score(np.arange(len(vectors)), vectors, everything, doc_ids, batch_ids)
            return
        order = np.argsort(clusters, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(clusters[order])) + 1):
            asked = np.flatnonzero(self.probes[:, clusters[rows[0]]])
            self._score(rows, vectors[rows], asked, doc_ids, batch_ids)

    def _score(self, rows, vectors, asked, doc_ids, batch_ids) -> None:
        for start in range(0, len(asked), _SCORE_BLOCK):
            block = asked[start:start + _SCORE_BLOCK]
            scores = np.round(vectors @ self.matrix[block].T, SCORE_DIGITS)
            np.minimum(scores, 1.0, out=scores)
            wanted = scores >= self.floors[block]
            for at in np.flatnonzero(wanted.any(axis=0)):
                found = np.flatnonzero(wanted[:, at])
                self._keep(block[at], rows[found], scores[found, at], doc_ids, batch_ids)

    def _keep(self, q, rows, scores, doc_ids, batch_ids) -> None:
        k, taken = self.ks[q], pa.array(rows)
        self.kept[q].append((scores, doc_ids.take(taken), batch_ids.take(taken)))
        self.n_held += len(rows)
        held = np.concatenate([part[0] for part in self.kept[q]])
        if len(held) > 4 * k:
            floor = np.partition(held, len(held) - k)[len(held) - k]
            self.floors[q] = max(self.floors[q], floor)
            keep = held >= floor
            self.n_held -= len(held) - int(keep.sum())
            self.kept[q] = [(
                held[keep],
                pa.concat_arrays([part[1] for part in self.kept[q]]).filter(pa.array(keep)),
                pa.concat_arrays([part[2] for part in self.kept[q]]).filter(pa.array(keep)),
            )]

    def sent(self) -> pa.Table:
        """The rows held so far, which are then forgotten; the floors stay."""
        found = self.table()
        self.kept, self.n_held = [[] for _ in self.query_ids], 0
        return found

    def table(self) -> pa.Table:
        ids, docs, batches, scores = [], [], [], []
        for query_id, parts in zip(self.query_ids, self.kept):
            for part in parts:
                ids.append(pa.repeat(pa.scalar(query_id, pa.string()), len(part[0])))
                scores.append(part[0])
                docs.append(part[1])
                batches.append(part[2])
        if not ids:
            return HITS_ARROW.empty_table()
        return pa.table(
            [pa.chunked_array(ids), pa.chunked_array(docs), pa.chunked_array(batches),
             pa.array(np.concatenate(scores), pa.float64())],
            schema=HITS_ARROW,
        ).combine_chunks()


def nearest(block: np.ndarray, centres: np.ndarray, n_probe: int) -> np.ndarray:
    """Numbers of the centres nearest to each row."""
    distance = (centres ** 2).sum(axis=1) - 2.0 * (block @ centres.T)
    return np.argsort(distance, axis=1, kind="stable")[:, :n_probe].astype(np.int32)


def batch_scorer(query_ids, matrix, thresholds, ks, probes):
    """Function for ``mapInArrow``: every batch against one query matrix."""
    def run(batches):
        best = BestHits(query_ids, matrix, thresholds, ks, probes)
        for batch in batches:
            if batch.num_rows:
                clusters = None if probes is None else np.asarray(batch.column("cluster_id"))
                best.add(
                    batch.column("doc_id").cast(pa.string()), batch.column("batch_id"),
                    matrix_of(batch.column("embedding")), clusters,
                )
            if best.n_held > _HELD_ROWS:
                yield from best.sent().to_batches(100_000)
        yield from best.table().to_batches()

    return run


def cluster_prober(centres: np.ndarray, n_probe: int):
    """Function for ``mapInPandas``: add the nearest clusters of each row."""
    def run(frames):
        for frame in frames:
            block = np.array(frame["embedding"].tolist(), dtype=np.float64)
            found = nearest(block, centres, n_probe) if len(frame) else []
            yield frame.assign(clusters=list(found))

    return run


# --- counts of terms -----------------------------------------------------------

STATISTICS = "term string, df bigint, ctf bigint"
RUN_STATISTICS = "n int, code bigint, df bigint, ctf bigint"
TERM_COUNTS = "term string, doc_id string, batch_id bigint, tf bigint"
TERM_WEIGHTS = f"{TERM_COUNTS}, weight double"


def _tokens_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All tokens of a batch in one array, and the row that each is from."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return column.flatten().cast(pa.string()), np.repeat(np.arange(len(column)), lengths)


def _split(column: pa.Array) -> pa.Array:
    """Lists of tokens; texts hold them with a space between."""
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        split = pc.split_pattern(column, " ")
        return pc.if_else(pc.equal(column, ""), pa.scalar(None, split.type), split)
    return column


def _numbers(tokens: pa.Array, words: pa.Array) -> np.ndarray:
    """Place of each token in the words, -1 for others."""
    found = pc.fill_null(pc.index_in(tokens, value_set=words), -1)
    return found.to_numpy(zero_copy_only=False).astype(np.int64)


def _frequencies(rows: np.ndarray, codes: np.ndarray, n_codes: int) -> tuple[np.ndarray, np.ndarray]:
    """Of codes below ``n_codes``: rows that hold each, and occurrences."""
    pairs, times = np.unique(rows * n_codes + codes, return_counts=True)
    codes = pairs % n_codes
    return (np.bincount(codes, minlength=n_codes),
            np.bincount(codes, weights=times, minlength=n_codes).astype(np.int64))


def _coded(tokens: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct words in order, and the place of each token in them."""
    coded = tokens.dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    place = np.empty(len(order), dtype=np.int64)
    place[order.to_numpy()] = np.arange(len(order))
    return coded.dictionary.take(order), place[coded.indices.to_numpy(zero_copy_only=False)]


def statistics_counter(low: int, high: int):
    """Function for ``mapInArrow``: statistics of the runs of ``low`` to ``high`` words of each batch.

    Runs of one length leave in order, word by word: neighbours share their first words, so they take
    less room in the shuffle and in the files behind it.
    """
    def count(batches):
        for batch in batches:
            tokens, rows = _tokens_of(batch.column("tokens"))
            if not len(tokens):
                continue
            words, ids = _coded(tokens)
            n_words = len(words)
            runs, terms, at = ids, words, np.arange(len(ids))
            for n in range(1, high + 1):
                if n > 1:
                    at = np.flatnonzero(rows[:len(ids) - n + 1] == rows[n - 1:])
                    distinct, places = np.unique(
                        runs[at] * n_words + ids[at + n - 1], return_inverse=True)
                    runs = np.full(len(ids), -1, dtype=np.int64)
                    runs[at] = places
                    terms = pc.binary_join_element_wise(
                        terms.take(pa.array(distinct // n_words)),
                        words.take(pa.array(distinct % n_words)), " ")
                if n >= low and len(at):
                    df, ctf = _frequencies(rows[at], runs[at], len(terms))
                    yield pa.RecordBatch.from_arrays(
                        [terms, pa.array(df), pa.array(ctf)], ["term", "df", "ctf"])
    return count


def run_counter(words: list[str], low: int, high: int):
    """Function for ``mapInArrow``: statistics of the runs of ``low`` to ``high`` of the words in
    each batch. The code of a run has its words as digits, in base ``len(words)``."""
    listed = pa.array(words, pa.string())

    def count(batches):
        for batch in batches:
            tokens, rows = _tokens_of(batch.column("tokens"))
            ids = _numbers(tokens, listed)
            codes, known = ids, ids >= 0
            for n in range(2, high + 1):
                last = ids[n - 1:]
                codes, known = codes[:len(last)] * len(words) + last, known[:len(last)] & (last >= 0)
                if n < low:
                    continue
                at = np.flatnonzero(known & (rows[:len(last)] == rows[n - 1:]))
                if len(at):
                    distinct, places = np.unique(codes[at], return_inverse=True)
                    df, ctf = _frequencies(rows[at], places, len(distinct))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(df), n, dtype=np.int32)), pa.array(distinct),
                         pa.array(df), pa.array(ctf)], ["n", "code", "df", "ctf"])
    return count


def term_counter(terms: list[str], low: int, high: int, idf: list[float] | None = None):
    """Function for ``mapInArrow``: counts of the given terms in each document; with ``idf`` also
    their weights, of length one in each document.

    Terms are found word by word: the runs of n words that begin a term are numbered by
    the run of n - 1 words and the word behind it.
    """
    split = [t.split(" ") for t in terms]
    words = sorted({w for t in split for w in t})
    place = {w: i for i, w in enumerate(words)}
    coded = [[place[w] for w in t] for t in split]
    number = {(i,): i for i in range(len(words))}
    keys, ends = [None], [np.full(len(words), -1, dtype=np.int64)]
    for n in range(2, high + 1):
        found = {tuple(t[:n]): number[tuple(t[:n - 1])] * len(words) + t[n - 1]
                 for t in coded if len(t) >= n}
        ordered = sorted(found, key=found.get)
        number = {run: i for i, run in enumerate(ordered)}
        keys.append(np.array([found[run] for run in ordered], dtype=np.int64))
        ends.append(np.full(len(ordered), -1, dtype=np.int64))
        for i, t in enumerate(coded):
            if len(t) == n >= low:
                ends[-1][number[tuple(t)]] = i
    for i, t in enumerate(coded):
        if len(t) == 1 >= low:
            ends[0][t[0]] = i
    listed, named = pa.array(words, pa.string()), pa.array(terms, pa.string())
    factors = None if idf is None else np.array(idf, dtype=np.float64)

    def count(batches):
        for batch in batches:
            tokens, rows = _tokens_of(_split(batch.column("tokens")))
            ids = _numbers(tokens, listed)
            runs, at, which = ids, [], []
            for n in range(1, high + 1):
                if n > 1:
                    last = ids[n - 1:]
                    before = runs[:len(last)]
                    code = np.where((before >= 0) & (last >= 0) & (rows[:len(last)] == rows[n - 1:]),
                                    before * len(words) + last, -1)
                    runs = np.searchsorted(keys[n - 1], code)
                    known = runs < len(keys[n - 1])
                    known[known] = keys[n - 1][runs[known]] == code[known]
                    runs[~known] = -1
                held = np.flatnonzero(runs >= 0)
                held = held[ends[n - 1][runs[held]] >= 0]
                at.append(rows[held])
                which.append(ends[n - 1][runs[held]])
            # By term and document, so that a sort behind this finds long sorted stretches.
            order = pc.sort_indices(batch, sort_keys=[
                ("doc_id", "ascending"), ("batch_id", "ascending")]).to_numpy().astype(np.int64)
            place = np.empty(len(order), dtype=np.int64)
            place[order] = np.arange(len(order))
            pairs, tf = np.unique(
                np.concatenate(which) * len(order) + place[np.concatenate(at)], return_counts=True)
            if not len(pairs):
                continue
            rows, which = order[pairs % len(order)], pairs // len(order)
            values, names = [pa.array(tf.astype(np.int64))], ["tf"]
            if factors is not None:
                raw = tf * factors[which]
                values.append(pa.array(raw / np.sqrt(np.bincount(rows, weights=raw * raw))[rows]))
                names.append("weight")
            rows = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [named.take(pa.array(which)), batch.column("doc_id").take(rows),
                 batch.column("batch_id").take(rows), *values],
                ["term", "doc_id", "batch_id", *names])
    return count

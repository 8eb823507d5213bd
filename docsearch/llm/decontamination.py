"""Benchmark decontamination: a BM25 index of test items, queried with every passage.

Items are put in classes of length, by powers of two. For each class every document is
cut into overlapping passages, so long and so close that any stretch as long as the longest
item that the class can hold lies in one. So the passages of an item follow from its own length
and not from what else is in the table. A passage is a query of its different words against an inverted index of the items. Impacts are BM25 weights
divided by the item's own sum of weights: an item that a passage holds in full
scores 1, and all items at or above ``threshold`` are retrieved.

The search is block-max WAND, made for a batch of passages at once. Items stand
in blocks, and each list has the largest impact of a block. The words of an
item are split into the rare ones and the rest, whose sum of impacts is known.
A (passage, block) pair is opened only if the block maxima of its rare words
plus the largest rest of the block reach the threshold; all else is skipped
unread. Opened blocks are scored in full. No item at or above the threshold is lost.

A retrieved item is reported if its question and its answer both overlap one span of the
passage of twice the item's length: the share of their words inside runs of ``RUN`` or more
words that the span has too is at least ``overlap``. The answer is the last line, else the
last sentence; an item of one sentence has only a question.

The items are read in groups of ``ITEM_BYTES`` of text, each broadcast in turn;
document frequencies cover all items, so other items move a score as far as they move the
idf of its words, and nothing else.

Defined results: items without words are never found, documents without words
find none. Null and empty texts are kept by ``remove``. Repeated rows and items
are each reported. Ids may be null. Empty tables give no matches. Other columns
are ignored by ``matches`` and kept by ``remove``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsearch.llm import common as C

THRESHOLD = 0.5
OVERLAP = 0.7
RUN = 3
K1, B = 1.2, 0.75
BLOCK_ITEMS = 4
ITEM_BYTES = 16 << 20
_SHORTEST = 16

#: Letters, digits and bytes of longer characters; all else parts words. Texts come in lower case.
_REWRITE = np.array([b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)], np.uint8)


def _lower(column) -> list[bytes]:
    return [(x or "").lower().encode() for x in column.to_pylist()]


def _hashes(text: str) -> np.ndarray:
    found = [C.span_hashes(data, starts, ends)
             for _, _, data, starts, ends, _ in C.word_blocks([text.lower().encode()], _REWRITE)]
    return found[0] if found else np.zeros(0, np.uint64)


def step_of(length: int) -> int:
    """Words between the passages for an item: the longest item of its class."""
    return max(_SHORTEST, 1 << max(length - 1, 0).bit_length())


def question_and_answer(text: str) -> tuple[str, str]:
    """The last line is the answer, else the last sentence; one sentence is all question."""
    text = text.strip()
    for cut in (r"(?s)(.*\S)\s*\n\s*(\S.*)", r"(?s)(.*[.?!])\s+(\S.*)"):
        if found := re.fullmatch(cut, text):
            return found[1], found[2]
    return text, ""


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different words of each item, and its length in the first of its rows."""
    for batch in batches:
        for text in batch.column(0).to_pylist():
            words = _hashes(text or "")
            different = np.unique(words)
            lengths = np.zeros(len(different), np.int64)
            lengths[:1] = len(words)
            yield pa.RecordBatch.from_arrays(
                [pa.array(different.view(np.int64)), pa.array(lengths)], names=["word", "length"])


class ItemIndex:
    """Inverted index of items of one class of length with block maxima."""

    def __init__(self, items: list[tuple], frequency: dict[int, int], n_items: int,
                 mean_length: float, threshold: float, overlap: float):
        self.threshold, self.overlap = threshold, overlap
        self.ids, self.words, self.split = [], [], []
        for item_id, text in items:
            question, answer = question_and_answer(text or "")
            parts = _hashes(question), _hashes(answer)
            if sum(map(len, parts)):
                self.ids.append(item_id)
                self.words.append(np.concatenate(parts))
                self.split.append(len(parts[0]))
        self.step = step_of(max([0, *map(len, self.words)]))
        rows = []
        for i, words in enumerate(self.words):
            different, tf = np.unique(words, return_counts=True)
            df = np.array([frequency[w] for w in different.tolist()], float)
            idf = np.log(1 + (n_items - df + 0.5) / (df + 0.5))
            weight = idf * tf * (K1 + 1) / (
                tf + K1 * (1 - B + B * len(words) / max(mean_length, 1e-9)))
            weight /= weight.sum()
            # The rest: the most common words, up to half the threshold together.
            order = np.argsort(idf, kind="stable")
            rare = np.ones(len(different), bool)
            rare[order[np.cumsum(weight[order]) <= threshold / 2]] = False
            rows.append((np.full(len(different), i), different, weight, rare))
        item, word, weight, rare = (
            np.concatenate([r[k] for r in rows]) if rows else np.zeros(0) for k in range(4))
        item, rare = item.astype(np.int64), rare.astype(bool)
        terms, term = np.unique(word.astype(np.uint64), return_inverse=True)
        self.terms = C.HashIndex(terms)
        # All postings by term, then item.
        order = np.lexsort((item, term))
        self.item, self.weight = item[order], weight[order]
        self.begin = np.searchsorted(term[order], np.arange(len(terms) + 1))
        # Block maxima of the rare postings by term, then block.
        n_blocks = len(self.ids) // BLOCK_ITEMS + 1
        key = term[rare].astype(np.int64) * n_blocks + item[rare] // BLOCK_ITEMS
        pairs, at = np.unique(key, return_inverse=True)
        self.block_max = np.zeros(len(pairs))
        np.maximum.at(self.block_max, at, weight[rare])
        self.block = pairs % n_blocks
        self.block_begin = np.searchsorted(pairs // n_blocks, np.arange(len(terms) + 1))
        self.is_rare = np.diff(self.block_begin) > 0
        rest = np.bincount(item[~rare], weight[~rare], minlength=len(self.ids))
        self.block_rest = np.zeros(n_blocks)
        np.maximum.at(self.block_rest, np.arange(len(self.ids)) // BLOCK_ITEMS, rest)

    @staticmethod
    def _lists(begin: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the postings of the terms, and of which term each is."""
        n = begin[terms + 1] - begin[terms]
        of = np.repeat(np.arange(len(terms)), n)
        return begin[terms][of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n), of

    def search(self, passage: np.ndarray, term: np.ndarray):
        """(passage, item, score) at or above the threshold. Pairs are different and sorted."""
        n_items, n_blocks = max(len(self.ids), 1), len(self.block_rest)
        rare = self.is_rare[term]
        at, of = self._lists(self.block_begin, term[rare])
        key = passage[rare][of] * n_blocks + self.block[at]
        pairs, place = np.unique(key, return_inverse=True)
        bound = np.bincount(place, self.block_max[at], minlength=len(pairs))
        opened = pairs[bound + self.block_rest[pairs % n_blocks] >= self.threshold - 1e-9]
        some = np.isin(passage, opened // n_blocks)
        passage, term = passage[some], term[some]
        at, of = self._lists(self.begin, term)
        key = passage[of] * n_blocks + self.item[at] // BLOCK_ITEMS
        inside = np.isin(key, opened)
        key = passage[of][inside] * n_items + self.item[at][inside]
        pairs, place = np.unique(key, return_inverse=True)
        score = np.bincount(place, self.weight[at][inside], minlength=len(pairs))
        good = score >= self.threshold - 1e-9
        return pairs[good] // n_items, pairs[good] % n_items, score[good]

    def overlaps(self, item: int, passage: np.ndarray) -> tuple[float, float]:
        """Shares of the words of question and answer in runs that the passage has too."""
        words, split = self.words[item], self.split[item]
        out = []
        for part in (words[:split], words[split:]):
            if not len(part):
                out.append(1.0)
                continue
            run = min(RUN, len(part), max(len(passage), 1))
            mine, theirs = (C.span_hashes(x, np.arange(len(x) - run + 1),
                                          np.arange(run, len(x) + 1)) if len(x) >= run
                            else np.zeros(0, np.uint64) for x in (part, passage))
            hit = np.flatnonzero(np.isin(mine, theirs))
            covered = np.zeros(len(part) + 1, int)
            np.add.at(covered, hit, 1)
            np.add.at(covered, hit + run, -1)
            out.append(float((np.cumsum(covered)[:-1] > 0).mean()))
        return out[0], out[1]

    def best_overlap(self, item: int, passage: np.ndarray) -> tuple[float, float]:
        """The overlaps with a span of twice the item's words: any stretch as long as the item
        lies in one of those that are tried."""
        n = max(len(self.words[item]), RUN)
        begins = range(0, max(len(passage) - n, 1), n)
        return max((self.overlaps(item, passage[b:b + 2 * n]) for b in begins), key=min)

    def find_in(self, words: np.ndarray, owner: np.ndarray, counts: np.ndarray):
        """(text, item, score, overlaps, first word) of the verified passages of a block of
        texts, whose words are given with the text of each and their number in each."""
        step = self.step
        first_word = np.cumsum(counts) - counts
        n_passages = np.maximum(-(-counts // step) - 1, 1)
        first_passage = np.cumsum(n_passages) - n_passages
        term = self.terms.find(words)
        known = np.flatnonzero(term >= 0)
        # Each word lies in the passage that begins in its stride and in the one before.
        stride = (known - first_word[owner[known]]) // step
        where, what = [], []
        for back in (0, 1):
            ok = (stride >= back) & (stride - back < n_passages[owner[known]])
            where.append(first_passage[owner[known]][ok] + stride[ok] - back)
            what.append(term[known][ok])
        n_terms = len(self.terms.keys)
        pairs = np.unique(np.concatenate(where) * n_terms + np.concatenate(what))
        found = self.search(pairs // n_terms, pairs % n_terms)
        for passage, item, score in zip(*(x.tolist() for x in found), strict=True):
            text = int(np.searchsorted(first_passage, passage, side="right")) - 1
            begin = (passage - first_passage[text]) * step
            end = min(begin + 2 * step, counts[text])
            span = words[first_word[text] + begin:first_word[text] + end]
            asked, answered = self.best_overlap(item, span)
            if min(asked, answered) >= self.overlap - 1e-9:
                yield text, item, score, asked, answered, int(begin)


class ItemGroup:
    """The indexes of a group of items, one for each class of length."""

    def __init__(self, items: list[tuple], *options):
        classes: dict[int, list[tuple]] = {}
        for item in items:
            n = len(_hashes(item[1] or ""))
            if n:
                classes.setdefault(step_of(n), []).append(item)
        self.indexes = [ItemIndex(classes[step], *options) for step in sorted(classes)]
        self.ids = [i for index in self.indexes for i in index.ids]

    def find(self, texts: list[bytes]) -> dict[tuple[int, int], tuple]:
        """Best verified passage of each (text, place in ``ids``): score, overlaps, first word."""
        best: dict[tuple[int, int], tuple] = {}
        for lo, hi, data, starts, ends, owner in C.word_blocks(texts, _REWRITE):
            if not len(starts):
                continue
            words, counts = C.span_hashes(data, starts, ends), C.per_text(owner, hi - lo)
            before = 0
            for index in self.indexes:
                for text, item, *found in index.find_in(words, owner, counts):
                    key = lo + text, before + item
                    if key not in best or found[0] > best[key][0] + 1e-12:
                        best[key] = tuple(found)
                before += len(index.ids)
        return best


def _indexes(items: DataFrame, threshold: float, overlap: float) -> Iterator:
    """Broadcast indexes of the groups of items."""
    spark = C.small_batches(items).sparkSession
    words = C.written(items.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        _item_words, "word long, length long").groupBy("word").agg(
        F.count("*").alias("df"), F.sum("length").alias("length")), "item_words")
    size = items.agg(F.count_if(F.col("text").rlike(r"[\p{L}\p{N}]")).alias("n"),
                     F.sum(F.octet_length("text")).alias("bytes")).first()
    n_items, groups = size["n"], -(-(size["bytes"] or 0) // ITEM_BYTES)
    length = words.agg(F.sum("length").alias("s")).first()["s"] or 0
    for g in range(groups):
        group = items.filter(F.pmod(F.xxhash64("text"), F.lit(groups)) == g)
        rows = [tuple(r) for r in group.select("item_id", "text").collect()]
        mine = group.select("text").mapInArrow(_item_words, "word long, length long").select(
            "word").distinct()
        frequency = {r["word"] & (1 << 64) - 1: r["df"]
                     for r in words.join(mine, "word", "left_semi").collect()}
        rows.sort(key=lambda r: (r[0] is None, r))
        yield spark.sparkContext.broadcast(ItemGroup(
            rows, frequency, n_items, length / max(n_items, 1), threshold, overlap))


def _matcher(index, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = index.value.find(_lower(batch.column(1)))
            text = pa.array([k[0] for k in found], pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(text), pa.array([index.value.ids[k[1]] for k in found],
                                                     schema.field("item_id").type),
                *(pa.array([v[i] for v in found.values()], t) for i, t in enumerate(
                    (pa.float64(), pa.float64(), pa.float64(), pa.int64())))],
                names=schema.names)
    return run


def matches(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
            overlap: float = OVERLAP) -> DataFrame:
    """``doc_id``, ``item_id``, ``score``, ``question_overlap``, ``answer_overlap`` and
    ``first_word`` of the best passage, for every document and item that match."""
    from pyspark.sql.pandas.types import to_arrow_schema
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("item_id", items.schema["item_id"].dataType),
        *(T.StructField(n, T.DoubleType())
          for n in ("score", "question_overlap", "answer_overlap")),
        T.StructField("first_word", T.LongType())])
    out = docs.sparkSession.createDataFrame([], schema)
    for index in _indexes(items, threshold, overlap):
        out = out.union(docs.select("doc_id", "text").mapInArrow(
            _matcher(index, to_arrow_schema(schema)), schema))
    return out


def _remover(index, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = {text for text, _ in index.value.find(_lower(batch.column(at)))}
            yield batch.filter(pa.array([i not in hit for i in range(batch.num_rows)], pa.bool_()))
    return run


def remove(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
           overlap: float = OVERLAP) -> DataFrame:
    """The columns and rows of ``docs`` without the rows that match an item."""
    for index in _indexes(items, threshold, overlap):
        docs = docs.mapInArrow(_remover(index, docs.columns.index("text")), docs.schema)
    return docs

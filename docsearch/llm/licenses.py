"""License scans: winnowed fingerprints of templates pick candidates, alignment reports spans.

Words (letters and digits, A-Z in lower case) of every template are hashed in runs of
``GRAM``; of each ``WINNOW`` runs in a row the least hash is kept with its place, so a copy of
``GRAM + WINNOW - 1`` words or more shares a kept one. The kept hashes form an inverted index that
is broadcast: templates are a parameter, of at most ``MAX_TEMPLATE_WORDS`` words. A text looks up
its own runs, and hits on close diagonals of one template make a candidate. There a banded
alignment (insertions, deletions and replacements within ``BAND`` words of the diagonal,
a quarter of the template at most)
reports how many words of the template are covered, and the span of words of the text.

A match is reported if at least ``coverage`` of the template is covered. Of matches of
different templates that overlap in a text, the one that covers most words stays, then the
better coverage, then the first name. A short template also matches as a whole
where it has fewer words than a run.

Defined results: null and empty texts have no matches. A template found twice gives two
rows. Repeated rows are scanned each. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from docsearch.llm import common as C

GRAM = 3
WINNOW = 3
BAND = 6
COVERAGE = 0.8
MAX_TEMPLATE_WORDS = 1_000_000

# Wording of public license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"),
    "MIT": "Released under the MIT License.",
    "MIT notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction"),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation"),
    "BSD notice": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "All rights reserved": "All rights reserved.",
}

_REWRITE = np.array([b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32
                     for b in range(256)], np.uint8)


def _words(text: str) -> np.ndarray:
    found = [C.span_hashes(data, starts, ends)
             for _, _, data, starts, ends, _ in C.word_blocks([text.encode()], _REWRITE)]
    return found[0] if found else np.zeros(0, np.uint64)


def _runs(words: np.ndarray, n: int) -> np.ndarray:
    at = np.arange(max(len(words) - n + 1, 0))
    return C.span_hashes(words, at, at + n)


def winnow(hashes: np.ndarray, width: int = WINNOW) -> np.ndarray:
    """Places of the least hash of every ``width`` in a row, the last of equal ones."""
    if len(hashes) <= width:
        return np.array([len(hashes) - 1 - int(np.argmin(hashes[::-1]))]) if len(hashes) else \
            np.zeros(0, np.int64)
    rows = np.lib.stride_tricks.sliding_window_view(hashes, width)[:, ::-1]
    return np.unique(np.arange(len(rows)) + width - 1 - rows.argmin(1))


class TemplateIndex:
    """Inverted index of the winnowed runs of templates."""

    def __init__(self, templates: dict[str, str], band: int = BAND, coverage: float = COVERAGE):
        self.band, self.coverage = band, coverage
        self.names = sorted(templates)
        self.words = [_words(templates[n]) for n in self.names]
        if sum(map(len, self.words)) > MAX_TEMPLATE_WORDS:
            raise ValueError("too many words of templates")
        postings: dict[int, list[tuple[int, int]]] = {}
        for t, words in enumerate(self.words):
            size = min(GRAM, len(words))
            runs = _runs(words, size) if size else np.zeros(0, np.uint64)
            for at in winnow(runs).tolist():
                postings.setdefault(int(runs[at]), []).append((t, at))
        self.postings = postings
        self.sizes = sorted({min(GRAM, len(w)) for w in self.words if len(w)})
        self.keys = C.HashIndex(np.array(sorted(postings), np.uint64))

    def _band(self, template: int) -> int:
        """Short templates have a narrower band, so that neighbours stay apart."""
        return min(self.band, len(self.words[template]) // 4)

    def align(self, template: int, words: np.ndarray, diagonal: int) -> tuple | None:
        """Longest common subsequence within the band: covered words, first and last word."""
        mine = self.words[template]
        band = self._band(template)
        begin, width = diagonal - band, 2 * band + 1
        # State: covered words, then the later start; end of the last covered word.
        row = [(0, 0, 0)] * width
        best = (0, 0, 0)
        for i, word in enumerate(mine.tolist()):
            new = []
            for k in range(width):
                at = begin + i + k
                value = max(row[k + 1] if k + 1 < width else (0, 0, 0),
                            new[k - 1] if k else (0, 0, 0), row[k])
                if 0 <= at < len(words) and int(words[at]) == word:
                    n, start, _ = row[k]
                    value = max(value, (n + 1, start if n else -at, -at - 1))
                new.append(value)
            row = new
            best = max(best, *row)
        if not best[0]:
            return None
        return best[0], -best[1], -best[2]

    def scan(self, words: np.ndarray) -> list[tuple]:
        """Matches (name, covered, coverage, first word, end) in one text."""
        hits: dict[int, set[int]] = {}
        for size in self.sizes:
            runs = _runs(words, size)
            found = self.keys.find(runs)
            for at in np.flatnonzero(found >= 0).tolist():
                for t, place in self.postings[int(runs[at])]:
                    if size == min(GRAM, len(self.words[t])):
                        hits.setdefault(t, set()).add(at - place)
        matches = []
        for t, diagonals in hits.items():
            last = None
            for diagonal in sorted(diagonals):
                if last is not None and diagonal - last <= self._band(t):
                    continue
                last = diagonal
                got = self.align(t, words, diagonal)
                if got and got[0] >= self.coverage * len(self.words[t]) - 1e-9:
                    matches.append((got[0], got[0] / len(self.words[t]), self.names[t],
                                    got[1], got[2]))
        matches.sort(key=lambda m: (-m[0], -m[1], m[2], m[3]))
        # What is kept does not overlap, so only the neighbours by first word can be in the way.
        begins: list[int] = []
        kept: list[tuple] = []
        for match in matches:
            at = bisect.bisect_right(begins, match[3])
            if (at and kept[at - 1][4] > match[3]) or (at < len(kept) and kept[at][3] < match[4]):
                continue
            begins.insert(at, match[3])
            kept.insert(at, match)
        return kept


def _scanner(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = C.binary_values(batch.column(1))
            out, rows = [], []
            for lo, hi, data, starts, ends, owner in C.word_blocks(texts, _REWRITE):
                words = C.span_hashes(data, starts, ends)
                # Texts with a hit of the index; the others are not looked at again.
                some = np.zeros(len(words), bool)
                for size in index.value.sizes:
                    some[:max(len(words) - size + 1, 0)] |= index.value.keys.find(
                        _runs(words, size)) >= 0
                counts = C.per_text(owner, hi - lo)
                first = np.cumsum(counts) - counts
                for i in np.unique(owner[some]).tolist():
                    for found in index.value.scan(words[first[i]:first[i] + counts[i]]):
                        out.append(found)
                        rows.append(lo + i)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(rows, pa.int64())),
                pa.array([m[2] for m in out], pa.string()),
                *(pa.array([m[k] for m in out], t) for k, t in (
                    (0, pa.int64()), (1, pa.float64()), (3, pa.int64()), (4, pa.int64())))],
                names=["doc_id", "license", "covered", "coverage", "first_word", "end_word"])
    return run


def scan(docs: DataFrame, templates: dict[str, str] | None = None, band: int = BAND,
         coverage: float = COVERAGE) -> DataFrame:
    """``doc_id``, ``license``, ``covered`` words, ``coverage``, ``first_word``, ``end_word``."""
    index = docs.sparkSession.sparkContext.broadcast(
        TemplateIndex(TEMPLATES if templates is None else templates, band, coverage))
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("license", T.StringType()),
        T.StructField("covered", T.LongType()), T.StructField("coverage", T.DoubleType()),
        T.StructField("first_word", T.LongType()), T.StructField("end_word", T.LongType())])
    return C.small_batches(docs).select("doc_id", C.text_bytes().alias("text")).mapInArrow(_scanner(index), schema)

"""Columns with the operators' own names, independence from unrelated items, class sizes."""

import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from docsearch.llm import (
    common,
    decontamination,
    fingerprint,
    licenses,
    mixing,
    simhash_dedup,
    substring_dedup,
    toxicity,
)

NAMES = ("__row", "__copy", "__score", "__bytes", "copies", "chunk", "Kept", "N_Words", "row",
         "caller", "doc", "label", "size")


@pytest.fixture(scope="module")
def clashing(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").filter("doc_id < 60")
    return docs.select("*", *[F.concat(F.lit("own "), F.col("doc_id")).alias(n) for n in NAMES])


def unchanged(rows):
    return all(r[n] == f"own {r['doc_id']}" for r in rows for n in NAMES)


def test_columns_named_like_the_operators_own(spark, sf_dir, clashing):
    labels = common.table(spark, sf_dir, "labels")
    classifier = toxicity.fit(clashing, labels)
    rows = toxicity.reject(clashing, classifier, 1.1).collect()
    assert len(rows) == clashing.count() and unchanged(rows)
    assert set(toxicity.score(clashing, classifier).columns) == {
        *clashing.columns, "__score", "__log_ratio", "__n_words"}
    for result in (mixing.mix(clashing), simhash_dedup.keep_one(clashing),
                   substring_dedup.strip(clashing)):
        assert result.columns == clashing.columns
        rows = result.collect()
        assert rows and unchanged(rows)
    cut = substring_dedup.cut(clashing)
    assert sorted(c.lower() for c in cut.columns) == sorted(
        {c.lower() for c in clashing.columns} - {"text"} | {"n_words", "n_removed", "kept"})
    assert all(r["chunk"] == f"own {r['doc_id']}" for r in cut.collect())


def test_other_items_do_not_change_a_match(spark):
    question = [f"q{i}" for i in range(24)]
    far = " ".join(" ".join(question[i:i + 3]) + " " + " ".join(f"x{i}y{j}" for j in range(60))
                   for i in range(0, 24, 3))
    near = "a b c " + " ".join(question) + " d e f"
    docs = spark.createDataFrame([(1, far), (2, near)], "doc_id long, text string")
    items = [(1, " ".join(question))]
    for n in (0, 5, 40, 300, 1500, 6000):
        more = [(2, " ".join(f"z{i}" for i in range(n)))] if n else []
        table = spark.createDataFrame(items + more, "item_id long, text string")
        rows = decontamination.matches(docs, table).collect()
        assert [(r["doc_id"], r["item_id"]) for r in rows] == [(2, 1)]
        assert rows[0]["score"] == pytest.approx(1) and rows[0]["question_overlap"] == 1


def test_long_items_of_any_class_are_found(spark):
    items = [(n, " ".join(f"w{n}v{i}" for i in range(n))) for n in (1, 15, 16, 17, 33, 64, 65, 700)]
    docs = [(n, "before " * 11 + text + " after" * 7) for n, text in items]
    rows = decontamination.matches(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in rows) == [(n, n) for n, _ in items]


class PlainKneserNey:
    """Discounted counts of windows with back-off, by dictionaries."""

    def __init__(self, counts, rate):
        order = toxicity.ORDER
        self.count = {order: {w: x * rate for w, x in counts.items()}}
        absent = {w: (1 - rate) ** x if x else 1.0 for w, x in counts.items()}
        for k in range(order - 1, -1, -1):
            now, below = {}, {}
            for w, q in absent.items():
                key = w[1:]
                now[key] = now.get(key, 0) + (self.count[k + 1][w] if w[0] == 0 else 1 - q)
                below[key] = below.get(key, 1.0) * q
            self.count[k], absent = now, below


def plain_probability(models, c, window):
    """Probability of the last byte of a window after the others, for class ``c``."""
    k = len(window) - 1
    if k < 0:
        return 1 / 256
    shared = models if k <= toxicity.SHARED_ORDER else (models[c],)

    def n(w):
        return sum(m.count[k].get(w, 0) for m in shared)

    after = [n((*window[:-1], b)) for b in range(256)]
    total, held = sum(after), [max(x - toxicity.DISCOUNT, 0) for x in after]
    lower = plain_probability(models, c, window[1:])
    if not total:
        return lower
    return held[window[-1]] / total + (1 - sum(held) / total) * lower


@pytest.mark.parametrize("rates", [(1.0, 1.0), (1.0, 0.25)])
def test_kneser_ney_equals_a_plain_version_that_sums_to_one(rates):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abc"), rng.integers(1, 8))) for _ in range(60)]
    windows = {}
    for word in words:
        spelled = [0] * toxicity.ORDER + [32, *word.encode(), 32]
        for i in range(toxicity.ORDER + 1, len(spelled)):
            w = tuple(spelled[i - toxicity.ORDER:i + 1])
            have = windows.setdefault(w, [0, 0])
            have[int(rng.integers(2))] += int(rng.integers(1, 9))
    packed = np.array([sum(b << 8 * i for i, b in enumerate(reversed(w))) for w in windows],
                      np.uint64)
    by = np.argsort(packed)
    counts = [np.array([v[c] for v in windows.values()], float)[by] for c in (0, 1)]
    model = toxicity.Model(packed[by], counts, rates)
    plain = [PlainKneserNey({w: v[c] for w, v in windows.items()}, rates[c]) for c in (0, 1)]
    for w in list(windows)[:12]:
        for c in (0, 1):
            every = [plain_probability(plain, c, (*w[:-1], b)) for b in range(256)]
            assert sum(every) == pytest.approx(1)
            assert min(every) > 0
    unseen = [(*w[:-1], b) for w in list(windows)[:10] for b in (97, 100)]
    for w in [*list(windows)[:40], *unseen]:
        key = np.array([sum(b << 8 * i for i, b in enumerate(reversed(w)))], np.uint64)
        p = [plain_probability(plain, c, w) for c in (0, 1)]
        assert model.log_ratio(key)[0] == pytest.approx(math.log(p[0] / p[1]), abs=1e-6)


def test_many_license_matches_take_no_quadratic_sweep():
    name, text = next((n, t) for n, t in licenses.TEMPLATES.items() if "notice" not in n)
    index = licenses.TemplateIndex({name: text})
    words, filler = licenses._words(text), np.arange(1, 12, dtype=np.uint64)
    many = np.concatenate([x for _ in range(4_000) for x in (words, filler)])
    began = time.time()
    found = index.scan(many)
    assert len(found) == 4_000 and time.time() - began < 30
    assert [m[3] for m in found] == [i * (len(words) + 11) for i in range(4_000)]


# --- 9: ranges of ids ------------------------------------------------------------------------------------------


def by_next(spark, docs):
    return {r["doc_id"]: tuple(r) for r in fingerprint.edited(docs).collect()}


def test_fingerprints_take_text_ids_and_any_number_of_partitions(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    few = by_next(spark, docs)
    padded = docs.withColumn("doc_id", F.lpad(F.col("doc_id").cast("string"), 9, "0"))
    assert {int(k): v[1:] for k, v in by_next(spark, padded).items()} == {
        k: v[1:] for k, v in few.items()}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "150")
        assert by_next(spark, docs) == few
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def plain_votes(text):
    """Signed votes of words, pairs of words (double) and, in short texts, runs of four bytes."""
    words = [w.lower() for w in text.encode().split()]

    def hashed(w):
        data = np.frombuffer(w, np.uint8)
        return int(common.span_hashes(data, np.array([0]), np.array([len(w)]))[0])

    def mixed(x):
        return int(common.mix(np.array([x % 2**64], np.uint64))[0])

    step = 0x9E3779B97F4A7C15
    terms = [(hashed(w), 1) for w in words]
    terms += [(mixed(hashed(a) * step + hashed(b)), fingerprint.PAIR_WEIGHT)
              for a, b in zip(words, words[1:])]
    if len(words) < fingerprint.FEW_WORDS:
        terms += [(hashed(w[i:i + 4]), 1) for w in words for i in range(len(w))]
    out = bytearray()
    for lane in range(fingerprint.LANES):
        lanes = [(mixed(h + (lane + 1) * step), w) for h, w in terms]
        for byte in range(8):
            value = 0
            for bit in range(7, -1, -1):
                at = byte * 8 + bit
                value = value * 2 + (sum(w if h >> at & 1 else -w for h, w in lanes) > 0)
            out.append(value)
    return bytes(out).hex()


def test_fingerprint_equals_plain_votes(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").filter("doc_id < 40")
    extra = spark.createDataFrame([(900, "One two"), (901, "Tie"), (902, "")], "doc_id long, text string")
    rows = docs.select("doc_id", "text").union(extra)
    texts = {r["doc_id"]: r["text"] or "" for r in rows.collect()}
    got = {r["doc_id"]: r["fingerprint"] for r in fingerprint.fingerprints(rows).collect()}
    assert got == {i: plain_votes(t) for i, t in texts.items()}

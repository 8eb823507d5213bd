"""Whitening, periodic runs and the rule ensemble against plain versions, and on odd rows."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from docsearch.llm import common, periodic_runs, queries, rule_ensemble, whitening

CLASH = ", row string, part string, words string, runs string, score string, x string, id string"


# --- 11: whitening ---------------------------------------------------------------------


def test_whitening_equals_a_dense_computation(spark, sf_dir):
    rows = queries.QUERIES["op11_block_whitening"](spark, sf_dir).toPandas()
    held = common.table(spark, sf_dir, "embeddings").toPandas().sort_values("vec_id")
    x = np.floor(np.array(held.embedding.tolist()).astype(float) * 64).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    rows = rows.sort_values(["vec_id", "component"])
    assert len(rows) == n * 32 and (rows.n == n).all()
    assert (rows.deviation.to_numpy().reshape(n, 32)[:, 0] ==
            np.square(n * x - sums).sum(axis=1)).all()
    want = centred @ vectors[:, :32] / np.sqrt(values[:32])
    got = rows.whitened.to_numpy().reshape(n, 32)
    assert np.abs(got * np.sign((got * want).sum(axis=0)) - want).max() < 1e-8
    assert rows.explained.to_numpy().reshape(n, 32)[0] == pytest.approx(values[:32] / values.sum())
    assert rows.identity_error.nunique() == 1 and rows.identity_error.iloc[0] < 1e-9


def test_whitening_does_not_depend_on_blocks(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [int(v) for v in rng.integers(-50, 50, 5)]) for i in range(300)]
    vectors = spark.createDataFrame(rows, "id long, x array<long>").repartition(7)
    runs = [whitening.whiten(vectors, block_rows=b, task_bytes=t).orderBy("id").collect()
            for b, t in ((1000, 1 << 20), (7, 400), (1, 40))]
    first = np.array([r["whitened"] for r in runs[0]])
    for other in runs[1:]:
        values = np.array([r["whitened"] for r in other])
        assert np.abs(np.abs(values) - np.abs(first)).max() < 1e-9
        assert [r["deviation"] for r in other] == [r["deviation"] for r in runs[0]]


def test_whitening_of_wide_numbers_is_exact(spark):
    rows = [(str(i), [10 ** 9 * (i % 3), -i, 7]) for i in range(50)]
    found = whitening.whiten(spark.createDataFrame(rows, "id string, x array<long>")).collect()
    sums = [sum(r[1][d] for r in rows) for d in range(3)]
    for r in found:
        x = rows[int(r["id"])][1]
        assert int(r["deviation"]) == sum((50 * v - s) ** 2 for v, s in zip(x, sums))
        # The third component has no variance.
        assert r["whitened"][2] == 0 and r["explained"][2] == 0
        assert r["identity_error"] < 1e-9


def test_whitening_of_odd_rows(spark):
    rows = [(1, [0.5, -1.0]), (None, [0.25, 2.0]), (1, [0.5, -1.0]), (3, None), (4, [None, 1.0]),
            (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, []), (8, [1.0]), (9, [3.0, 0.0])]
    table = spark.createDataFrame(
        [(*r, *["y"] * 5) for r in rows],
        "vec_id long, embedding array<float>, part string, number string, ids string, n string, "
        "matrix string")
    fixed = table.withColumn("x", whitening.fixed_point(F.col("embedding"), 64, 10))
    found = whitening.whiten(fixed, id_column="vec_id").collect()
    assert sorted(str(r["id"]) for r in found) == ["1", "1", "9", "None"]
    assert {r["n"] for r in found} == {4}
    assert len({tuple(r["whitened"]) for r in found if r["id"] == 1}) == 1
    assert whitening.whiten(fixed.limit(0), id_column="vec_id").count() == 0
    one = whitening.whiten(fixed.filter("vec_id = 9"), id_column="vec_id").first()
    assert one["whitened"] == [0.0, 0.0] and one["deviation"] == 0 and one["identity_error"] == 0


# --- 12: periodic runs -------------------------------------------------------------------


def plain_runs(words, min_length=6, min_exponent=4):
    """Runs by trying every period at every place."""
    n, found = len(words), {}
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            begin = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - begin >= max(min_length, min_exponent * q):
                found.setdefault((begin, i + q), q)
    return sorted(((b, e - b, q) for (b, e), q in found.items()), key=lambda r: (r[0], r[2]))


def _texts_with_runs(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        kinds = rng.randint(1, 4)
        unit = [rng.randrange(kinds) for _ in range(rng.randint(1, 6))]
        noise = [rng.randrange(kinds) for _ in range(rng.randint(0, 12))]
        yield noise + (unit * 20)[:rng.randint(0, 60)] + noise[::-1] + (unit * 9)[:rng.randint(0, 30)]


@pytest.mark.parametrize("bounds", [(6, 4), (2, 2), (5, 3)])
def test_runs_equal_trying_every_period(bounds):
    texts = list(_texts_with_runs(bounds[0], 400))
    codes, want = [], []
    for t, words in enumerate(texts):
        want += [(b + len(codes), n, q) for b, n, q in plain_runs(words, *bounds)]
        codes += [w + 10 * t for w in words] + [9 + 10 * t]
    got = periodic_runs.runs_of(np.array(codes), *bounds)
    assert list(zip(*(x.tolist() for x in got))) == sorted(want, key=lambda r: (r[0], r[2]))


def test_suffix_array_is_sorted_with_common_prefixes():
    codes = np.array([2, 1, 2, 1, 2, 3, 1, 2, 9])
    array = periodic_runs.SuffixArray(codes)
    suffixes = [codes[i:].tolist() for i in array.order]
    assert sorted(range(9), key=lambda i: array.inverse[i]) == array.order.tolist()
    for before, after, common_prefix in zip(suffixes, suffixes[1:], array.lcp[1:]):
        same = 0
        while before[same:same + 1] == after[same:same + 1]:
            same += 1
        assert same == common_prefix


def test_run_query_equals_a_plain_version(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in common.table(spark, sf_dir, "documents").collect()}
    rows = {r["doc_id"]: r for r in queries.QUERIES["op12_periodic_runs"](spark, sf_dir).collect()}
    assert rows.keys() == texts.keys()
    for doc_id, text in texts.items():
        words = (text or "").encode().split()
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if n > 1500:
            continue
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs, gone = plain_runs(words), set()
        for b, length, q in runs:
            gone.update(range(b + q, b + length))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        lines = "".join(f"{b},{length},{q}\n" for b, length, q in runs)
        row = rows[doc_id]
        assert row["n_runs"] == len(runs)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(kept).hexdigest()
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        shown = (row["start"], row["length"], row["period"], row["exponent_milli"])
        assert shown == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)


def test_runs_of_odd_rows(spark):
    long_text = " ".join(f"w{i % 977}" for i in range(40_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "a " * 6), (4, "a " * 6), (None, "a b" * 3),
            (5, "É é " * 9), (6, long_text), (7, "x\x0bx\x0cx\rx\nx\tx x x")]
    table = spark.createDataFrame([(*r, *["z"] * 7) for r in rows],
                                  "doc_id long, text string" + CLASH)
    found = periodic_runs.find(table, ("doc_id", "row"))
    assert found.columns == ["doc_id", "row", "n_words", "runs", "collapsed"]
    by_id = {}
    for r in found.collect():
        by_id.setdefault(r["doc_id"], []).append(
            (r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]))
    assert by_id[1] == by_id[2] == by_id[3] == [(0, [], "")]
    assert by_id[4] == [(6, [(0, 6, 1)], "a")] * 2
    assert by_id[5] == [(18, [(0, 18, 2)], "É é")]
    assert by_id[6][0][1] == [(0, 40_000, 977)]
    assert by_id[7] == [(7, [], "x x x x x x x x")]
    assert periodic_runs.find(table.limit(0)).count() == 0
    best = found.filter("doc_id = 4").select(periodic_runs.longest_run().alias("b")).first()["b"]
    assert tuple(best) == (0, 6, 1)


# --- 13: rule ensemble ---------------------------------------------------------------------


def test_tree_paths_become_rules():
    tree = """DecisionTreeClassificationModel: depth=2
  If (feature 0 <= 10.5)
   If (feature 0 <= 2.5)
    Predict: 0.0
   Else (feature 0 > 2.5)
    Predict: 1.0
  Else (feature 0 > 10.5)
   If (feature 1 <= 7.0)
    Predict: 1.0
   Else (feature 1 > 7.0)
    Predict: 0.0
"""
    low, high = float("-inf"), float("inf")
    assert rule_ensemble.tree_rules(tree, ("a", "b")) == [
        (("a", low, 10.5),), (("a", low, 2.5),), (("a", 2.5, 10.5),), (("a", 10.5, high),),
        (("a", 10.5, high), ("b", low, 7.0)), (("a", 10.5, high), ("b", 7.0, high))]


def test_compiled_score_equals_the_weighted_rules(spark):
    low, high = float("-inf"), float("inf")
    ensemble = rule_ensemble.Ensemble(
        0.5, [((("words", 2.0, high),), 1.5), ((("chars", low, 9.0), ("words", low, 3.0)), -2.0)],
        [("words", 0.0, 4.0, 0.25)])
    texts = ["a b c d e f", "a b c", "abcdefghijkl", "", None]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r["score"] for r in rule_ensemble.score(table, ensemble).collect()}
    for i, text in enumerate(texts):
        words, chars = len((text or "").split()), len(text or "")
        total = 0.5 + 1.5 * (words > 2) - 2.0 * (chars <= 9 and words <= 3) + 0.25 * min(words, 4)
        assert rows[i] == pytest.approx(1 / (1 + np.exp(-total)))


def test_statistics_of_a_text(spark):
    text = "The the the End. 12 of 34!\n\n| | Déjà vu?\nDéjà vu? VU"
    row = rule_ensemble.statistics(spark.createDataFrame([(text,)], "text string")).first()
    words = text.split()
    assert (row["chars"], row["words"], row["lines"]) == (len(text), len(words), 3)
    assert row["repeats"] == pytest.approx(2 / len(words))  # "the the" and "| |"
    assert row["sentence_ends"] == pytest.approx(4 / len(words))
    assert row["other"] == pytest.approx(2 / len(words))
    assert row["digits"] == pytest.approx(4 / len(text))
    assert row["word_kinds"] == pytest.approx(len(set(words)) / len(words))


def test_quality_is_learned_without_the_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op13_rule_quality"](spark, sf_dir).collect()
    labels = {r["doc_id"]: r["quality"] for r in common.table(spark, sf_dir, "labels").collect()}
    assert len(rows) == common.table(spark, sf_dir, "documents").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    good = [r["score"] for r in held if labels[r["doc_id"]] == 1]
    bad = [r["score"] for r in held if labels[r["doc_id"]] == 0]
    auc = np.mean([[(g > b) + (g == b) / 2 for g in good] for b in bad])
    assert auc > 0.95
    # Other labels of held-out rows change nothing.
    docs = common.table(spark, sf_dir, "documents")
    told = common.table(spark, sf_dir, "labels")
    apart = common.fold("doc_id", 3) == 1
    turned = told.withColumn("quality", F.when(apart, 1 - F.col("quality")).otherwise(F.col("quality")))
    fitted = [rule_ensemble.fit(docs, x, ~apart) for x in (told, turned)]
    assert fitted[0] == fitted[1]
    assert 0 < len(fitted[0].rules) < 400


def test_quality_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "good text here."), (3, "good text here."), (None, "x"),
            (4, "word " * 30_000)]
    table = spark.createDataFrame([(*r, *["z"] * 7) for r in rows],
                                  "doc_id long, text string" + CLASH)
    labels = spark.createDataFrame([(3, 1), (4, 0), (None, 0), (3, 7), (2, None)],
                                   "doc_id long, quality int")
    ensemble = rule_ensemble.fit(table, labels)
    scores = rule_ensemble.score(table, ensemble, ("doc_id", "row", "words")).collect()
    assert len(scores) == 6 and all(0 <= r["score"] <= 1 for r in scores)
    assert len({r["score"] for r in scores if r["doc_id"] in (1, 2)}) == 1
    everything = rule_ensemble.keep(table, ensemble, 0.0)
    assert everything.columns == table.columns
    assert sorted(map(str, everything.collect())) == sorted(map(str, table.collect()))
    only_good = rule_ensemble.fit(table, labels.filter("quality = 1"))
    assert all(r["score"] > 0.99 for r in rule_ensemble.score(table, only_good).collect())
    assert rule_ensemble.fit(table, labels.limit(0)) == rule_ensemble.Ensemble(0.0)
    assert rule_ensemble.score(table.limit(0), ensemble).count() == 0

"""Operators of the llm subpackage against plain versions, and on odd rows."""

import collections
import hashlib
import math
import random
import re
import zlib
from types import SimpleNamespace

import numpy as np
import pytest

from docsearch.llm import (
    common,
    components,
    decontamination,
    fingerprint,
    fm_index,
    language_id,
    licenses,
    mixing,
    ppm,
    ppm_tables,
    queries,
    simhash_dedup,
    substring_dedup,
    toxicity,
    url_filter,
)
from plain_versions import (
    normal,
    plain_components,
    plain_cut,
    plain_fingerprint,
    plain_languages,
    words_of,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use themselves.
CLASH = ", row string, chunk string, label string, size string, key string, n_words string"


def texts_of(spark, sf_dir):
    rows = common.table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] for r in rows}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, blanks, ties, repeated and very long rows, with columns of clashing names."""
    long_text = " ".join(f"w{i % 977} x{i % 31}" for i in range(60_000))
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", None, "a", 4),
        (4, "one two three four five", "en", None, 23), (4, "one two three four five", "en", None, 23),
        (None, "one two three four five", None, None, None), (None, None, None, None, None),
        (7, long_text, "de", "b", len(long_text)), (8, "Été ÉTÉ été 123", "fr", "b", 15),
        (9, "1 2 3 ...", "fr", "c", 9), (10, "word", "en", "c", 4), (11, "word", "en", "c", 4),
    ]
    return spark.createDataFrame([(*r, *["x"] * 6) for r in rows], DOCS + CLASH)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS + CLASH)


# --- helpers -------------------------------------------------------------------------


def test_span_hashes_know_equal_stretches():
    data = np.frombuffer(b"abc xyz abc", np.uint8)
    a, b, c = common.span_hashes(data, np.array([0, 4, 8]), np.array([3, 7, 11]))
    assert a == c != b


def test_hash_index_finds_only_what_is_there():
    keys = np.random.default_rng(1).integers(0, 1 << 60, 5000).astype(np.uint64)
    keys = np.unique(keys)
    index = common.HashIndex(keys[::2])
    assert (index.find(keys[::2]) == np.arange(len(keys[::2]))).all()
    assert (index.find(keys[1::2]) == -1).all()
    assert (common.HashIndex(keys[:0]).find(keys[:3]) == -1).all()


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(1, i) for i in range(2, 40)]
    found = components.connected_components(
        spark.createDataFrame(chain + star + [(7, 7)], "a long, b long")).collect()
    labels = {r["node"]: r["label"] for r in found}
    assert all(labels[i] == 100 for i in range(100, 161))
    assert all(labels[i] == 1 for i in range(1, 40))


# --- 1: PPM ------------------------------------------------------------------------------


def test_ppm_equals_a_plain_trie_and_base_equals_counts(spark, sf_dir):
    texts = texts_of(spark, sf_dir)
    rows = queries.QUERIES["op1_ppm_score"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    trie, counts = ppm.Trie(), collections.Counter()
    for doc_id, text in texts.items():
        if zlib.crc32(str(doc_id).encode()) % 7 != 2:
            trie.text((text or "").encode(), learn=True, measure=False)
            counts.update((text or "").encode().lower().split() + [b"\n"])
    total, kinds = sum(counts.values()), len(counts)
    for r in rows:
        words = (texts[r["doc_id"]] or "").encode().lower().split() + [b"\n"]
        base = sum(math.log10((counts.get(w, 0) + 1) / (total + kinds + 1)) for w in words)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)
        assert (r["n_tokens"], r["train_tokens"]) == (len(words), total)
        assert r["n_known"] == sum(w in counts for w in words)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
    for r in [r for r in rows if r["held_out"]][:6]:
        assert r["score"] == pytest.approx(
            trie.text((texts[r["doc_id"]] or "").encode(), learn=False), rel=1e-6)


def test_ppm_probabilities_sum_to_one():
    keys = np.unique(np.random.default_rng(2).integers(97, 101, (300, 6)) @
                     (1 << (8 * np.arange(6)[::-1]))).astype(np.uint64)
    counts = np.random.default_rng(3).integers(1, 9, len(keys)).astype(float)
    contexts = np.unique(keys >> np.uint64(8))[:20]
    full = ((contexts[:, None] << np.uint64(8)) | np.arange(256, dtype=np.uint64)).ravel()
    every = np.unique(np.concatenate((keys, full)))
    n = np.zeros(len(every))
    n[np.searchsorted(every, keys)] = counts
    roots = ppm._roots(*ppm_tables.sums_by(ppm_tables.tail(keys, 2), counts))
    p = 10 ** ppm_tables.code_lengths(every, n, 5, roots)
    assert p[np.searchsorted(every, full)].reshape(-1, 256).sum(1) == pytest.approx(1)


def test_ppm_many_chunks_and_salts_agree_with_few(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    few, many = ({r["doc_id"]: r["score"] for r in ppm.score(docs, **o).collect()}
                 for o in ({}, {"chunk_bytes": 20_000, "fan": 4}))
    assert few.keys() == many.keys()
    assert all(few[k] == pytest.approx(many[k]) for k in few)


def test_ppm_buckets_answer_each_salt_with_its_own_keys():
    lists = [(np.array([2, 5, 9], np.uint64), np.array([1.0, 0, 3])),
             (np.array([5, 7], np.uint64), np.array([4.0, 0]))]
    for bucket in (0, 3):
        table = ppm._packed([(bucket, salt, None, ppm.pack(keys), ppm.pack_counts(n))
                             for salt, (keys, n) in enumerate(lists)])
        roots = SimpleNamespace(value=ppm._roots(np.array([2, 5, 9], np.uint64), np.array([1.0, 4, 3])))
        rows = ppm._valuer(5, 3, roots)(table).to_pylist()
        assert [ppm.unpack(r["keys"]).tolist() for r in rows] == [[2, 5, 9], [5, 7]]
        if bucket == 3:
            assert [ppm.unpack_counts(r["values"], k).tolist() for r, k in zip(rows, (3, 2))] == [
                [1, 4, 3], [4, 0]]
        else:
            costs = [np.frombuffer(r["values"], np.float32) for r in rows]
            assert costs[0][1] == costs[1][0] and len(costs[1]) == 2
        assert [(r["total"], r["kinds"]) for r in rows] == [(8, 3) if bucket == 3 else (0, 0), (0, 0)]


def test_ppm_odd_rows(spark, odd, none):
    rows = ppm.score(odd).collect()
    assert len(rows) == odd.count()
    assert all(r["n_tokens"] == 1 for r in rows if r["doc_id"] in (1, 2, 3))
    assert ppm.score(none).collect() == []
    nothing = ppm.score(odd.filter("doc_id = 10"), common.F.lit(False)).first()
    assert nothing["score"] == pytest.approx(-5 * math.log10(256))
    adaptive = ppm.adaptive_score(odd.filter("doc_id <> 7")).collect()
    assert all(r["score"] < 0 for r in adaptive)


# --- 2: languages ------------------------------------------------------------------------


def test_languages_on_held_out_rows(spark, sf_dir):
    truth = {r["doc_id"]: r["lang"] for r in
             common.table(spark, sf_dir, "documents").select("doc_id", "lang").collect()}
    rows = queries.QUERIES["op2_ecoc_language_id"](spark, sf_dir).collect()
    held = [r for r in rows if r["held_out"]]
    assert sum(truth[r["doc_id"]] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_decoding_equals_a_plain_version():
    learn = [["the cat sat on the mat", "Where is it?"], ["der Hund und die Katze", "schön ist es"],
             ["le chat est sur la table", "où est-il"]]
    texts = ["the hat", "die Hand 12", "sur le mat", "es", "x", "", "cat und chat " * 30]
    size = len(language_id.SIZES) * language_id.BUCKETS
    counts = np.zeros((len(learn), size))
    for place, known in enumerate(learn):
        for _, _, codes, _ in language_id._ngrams([t.lower().encode() for t in known]):
            for c in codes:
                counts[place] += np.bincount(c, minlength=size)
    decoder = language_id.Decoder(["en", "de", "fr"], counts)
    best, share, _ = decoder.decode([t.lower().encode() for t in texts])
    plain = plain_languages(learn, texts, decoder.code.tolist(), language_id.BUCKETS,
                            language_id._EVIDENCE)
    assert [p[1] for p in plain] == pytest.approx(share.tolist(), rel=1e-4)
    assert all(b == p[0] or p[1] < 0.5 for b, p in zip(best.tolist(), plain, strict=True))


def test_language_odd_rows(odd, none):
    decoder = language_id.fit(odd)
    found = collections.Counter(
        (r["doc_id"], r["lang_pred"]) for r in language_id.predict(odd, decoder).collect())
    assert all(found[i, "und"] for i in (1, 2, 3, 9)) and found[4, "en"] == 2
    assert language_id.fit(none) is None
    assert language_id.predict(none, decoder).collect() == []
    assert {r["lang_pred"] for r in language_id.predict(odd, None).collect()} == {"und"}
    with pytest.raises(ValueError):
        language_id.fit(odd, max_languages=1)


def test_codewords_differ_and_ties_go_to_the_first_language():
    for n in (2, 3, 6, 7, 40):
        code = language_id.codewords(n)
        assert len({tuple(c) for c in code}) == n
    decoder = language_id.Decoder(["a", "b"], np.zeros((2, 2 * language_id.BUCKETS)))
    place, share, lead = decoder.decode([b"text"])
    assert (place[0], share[0], lead[0]) == (0, 0.5, 0.0)


# --- 3: SimHash near-dedup -------------------------------------------------------------------


def test_simhash_components_equal_all_pairs(spark, sf_dir):
    texts = texts_of(spark, sf_dir)
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    expected = plain_components(prints)
    for r in queries.QUERIES["op3_simhash_dedup"](spark, sf_dir).collect():
        assert int(r["fingerprint"], 16) == prints[r["doc_id"]]
        assert r["component_id"] == expected[r["doc_id"]]


def test_masks_cover_every_pair_within_the_radius():
    masks = [m & (1 << 64) - 1 for m in simhash_dedup.covering_masks(2)]
    for i in range(64):
        for j in range(i + 1):
            assert any(not m & ((1 << i) | (1 << j)) for m in masks)


def test_crowded_buckets_keep_all_links(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(63) for _ in range(3)]
    prints = {i: base[i % 3] ^ sum(1 << b for b in rng.sample(range(63), rng.randrange(5)))
              for i in range(300)}
    values = sorted(set(prints.values()))
    links = simhash_dedup.links(spark.createDataFrame([(v,) for v in values], "fingerprint long"))
    labels = {r["node"]: r["label"] for r in components.connected_components(links).collect()}
    expected = plain_components({v: v for v in values})
    assert all(labels.get(v, v) == expected[v] for v in values)
    with pytest.raises(ValueError):
        simhash_dedup.links(spark.createDataFrame([(1,)], "fingerprint long"), 3)


def test_simhash_odd_rows(odd, none):
    rows = simhash_dedup.components(odd).collect()
    assert len(rows) == odd.count()
    of = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert of[1]["fingerprint"] == of[2]["fingerprint"] == of[3]["fingerprint"] == 0
    assert of[3]["component_id"] == 1 and of[11]["component_id"] == 10
    assert all(r["component_id"] is not None for r in rows)
    kept = simhash_dedup.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 7, 8, 9, 10]
    assert simhash_dedup.components(none).collect() == simhash_dedup.keep_one(none).collect() == []


# --- 4: toxicity ----------------------------------------------------------------------------


def toxic_table(spark, n=400):
    rng = random.Random(3)
    common_words = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in "lmnrst"]
    bad = ["zzork", "zzorkly", "grukh", "grukhen", "plagg"]
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(common_words, k=rng.randrange(20, 200))
        toxic = int(i % 4 == 0)
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        docs.append((i, " ".join(words)))
        labels.append((i, toxic))
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels))


def test_toxicity_on_held_out_rows(spark):
    docs, labels, truth = toxic_table(spark)
    classifier = toxicity.fit(docs, labels, queries.learned(5, 0))
    rows = toxicity.score(docs, classifier).withColumn("held", ~queries.learned(5, 0)).collect()
    held = [r for r in rows if r["held"]]
    assert len(held) > 50
    right = sum((r["__score"] >= 0.5) == bool(truth[r["doc_id"]]) for r in held)
    assert right >= 0.95 * len(held)
    kept = toxicity.reject(docs, classifier)
    assert kept.columns == docs.columns and kept.count() < 330


def test_kneser_ney_is_a_distribution_over_words_of_a_class():
    """The class models sum to one over the bytes after a context."""
    keys = np.unique(np.random.default_rng(4).integers(97, 100, (200, 6)) @
                     (1 << (8 * np.arange(6)[::-1]))).astype(np.uint64)
    counts = [np.random.default_rng(s).integers(0, 9, len(keys)).astype(float) for s in (5, 6)]
    model = toxicity.Model(keys, counts)
    assert np.isfinite(model.log_ratio(keys)).all()
    # Equal counts in both classes say nothing.
    same = toxicity.Model(keys, [counts[0], counts[0]])
    assert np.abs(same.log_ratio(keys)).max() < 1e-9


def test_toxicity_odd_rows(spark, odd, none):
    docs, labels, _ = toxic_table(spark, 80)
    classifier = toxicity.fit(docs, labels)
    rows = toxicity.score(odd, classifier).collect()
    assert len(rows) == odd.count() and all(0 <= r["__score"] <= 1 for r in rows)
    assert len({r["__score"] for r in rows if r["doc_id"] in (1, 2, 3)}) == 1
    assert toxicity.score(none, classifier).collect() == []
    no_labels = toxicity.fit(docs, labels.limit(0))
    assert toxicity.score(odd, no_labels).first()["__score"] == 0
    one_class = toxicity.fit(docs, labels.filter("toxic = 1"))
    assert toxicity.score(odd, one_class).first()["__score"] == 1
    strange = spark.createDataFrame([(None, 1), (1, None), (1, 7), (2, 0), (2, 1)],
                                    "doc_id long, toxic int")
    assert toxicity.fit(docs, strange).model is None


# --- 5: mixing ---------------------------------------------------------------------------------


def test_mix_meets_targets(spark, sf_dir):
    rows = queries.QUERIES["op5_entropy_mixing"](spark, sf_dir).collect()
    texts = texts_of(spark, sf_dir)
    sources = {r["doc_id"]: r["source"] for r in common.table(spark, sf_dir, "documents").collect()}
    by_source = collections.defaultdict(list)
    for r in rows:
        assert r["size"] == len(words_of(texts[r["doc_id"]]))
        assert 0 <= r["taken"] <= 2 * r["size"]
        by_source[sources[r["doc_id"]]].append(r)
    names = sorted(by_source)
    expected = mixing.targets([sum(r["size"] for r in by_source[n]) for n in names])
    for name, target in zip(names, expected, strict=True):
        of = by_source[name]
        assert {r["source_size"] for r in of} == {sum(r["size"] for r in of)}
        assert of[0]["target"] == pytest.approx(target)
        assert sum(r["taken"] for r in of) == pytest.approx(target, rel=0.05)
    again = queries.QUERIES["op5_entropy_mixing"](spark, sf_dir).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_targets_reshare_the_excess():
    assert mixing.targets([100, 100, 100]) == pytest.approx([200, 250 / 3, 500 / 3])
    assert mixing.targets([1, 1000], (1, 1), 1.5) == pytest.approx([2, 1499.5])
    assert mixing.targets([0, 10], (3, 1), 1.5) == [0, 15]
    assert mixing.targets([]) == [] and mixing.targets([0, 0]) == [0, 0]


def test_tilts_solve_the_dual(spark):
    rng = random.Random(1)
    rows = [(["s"], rng.randrange(1, 500)) for _ in range(500)] + [
        (["t"], rng.randrange(1, 50)) for _ in range(500)] + [([], 10)] * 50
    sources = mixing.balance(spark.createDataFrame(rows, "key array<string>, size long"))
    assert [s.name for s in sources] == ["s", "t", None]
    for s in sources:
        sizes = [r[1] for r in rows if r[0] == ([] if s.name is None else [s.name])]
        rates = [2.0 if s.full else min(2.0, 1.5 * math.exp(s.tilt * x / (s.size / s.rows)))
                 for x in sizes]
        assert sum(r * x for r, x in zip(rates, sizes, strict=True)) == pytest.approx(s.target)
    with pytest.raises(ValueError):
        mixing.balance(spark.createDataFrame(rows, "key array<string>, size long"), max_sources=2)


def test_mix_odd_rows(odd, none):
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns
    copies = collections.Counter(r["doc_id"] for r in mixed.collect())
    assert all(n <= 4 for n in copies.values())
    assert mixing.mix(none).collect() == []


# --- 6: decontamination ----------------------------------------------------------------------------


def test_contaminated_documents_hold_the_items(spark, sf_dir):
    items = {r["item_id"]: normal(r["text"])
             for r in common.table(spark, sf_dir, "benchmark").collect()}
    texts = texts_of(spark, sf_dir)
    expected = {(d, i) for d, t in texts.items() for i, x in items.items() if x in normal(t)}
    rows = queries.QUERIES["op6_bm25_decontamination"](spark, sf_dir).collect()
    found = {(r["doc_id"], r["item_id"]) for r in rows}
    assert expected and found == expected


def test_block_max_search_equals_full_scores():
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(150)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(5, 40)))) for i in range(60)]
    sets = [np.unique(decontamination._hashes(t)) for _, t in items]
    frequency = collections.Counter(int(w) for s in sets for w in s)
    index = decontamination.ItemIndex(items, frequency, 60, 20.0, 0.4, 0.5)
    passage, term, expected = [], [], {}
    for p in range(80):
        words = np.unique(decontamination._hashes(" ".join(
            rng.choices(vocabulary, k=20) + items[p % 60][1].split()[::2 + p % 3])))
        terms = np.unique(index.terms.find(words))
        terms = terms[terms >= 0]
        passage += [p] * len(terms)
        term += terms.tolist()
        for i in range(60):
            total = sum(w for t in terms for it, w in zip(
                index.item[index.begin[t]:index.begin[t + 1]],
                index.weight[index.begin[t]:index.begin[t + 1]], strict=True) if it == i)
            if total >= 0.4:
                expected[p, i] = total
    found = index.search(np.array(passage), np.array(term))
    got = {(int(p), int(i)): s for p, i, s in zip(*found, strict=True)}
    assert expected and got.keys() == expected.keys()
    assert all(got[k] == pytest.approx(expected[k]) for k in got)


def test_question_and_answer():
    split = decontamination.question_and_answer
    assert split("Who is it?\nThe cat.") == ("Who is it?", "The cat.")
    assert split("First. Second one. Third.") == ("First. Second one.", "Third.")
    assert split(" Only one. ") == ("Only one.", "")


def test_decontamination_needs_question_and_answer(spark, odd, none):
    question = " ".join(f"q{i}" for i in range(20))
    items = spark.createDataFrame(
        [(1, question + "\nred apple tree"), (2, None), (None, "!!!")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, f"a b {question.upper()} red, apple tree c"), (2, f"a {question} blue sea"),
         (3, "red apple tree")], "doc_id long, text string")
    rows = decontamination.matches(docs, items).collect()
    assert [(r["doc_id"], r["item_id"]) for r in rows] == [(1, 1)]
    assert rows[0]["score"] == pytest.approx(1)
    assert sorted(r["doc_id"] for r in decontamination.remove(docs, items).collect()) == [2, 3]
    assert decontamination.remove(odd, items).count() == odd.count()
    assert decontamination.matches(none, items).collect() == []
    assert decontamination.matches(docs, items.limit(0)).collect() == []
    assert decontamination.remove(docs, items.limit(0)).count() == 3


# --- 7: URLs ------------------------------------------------------------------------------------------


def plain_rule(url, rules=queries.URL_RULES):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1:] if fits else None


def test_url_rules(spark, sf_dir):
    urls = {r["page_id"]: r["url"] for r in common.table(spark, sf_dir, "pages").collect()}
    rows = queries.QUERIES["op7_url_filter"](spark, sf_dir).collect()
    assert len(rows) == len(urls)
    for r in rows:
        host, path, rule = plain_rule(urls[r["page_id"]])
        assert (r["host"], r["path"]) == (host, path)
        assert r["verdict"] in ("allow", "block")
        assert r["rule"] == (rule and rule[0])
        if rule:
            assert r["verdict"] == rule[1]


def test_url_odd_rows(spark):
    rows = [(1, None, "x"), (2, "no scheme.org/", "x"), (3, "HTTP://A.ExAmPle.ORG/es/?q", "x"),
            (4, "http://example.org", "x"), (5, "x://org/é", "x"), (5, "x://org/é", "x"),
            (6, "http://notorg/", "x"), (7, "http://a.com?/fr/#://b", "x"), (None, "://#", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    found = url_filter.judge(pages, queries.URL_RULES).collect()
    assert len(found) == len(rows)
    for r in found:
        url = next(x[1] for x in rows if x[0] == r["page_id"])
        host, path, rule = plain_rule(url)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule[0])
    assert url_filter.judge(pages.limit(0), queries.URL_RULES).collect() == []
    assert {r["verdict"] for r in url_filter.judge(pages, []).collect()} == {"allow"}


def test_markov_models_tell_urls_apart():
    rng = random.Random(2)
    good = [f"site{rng.randrange(99)}.org/wiki/{rng.randrange(999)}" for _ in range(300)]
    bad = [f"win{rng.randrange(99)}.biz/casino/{rng.randrange(999)}" for _ in range(300)]
    judge = url_filter.Judge({"allow": good[:200], "block": bad[:200]})
    assert all(judge.score(u) > 0.5 for u in good[200:])
    assert all(judge.score(u) < 0.5 for u in bad[200:])
    model = judge.models[0]
    seen = [chr(i) for i in range(1 << 8)]
    data = model._framed("site1")[:8]
    total = sum(math.exp(_next(model, data, c)) for c in seen)
    assert 0.99 < total <= 1 + 1e-9


def _next(model, data, symbol):
    at, text, p = len(data), data + symbol, 1 / url_filter._CHARACTERS
    for k in range(model.order + 1):
        if text[at - k:at] not in model.totals:
            break
        total, kinds = model.totals[text[at - k:at]]
        p = (model.counts[text[at - k:at]].get(symbol, 0) + kinds * p) / (total + kinds)
    return math.log(p)


def test_url_models_learn_from_every_url(spark, monkeypatch):
    """The tables give the scores of the same models in memory, and no URL is left out."""
    rng = random.Random(3)
    good = [f"http://s{rng.randrange(9)}.org/wiki/{i}" for i in range(6000)]
    bad = [f"http://w{rng.randrange(9)}.com/de/{i}" for i in range(6000)]
    new = [f"http://x{rng.randrange(9)}.net/{w}/{i}" for i, w in enumerate(["wiki", "de"] * 30)]
    pages = spark.createDataFrame(list(enumerate(good + bad + new)), "page_id long, url string")
    taught = []
    weights = url_filter._weights
    monkeypatch.setattr(url_filter, "_weights", lambda learned, wanted, order: (
        taught.append(learned.collect()), weights(learned, wanted, order))[1])
    rows = url_filter.judge(pages, queries.URL_RULES).collect()
    assert len(rows) == len(good) + len(bad) + len(new)
    learned = {v: [r["url"] for r in taught[0] if r["spoken"] == v] for v in ("allow", "block")}
    # Three of four by hash: more than the 5,000 of each verdict that were read before allow.
    assert all(len(x) == 4500 for x in learned.values())
    allow, block = (url_filter.MarkovModel(learned[v]) for v in ("allow", "block"))
    apart = {v: [u for u in urls if u not in set(learned[v])] for v, urls in (
        ("allow", [u[7:] for u in good]), ("block", [u[7:] for u in bad]))}
    plain = object.__new__(url_filter.Judge)
    plain.fixed, plain.models = None, [allow, block]
    plain._calibrate([np.array([plain.difference(u) for u in apart[v]]) for v in ("allow", "block")])
    for r in rows[-len(new):] if rows[-1]["rule"] is None else [r for r in rows if r["rule"] is None]:
        assert abs(r["score"] - plain.score(r["host"] + r["path"])) < 1e-6


def test_url_models_are_not_sent_to_the_driver(spark, monkeypatch):
    """Only the bounded number of frequent windows is broadcast, and scores don't depend on the bound."""
    rng = random.Random(4)
    urls = [f"http://s{rng.randrange(9)}.{end}/{i}" for i, end in enumerate(
        ["org/wiki", "com/de", "net/wiki", "net/de"] * 150)] + ["http://s1.net/wiki/2"] * 3
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    expected = {r["page_id"]: r["score"] for r in url_filter.judge(pages, queries.URL_RULES).collect()}
    sent, plans = [], {}
    broadcast, written = url_filter.F.broadcast, url_filter.written

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    def sending(df):
        sent.extend([df.count()] * ("window" in df.columns))
        return broadcast(df)

    def writing(df, name):
        plans[name] = plan(df)
        return written(df, name)

    monkeypatch.setattr(url_filter, "_FREQUENT", 64, raising=False)
    monkeypatch.setattr(url_filter.F, "broadcast", sending)
    monkeypatch.setattr(url_filter, "written", writing)
    judged = url_filter.judge(pages, queries.URL_RULES)
    found = {r["page_id"]: r["score"] for r in judged.collect()}
    assert len(sent) == 1 and 0 < sent[0] < 64
    # Stored tables are small here, and Spark would broadcast them if it were let.
    assert [plans[x].count("BroadcastExchange") for x in ("weights", "differences")] == [0, 2]
    assert "BroadcastExchange" not in plan(judged)
    assert found.keys() == expected.keys() and len(found) == len(urls)
    for page, score in expected.items():
        assert (score is None) == (found[page] is None)
        assert score is None or abs(score - found[page]) < 1e-9


# --- 8: substring dedup -----------------------------------------------------------------------------------


@pytest.mark.parametrize("hot", [substring_dedup.HOT, 3])
def test_substring_dedup_equals_all_windows(spark, sf_dir, hot):
    texts = texts_of(spark, sf_dir)
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    expected = dict(zip(texts, plain_cut([words_of(t) for t in texts.values()]), strict=True))
    rows = substring_dedup.cut(docs, hot=hot, chunk_bytes=100_000).withColumn(
        "sha", common.F.sha2("kept", 256)).collect()
    assert any(r["n_removed"] for r in rows)
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["sha"]) for r in rows} == expected


def test_substring_dedup_of_few_words(spark):
    """Small vocabularies and short windows, where chance repeats and periods are many."""
    rng = random.Random(11)
    for seed in range(3):
        texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(60)))
                 for _ in range(40)] + ["a b " * 40, "a " * 90, "a b c d e f g h i j k l m n o"]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        expected = plain_cut([words_of(t) for t in texts], 12)
        for hot in (substring_dedup.HOT, 3):
            rows = substring_dedup.cut(docs, 12, hot=hot).withColumn(
                "sha", common.F.sha2("kept", 256)).orderBy("doc_id").collect()
            assert [(r["n_words"], r["n_removed"], r["sha"]) for r in rows] == expected


def test_fm_index_matching_statistics():
    rng = np.random.default_rng(6)
    for symbols_in in (2, 5, 40):
        symbols = rng.integers(0, symbols_in, 400)
        symbols[:symbols_in] = np.arange(symbols_in)
        ends = np.array([90, 100, 250, 400])
        index = fm_index.FMIndex(symbols, ends, symbols_in)
        starts = np.array([0, 90, 100, 250])
        parts = ["".join(map(chr, symbols[a:b] + 65)) for a, b in zip(starts, ends, strict=True)]
        at, room = [], []
        for a, b in zip(starts, ends, strict=True):
            at += range(a + 1, b + 1)
            room += range(1, b - a + 1)
        got = index.matching(symbols, np.array(at), np.minimum(room, 20))
        for end, length, most in zip(at, got.tolist(), np.minimum(room, 20).tolist(), strict=True):
            text = "".join(map(chr, symbols[end - most:end] + 65))
            times = [sum(sum(p.startswith(text[most - n:], i) for i in range(len(p)))
                         for p in parts) for n in (length, length + 1) if n <= most]
            assert length == 0 or times[0] >= 2
            assert length == most or times[1] < 2


def test_strip_odd_rows(odd, none):
    kept = substring_dedup.strip(odd)
    assert kept.columns == odd.columns and kept.schema == odd.schema
    rows = {r["doc_id"]: r for r in kept.collect()}
    assert rows[1]["text"] is None and rows[3]["text"] == " \n\t " and 7 in rows
    assert substring_dedup.strip(none).collect() == []
    with pytest.raises(ValueError):
        substring_dedup.cut(odd, 5)


def test_strip_cuts_and_drops(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    docs = spark.createDataFrame(
        [(1, f"mine {passage} own", 9), (2, passage, 9), (3, "left  as it\nis", 9)],
        "doc_id long, text string, n_chars long")
    rows = sorted(substring_dedup.strip(docs).collect())
    assert [tuple(r) for r in rows] == [(1, "mine own", 8), (3, "left  as it\nis", 9)]


# --- 9: fingerprints ------------------------------------------------------------------------------------------


def test_edited_fingerprints(spark, sf_dir):
    texts = texts_of(spark, sf_dir)
    order = sorted(texts, reverse=True)
    rows = {r["doc_id"]: r for r in queries.QUERIES["op9_simhash_fingerprints"](
        spark, sf_dir).collect()}
    assert len(rows) == len(texts)
    better = 0
    for i, after in zip(order, order[1:] + order[:1], strict=True):
        text, r = texts[i] or "", rows[i]
        half = len(text) // 2
        edited = text[:len(text) - half] + (texts[after] or "")[:half]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, b = (int(rows[k]["fingerprint"], 16) for k in (i, after))
        assert r["near_next"] == 1 - (a ^ b).bit_count() / fingerprint.BITS
        assert r["near_edited"] == 1 - (
            a ^ int(r["edited_fingerprint"], 16)).bit_count() / fingerprint.BITS
        better += r["near_edited"] > r["near_next"]
    assert better >= 0.95 * len(order)


def test_radius_search_equals_all_pairs(spark, sf_dir):
    rows = fingerprint.fingerprints(common.table(spark, sf_dir, "documents")).collect()
    prints = {r["doc_id"]: int(r["fingerprint"], 16) for r in rows}
    base = next(iter(prints.values()))
    for k in range(1, 12):
        prints[100_000 + k] = base ^ ((1 << k) - 1) << (9 * k)
    table = spark.createDataFrame(
        [(i, f"{p:064x}") for i, p in prints.items()], "doc_id long, fingerprint string")
    found = fingerprint.within_radius(table, common.F.col("doc_id") % 10 == 0)
    got = {(r["fingerprint"], r["near"]): r["distance"] for r in found.collect()}
    asked = {p for i, p in prints.items() if i % 10 == 0}
    expected = {(f"{a:064x}", f"{b:064x}"): (a ^ b).bit_count() for a in asked
                for b in set(prints.values()) if (a ^ b).bit_count() <= fingerprint.RADIUS}
    assert got == expected and len(got) > len(asked)
    with pytest.raises(ValueError):
        fingerprint.within_radius(table, common.F.lit(True), 6)


def test_fingerprint_odd_rows(spark, odd, none):
    rows = fingerprint.edited(odd).collect()
    assert len(rows) == odd.count()
    prints = collections.defaultdict(set)
    for r in rows:
        prints[r["doc_id"]].add(r["fingerprint"])
    assert prints[1] == prints[2] == {"0" * 64} and prints[10] == prints[11]
    assert fingerprint.edited(none).collect() == fingerprint.fingerprints(none).collect() == []
    alone = fingerprint.edited(odd.filter("doc_id = 10")).collect()
    assert alone[0]["edited_sha256"] == hashlib.sha256(b"wowo").hexdigest()
    assert alone[0]["near_next"] == 1


# --- 10: licenses ---------------------------------------------------------------------------------------------


def test_license_lines_are_found(spark, sf_dir):
    short = {n: normal(t) for n, t in licenses.TEMPLATES.items() if "notice" not in n}
    expected = collections.Counter(
        (i, n) for i, t in texts_of(spark, sf_dir).items() for n, x in short.items()
        for _ in range(normal(t).count(x)))
    rows = queries.QUERIES["op10_license_scan"](spark, sf_dir).collect()
    assert expected and collections.Counter((r["doc_id"], r["license"]) for r in rows) == expected


def test_license_spans_and_edits(spark, odd, none):
    notice = licenses.TEMPLATES["GPL notice"]
    changed = notice.replace("redistribute", "give").replace(" and/or ", " or, you may, ")
    docs = spark.createDataFrame(
        [(1, f"foo bar {changed} baz"), (2, "this program is free"),
         (3, "x All Rights Reserved. y all rights reserved")], "doc_id long, text string")
    rows = licenses.scan(docs).orderBy("doc_id", "first_word").collect()
    assert [(r["doc_id"], r["license"]) for r in rows] == [
        (1, "GPL notice"), (3, "All rights reserved"), (3, "All rights reserved")]
    assert rows[0]["first_word"] == 2 and 0.8 <= rows[0]["coverage"] < 1
    assert [(r["first_word"], r["end_word"]) for r in rows[1:]] == [(1, 4), (5, 8)]
    assert licenses.scan(odd).collect() == licenses.scan(none).collect() == []
    assert licenses.scan(docs, {}).collect() == licenses.scan(docs, {"none": ""}).collect() == []


def test_winnowing_keeps_one_hash_in_every_stretch():
    hashes = np.random.default_rng(9).integers(0, 50, 200).astype(np.uint64)
    kept = set(licenses.winnow(hashes).tolist())
    assert all(kept & set(range(i, i + licenses.WINNOW))
               for i in range(len(hashes) - licenses.WINNOW + 1))

"""The pipeline, stage by stage, against plain versions of its decisions."""

import collections

import pytest

import corpus_pipeline
from docsearch.llm import common, mixing, simhash_dedup, toxicity
from plain_versions import normal, plain_components, plain_cut, plain_fingerprint, words_of


def test_stages_take_effect(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        out = common.written(stage(spark, docs, sf_dir), name)
        assert out.columns == columns
        rows = [(r["doc_id"], r["text"]) for r in out.collect()]
        after = dict(rows)
        seen.append(name)
        if name == "simhash_dedup":
            groups = plain_components({i: plain_fingerprint(t) for i, t in before.items()})
            assert sorted(i for i, _ in rows) == sorted(set(groups.values()))
            assert all(after[i] == before[i] for i in after)
        if name == "substring_dedup":
            cut = dict(zip(before, plain_cut([words_of(t) for t in before.values()]), strict=True))
            assert after.keys() == {i for i, (n, gone, _) in cut.items() if not gone or gone < n}
            for i, text in after.items():
                n, gone, _ = cut[i]
                assert len(words_of(text)) == n - gone
                assert gone or text == before[i]
        if name == "decontamination":
            items = [normal(r["text"]) for r in common.table(spark, sf_dir, "benchmark").collect()]
            bad = {i for i, t in before.items() if any(x in normal(t) for x in items)}
            assert after.keys() == before.keys() - bad
        if name == "mixing":
            assert max(collections.Counter(i for i, _ in rows).values()) <= 2
            total = sum(len(words_of(t)) for t in before.values())
            taken = sum(len(words_of(t)) for _, t in rows)
            assert taken == pytest.approx(1.5 * total, rel=0.02)
        docs = out
    assert seen == ["toxicity", "simhash_dedup", "substring_dedup", "decontamination", "mixing"]


def test_stages_on_an_empty_table(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).collect() == []


def test_extra_columns_and_repeated_rows_stay(spark):
    docs = spark.createDataFrame(
        [(i, f"text number {i} of its own kind {i * 7}", "en", "s", 9, "x") for i in (1, 2, 2, 3)],
        "doc_id long, text string, lang string, source string, n_chars long, row string")
    assert sorted(r["doc_id"] for r in simhash_dedup.keep_one(docs).collect()) == [1, 2, 3]
    assert mixing.mix(docs).columns == docs.columns
    assert toxicity.reject(docs, toxicity.Classifier(None, None, 0.0)).count() == 4

"""A corpus pipeline over the documents table: five stages, each one of the operators.

Toxic documents go, one document of each near-duplicate group stays, repeated
stretches are cut, documents with benchmark items go, and the rest is mixed to
the target weights of the sources. Each stage is written to the shared folder
and read again, so a lost executor costs at most the stage that runs.

Null, blank and very long texts, repeated rows, empty tables and further columns
have the results that the modules of the operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docsearch.llm import decontamination, mixing, simhash_dedup, substring_dedup, toxicity
from docsearch.llm.common import fold, table, written


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    classifier = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return toxicity.reject(docs, classifier)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.keep_one(docs)


def cut_repeated_stretches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.strip(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.remove(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash_dedup", keep_one_of_near_copies),
    ("substring_dedup", cut_repeated_stretches),
    ("decontamination", remove_benchmark),
    ("mixing", mix_sources),
]

#: Fitted models, components and window statistics can't be written as SQL; the tests compare
#: every stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

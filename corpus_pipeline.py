"""Corpus pipeline: five stages over the documents, each written as Parquet and read again.

Every stage works on what its predecessor kept; all but the last return the columns of documents.

1. ``language``: documents of a known language stay; the network learns from the labelled ones outside the held-out fold.
2. ``near_duplicates``: one document of each group stays (five-word shingles, similarity 0.8).
3. ``decontaminate``: documents that contain a benchmark item to 0.8 go (five-word shingles).
4. ``secrets``: secrets are replaced in the text, no document goes.
5. ``mix``: the documents of the mix of sources, with a column copies (1 or more), in place of one of that name.

Null and empty texts have no language, so the first stage drops them. Languages are learned from rows with a
doc_id only. Rows that share a doc_id are one document to ``near_duplicates``, which keeps
one of them; rows without a doc_id stay until the mix. Extra columns, whatever their names, pass through. An empty table, and one
without labelled languages, gives an empty result: nothing is a known language then.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from forecourt.llm import decontaminate, language, minhash, mixing, secrets
from forecourt.llm.common import table
from forecourt.session import materialise, run_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.of_known_language(docs, language.learn(language.trainable(docs)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", keep_languages),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_benchmark),
    ("secrets", mask_secrets),
    ("mix", mix_sources),
]

#: A trained network decides on the first stage, which SQL can't express; see tests/llm.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result; the written stages stay until ``session.remove_runs``, or in the caller's ``run_folder``."""
    with run_folder(spark, keep=True):
        docs = table(spark, sf_dir, "documents")
        for name, stage in STAGES:
            docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        return docs

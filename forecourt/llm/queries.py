"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from forecourt.llm import chat, decontaminate, language, minhash, mixing, pii, resample, secrets, sphere, suffixes, toxicity, urls, whiten
from forecourt.llm.common import table
from forecourt.llm.oracles import ORACLES
from forecourt.session import run_folder

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = dict(ORACLES)


def query(build):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # intermediate tables of a query share a folder; session.remove_runs removes it
        with run_folder(spark, keep=True):
            return build(spark, sf_dir)

    run.__name__ = build.__name__
    LLM_QUERIES[build.__name__] = run
    return run


@query
def op3_mixing(spark, sf_dir):
    return mixing.mixture(table(spark, sf_dir, "documents"))


@query
def op4_chat(spark, sf_dir):
    messages = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return chat.digests(chat.format_chats(chat.events_of(messages.union(probe))))


@query
def op7_decontamination(spark, sf_dir):
    return decontaminate.leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_secrets(spark, sf_dir):
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


@query
def op5_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


@query
def op10_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.learn(language.trainable(docs)))


@query
def op1_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, *toxicity.learn(docs, table(spark, sf_dir, "labels")))


@query
def op2_sphere(spark, sf_dir):
    return sphere.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op6_suffixes(spark, sf_dir):
    return suffixes.without_repeats(table(spark, sf_dir, "documents"))


@query
def op9_pii(spark, sf_dir):
    return pii.find_personal(table(spark, sf_dir, "documents"))


@query
def op11_urls(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, urls.rule_table(spark), urls.listed_urls(pages)).drop("listed")


@query
def op12_whitening(spark, sf_dir):
    return whiten.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


@query
def op13_resampling(spark, sf_dir):
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def mixing_targets(spark, sf_dir):
    """What each source is to give to the mix."""
    found = mixing.targets(mixing.sizes(table(spark, sf_dir, "documents")))
    return found.select("source", "source_size", F.round("target", 3).alias("target"))


@query
def secrets_base(spark, sf_dir):
    """The part of op8 that SQL can express."""
    return op8_secrets(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


@query
def pii_base(spark, sf_dir):
    """The part of op9 that SQL can express."""
    return op9_pii(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


@query
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)

"""Queries that plan and curate: the life of a stored manifest, a budget plan,
reconciliation, chat validation, a split, and release dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import curate, dedup, report
from tessera.operators.manifest import MANIFEST_COLUMNS, build_manifest
from tessera.plans import chats, corpus
from tessera.session import scratch_path
from tessera.sinks.jsonl import write_manifest
from tessera.sources.jsonl import scan_manifest
from tessera.sources.tables import table

#: Tokens that a training run asks for, and the percentage for validation.
TOKEN_BUDGET = 200_000
VALIDATION_PERCENT = 10
#: The source that stands for an earlier release.
RELEASED_SOURCE = "src0"


def stored_manifest(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "manifest") + "/index.jsonl"
    write_manifest(report.ranked(corpus.corpus_manifest(spark, root), corpus.LANG_ORDER), path)
    return scan_manifest(spark, path)


def manifest_round_trip(spark: SparkSession, root: str) -> DataFrame:
    """The manifest written in rank order and read back."""
    return stored_manifest(spark, root).select(*MANIFEST_COLUMNS)


def token_budget_plan(spark: SparkSession, root: str) -> DataFrame:
    """Files of the stored manifest that fit the budget, largest first, and
    the documents that loading only them gives (a semi-join)."""
    plan = curate.token_budget(stored_manifest(spark, root), TOKEN_BUDGET)
    docs = table(spark, root, "documents", "lang", "source") \
        .withColumnsRenamed({"lang": "skill", "source": "subtopic"})
    loaded = docs.join(plan.select("skill", "subtopic"), ["skill", "subtopic"], "left_semi") \
        .groupBy("skill", "subtopic").agg(F.count(F.lit(1)).alias("loaded"))
    return plan.join(loaded, ["skill", "subtopic"]).select("file", "approx_tokens", "running_tokens", "loaded")


def manifest_reconcile(spark: SparkSession, root: str) -> DataFrame:
    """The stored manifest against that of the corpus without repeated texts."""
    d = table(spark, root, "documents", "doc_id", "lang", "source", "text")
    firsts = dedup.first_wins(d.select("doc_id", "lang", "source", F.md5("text").alias("key"),
                                       F.length("text").alias("chars"), F.octet_length("text").alias("size")),
                              "key", "doc_id")
    computed = build_manifest(firsts.withColumnsRenamed({"lang": "skill", "source": "subtopic"}),
                              F.col("chars"), F.col("size"))
    return curate.reconcile(stored_manifest(spark, root), computed)


def chat_validate(spark: SparkSession, root: str) -> DataFrame:
    """Each thread against the rules of a chat entry."""
    rules = curate.chat_rules(F.col("messages"))
    return chats.threads(spark, root).select("conv_id", *[r.alias(n) for n, r in rules.items()],
                                             curate.chat_valid(F.col("messages")).alias("valid"))


def hash_split(spark: SparkSession, root: str) -> DataFrame:
    """A stable train and validation split of the documents by their ids."""
    d = table(spark, root, "documents", "doc_id")
    bucket = curate.hash_bucket(F.col("doc_id"))
    return d.select("doc_id", bucket.alias("bucket"), F.when(bucket < VALIDATION_PERCENT, "validation")
                    .otherwise("train").alias("split"))


def release_dedup(spark: SparkSession, root: str) -> DataFrame:
    """Documents of other sources whose text the released source does not hold."""
    d = table(spark, root, "documents", "doc_id", "source", "text") \
        .select("doc_id", "source", F.md5("text").alias("text_md5"))
    released = F.col("source") == RELEASED_SOURCE
    return curate.not_released(d.where(~released), d.where(released), "text_md5") \
        .select("doc_id", "source", "text_md5")

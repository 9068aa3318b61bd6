"""Queries over ``conversations`` (one row per turn) as a chat corpus.

Threads are grouped into two files: those that open with a system message
(``with_system``) and the rest (``plain``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.chat import (canonical_line, canonical_line_bytes, content_chars,
                                    first_content)
from tessera.functions.text import content_hash
from tessera.operators import chat
from tessera.operators.manifest import MANIFEST_COLUMNS, build_manifest
from tessera.sources.tables import table


def threads(spark: SparkSession, root: str) -> DataFrame:
    return chat.assemble(table(spark, root, "conversations", "conv_id", "turn", "role", "text"))


def grouped_threads(spark: SparkSession, root: str) -> DataFrame:
    t = threads(spark, root)
    first_role = F.get(F.col("messages"), 0).getField("role")
    sub = F.when(first_role == "system", F.lit("with_system")).otherwise(F.lit("plain"))
    return t.select(F.lit("conversations").alias("skill"), sub.alias("subtopic"), "conv_id",
                    "messages")


def chat_assemble(spark: SparkSession, root: str) -> DataFrame:
    t = threads(spark, root)
    return t.select("conv_id", F.size("messages").alias("n_messages"),
                    canonical_line("messages").alias("line"))


def chat_flatten(spark: SparkSession, root: str) -> DataFrame:
    return chat.flatten(threads(spark, root))


def chat_stats(spark: SparkSession, root: str) -> DataFrame:
    t = threads(spark, root)
    return t.select(
        "conv_id", content_chars("messages").alias("chars"),
        content_hash(first_content("messages")).alias("first_md5"),
        canonical_line_bytes("messages").alias("line_bytes"),
        F.octet_length(canonical_line("messages")).cast("bigint").alias("line_octets"))


def chat_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Manifest of the two thread files, measured from the turn rows (per
    thread partial aggregates; no thread is assembled)."""
    turns = table(spark, root, "conversations", "conv_id", "turn", "role", "text")
    t = chat.thread_measures(turns)
    sub = F.when(F.col("first_role") == "system", F.lit("with_system")).otherwise(F.lit("plain"))
    t = t.select(F.lit("conversations").alias("skill"), sub.alias("subtopic"), "chars",
                 "line_bytes")
    return build_manifest(t, F.col("chars"), F.col("line_bytes")).select(*MANIFEST_COLUMNS)

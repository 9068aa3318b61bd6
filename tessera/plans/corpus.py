"""Queries over ``documents`` seen as a grouped corpus: one group (file)
per (lang, source), i.e. skill = lang, subtopic = source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import content_hash
from tessera.operators import dedup, report, subset
from tessera.operators.manifest import MANIFEST_COLUMNS, build_manifest
from tessera.sources.tables import table

# Explicit group order for the documents corpus (a parameter of the
# reports): listed languages rank 0.., others rank 99; a listed language
# without documents reports zeros.
LANG_ORDER = ["en", "de", "fr", "es", "it"]
CAP_PER_GROUP = 5
MIN_ENTRIES_TO_LOAD = 30


def documents_as_groups(spark: SparkSession, root: str, *extra: str) -> DataFrame:
    d = table(spark, root, "documents", "lang", "source", "text", *extra)
    return d.withColumnRenamed("lang", "skill").withColumnRenamed("source", "subtopic")


def manifest_full(spark: SparkSession, root: str) -> DataFrame:
    """Manifest with ``chars`` kept (for averages and merges)."""
    d = documents_as_groups(spark, root)
    return build_manifest(d, F.length("text"), F.octet_length("text"))


def corpus_manifest(spark: SparkSession, root: str) -> DataFrame:
    return manifest_full(spark, root).select(*MANIFEST_COLUMNS)


def ranked_manifest(spark: SparkSession, root: str) -> DataFrame:
    return report.ranked(corpus_manifest(spark, root), LANG_ORDER)


def corpus_totals(spark: SparkSession, root: str) -> DataFrame:
    return report.totals(corpus_manifest(spark, root))


def skill_rollup(spark: SparkSession, root: str) -> DataFrame:
    return report.skill_rollup(corpus_manifest(spark, root))


def fixed_order_report(spark: SparkSession, root: str) -> DataFrame:
    return report.fixed_order_report(corpus_manifest(spark, root), LANG_ORDER)


def coverage_table(spark: SparkSession, root: str) -> DataFrame:
    return report.coverage_table(corpus_manifest(spark, root), LANG_ORDER)


def subtopic_lists(spark: SparkSession, root: str) -> DataFrame:
    return report.subtopic_lists(corpus_manifest(spark, root))


def entry_averages(spark: SparkSession, root: str) -> DataFrame:
    return report.entry_averages(manifest_full(spark, root))


def subset_skill(spark: SparkSession, root: str) -> DataFrame:
    """All documents of one language (the predicate reaches the scan)."""
    d = table(spark, root, "documents")
    return subset.by_skill(d, ["en"], column="lang")


def manifest_subset(spark: SparkSession, root: str) -> DataFrame:
    """Documents of the groups the manifest selects (entries >= 30)."""
    m = corpus_manifest(spark, root).where(F.col("entries") >= MIN_ENTRIES_TO_LOAD)
    d = documents_as_groups(spark, root, "doc_id")
    return subset.by_manifest(d, m).select("doc_id", "skill", "subtopic")


def _hashed(spark: SparkSession, root: str) -> DataFrame:
    d = table(spark, root, "documents", "doc_id", "lang", "source", "text")
    return d.select("doc_id", "lang", "source", content_hash(F.col("text")).alias("text_md5"))


def dedup_first_wins(spark: SparkSession, root: str) -> DataFrame:
    """One document per (lang, source, md5(text)): the lowest doc_id."""
    return dedup.first_wins(_hashed(spark, root), "text_md5", "doc_id", scope=["lang", "source"])


def dedup_corpus(spark: SparkSession, root: str) -> DataFrame:
    """One document per md5(text) over the whole corpus."""
    return dedup.first_wins(_hashed(spark, root), "text_md5", "doc_id")


def cap_per_group(spark: SparkSession, root: str) -> DataFrame:
    """The first five documents (by doc_id) of every (lang, source)."""
    d = table(spark, root, "documents", "doc_id", "lang", "source")
    return dedup.cap(d, CAP_PER_GROUP, "doc_id", ["lang", "source"])

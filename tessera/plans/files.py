"""Queries over files that they write: the flat corpus and its audit, and a budget plan that prunes a partitioned corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.chat import canonical_line, message, nest
from tessera.functions.text import file_name
from tessera.model import FILE_SUFFIX, GROUP_COLUMNS
from tessera.operators import curate, manifest
from tessera.plans import curation
from tessera.session import scratch_path
from tessera.sinks.flat import write_flat, write_flat_lines
from tessera.sources.jsonl import list_files, scan_chat, scan_chat_lines
from tessera.sources.tables import table

#: Documents whose entry is turned round, is cut off, or is a blank line (by id).
TURNED, CUT, BLANK = (30, 5), (50, 7), (40, 3)
#: Documents that lie in files without a group in the name.
UNGROUPED = (25, 11)


def _marked(rule: tuple[int, int]):
    return F.col("doc_id") % rule[0] == rule[1]


def document_entries(spark: SparkSession, root: str) -> DataFrame:
    """Each document as the answer to a request, grouped by language and source."""
    d = table(spark, root, "documents", "doc_id", "lang", "source", "text")
    asked = F.concat(F.lit("Write a text in "), F.col("lang"), F.lit("."))
    return d.select(F.col("lang").alias("skill"), F.col("source").alias("subtopic"), "doc_id",
                    nest(asked, F.col("text")).alias("messages"))


def flat_corpus_manifest(spark: SparkSession, root: str) -> DataFrame:
    """The documents' corpus written as one file for each group, listed and
    scanned back; the manifest from the physical files."""
    out = scratch_path(spark, "flat-corpus")
    write_flat(document_entries(spark, root), out, order=["doc_id"])
    return manifest.file_manifest(scan_chat(spark, out), list_files(spark, out)).select(*manifest.MANIFEST_COLUMNS)


def _odd_corpus(spark: SparkSession, root: str) -> str:
    """The same corpus with what a folder may hold besides: entries whose roles
    are turned round, lines that are cut off or blank, an empty file for each
    language, and files without a group in their name."""
    entries = document_entries(spark, root)
    asked, answer = (F.get("messages", i)["content"] for i in (0, 1))
    turned = F.array(message(F.lit("assistant"), answer), message(F.lit("user"), asked))
    line = canonical_line(F.when(_marked(TURNED), turned).otherwise(F.col("messages")))
    line = F.when(_marked(BLANK), F.lit("  ")).when(_marked(CUT), F.substring(line, 1, 40)).otherwise(line)
    name = F.when(_marked(UNGROUPED), F.concat(F.lit("notes-"), F.col("skill"), F.lit(FILE_SUFFIX))) \
        .otherwise(file_name(F.col("skill"), F.col("subtopic")))
    lines = entries.select(name.alias("file"), "doc_id", line.alias("line"))
    empty = entries.select("skill").distinct().select(
        file_name(F.col("skill"), F.lit("nothing yet")).alias("file"), F.lit(None).cast("bigint").alias("doc_id"),
        F.lit(None).cast("string").alias("line"))
    out = scratch_path(spark, "odd-corpus")
    write_flat_lines(lines.unionByName(empty), out, order=["doc_id"])
    return out


def line_audit(spark: SparkSession, root: str) -> DataFrame:
    """Per file of a folder with all sorts of lines: lines, blank ones, broken
    ones, and entries that hold the rules of a chat."""
    out = _odd_corpus(spark, root)
    audited = manifest.line_audit(scan_chat_lines(spark, out), list_files(spark, out), curate.chat_valid(F.col("entry.messages")))
    return audited.select(*GROUP_COLUMNS, "lines", "blank_lines", "broken_lines", "valid_entries", "file_size")


def odd_files(spark: SparkSession, root: str) -> DataFrame:
    """How many files that folder has, how many are empty or without a group."""
    return manifest.odd_files(list_files(spark, _odd_corpus(spark, root)))


def budget_load(spark: SparkSession, root: str) -> DataFrame:
    """What a budget plan loads of a partitioned corpus: the plan's groups prune
    its partitions when the query runs, so other files are not read."""
    corpus = scratch_path(spark, "partitioned")
    d = table(spark, root, "documents", "doc_id", "lang", "source", "text") \
        .withColumnsRenamed({"lang": "skill", "source": "subtopic"})
    d.hint("rebalance", *GROUP_COLUMNS).write.partitionBy(*GROUP_COLUMNS).parquet(corpus)
    schema = "doc_id long, text string, skill string, subtopic string"
    loaded = curate.load_planned(spark.read.schema(schema).parquet(corpus), curation.stored_manifest(spark, root),
                                 curation.TOKEN_BUDGET)
    return loaded.groupBy(*GROUP_COLUMNS).agg(
        F.count(F.lit(1)).alias("loaded"), F.sum(F.length("text").cast("bigint")).alias("chars"))

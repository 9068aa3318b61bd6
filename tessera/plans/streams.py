"""Queries that stream the documents table or write and read files: the
streaming manifest and dedup, and the JSON Lines round trip of the chat corpus
(sink, scan, physical-size manifest).

Streams read the table's own files; their state and sinks, and written
corpora, live under the shared checkpoint folder of the session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import content_hash
from tessera.operators import dedup
from tessera.operators.manifest import MANIFEST_COLUMNS, file_manifest
from tessera.plans.chats import grouped_threads
from tessera.plans.files import document_entries
from tessera.session import scratch_path
from tessera.sinks.flat import remove_files, write_flat
from tessera.sinks.jsonl import write_corpus
from tessera.sources.jsonl import list_files, scan_chat
from tessera.sources.tables import table
from tessera.streaming import (changes, look, read_file_manifest, read_snapshot, read_survivors,
                               run_dedup_stream, run_file_stream, run_manifest_stream, table_stream)

#: How late an event may come and still find the one that it repeats.
EVENT_DELAY = "60 days"
#: Files that are written again, and files that are removed.
REWRITTEN_LANG, REMOVED_SOURCE = "de", "src3"


def _documents(spark: SparkSession, root: str) -> DataFrame:
    """The documents table as a stream of its files. With ``availableNow`` all
    files of the moment are read, in as many batches as their sizes ask for."""
    schema = table(spark, root, "documents", "doc_id", "lang", "source", "text").schema
    return table_stream(spark, root, "documents", schema)


def stream_manifest(spark: SparkSession, root: str) -> DataFrame:
    snap = scratch_path(spark, "manifest-snapshot")
    run_manifest_stream(spark, _documents(spark, root), ("lang", "source"), F.length("text"),
                        F.octet_length("text"), snap, scratch_path(spark, "manifest-ckpt"))
    return read_snapshot(spark, snap, ("lang", "source"))


def stream_dedup(spark: SparkSession, root: str) -> DataFrame:
    """Keys that survive the streaming first-seen dedup; which row survives
    depends on arrival order, so only keys are reported."""
    keyed = _documents(spark, root).select("doc_id", "lang", "source",
                                           content_hash(F.col("text")).alias("text_md5"))
    sink = scratch_path(spark, "dedup-sink")
    run_dedup_stream(spark, keyed, ["lang", "source", "text_md5"], sink,
                     scratch_path(spark, "dedup-ckpt"))
    return read_survivors(spark, sink).select("lang", "source", "text_md5")


def stream_dedup_watermark(spark: SparkSession, root: str) -> DataFrame:
    """The same over the events, with the state bounded by a watermark: a key
    that comes again within the delay is dropped, and its state goes when the
    watermark has passed it."""
    schema = table(spark, root, "events", "ts", "user_id", "event_type").schema
    keyed = table_stream(spark, root, "events", schema).select(F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    sink = scratch_path(spark, "events-sink")
    run_dedup_stream(spark, keyed, ["user_id", "event_type"], sink, scratch_path(spark, "events-ckpt"),
                     event_time="ts", delay=EVENT_DELAY)
    return read_survivors(spark, sink).select("user_id", "event_type")


def stream_file_manifest(spark: SparkSession, root: str) -> DataFrame:
    """The manifest of a folder after its files have come, changed and gone: the
    documents' corpus is taken in, then the files of one language are written
    again without repeated texts and those of one source are removed, and only
    these changes are taken in."""
    folder, feed, deltas, checkpoint = (scratch_path(spark, f"files-{n}") for n in ("corpus", "feed", "deltas", "ckpt"))
    entries, before = document_entries(spark, root), None
    rewritten = dedup.first_wins(entries.where(F.col("skill") == REWRITTEN_LANG).withColumn("key", F.md5(F.get("messages", 1)["content"])),
                                 "key", "doc_id", scope=["skill", "subtopic"])
    for version, rows in enumerate((entries, rewritten)):
        write_flat(rows.select("skill", "subtopic", "doc_id", "messages"), folder, order=["doc_id"], mode="append")
        if version:
            remove_files(spark, folder, list_files(spark, folder).where(F.col("subtopic") == REMOVED_SOURCE))
        now = look(spark, folder)
        changes(spark, folder, now, before, version).write.parquet(f"{feed}/version-{version}")
        run_file_stream(spark, feed, deltas, checkpoint)
        before = now
    return read_file_manifest(spark, deltas)


def jsonl_file_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Write the chat corpus as JSON Lines (one folder per group), scan it
    back with an explicit schema and build the manifest from physical file
    sizes; equals the manifest computed from the rows."""
    out = scratch_path(spark, "chat-corpus")
    write_corpus(grouped_threads(spark, root).select("skill", "subtopic", "messages"), out)
    scanned = scan_chat(spark, out, layout="hive")
    return file_manifest(scanned, list_files(spark, out, layout="hive")).select(*MANIFEST_COLUMNS)

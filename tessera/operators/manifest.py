"""Manifest: entries, bytes and estimated tokens per group (file).

Characters are summed per group first and floored once (``sum div 4``):
a floor per row or per part file would not add up to the same number.
Every builder keeps ``chars`` so that partial manifests can be merged
(streams, increments) before tokens are derived.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.chat import canonical_line_bytes, content_chars
from tessera.functions.text import approx_tokens, file_name
from tessera.model import GROUP_COLUMNS

MANIFEST_COLUMNS = ["file", "skill", "subtopic", "entries", "bytes", "approx_tokens"]


def _finish(df: DataFrame, group: Sequence[str]) -> DataFrame:
    skill, sub = group
    return df.select(
        file_name(F.col(skill), F.col(sub)).alias("file"),
        F.col(skill).alias("skill"), F.col(sub).alias("subtopic"),
        F.col("entries").cast("bigint").alias("entries"),
        F.col("bytes").cast("bigint").alias("bytes"),
        approx_tokens(F.col("chars")).alias("approx_tokens"),
        F.col("chars").cast("bigint").alias("chars"))


def build_manifest(rows: DataFrame, chars: Column, nbytes: Column,
                   group: Sequence[str] = GROUP_COLUMNS) -> DataFrame:
    """Generic manifest: one row per group with ``entries = count(*)``,
    ``bytes = sum(nbytes)``, ``chars = sum(chars)`` and
    ``approx_tokens = chars div 4``. One hash aggregate (partial, exchange on
    the group, final)."""
    agg = rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("entries"),
        F.coalesce(F.sum(nbytes.cast("bigint")), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum(chars.cast("bigint")), F.lit(0)).alias("chars"))
    return _finish(agg, group)


def chat_manifest(entries: DataFrame, group: Sequence[str] = GROUP_COLUMNS) -> DataFrame:
    """Manifest of chat entries held in a DataFrame: bytes are the logical
    size of the canonical JSON lines, newline included."""
    return build_manifest(entries, content_chars("messages"),
                          canonical_line_bytes("messages") + F.lit(1), group)


def measured_manifest(entries: DataFrame, group: Sequence[str] = GROUP_COLUMNS) -> DataFrame:
    """Manifest of entries that carry their own measures (``chars``,
    ``line_bytes``), as the generator's entries do."""
    return build_manifest(entries, F.col("chars"), F.col("line_bytes"), group)


def file_manifest(scanned: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Manifest of a scanned corpus (``sources.scan_chat``): bytes are the
    physical file sizes, counted once per file; broken lines (parsed to
    null) are not entries. With the listing ``files`` (``sources.list_files``)
    a group whose files are empty has a row with zero entries; files with an
    odd name belong to no group (see :func:`odd_files`). Of a line-level scan
    (``sources.scan_chat_lines``), which compressed files need, bytes are those of
    the lines as read, each with its newline.

    Aggregates to one row per file first (the file size repeats on every
    row of that file), then per group over those few rows.
    """
    size = F.max("file_size")
    if "line" in scanned.columns:
        scanned = scanned.withColumn("messages", F.col("entry.messages"))
        size = F.sum(F.octet_length("line").cast("bigint") + 1)
    ok = F.col("messages").isNotNull()
    if "_corrupt_record" in scanned.columns:
        ok = ok & F.col("_corrupt_record").isNull()
    per_file = scanned.groupBy(*GROUP_COLUMNS, "file_path").agg(
        F.count(F.when(ok, F.lit(1))).alias("entries"),
        F.coalesce(F.sum(F.when(ok, content_chars("messages"))), F.lit(0)).alias("chars"),
        size.alias("file_size"))
    if files is not None:
        empty = files.where(~F.col("odd_name") & (F.col("file_size") == 0)) \
            .select(*GROUP_COLUMNS, "file_path", F.lit(0).cast("bigint").alias("entries"),
                    F.lit(0).cast("bigint").alias("chars"), "file_size")
        per_file = per_file.select(*empty.columns).unionByName(empty)
    per_group = per_file.groupBy(*GROUP_COLUMNS).agg(
        F.sum("entries").alias("entries"), F.sum("file_size").alias("bytes"),
        F.sum("chars").alias("chars"))
    return _finish(per_group, GROUP_COLUMNS)


def odd_files(files: DataFrame) -> DataFrame:
    """How many listed files there are, and how many of them are empty or have
    a name without a group: nothing is skipped uncounted."""
    return files.agg(F.count(F.lit(1)).alias("files"),
                     F.count(F.when(F.col("file_size") == 0, 1)).alias("empty_files"),
                     F.count(F.when(F.col("odd_name"), 1)).alias("odd_files"))


def line_audit(lines: DataFrame, files: DataFrame | None = None, valid: Column | None = None) -> DataFrame:
    """Per file: physical lines, blank lines and lines that do not parse to
    an entry with messages (from ``sources.scan_chat_lines``), and with
    ``valid``, a rule over ``entry``, how many of the others hold it. Nothing is
    dropped without being counted; with the listing ``files`` empty files
    have a row of zeros too."""
    blank = F.trim(F.col("line")) == ""
    broken = ~blank & (F.col("entry").isNull() | F.col("entry.messages").isNull())
    out = lines.groupBy(*GROUP_COLUMNS, "file_path").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count(F.when(blank, 1)).alias("blank_lines"),
        F.count(F.when(broken, 1)).alias("broken_lines"),
        *([F.count(F.when(~blank & ~broken & valid, 1)).alias("valid_entries")] if valid is not None else []),
        F.max("file_size").alias("file_size"))
    if files is None:
        return out
    group = {*GROUP_COLUMNS, "file_path", "file_size"}
    empty = files.where(~F.col("odd_name") & (F.col("file_size") == 0)).select(
        *[F.col(c) if c in group else F.lit(0).cast("bigint").alias(c) for c in out.columns])
    return out.unionByName(empty)


def merge_manifests(*parts: DataFrame) -> DataFrame:
    """Combine partial manifests (same groups appearing in several parts) by
    adding entries, bytes and chars, then deriving tokens once."""
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    agg = u.groupBy("skill", "subtopic").agg(
        F.sum("entries").alias("entries"), F.sum("bytes").alias("bytes"),
        F.sum("chars").alias("chars"))
    return _finish(agg, GROUP_COLUMNS)

"""Reports over a manifest: rank order, totals, per-skill rollup, the
fixed-order report, the coverage table with a Total row, subtopic lists
and per-entry averages.

All of these run over manifest rows (one per file), never over corpus rows,
so their windows and single-partition sorts stay small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import megabytes
from tessera.model import SKILL_ORDER, UNKNOWN_RANK
from tessera.session import checkpointed


def rank_of(skill_col, order: Sequence[str] = SKILL_ORDER, unknown: int = UNKNOWN_RANK):
    """Position of the skill in the explicit order; unknown skills rank last."""
    kv = []
    for i, s in enumerate(order):
        kv += [F.lit(s), F.lit(i)]
    return F.coalesce(F.try_element_at(F.create_map(*kv), skill_col), F.lit(unknown))


def ranked(manifest: DataFrame, order: Sequence[str] = SKILL_ORDER,
           unknown: int = UNKNOWN_RANK) -> DataFrame:
    """Manifest with ``rank`` (explicit skill order, unknown = 99) and
    ``position`` (1-based place in the order rank, subtopic). Rank is kept
    as a column because consumers may compare rows unordered."""
    m = manifest.withColumn("rank", rank_of(F.col("skill"), order, unknown))
    return global_position(m, ["rank", "subtopic", "skill"], "position")


def global_position(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``name`` = 1-based place of each row in the total ``order`` (which
    must be unique per row), without a single-partition window.

    The rows are range-partitioned on the order and stored with the number
    of their range, so that counting the ranges and numbering their rows
    read the same ranges whatever the optimizer does with either. Each row
    is numbered inside its range and shifted by the rows of the ranges
    before it; the offsets are one row per partition.
    """
    ranged = checkpointed(df.repartitionByRange(*[F.col(c) for c in order])
                          .withColumn("_part", F.spark_partition_id()))
    local = ranged.withColumn(
        "_local", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_offset"))
    out = local.join(F.broadcast(offsets), "_part", "inner")
    return out.withColumn(name, (F.col("_offset") + F.col("_local")).cast("bigint")) \
        .select(*df.columns, name)


def totals(manifest: DataFrame) -> DataFrame:
    """Grand totals; tokens are the sum of the per-file floors."""
    return manifest.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("entries"), F.lit(0)).cast("bigint").alias("entries"),
        F.coalesce(F.sum("bytes"), F.lit(0)).cast("bigint").alias("bytes"),
        F.coalesce(F.sum("approx_tokens"), F.lit(0)).cast("bigint").alias("approx_tokens"))


def skill_rollup(manifest: DataFrame) -> DataFrame:
    """Per skill: files, entries, tokens, bytes (from the manifest)."""
    return manifest.groupBy("skill").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("entries").cast("bigint").alias("entries"),
        F.sum("approx_tokens").cast("bigint").alias("approx_tokens"),
        F.sum("bytes").cast("bigint").alias("bytes"))


def fixed_order_report(manifest: DataFrame, order: Sequence[str] = SKILL_ORDER) -> DataFrame:
    """The per-skill report for exactly the listed skills, in list order;
    a listed skill without files reports zeros, unlisted skills are left
    out. The order list is a literal, so the join's small side is bounded
    by the list itself."""
    listed = manifest.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(s) for s in order]))) \
        .select(F.col("pos").alias("rank"), F.col("col").alias("skill"))
    # only listed skills reach the join: at most one row for each
    roll = skill_rollup(manifest.where(F.col("skill").isin(list(order))))
    out = listed.join(F.broadcast(roll), "skill", "left")
    return out.select(
        "rank", "skill",
        F.coalesce("files", F.lit(0)).cast("bigint").alias("files"),
        F.coalesce("entries", F.lit(0)).cast("bigint").alias("entries"),
        F.coalesce("approx_tokens", F.lit(0)).cast("bigint").alias("approx_tokens"),
        F.coalesce("bytes", F.lit(0)).cast("bigint").alias("bytes"),
        megabytes(F.coalesce(F.col("bytes"), F.lit(0))).alias("size_mb"))


def coverage_table(manifest: DataFrame, order: Sequence[str] = SKILL_ORDER) -> DataFrame:
    """Per-skill rows plus a ``Total`` row (one ROLLUP)."""
    r = manifest.rollup("skill").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("entries").cast("bigint").alias("entries"),
        F.sum("approx_tokens").cast("bigint").alias("approx_tokens"),
        F.sum("bytes").cast("bigint").alias("bytes"),
        F.grouping("skill").alias("is_total"))
    label = F.when(F.col("is_total") == 1, F.lit("Total")).otherwise(F.col("skill"))
    rank = F.when(F.col("is_total") == 1, F.lit(UNKNOWN_RANK + 1)) \
        .otherwise(rank_of(F.col("skill"), order))
    return r.select(label.alias("skill"), rank.alias("rank"), "files", "entries",
                    "approx_tokens", "bytes")


def subtopic_lists(manifest: DataFrame, sub_rank: str | None = None) -> DataFrame:
    """Per skill, its subtopics as one comma-separated list, in ``sub_rank``
    order when given, else by name. Runs over manifest rows."""
    key = F.col(sub_rank) if sub_rank else F.col("subtopic")
    per = manifest.groupBy("skill").agg(
        F.array_sort(F.collect_list(F.struct(key.alias("k"), F.col("subtopic").alias("s"))))
        .alias("subs"), F.count(F.lit(1)).alias("files"))
    return per.select("skill", "files",
                      F.array_join(F.transform("subs", lambda x: x.getField("s")), ", ")
                      .alias("subtopics"))


def entry_averages(manifest: DataFrame) -> DataFrame:
    """Mean characters and tokens per entry, per file (needs ``chars``)."""
    e = F.col("entries").cast("double")
    return manifest.select(
        "file", "skill", "subtopic", "entries",
        F.when(e > 0, F.col("chars") / e).alias("avg_chars"),
        F.when(e > 0, F.col("approx_tokens") / e).alias("avg_tokens"))

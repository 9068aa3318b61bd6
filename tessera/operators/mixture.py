"""Samples and shards from a histogram of hash buckets.

A row's bucket is a hash of its key, so the rows of a bucket are a uniform
sample. What a sample or a shard should weigh is decided on the histogram, one
row for each bucket (and group), never on rows: the buckets below a cut-off
make a sample, a run of buckets makes a shard. Rows are then told by their own
bucket, with a join to a few thousand rows at most.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import checkpointed

#: Buckets of a histogram: three hex digits of an MD5.
BUCKETS = 4096


def bucket_of(key: Column) -> Column:
    """A uniform bucket below ``BUCKETS`` (null keys: 0)."""
    first = F.conv(F.substring(F.md5(key.cast("string")), 1, 3), 16, 10)
    return F.coalesce(first.cast("int"), F.lit(0))


def mixture_cutoffs(rows: DataFrame, group: str, weights: Mapping[str, int]) -> DataFrame:
    """Rows ``(group, target, cutoff, kept)`` for the listed groups of
    ``rows(group, bucket, tokens)``.

    The sample is as large as the scarcest group allows: the targets are the
    weights times the least ``tokens div weight``. A group keeps the buckets
    below ``cutoff``, which hold ``kept`` tokens, at most its target and less than
    one bucket below it."""
    if not weights or min(weights.values()) <= 0:
        raise ValueError("weights must be positive")
    pairs = [F.lit(x) for g, w in weights.items() for x in (g, w)]
    weight = F.try_element_at(F.create_map(*pairs), F.col(group)).cast("bigint")
    hist = checkpointed(rows.where(F.col(group).isin(list(weights))).groupBy(group, "bucket")
                        .agg(F.sum("tokens").alias("tokens")))
    share = hist.groupBy(group).agg(F.sum("tokens").alias("t")) \
        .select(F.call_function("div", F.col("t"), weight).alias("unit"))
    unit, present = share.agg(F.min("unit"), F.count(F.lit(1))).first()
    unit = unit if present == len(weights) else 0  # a listed group without rows: no such mixture
    run = F.sum("tokens").over(Window.partitionBy(group).orderBy("bucket"))
    target = weight * F.lit(unit or 0)
    fits = F.col("run") <= F.col("target")
    filled = hist.withColumn("run", run).withColumn("target", target).groupBy(group, "target").agg(
        F.max(F.when(fits, F.col("run"))).alias("kept"), F.min(F.when(~fits, F.col("bucket"))).alias("over"))
    return filled.select(group, "target", F.coalesce("over", F.lit(BUCKETS)).alias("cutoff"),
                         F.coalesce("kept", F.lit(0)).alias("kept"))


def mixture(rows: DataFrame, group: str, key: str, tokens: Column, weights: Mapping[str, int]) -> DataFrame:
    """The rows of a deterministic sample whose token shares of the listed
    groups are the ``weights``, with ``bucket`` and ``tokens``. Rows of other groups
    are not in it."""
    dealt = rows.withColumns({"bucket": bucket_of(F.col(key)), "tokens": F.coalesce(tokens, F.lit(0)).cast("bigint")})
    cut = mixture_cutoffs(dealt.select(group, "bucket", "tokens"), group, weights) \
        .select(F.col(group).alias("_group"), "cutoff")
    # one row for each listed group
    return dealt.join(F.broadcast(cut), (F.col(group) == F.col("_group")) & (F.col("bucket") < F.col("cutoff"))) \
        .drop("_group", "cutoff")


def byte_shards(rows: DataFrame, key: str, size: Column, shards: int) -> DataFrame:
    """``rows`` with ``bucket`` and ``shard``: runs of buckets of near-equal bytes. A
    bucket belongs to the shard in whose share of all bytes it begins, so a
    shard is off the mean by less than the largest bucket."""
    if shards <= 0:
        raise ValueError("shards must be positive")
    dealt = rows.withColumn("bucket", bucket_of(F.col(key)))
    hist = dealt.select("bucket", F.coalesce(size, F.lit(0)).cast("bigint").alias("s")) \
        .groupBy("bucket").agg(F.sum("s").cast("decimal(38,0)").alias("s"))
    hist = checkpointed(hist)  # BUCKETS rows at most
    run = F.sum("s").over(Window.orderBy("bucket")) - F.col("s")
    total = hist.agg(F.sum("s")).first()[0] or 1
    number = F.floor(run * shards / F.lit(total)).cast("int")
    plan = hist.select(F.col("bucket").alias("_bucket"), F.least(number, F.lit(shards - 1)).alias("shard"))
    return dealt.join(F.broadcast(plan), F.col("bucket") == F.col("_bucket")).drop("_bucket")

"""Length profiles: exact quantiles by histogram refinement, bins, the share
of a band, and mergeable sketches.

Exact quantiles never sort rows. A first histogram of coarse bins shows in
which bin each wanted rank lies, a second one, of these bins only, holds single
values. Sketches are kept one for each file and merged to any larger group
without reading its rows again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import stored

#: Values of a coarse bin.
COARSE = 256
#: Size parameter of the sketches: a rank error of about 1 % for each merge tree.
SKETCH_K = 400


def quantiles(rows: DataFrame, group: str, value: str, probs: Sequence[float], coarse: int = COARSE) -> DataFrame:
    """Rows ``(group, p, value)``: the continuous quantiles of a whole-number
    ``value`` (nulls do not count), interpolated between the ranks on both sides
    of ``p * (n - 1)``. Two histograms; the second reads the rows of the bins
    that hold a wanted rank."""
    rows = rows.where(F.col(value).isNotNull()).select(
        F.col(group).alias("g"), F.col(value).cast("bigint").alias("v"),
        F.floor(F.col(value).cast("bigint") / F.lit(coarse)).cast("bigint").alias("bin"))
    every = Window.partitionBy("g")
    hist = rows.groupBy("g", "bin").agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("total", F.sum("n").over(every)) \
        .withColumn("before", F.sum("n").over(every.orderBy("bin")) - F.col("n"))

    def ranks(p: float) -> list:
        at = F.lit(p) * (F.col("total") - 1)
        low = F.floor(at)
        return [F.struct(F.lit(p).alias("p"), F.lit(side).alias("high"), rank.cast("bigint").alias("rank"), (at - low).alias("part"))
                for side, rank in ((0, low), (1, F.ceil(at)))]

    wanted = F.filter(F.array(*[r for p in probs for r in ranks(p)]),
                      lambda w: (w["rank"] >= F.col("before")) & (w["rank"] < F.col("before") + F.col("n")))
    asked = stored(hist.select("g", "bin", "before", F.explode(wanted).alias("w")), "profile-ranks")
    bins = asked.select(F.col("g").alias("ag"), F.col("bin").alias("ab"), "before").distinct()
    fine = rows.join(bins, F.col("g").eqNullSafe(F.col("ag")) & (F.col("bin") == F.col("ab"))).select("g", "bin", "before", "v")
    fine = fine.groupBy("g", "bin", "before", "v").agg(F.count(F.lit(1)).alias("n"))
    run = F.sum("n").over(Window.partitionBy("g", "bin").orderBy("v"))
    fine = fine.select(F.col("g").alias("fg"), F.col("bin").alias("fb"), "v", (F.col("before") + run).alias("upto"),
                       (F.col("before") + run - F.col("n")).alias("since"))
    found = asked.join(fine, F.col("g").eqNullSafe(F.col("fg")) & (F.col("bin") == F.col("fb"))
                       & (F.col("w.rank") >= F.col("since")) & (F.col("w.rank") < F.col("upto")))
    both = found.groupBy("g", F.col("w.p").alias("p"), F.col("w.part").alias("part")).agg(
        F.max(F.when(F.col("w.high") == 0, F.col("v"))).alias("lo"), F.max(F.when(F.col("w.high") == 1, F.col("v"))).alias("hi"))
    return both.select(F.col("g").alias(group), "p",
                       (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part")).alias("value"))


def profile(rows: DataFrame, group: str, value: str, probs: Sequence[float], band: tuple[int, int]) -> DataFrame:
    """Per group: entries, least and greatest value, the quantiles as ``p50``
    and so on, and the share of entries inside the closed ``band``."""
    rows = stored(rows.select(group, F.col(value).cast("bigint").alias(value)), "profile-values")
    low, high = band
    plain = rows.groupBy(group).agg(
        F.count(value).alias("entries"), F.min(value).alias("least"), F.max(value).alias("greatest"),
        F.avg(F.when(F.col(value).isNotNull(), F.col(value).between(low, high).cast("int"))).alias("in_band"))
    q = quantiles(rows, group, value, probs)
    wide = q.groupBy(F.col(group).alias("_g")).agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(_name(p)) for p in probs])
    return plain.join(wide, F.col(group).eqNullSafe(F.col("_g")), "left").drop("_g")


def _name(p: float) -> str:
    return "p" + f"{p * 100:g}".replace(".", "_")


def bins(rows: DataFrame, group: str, value: str, width: int) -> DataFrame:
    """Rows ``(group, bin, entries)``: how many values lie in ``[bin, bin + width)``."""
    low = (F.floor(F.col(value) / F.lit(width)) * width).cast("bigint")
    return rows.where(F.col(value).isNotNull()).groupBy(group, low.alias("bin")).agg(F.count(F.lit(1)).alias("entries"))


def sketches(rows: DataFrame, file_columns: Sequence[str], value: str, k: int = SKETCH_K) -> DataFrame:
    """One sketch for each file: ``file_columns, sketch``."""
    return rows.groupBy(*file_columns).agg(F.kll_sketch_agg_bigint(F.col(value).cast("bigint"), k).alias("sketch"))


def merged(parts: DataFrame, group: str, probs: Sequence[float], k: int = SKETCH_K) -> DataFrame:
    """Rows ``(group, entries, p, value)`` from the sketches of the group's files;
    no row of the corpus is read."""
    whole = parts.groupBy(group).agg(F.kll_merge_agg_bigint("sketch", k).alias("sketch"))
    each = F.array(*[F.struct(F.lit(float(p)).alias("p"), F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(p))).alias("value"))
                     for p in probs])
    return whole.select(group, F.kll_sketch_get_n_bigint("sketch").alias("entries"), F.explode(each).alias("q")) \
        .select(group, "entries", "q.p", "q.value")


def rank_error(rows: DataFrame, group: str, value: str, quantile_rows: DataFrame) -> DataFrame:
    """``quantile_rows(group, p, value)`` with ``error``: how far ``p`` is from the
    ranks, as shares, that the value really takes. One aggregation of the rows
    against the few quantiles of their group."""
    each = quantile_rows.groupBy(F.col(group).alias("_g")).agg(F.collect_set(F.struct("p", F.col("value").alias("q"))).alias("qs"))
    pairs = rows.select(group, F.col(value).alias("_v")).join(each, F.col(group).eqNullSafe(F.col("_g"))) \
        .select(group, "_v", F.explode("qs").alias("q"))
    ranks = pairs.groupBy(group, F.col("q.p").alias("p"), F.col("q.q").alias("value")).agg(
        F.avg((F.col("_v") < F.col("q.q")).cast("int")).alias("low"), F.avg((F.col("_v") <= F.col("q.q")).cast("int")).alias("high"))
    return ranks.withColumn("error", F.greatest(F.col("low") - F.col("p"), F.col("p") - F.col("high"), F.lit(0.0)))


def sketch_bound(k: int = SKETCH_K) -> float:
    """The rank error of a sketch that is exceeded about once in a hundred."""
    return 2.296 / math.pow(k, 0.9723)

"""Diversity audit: which combinations of the dimensions are present, which of
the possible ones are missing, and how evenly the entries are spread.

The entries of every position are counted first; one aggregation with grouping
sets sums them up to the cells of every dimension and of every pair. Possible cells are the positions of the grid; missing
ones are found by an anti-join.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import checkpointed


def lattice(sizes: Mapping[str, int]) -> list[tuple[str, ...]]:
    """Every dimension and every pair of dimensions."""
    return [c for n in (1, 2) for c in combinations(sizes, n)]


def _label(dims: tuple[str, ...]) -> str:
    return "+".join(dims)


def cells(rows: DataFrame, sizes: Mapping[str, int]) -> DataFrame:
    """Rows ``(dims, <dimensions>, n)``: the cells that are present; a dimension
    that is not in ``dims`` is -1. ``rows`` has a position for each dimension."""
    names = list(sizes)
    sets = lattice(sizes)
    # every position is counted once before the grouping sets repeat the rows
    counted = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    grouped = counted.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in names]) \
        .agg(F.sum("n").alias("n"), F.grouping_id(*names).alias("gid"))
    gids = {sum(1 << (len(names) - 1 - i) for i, c in enumerate(names) if c not in s): _label(s) for s in sets}
    pairs = [x for g, label in gids.items() for x in (F.lit(g).cast("bigint"), F.lit(label))]
    return grouped.select(F.element_at(F.create_map(*pairs), F.col("gid")).alias("dims"),
                          *[F.coalesce(F.col(c), F.lit(-1)).cast("int").alias(c) for c in names], "n")


def possible(spark, sizes: Mapping[str, int]) -> DataFrame:
    """Rows ``(dims, <dimensions>)``: every cell of the lattice's grids, decoded
    from a range of numbers."""
    parts = []
    for dims in lattice(sizes):
        total = reduce(lambda a, c: a * sizes[c], dims, 1)
        ids, stride, at = spark.range(total), 1, {}
        for c in dims:
            at[c] = (F.call_function("div", F.col("id"), F.lit(stride).cast("bigint")) % sizes[c]).cast("int")
            stride *= sizes[c]
        parts.append(ids.select(F.lit(_label(dims)).alias("dims"),
                                *[(at[c] if c in at else F.lit(-1)).alias(c) for c in sizes]))
    return reduce(DataFrame.unionByName, parts)


def missing(present: DataFrame, sizes: Mapping[str, int]) -> DataFrame:
    """The possible cells that are not present. ``present`` should be stored: the
    anti-join is pushed into each part of the possible cells and reads it there."""
    a, b = possible(present.sparkSession, sizes).alias("a"), present.alias("b")
    same = reduce(lambda x, c: x & (F.col(f"a.{c}") == F.col(f"b.{c}")), sizes, F.col("a.dims") == F.col("b.dims"))
    return a.join(b, same, "left_anti")


def audit(rows: DataFrame, sizes: Mapping[str, int]) -> DataFrame:
    """Rows ``(dims, entries, present, possible, missing, entropy, evenness)``. The
    entropy of the entries over the present cells is in bits; evenness is its
    share of the greatest that the possible cells allow."""
    present = checkpointed(cells(rows, sizes))
    summed = present.groupBy("dims").agg(
        F.sum("n").alias("entries"), F.count(F.lit(1)).alias("present"), F.sum(F.col("n") * F.log2(F.col("n"))).alias("s"))
    lost = missing(present, sizes).groupBy("dims").agg(F.count(F.lit(1)).alias("missing"))
    totals = [x for s in lattice(sizes) for x in (F.lit(_label(s)), F.lit(reduce(lambda a, c: a * sizes[c], s, 1)).cast("bigint"))]
    out = summed.join(F.broadcast(lost), "dims", "left").withColumn("possible", F.element_at(F.create_map(*totals), F.col("dims")))
    entropy = F.greatest(F.log2(F.col("entries")) - F.col("s") / F.col("entries"), F.lit(0.0))
    even = F.when(F.col("possible") > 1, entropy / F.log2(F.col("possible"))).otherwise(F.lit(1.0))
    return out.select("dims", "entries", "present", "possible", F.coalesce("missing", F.lit(0)).cast("bigint").alias("missing"),
                      F.round(entropy, 6).alias("entropy"), F.round(even, 6).alias("evenness"))

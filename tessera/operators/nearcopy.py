"""Near-copy audit: an exact set-similarity join of texts over word shingles.

Equal texts are one class, and classes are compared by the Jaccard similarity
of their shingle sets. Shingles are ordered by rarity over the corpus. Two sets
that reach the limit share one of the first shingles of either, as many as they
may differ in and one more, so only these prefixes are joined. Of the classes
that meet, sizes and the places of the meeting shingle rule most out before
any sets are compared; the others are compared whole. No group of candidates is
cut off, so the pairs are those of all against all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import stored

#: Words of a shingle, and the least similarity of a pair.
SHINGLE, SIMILARITY = 5, 0.8
#: Names of classes up to which they are broadcast.
BROADCAST_NAMES = 1_000_000


def shingles(text: Column, n: int = SHINGLE) -> Column:
    """The distinct hashes of the runs of ``n`` words (split at ASCII white space,
    lower case); of fewer words the whole run; none without a word."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")

    def hashed(w: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - n, F.lit(0))),
                           lambda i: F.xxhash64(F.array_join(F.slice(w, i + 1, F.lit(n)), " ")))
        return F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(F.array_distinct(runs))
    return F.get(F.transform(F.array(words), hashed), F.lit(0))


def members(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Rows ``(key, class)``: the smallest key with the same text (null texts are
    empty; null keys stand before all others)."""
    rows = texts.select(F.col(key), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("_t"))
    least = rows.groupBy("_t").agg(F.min(key).alias("class"))
    return rows.join(least, "_t").select(key, "class")


def near_copies(texts: DataFrame, key: str, text: str, similarity: float = SIMILARITY, n: int = SHINGLE) -> DataFrame:
    """Rows ``(a, b, shared, similarity)`` with ``a < b``: the pairs of classes whose
    texts differ and whose shingle sets reach ``similarity``. Texts without a
    word are in no pair. ``key`` must not be null for texts that are to be in one."""
    bare = texts.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t")).where(F.col("id").isNotNull())
    first = bare.groupBy(F.md5("t").alias("h")).agg(F.min("id").alias("id"), F.first("t").alias("t"))
    sets = first.select("id", shingles(F.col("t"), n).alias("s")).where(F.size("s") > 0)
    sets = stored(sets.select("id", F.size("s").alias("n"), "s"), "near-sets")
    # counted and joined where it lies: both read this one exchange (the filter is
    # what a later join would infer on one side only)
    held = sets.select("id", F.explode("s").alias("s")).where("id is not null and s is not null").repartition("s")
    rarity = held.groupBy("s").agg(F.count(F.lit(1)).alias("df"), F.min("id").alias("lo"), F.max("id").alias("hi")) \
        .where("lo < hi").select("s", "df")
    held = held.join(rarity, "s")
    # a shingle that one text has alone comes first in any order by rarity and
    # meets nothing: it takes a place of the prefix and is not joined
    ranked = held.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("df", "s"))).alias("r")) \
        .join(sets.select("id", "n"), "id")
    alone = F.col("n") - F.size("r")
    length = F.col("n") - F.ceil(F.col("n") * F.lit(similarity) - F.lit(1e-9)).cast("int") + 1
    prefix = ranked.select("id", "n", F.posexplode(F.slice("r", F.lit(1), F.greatest(length - alone, F.lit(0)))).alias("p", "x"),
                           alone.alias("alone"))
    prefix = stored(prefix.select("id", "n", F.col("x.s").alias("s"), (F.col("alone") + F.col("p")).alias("p")), "near-prefixes")
    x, y = prefix.alias("x"), prefix.alias("y")
    nx, ny = F.col("x.n"), F.col("y.n")
    needed = F.ceil((nx + ny) * F.lit(similarity / (1 + similarity)) - F.lit(1e-9))
    possible = F.least(nx - F.col("x.p"), ny - F.col("y.p"))  # what may be shared from the meeting place on
    met = x.join(y, (F.col("x.s") == F.col("y.s")) & (F.col("x.id") < F.col("y.id"))
                 & (F.least(nx, ny) >= F.greatest(nx, ny) * F.lit(similarity) - F.lit(1e-9)) & (possible >= needed))
    pairs = stored(met.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct(), "near-pairs")
    # the sets of the classes that a pair names, the others stay where they are
    named = stored(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "near-named")
    if named.count() <= BROADCAST_NAMES:
        named = F.broadcast(named)
    few = sets.join(named, "id", "left_semi")
    both = pairs.join(few.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a") \
        .join(few.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    counted = both.select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("shared"), (F.size("sa") + F.size("sb")).alias("total"))
    alike = F.col("shared") / (F.col("total") - F.col("shared"))
    return counted.where(F.col("shared") >= F.lit(similarity) * (F.col("total") - F.col("shared")) - F.lit(1e-9)) \
        .select("a", "b", "shared", alike.alias("similarity"))

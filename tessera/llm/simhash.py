"""SimHash near-duplicates with pigeonring filtering.

``fingerprints`` computes 64-bit SimHashes of word shingles; ``components_of``
links fingerprints at few differing bits and labels the components.

Candidate search. The 64 bits stand as eight bytes on a ring. If two
fingerprints differ in at most three bits, some start on the ring has all its
chains within the proportional budget: the first l bytes from it differ in at
most floor(3 l / 8) bits, that is 0, 0, 1, 1, 1, 2, 2, 3 for l = 1..8. So the
first two bytes agree, and of the next three, with at most one difference, at
least one 12-bit half agrees: 28 bits to meet on, for 8 starts and 2 halves.
Every meeting is pruned by the chain budgets before the full Hamming check.

Groups. Distinct fingerprints only are compared, so exact copies cost one row.
In each meeting group all members are first held against the group's smallest
fingerprint (a star, linear in the group). Only groups that still hold several
components are searched for links between different components, and there on
9 further bits: of the other 36 bits at most 3 differ, so one of their four
9-bit parts agrees.
Nothing is dropped at any size: the components are those of all links.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.components import components
from tessera.llm.util import cut, stored

RING, BITS = 8, 3
#: Differences allowed in the first l bytes of a chain, l = 1..8.
BUDGET = tuple(BITS * n // RING for n in range(1, RING + 1))
CHUNK = 1 << 16


def simhash(text: str | None, shingle: int = 3) -> int:
    """Signed 64-bit SimHash of one text: A-Z lower-cased, words split at
    ASCII white space, shingles space-joined, repeats counted, XXH64 seed 42.
    A bit is set if more than half of the hashes have it. Fewer words than a
    shingle make one shingle; no words (or null) give zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    if len(words) <= shingle:
        first, last = [0], [len(joined)]
    else:
        last = ends[shingle - 1:].tolist()
        first = [0, *(ends[:len(words) - shingle] + 1).tolist()]
    h64, bits = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, len(first), CHUNK):
        h = np.array([h64(joined[a:b], 42) for a, b in zip(first[i:i + CHUNK], last[i:i + CHUNK])],
                     dtype="<u8")
        bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") \
            .sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(bits * 2 > len(first), bitorder="little")
    return int(set_bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Rows ``(doc_id, text_md5, fp)``, one for each row of ``docs``; other
    columns are not read. ``text_md5`` tells apart rows that share an id
    (null text: null)."""
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, shingle) for t in texts], dtype="int64")

    return docs.select(F.col(id_col).alias("doc_id"), F.md5(text_col).alias("text_md5"),
                       fp(text_col).alias("fp"))


def _turned(fp: Column, start: int) -> Column:
    """The ring read from byte ``start`` (from the most significant)."""
    n = 8 * start
    return fp if not n else F.shiftleft(fp, n).bitwiseOR(F.shiftrightunsigned(fp, 64 - n))


def _field(c: Column, offset: int, width: int) -> Column:
    """``width`` bits of a 64-bit value, ``offset`` bits from its top."""
    return F.shiftrightunsigned(c, 64 - offset - width).bitwiseAND(F.lit((1 << width) - 1))


def _meetings(fps: DataFrame) -> DataFrame:
    """``fps`` with a meeting key for each start and half: 4 bits that name
    them, then the 28 bits that agree."""
    keys = [F.lit((2 * s + half) << 28).bitwiseOR(F.shiftleft(_field(r, 0, 16), 12))
            .bitwiseOR(_field(r, 16 + 12 * half, 12))
            for s in range(RING) for r in [_turned(F.col("fp"), s)] for half in (0, 1)]
    return fps.withColumn("key", F.explode(F.array(*keys)))


def _differing(x: Column) -> Column:
    return F.bit_count(x)


def _within(a: Column, b: Column, key: Column) -> Column:
    """The chain budgets from the start that the key names, then the full
    Hamming check."""
    diff = a.bitwiseXOR(b)
    start = F.shiftright(key, 29)
    ok = F.lit(False)
    for s in range(RING):
        turned = _turned(diff, s)
        chain = F.lit(True)
        for n, most in enumerate(BUDGET[:-1], 1):
            if n == RING or BUDGET[n] != most:  # the longest chain of each budget
                chain = chain & (_differing(_field(turned, 0, 8 * n)) <= most)
        ok = F.when(start == s, chain).otherwise(ok) if s else F.when(start == 0, chain) \
            .otherwise(F.lit(False))
    return ok & (_differing(diff) <= BITS)


def _refined(rows: DataFrame) -> DataFrame:
    """Every row once for each of the four 9-bit parts of the 36 bits that its
    key leaves open."""
    start, half = F.shiftright("key", 29), F.shiftright("key", 28).bitwiseAND(F.lit(1))
    turned = F.lit(0).cast("long")
    for s in range(RING):
        turned = F.when(start == s, _turned(F.col("fp"), s)).otherwise(turned)
    rows = rows.withColumn("_t", turned).withColumn(
        "_rest", F.shiftleft(F.when(half == 0, _field(F.col("_t"), 28, 12))
                             .otherwise(_field(F.col("_t"), 16, 12)), 24)
        .bitwiseOR(_field(F.col("_t"), 40, 24)))
    subkeys = [F.lit(i << 9).bitwiseOR(F.shiftrightunsigned("_rest", 27 - 9 * i)
                                       .bitwiseAND(F.lit(511))) for i in range(4)]
    return rows.withColumn("sub", F.explode(F.array(*subkeys))).drop("_t", "_rest")


def linked(fps: DataFrame) -> DataFrame:
    """Rows ``(node, root)`` of the fingerprints ``fps(fp)`` that have a link;
    a fingerprint without one is not listed."""
    rows = _meetings(fps.select("fp").where("fp is not null").distinct())
    groups = rows.groupBy("key").agg(F.min("fp").alias("least"), F.max("fp").alias("most")) \
        .where("least < most").select("key", "least")
    rows = cut(rows.join(groups, "key"))  # only fingerprints that meet another
    stars = rows.where("fp > least").where(_within(F.col("fp"), F.col("least"), F.col("key"))) \
        .select(F.col("least").alias("a"), F.col("fp").alias("b")).distinct()
    stars = cut(stars)
    first = components(stars)
    rows = rows.select("key", "fp").join(first.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("key", "fp", F.coalesce("root", "fp").alias("root"))
    mixed = rows.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")) \
        .where("lo < hi").select("key")
    rows = _refined(cut(rows.join(mixed, "key", "left_semi")))
    x, y = rows.alias("x"), rows.alias("y")
    across = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.sub") == F.col("y.sub"))
                    & (F.col("x.root") < F.col("y.root"))
                    & _within(F.col("x.fp"), F.col("y.fp"), F.col("x.key"))) \
        .select(F.least("x.fp", "y.fp").alias("a"), F.greatest("x.fp", "y.fp").alias("b")).distinct()
    across = cut(across)
    return components(stars.unionByName(across)) if across.take(1) else first


def components_of(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Rows ``(doc_id, text_md5, fp, component_id)``, one for each row of
    ``docs``. ``component_id`` is the smallest id of the component.

    Null and empty texts have fingerprint zero and are linked like any other;
    null ids take part but never name a component (null if all ids are null);
    repeated rows each come back; an empty table gives an empty result.
    """
    rows = stored(fingerprints(docs, shingle, id_col, text_col), "simhash")
    ids = rows.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    roots = cut(linked(ids))
    named = ids.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    names = named.join(roots.select("root").distinct(), "root", "left_semi") \
        .groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = named.join(names, "root", "left") \
        .select("fp", F.coalesce("component_id", "least_id").alias("component_id"))
    return rows.join(named, "fp").select("doc_id", "text_md5", "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_per_component(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, of
    these the smallest text digest; exact repeats of it count once. Columns
    stay as they are."""
    from pyspark.sql import Window
    found = components_of(docs, shingle)
    kept = found.groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_md5")).alias("k"))
    kept = kept.select(F.col("k.doc_id").alias("_keep_id"), F.col("k.text_md5").alias("_keep_md5"))
    held = docs.withColumn("_row_md5", F.md5("text"))
    held = held.join(kept, held["doc_id"].eqNullSafe(kept["_keep_id"])
                     & held["_row_md5"].eqNullSafe(kept["_keep_md5"]), "left_semi")
    nth = F.row_number().over(Window.partitionBy("doc_id", "_row_md5").orderBy(F.lit(1)))
    return held.withColumn("_nth", nth).where("_nth = 1").select(*docs.columns)

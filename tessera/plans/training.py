"""Queries that prepare a corpus for training: packing, mixture sampling, byte
shards, length profiles, the near-copy audit of answers and the diversity audit
of a generation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.radix import decode
from tessera.operators import diversity, mixture, nearcopy, pack, profile
from tessera.plans import synthesis
from tessera.session import checkpointed, stored
from tessera.sources.tables import table

#: Tokens of a training sequence, and shards of the packing.
PACK_BUDGET, PACK_SHARDS = 4096, 16
#: Token weights of a mixture by language.
MIXTURE = {"en": 4, "de": 2, "es": 1, "fr": 1}
BYTE_SHARDS = 16
PROBS = (0.05, 0.25, 0.5, 0.75, 0.95, 0.99)
#: Tokens that an entry is claimed to have.
BAND = (600, 900)
BIN_WIDTH = 128


def _tokens(c: str = "text"):
    return F.call_function("div", F.coalesce(F.length(c), F.lit(0)).cast("bigint"), F.lit(4).cast("bigint"))


def pack_sequences(spark: SparkSession, root: str) -> DataFrame:
    """Every document in one training sequence of its shard."""
    d = table(spark, root, "documents", "doc_id", "text").select("doc_id", _tokens().alias("tokens"))
    return pack.pack(d, "doc_id", "tokens", PACK_BUDGET, PACK_SHARDS)


def mixture_sample(spark: SparkSession, root: str) -> DataFrame:
    """A sample of the documents whose tokens are shared out by ``MIXTURE``."""
    d = table(spark, root, "documents", "doc_id", "lang", "text").select("doc_id", "lang", _tokens().alias("t"))
    return mixture.mixture(d, "lang", "doc_id", F.col("t"), MIXTURE).select("doc_id", "lang", "bucket", "tokens")


def byte_shards(spark: SparkSession, root: str) -> DataFrame:
    """Every document in one of ``BYTE_SHARDS`` shards of near-equal bytes."""
    d = table(spark, root, "documents", "doc_id", "text").select("doc_id", F.octet_length("text").alias("bytes"))
    return mixture.byte_shards(d, "doc_id", F.col("bytes"), BYTE_SHARDS).select("doc_id", "bucket", "shard")


def _lengths(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents", "lang", "source", "text").select(
        F.col("lang").alias("skill"), F.col("source").alias("subtopic"), _tokens().alias("tokens"))


def length_profile(spark: SparkSession, root: str) -> DataFrame:
    """Exact token quantiles of each language, and the share in the band."""
    return profile.profile(_lengths(spark, root), "skill", "tokens", PROBS, BAND)


def length_bins(spark: SparkSession, root: str) -> DataFrame:
    return profile.bins(_lengths(spark, root), "skill", "tokens", BIN_WIDTH)


def length_sketch(spark: SparkSession, root: str) -> DataFrame:
    """Quantiles of each language from the stored sketches of its files; a value
    itself is approximate, so what is reported is whether its true rank is
    within the error that the sketches promise, doubled for their merging."""
    rows = stored(_lengths(spark, root), "sketch-lengths")
    parts = stored(profile.sketches(rows, ["skill", "subtopic"], "tokens"), "length-sketches")
    found = stored(profile.merged(parts, "skill", PROBS), "sketch-quantiles")
    checked = profile.rank_error(rows, "skill", "tokens", found)
    within = F.col("error") <= 2 * profile.sketch_bound()
    return found.join(checked, ["skill", "p", "value"]).select("skill", "p", "entries", within.alias("within"))


def near_copy_members(spark: SparkSession, root: str) -> DataFrame:
    """The class of equal answers that each document's answer is in."""
    return nearcopy.members(table(spark, root, "documents", "doc_id", "text"), "doc_id", "text")


def near_copy_pairs(spark: SparkSession, root: str) -> DataFrame:
    """The classes of answers that are near copies of each other."""
    found = nearcopy.near_copies(table(spark, root, "documents", "doc_id", "text"), "doc_id", "text")
    return found.select("a", "b", "shared", F.round("similarity", 6).alias("similarity"))


def _generated(spark: SparkSession, root: str):
    """Positions of the kept entries of the customers' corpus, and the grid's sizes."""
    grid = synthesis.grid(spark, root)
    sizes = dict(zip(("audience", "perspective", "fmt", "template"), grid.radices))
    kept = synthesis.first_wins_kept(spark, root, synthesis.groups(spark, root), grid)
    return kept.select(*[d.alias(c) for c, d in zip(sizes, decode(F.col("idx"), grid.radices))]), sizes


def diversity_audit(spark: SparkSession, root: str) -> DataFrame:
    """Cells of the generator's dimensions and pairs that the kept entries hold,
    against the possible ones, and their entropy."""
    return diversity.audit(*_generated(spark, root))


def diversity_missing(spark: SparkSession, root: str) -> DataFrame:
    """The cells that no kept entry holds."""
    rows, sizes = _generated(spark, root)
    return diversity.missing(checkpointed(diversity.cells(rows, sizes)), sizes)

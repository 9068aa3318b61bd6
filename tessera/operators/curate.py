"""Planning and curation over manifests and rows: a budget plan, the
reconciliation of two manifests, chat validation, a hash split, and the
removal of what an earlier release holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.model import GROUP_COLUMNS
from tessera.session import checkpointed, stored

KNOWN_ROLES = ("system", "user", "assistant")
#: Groups of a plan up to which it is broadcast.
BROADCAST_GROUPS = 100_000


def running_total(df: DataFrame, value: str, order: Sequence[Column], name: str) -> DataFrame:
    """``name`` = the sum of ``value`` over the rows up to each one in the
    total ``order``, without a window over all rows: range partitions are
    stored once, summed inside, and shifted by the sums of those before."""
    ranged = checkpointed(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    local = F.sum(value).over(Window.partitionBy("_part").orderBy(*order)
                              .rowsBetween(Window.unboundedPreceding, 0))
    sums = ranged.groupBy("_part").agg(F.sum(value).alias("_s"))
    before = sums.select("_part", (F.sum("_s").over(Window.orderBy("_part")) - F.col("_s")).alias("_before"))
    return ranged.withColumn("_local", local).join(F.broadcast(before), "_part") \
        .select(*df.columns, (F.col("_before") + F.col("_local")).cast("bigint").alias(name))


def _planned(manifest: DataFrame) -> DataFrame:
    order = [F.col("approx_tokens").desc(), F.col("file")]
    return running_total(manifest, "approx_tokens", order, "running_tokens")


def token_budget(manifest: DataFrame, budget: int) -> DataFrame:
    """The manifest rows, largest first, whose tokens fit the budget together,
    with their ``running_tokens``."""
    return _planned(manifest).where(F.col("running_tokens") <= budget)


def load_planned(corpus: DataFrame, manifest: DataFrame, budget: int) -> DataFrame:
    """The rows of a corpus partitioned by group that a budget plan over its
    manifest loads. The plan is a stored table with a filter, so that its groups
    prune the partitions of the corpus when the query runs; it is broadcast up
    to ``BROADCAST_GROUPS`` groups, beyond which the join shuffles and reads all."""
    plan = stored(_planned(manifest), "budget-plan")
    chosen = plan.where(F.col("running_tokens") <= budget).select(*GROUP_COLUMNS)
    chosen = F.broadcast(chosen) if plan.count() <= BROADCAST_GROUPS else chosen
    return corpus.join(chosen, list(GROUP_COLUMNS))


def reconcile(stored: DataFrame, computed: DataFrame) -> DataFrame:
    """Each group of either manifest with ``status``: ``same``, ``changed``,
    ``missing`` (stored only) or ``extra`` (computed only); the measures of the
    side that lacks the group are zero."""
    measures = ("entries", "bytes", "approx_tokens")
    a, b = stored.alias("a"), computed.alias("b")
    both = a.join(b, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in GROUP_COLUMNS], "full")
    equal = F.lit(True)
    for m in measures:
        equal = equal & F.col(f"a.{m}").eqNullSafe(F.col(f"b.{m}"))
    status = F.when(F.col("b.entries").isNull(), "missing").when(F.col("a.entries").isNull(), "extra") \
        .when(equal, "same").otherwise("changed")
    return both.select(*[F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in GROUP_COLUMNS],
                       status.alias("status"),
                       *[F.coalesce(f"a.{m}", F.lit(0)).cast("bigint").alias(f"stored_{m}") for m in measures],
                       *[F.coalesce(f"b.{m}", F.lit(0)).cast("bigint").alias(f"computed_{m}") for m in measures])


def chat_rules(messages: Column) -> dict[str, Column]:
    """The rules of a chat entry, each true if it holds: known roles, an
    optional system message and then a user message first, user and assistant
    in turn, an assistant message last, no empty content."""
    roles = F.transform(messages, lambda m: m["role"])
    talk = F.when(F.get(roles, 0) == "system", F.slice(roles, 2, F.greatest(F.size(roles) - 1, F.lit(0)))) \
        .otherwise(roles)
    in_turn = F.forall(F.transform(talk, lambda r, i: r == F.when(i % 2 == 0, "user").otherwise("assistant")),
                       lambda ok: ok)
    rules = {
        "known_roles": F.forall(roles, lambda r: r.isin(*KNOWN_ROLES)),
        "starts_user": F.get(talk, 0) == "user",
        "alternates": in_turn,
        "ends_assistant": F.get(roles, F.size(roles) - 1) == "assistant",
        "no_empty": F.forall(messages, lambda m: F.coalesce(F.trim(m["content"]), F.lit("")) != ""),
    }
    return {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}


def chat_valid(messages: Column) -> Column:
    """Whether every rule of a chat entry holds."""
    valid = F.lit(True)
    for rule in chat_rules(messages).values():
        valid = valid & rule
    return valid


def hash_bucket(key: Column, buckets: int = 100) -> Column:
    """A stable bucket of a key from the first 24 bits of its MD5."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 6), 16, 10).cast("bigint") % buckets


def not_released(rows: DataFrame, release: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in an earlier release (an anti-join on its
    distinct keys)."""
    return rows.join(release.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")

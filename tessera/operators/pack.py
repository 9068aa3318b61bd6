"""Sequence packing: entries laid end to end into training sequences.

Entries are dealt to shards by the MD5 of their key, and inside a shard they
lie in the order of that hash, so a packing depends on keys and lengths only.
The position of an entry is the sum of the lengths before it in its shard. The
sums are segmented prefix sums: ranges of (shard, hash) are sorted and summed
by themselves, in one pass that carries the sum from batch to batch, and a
shard that goes on over several ranges adds what the ranges before it hold. So
neither a shard nor a range is a window of rows, and the number of shards does
not bound the parallelism.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.curate import hash_bucket
from tessera.session import stored

# The summing pass runs in Python workers; see operators.dedup.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DEFAULT_BUDGET = 4096
DEFAULT_SHARDS = 64


def _running(batches: Iterator[pa.RecordBatch], segment: int, value: int) -> Iterator[pa.RecordBatch]:
    """Each batch with the number of the range and the sum of ``value`` up to
    each row inside its segment; the last segment and its sum go on."""
    part, last, carried = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        seg, x = batch.column(segment).to_numpy(), batch.column(value).to_numpy()
        sums = np.cumsum(x)
        starts = np.concatenate([[seg[0] != last], seg[1:] != seg[:-1]])
        first = np.maximum.accumulate(np.where(starts, np.arange(len(seg)), -1))
        before = np.where(first < 0, -carried, sums[first] - x[first])
        sums = sums - before
        last, carried = seg[-1], int(sums[-1])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(seg), part, np.int32)), pa.array(sums.astype(np.int64))],
            names=[*batch.schema.names, "_range", "_sum"])


def segmented_sums(rows: DataFrame, segment: str, order: Sequence[str], value: str, name: str) -> DataFrame:
    """``rows`` with ``name`` = the sum of ``value`` over the rows of the same
    ``segment`` up to and with each one in ``order``. ``segment`` is a whole number
    and ``value`` a BIGINT, both without nulls; rows that are equal in ``order``
    are numbered in any order."""
    ranged = rows.repartitionByRange(segment, *order).sortWithinPartitions(segment, *order)
    at, what = rows.columns.index(segment), rows.columns.index(value)
    schema = T.StructType([*rows.schema.fields, T.StructField("_range", T.IntegerType()), T.StructField("_sum", T.LongType())])
    summed = stored(ranged.mapInArrow(lambda batches: _running(batches, at, what), schema), "segmented-sums")
    # a range holds a run of segments, so these are as many rows as there are
    # ranges and segments together
    totals = summed.groupBy(segment, "_range").agg(F.sum(value).alias("_t"))
    before = F.sum("_t").over(Window.partitionBy(segment).orderBy("_range")) - F.col("_t")
    offsets = totals.select(F.col(segment).alias("_segment"), F.col("_range").alias("_r"), before.alias("_before")).where("_before > 0")
    out = summed.join(F.broadcast(offsets), (summed[segment] == offsets["_segment"]) & (summed["_range"] == offsets["_r"]), "left")
    return out.select(*rows.columns, (F.col("_sum") + F.coalesce("_before", F.lit(0))).cast("bigint").alias(name))


def pack(entries: DataFrame, key: str, tokens: str, budget: int = DEFAULT_BUDGET,
         shards: int = DEFAULT_SHARDS) -> DataFrame:
    """``entries(key, tokens)`` with ``shard``, ``pack`` (its number in the shard) and
    ``start`` (where the entry begins in the pack).

    An entry belongs to the pack in which it begins, so every entry is in one
    pack, whole, and a pack's load stays below the budget plus its last entry.
    Null tokens count as zero; null keys are one key, before all others."""
    if budget <= 0 or shards <= 0:
        raise ValueError("budget and shards must be positive")
    rows = entries.select(F.col(key).alias("key"), F.coalesce(F.col(tokens), F.lit(0)).cast("bigint").alias("tokens"),
                          F.coalesce(hash_bucket(F.col(key), shards), F.lit(0)).cast("int").alias("shard"),
                          F.coalesce(F.md5(F.col(key).cast("string")), F.lit("")).alias("hash"))
    laid = segmented_sums(rows, "shard", ["hash", "key", "tokens"], "tokens", "end")
    begin = F.col("end") - F.col("tokens")
    number = F.call_function("div", begin, F.lit(budget).cast("bigint"))
    return laid.select(F.col("key").alias(key), "tokens", "shard", number.alias("pack"), (begin % budget).alias("start"))


def pack_loads(packed: DataFrame) -> DataFrame:
    """Per pack: entries, tokens, and the tokens of its last entry."""
    return packed.groupBy("shard", "pack").agg(
        F.count(F.lit(1)).alias("entries"), F.sum("tokens").alias("load"),
        F.max_by("tokens", F.struct("start", "tokens")).alias("last"))

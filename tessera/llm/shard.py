"""Sharding by a two-pass external shuffle.

Pass one scatters the records uniformly into buckets that fit in memory, by
seeded hashes. Pass two shuffles each bucket by Fisher-Yates and writes it.
A shard is a run of whole buckets; the slot of a record is the number of
records in the shard's buckets before its own, plus its place in the bucket.

The shard of a record follows the ``key`` law: the id and the number of
shards decide, by the highest of one seeded hash for each shard. One more
shard takes over exactly the records whose new hash is the highest.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tessera.llm.util import cut, fresh, shared_root

SHARDS, SEED = 16, 42
#: Text bytes of a bucket, on average: what one task shuffles in memory.
BUCKET_BYTES = 16 << 20
#: Buckets up to which their offsets are broadcast.
BROADCAST_BUCKETS = 200_000


def size_of(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus one."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def shard_of(doc_id: Column, shards: int, seed: int = SEED) -> Column:
    """The shard whose seeded hash of the id is the highest; null ids are
    treated as one id."""
    each = [F.struct(F.xxhash64(F.lit(seed), F.lit(s), doc_id).alias("h"), F.lit(s).alias("s"))
            for s in range(shards)]
    return (each[0] if shards == 1 else F.greatest(*each))["s"]


def _bucket(doc_id: Column, text: Column, buckets: int, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed + 1), doc_id, F.crc32(F.coalesce(text, F.lit("")))),
                  F.lit(buckets)).cast("int")


def names_of(columns: list[str]) -> tuple[str, str, str]:
    """The columns that shards add, ``_shard``, ``_bucket`` and ``_place``, with more
    underscores where records have a column of the name."""
    taken = {c.lower() for c in columns}

    def free(name: str) -> str:
        return free("_" + name) if name in taken else name
    return free("_shard"), free("_bucket"), free("_place")


def write_shards(docs: DataFrame, path: str | None = None, shards: int = SHARDS, seed: int = SEED,
                 bucket_bytes: int = BUCKET_BYTES, id_col: str = "doc_id",
                 text_col: str = "text") -> str:
    """Shuffle ``docs`` into ``path/_shard=N`` and return the path (a new one
    in the shared folder if none is given). All columns are kept; added are
    ``_bucket`` and ``_place`` (see :func:`names_of`).

    The same rows give the same files whatever their order: a bucket is put in
    the order of its ids and texts before it is shuffled. Null ids count as
    one id, null texts stay null, repeated rows keep a slot each, an empty
    table writes no rows. Copies of a text are spread by their ids.
    """
    spark = docs.sparkSession
    path = path or f"{shared_root(spark)}/shards-{uuid.uuid4().hex[:12]}"
    total = docs.agg(F.sum(size_of(F.col(text_col)))).first()[0] or 0
    buckets = max(1, math.ceil(total / (shards * bucket_bytes)))
    in_shard, in_bucket, in_place = names_of(docs.columns)
    rows = docs.select("*", shard_of(F.col(id_col), shards, seed).alias(in_shard),
                       _bucket(F.col(id_col), F.col(text_col), buckets, seed).alias(in_bucket))
    schema = StructType([*rows.schema.fields, StructField(in_place, LongType())])
    names = rows.columns

    def shuffled(key: tuple, bucket: pa.Table) -> pa.Table:
        columns = [(id_col, "ascending"), (text_col, "ascending")]
        bucket = bucket.take(pa.compute.sort_indices(bucket, sort_keys=columns))
        rng = np.random.Generator(np.random.PCG64([seed, key[0].as_py(), key[1].as_py()]))
        places = rng.permutation(bucket.num_rows)  # numpy's permutation is a Fisher-Yates shuffle
        out = bucket.take(pa.array(places)).select(names)
        return out.append_column(in_place, pa.array(np.arange(bucket.num_rows), pa.int64()))

    rows = rows.repartition(shards * buckets, in_shard, in_bucket)  # as many tasks as buckets
    rows.groupBy(in_shard, in_bucket).applyInArrow(shuffled, schema) \
        .write.partitionBy(in_shard).parquet(path)
    return path


def read_shards(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The written records, with the columns of ``schema`` (those of the
    documents), ``_shard``, ``_bucket`` and ``_place`` (see :func:`names_of`)."""
    in_shard, in_bucket, in_place = names_of(schema.names)
    return spark.read.schema(StructType([
        *schema.fields, StructField(in_bucket, IntegerType()), StructField(in_place, LongType()),
        StructField(in_shard, IntegerType())])).parquet(path)


def with_slots(rows: DataFrame, names: tuple[str, str, str] = ("_shard", "_bucket", "_place")) -> DataFrame:
    """Written records with their slot, gapless from 0 in each shard, as ``_slot``
    in place of bucket and place. The offsets are one row for each bucket,
    broadcast up to a bound; select what is needed before, since beyond the
    bound the rows are shuffled."""
    in_shard, in_bucket, in_place = names
    before_, slot = (fresh(rows, c) for c in ("_before", "_slot"))
    sizes = rows.groupBy(in_shard, in_bucket).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(in_shard).orderBy(in_bucket)) - F.col("_n")
    offsets = cut(sizes.select(in_shard, in_bucket, before.alias(before_)))
    offsets = F.broadcast(offsets) if offsets.count() <= BROADCAST_BUCKETS else offsets
    return rows.join(offsets, [in_shard, in_bucket]) \
        .withColumn(slot, (F.col(before_) + F.col(in_place)).cast("bigint")) \
        .drop(in_bucket, in_place, before_)

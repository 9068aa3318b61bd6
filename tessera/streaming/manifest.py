"""Incremental manifest over files as they arrive (Structured Streaming).

A file stream feeds a stateful aggregation on the group columns that keeps
``entries, bytes, chars`` per group in the state store. The stream runs in
``update`` mode: each micro-batch emits only the groups it changed, and
``foreachBatch`` writes them to a folder named by the batch id
(overwritten when a batch is replayed after a failure, so replays are
idempotent). The manifest is the latest row of each group across those
folders, so no batch rewrites the groups it did not touch. Every
``COMPACT_EVERY`` batches the latest rows so far are written as one
``compact=N`` folder, from which reads start. Tokens are
derived from the summed characters only when the manifest is read,
because floors do not add.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.manifest import MANIFEST_COLUMNS, _finish
from tessera.session import use_rocksdb


COMPACT_EVERY = 32


def run_manifest_stream(spark: SparkSession, source: DataFrame, group: tuple[str, str],
                        chars: Column, nbytes: Column, snapshot_path: str, checkpoint: str) -> None:
    """Run the stream until every available file is processed."""
    agg = source.groupBy(*group).agg(
        F.count(F.lit(1)).alias("entries"),
        F.sum(nbytes.cast("bigint")).alias("bytes"),
        F.sum(chars.cast("bigint")).alias("chars"))

    def write_changes(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{snapshot_path}/batch={batch_id}")
        if (batch_id + 1) % COMPACT_EVERY == 0:
            rows = _changes(batch.sparkSession, snapshot_path)
            latest = rows.groupBy(*group).agg(F.max_by(F.struct(
                "entries", "bytes", "chars", "batch"), F.col("batch")).alias("_m"))
            latest.select(*group, "_m.*").write.mode("overwrite") \
                .parquet(f"{snapshot_path}-compact/upto={batch_id}")

    use_rocksdb(spark)
    q = (agg.writeStream.outputMode("update").foreachBatch(write_changes)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def _changes(spark: SparkSession, snapshot_path: str) -> DataFrame:
    """Rows ``(group..., entries, bytes, chars, batch)``: those of the newest
    compact folder and of the batches after it."""
    parts = spark.read.parquet(snapshot_path)
    schema = T.StructType([f for f in parts.schema if f.name != "batch"]
                          + [T.StructField("batch", T.IntegerType()), T.StructField("upto", T.IntegerType())])
    compact = f"{snapshot_path}-compact"
    path = spark._jvm.org.apache.hadoop.fs.Path(compact)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return parts
    old = spark.read.schema(schema).parquet(compact)
    newest = old.agg(F.max("upto")).first()[0]
    if newest is None:
        return parts
    return parts.where(F.col("batch") > newest).unionByName(
        old.where(F.col("upto") == newest).drop("upto"))


def read_snapshot(spark: SparkSession, snapshot_path: str, group: tuple[str, str]) -> DataFrame:
    """The manifest: per group, the row of the latest batch that changed it
    (``max_by`` on the batch id, a partial aggregate)."""
    changes = _changes(spark, snapshot_path)
    latest = changes.groupBy(*group).agg(
        F.max_by(F.struct("entries", "bytes", "chars"), F.col("batch")).alias("_m"))
    renamed = latest.select(F.col(group[0]).alias("skill"), F.col(group[1]).alias("subtopic"),
                            "_m.entries", "_m.bytes", "_m.chars")
    return _finish(renamed, ("skill", "subtopic")).select(*MANIFEST_COLUMNS)


def parquet_stream(spark: SparkSession, folder: str, schema: T.StructType,
                   files_per_batch: int = 1) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
            .parquet(folder))


def table_stream(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    """A table of ``root`` as a stream of its Parquet files, whether it is one
    file or a folder of files."""
    return (spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", "true").option("maxBytesPerTrigger", str(64 << 30))
            .parquet(f"{root.rstrip('/')}/{name}.parque[t]"))

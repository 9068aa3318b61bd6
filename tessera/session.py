"""Spark session and shared-folder helpers.

Everything the library writes (streaming checkpoints, scratch corpora) goes
under the shared folder that the cluster names in ``spark.checkpoint.dir``.
Only when that is unset (local tests) do we create one of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tessera") -> SparkSession:
    """Create (or reuse) a session with the settings the library assumes."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    driver_mem = os.environ.get("TESSERA_DRIVER_MEMORY")
    if driver_mem:
        builder = builder.config("spark.driver.memory", driver_mem)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). When neither is set, only a session with a local master
    gets a folder of its own: on a cluster every executor would write to its
    own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder path under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` evaluated once and kept in the shared folder."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(checkpoint_root(spark))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back, so later
    plans know its size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def use_rocksdb(spark: SparkSession) -> None:
    """Streaming state goes to RocksDB, off the heap; a running query keeps
    the provider it started with."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)

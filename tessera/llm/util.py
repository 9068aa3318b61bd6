"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_GIVING = ContextVar("giving", default=False)
A_Z, LOWER_A_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    """Only A-Z become lower case; other letters stay as they are."""
    return F.translate(c, A_Z, LOWER_A_Z)


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``
    or the context's checkpoint folder. Only a session with a local master
    may fall back to a folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tessera-llm-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """``checkpoint()`` in the shared folder: cuts the lineage of a small or
    middle-sized frame that several later jobs read."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table of the shared folder and read it back:
    the columnar, compressed form of :func:`cut` for frames with texts."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = [path]
    return out


def together(frames: list[DataFrame]) -> DataFrame:
    """The rows of all ``stored`` frames, which are released as one."""
    out = reduce(DataFrame.unionByName, frames)
    out.stored_at = [path for frame in frames for path in frame.stored_at]
    return out


def deleted(*frames: DataFrame) -> None:
    """Delete the folders of :func:`stored` ``frames``, which nothing reads any more."""
    for frame in frames:
        spark = frame.sparkSession
        for path in map(spark._jvm.org.apache.hadoop.fs.Path, frame.stored_at):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def released(*frames: DataFrame) -> None:
    """The same inside :func:`given_back`; elsewhere they stay, to be looked at."""
    if _GIVING.get():
        deleted(*frames)


def slices(rows: DataFrame, key: str, n: int) -> list[DataFrame]:
    """The ``rows`` as ``n`` frames, dealt by ``key``: what is worked through one after
    the other takes the disk of one at a time."""
    return [rows.where(F.pmod(F.xxhash64(key), F.lit(n)) == i) for i in range(n)] if n > 1 else [rows]


@contextmanager
def given_back(spark: SparkSession):
    """Inside, the disk of ``released`` frames is free at once, and that of the shuffles of
    frames made inside as soon as these have been computed, not when the JVM next
    collects its garbage. A frame that is computed twice shuffles twice."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was, giving = spark.conf.get(key), _GIVING.set(True)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, was)
        _GIVING.reset(giving)


def bounded_sample(rows: DataFrame, key: str, n: int) -> DataFrame:
    """At most ``n`` of the (stored) ``rows``, those of the least hash of ``key``,
    which says nothing about them. Where there are many more, a bound on the
    hash that about ``2 * n`` rows pass goes first, so that the task that takes
    the ``n`` reads little, however many rows there are."""
    place = F.pmod(F.xxhash64(key), F.lit(2 ** 31 - 1))
    total = rows.count()
    if total > 4 * n:
        rows = rows.where(place < F.lit(int((2 ** 31 - 1) * (2 * n + 1000) / total)))
    return rows.orderBy(place, key).limit(n)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column
    (names are compared without case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name

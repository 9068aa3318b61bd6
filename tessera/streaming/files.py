"""Incremental manifest of a folder whose files come, change and go
(Structured Streaming).

Each look at the folder is compared with the look before it, and only files
that are new, changed or gone make a row of the change feed, with the sums of
their lines; unchanged files are not read. A stream over the feed keeps the
last sums of each file in the state store, by file, and gives what a change
adds to or takes from its group, so a changed file replaces its sums instead of
adding to them. Versions that are not newer than the one in the state change
nothing, so rows may come again or late; a file that is gone leaves its version
behind. The manifest is the sum of the changes by group.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessera.functions.chat import content_chars
from tessera.functions.text import file_name
from tessera.model import GROUP_COLUMNS
from tessera.operators.manifest import MANIFEST_COLUMNS, _finish
from tessera.session import stored, use_rocksdb
from tessera.sources.jsonl import list_files, scan_chat

# The state function runs in Python workers; see operators.dedup.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SUMS = ("entries", "bytes", "chars")
CHANGE = "file string, skill string, subtopic string, version long, deleted boolean, entries long, bytes long, chars long"
STATE = "version long, files long, entries long, bytes long, chars long"
DELTA = "skill string, subtopic string, files long, entries long, bytes long, chars long"


def look(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a flat corpus folder now: ``file, skill, subtopic, size, modified``."""
    files = list_files(spark, folder, times=True).where(~F.col("odd_name"))
    return stored(files.select(file_name(F.col("skill"), F.col("subtopic")).alias("file"), *GROUP_COLUMNS,
                               F.col("file_size").alias("size"), "modified"), "file-look")


def changes(spark: SparkSession, folder: str, now: DataFrame, before: DataFrame | None, version: int) -> DataFrame:
    """Rows of the change feed (``CHANGE``) between two looks. ``version`` grows from
    look to look. The names of changed files pass the driver, as any listing does."""
    if before is None:
        before = now.where("false")
    a, b = now.alias("a"), before.alias("b")
    differ = ~(F.col("a.size").eqNullSafe(F.col("b.size")) & F.col("a.modified").eqNullSafe(F.col("b.modified")))
    both = a.join(b, F.col("a.file") == F.col("b.file"), "full").where(differ)
    changed = stored(both.select(*[F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in ("file", *GROUP_COLUMNS)],
                                 F.col("a.file").isNull().alias("deleted"), F.coalesce("a.size", F.lit(0)).alias("bytes")), "file-changes")
    names = [r["file"] for r in changed.where("not deleted and bytes > 0").select("file").collect()]
    rows = changed.withColumn("version", F.lit(version).cast("bigint"))
    if not names:
        return rows.selectExpr("file", "skill", "subtopic", "version", "deleted", "0L entries", "bytes", "0L chars")
    paths = [folder.rstrip("/") + "/" + re.sub(r"([\\*?\[\]{}])", r"\\\1", n) for n in names]
    lines = scan_chat(spark, paths).where(F.col("messages").isNotNull() & F.col("_corrupt_record").isNull())
    sums = lines.groupBy(file_name(F.col("skill"), F.col("subtopic")).alias("file")).agg(
        F.count(F.lit(1)).alias("entries"), F.sum(content_chars("messages")).alias("chars"))
    zero = F.lit(0).cast("bigint")
    return rows.join(sums, "file", "left").select("file", *GROUP_COLUMNS, "version", "deleted", F.coalesce("entries", zero).alias("entries"),
                                                  "bytes", F.coalesce("chars", zero).alias("chars"))


def replace_sums(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """What the newest of a file's rows changes in its group, if it is newer than
    the state."""
    newest = None
    for batch in batches:
        row = batch.loc[batch["version"].idxmax()]
        newest = row if newest is None or row["version"] > newest["version"] else newest
    old = state.get if state.exists else (-1, 0, 0, 0, 0)
    if newest is None or newest["version"] <= old[0]:
        return
    sums = (0, 0, 0, 0) if newest["deleted"] else (1, *(int(newest[c]) for c in SUMS))
    state.update((int(newest["version"]), *sums))
    yield pd.DataFrame([(newest["skill"], newest["subtopic"], *(n - o for n, o in zip(sums, old[1:])))],
                       columns=["skill", "subtopic", "files", *SUMS])


def run_file_stream(spark: SparkSession, feed: str, deltas: str, checkpoint: str) -> None:
    """Take in every change of the feed (a folder of Parquet folders) that has
    not been taken in; a batch that runs again overwrites its own folder."""
    rows = spark.readStream.schema(CHANGE).option("recursiveFileLookup", "true").parquet(feed)
    taken = rows.groupBy("file").applyInPandasWithState(replace_sums, DELTA, STATE, "update", GroupStateTimeout.NoTimeout)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{deltas}/batch={batch_id}")

    use_rocksdb(spark)
    q = (taken.writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def read_file_manifest(spark: SparkSession, deltas: str) -> DataFrame:
    """The manifest of the files that are there."""
    summed = spark.read.parquet(deltas).groupBy(*GROUP_COLUMNS).agg(*[F.sum(c).alias(c) for c in ("files", *SUMS)])
    return _finish(summed.where("files > 0"), GROUP_COLUMNS).select(*MANIFEST_COLUMNS)

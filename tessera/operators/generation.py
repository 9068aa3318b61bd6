"""A generation that writes its corpus and reports what became of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tessera.model import GROUP_COLUMNS
from tessera.operators import dedup, synth
from tessera.sinks.jsonl import write_corpus
from tessera.sources.jsonl import list_files, scan_chat


def write_generation(groups: DataFrame, wanted: DataFrame, grid: synth.Grid, path: str) -> DataFrame:
    """Generate the wanted files ``(skill, subtopic)`` over one grid period (first
    seen wins), write them under ``path``, and return rows ``(measure, value)``:

    ``tried`` indices, ``failed`` ones (no record, a record that cannot fill an
    answer, or a template with an unknown placeholder), ``repeated`` and ``kept``
    ones, and the ``chars`` and ``bytes`` of what was kept, all observed inside the
    writing job, so nothing is generated or read a second time to be counted;
    then the ``scanned`` entries, ``files`` and ``file_bytes`` of what lies there. A
    task that has to run again after its stage had ended is observed again; the
    scan would then differ from the observation."""
    spark = groups.sparkSession
    tried, written = Observation("tried"), Observation("written")
    files = wanted.select(*GROUP_COLUMNS).distinct().join(groups, list(GROUP_COLUMNS), "left")
    keyed = synth.keyed_prompts(files, grid, 0, grid.period - 1).select(*GROUP_COLUMNS, "idx", "key") \
        .observe(tried, F.count(F.lit(1)).alias("tried"), F.count(F.when(F.col("key").isNull(), 1)).alias("failed"))
    kept = dedup.first_wins(keyed.where(F.col("key").isNotNull()), "key", "idx", scope=list(GROUP_COLUMNS))
    entries = synth.entries_at(groups, kept.select(*GROUP_COLUMNS, "idx"), grid).observe(
        written, F.count(F.lit(1)).alias("kept"), F.coalesce(F.sum("chars"), F.lit(0)).alias("chars"),
        F.coalesce(F.sum("line_bytes"), F.lit(0)).alias("bytes"))
    write_corpus(entries.select(*GROUP_COLUMNS, "line"), path)
    got = {**tried.get, **written.get}
    got["repeated"] = got["tried"] - got["failed"] - got["kept"]
    seen = spark.createDataFrame([(m, int(got[m])) for m in ("tried", "failed", "repeated", "kept", "chars", "bytes")],
                                 "measure string, value long")
    lying = list_files(spark, path, layout="hive").agg(
        F.countDistinct(*GROUP_COLUMNS).alias("files"), F.coalesce(F.sum("file_size"), F.lit(0)).alias("file_bytes"))
    scanned = scan_chat(spark, path, layout="hive").where(F.col("messages").isNotNull()) \
        .agg(F.count(F.lit(1)).alias("scanned"))
    both = [df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).alias("value")) for c in df.columns]))
                      .alias("r")).select("r.*") for df in (lying, scanned)]
    return seen.unionByName(both[0]).unionByName(both[1])

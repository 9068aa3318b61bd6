import json
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF001

from tessera.functions import nest
from tessera.operators import report, subset
from tessera.operators.manifest import (chat_manifest, file_manifest, line_audit, merge_manifests,
                                        odd_files)
from tessera.sinks import write_corpus, write_manifest
from tessera.sources import scan_chat, scan_chat_lines, scan_manifest
from tessera.sources.jsonl import list_files


def _entries(spark):
    rows = [("thinking", "a_b", "q1", "ans \"1\""), ("thinking", "a_b", "q2", "ans 2\n"),
            ("coding", "c_d", "q3", "ans — 3 😀"), ("other", "zz", "q4", "x")]
    df = spark.createDataFrame(rows, "skill string, subtopic string, u string, a string")
    return df.select("skill", "subtopic", nest(F.col("u"), F.col("a")).alias("messages"))


def test_sink_scan_round_trip(spark, tmp_dir):
    ent = _entries(spark)
    out = os.path.join(tmp_dir, "corpus")
    write_corpus(ent, out, files_per_group=2)
    scanned = scan_chat(spark, out, layout="hive")
    a = {r["file"]: tuple(r) for r in file_manifest(scanned).collect()}
    b = {r["file"]: tuple(r) for r in chat_manifest(ent).collect()}
    assert a == b  # physical file sizes equal the logical canonical size
    # a skill predicate becomes a partition filter
    plan = scanned.where("skill = 'coding'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(skill" in plan


def test_many_compressed_files_have_no_checksum_files_and_are_listed_in_few_tasks(spark, tmp_dir):
    rows = spark.range(80).select(F.lit("s").alias("skill"), F.col("id").cast("string").alias("subtopic"), F.lit('{"messages": []}').alias("line"))
    packed = os.path.join(tmp_dir, "packed")
    write_corpus(rows, packed, compression="gzip")
    names = [f for p, _, files in os.walk(os.path.join(packed, "skill=s")) for f in files]
    assert len(names) == 80 and all(f.endswith(".gz") for f in names)
    sc, key = spark.sparkContext, "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    conf = spark.conf.get(key)
    sc.setJobGroup("listing", "")
    scanned = scan_chat_lines(spark, packed, layout="hive")
    sc.setLocalProperty("spark.jobGroup.id", None)
    stages = [s for j in sc.statusTracker().getJobIdsForGroup("listing") for s in sc.statusTracker().getJobInfo(j).stageIds]
    tasks = [sc.statusTracker().getStageInfo(s).numTasks for s in stages]
    assert tasks and max(tasks) <= sc.defaultParallelism and spark.conf.get(key) == conf
    assert scanned.count() == 80


def test_compressed_corpus_has_the_same_manifest(spark, tmp_dir):
    ent = _entries(spark).unionByName(_entries(spark).crossJoin(spark.range(200)).drop("id"))
    plain, packed = os.path.join(tmp_dir, "plain"), os.path.join(tmp_dir, "packed")
    write_corpus(ent, plain)
    write_corpus(ent, packed, compression="gzip")
    a = {r["file"]: tuple(r) for r in file_manifest(scan_chat(spark, plain, layout="hive"), list_files(spark, plain, layout="hive")).collect()}
    b = {r["file"]: tuple(r) for r in file_manifest(scan_chat_lines(spark, packed, layout="hive"), list_files(spark, packed, layout="hive")).collect()}
    assert a == b
    lying = [list_files(spark, p, layout="hive").agg(F.sum("file_size")).first()[0] for p in (plain, packed)]
    assert 10 * lying[1] < lying[0]


def test_flat_layout_skips_index_and_odd_files(spark, tmp_dir):
    d = os.path.join(tmp_dir, "flat")
    os.makedirs(d)
    line = json.dumps({"messages": [{"role": "user", "content": "u"},
                                    {"role": "assistant", "content": "abcdefgh"}]})
    with open(os.path.join(d, "thinking__x_y.jsonl"), "w") as f:
        f.write(line + "\n" + line + "\n\n{broken\n")
    with open(os.path.join(d, "noseparator.jsonl"), "w") as f:
        f.write(line + "\n")
    with open(os.path.join(d, "index.jsonl"), "w") as f:
        f.write('{"file": "x", "entries": 1}\n')
    m = file_manifest(scan_chat(spark, d)).collect()
    assert len(m) == 1 and m[0]["file"] == "thinking__x_y.jsonl" and m[0]["entries"] == 2
    assert m[0]["bytes"] == os.path.getsize(os.path.join(d, "thinking__x_y.jsonl"))
    assert m[0]["approx_tokens"] == (2 * 9) // 4
    audit = line_audit(scan_chat_lines(spark, d)).collect()
    assert (audit[0]["lines"], audit[0]["blank_lines"], audit[0]["broken_lines"]) == (4, 1, 1)


def test_manifest_sink_and_scan(spark, tmp_dir):
    m = report.ranked(chat_manifest(_entries(spark)))
    out = os.path.join(tmp_dir, "index.jsonl")
    write_manifest(m, out)
    back = scan_manifest(spark, out).collect()
    assert sorted(r["skill"] for r in back) == ["coding", "other", "thinking"]
    # part files in name order hold the lines in rank order, unknown last
    parts = sorted(f for f in os.listdir(out) if f.startswith("part-"))
    lines = [ln for f in parts for ln in open(os.path.join(out, f)).read().splitlines()]
    assert [json.loads(ln)["skill"] for ln in lines] == ["thinking", "coding", "other"]
    assert lines[0] == json.dumps(json.loads(lines[0]))


def test_reports(spark):
    m = chat_manifest(_entries(spark))
    ranks = {r["skill"]: r["rank"] for r in report.ranked(m).collect()}
    assert ranks == {"thinking": 0, "coding": 4, "other": 99}
    rep = {r["skill"]: r for r in report.fixed_order_report(m).collect()}
    assert set(rep) == {"thinking", "reasoning", "speaking", "understanding", "coding"}
    assert rep["reasoning"]["files"] == 0 and rep["reasoning"]["approx_tokens"] == 0
    cov = {r["skill"]: r for r in report.coverage_table(m).collect()}
    tot = report.totals(m).first()
    assert cov["Total"]["entries"] == tot["entries"] == 4
    assert cov["Total"]["approx_tokens"] == tot["approx_tokens"]
    merged = merge_manifests(m, m).collect()
    assert all(r["entries"] in (2, 4) for r in merged)


def test_subset_by_manifest(spark):
    ent = _entries(spark)
    chosen = chat_manifest(ent).where("entries >= 2")
    assert {r["skill"] for r in subset.by_manifest(ent, chosen).collect()} == {"thinking"}


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_global_position_of_wide_rows(spark, adaptive):
    """300,000 rows with a wide column over many ranges: none lost, each with
    the place that row_number() gives."""
    df = spark.range(300_000).selectExpr(
        "int(id % 6) rank", "concat('sub', xxhash64(id)) subtopic", "concat('s', id) skill",
        "repeat(cast(id as string), 40) wide").repartition(7)
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        out = report.global_position(df, ["rank", "subtopic", "skill"], "position")
        nth = F.row_number().over(Window.orderBy("rank", "subtopic", "skill"))
        got = out.withColumn("nth", nth).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("nth") != F.col("position")).alias("wrong")).first()
        assert (got["n"], got["wrong"]) == (300_000, 0)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_listing_counts_empty_and_odd_files(spark, tmp_dir):
    d = os.path.join(tmp_dir, "flat")
    os.makedirs(d)
    line = json.dumps({"messages": [{"role": "user", "content": "u"}, {"role": "assistant", "content": "abcdefgh"}]})
    for name, text in (("thinking__x_y.jsonl", line + "\n"), ("thinking__empty.jsonl", ""),
                       ("noseparator.jsonl", line + "\n"), ("index.jsonl", "{}\n")):
        with open(os.path.join(d, name), "w") as f:
            f.write(text)
    files = list_files(spark, d)
    got = {r["file"]: (r["entries"], r["bytes"], r["approx_tokens"])
           for r in file_manifest(scan_chat(spark, d), files).collect()}
    assert got == {"thinking__x_y.jsonl": (1, len(line) + 1, 2), "thinking__empty.jsonl": (0, 0, 0)}
    assert tuple(odd_files(files).first()) == (3, 1, 1)
    audit = {r["subtopic"]: r["lines"] for r in line_audit(scan_chat_lines(spark, d), files).collect()}
    assert audit == {"x_y": 1, "empty": 0}


def test_streams_over_several_batches_equal_one(spark, tmp_dir, monkeypatch):
    from tessera.streaming import manifest as M
    from tessera.streaming import parquet_stream, read_snapshot, read_survivors, run_dedup_stream
    monkeypatch.setattr(M, "COMPACT_EVERY", 2)
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "lang", "source", "text")
    folder, snap = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "snap")
    docs.repartition(5).write.parquet(folder)
    M.run_manifest_stream(spark, parquet_stream(spark, folder, docs.schema), ("lang", "source"),
                          F.length("text"), F.octet_length("text"), snap, os.path.join(tmp_dir, "c1"))
    assert len([x for x in os.listdir(snap) if x.startswith("batch=")]) >= 5
    assert len(os.listdir(snap + "-compact")) >= 2
    one = docs.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("entries"), F.sum(F.length("text")).alias("c"))
    assert {(r["skill"], r["subtopic"], r["entries"], r["approx_tokens"])
            for r in read_snapshot(spark, snap, ("lang", "source")).collect()} == \
        {(r["lang"], r["source"], r["entries"], r["c"] // 4) for r in one.collect()}
    keyed = parquet_stream(spark, folder, docs.schema).select("lang", F.md5("text").alias("k"))
    run_dedup_stream(spark, keyed, ["lang", "k"], os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "c2"))
    got = [(r["lang"], r["k"]) for r in read_survivors(spark, os.path.join(tmp_dir, "out")).collect()]
    want = {(r["lang"], r["k"]) for r in docs.select("lang", F.md5("text").alias("k")).collect()}
    assert len(got) == len(want) and set(got) == want


def test_running_total_and_budget(spark):
    from tessera.operators import curate
    rows = [(f"f{i}", (i * 37) % 50) for i in range(500)]
    df = spark.createDataFrame(rows, "file string, approx_tokens long").repartition(6)
    got = [tuple(r) for r in curate.token_budget(df, 4000).orderBy("running_tokens", "file")
           .select("file", "approx_tokens", "running_tokens").collect()]
    total, want = 0, []
    for f, t in sorted(rows, key=lambda r: (-r[1], r[0])):
        total += t
        if total <= 4000:
            want.append((f, t, total))
    assert sorted(got) == sorted(want)


def test_chat_rules(spark):
    from tessera.operators import curate
    cases = [(["system", "user", "assistant"], True), (["user", "assistant"], True), (["assistant", "user"], False),
             (["user", "user", "assistant"], False), (["user"], False), ([], False), (["system"], False),
             (["user", "bot"], False)]
    df = spark.createDataFrame([(i, [(r, "x") for r in roles]) for i, (roles, _) in enumerate(cases)]
                               + [(99, [("user", " "), ("assistant", None)])],
                               "i int, messages array<struct<role:string,content:string>>")
    rules = curate.chat_rules(F.col("messages"))
    valid = F.lit(True)
    for r in rules.values():
        valid = valid & r
    got = {r["i"]: r["v"] for r in df.select("i", valid.alias("v")).collect()}
    assert got == {**{i: v for i, (_, v) in enumerate(cases)}, 99: False}


def test_incremental_manifest_reads_latest_change(spark, tmp_dir):
    from tessera.streaming import read_snapshot
    snap = os.path.join(tmp_dir, "snap")
    schema = "lang string, source string, entries long, bytes long, chars long"
    # batch 0 sees both groups; batch 1 changes only ("en", "a"); batch 1 is
    # then replayed (overwritten) with the same content
    spark.createDataFrame([("en", "a", 1, 10, 7), ("de", "b", 2, 20, 9)], schema) \
        .write.parquet(f"{snap}/batch=0")
    for _ in range(2):
        spark.createDataFrame([("en", "a", 3, 30, 21)], schema) \
            .write.mode("overwrite").parquet(f"{snap}/batch=1")
    got = {r["skill"]: r for r in read_snapshot(spark, snap, ("lang", "source")).collect()}
    assert (got["en"]["entries"], got["en"]["bytes"], got["en"]["approx_tokens"]) == (3, 30, 5)
    assert (got["de"]["entries"], got["de"]["bytes"], got["de"]["approx_tokens"]) == (2, 20, 2)

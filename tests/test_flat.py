"""The flat layout: files of many shares, empty and odd files, replays and
failures of the writer; generation counts; loads that prune partitions."""
import json
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tessera.functions.chat import nest
from tessera.operators import curate
from tessera.operators.manifest import file_manifest, line_audit, odd_files
from tessera.plans import synthesis
from tessera.sinks import flat
from tessera.sources.jsonl import list_files, scan_chat, scan_chat_lines


def corpus(spark, n=400):
    rows = [("hot" if i % 3 else f"s{i % 4}", "a__b" if i % 2 else "é x", i, f"q {i}", "antwort ü " * (i % 17)) for i in range(n)]
    df = spark.createDataFrame(rows, "skill string, subtopic string, idx long, q string, a string").repartition(5)
    return rows, df.select("skill", "subtopic", "idx", nest("q", "a").alias("messages"))


def line(q, a):
    return json.dumps({"messages": [{"role": "user", "content": q}, {"role": "assistant", "content": a}]}, ensure_ascii=False)


@pytest.mark.parametrize("share_bytes", [1 << 30, 900])
def test_files_hold_their_lines_whatever_the_shares(spark, tmp_dir, share_bytes):
    rows, entries = corpus(spark)
    flat.write_flat(entries, tmp_dir + "/c", order=["idx"], share_bytes=share_bytes)
    want = {}
    for s, t, i, q, a in rows:
        want.setdefault(f"{s}__{t}.jsonl", []).append((i, line(q, a)))
    assert sorted(os.listdir(tmp_dir + "/c")) == sorted(want)
    for name, lines in want.items():
        got = open(f"{tmp_dir}/c/{name}", encoding="utf-8").read()
        assert got.endswith("\n") and sorted(got[:-1].split("\n")) == sorted(x for _, x in lines)
        if share_bytes > 900:
            assert got[:-1].split("\n") == [x for _, x in sorted(lines)]
    found = file_manifest(scan_chat(spark, tmp_dir + "/c"), list_files(spark, tmp_dir + "/c")).collect()
    assert {(r["file"], r["entries"]) for r in found} == {(n, len(v)) for n, v in want.items()}


def test_modes_empty_files_and_the_manifest(spark, tmp_dir):
    at = tmp_dir + "/c"
    lines = lambda rows: spark.createDataFrame(rows, "file string, line string")
    flat.write_flat_lines(lines([("a__x.jsonl", "1"), ("b__x.jsonl", "2"), ("e__x.jsonl", None), ("odd.jsonl", "3")]), at)
    open(at + "/index.jsonl", "w").write("kept\n")
    audit = odd_files(list_files(spark, at)).first()
    assert (audit["files"], audit["empty_files"], audit["odd_files"]) == (4, 1, 1)
    flat.write_flat_lines(lines([("a__x.jsonl", "9"), ("n__x.jsonl", "8")]), "file://" + at, mode="append")
    assert sorted(os.listdir(at)) == ["a__x.jsonl", "b__x.jsonl", "e__x.jsonl", "index.jsonl", "n__x.jsonl", "odd.jsonl"]
    assert open(at + "/a__x.jsonl").read() == "9\n"
    flat.write_flat_lines(lines([("z__x.jsonl", "7")]), at)
    assert sorted(os.listdir(at)) == ["index.jsonl", "z__x.jsonl"]
    flat.write_flat_lines(lines([]), at, mode="append")
    assert sorted(os.listdir(at)) == ["index.jsonl", "z__x.jsonl"]


def test_a_task_that_runs_twice_and_a_commit_that_misses_bytes(tmp_dir):
    writer = flat.FlatWriter(tmp_dir, "s", True)
    batch = pa.RecordBatch.from_pydict({"file": ["a", "a", "b"], "at": [0, 0, 0], "line": ["x", "yy", None]})
    later = pa.RecordBatch.from_pydict({"file": ["a"], "at": [5], "line": ["z"]})
    first = writer.write(iter([batch]))
    again, rest = writer.write(iter([batch])), writer.write(iter([later]))
    assert first.files == again.files == {"a": 5, "b": 0} and rest.files == {"a": 2}
    writer.commit([again, None, rest])
    assert open(f"{tmp_dir}/a").read() == "x\nyy\nz\n" and open(f"{tmp_dir}/b").read() == "" and sorted(os.listdir(tmp_dir)) == ["a", "b"]
    broken = flat.FlatWriter(tmp_dir, "t", True)
    message = broken.write(iter([batch]))
    message.files["a"] += 1
    with pytest.raises(OSError):
        broken.commit([message])
    broken.abort([message])
    assert sorted(os.listdir(tmp_dir)) == ["a", "b"] and open(f"{tmp_dir}/a").read() == "x\nyy\nz\n"


def test_names_and_stores_that_are_refused(tmp_dir):
    with pytest.raises(ValueError):
        flat.local_folder("s3a://bucket/x")
    assert flat.local_folder("file:///a%20b") == "/a b" and flat.local_folder("/a%20b") == "/a%20b"
    with pytest.raises(ValueError):
        flat.FlatWriter(tmp_dir, "s", False).write(iter([pa.RecordBatch.from_pydict({"file": ["../x"], "at": [0], "line": ["x"]})]))


def test_lines_of_every_sort_are_counted(spark, tmp_dir):
    ok, turned = line("q", "a"), '{"messages": [{"role": "assistant", "content": "a"}]}'
    rows = [("a__x.jsonl", v) for v in (ok, ok, turned, "{cut", "", "   ", "[1]", '{"other": 1}')] + [("e__x.jsonl", None)]
    flat.write_flat_lines(spark.createDataFrame(rows, "file string, line string"), tmp_dir + "/c")
    got = line_audit(scan_chat_lines(spark, tmp_dir + "/c"), list_files(spark, tmp_dir + "/c"), curate.chat_valid(F.col("entry.messages")))
    found = {r["skill"]: (r["lines"], r["blank_lines"], r["broken_lines"], r["valid_entries"]) for r in got.collect()}
    assert found == {"a": (8, 2, 3, 2), "e": (0, 0, 0, 0)}


def test_observed_counts_equal_the_scan(spark):
    got = {r["measure"]: r["value"] for r in synthesis.generation_result(spark, SF001).collect()}
    assert got["kept"] == got["scanned"] and got["bytes"] == got["file_bytes"]
    assert got["tried"] == got["failed"] + got["repeated"] + got["kept"] and got["failed"] > 0 < got["repeated"]


def test_a_plan_prunes_the_partitions_it_does_not_load(spark, tmp_dir):
    rows = [(f"s{i % 5}", f"t{i % 20}", "x" * (i % 20 + 1)) for i in range(2000)]
    spark.createDataFrame(rows, "skill string, subtopic string, text string").write.partitionBy("skill", "subtopic").parquet(tmp_dir + "/p")
    whole = spark.read.schema("text string, skill string, subtopic string").parquet(tmp_dir + "/p")
    manifest = whole.groupBy("skill", "subtopic").agg(F.sum(F.length("text")).alias("approx_tokens")) \
        .withColumn("file", F.concat_ws("__", "skill", "subtopic"))
    loaded = curate.load_planned(whole, manifest, 5000)
    by_file = sorted(((-r["approx_tokens"], r["file"]) for r in manifest.collect()))
    want, run = set(), 0
    for t, f in by_file:
        run -= t
        if run <= 5000:
            want.add(f)
    assert {f"{r['skill']}__{r['subtopic']}" for r in loaded.collect()} == want
    plan = loaded._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()

"""The manifest of a folder whose files come, change and go, over many looks."""
import os
import random

import pandas as pd

from tessera.operators.manifest import MANIFEST_COLUMNS, file_manifest
from tessera.sources.jsonl import list_files, scan_chat
from tessera.streaming import changes, look, read_file_manifest, run_file_stream
from tessera.streaming.files import CHANGE, replace_sums


def test_every_look_equals_the_manifest_of_the_folder(spark, tmp_dir):
    rnd = random.Random(3)
    folder, feed, deltas, ckpt = (f"{tmp_dir}/{n}" for n in ("corpus", "feed", "deltas", "ckpt"))
    os.makedirs(folder)
    line = lambda n: '{"messages": [{"role": "user", "content": "%s"}]}\n' % ("é" * n)
    write = lambda name, n: open(f"{folder}/{name}", "w").write("".join(line(rnd.randint(1, 30)) for _ in range(n)))
    before, read = None, []
    for version, step in enumerate([
            lambda: [write(f"s{i % 3}__t{i} +x.jsonl", i) for i in range(9)],
            lambda: None,
            lambda: [write("s1__t1 +x.jsonl", 40), os.remove(f"{folder}/s2__t2 +x.jsonl"), write("new__t.jsonl", 3)],
            lambda: [write("s1__t1 +x.jsonl", 2), write("s2__t2 +x.jsonl", 5), os.remove(f"{folder}/new__t.jsonl")]]):
        step()
        now = look(spark, folder)
        found = changes(spark, folder, now, before, version)
        read.append(found.count())
        found.write.parquet(f"{feed}/v{version}")
        run_file_stream(spark, feed, deltas, ckpt)
        want = file_manifest(scan_chat(spark, folder), list_files(spark, folder)).select(*MANIFEST_COLUMNS)
        assert sorted(map(tuple, read_file_manifest(spark, deltas).collect())) == sorted(map(tuple, want.collect()))
        before = now
    assert read == [9, 0, 3, 3]
    # the same rows again, in another folder of the feed, change nothing
    was = sorted(map(tuple, read_file_manifest(spark, deltas).collect()))
    spark.read.schema(CHANGE).parquet(f"{feed}/v2").write.parquet(f"{feed}/again")
    run_file_stream(spark, feed, deltas, ckpt)
    assert sorted(map(tuple, read_file_manifest(spark, deltas).collect())) == was


class State:
    def __init__(self):
        self.value, self.exists = None, False

    @property
    def get(self):
        return self.value

    def update(self, value):
        self.value, self.exists = value, True


def test_late_and_repeated_versions():
    state = State()

    def take(*rows):
        frame = pd.DataFrame([("f", "s", "t", *r) for r in rows], columns=[c.split()[0] for c in CHANGE.split(", ")])
        return [tuple(r) for df in replace_sums(("f",), iter([frame]), state) for r in df.itertuples(index=False)]
    assert take((2, False, 5, 50, 40), (1, False, 9, 90, 80)) == [("s", "t", 1, 5, 50, 40)]
    assert take((2, False, 5, 50, 40)) == [] == take((1, False, 7, 7, 7))
    assert take((4, True, 0, 0, 0)) == [("s", "t", -1, -5, -50, -40)]
    assert take((3, False, 6, 6, 6)) == []
    assert take((5, False, 1, 2, 3)) == [("s", "t", 1, 1, 2, 3)]

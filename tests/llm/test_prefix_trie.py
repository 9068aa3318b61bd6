"""Conversation trie against a plain dictionary of prefixes."""
import hashlib
import random
import zlib
from collections import defaultdict

from llm_help import SF01
from tessera.llm import prefix_trie as T

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    seqs = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        seqs[c] = own.get(base, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(seqs[c]) == len(p))))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def run(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in T.trie(df).collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows],
                                 "conv_id long, turn long, role string, text string, conv string, a int, depth int")


def test_equals_the_plain_trie_on_the_table(spark):
    df = spark.read.parquet(f"{SF01}/conversations.parquet")
    assert run(df) == plain([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_shared_prefixes_of_many_lengths(spark):
    rnd = random.Random(2)
    rows = []
    for c in range(-20, 120):
        n = rnd.choice([0, 1, 2, 3, 5, 8, 13, 40])
        rows += [(c, t, rnd.choice(["u", "a"]) if t > 3 else "u", rnd.choice(["hé", "x"]) if t % 7 == 6 else "same")
                 for t in range(n)]
    assert run(frame(spark, rows).repartition(5)) == plain(rows)


def test_copies_and_one_long_conversation(spark):
    rows = [(c, t, "u", f"turn {t}") for c in range(0, 3000, 5) for t in range(4)]  # one conversation again and again
    rows += [(7, t, "u", "on") for t in range(1500)]  # most of the rest in one
    got = run(frame(spark, rows).repartition(9))
    assert got == plain(rows)


def test_numbers_go_on_over_ranges(spark):
    rows = [(c, t, "u", str(t)) for c in (1, 2, 3) for t in range(2000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = frame(spark, rows).select(T.F.col("conv_id").alias("conv"), "turn", T.F.col("turn").alias("a"),
                                       T.F.lit(0).cast("long").alias("b"), T.F.lit(1).cast("long").alias("size"))
        got = T.numbered(df)
        assert got.where("pos <> a").count() == 0 and got.count() == len(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_nulls_ties_and_empty(spark):
    rows = [(1, None, None, None), (1, 0, "u", ""), (1, 3, "u", None), (None, 1, "u", "lost"), (2, 1, "u", "b"),
            (5, 0, "u", "a"), (5, 1, None, "b"), (5, 1, None, "b"), (6, 4, "u", "z" * 100_000), (8, None, "u", "q"), (11, 2, "u", "k")]
    assert run(frame(spark, rows)) == plain(rows)
    assert run(frame(spark, [])) == [] == run(frame(spark, [(None, 1, "u", "x")]))
    assert run(frame(spark, [(21, 0, "u", "x")])) == plain([(21, 0, "u", "x")])

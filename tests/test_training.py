"""Packing, mixture, byte shards, length profiles and the diversity audit
against plain computations, with hot groups, ties, nulls and empty tables."""
import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from tessera.operators import diversity, mixture, pack, profile


def md5(key):
    return hashlib.md5(str(key).encode()).hexdigest()


def entries(spark, rows, parts=7):
    return spark.createDataFrame(rows, "id long, tokens long").repartition(parts)


def plain_pack(rows, budget, shards):
    by_shard = defaultdict(list)
    for i, t in rows:
        by_shard[int(md5(i)[:6], 16) % shards if i is not None else 0].append((md5(i) if i is not None else "", -1 if i is None else i, t or 0))
    out = Counter()
    for s, mine in by_shard.items():
        at = 0
        for _, i, t in sorted(mine):
            out[(None if i == -1 else i, t, s, at // budget, at % budget)] += 1
            at += t
    return out


@pytest.mark.parametrize("shards", [1, 5])
def test_packing_equals_a_plain_walk(spark, shards):
    rnd = random.Random(1)
    rows = [(i, rnd.choice([0, 1, 7, 40, 130, None])) for i in range(3000)] + [(None, 5), (None, 5), (8, 3), (8, 3)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = pack.pack(entries(spark, rows), "id", "tokens", 100, shards).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert Counter((r["id"], r["tokens"], r["shard"], r["pack"], r["start"]) for r in got) == plain_pack(rows, 100, shards)


def test_loads_and_empty(spark):
    d = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", F.length("text").alias("n"))
    packed = pack.pack(d, "doc_id", "n", 2000, 4)
    assert packed.count() == packed.select("doc_id").distinct().count() == d.count()
    for r in pack.pack_loads(packed).collect():
        assert r["load"] < 2000 + r["last"] and r["load"] - r["last"] < 2000
    assert pack.pack(d.where("false"), "doc_id", "n").count() == 0
    with pytest.raises(ValueError):
        pack.pack(d, "doc_id", "n", 0)


def test_mixture_shares_are_within_a_bucket_of_the_target(spark):
    rnd = random.Random(2)
    rows = [(i, "hot" if i % 3 else rnd.choice(["a", "b", None]), rnd.randint(0, 9)) for i in range(20_000)]
    df = spark.createDataFrame(rows, "id long, g string, t long")
    weights = {"hot": 5, "a": 2}
    got = mixture.mixture(df, "g", "id", F.col("t"), weights).collect()
    tokens = Counter()
    for _, g, t in rows:
        tokens[g] += t
    unit = min(tokens[g] // w for g, w in weights.items())
    assert {r["g"] for r in got} == set(weights)
    for g, w in weights.items():
        mine = [r for r in got if r["g"] == g]
        kept, top = sum(r["tokens"] for r in mine), max(r["bucket"] for r in mine)
        after = sum(t for i, x, t in rows if x == g and int(md5(i)[:3], 16) == top + 1)
        assert kept <= unit * w and (kept + after > unit * w or top == mixture.BUCKETS - 1 or after == 0)
        assert len(mine) == sum(x == g and int(md5(i)[:3], 16) <= top for i, x, _ in rows)
    assert mixture.mixture(df, "g", "id", F.col("t"), {"hot": 1, "nowhere": 1}).count() == 0
    assert mixture.mixture(df.where("false"), "g", "id", F.col("t"), weights).count() == 0
    with pytest.raises(ValueError):
        mixture.mixture(df, "g", "id", F.col("t"), {"hot": 0})


def test_byte_shards_are_within_a_bucket_of_the_mean(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.randint(0, 5000)) for i in range(8000)] + [(None, 4), (5, None)]
    df = spark.createDataFrame(rows, "id long, s long")
    got = mixture.byte_shards(df, "id", F.col("s"), 7).collect()
    assert len(got) == len(rows)
    size, bucket = Counter(), Counter()
    shard_of = {}
    for r in got:
        size[r["shard"]] += r["s"] or 0
        bucket[r["bucket"]] += r["s"] or 0
        assert shard_of.setdefault(r["bucket"], r["shard"]) == r["shard"]
    assert sorted(size) == list(range(7))
    assert [shard_of[b] for b in sorted(shard_of)] == sorted(shard_of[b] for b in shard_of)
    mean = sum(size.values()) / 7
    assert all(abs(v - mean) <= max(bucket.values()) for v in size.values())
    assert mixture.byte_shards(df.where("false"), "id", F.col("s"), 7).count() == 0


def test_quantiles_equal_the_sorted_values(spark):
    rnd = random.Random(4)
    rows = [("hot", rnd.choice([3, 255, 256, 700])) for _ in range(4000)] + [("wide", rnd.randint(-9000, 10 ** 9)) for _ in range(501)] \
        + [("one", 42), (None, 7), (None, 9), ("gone", None)]
    df = spark.createDataFrame(rows, "g string, v long")
    probs = (0.0, 0.1, 0.5, 0.999, 1.0)
    got = {(r["g"], r["p"]): r["value"] for r in profile.quantiles(df, "g", "v", probs).collect()}
    for g in ("hot", "wide", "one", None):
        values = [v for x, v in rows if x == g and v is not None]
        for p in probs:
            assert math.isclose(got[(g, p)], float(np.quantile(values, p)), rel_tol=1e-12, abs_tol=1e-9)
    assert len(got) == 4 * len(probs)
    assert profile.quantiles(df.where("false"), "g", "v", probs).count() == 0
    whole = {r["g"]: r for r in profile.profile(df, "g", "v", (0.5,), (250, 260)).collect()}
    assert whole["hot"]["entries"] == 4000 and whole["gone"]["entries"] == 0 and whole["gone"]["p50"] is None
    assert math.isclose(whole["hot"]["in_band"], sum(v in (255, 256) for g, v in rows if g == "hot") / 4000)
    assert whole[None]["p50"] == 8.0


def test_merged_sketches_keep_their_rank_error(spark):
    rnd = random.Random(5)
    rows = [(f"g{i % 2}", f"f{rnd.randint(0, 30)}", int(rnd.lognormvariate(6, 1))) for i in range(60_000)]
    df = spark.createDataFrame(rows, "g string, f string, v long")
    parts = profile.sketches(df, ["g", "f"], "v")
    probs = [0.01, 0.25, 0.5, 0.9, 0.99]
    got = profile.rank_error(df, "g", "v", profile.merged(parts, "g", probs)).collect()
    assert len(got) == 10 and all(r["error"] <= profile.sketch_bound() for r in got)
    assert {r["entries"] for r in profile.merged(parts, "g", [0.5]).collect()} == {30_000}


def test_diversity_counts_cells_and_finds_the_missing(spark):
    sizes = {"a": 3, "b": 2, "c": 4}
    rnd = random.Random(6)
    rows = [(rnd.choice([0, 2]), rnd.randint(0, 1), rnd.choice([0, 0, 0, 3])) for _ in range(500)]
    df = spark.createDataFrame(rows, "a int, b int, c int")
    got = {r["dims"]: r for r in diversity.audit(df, sizes).collect()}
    assert set(got) == {"a", "b", "c", "a+b", "a+c", "b+c"}
    for dims, r in got.items():
        at = [list(sizes).index(d) for d in dims.split("+")]
        seen = Counter(tuple(row[i] for i in at) for row in rows)
        possible = math.prod(list(sizes.values())[i] for i in at)
        entropy = -sum(n / 500 * math.log2(n / 500) for n in seen.values())
        assert (r["entries"], r["present"], r["possible"], r["missing"]) == (500, len(seen), possible, possible - len(seen))
        assert abs(r["entropy"] - entropy) < 1e-5 and abs(r["evenness"] - entropy / math.log2(possible)) < 1e-5
    lost = {(r["dims"], r["a"], r["b"], r["c"]) for r in diversity.missing(diversity.cells(df, sizes), sizes).collect()}
    assert ("a", 1, -1, -1) in lost and ("b+c", -1, 1, 2) in lost and ("b", -1, 0, -1) not in lost


def test_cells_are_counted_before_the_grouping_sets(spark):
    df = spark.createDataFrame([(0, 1)] * 5 + [(2, None)], "a int, b int")
    got = diversity.cells(df, {"a": 3, "b": 2})
    assert sorted(tuple(r) for r in got.collect()) == [("a", 0, -1, 5), ("a", 2, -1, 1), ("a+b", 0, 1, 5), ("a+b", 2, -1, 1),
                                                       ("b", -1, -1, 1), ("b", -1, 1, 5)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan.split("Expand")[1]  # rows are not repeated for each set

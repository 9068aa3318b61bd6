"""Sharding: laws, order independence, real files, and edge cases."""
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

from llm_help import SF001, SF01, as_list, edge_docs, empty_docs  # noqa: F401
from tessera.llm import shard
from tessera.llm.queries import op9_shards


def slots(docs, **options):
    spark = docs.sparkSession
    return shard.with_slots(shard.read_shards(spark, shard.write_shards(docs, **options), docs.schema))


def test_slots_are_gapless_and_texts_whole(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = slots(docs, bucket_bytes=20_000).collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == \
        Counter((r["doc_id"], r["text"]) for r in docs.collect())
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r["_shard"]].append((r["_slot"], r["doc_id"]))
    assert len(by_shard) == 16
    for members in by_shard.values():
        members.sort()
        assert [s for s, _ in members] == list(range(len(members)))
        assert [d for _, d in members] != sorted(d for _, d in members)


def test_same_rows_same_slots_in_any_order(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    one = as_list(slots(docs, bucket_bytes=30_000), "doc_id", "_shard", "_slot")
    two = as_list(slots(docs.repartition(7).orderBy("text"), bucket_bytes=30_000), "doc_id", "_shard", "_slot")
    assert one == two
    other = as_list(slots(docs, seed=43), "doc_id", "_shard", "_slot")
    assert one != other


def test_key_law(spark):
    got = op9_shards(spark, SF01).toPandas()
    moved = got[got["shard"] != got["grown_shard"]]
    assert set(moved["grown_shard"]) == {16} and 0 < len(moved) < len(got) / 8
    assert set(got["shard"]) == set(range(16)) and set(got["law"]) == {"key"}


def test_edge_cases(edge_docs, empty_docs):
    rows = slots(edge_docs)
    assert set(edge_docs.columns) <= set(rows.columns)
    assert Counter((r["doc_id"], r["text"]) for r in rows.collect()) == \
        Counter((r["doc_id"], r["text"]) for r in edge_docs.collect())
    assert slots(empty_docs).count() == 0


def plain_hash(*values):
    h = 42
    for v, size in values:
        h = xxhash.xxh64(int(v).to_bytes(size, "little", signed=True), seed=h).intdigest()
    return h - 2 ** 64 if h >= 2 ** 63 else h


def plain_shard(doc_id, shards):
    return max((plain_hash((shard.SEED, 4), (s, 4), (doc_id, 8)), s) for s in range(shards))[1]


def test_query_equals_a_plain_model(spark):
    rows = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()
    size = {r["doc_id"]: len(r["text"].encode()) + 1 for r in rows}
    buckets = max(1, -(-sum(size.values()) // (shard.SHARDS * shard.BUCKET_BYTES)))
    held = defaultdict(list)
    for r in rows:
        crc = zlib.crc32(r["text"].encode())
        bucket = plain_hash((shard.SEED + 1, 4), (r["doc_id"], 8), (crc, 8)) % buckets
        held[plain_shard(r["doc_id"], shard.SHARDS), bucket].append((r["doc_id"], r["text"], crc))
    want, before = [], Counter()
    for (s, b), members in sorted(held.items()):
        order = np.random.Generator(np.random.PCG64([shard.SEED, s, b])).permutation(len(members))
        members.sort(key=lambda m: m[:2])
        want += [(i, size[i], crc, "key", s, before[s] + at, plain_shard(i, shard.SHARDS + 1))
                 for at, (i, _, crc) in enumerate(members[k] for k in order)]
        before[s] += len(members)
    columns = ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
    assert as_list(op9_shards(spark, SF01), *columns) == sorted(want)


def test_clashing_names(spark):
    docs = spark.createDataFrame([(i, f"t{i}", i, "x", 7) for i in range(50)],
                                 "doc_id long, text string, _bucket long, _SHARD string, _before int")
    names = shard.names_of(docs.columns)
    assert names == ("__shard", "__bucket", "_place")
    got = shard.with_slots(shard.read_shards(spark, shard.write_shards(docs), docs.schema), names)
    assert as_list(got, *docs.columns) == as_list(docs, *docs.columns)
    by_shard = defaultdict(list)
    for s, slot in as_list(got, "__shard", "_slot"):
        by_shard[s].append(slot)
    assert all(v == list(range(len(v))) for v in by_shard.values())

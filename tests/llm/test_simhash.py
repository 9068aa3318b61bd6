"""SimHash against brute force over all pairs, and edge cases."""
import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from llm_help import as_list, edge_docs, empty_docs  # noqa: F401
from tessera.llm import components, simhash


def plain_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    ws = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(ws[i:i + 3]) for i in range(len(ws) - 2)] if len(ws) > 2 else \
        [" ".join(ws)] if ws else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_matches_definition():
    for text in ("", None, "one", "One TWO", "a b c", "\u00c9t\u00c9 A\u00c9 b c d\x0be", "x y z " * 50):
        assert simhash.simhash(text) & (2 ** 64 - 1) == plain_fingerprint(text)


def test_links_equal_brute_force_in_dense_groups(spark):
    rnd = random.Random(1)
    fps = set()
    for _ in range(40):
        centre = rnd.getrandbits(64)
        for _ in range(rnd.choice([1, 2, 30, 60])):
            x = centre
            for _ in range(rnd.randint(0, 5)):
                x ^= 1 << rnd.randrange(64)
            fps.add(x)
    fps = sorted(x - 2 ** 64 if x >= 2 ** 63 else x for x in fps)
    a = np.array(fps, np.int64).view(np.uint64)
    label = list(range(len(fps)))
    for _ in range(len(fps)):
        before = list(label)
        for i in range(len(fps)):
            near = np.flatnonzero(np.bitwise_count(a ^ a[i]) <= 3)
            label[i] = min(label[j] for j in near)
        if label == before:
            break
    want = {fps[i]: fps[label[i]] for i in range(len(fps))
            if np.count_nonzero(np.bitwise_count(a ^ a[i]) <= 3) > 1}
    found = simhash.linked(spark.createDataFrame([(x,) for x in fps], "fp long"))
    assert dict(as_list(found, "node", "root")) == want


def test_edge_cases(edge_docs, empty_docs):
    got = simhash.components_of(edge_docs)
    rows = as_list(got, "doc_id", "component_id")
    assert len(rows) == edge_docs.count()
    component = {i: c for i, c in rows if i is not None}
    assert component[1] == component[2] == 1
    assert component[3] == component[4] == component[5] == 3
    assert component[9] == 9
    assert simhash.components_of(empty_docs).count() == 0
    hexes = got.select(simhash.hex_digits(F.col("fp")).alias("h")).distinct().collect()
    assert all(re.fullmatch("[0-9a-f]{16}", r["h"]) for r in hexes)


def test_one_per_component_keeps_columns_and_one_row(edge_docs):
    kept = simhash.one_per_component(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(ids) == sorted(set(ids)) and 1 in ids and 2 not in ids and 4 not in ids


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (None, 3)]
    got = components.components(spark.createDataFrame(chain, "a long, b long"))
    roots = dict(as_list(got, "node", "root"))
    assert {roots[i] for i in range(61)} == {0} and {roots[100 + i] for i in range(40)} == {100}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0

"""Vector codes against the plain rounds in Python's integers, the curve,
shortlists, and edge cases."""
import hashlib
import math
import random

import numpy as np
import pytest

from llm_help import SF01
from tessera.llm import vector_codes as V


def plain(rows, parts=8, entries=16, rounds=6):
    """``{(vec_id, code, error, label_error)}`` and the digest, by all distances."""
    kept = [(i, l, [math.floor(4096 * x) for x in e]) for i, l, e in rows
            if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    width = len(kept[0][2]) // parts
    cut = [[r[2][p * width:(p + 1) * width] for p in range(parts)] for r in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            mine = [near(c[p], books[p])[1] for c in cut]
            for k in set(mine):
                xs = [c[p] for c, m in zip(cut, mine) if m == k]
                books[p][k] = [sum(v) // len(xs) for v in zip(*xs)]
    got = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    error = [sum(d for d, _ in g) for g in got]
    by_label = {}
    for (_, l, _), e in zip(kept, error):
        by_label[l] = by_label.get(l, 0) + e
    long = lambda v: v if v < 2 ** 63 else None
    out = [(r[0], "".join("%02x" % k for _, k in g), long(e), long(by_label[r[1]])) for r, g, e in zip(kept, got, error)]
    text = ",".join(str(v) for b in books for c in b for v in c)
    return sorted(out, key=str), hashlib.sha256(text.encode()).hexdigest()


def run(df):
    rows = V.compress(df).collect()
    return sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in rows), key=str), \
        {r["codebooks_sha256"] for r in rows}


def made(spark, rows, kind="float"):
    return spark.createDataFrame([(i, e, l, "x", 1) for i, l, e in rows],
                                 f"vec_id long, embedding array<{kind}>, label int, part string, error int")


@pytest.mark.parametrize("bits, axes", [(3, 2), (2, 3), (1, 4), (2, 4)])
def test_curve_steps_to_a_neighbour(bits, axes):
    cells = np.stack(np.meshgrid(*[np.arange(2 ** bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
    key = V.hilbert(cells, bits)
    assert sorted(key) == list(range(len(cells)))
    walk = cells[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_shortlists_hold_the_nearest_of_every_vector():
    rnd = np.random.default_rng(1)
    for _ in range(200):
        book = rnd.integers(-6, 6, (16, 3))
        x = rnd.integers(-6, 6, 3) + rnd.integers(0, rnd.integers(1, 4), (20, 3))
        keep = V.shortlists(x.min(0)[None], x.max(0)[None], book)[0]
        best, d = V.kernel(x, book, np.arange(16))
        assert keep[best].all()
        again, e = V.kernel(x, book, np.flatnonzero(keep))
        assert (again == best).all() and (e == d).all()
        if keep.sum() == 1:
            assert len(set(best)) == 1


def test_equals_the_plain_rounds_on_the_table(spark):
    df = spark.read.parquet(f"{SF01}/embeddings.parquet")
    want, digest = plain([(r["vec_id"], r["label"], r["embedding"]) for r in df.collect()])
    got, digests = run(df)
    assert got == want and digests == {digest}


def test_edges_against_the_plain_rounds(spark):
    rnd = random.Random(4)
    rows = [(i, rnd.choice([None, 1, 2]), [rnd.choice([-0.5, 0.0, -0.0, 0.1, 1 / 4096]) for _ in range(16)])
            for i in range(300)]
    rows += [(7, 1, rows[7][2]), (None, None, rows[9][2]), (None, 3, rows[9][2]), (400, 1, None), (401, 1, [None] * 16),
             (402, 1, [float("nan")] * 16), (403, 1, [0.0] * 15 + [float("inf")])]
    rows += [(1000 + i, 9, rows[3][2]) for i in range(2000)]  # one vector in most rows
    df = made(spark, rows).repartition(6)
    want, digest = plain(rows)
    got, digests = run(df)
    assert got == want and digests == {digest}


def test_few_rows_ties_and_wide_integers(spark):
    few = [(3, 1, [1.0] * 8), (1, 1, [1.0] * 8), (2, None, [-3.5e5] + [2.0] * 7)]
    assert run(made(spark, few))[0] == plain(few)[0]
    wide = [(i, i % 3, [float((i % 7) * 1e5 + i)] * 8) for i in range(40)] + [(99, 4, [1e9] * 8)]
    got, digests = run(made(spark, wide, "double"))
    want, digest = plain(wide)
    assert got == want and digests == {digest}


def test_empty_tables_and_vectors(spark):
    assert V.compress(made(spark, [])).count() == 0
    assert V.compress(made(spark, [(1, 1, None)])).count() == 0
    got, _ = run(made(spark, [(1, 1, []), (2, 1, [])]))
    assert got == [(1, "00" * 8, 0, 0), (2, "00" * 8, 0, 0)]
    short = run(made(spark, [(1, 1, [1.0] * 8), (2, 1, [1.0] * 3)]))[0]
    assert short == run(made(spark, [(1, 1, [1.0] * 8), (2, 1, [1.0] * 3 + [0.0] * 5)]))[0]

"""The near-copy join against all pairs, on planted near copies and edge cases."""
import random

import pytest

from tessera.operators import nearcopy as N


def sets(text, n):
    w = (text or "").lower().split()
    return {" ".join(w[i:i + n]) for i in range(max(len(w) - n, 0) + 1)} if w else set()


def all_pairs(rows, limit, n):
    least = {}
    for i, t in rows:
        least[t or ""] = min(i, least.get(t or "", i))
    each = sorted((i, sets(t, n)) for t, i in least.items())
    out = set()
    for k, (a, x) in enumerate(each):
        for b, y in each[k + 1:]:
            if x and y and len(x & y) >= limit * len(x | y) - 1e-9:
                out.add((a, b, len(x & y)))
    return out


@pytest.mark.parametrize("limit, n", [(0.8, 5), (0.5, 2), (0.8, 1), (1.0, 3)])
def test_equals_all_pairs(spark, limit, n):
    rnd = random.Random(n)
    words = [f"w{i}" for i in range(400)]
    bases = [[rnd.choice(words) for _ in range(rnd.choice([3, 6, 30, 80]))] for _ in range(12)]
    rows = []
    for i in range(260):
        w = list(rnd.choice(bases))
        for _ in range(rnd.choice([0, 0, 1, 1, 2])):
            at = rnd.randrange(len(w))
            w[at:at + 1] = rnd.choice([[rnd.choice(words)], [], [w[at], "new"]]) if len(w) > 1 else w
        rows.append((i, " ".join(w).title() if i % 9 == 0 else "  ".join(w)))
    rows += [(900, None), (901, ""), (902, " "), (903, "one"), (904, "ONE"), (905, "one one one one one one")]
    df = spark.createDataFrame(rows, "id long, t string").repartition(4)
    got = {(r["a"], r["b"], r["shared"]) for r in N.near_copies(df, "id", "t", limit, n).collect()}
    assert got == all_pairs(rows, limit, n) and len(got) >= 5  # not empty
    of = {r["id"]: r["class"] for r in N.members(df, "id", "t").collect()}
    texts = dict(rows)
    assert all((texts[i] or "") == (texts[c] or "") and c <= i for i, c in of.items()) and len(of) == len(rows)


def test_empty(spark):
    df = spark.createDataFrame([], "id long, t string")
    assert N.near_copies(df, "id", "t").count() == 0 == N.members(df, "id", "t").count()


@pytest.mark.parametrize("bound", [0, 1_000_000])
def test_only_sets_that_a_pair_names_are_joined(spark, monkeypatch, bound):
    """Of many texts without a near copy none is named; both forms of the join agree."""
    made, real = {}, N.stored
    monkeypatch.setattr(N, "BROADCAST_NAMES", bound)
    monkeypatch.setattr(N, "stored", lambda df, name: made.setdefault(name, real(df, name)))
    rows = [(i, " ".join(f"t{i}w{k}" for k in range(30))) for i in range(200)]
    rows += [(300 + i, rows[i][1] + " more") for i in range(3)]
    df = spark.createDataFrame(rows, "id long, t string").repartition(3)
    got = {(r["a"], r["b"], r["shared"]) for r in N.near_copies(df, "id", "t").collect()}
    assert got == all_pairs(rows, N.SIMILARITY, N.SHINGLE) == {(i, 300 + i, 26) for i in range(3)}
    assert sorted(r["id"] for r in made["near-named"].collect()) == [0, 1, 2, 300, 301, 302]

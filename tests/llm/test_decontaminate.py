"""Decontamination against exhaustive edit distance, recall on edited plants,
and edge cases."""
import random

from llm_help import SF01, as_list, edge_docs, empty_docs  # noqa: F401
from tessera.llm import decontaminate as D


def plain_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_edit_distance():
    rnd = random.Random(1)
    for _ in range(400):
        a = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 14)))
        b = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 25)))
        assert D.edit_distance_within(a, b) == plain_distance(a, b)


def test_many_edit_distances_at_a_time():
    rnd = random.Random(5)
    text = lambda n: "".join(rnd.choice("abcd é") for _ in range(n))
    pairs = []
    for _ in range(900):
        item = text(rnd.choice([1, 3, 59, 60, 61, 119, 120, 121, 200]))
        other = "".join(c for c in item if rnd.random() < 0.9) if rnd.random() < 0.6 else text(rnd.randint(0, 80))
        pairs.append((item, text(rnd.randint(0, 30)) + other + text(rnd.randint(0, 30))))
    pairs += [("", "x"), ("x", ""), ("abc" * 50, "")]
    assert D.edit_distances_within(pairs) == [D.edit_distance_within(*p) for p in pairs]


def test_distances_up_to_a_limit(monkeypatch):
    """Exact up to the limit, above it beyond; few pairs need the whole item's distance."""
    rnd = random.Random(6)
    text = lambda n, of="abcdefgh é\U0001F600": "".join(rnd.choice(of) for _ in range(n))
    pairs = [("", "x"), ("x", ""), ("abc" * 50, ""), ("a" * 300, "a" * 300)]
    for n in (1, 2, 30, 63, 64, 65, 127, 128, 129, 200, 400):
        for share in (0, 0.1, 0.25):
            item = text(n)
            pairs += [(item, text(20) + "".join(c if rnd.random() >= share else text(2) for c in item) + text(9)) for _ in range(3)]
        pairs += [(text(n), text(2 * n)) for _ in range(20)]
    limits = [len(item) // 5 for item, _ in pairs]
    whole, real = [], D.edit_distances_within
    monkeypatch.setattr(D, "edit_distances_within", lambda p: whole.extend(p) or real(p))
    got = D.edit_distances_up_to(pairs, limits)
    for (item, other), limit, v in zip(pairs, limits, got):
        want = plain_distance(item, other)
        assert v == want if want <= limit else v > limit
    assert len(whole) < len(pairs) / 4 and D.edit_distances_up_to([], []) == []


def test_verbatim_copies_are_all_found_and_clean_texts_left(spark):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect()]
    docs = [r["text"] for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()]
    tables = D.compile_items(items)
    got = {(n, k) for n, k, v in D.find(tables, docs) if v == 0}
    plain = [" " + " ".join(D.words(d)) + " " for d in docs]
    assert got == {(n, k) for n, d in enumerate(plain) for k, t in enumerate(tables["texts"])
                   if f" {t} " in d}
    assert all(v <= 0.2 * len(tables["texts"][k]) for _, k, v in D.find(tables, docs))


def test_recall_of_edited_plants(spark):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect()]
    tables, rnd = D.compile_items(items), random.Random(3)
    texts, want = [], set()
    for k, ws in enumerate(tables["words"] * 5):
        k %= len(tables["words"])
        edited = [rnd.choice([w + "x", "other", ""]) if rnd.random() < 0.1 else w for w in ws]
        pad = [f"pad{rnd.randrange(1000)}" for _ in range(rnd.randrange(300))]
        texts.append(" ".join([*pad, *edited, *pad]))
        if D.edit_distance_within(tables["texts"][k], " ".join(D.words(texts[-1]))) <= \
                0.2 * len(tables["texts"][k]):
            want.add((len(texts) - 1, k))
    got = {(n, k) for n, k, _ in D.find(tables, texts)}
    assert len(got & want) >= 0.9 * len(want) > 100


def test_recall_of_each_sort_of_edit_at_each_length():
    """Items of each length class between other words, edited in one way; counted
    where the exact distance is within the limit."""
    rnd = random.Random(11)
    letters = "abcdefghiklmnoprstuvwy"
    word = lambda: "".join(rnd.choice(letters) for _ in range(rnd.randint(3, 9)))
    common = ["the", "of", "and", "to", "in", "that", "is", "was"]

    def typo(w):
        at = rnd.randrange(len(w))
        return rnd.choice([w[:at] + rnd.choice("xzq") + w[at + 1:], w[:at] + w[at + 1:] or "x", w[:at] + "x" + w[at:]])
    edits = {
        "typo in each 3rd word": lambda t: [typo(w) if i % 3 == 2 else w for i, w in enumerate(t)],
        "typo in each 2nd word": lambda t: [typo(w) if i % 2 else w for i, w in enumerate(t)],
        "20 % replaced": lambda t: [word() if rnd.random() < 0.2 else w for w in t],
        "10 % left out": lambda t: [w for w in t if rnd.random() >= 0.1],
    }
    low = {}
    for n in (5, 8, 11, 16, 23, 32, 39, 40, 59, 80):
        items = [(i, " ".join(rnd.choice(common) if rnd.random() < 0.3 else word() for _ in range(n))) for i in range(60)]
        tables = D.compile_items(items)
        for name, edit in edits.items():
            texts = []
            for t in tables["words"]:
                pad = [word() for _ in range(rnd.randrange(40))]
                texts.append(" ".join([*pad, *edit(list(t)), *pad]))
            want = {(k, k) for k, x in enumerate(texts) if D.edit_distance_within(tables["texts"][k], x) <= 0.2 * len(tables["texts"][k])}
            got = {(d, k) for d, k, _ in D.find(tables, texts)}
            if len(want) >= 10:
                low[n, name] = (len(got & want), len(want))
    print({k: f"{a}/{b}" for k, (a, b) in low.items()})
    assert len(low) >= 30 and all(a >= 0.9 * b for a, b in low.values()), {k: v for k, v in low.items() if v[0] < 0.9 * v[1]}


def test_short_and_long_items():
    long_item = " ".join(f"w{i}" for i in range(700))
    tables = D.compile_items([(1, "one"), (2, "two words"), (3, long_item), (4, None), (5, ""), (6, "ONE")])
    found = {(n, k, v) for n, k, v in D.find(tables, ["a one b", f"x {long_item} y", None, "", "two, words!"])}
    by_text = {tables["texts"][k][:9]: n for n, k, v in found if v == 0}
    assert by_text == {"one": 0, long_item[:9]: 1, "two words": 4}
    assert sorted(i for ids in tables["ids"] for i in ids) == [1, 2, 3, 6]


def test_edge_cases(spark, edge_docs, empty_docs):
    text = edge_docs.where("doc_id = 1").first()["text"]
    items = spark.createDataFrame([(1, text), (2, text.upper()), (3, None), (None, "zzzz " * 20)],
                                  "item_id long, text string")
    got = as_list(D.matches(edge_docs, items), "doc_id", "item_id", "distance")
    assert [x for x in got if x[0] in (1, 2, 8)] == [(d, i, 0) for d in (1, 2, 8) for i in (1, 2)]
    assert {x[0] for x in got} == {1, 2, 8, None}
    assert D.matches(empty_docs, items).count() == 0
    assert D.matches(edge_docs, items.where("false")).count() == 0
    kept = D.clean(edge_docs, items)
    assert kept.columns == edge_docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {3, 4, None, 5, 6, 7, 9, 10}


def test_blocks_cover_the_benchmark_once(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_ITEMS", 7)
    items = spark.createDataFrame([(i, f"text {i}") for i in range(40)], "item_id long, text string")
    blocks = list(D.blocks_of(items))
    assert len(blocks) > 3 and sorted(i for b in blocks for i, _ in b) == list(range(40))


def test_copies_of_a_text_are_searched_once(monkeypatch):
    item = "the quick brown fox jumps over the lazy dog near the old river bank"
    tables = D.compile_items([(1, item)])
    seen, real = [], D.words
    monkeypatch.setattr(D, "words", lambda t: seen.append(t) or real(t))
    texts = ["so " + item, "nothing of it", None, *["so " + item] * 40, "nothing of it", None]
    found = D.find(tables, texts)
    assert sorted(found) == [(n, 0, 0) for n, t in enumerate(texts) if t and item in t]
    assert len(seen) == 3


def test_words_are_runs_of_letters_and_digits():
    import random
    rnd = random.Random(3)
    signs = [chr(c) for c in range(0x3000)] + ["\U0001F600", "\U0001D7D8", "中", " ", "İ"]
    texts = ["".join(rnd.choice(signs[:top]) for _ in range(n)) for top in (128, 256, 0x250, len(signs)) for n in (0, 9, 80, 400) for _ in range(20)]
    texts += ["Ünï_cöde, «ça va»? x\x1cy\x85z" * 3]
    for t in texts:
        assert D.words(t) == D.WORD.findall(t.lower())

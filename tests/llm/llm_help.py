"""Helpers and fixtures of these tests."""

import random

import pytest

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def as_list(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((x is None, x) for x in t))


CLASHING = ("fp, key, root, component_id, label, shard, bands, gone, norm, row, pos, host, text_id, "
            "node, words, line, score")


def word(rnd):
    return "".join(rnd.choice("bcdfglmnprst") + rnd.choice("aeiou") for _ in range(rnd.randint(1, 4)))


def prose(rnd, words, lines=1):
    return "\n".join(" ".join(word(rnd) for _ in range(words)).capitalize() + "."
                     for _ in range(lines))


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and extra columns
    whose names operators use themselves."""
    rnd = random.Random(3)
    base = prose(rnd, 60, 4)
    rows = [(1, base), (2, base), (3, None), (4, ""), (None, base), (None, None), (5, " \t\n "),
            (6, prose(rnd, 12, 3000)), (7, "x" * 50_000), (8, base + " more words"), (9, "one two"),
            (9, "one two"), (10, "\u00e9t\u00e9 \u4e2d\u6587 \U0001F600 <|endoftext|> it's")]
    names = CLASHING.split(", ")
    data = [(i, t, "en", "src", *["x"] * len(names)) for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, " + \
        ", ".join(f"`{n}` string" for n in names)
    return spark.createDataFrame(data, schema)


@pytest.fixture(scope="session")
def empty_docs(edge_docs):
    return edge_docs.where("false")


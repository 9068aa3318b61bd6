import json

from pyspark.sql import functions as F

from tessera.functions import (approx_tokens, canonical_line, canonical_line_bytes, capitalise,
                               content_chars, decode, decode_file_name, file_name, fill,
                               humanise, megabytes, nest, rotated_pick, substitute)
from tessera.functions.chat import json_escape_text, json_escaped
from tessera.functions.radix import decode

EDGE = ['say "hi"', "back\\slash", "line\nbreak", "tab\there", "em — dash", "emoji 😀",
        'holds ": " inside', "{topic} stays", "", "ctrl \x01 \x1f"]


def one(spark, col, rows=None):
    df = spark.createDataFrame(rows or [("x",)], "s string")
    return df.select(col.alias("v")).first()["v"]


def test_humanise_and_capitalise(spark):
    assert one(spark, humanise(F.lit("first_principles_x"))) == "first principles x"
    assert one(spark, capitalise(F.lit("root cause ANALYSIS"))) == "Root cause analysis"


def test_file_name_round_trip(spark):
    assert one(spark, file_name(F.lit("coding"), F.lit("api_design"))) == "coding__api_design.jsonl"
    r = one(spark, decode_file_name(F.lit("coding__api__design.jsonl")))
    assert (r["skill"], r["subtopic"]) == ("coding", "api__design")
    r = one(spark, decode_file_name(F.lit("index.jsonl")))
    assert r["skill"] is None and r["subtopic"] is None


def test_tokens_floor_after_sum(spark):
    df = spark.createDataFrame([("a", 3), ("a", 5), ("b", 8)], "g string, c long")
    per_row = {r["g"]: r["t"] for r in df.groupBy("g").agg(
        F.sum(approx_tokens(F.col("c"))).alias("t")).collect()}
    after = {r["g"]: r["t"] for r in df.groupBy("g").agg(
        approx_tokens(F.sum("c")).alias("t")).collect()}
    assert per_row == {"a": 1, "b": 2} and after == {"a": 2, "b": 2}
    assert one(spark, megabytes(F.lit(41263274))) == round(41263274 / 1048576, 1)


def test_decode_and_rotated_pick(spark):
    row = spark.range(1).select(*[d.alias(f"d{i}") for i, d in enumerate(
        decode(F.lit(14567), [10, 10, 10, 15]))]).first()
    assert tuple(row) == (7, 6, 5, 14)
    arr = F.array(*[F.lit(x) for x in "abcd"])
    picks = spark.range(8).select(rotated_pick(arr, F.col("id"), 1).alias("p")).collect()
    assert [r["p"] for r in picks] == list("abcdabcd")  # four items: modulus 4
    assert one(spark, rotated_pick(F.array().cast("array<string>"), F.lit(3), 1)) is None


def test_canonical_line_matches_python(spark):
    rows = [(a, b) for a, b in zip(EDGE, reversed(EDGE))]
    df = spark.createDataFrame(rows, "u string, a string").select(
        "u", "a", nest(F.col("u"), F.col("a")).alias("messages"))
    out = df.select("u", "a", canonical_line("messages").alias("line"),
                    canonical_line_bytes("messages").alias("nbytes"),
                    content_chars("messages").alias("chars")).collect()
    for r in out:
        want = json.dumps({"messages": [{"role": "user", "content": r["u"]},
                                        {"role": "assistant", "content": r["a"]}]},
                          ensure_ascii=False)
        # the only allowed difference: upper-case hex in \\u00XX escapes
        assert r["line"].lower() == want.lower() and len(r["line"]) == len(want)
        assert r["nbytes"] == len(want.encode("utf-8"))
        assert r["chars"] == len(r["u"]) + len(r["a"])


def test_escaped_constant_matches_column_escaping(spark):
    for s in EDGE:
        assert one(spark, json_escaped(F.lit(s))) == json_escape_text(s)


def test_fill_and_substitute(spark):
    vals = {"topic": F.lit("{audience}"), "audience": F.lit("B"), "fmt": F.lit("C")}
    assert one(spark, fill("x {topic} y {audience}", vals)) == "x {audience} y B"
    # simultaneous and non-recursive; unused values ignored
    assert one(spark, substitute(F.lit("{topic}-{audience}"), vals)) == "{audience}-B"
    # an unknown placeholder fails the row
    assert one(spark, substitute(F.lit("{topic}-{nope}"), vals)) is None


def test_thread_measures_equal_assembled_lines(spark):
    from tessera.operators import chat
    turns = spark.createDataFrame(
        [(1, 1, "user", 'he said "hi"\n\tand left'), (1, 0, "system", "rules: ä ö — 😀"),
         (1, 2, "assistant", 'a\\b ": " c'), (2, 0, "user", "x"), (2, 1, "assistant", "")],
        "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.thread_measures(turns).collect()}
    for t in chat.assemble(turns).collect():
        msgs = [{"role": m["role"], "content": m["content"]} for m in t["messages"]]
        line = json.dumps({"messages": msgs}, ensure_ascii=False)
        g = got[t["conv_id"]]
        assert g["line_bytes"] == len(line.encode("utf-8")) + 1
        assert g["chars"] == sum(len(m["content"]) for m in msgs)
        assert g["first_role"] == msgs[0]["role"]


def test_decode_is_exact_beyond_doubles(spark):
    big = 2 ** 60 + 33
    digits = spark.range(1).select(*decode(F.lit(big), [10, 7, 100])).first()
    assert tuple(digits) == (big % 10, big // 10 % 7, big // 70 % 100)

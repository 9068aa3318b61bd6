import json
import random
from array import array

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import golden
from tessera.model import DEFINITION
from tessera.operators import dedup, synth
from tessera.operators.manifest import chat_manifest, measured_manifest
from tessera.plans.synthesis import SECTION, SECTIONS, outline, section_pattern

GRID = synth.Grid(audiences=["a0", "a1", "a2"], perspectives=["p0", "p1"], formats=["f0", "f1"],
                  templates=["T {topic} {audience} {perspective} {fmt}",
                             "U {topic} {audience} {perspective}",  # leaves fmt out
                             "V {topic} for {audience}, {fmt} {perspective}"],
                  answer_template="A {title}|{Title}|{definition}|{principle}|{example}|"
                                  "{mistake}|{audience}|{perspective}|{fmt}")

DEFS = [("s1", "first_topic", "d \"one\"", ["p1", "p2"], ["e1", "e2", "e3", "e4"], ["m1"]),
        ("s1", "second_topic", "d two", ["q1"], ["x1"], ["y1", "y2", "y3"]),
        ("s2", "third\ntopic", "d three", ["r1"], ["z1", "z2"], ["w1"])]


def walked_by_sql(keys, target, attempts):
    """The loop as a recursion in SQL: kept and tried grow together."""
    rows = duckdb.execute("""
WITH RECURSIVE steps AS (
  SELECT CAST(0 AS BIGINT) AS tried, CAST([] AS VARCHAR[]) AS seen, CAST(NULL AS BIGINT) AS took
  UNION ALL
  SELECT tried + 1, CASE WHEN fresh THEN list_append(seen, k) ELSE seen END, CASE WHEN fresh THEN i END
  FROM (SELECT *, k IS NOT NULL AND NOT list_contains(seen, k) AS fresh FROM (
    SELECT *, len(seen) + tried + 1 AS i, ($keys)[len(seen) + tried + 2] AS k FROM steps
    WHERE len(seen) < $target AND tried < $attempts)))
SELECT took FROM steps WHERE took IS NOT NULL ORDER BY took""",
                          {"keys": keys, "target": target, "attempts": attempts}).fetchall()
    return [r[0] for r in rows]


def test_walk_by_hand():
    walk = dedup._walk
    assert walk(list("abcdefgh"), 10, 10) == [1, 3, 5, 7]      # every other index
    assert walk(list("abbcdefg"), 10, 10) == [1, 3, 5, 7]      # a repeat at a skipped index
    assert walk(["a", "x", "b", "x", "c", "d", "e"], 10, 10) == [1, 4, 6]  # the repeat at 3 moves by one
    assert walk([None, None, "a", None, "b"], 10, 10) == [2, 4]            # failed rows move by one
    assert walk(list("abcdefgh"), 2, 10) == [1, 3] and walk(list("abcdefgh"), 9, 3) == [1, 3, 5]
    assert walk(list("ab"), 9, 9, period=2) == [1, 4]          # b, (skip), b again at 3, a at 4


@pytest.mark.parametrize("batch", [10000, 2])
def test_visit_plan_in_spark(spark, batch):
    """Against the recursion; many files of few patterns, and a null group
    value is a group of its own."""
    rng = random.Random(3)
    rows, want = [], {}
    shapes = [[rng.choice([None, "k1", "k2", "k3", "u", "k4"]) for _ in range(41)] for _ in range(5)]
    for g in [*range(12), None]:
        name = None if g is None else f"g{g}"
        keys = shapes[(g or 0) % 5]
        rows += [(name, "s", i, k and f"{k}-{g}") for i, k in enumerate(keys)]
        want[name] = walked_by_sql(keys, 10, 30)
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "skill string, subtopic string, idx long, key string")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = {}
        for r in dedup.visit_plan(df, ["skill", "subtopic"], 10, 30).collect():
            got.setdefault(r["skill"], []).append(r["idx"])
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in want.items() if v}


def test_generated_entries(spark):
    groups = spark.createDataFrame(DEFS, DEFINITION)
    ent = synth.generate(groups, GRID, target=100, attempts=500, chunk=7).cache()
    rows = ent.collect()
    # prompts unique per group, all distinct prompts found: 2*3*2*2 + 3*2
    by_group = {}
    for r in rows:
        by_group.setdefault((r["skill"], r["subtopic"]), []).append(r)
    assert {k: len(v) for k, v in by_group.items()} == {(s, t): 30 for s, t, *_ in DEFS}
    for v in by_group.values():
        assert len({r["prompt"] for r in v}) == len(v)
    for r in rows:
        assert [m["role"] for m in r["messages"]] == ["user", "assistant"]
        want = json.dumps({"messages": [{"role": "user", "content": r["prompt"]},
                                        {"role": "assistant", "content": r["answer"]}]},
                          ensure_ascii=False)
        assert r["line"] == want
        assert r["line_bytes"] == len(want.encode("utf-8")) + 1
        assert r["chars"] == len(r["prompt"]) + len(r["answer"])
    # the measured manifest equals the one measured from the nested records
    a = {r["file"]: tuple(r) for r in measured_manifest(ent).collect()}
    b = {r["file"]: tuple(r) for r in chat_manifest(ent).collect()}
    assert a == b
    # rotated pick with a four-item list uses modulus 4
    first = [r for r in by_group[("s1", "first_topic")]]
    for r in first:
        assert r["answer"].split("|")[4] == ["e1", "e2", "e3", "e4"][r["idx"] % 4]


def test_runs_hold_every_index(spark):
    rows = [("s", "t", i) for i in (0, 1, 63, 64, 5_000_000_000, 5_000_000_063)] + [("s", "u", 7), ("s", None, 127)]
    runs = synth.index_runs(spark.createDataFrame(rows, "skill string, subtopic string, idx long"))
    assert runs.count() == 5
    back = synth.run_indices(runs).select("skill", "subtopic", "idx").collect()
    assert sorted(map(str, map(tuple, back))) == sorted(map(str, rows))


def test_measures_are_compiled(spark, capsys):
    """The JVM leaves methods of more than 8000 bytes to its interpreter."""
    groups = spark.createDataFrame(DEFS, DEFINITION)
    kept = spark.createDataFrame([(s, t, 3) for s, t, *_ in DEFS], "skill string, subtopic string, idx long")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        measured_manifest(synth.entries_at(groups, kept, synth.Grid())).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(x.split(";")[0]) for x in capsys.readouterr().out.split("maxMethodCodeSize:")[1:]]
    assert sizes and max(sizes) < 8000


def test_walk_sorts_by_a_number(spark):
    keyed = spark.createDataFrame([("s", "t", i, f"k{i % 3}") for i in range(9)], "skill string, subtopic string, idx long, key string")
    seen = []
    keep, dedup.stored = dedup.stored, lambda df, name: seen.append(df) or keep(df, name)
    try:
        got = dedup.visit_plan(keyed, ["skill", "subtopic"], 9, 45).select("idx").collect()
    finally:
        dedup.stored = keep
    assert sorted(r["idx"] for r in got) == dedup._walk([f"k{i % 3}" for i in range(9)], 9, 45)
    assert "xxhash64" in seen[0]._jdf.queryExecution().optimizedPlan().toString()


def test_section_pattern_equals_titles_and_bodies(spark):
    names = ["One", "Two b"]
    texts = [a + b + c + d for a in ("", "x ", "**y** ", "* ** z", "**q.** ") for b in ("**One.**", "**One**", "***One.**", "**One.***")
             for c in ("", "  ", " \n", "text *s* ", " **u**. v ") for d in ("**Two b.** end", "**Two b.**", "**Two b.**  ", "**One.** e", "**Two b.** t **")]
    df = spark.createDataFrame([(t,) for t in [*texts, None, ""]], "t string")
    titles = F.regexp_extract_all("t", F.lit(SECTION), F.lit(1))
    bodies = F.slice(F.split("t", SECTION.replace("(", "(?:")), 2, 1000)
    plain = (titles == F.array(*[F.lit(t) for t in names])) & F.forall(bodies, lambda b: F.trim(b) != "")
    got = df.select("t", plain.alias("a"), F.rlike("t", F.lit(section_pattern(names))).alias("b")).collect()
    assert [r["t"] for r in got if bool(r["a"]) != bool(r["b"])] == []
    assert {bool(r["b"]) for r in got} == {True, False}


def test_outline_is_short_and_keeps_what_the_pattern_tells(spark):
    rnd = random.Random(12)
    long = ["a long body without any star, and no stop", "  a body of some words that ends so.", " " * 30, "\n" * 30, "é中 " * 12 + "."]
    short = ["", "*", "**", "***", " ", ".", "One.", "Two b.", "One", "**One.**", "**Two b.**", "x"]
    texts = ["".join(rnd.choice(short + long + ["*", "**"]) for _ in range(rnd.randint(1, 9))) for _ in range(1500)]
    texts += [f"{a}**One.**{b}**Two b.**{c}" for a in (*long, "") for b in (*short, *long) for c in (*short, *long)]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    names, text = ["One", "Two b"], outline(F.col("t"), ["One", "Two b"])
    got = df.select("t", F.rlike("t", F.lit(section_pattern(names))).alias("a"), F.rlike(text, F.lit(section_pattern(names))).alias("b")).collect()
    assert [r["t"] for r in got if r["a"] != r["b"]] == [] and {r["b"] for r in got} == {True, False, None}
    body = "A body of a section, as long as they are. " * 8
    df = spark.createDataFrame([("".join(f"**{s}.** {body}" for s in SECTIONS),)], "t string")
    size, = df.select(F.length(outline(F.col("t"), SECTIONS))).first()
    assert size < 250


def test_many_groups_of_many_patterns(spark, monkeypatch):
    """Groups share patterns; the broadcast of the plans and the shares beyond it
    give what a walk of each group gives."""
    rnd = random.Random(7)
    kinds = [[rnd.choice([None, *range(n)]) for _ in range(30)] for n in (1, 4, 12, 40)] + [[None] * 30]
    groups = {f"g{g}": kinds[0 if g % 2 else rnd.randrange(5)] for g in range(40)}
    rows = [(g, i, None if k is None else f"{g}-{k}") for g, ks in groups.items() for i, k in enumerate(ks)]
    df = spark.createDataFrame(rows, "grp string, idx long, key string").repartition(5)
    want = sorted((g, i) for g, ks in groups.items() for i in dedup._walk(ks, 9, 70, 30))
    for bound in (0, 10 ** 6):
        monkeypatch.setattr(dedup, "BROADCAST_PLANS", bound)
        assert sorted(map(tuple, dedup.visit_plan(df, ["grp"], 9, 70, period=30).collect())) == want


def test_a_period_of_five_million(spark):
    """A long period streams into one array; half of the indices repeat the others."""
    period = 5_000_000
    keyed = spark.range(period).selectExpr("'g' grp", "id idx", f"cast(id % {period // 2} as string) key")
    got = dedup.visit_plan(keyed, ["grp"], period, 2 * period, period=period)
    classes = array("i", (i % (period // 2) for i in range(period)))
    want = dedup._walk_classes(classes, period, 2 * period, period)
    row = got.selectExpr("count(*) n", "sum(idx) s", "bit_xor(idx) x").first()
    assert (row["n"], row["s"], row["x"]) == (len(want), sum(want), int(np.bitwise_xor.reduce(np.array(want))))
    assert len(want) == period // 2


def test_dimensions_from_tables_equal_listed_ones(spark):
    groups = spark.createDataFrame(DEFS, DEFINITION)
    cols = ["skill", "subtopic", "idx", "prompt", "answer", "line", "chars", "line_bytes"]
    want = sorted(synth.generate(groups, GRID, target=100, attempts=500).select(*cols).collect())
    table = spark.createDataFrame([("a1", "p1", "f0"), ("a0", "p0", "f1"), ("a2", None, "f1")],
                                  "a string, p string, f string")
    tables = synth.Grid(synth.resolve_dim(table, "a"), synth.resolve_dim(table, "p"),
                        synth.resolve_dim(table, "f"), GRID.templates, GRID.answer_template)
    assert tables.period == GRID.period
    assert sorted(synth.generate(groups, tables, target=100, attempts=500).select(*cols).collect()) == want


def test_a_dimension_of_two_thousand_values(spark):
    dim = synth.resolve_dim(spark.range(2000).selectExpr("concat('v', lpad(id, 4, '0')) v"), "v")
    assert dim.size == 2000
    grid = synth.Grid(dim, ["p"], ["f"], ["{topic} {audience}"], GRID.answer_template)
    got = synth.keyed_prompts(spark.createDataFrame(DEFS[:1], DEFINITION), grid, 0, grid.period - 1)
    assert {(r["idx"], r["prompt"]) for r in got.collect()} == \
        {(i, f"first topic v{i:04d}") for i in range(2000)}


def test_failures_are_counted_by_reason(spark):
    bad = [("s3", "no_examples", "d", ["p"], [], ["m"]), ("s3", "no_def", None, ["p"], ["e"], ["m"])]
    groups = spark.createDataFrame(bad + DEFS[:1], DEFINITION)
    wanted = spark.createDataFrame([(r[0], r[1]) for r in bad + DEFS], "skill string, subtopic string")
    grid = synth.Grid(["a", "b"], ["p"], ["f"], ["{topic} {nope}", "{topic} ok"], GRID.answer_template)
    got = {r["reason"]: (r["files"], r["entries"]) for r in synth.failures(groups, wanted, grid).collect()}
    assert got == {"missing_group": (2, 8), "definition": (2, 8), "template": (1, 2)}


def test_generation_failures_are_dropped(spark):
    bad = [("s3", "no_examples", "d", ["p"], [], ["m"]),
           ("s3", "no_def", None, ["p"], ["e"], ["m"])]
    groups = spark.createDataFrame(bad + DEFS[:1], DEFINITION)
    got = {r["subtopic"] for r in synth.generate(groups, GRID, 100, 500).collect()}
    assert got == {"first_topic"}
    broken = synth.Grid(audiences=["a"], perspectives=["p"], formats=["f"],
                        templates=["{topic} {nope}", "{topic} ok"],
                        answer_template=GRID.answer_template)
    ent = synth.generate(spark.createDataFrame(DEFS[:1], DEFINITION), broken, 10, 50).collect()
    assert {r["prompt"] for r in ent} == {"first topic ok"}


def test_first_wins_and_cap(spark):
    rows = [("g", 3, "h1", "late"), ("g", 1, "h1", "early"), ("g", 2, "h2", "x"),
            ("k", 5, "h1", "other")]
    df = spark.createDataFrame(rows, "grp string, idx long, h string, answer string")
    per_group = {(r["grp"], r["h"]): r["answer"]
                 for r in dedup.first_wins(df, "h", "idx", ["grp"]).collect()}
    assert per_group == {("g", "h1"): "early", ("g", "h2"): "x", ("k", "h1"): "other"}
    corpus = {r["h"]: r["answer"] for r in dedup.first_wins(df, "h", "idx").collect()}
    assert corpus == {"h1": "early", "h2": "x"}
    capped = dedup.cap(df, 2, "idx", ["grp"]).collect()
    assert sorted((r["grp"], r["idx"]) for r in capped) == [("g", 1), ("g", 2), ("k", 5)]
    many = spark.range(5000).selectExpr("id % 3 grp", "5000 - id idx")
    got = dedup.cap(many, 1200, "idx", ["grp"])
    assert sorted((r["grp"], r["idx"]) for r in got.collect()) == sorted(
        (g, i) for g in range(3) for i in sorted(5000 - x for x in range(g, 5000, 3))[:1200])


def _check_golden(spark, names):
    want = {r["file"]: r for r in golden.manifest_rows()}
    rows = [r for r in golden.definition_rows() if not names or f"{r[0]}__{r[1]}.jsonl" in names]
    got = measured_manifest(synth.generate(spark.createDataFrame(rows, DEFINITION))).collect()
    assert len(got) == (len(names) if names else len(want))
    for r in got:
        w = want[r["file"]]
        assert (r["entries"], r["bytes"], r["approx_tokens"]) == \
            (w["entries"], w["bytes"], w["approx_tokens"])


@pytest.mark.skipif(not golden.available(), reason="golden inputs not configured")
@pytest.mark.parametrize("names", [{"coding__refactoring.jsonl", "thinking__abstraction.jsonl",
                                    "understanding__inferential_comprehension.jsonl"}, None],
                         ids=["three", "all"])
def test_golden_manifest(spark, names):
    """The generator reproduces the published manifest exactly (entries,
    bytes, approx_tokens): three files incl. a four-example one, then all."""
    _check_golden(spark, names)


def test_keyed_prompts_find_file_values_before_the_indices(spark):
    """The title and the record's check are made once for each file, and the record's
    texts do not go along with each index; failing files and templates still fail."""
    g = synth.Grid(audiences=["a", "b"], perspectives=["p"], formats=["f"], templates=["{topic} {audience}", "{whom}"])
    files = spark.createDataFrame([("s", "x_y", "d", ["p"], ["e"], ["m"]), ("s", "z", None, ["p"], ["e"], ["m"])],
                                  "skill string, subtopic string, def string, principles array<string>, "
                                  "examples array<string>, mistakes array<string>")
    for drop in (False, True):
        k = synth.keyed_prompts(files, g, 0, g.period - 1, drop_failed=drop)
        plan = k._jdf.queryExecution().optimizedPlan().toString()
        above = plan[:plan.index("Generate explode")]
        assert "translate(" not in above and "principles" not in above
        rows = sorted((r["subtopic"], r["idx"], r["prompt"], r["key"] is not None) for r in k.collect())
        ok = [("x_y", 0, "x y a", True), ("x_y", 1, "x y b", True)]
        assert [r for r in rows if r[3]] == ok and len(rows) == (2 if drop else 8)

"""License scan by ordered signature rules, in DataFrame operations.

A text is read as its words (A-Z lower-cased), joined by single blanks, so
signatures need not care for punctuation and line breaks. Cheap substring
tests keep most texts from the rules: a text must hold a gate word, and a rule
is tried only where its keyword stands in a word. What the rules find are intervals of
words; of overlapping finds, one that lies inside another goes (the longer
wins, of equal ones the rule of higher priority).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tessera.llm.util import ascii_lower, stored

#: What does not belong to a word, in lower-cased text and in text as it is.
BREAKS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
#: Base phrases and their labels.
BASE: tuple[tuple[str, str], ...] = (
    ("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
BASE_SCORE = 0.6
#: Licenses: label, keyword (part of every way to write the name), and how the
#: name is written in words.
LICENSES: tuple[tuple[str, str, str], ...] = (
    ("mit", "mit", "mit(?: x11)?"),
    ("x11", "x11", "x11"),
    ("isc", "isc", "isc"),
    ("zlib", "zlib", "zlib(?: libpng)?"),
    ("apache-1.1", "apache", "apache(?: software)?(?: license)?(?: version| v)? 1 1"),
    ("apache-2.0", "apache", "apache(?: software)?(?: license)?(?: version| v)? ?2(?: 0)?"),
    ("bsd-2-clause", "bsd", "(?:simplified bsd|freebsd|(?:2|two) clause bsd|bsd (?:2|two) clause)"),
    ("bsd-3-clause", "bsd", "(?:new bsd|modified bsd|revised bsd|(?:3|three) clause bsd|bsd (?:3|three) clause)"),
    ("bsd-4-clause", "bsd", "(?:original bsd|(?:4|four) clause bsd|bsd (?:4|four) clause)"),
    ("gpl-1.0", "gnu", "gnu general public license,? (?:version |v ?)1(?: 0)?"),
    ("gpl-2.0", "gnu", "gnu general public license (?:version |v ?)2(?: 0)?"),
    ("gpl-3.0", "gnu", "gnu general public license (?:version |v ?)3(?: 0)?"),
    ("gpl-2.0", "gplv2", "(?:gnu )?gplv2"),
    ("gpl-3.0", "gplv3", "(?:gnu )?gplv3"),
    ("lgpl-2.1", "lesser", "(?:gnu )?lesser general public license (?:version |v ?)2 1"),
    ("lgpl-3.0", "lesser", "(?:gnu )?lesser general public license (?:version |v ?)3(?: 0)?"),
    ("lgpl-2.0", "library", "gnu library general public license(?: version 2(?: 0)?)?"),
    ("agpl-3.0", "affero", "(?:gnu )?affero general public license(?: version| v)? ?3(?: 0)?"),
    ("fdl-1.3", "documentation", "gnu free documentation license(?: version)? 1 3"),
    ("fdl-1.2", "documentation", "gnu free documentation license(?: version)? 1 2"),
    ("mpl-1.1", "mozilla", "mozilla public license(?: version| v)? ?1 1"),
    ("mpl-2.0", "mozilla", "mozilla public license(?: version| v)? ?2(?: 0)?"),
    ("epl-1.0", "eclipse", "eclipse public license(?: version| v)? ?1(?: 0)?"),
    ("epl-2.0", "eclipse", "eclipse public license(?: version| v)? ?2(?: 0)?"),
    ("edl-1.0", "eclipse", "eclipse distribution license(?: version| v)? ?1(?: 0)?"),
    ("cddl-1.0", "cddl", "cddl(?: version)? ?1(?: 0)?"),
    ("cddl-1.0", "development", "common development and distribution license(?: version)? ?1(?: 0)?"),
    ("cpl-1.0", "common", "common public license(?: version)? ?1(?: 0)?"),
    ("artistic-1.0", "artistic", "artistic license(?: version)? 1(?: 0)?"),
    ("artistic-2.0", "artistic", "artistic license(?: version)? 2(?: 0)?"),
    ("bsl-1.0", "boost", "boost software license(?: version)? 1(?: 0)?"),
    ("busl-1.1", "business", "business source license(?: version)? 1 1"),
    ("sspl-1.0", "server", "server side public license(?: version)? ?1?(?: 0)?"),
    ("elastic-2.0", "elastic", "elastic license(?: version)? 2(?: 0)?"),
    ("unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl(?: version 2)?"),
    ("cc0-1.0", "cc0", "(?:creative commons )?cc0(?: 1 0)?(?: universal)?"),
    ("cc-by-2.0", "cc", "(?:creative commons )?cc by 2 0"),
    ("cc-by-3.0", "cc", "(?:creative commons )?cc by 3 0"),
    ("cc-by-4.0", "cc", "(?:creative commons )?cc by 4 0"),
    ("cc-by-sa-2.0", "cc", "(?:creative commons )?cc by sa 2 0"),
    ("cc-by-sa-3.0", "cc", "(?:creative commons )?cc by sa 3 0"),
    ("cc-by-sa-4.0", "cc", "(?:creative commons )?cc by sa 4 0"),
    ("cc-by-nc-3.0", "cc", "(?:creative commons )?cc by nc 3 0"),
    ("cc-by-nc-4.0", "cc", "(?:creative commons )?cc by nc 4 0"),
    ("cc-by-nd-3.0", "cc", "(?:creative commons )?cc by nd 3 0"),
    ("cc-by-nd-4.0", "cc", "(?:creative commons )?cc by nd 4 0"),
    ("cc-by-nc-sa-3.0", "cc", "(?:creative commons )?cc by nc sa 3 0"),
    ("cc-by-nc-sa-4.0", "cc", "(?:creative commons )?cc by nc sa 4 0"),
    ("cc-by-nc-nd-4.0", "cc", "(?:creative commons )?cc by nc nd 4 0"),
    ("cc-by", "commons", "creative commons attribution(?: (?:[1-4] 0|international|unported))*"),
    ("cc-by-sa", "commons", "creative commons attribution share ?alike(?: (?:[1-4] 0|international|unported))*"),
    ("cc-by-nc", "commons", "creative commons attribution non ?commercial(?: (?:[1-4] 0|international|unported))*"),
    ("odbl-1.0", "database", "open (?:data commons )?(?:open )?database license(?: 1 0)?"),
    ("odc-by-1.0", "data", "open data commons attribution license(?: 1 0)?"),
    ("ofl-1.1", "sil", "sil open font license(?: version)?(?: 1 1)?"),
    ("openssl", "openssl", "openssl"),
    ("php-3.01", "php", "php license(?: version)? 3 01"),
    ("python-2.0", "python", "python software foundation license(?: version 2)?"),
    ("postgresql", "postgresql", "postgresql"),
    ("upl-1.0", "universal", "universal permissive license(?: version)?(?: v)? ?1(?: 0)?"),
    ("eupl-1.2", "european", "european union public licen[cs]e(?: version| v)? ?1 2"),
    ("openrail", "openrail", "(?:creativeml |bigscience )?openrail(?: m)?"),
    ("llama-community", "llama", "llama [2-9](?: [0-9])? community license(?: agreement)?"),
)
#: How a license is named in a text: pattern around the name, priority, weight.
PHRASES: tuple[tuple[str, int, float], ...] = (
    ("spdx license identifier {}(?: only| or later)?", 1, 1.0),
    ("(?:dual )?licen[sc]ed (?:to you )?under (?:the )?(?:terms of (?:the )?)?{}(?: licen[sc]e)?", 2, 0.95),
    ("(?:released|distributed|available|published|provided|covered|shared) under (?:the )?"
     "(?:terms of (?:the )?)?{}(?: licen[sc]e)?", 3, 0.9),
    ("{} licen[sc]e", 4, 0.8),
    ("{}", 5, 0.5),
)
#: Names that are words of ordinary language or of other things stand for a
#: license only in one of the other phrases.
NO_BARE_NAME = frozenset({"mit", "x11", "isc", "zlib", "openssl", "postgresql", "apache-2.0",
                          "apache-1.1", "cc0-1.0", "unlicense"})
#: Notices by their own words: label, keyword, pattern, priority, weight.
NOTICES: tuple[tuple[str, str, str, int, float], ...] = (
    ("mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy", 1, 1.0),
    ("isc", "permission", "permission to use copy modify and or distribute this software for any purpose", 1, 1.0),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification", 1, 1.0),
    ("gpl", "redistribute", "this program is free software you can redistribute it and or modify it", 1, 1.0),
    ("gpl", "version", "either version [123] of the license or at your option any later version", 2, 0.9),
    ("apache-2.0", "compliance", "you may not use this file except in compliance with the license", 1, 0.9),
    ("zlib", "altered", "altered source versions must be plainly marked as such", 1, 1.0),
    ("mpl-2.0", "subject", "this source code form is subject to the terms of the mozilla public license", 1, 1.0),
    ("bsl-1.0", "boost", "distributed under the boost software license", 2, 0.95),
    ("unlicense", "unencumbered", "free and unencumbered software released into the public domain", 1, 1.0),
    ("public-domain", "domain", "(?:in|into|to) the public domain", 4, 0.7),
    ("public-domain", "domain", "public domain dedication", 4, 0.8),
    ("warranty-disclaimer", "warranty", "without warranty of any kind", 5, 0.4),
    ("warranty-disclaimer", "warranties", "without warranties or conditions of any kind", 5, 0.4),
    ("proprietary", "proprietary", "proprietary and confidential", 4, 0.7),
    ("proprietary", "prohibited", "unauthori[sz]ed (?:copying|reproduction|distribution|use) .{0,60}prohibited", 4, 0.7),
    ("reserved", "rights", "all rights reserved", 5, BASE_SCORE),
    ("gpl", "general", "general public license", 6, BASE_SCORE),
    ("cc-by", "cc", "cc by", 6, BASE_SCORE),
)
def rules() -> list[tuple[int, str, str, str, int, float]]:
    """``(rule, label, keyword, regex, priority, weight)`` of all signatures."""
    out = []
    for label, keyword, name in LICENSES:
        for pattern, priority, weight in PHRASES:
            if pattern != "{}" or label not in NO_BARE_NAME:
                out.append((label, keyword, pattern.format(f"(?:{name})"), priority, weight))
    out += [(label, keyword, p, priority, w) for label, keyword, p, priority, w in NOTICES]
    out.sort(key=lambda r: (r[3], r[0], r[2]))
    return [(n, a, k, f" {p}(?= )", pr, w) for n, (a, k, p, pr, w) in enumerate(out)]


def normal(text: Column) -> Column:
    """The words of a text, each after one blank, and a blank at the end."""
    bare = F.btrim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), BREAKS, " "))
    return F.concat(F.lit(" "), bare, F.lit(" "))


def blanks(c: Column) -> Column:
    return (F.length(c) - F.length(F.translate(c, " ", ""))).cast("bigint")


def gated(text: Column) -> Column:
    """Whether a rule's keyword may stand in the text. Each text that a rule
    finds holds its keyword, at any place of a word, and each base phrase is a
    rule, so the test loses nothing."""
    def holds(lower: Column) -> Column:
        test = F.lit(False)
        for word in sorted({r[2] for r in rules()}):
            test = test | F.contains(lower, F.lit(word))
        return test

    # a one-element transform: the text is lower-cased once for all tests,
    # also where a filter is pushed down
    return F.get(F.transform(F.array(F.lower(F.coalesce(text, F.lit("")))), holds), 0)


def _base(norm: Column, n_words: Column) -> dict[str, Column]:
    found = []
    for phrase, label in BASE:
        key = f" {phrase} "
        n = F.regexp_count(norm, F.lit(f" {phrase}(?= )")).cast("bigint")
        first = blanks(F.substring(norm, F.lit(1), F.instr(norm, key) - 1))
        last = n_words - blanks(F.substring_index(norm, key, -1)) - len(phrase.split())
        found.append((label, n, F.when(n > 0, first), F.when(n > 0, last)))
    labels = F.array_compact(F.array(*[F.when(n > 0, F.lit(label)) for label, n, _, _ in found]))
    return {"n_base": sum((n for _, n, _, _ in found[1:]), found[0][1]),
            "first_word": F.least(*[f for _, _, f, _ in found]),
            "last_word": F.greatest(*[x for _, _, _, x in found]),
            "base": F.array_sort(F.array_distinct(labels))}


def detections(rows: DataFrame, table: Sequence[tuple] | None = None) -> DataFrame:
    """Rows ``(doc_id, row, label, start, stop, weight)`` of the finds in
    ``rows(doc_id, row, norm)`` that lie inside no other."""
    spark = rows.sparkSession
    table = list(table if table is not None else rules())
    signatures = spark.createDataFrame(
        table, "rule int, label string, keyword string, regex string, priority int, weight double")
    keywords = F.array(*[F.lit(k) for k in sorted({r[2] for r in table})])
    held = F.filter(keywords, lambda k: F.contains(F.col("norm"), k))
    tried = rows.withColumn("_uid", F.monotonically_increasing_id()) \
        .withColumn("keyword", F.explode(held)).join(F.broadcast(signatures), "keyword")
    found = F.expr("regexp_extract_all(norm, regex, 0)")
    tried = tried.withColumn("_found", found).where(F.size("_found") > 0)
    steps = F.arrays_zip(
        F.transform(F.col("_found"), blanks).alias("words"),
        F.transform(F.slice(F.expr("split(norm, regex)"), F.lit(1), F.size("_found")), blanks).alias("gap"))
    spans = tried.select("_uid", "doc_id", "row", "rule", "label", "priority", "weight",
                         F.posexplode(steps).alias("nth", "s"))
    so_far = Window.partitionBy("_uid", "rule").orderBy("nth")
    spans = spans.withColumn("stop", F.sum(F.col("s.gap") + F.col("s.words")).over(so_far)) \
        .withColumn("start", F.col("stop") - F.col("s.words"))
    before = Window.partitionBy("_uid").orderBy("start", F.desc("stop"), "priority", "rule") \
        .rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("_reach", F.max("stop").over(before))
    return spans.where("_reach is null or stop > _reach") \
        .select("doc_id", "row", "label", "start", "stop", "weight")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_words, n_base, first_word,
    last_word, base_labels, labels, score``; the score is the weight of the
    strongest find (0 without any).

    Null and empty texts have no words and no labels; null ids and repeated
    rows each come back; texts are read whole; an empty table gives an empty
    result; other columns are not read.
    """
    text = F.col("text")
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = source.select("doc_id", F.xxhash64("text").alias("row"),
                       F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")
                       .alias("n_words"),
                       F.when(gated(text), normal(text)).otherwise(F.lit("  ")).alias("norm"))
    rows = stored(rows, "license-texts")  # read twice; most texts hold no keyword and are left blank
    found = detections(rows.where("norm <> '  '").select("doc_id", "row", "norm"))
    found = found.groupBy("doc_id", "row").agg(F.collect_set("label").alias("_labels"),
                                               F.max("weight").alias("_weight"))
    base = _base(F.col("norm"), F.col("n_words"))
    rows = rows.select("doc_id", "row", "n_words", *[c.alias(n) for n, c in base.items()])
    out = rows.alias("r").join(found.alias("f"), F.col("r.doc_id").eqNullSafe(F.col("f.doc_id"))
                               & (F.col("r.row") == F.col("f.row")), "left")
    none = F.array().cast("array<string>")
    labels = F.array_sort(F.array_union("base", F.coalesce("_labels", none)))
    score = F.greatest(F.coalesce("_weight", F.lit(0.0)),
                       F.when(F.size("base") > 0, BASE_SCORE).otherwise(0.0))
    return out.select("r.doc_id", "n_words", "n_base", "first_word", "last_word",
                      F.array_join("base", ",").alias("base_labels"),
                      F.array_join(labels, ",").alias("labels"), score.alias("score"))

"""License scan against plain Python, suppression by hand, and edge cases."""
import re
from collections import Counter

from llm_help import SF01, edge_docs, empty_docs  # noqa: F401
from tessera.llm import license_scan as L

W = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    ws, places, base = W.findall(low), [], set()
    for phrase, label in L.BASE:
        q = phrase.split()
        for i in range(len(ws) - len(q) + 1):
            if ws[i:i + len(q)] == q:
                places.append(i)
                base.add(label)
    norm, spans = f" {' '.join(ws)} ", []
    for n, label, keyword, regex, priority, weight in L.rules():
        if f" {keyword} " in norm:
            for m in re.finditer(regex, norm):
                start = norm[:m.start()].count(" ")
                spans.append((start, -start - m[0].count(" "), priority, n, label, weight))
    reach, labels, score = -1, set(), L.BASE_SCORE if base else 0.0
    for start, stop, _, _, label, weight in sorted(spans):
        if -stop > reach:
            reach = -stop
            labels.add(label)
            score = max(score, weight)
    return (len(ws), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(base | labels)), score)


COLUMNS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def check(docs):
    got = Counter((r["doc_id"], *[r[c] for c in COLUMNS]) for r in L.scan(docs).collect())
    assert got == Counter((r["doc_id"], *plain(r["text"])) for r in docs.collect())


def test_documents_and_edge_cases(spark, edge_docs, empty_docs):
    check(spark.read.parquet(f"{SF01}/documents.parquet"))
    check(edge_docs)
    assert L.scan(empty_docs).count() == 0


def test_phrases_and_suppression(spark):
    texts = ["Licensed under the Apache License, Version 2.0. All Rights\nReserved",
             "cc by cc by cc-by, CC BY-NC 4.0", "GNU General Public License version 3 or General public license",
             "Released under the MIT License (mit)", "SPDX-License-Identifier: GPLv3 only; in the public domain",
             "all rights reserve", "x cc", "by cc by", "mit der und", "Permission is hereby granted, free of "
             "charge, to any person obtaining a copy", ("cc by " * 3000) + "end"]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert plain(texts[0])[5] == "apache-2.0,reserved" and plain(texts[3])[5] == "mit"
    assert plain(texts[8])[5] == ""


def test_there_are_hundreds_of_rules_each_with_its_keyword():
    rules = L.rules()
    assert len(rules) >= 300 and all(re.compile(r[3]) for r in rules)


def ungated(text):
    """Labels and score of the finds, without any test for keywords."""
    norm, spans = f" {' '.join(W.findall((text or '').lower()))} ", []
    for n, label, _, regex, priority, weight in L.rules():
        for m in re.finditer(regex, norm):
            start = norm[:m.start()].count(" ")
            spans.append((start, -start - m[0].count(" "), priority, n, label, weight))
    reach, labels, score = -1, set(), 0.0
    for _, stop, _, _, label, weight in sorted(spans):
        if -stop > reach:
            reach = -stop
            labels.add(label)
            score = max(score, weight)
    return ",".join(sorted(labels)), score


def test_no_rule_is_lost_to_its_keyword(spark):
    names = ["the Common Development and Distribution License 1.0", "FreeBSD", "Licensed under Apache2",
             "Apache2.0 license", "licensed under apache2.0", "cddl1", "CDDL 1.0", "GPLv3", "OpenRAIL-M", "wtfpl"]
    texts = [f"this is {x} here" for x in names]
    got = [(r["labels"], r["score"]) for r in L.scan(spark.createDataFrame(
        list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert got == [ungated(t) for t in texts] and all(x for x, _ in got)


def test_each_alternative_holds_its_keyword():
    """Every text that the parts of a rule's regex allow holds the keyword."""
    import re._parser as parser

    def needs(tree, keyword):
        run = ""
        for op, value in tree:
            name = str(op)
            if name == "LITERAL":
                run += chr(value)
                if keyword in run:
                    return True
                continue
            run = ""
            inside = [value[-1]] if name == "SUBPATTERN" else value[1] if name == "BRANCH" else \
                [value[2]] if name == "MAX_REPEAT" and value[0] > 0 else []
            if inside and all(needs(x, keyword) for x in inside):
                return True
        return False

    lost = [(r[1], r[2]) for r in L.rules() if not needs(parser.parse(r[3]), r[2])]
    assert not lost, lost

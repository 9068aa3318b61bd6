"""Quality rules with cross-document line frequency, in DataFrame operations.

Text measures are expressions on one row. Lines are hashed after
normalisation, and for each host and line the distinct documents are counted.
Exact copies are one document here (a document is its text), so a text does
not become boilerplate by being copied. Lines that stand in more documents
than the limit are removed, and documents that keep too little are rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.util import stored

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 3
#: A document fails the base rules below so many words, or above so many per
#: cent of words in repeated windows.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: A line is boilerplate of a host if it stands in at least so many of the
#: host's distinct documents, whatever the size of the host ...
MIN_LINE_DOCS = 20
#: ... or, on a small host, in more than this share of them and at least so many.
MAX_LINE_SHARE, MIN_SHARE_DOCS = 0.1, 5
#: A document is depleted if less than this share of its words remains, or
#: fewer than a document must have.
MIN_LEFT_SHARE = 0.3


def words_of(text: Column) -> Column:
    """Words split at ASCII white space; null and empty texts have none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")) \
        .otherwise(F.split(bare, "[\\x20\\x09-\\x0D]+"))


def repeated_words(words: Column) -> Column:
    """Words that some three-word window covers whose words occur in that
    order twice or more; linear in the text but for one sort of its windows,
    which only texts with a repeated window take.

    Windows are sorted by their hash and place; a window is repeated if a
    neighbour has the same hash. The places of the repeated ones, in order,
    each add the words that the one before did not cover."""
    n = F.size(words) - (WINDOW - 1)
    hashes = F.when(n >= 2, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(
        F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))).otherwise(F.array().cast("array<bigint>"))

    def if_any(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(
            _let(_let(F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), covered), total))

    def covered(sorted_windows: Column) -> Column:
        twice = F.filter(sorted_windows, lambda x, k: (
            (x["h"] == F.get(sorted_windows, k - 1)["h"])
            | (x["h"] == F.get(sorted_windows, k + 1)["h"])).eqNullSafe(F.lit(True)))
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    def total(places: Column) -> Column:
        gaps = F.transform(places, lambda p, k: F.least(
            F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, g: a + g)

    return _let(hashes, if_any)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once (a one-element transform)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line of the text."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"),
                     lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    return _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint"))


def measures(text: Column) -> list[Column]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    text = F.coalesce(text, F.lit(""))
    counted = _let(words_of(text), lambda w: F.struct(
        F.size(w).cast("bigint").alias("n"), repeated_words(w).alias("r")))
    return [counted.alias("_words"),
            F.length(F.translate(text, SPACES, "")).cast("bigint").alias("word_chars"),
            F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
            duplicate_lines(text).alias("n_dup_lines")]


def line_words(docs: DataFrame) -> DataFrame:
    """Rows ``(host, text_id, line, words)`` of every line with a word, the
    line as the hash of its normal form: lower-cased, runs of white space one
    space, digits as 0."""
    lines = docs.select("host", "text_id", F.explode(F.split(F.coalesce("text", F.lit("")), "\n"))
                        .alias("l"))
    normal = F.trim(F.regexp_replace(F.regexp_replace(F.lower("l"), "[\\x20\\x09-\\x0D]+", " "),
                                     "[0-9]+", "0"))
    lines = lines.select("host", "text_id", normal.alias("l")).where("l <> ''")
    return lines.select("host", "text_id", F.xxhash64("l").alias("line"),
                        (F.length("l") - F.length(F.translate("l", " ", "")) + 1).cast("bigint")
                        .alias("words"))


def frequent_lines(lines: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows ``(host, line)`` of the lines above the limit. Each count is taken
    of partial counts: equal texts collapse first, then each line is one row
    for each task, so no line or host is gathered anywhere."""
    each = lines.groupBy("host", "line", "text_id").agg(F.lit(1).alias("one"))
    counted = each.groupBy("host", "line").agg(F.count(F.lit(1)).alias("docs"))
    hosts = rows.select("host", "text_id").distinct() \
        .groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    return counted.where(F.col("docs") >= MIN_SHARE_DOCS).join(hosts, "host") \
        .where((F.col("docs") >= MIN_LINE_DOCS) | (F.col("docs") > MAX_LINE_SHARE * F.col("host_docs"))) \
        .select("host", "line")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          host_col: str = "source") -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, the measures,
    ``base_failed``, ``removed_words`` (words in lines above the limit) and
    ``kept``.

    Null and empty texts have zero measures and fail the base rules; a null
    host is a host of its own; null ids and repeated rows each come back; an
    empty table gives an empty result; other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(host_col), F.lit("\0"))
                       .alias("host"), text.alias("text"), F.unhex(F.md5(text)).alias("text_id"))
    # narrow, and read twice: for the frequent lines and for what they remove
    lines = stored(line_words(rows), "quality-lines")
    often = frequent_lines(lines, rows)
    copies = rows.groupBy("host", "text_id").agg(F.count(F.lit(1)).alias("copies"))
    removed = lines.join(often, ["host", "line"], "left_semi") \
        .groupBy("host", "text_id").agg(F.sum("words").alias("removed_in_copies"))
    removed = removed.join(copies, ["host", "text_id"]).select(
        "host", "text_id", (F.col("removed_in_copies") / F.col("copies")).cast("bigint")
        .alias("removed_words"))
    out = rows.select("doc_id", "host", "text_id", *measures(F.col("text")))
    out = out.select("doc_id", "host", "text_id", F.col("_words.n").alias("n_words"), "word_chars",
                     "n_symbols", "n_dup_lines", F.col("_words.r").alias("n_repeat_words"))
    out = out.join(removed, ["host", "text_id"], "left")
    removed_words = F.coalesce("removed_words", F.lit(0).cast("bigint"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    left = F.col("n_words") - removed_words
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", failed.alias("base_failed"),
                      removed_words.alias("removed_words"),
                      (~failed & (left >= MIN_LEFT_SHARE * F.col("n_words")) & (left >= MIN_WORDS)).alias("kept"))

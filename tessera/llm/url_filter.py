"""URL filter: host and path rules first, then logistic regression on hashed
character n-grams, in DataFrame operations.

The model is trained on the driver from the small labelled table below. Its
weights are rounded to integers, so a score is an exact sum whatever the
order, and SQL gives the same.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.util import ascii_lower

#: ``(verdict, host, path start)``; a host stands for all its subdomains.
RULES: tuple[tuple[str, str, str], ...] = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Labelled URLs (1: block): names of unwanted kinds of site, and ordinary ones.
UNWANTED = ("casino-win", "best-casino", "free-bets", "betting-odds", "poker-online", "slots-jackpot",
            "adult-x", "xxx-videos", "porn-tube", "sex-cams", "hot-escorts", "ads-track",
            "adserver", "click-track", "popunder-ads", "track-pixel", "cheap-pills", "viagra-shop",
            "payday-loans", "spam-farm", "link-farm", "crack-warez", "torrent-keygen", "win-prizes", "free-spins", "lottery-win")
ORDINARY = ("news", "weather-report", "city-library", "university", "museum", "cooking-recipes",
            "gardening", "history-notes", "open-science", "travel-guide", "football-club",
            "mathematics", "townhall", "music-school", "therapy-center", "bookstore", "healthcare",
            "docs-online", "software-manual", "encyclopedia", "railway", "thornton", "anderson-law",
            "herenow", "theatre", "station", "blended", "nation", "shire", "tradition")
HOSTS = ("{}.org", "www.{}.net", "blog.{}.com", "m.{}.example.org")
PATHS = ("", "/en/12", "/de/345.html", "/index.html", "/es/7/", "/fr/98")
GRAM, BUCKETS, SCALE = 4, 16384, 1_000_000
STEPS, RATE, DECAY = 120, 2.0, 1e-3
#: Blocked from this probability.
THRESHOLD = 0.75


def training_table() -> list[tuple[str, str, int]]:
    """``(host, path, label)``: each name in each form of host, paths in turn."""
    rows = []
    for label, names in ((1, UNWANTED), (0, ORDINARY)):
        for n, name in enumerate(names):
            for k, host in enumerate(HOSTS):
                rows.append((host.format(name), PATHS[(n + k) % len(PATHS)], label))
    return rows


def buckets(host: str, path: str) -> list[int]:
    """Buckets of all character n-grams of ``^host|path$``, repeats included."""
    s = f"^{host}|{path}$"
    return [int(hashlib.md5(s[i:i + GRAM].encode()).hexdigest()[:8], 16) % BUCKETS
            for i in range(max(len(s) - GRAM + 1, 1))]


def train(table: Sequence[tuple[str, str, int]] | None = None) -> tuple[int, list[int]]:
    """Bias and bucket weights in millionths: full-batch gradient descent on
    the mean of the bucket weights over a URL. Deterministic."""
    data = [(buckets(h, p), y) for h, p, y in (table if table is not None else training_table())]
    bias, weights = 0.0, [0.0] * BUCKETS
    for _ in range(STEPS if data else 0):
        step, up = 0.0, {}
        for grams, y in data:
            z = bias + sum(weights[g] for g in grams)
            err = y - 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
            step += err
            for g in grams:
                up[g] = up.get(g, 0.0) + err
        bias += RATE * step / len(data)
        for g, v in up.items():
            weights[g] += RATE * v / len(data)
        weights = [w * (1 - DECAY) for w in weights]
    return round(bias * SCALE), [round(w * SCALE) for w in weights]


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))) \
        .otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return (ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)),
            F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def _fits(host: Column, path: Column, rule_host: str, rule_path: str) -> Column:
    return ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) \
        & F.startswith(path, F.lit(rule_path))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES
            ) -> tuple[Column, Column]:
    """The longest rule that fits (``net/es/``) and its verdict, else nulls."""
    longest = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in reversed(longest):
        rule = F.when(_fits(host, path, h, p), F.lit(h + p)).otherwise(rule)
        verdict = F.when(_fits(host, path, h, p), F.lit(v)).otherwise(verdict)
    return rule, verdict


def score(host: Column, path: Column, model: tuple[int, list[int]]) -> Column:
    """The model's sum for a URL, in millionths (a BIGINT)."""
    bias, weights = model
    table = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<bigint>")
    s = F.concat(F.lit("^"), host, F.lit("|"), path, F.lit("$"))
    at = F.sequence(F.lit(1), F.greatest(F.length(s) - (GRAM - 1), F.lit(1)))
    bucket = lambda i: F.conv(F.substring(F.md5(F.substring(s, i, F.lit(GRAM))), 1, 8), 16, 10) \
        .cast("bigint") % BUCKETS
    return F.aggregate(at, F.lit(bias).cast("bigint"),
                       lambda a, i: a + F.get(table, bucket(i).cast("int")))


def cutoff() -> int:
    """The sum, in millionths, from which a URL is blocked."""
    return round(math.log(THRESHOLD / (1 - THRESHOLD)) * SCALE)


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
          rules: Sequence[tuple[str, str, str]] = RULES,
          model: tuple[int, list[int]] | None = None) -> DataFrame:
    """Rows ``(page_id, host, path, rule, verdict, score)``, one for each row.

    Null, empty and malformed URLs have empty host and path, no rule, and the
    method's verdict on these; null ids and repeated rows each come back; very
    long URLs are read whole; other columns are not read.
    """
    model = model or train()
    host, path = parts(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("score", score(F.col("host"), F.col("path"), model))
    method = F.when(F.col("score") >= cutoff(), F.lit("block")).otherwise(F.lit("allow"))
    return rows.select("page_id", "host", "path", rule.alias("rule"),
                       F.coalesce(verdict, method).alias("verdict"), "score")


def oracle(rules: Sequence[tuple[str, str, str]] = RULES,
           model: tuple[int, list[int]] | None = None) -> str:
    """:func:`judge` of ``pages`` as DuckDB SQL."""
    bias, weights = model or train()
    longest = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    cases = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') "
                     "THEN '{}'" for v, h, p in longest)
    rule = cases.format(*[h + p for _, h, p in longest])
    verdict = cases.format(*[v for v, _, _ in longest])
    return f"""
WITH model AS (SELECT {weights}::BIGINT[] AS w),
rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0
           THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
split AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
scored AS (SELECT page_id, host, path, CAST({bias} + list_sum(list_transform(
    range(1, greatest(length('^' || host || '|' || path || '$') - {GRAM - 1}, 1) + 1),
    lambda i: w[1 + CAST('0x' || substr(md5(substr('^' || host || '|' || path || '$', i, {GRAM})), 1, 8)
      AS BIGINT) % {BUCKETS}])) AS BIGINT) AS score FROM split, model)
SELECT page_id, host, path, CASE {rule} END AS rule,
  CASE {verdict} WHEN score >= {cutoff()} THEN 'block' ELSE 'allow' END AS verdict, score
FROM scored"""

"""DuckDB SQL for every registered query (the correctness oracle).

Each string runs against views named like the driver's tables. Aggregates
are cast to BIGINT (DuckDB sums to HUGEINT) and every column is aliased to
the Spark name. The synthesis SQL is produced from the same fixed templates
that the Spark plan fills, by turning each template into a SQL
concatenation.
"""

from __future__ import annotations

from tessera.functions.text import template_parts
from tessera.model import ANSWER_TEMPLATE
from tessera.operators.nearcopy import SHINGLE, SIMILARITY
from tessera.plans.corpus import CAP_PER_GROUP, LANG_ORDER, MIN_ENTRIES_TO_LOAD
from tessera.plans.curation import RELEASED_SOURCE, TOKEN_BUDGET, VALIDATION_PERCENT
from tessera.plans.files import BLANK, CUT, TURNED, UNGROUPED
from tessera.plans.streams import REMOVED_SOURCE, REWRITTEN_LANG
from tessera.plans.synthesis import SECTIONS, SYNTH_TEMPLATES
from tessera.plans.training import (BAND, BIN_WIDTH, BYTE_SHARDS, MIXTURE, PACK_BUDGET, PACK_SHARDS, PROBS)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_fill(template: str, values: dict[str, str]) -> str:
    pieces, names = template_parts(template)
    parts = []
    for piece, name in zip(pieces, names):
        if piece:
            parts.append(_q(piece))
        parts.append(values[name])
    if pieces[-1]:
        parts.append(_q(pieces[-1]))
    return "(" + " || ".join(parts) + ")"


def _rank_case(col: str) -> str:
    whens = " ".join(f"WHEN {_q(s)} THEN {i}" for i, s in enumerate(LANG_ORDER))
    return f"(CASE {col} {whens} ELSE 99 END)"


DOC_MANIFEST = """
SELECT lang || '__' || source || '.jsonl' AS file, lang AS skill, source AS subtopic,
       CAST(count(*) AS BIGINT) AS entries,
       CAST(coalesce(sum(strlen(text)), 0) AS BIGINT) AS bytes,
       CAST(coalesce(sum(length(text)), 0) // 4 AS BIGINT) AS approx_tokens,
       CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS chars
FROM documents GROUP BY lang, source
"""

_M = f"(SELECT file, skill, subtopic, entries, bytes, approx_tokens FROM ({DOC_MANIFEST}))"

_CANON = ("'{\"messages\": [' || coalesce(string_agg('{\"role\": ' || to_json(role)::VARCHAR || "
          "', \"content\": ' || to_json(text)::VARCHAR || '}', ', ' ORDER BY turn), '') || ']}'")

_THREADS = f"""
SELECT conv_id, count(*) AS n_messages, {_CANON} AS line,
       sum(length(text)) AS chars,
       arg_min(text, turn) AS first_text, arg_min(role, turn) AS first_role
FROM conversations GROUP BY conv_id
"""

_SYN_DIMS = """
RECURSIVE dims AS (
  SELECT (SELECT list(v ORDER BY v) FROM (SELECT DISTINCT c_mktsegment AS v FROM customer
          WHERE c_mktsegment IS NOT NULL)) AS aud,
         (SELECT list(v ORDER BY v) FROM (SELECT DISTINCT o_orderpriority AS v FROM orders
          WHERE o_orderpriority IS NOT NULL)) AS per,
         (SELECT list(v ORDER BY v) FROM (SELECT DISTINCT o_orderstatus AS v FROM orders
          WHERE o_orderstatus IS NOT NULL)) AS fmts
),
sizes AS (SELECT aud, per, fmts, len(aud) AS na, len(per) AS np, len(fmts) AS nf FROM dims),
placed AS (
  SELECT o.*, c.c_custkey, c.c_name, c.c_mktsegment, n.n_name, __SKILL__ AS gk, __SUB__ AS gs
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  __LEFT__ JOIN orders o ON c.c_custkey = o.o_custkey
),
best AS (
  SELECT gk, gs, o_orderpriority, o_orderkey, o_orderstatus,
         row_number() OVER (PARTITION BY gk, gs, o_orderpriority
                            ORDER BY o_totalprice DESC, o_orderkey) AS rn
  FROM placed WHERE o_orderkey IS NOT NULL
),
top AS (
  SELECT gk, gs, list('order ' || CAST(o_orderkey AS VARCHAR) || ' (' || o_orderstatus || ')'
                      ORDER BY o_orderpriority) AS examples
  FROM best WHERE rn = 1 GROUP BY gk, gs
),
sets AS (
  SELECT gk, gs, any_value(n_name) AS skill, any_value(__SUB__) AS subtopic, any_value(__DEF__) AS def,
         list_sort(list(DISTINCT o_orderpriority) FILTER (o_orderpriority IS NOT NULL)) AS principles,
         list_sort(list_transform(list_sort(list(DISTINCT o_orderstatus) FILTER (o_orderstatus IS NOT NULL)),
                   lambda s: 'leaving orders in status ' || s)) AS mistakes
  FROM placed GROUP BY gk, gs
),
grp AS (
  SELECT s.skill, s.subtopic, s.def, s.principles, t.examples, s.mistakes
  FROM sets s LEFT JOIN top t ON s.gk = t.gk AND s.gs = t.gs
),
grid AS (
  SELECT g.*, i AS idx, replace(g.subtopic, '_', ' ') AS title,
         z.aud[(i % z.na) + 1] AS audience,
         z.per[((i // z.na) % z.np) + 1] AS perspective,
         z.fmts[((i // (z.na * z.np)) % z.nf) + 1] AS fmt,
         (i // (z.na * z.np * z.nf)) % __NT__ AS template_pos
  FROM grp g, sizes z, range(0, (SELECT na * np * nf * __NT__ FROM sizes)) r(i)
),
keyed AS (
  SELECT *, __PROMPT__ AS prompt FROM grid
  WHERE def IS NOT NULL AND len(principles) > 0 AND len(examples) > 0 AND len(mistakes) > 0
),
firsts AS (
  SELECT *, row_number() OVER (PARTITION BY skill, subtopic, md5(prompt) ORDER BY idx) AS dup_rn
  FROM keyed
),
kept AS (SELECT * FROM firsts WHERE dup_rn = 1)
"""


def _prompt_sql() -> str:
    vals = {"topic": "title", "audience": "audience", "perspective": "perspective", "fmt": "fmt"}
    whens = " ".join(f"WHEN {i} THEN {sql_fill(t, vals)}" for i, t in enumerate(SYNTH_TEMPLATES))
    return f"(CASE template_pos {whens} END)"


def _answer_sql() -> str:
    def pick(arr: str, stride: int) -> str:
        return f"{arr}[((idx // {stride}) % len({arr})) + 1]"
    vals = {"title": "title", "Title": "(upper(substr(title, 1, 1)) || lower(substr(title, 2)))",
            "perspective": "perspective", "fmt": "fmt", "audience": "audience",
            "definition": "def", "principle": pick("principles", 3),
            "example": pick("examples", 1), "mistake": pick("mistakes", 5)}
    return sql_fill(ANSWER_TEMPLATE, vals)


_CUSTOMERS = ("n_name", "c_name", "LEFT",
              "('the ' || lower(c_mktsegment) || ' account of ' || c_name || ' in ' || n_name)")
_SEGMENTS = ("n_name", "c_mktsegment", "INNER", "('the ' || lower(c_mktsegment) || ' market of ' || n_name)")


def _synth_with(files: tuple[str, str, str, str] = _CUSTOMERS) -> str:
    sql = "WITH " + _SYN_DIMS
    for mark, text in zip(("__SKILL__", "__SUB__", "__LEFT__", "__DEF__"), files):
        sql = sql.replace(mark, text)
    return sql.replace("__NT__", str(len(SYNTH_TEMPLATES))).replace("__PROMPT__", _prompt_sql())


#: The generator's loop as a recursion, once for each list of key classes: the
#: index is kept + tried, and both grow when a key is new.
_WALK = """
, classes AS (
  SELECT skill, subtopic, idx, min(idx) OVER (PARTITION BY skill, subtopic, md5(prompt)) AS c FROM keyed
),
lists AS (SELECT skill, subtopic, list(c ORDER BY idx) AS ks FROM classes GROUP BY skill, subtopic),
steps AS (
  SELECT ks, len(list_distinct(ks)) AS n, CAST(0 AS BIGINT) AS tried, CAST([] AS BIGINT[]) AS seen,
         CAST(NULL AS BIGINT) AS took
  FROM (SELECT DISTINCT ks FROM lists)
  UNION ALL
  SELECT ks, n, tried + 1,
         CASE WHEN list_contains(seen, ks[(len(seen) + tried + 1) % len(ks) + 1]) THEN seen
              ELSE list_append(seen, ks[(len(seen) + tried + 1) % len(ks) + 1]) END,
         CASE WHEN list_contains(seen, ks[(len(seen) + tried + 1) % len(ks) + 1]) THEN NULL
              ELSE len(seen) + tried + 1 END
  FROM steps WHERE len(seen) < n AND tried < 5 * len(ks)
),
walked AS (
  SELECT l.skill, l.subtopic, s.took AS idx, len(l.ks) AS period
  FROM lists l JOIN steps s ON l.ks = s.ks WHERE s.took IS NOT NULL
)
"""

_CANON_LINE = ("('{\"messages\": [{\"role\": \"user\", \"content\": ' || to_json(prompt)::VARCHAR"
               " || '}, {\"role\": \"assistant\", \"content\": ' || to_json(answer)::VARCHAR || '}]}')")


def _manifest_of(entries: str) -> str:
    return f"""
SELECT skill || '__' || subtopic || '.jsonl' AS file, skill, subtopic,
       CAST(count(*) AS BIGINT) AS entries,
       CAST(sum(strlen({_CANON_LINE}) + 1) AS BIGINT) AS bytes,
       CAST(sum(length(prompt) + length(answer)) // 4 AS BIGINT) AS approx_tokens
FROM ({entries}) GROUP BY skill, subtopic
"""


def _kept_entries() -> str:
    return f"SELECT skill, subtopic, idx, prompt, {_answer_sql()} AS answer FROM kept"


def _walked_entries() -> str:
    return f"""SELECT skill, subtopic, prompt, {_answer_sql()} AS answer FROM (
      SELECT k.* EXCLUDE (idx), w.idx AS idx FROM walked w JOIN keyed k
      ON k.skill = w.skill AND k.subtopic = w.subtopic AND k.idx = w.idx % w.period)"""


_DIMS = ("audience", "perspective", "fmt", "template")
_SIZES = {"audience": "na", "perspective": "np", "fmt": "nf", "template": str(len(SYNTH_TEMPLATES))}

#: Positions of the kept entries in each dimension.
_CELLS = f"""
, cells AS (
  SELECT CAST(idx % na AS INTEGER) AS audience, CAST(idx // na % np AS INTEGER) AS perspective,
         CAST(idx // (na * np) % nf AS INTEGER) AS fmt, CAST(template_pos AS INTEGER) AS template
  FROM kept, sizes
)
"""


def _diversity_audit() -> str:
    parts = []
    for dims in [(a,) for a in _DIMS] + [(a, b) for i, a in enumerate(_DIMS) for b in _DIMS[i + 1:]]:
        parts.append(f"""SELECT '{"+".join(dims)}' AS dims, CAST(sum(n) AS BIGINT) AS entries, count(*) AS present,
  CAST(any_value({" * ".join(_SIZES[d] for d in dims)}) AS BIGINT) AS possible, sum(n * log2(n)) AS s
  FROM (SELECT {", ".join(dims)}, count(*) AS n FROM cells GROUP BY ALL), sizes""")
    return _synth_with() + _CELLS + f"""
SELECT dims, entries, present, possible, possible - present AS missing,
       round(greatest(log2(entries) - s / entries, 0), 6) AS entropy,
       round(CASE WHEN possible > 1 THEN greatest(log2(entries) - s / entries, 0) / log2(possible) ELSE 1 END, 6) AS evenness
FROM ({" UNION ALL ".join(parts)})"""


def _diversity_missing() -> str:
    def columns(dims: tuple[str, ...]) -> str:
        return ", ".join((d if d in dims else f"-1 AS {d}") for d in _DIMS)
    parts = []
    for dims in [(a,) for a in _DIMS] + [(a, b) for i, a in enumerate(_DIMS) for b in _DIMS[i + 1:]]:
        ranges = ", ".join(f"(SELECT CAST(unnest(range({_SIZES[d]})) AS INTEGER) AS {d} FROM sizes)" for d in dims)
        parts.append(f"""SELECT '{"+".join(dims)}' AS dims, {columns(dims)} FROM (
  SELECT * FROM {ranges} EXCEPT SELECT {", ".join(dims)} FROM cells)""")
    return _synth_with() + _CELLS + " UNION ALL ".join(parts)


def _flat_lines() -> str:
    """The lines of the corpus with all sorts of lines, by file."""
    def hit(rule: tuple[int, int]) -> str:
        return f"doc_id % {rule[0]} = {rule[1]}"

    def entry(first: str, second: str) -> str:
        role = {"user": "'Write a text in ' || lang || '.'", "assistant": "text"}
        turn = [f"'{{\"role\": \"{r}\", \"content\": ' || to_json({role[r]})::VARCHAR || '}}'" for r in (first, second)]
        return f"('{{\"messages\": [' || {turn[0]} || ', ' || {turn[1]} || ']}}')"
    return f"""
SELECT lang AS skill, source AS subtopic, {hit(UNGROUPED)} AS odd, {hit(BLANK)} AS blank, {hit(CUT)} AND NOT {hit(BLANK)} AS broken,
       {hit(TURNED)} AS turned, coalesce(trim(text), '') <> '' AS filled, length(text) AS chars, length('Write a text in ' || lang || '.') AS asked,
       CASE WHEN {hit(BLANK)} THEN '  ' WHEN {hit(CUT)} THEN substr(e, 1, 40) ELSE e END AS line, whole
FROM (SELECT *, CASE WHEN {hit(TURNED)} THEN {entry("assistant", "user")} ELSE {entry("user", "assistant")} END AS e,
             {entry("user", "assistant")} AS whole FROM documents)"""


def oracle_sql() -> dict[str, str]:
    rank = _rank_case("skill")
    order_values = ", ".join(f"({i}, {_q(s)})" for i, s in enumerate(LANG_ORDER))
    q: dict[str, str] = {
        "corpus_manifest": _M,
        "ranked_manifest": f"""
SELECT *, {rank} AS rank,
       row_number() OVER (ORDER BY {rank}, subtopic, skill) AS position FROM {_M}""",
        "corpus_totals": f"""
SELECT CAST(count(*) AS BIGINT) AS files, CAST(sum(entries) AS BIGINT) AS entries,
       CAST(sum(bytes) AS BIGINT) AS bytes, CAST(sum(approx_tokens) AS BIGINT) AS approx_tokens
FROM {_M}""",
        "skill_rollup": f"""
SELECT skill, CAST(count(*) AS BIGINT) AS files, CAST(sum(entries) AS BIGINT) AS entries,
       CAST(sum(approx_tokens) AS BIGINT) AS approx_tokens, CAST(sum(bytes) AS BIGINT) AS bytes
FROM {_M} GROUP BY skill""",
        "fixed_order_report": f"""
WITH o(rank, skill) AS (VALUES {order_values}),
r AS (SELECT skill, count(*) AS files, sum(entries) AS entries, sum(approx_tokens) AS approx_tokens,
             sum(bytes) AS bytes FROM {_M} GROUP BY skill)
SELECT CAST(o.rank AS INTEGER) AS rank, o.skill,
       CAST(coalesce(files, 0) AS BIGINT) AS files, CAST(coalesce(entries, 0) AS BIGINT) AS entries,
       CAST(coalesce(approx_tokens, 0) AS BIGINT) AS approx_tokens,
       CAST(coalesce(bytes, 0) AS BIGINT) AS bytes,
       round(CAST(coalesce(bytes, 0) AS DOUBLE) / 1048576.0, 1) AS size_mb
FROM o LEFT JOIN r ON o.skill = r.skill""",
        "coverage_table": f"""
SELECT CASE WHEN grouping(skill) = 1 THEN 'Total' ELSE skill END AS skill,
       CASE WHEN grouping(skill) = 1 THEN 100 ELSE {rank} END AS rank,
       CAST(count(*) AS BIGINT) AS files, CAST(sum(entries) AS BIGINT) AS entries,
       CAST(sum(approx_tokens) AS BIGINT) AS approx_tokens, CAST(sum(bytes) AS BIGINT) AS bytes
FROM {_M} GROUP BY ROLLUP (skill)""",
        "subtopic_lists": f"""
SELECT skill, CAST(count(*) AS BIGINT) AS files, string_agg(subtopic, ', ' ORDER BY subtopic) AS subtopics
FROM {_M} GROUP BY skill""",
        "entry_averages": f"""
SELECT file, skill, subtopic, entries, chars / entries AS avg_chars,
       approx_tokens / entries AS avg_tokens FROM ({DOC_MANIFEST})""",
        "subset_skill": "SELECT * FROM documents WHERE lang = 'en'",
        "manifest_subset": f"""
SELECT d.doc_id, d.lang AS skill, d.source AS subtopic FROM documents d
WHERE (d.lang, d.source) IN (SELECT (skill, subtopic) FROM {_M} WHERE entries >= {MIN_ENTRIES_TO_LOAD})""",
        "dedup_first_wins": """
SELECT doc_id, lang, source, text_md5 FROM (
  SELECT doc_id, lang, source, md5(text) AS text_md5,
         row_number() OVER (PARTITION BY lang, source, md5(text) ORDER BY doc_id) AS rn
  FROM documents) WHERE rn = 1""",
        "dedup_corpus": """
SELECT doc_id, lang, source, text_md5 FROM (
  SELECT doc_id, lang, source, md5(text) AS text_md5,
         row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS rn
  FROM documents) WHERE rn = 1""",
        "cap_per_group": f"""
SELECT doc_id, lang, source FROM (
  SELECT doc_id, lang, source, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS rn
  FROM documents) WHERE rn <= {CAP_PER_GROUP}""",
        "chat_assemble": f"SELECT conv_id, CAST(n_messages AS INTEGER) AS n_messages, line FROM ({_THREADS})",
        "chat_flatten": "SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 "
                        "AS BIGINT) AS turn, role, text FROM conversations",
        "chat_stats": f"""
SELECT conv_id, CAST(chars AS BIGINT) AS chars, md5(first_text) AS first_md5,
       CAST(strlen(line) AS BIGINT) AS line_bytes, CAST(strlen(line) AS BIGINT) AS line_octets
FROM ({_THREADS})""",
        "chat_manifest": f"""
SELECT 'conversations__' || sub || '.jsonl' AS file, 'conversations' AS skill, sub AS subtopic,
       CAST(count(*) AS BIGINT) AS entries, CAST(sum(strlen(line) + 1) AS BIGINT) AS bytes,
       CAST(sum(chars) // 4 AS BIGINT) AS approx_tokens
FROM (SELECT *, CASE WHEN first_role = 'system' THEN 'with_system' ELSE 'plain' END AS sub
      FROM ({_THREADS})) GROUP BY sub""",
        "synth_grid": _synth_with() + """
SELECT skill, subtopic, CAST(idx AS BIGINT) AS idx, md5(prompt) AS prompt_md5 FROM keyed""",
        "synth_first_wins": _synth_with() + """
SELECT skill, subtopic, CAST(idx AS BIGINT) AS idx, md5(prompt) AS prompt_md5 FROM kept""",
        "synth_manifest": _synth_with() + _manifest_of(_kept_entries()),
        "synth_walk": _synth_with() + _WALK + "SELECT skill, subtopic, CAST(idx AS BIGINT) AS idx FROM walked",
        "synth_walk_manifest": _synth_with() + _WALK + _manifest_of(_walked_entries()),
        "synth_entries": _synth_with() + f"""
SELECT skill, subtopic, CAST(idx AS BIGINT) AS idx, md5(prompt) AS prompt_md5, md5(answer) AS answer_md5,
       md5({_CANON_LINE}) AS line_md5 FROM ({_kept_entries()})""",
        "synth_corpus_files": _synth_with() + _manifest_of(_kept_entries()),
        "diversity_audit": _diversity_audit(),
        "diversity_missing": _diversity_missing(),
        "section_audit": _synth_with() + f"""
SELECT skill, subtopic, CAST(count(*) AS BIGINT) AS entries,
  CAST(count(*) FILTER (regexp_extract_all(answer, '\\*\\*([^*]+)\\.\\*\\*', 1) = {SECTIONS}
    AND len(list_filter(regexp_split_to_array(answer, '\\*\\*[^*]+\\.\\*\\*')[2:],
                        lambda b: trim(b) = '')) = 0) AS BIGINT) AS complete
FROM ({_kept_entries()}) GROUP BY skill, subtopic""",
        "synth_failures": _synth_with() + f"""
, each AS (SELECT na * np * nf AS p FROM sizes),
wanted AS (SELECT c_name AS name, c_acctbal < 0 AS debt,
                  NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey) AS lost
           FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
           UNION ALL SELECT s_name, false, true FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey),
f AS (SELECT CAST(count(*) FILTER (lost) AS BIGINT) AS missing, CAST(count(*) FILTER (NOT lost AND debt) AS BIGINT) AS bad,
             CAST(count(*) FILTER (NOT lost AND NOT debt) AS BIGINT) AS usable FROM wanted)
SELECT r.reason, CAST(CASE r.reason WHEN 'missing_group' THEN missing WHEN 'definition' THEN bad ELSE usable END AS BIGINT) AS files,
       CAST(CASE r.reason WHEN 'missing_group' THEN missing * p * {len(SYNTH_TEMPLATES) + 1}
                          WHEN 'definition' THEN bad * p * {len(SYNTH_TEMPLATES) + 1} ELSE usable * p END AS BIGINT) AS entries
FROM f, each, (VALUES ('missing_group'), ('definition'), ('template')) r(reason)""",
        "generation_result": _synth_with(_SEGMENTS) + f"""
, w AS (SELECT count(DISTINCT (n_name, c_mktsegment)) AS files FROM customer JOIN nation ON c_nationkey = n_nationkey),
t AS (SELECT files * na * np * nf * {len(SYNTH_TEMPLATES) + 1} AS tried FROM w, sizes),
k AS (SELECT count(*) AS usable FROM keyed),
m AS (SELECT sum(entries) AS kept, sum(bytes) AS bytes, sum(chars) AS chars, count(*) AS files FROM (
  SELECT skill, subtopic, count(*) AS entries, sum(strlen({_CANON_LINE}) + 1) AS bytes, sum(length(prompt) + length(answer)) AS chars
  FROM ({_kept_entries()}) GROUP BY skill, subtopic))
SELECT r.measure, CAST(CASE r.measure WHEN 'tried' THEN tried WHEN 'failed' THEN tried - usable WHEN 'repeated' THEN usable - kept
  WHEN 'kept' THEN kept WHEN 'scanned' THEN kept WHEN 'chars' THEN chars WHEN 'files' THEN files ELSE bytes END AS BIGINT) AS value
FROM t, k, m, (VALUES ('tried'), ('failed'), ('repeated'), ('kept'), ('chars'), ('bytes'), ('files'), ('file_bytes'), ('scanned')) r(measure)""",
        "hierarchy_lists": """
SELECT r_name AS skill, r_regionkey AS skill_rank, CAST(count(*) AS BIGINT) AS files,
       string_agg(n_name, ', ' ORDER BY n_nationkey DESC) AS subtopics
FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, r_regionkey""",
        "manifest_round_trip": _M,
        "token_budget_plan": f"""
SELECT file, approx_tokens, CAST(r AS BIGINT) AS running_tokens, entries AS loaded FROM (
  SELECT *, sum(approx_tokens) OVER (ORDER BY approx_tokens DESC, file ROWS UNBOUNDED PRECEDING) AS r
  FROM {_M}) WHERE r <= {TOKEN_BUDGET}""",
        "manifest_reconcile": f"""
WITH d AS (SELECT *, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS rn FROM documents),
b AS (SELECT lang AS skill, source AS subtopic, count(*) AS entries, sum(strlen(text)) AS bytes,
             sum(length(text)) // 4 AS approx_tokens FROM d WHERE rn = 1 GROUP BY lang, source)
SELECT coalesce(a.skill, b.skill) AS skill, coalesce(a.subtopic, b.subtopic) AS subtopic,
  CASE WHEN b.entries IS NULL THEN 'missing' WHEN a.entries IS NULL THEN 'extra'
       WHEN a.entries = b.entries AND a.bytes = b.bytes AND a.approx_tokens = b.approx_tokens THEN 'same'
       ELSE 'changed' END AS status,
  CAST(coalesce(a.entries, 0) AS BIGINT) AS stored_entries, CAST(coalesce(a.bytes, 0) AS BIGINT) AS stored_bytes,
  CAST(coalesce(a.approx_tokens, 0) AS BIGINT) AS stored_approx_tokens,
  CAST(coalesce(b.entries, 0) AS BIGINT) AS computed_entries,
  CAST(coalesce(b.bytes, 0) AS BIGINT) AS computed_bytes,
  CAST(coalesce(b.approx_tokens, 0) AS BIGINT) AS computed_approx_tokens
FROM {_M} a FULL JOIN b ON a.skill = b.skill AND a.subtopic = b.subtopic""",
        "chat_validate": """
WITH t AS (SELECT conv_id, list(role ORDER BY turn) AS roles,
             bool_and(coalesce(trim(text), '') <> '') AS no_empty FROM conversations GROUP BY conv_id),
s AS (SELECT *, CASE WHEN roles[1] = 'system' THEN roles[2:] ELSE roles END AS talk FROM t),
r AS (SELECT conv_id, len(list_filter(roles, lambda x: x NOT IN ('system', 'user', 'assistant'))) = 0 AS known_roles,
  coalesce(talk[1] = 'user', false) AS starts_user,
  len(list_filter(range(1, len(talk) + 1), lambda i: talk[i] <> CASE WHEN i % 2 = 1 THEN 'user' ELSE 'assistant' END))
    = 0 AS alternates,
  roles[-1] = 'assistant' AS ends_assistant, no_empty FROM s)
SELECT *, known_roles AND starts_user AND alternates AND ends_assistant AND no_empty AS valid FROM r""",
        "hash_split": f"""
SELECT doc_id, b AS bucket, CASE WHEN b < {VALIDATION_PERCENT} THEN 'validation' ELSE 'train' END AS split
FROM (SELECT doc_id, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 6) AS BIGINT) % 100 AS b
      FROM documents)""",
        "release_dedup": f"""
SELECT doc_id, source, md5(text) AS text_md5 FROM documents WHERE source <> '{RELEASED_SOURCE}'
AND md5(text) NOT IN (SELECT md5(text) FROM documents WHERE source = '{RELEASED_SOURCE}')""",
    }
    tokens = "(SELECT doc_id, lang, coalesce(length(text), 0) // 4 AS tokens, md5(CAST(doc_id AS VARCHAR)) AS h FROM documents)"
    bucket = "CAST('0x' || substr(h, 1, 3) AS INTEGER)"
    weights = ", ".join(f"('{g}', {w})" for g, w in MIXTURE.items())
    marks = ", ".join(f"quantile_cont(tokens, {p}) AS p{f'{p * 100:g}'.replace('.', '_')}" for p in PROBS)
    q |= {
        "pack_sequences": f"""
SELECT doc_id, CAST(tokens AS BIGINT) AS tokens, shard, CAST(b // {PACK_BUDGET} AS BIGINT) AS pack,
       CAST(b % {PACK_BUDGET} AS BIGINT) AS start
FROM (SELECT *, sum(tokens) OVER (PARTITION BY shard ORDER BY h, doc_id, tokens ROWS UNBOUNDED PRECEDING) - tokens AS b
      FROM (SELECT *, CAST(CAST('0x' || substr(h, 1, 6) AS BIGINT) % {PACK_SHARDS} AS INTEGER) AS shard FROM {tokens}))""",
        "mixture_sample": f"""
WITH d AS (SELECT *, {bucket} AS bucket FROM {tokens}), w(lang, w) AS (VALUES {weights}),
u AS (SELECT min(t // w) AS unit FROM (SELECT lang, sum(tokens) AS t FROM d GROUP BY lang) JOIN w USING (lang)),
h AS (SELECT lang, bucket, sum(sum(tokens)) OVER (PARTITION BY lang ORDER BY bucket) AS run FROM d GROUP BY lang, bucket),
c AS (SELECT lang, coalesce(min(bucket) FILTER (run > w * unit), 4096) AS cutoff FROM h JOIN w USING (lang), u GROUP BY lang)
SELECT doc_id, d.lang, bucket, CAST(tokens AS BIGINT) AS tokens FROM d JOIN c ON d.lang = c.lang AND bucket < cutoff""",
        "byte_shards": f"""
WITH d AS (SELECT doc_id, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 3) AS INTEGER) AS bucket,
                  strlen(text) AS s FROM documents),
h AS (SELECT bucket, sum(sum(s)) OVER (ORDER BY bucket) - sum(s) AS before, sum(sum(s)) OVER () AS total FROM d GROUP BY bucket)
SELECT doc_id, bucket, CAST(least({BYTE_SHARDS} - 1, before * {BYTE_SHARDS} // total) AS INTEGER) AS shard FROM d JOIN h USING (bucket)""",
        "length_profile": f"""
SELECT lang AS skill, count(*) AS entries, min(tokens) AS least, max(tokens) AS greatest,
       avg(CASE WHEN tokens BETWEEN {BAND[0]} AND {BAND[1]} THEN 1 ELSE 0 END) AS in_band, {marks} FROM {tokens} GROUP BY lang""",
        "length_bins": f"""
SELECT lang AS skill, CAST(tokens // {BIN_WIDTH} * {BIN_WIDTH} AS BIGINT) AS bin, count(*) AS entries FROM {tokens} GROUP BY 1, 2""",
        "near_copy_members": """
SELECT doc_id, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS class FROM documents""",
        "near_copy_pairs": f"""
WITH d AS (SELECT min(doc_id) AS id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
           FROM documents GROUP BY text),
s AS (SELECT id, list_distinct(list_transform(range(1, greatest(len(w) - {SHINGLE}, 0) + 2),
        lambda i: array_to_string(w[i:i + {SHINGLE} - 1], ' '))) AS s FROM d WHERE len(w) > 0),
e AS (SELECT id, len(s) AS n, unnest(s) AS x FROM s),
p AS (SELECT a.id AS a, b.id AS b, count(*) AS shared, any_value(a.n + b.n) AS total
      FROM e a JOIN e b ON a.x = b.x AND a.id < b.id GROUP BY 1, 2)
SELECT a, b, CAST(shared AS INTEGER) AS shared, round(shared / (total - shared), 6) AS similarity
FROM p WHERE shared >= {SIMILARITY} * (total - shared) - 1e-9""",
        "length_sketch": f"""
SELECT lang AS skill, p, count(*) AS entries, true AS within
FROM documents, (SELECT CAST(unnest({list(PROBS)}) AS DOUBLE) AS p) GROUP BY lang, p""",
        "flat_corpus_manifest": f"""
SELECT skill || '__' || subtopic || '.jsonl' AS file, skill, subtopic, count(*) AS entries,
       CAST(sum(strlen(whole) + 1) AS BIGINT) AS bytes, CAST(sum(chars + asked) // 4 AS BIGINT) AS approx_tokens
FROM ({_flat_lines()}) GROUP BY skill, subtopic""",
        "line_audit": f"""
SELECT skill, subtopic, count(*) AS lines, CAST(count(*) FILTER (blank) AS BIGINT) AS blank_lines,
       CAST(count(*) FILTER (broken) AS BIGINT) AS broken_lines,
       CAST(count(*) FILTER (NOT blank AND NOT broken AND NOT turned AND filled) AS BIGINT) AS valid_entries,
       CAST(sum(strlen(line) + 1) AS BIGINT) AS file_size FROM ({_flat_lines()}) WHERE NOT odd GROUP BY skill, subtopic
UNION ALL SELECT DISTINCT lang, 'nothing yet', 0, 0, 0, 0, 0 FROM documents""",
        "odd_files": f"""
SELECT count(*) AS files, count(*) FILTER (e) AS empty_files, count(*) FILTER (odd) AS odd_files FROM (
  SELECT DISTINCT skill, CASE WHEN odd THEN '' ELSE subtopic END, odd, false AS e FROM ({_flat_lines()})
  UNION ALL SELECT DISTINCT lang, 'nothing yet', false, true FROM documents)""",
        "budget_load": f"""
SELECT skill, subtopic, entries AS loaded, chars FROM (
  SELECT *, sum(approx_tokens) OVER (ORDER BY approx_tokens DESC, file ROWS UNBOUNDED PRECEDING) AS r
  FROM ({DOC_MANIFEST})) WHERE r <= {TOKEN_BUDGET}""",
    }
    # The streaming manifest must equal the batch manifest.
    q["stream_manifest"] = q["corpus_manifest"]
    q["stream_dedup_watermark"] = "SELECT DISTINCT user_id, event_type FROM events"
    q["stream_file_manifest"] = f"""
SELECT skill || '__' || subtopic || '.jsonl' AS file, skill, subtopic, count(*) AS entries,
       CAST(sum(strlen(whole) + 1) AS BIGINT) AS bytes, CAST(sum(chars + asked) // 4 AS BIGINT) AS approx_tokens
FROM (SELECT *, row_number() OVER (PARTITION BY skill, subtopic, md5(whole) ORDER BY 1) AS rn FROM ({_flat_lines()}))
WHERE subtopic <> '{REMOVED_SOURCE}' AND (skill <> '{REWRITTEN_LANG}' OR rn = 1) GROUP BY skill, subtopic"""
    q["stream_dedup"] = "SELECT DISTINCT lang, source, md5(text) AS text_md5 FROM documents"
    q["jsonl_file_manifest"] = q["chat_manifest"]
    return q

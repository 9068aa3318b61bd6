"""Chat-record functions over ``messages ARRAY<STRUCT<role, content>>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import _col


def message(role, content) -> Column:
    return F.struct(_col(role).alias("role"), _col(content).alias("content"))


def nest(user, assistant) -> Column:
    """Two-message chat record: user first, then assistant."""
    return F.array(message(F.lit("user"), user), message(F.lit("assistant"), assistant))


def first_content(messages="messages") -> Column:
    """``messages[0].content`` (null when there is no message)."""
    return F.get(_col(messages), 0).getField("content")


def content_chars(messages="messages") -> Column:
    """Characters (code points) over every message's content, both roles."""
    return F.aggregate(_col(messages), F.lit(0).cast("bigint"),
                       lambda acc, m: acc + F.coalesce(F.length(m.getField("content")), F.lit(0)))


def json_string(c) -> Column:
    """A JSON string literal for ``c`` (quotes included), non-ASCII kept;
    ``null`` for null."""
    j = F.to_json(F.array(_col(c)))
    return j.substr(F.lit(2), F.length(j) - 2)


def json_escape_text(text: str) -> str:
    """JSON string escaping of a driver-side constant, as ``to_json`` does it
    (quotes and backslashes, named escapes for \\b \\f \\n \\r \\t, upper-case
    ``\\u00XX`` for the other control characters; non-ASCII kept)."""
    named = {'"': '\\"', "\\": "\\\\", "\b": "\\b", "\f": "\\f", "\n": "\\n", "\r": "\\r",
             "\t": "\\t"}
    out = []
    for ch in text:
        if ch in named:
            out.append(named[ch])
        elif ord(ch) < 0x20:
            out.append("\\u%04X" % ord(ch))
        else:
            out.append(ch)
    return "".join(out)


def json_escaped(c) -> Column:
    """The JSON escaping of ``c`` without the surrounding quotes."""
    j = F.to_json(F.array(_col(c)))
    return j.substr(F.lit(3), F.length(j) - 4)


def canonical_pair_line_parts() -> tuple[str, str, str]:
    return ('{"messages": [{"role": "user", "content": "',
            '"}, {"role": "assistant", "content": "', '"}]}')


def canonical_pair_line(user_escaped, assistant_escaped) -> Column:
    """Canonical line of a user/assistant pair from already-escaped texts.

    Escaping works character by character, so the escaped form of a filled
    template is the escaped template filled with escaped values; callers
    use that to avoid escaping long generated texts row by row."""
    head, mid, tail = canonical_pair_line_parts()
    return F.concat(F.lit(head), _col(user_escaped), F.lit(mid), _col(assistant_escaped),
                    F.lit(tail))


def canonical_line(messages="messages") -> Column:
    """The entry as one JSON line with ``", "`` and ``": "`` separators and
    non-ASCII kept, i.e. the text a ``json.dumps(entry, ensure_ascii=False)``
    would give. (Control characters whose escape has a hex letter come out
    with upper-case hex; lengths are unchanged.)"""
    body = F.array_join(F.transform(_col(messages), lambda m: F.concat(
        F.lit('{"role": '), json_string(m.getField("role")),
        F.lit(', "content": '), json_string(m.getField("content")), F.lit("}"))), ", ")
    return F.concat(F.lit('{"messages": ['), body, F.lit("]}"))


def canonical_line_bytes(messages="messages") -> Column:
    """UTF-8 size of :func:`canonical_line` without building it: the compact
    ``to_json`` of the entry plus one blank after each ``:`` and ``,``
    (4 per message; 1 for an empty list)."""
    m = _col(messages)
    compact = F.octet_length(F.to_json(F.struct(m.alias("messages"))))
    k = F.size(m)
    return (compact + F.when(k > 0, k * 4).otherwise(F.lit(1))).cast("bigint")

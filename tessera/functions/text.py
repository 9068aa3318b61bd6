"""Scalar string functions (Column -> Column), all JVM-side expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.model import CHARS_PER_TOKEN, FILE_SUFFIX, GROUP_SEPARATOR

_PLACEHOLDER = re.compile(r"\{([A-Za-z_]+)\}")
_PLACEHOLDER_SQL = r"\{([A-Za-z_]+)\}"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def humanise(c) -> Column:
    """``abc_def`` -> ``abc def``."""
    return F.translate(_col(c), "_", " ")


def capitalise(c) -> Column:
    """Sentence case: first character upper, the rest lower.

    Not ``initcap``, which capitalises every word.
    """
    c = _col(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(c.substr(F.lit(2), F.length(c))))


def file_name(skill, subtopic) -> Column:
    """``{skill}__{subtopic}.jsonl``."""
    return F.concat(_col(skill), F.lit(GROUP_SEPARATOR), _col(subtopic), F.lit(FILE_SUFFIX))


def decode_file_name(name) -> Column:
    """Inverse of :func:`file_name`: struct(skill, subtopic), split on the
    first separator after removing the suffix. Null when there is no
    separator (such files are quarantined, not read as groups)."""
    base = F.replace(_col(name), F.lit(FILE_SUFFIX), F.lit(""))
    pos = F.instr(base, GROUP_SEPARATOR)
    ok = pos > 0
    skill = F.when(ok, base.substr(F.lit(1), pos - 1))
    sub = F.when(ok, base.substr(pos + len(GROUP_SEPARATOR), F.length(base)))
    return F.struct(skill.alias("skill"), sub.alias("subtopic"))


def content_hash(c) -> Column:
    """MD5 hex digest of the UTF-8 text."""
    return F.md5(_col(c).cast("binary"))


def approx_tokens(chars) -> Column:
    """Token estimate ``chars div 4``. Apply to a *sum* of characters: the
    floor is taken after the group sum, never per row."""
    exact = _col(chars).cast("decimal(38,0)") / F.lit(CHARS_PER_TOKEN).cast("decimal(38,0)")
    return F.floor(exact).cast("bigint")


def megabytes(nbytes) -> Column:
    """bytes / 1024 / 1024, one decimal, half-even on the exact value (as
    Python's fixed-point formatting does)."""
    return F.bround(_col(nbytes).cast("double") / 1024.0 / 1024.0, 1)


def template_parts(template: str) -> tuple[list[str], list[str]]:
    """Split a fixed template into literal pieces and placeholder names.

    ``len(pieces) == len(names) + 1``.
    """
    pieces, names, last = [], [], 0
    for m in _PLACEHOLDER.finditer(template):
        pieces.append(template[last:m.start()])
        names.append(m.group(1))
        last = m.end()
    pieces.append(template[last:])
    return pieces, names


def fill(template: str, values: Mapping[str, Column], literal=lambda piece: piece) -> Column:
    """Fill a fixed (driver-side constant) template with column values.

    Compiles to one ``concat`` of literals and columns, so it stays inside
    whole-stage codegen. Every placeholder must have a value.
    """
    pieces, names = template_parts(template)
    missing = sorted(set(names) - set(values))
    if missing:
        raise KeyError(f"no value for placeholders {missing}")
    parts: list[Column] = []
    for piece, name in zip(pieces, names):
        if piece:
            parts.append(F.lit(literal(piece)))
        parts.append(_col(values[name]))
    if pieces[-1]:
        parts.append(F.lit(literal(pieces[-1])))
    return F.concat(*parts)


def substitute(template, values: Mapping[str, Column]) -> Column:
    """Fill a template held in a column; simultaneous, non-recursive.

    The template is split on ``{name}`` placeholders, and each name is
    looked up in a map of the given values, so a value that itself holds a
    placeholder is not expanded again. A placeholder without a value makes
    the whole result null (the row fails, as formatting would); values not
    named by the template are ignored.
    """
    t = _col(template)
    names = F.regexp_extract_all(t, F.lit(_PLACEHOLDER_SQL), F.lit(1))
    pieces = F.split(t, _PLACEHOLDER_SQL, -1)
    kv = []
    for k, v in values.items():
        kv += [F.lit(k), _col(v).cast("string")]
    lookup = F.create_map(*kv)
    vals = F.transform(names, lambda n: F.try_element_at(lookup, n))
    joined = F.array_join(
        F.zip_with(F.slice(pieces, 1, F.size(names)), vals, lambda p, v: F.concat(p, v)), "")
    filled = F.concat(joined, F.element_at(pieces, -1))
    ok = F.forall(vals, lambda v: v.isNotNull())
    return F.when(ok, filled)


def fill_length(template: str, values: Mapping[str, Column]) -> Column:
    """``length(fill(template, values))`` without building the string: the
    literal characters are counted once on the driver."""
    pieces, names = template_parts(template)
    total = F.lit(sum(len(p) for p in pieces)).cast("bigint")
    for name in names:
        total = total + F.length(_col(values[name])).cast("bigint")
    return total


def fill_octets(template: str, values: Mapping[str, Column],
                literal=lambda piece: piece) -> Column:
    """``octet_length`` of the filled template without building it;
    ``literal`` maps each literal piece first (e.g. to its JSON escaping,
    with ``values`` already escaped)."""
    pieces, names = template_parts(template)
    total = F.lit(sum(len(literal(p).encode("utf-8")) for p in pieces)).cast("bigint")
    for name in names:
        total = total + F.octet_length(_col(values[name])).cast("bigint")
    return total

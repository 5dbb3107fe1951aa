"""Identifiers: namespaces, normal forms, stable ids, grammars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def predicate_id(name: Column) -> Column:
    """``lc:`` and the trimmed, lower-cased name."""
    return F.concat(F.lit("lc:"), F.lower(F.trim(name)))


def role_id(name: Column) -> Column:
    return F.concat(F.lit("lc.role."), F.lower(F.trim(name)))


def positional_role_id(position: Column) -> Column:
    return F.concat(F.lit("lc.role.relation_arg"), position.cast("string"))


def type_id(name: Column) -> Column:
    """``lc:sumo_type.`` and the lower-cased name without a leading ``sumo:``."""
    return F.concat(F.lit("lc:sumo_type."), F.lower(F.regexp_replace(F.trim(name), "^sumo:", "")))


def normal_sense_id(value: Column) -> Column:
    """``lemma-NN`` as ``lemma.NN``; null unless the whole value has that form."""
    form = r"^([^\n]+)-([0-9]{2})\z"
    return F.when(value.rlike(form), F.regexp_replace(value, form, "$1.$2"))


def symbol(value: Column) -> Column:
    """The value if it is a symbol: a letter, then letters, digits, ``_`` and ``-``; else null."""
    return F.when(value.rlike(r"^[A-Za-z][A-Za-z0-9_-]*\z"), value)


def strip_argument(value: Column, source: Column, only: str) -> Column:
    """Without the last ``:`` segment, for rows of one source only; without a colon nothing changes."""
    return F.when(source.eqNullSafe(only), F.regexp_replace(value, r":[^:]*\z", "")).otherwise(value)


def stable_id(prefix: str, *parts: Column, digits: int = 24) -> Column:
    """``prefix`` and the first hex digits of the SHA-256 of the parts, NUL between them; nulls count as empty."""
    joined = F.concat_ws("\0", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix), F.substring(F.sha2(joined, 256), 1, digits))


def json_id(prefix: str, **fields: Column) -> Column:
    """``prefix`` and the SHA-256 of compact JSON with its keys in order. Nulls are written as null."""
    quoted = lambda c: F.coalesce(F.concat(F.lit('"'), F.regexp_replace(F.regexp_replace(c.cast("string"), r"\\", r"\\\\"), '"', r'\\"'), F.lit('"')), F.lit("null"))
    body = F.concat_ws(",", *[F.concat(F.lit(f'"{k}":'), quoted(v)) for k, v in sorted(fields.items())])
    return F.concat(F.lit(prefix), F.sha2(F.concat(F.lit("{"), body, F.lit("}")), 256))


def blob_sha(content: Column) -> Column:
    """SHA-1 of ``blob``, the length and the bytes, as version control names contents."""
    head = F.concat(F.lit("blob "), F.octet_length(content).cast("string"), F.lit("\0"))
    return F.sha1(F.concat(head.cast("binary"), content.cast("binary")))


def argument_number(role: Column) -> Column:
    """``ARG07`` -> ``7``; null for roles without a number."""
    digits = F.regexp_extract(role, r"^ARG([0-9]+)\z", 1)
    return F.when(digits != "", digits.cast("int").cast("string"))


def is_hex(value: Column, digits: int) -> Column:
    return value.rlike(f"^[0-9a-f]{{{digits}}}\\z")


def is_version(value: Column) -> Column:
    """MAJOR.MINOR.PATCH with an optional ``-`` suffix, no leading zeros."""
    return value.rlike(r"^(0|[1-9][0-9]*)\.(0|[1-9][0-9]*)\.(0|[1-9][0-9]*)(-[0-9A-Za-z.-]+)?\z")


def is_token(value: Column) -> Column:
    return value.rlike(r"^[A-Za-z][A-Za-z0-9_.:-]*\z")


def is_safe_path(path: Column) -> Column:
    """Relative, not empty, without empty, ``.`` and ``..`` parts and without backslashes."""
    parts = F.split(path, "/")
    return (path != "") & ~F.contains(path, F.lit("\\")) & ~F.exists(parts, lambda p: p.isin("", ".", ".."))


def is_basename(path: Column) -> Column:
    return is_safe_path(path) & ~F.contains(path, F.lit("/"))


def utc_seconds(text: Column) -> Column:
    """A time with zone and whole seconds as timestamp; null without a zone, with fractions, or if it is no time."""
    fine = text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(Z|[+-][0-9]{2}:[0-9]{2})\z")
    return F.when(fine, F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")))

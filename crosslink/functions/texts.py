"""Texts: occurrences, quotes, headers, line ranges, redaction, tagged JSON."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The marks of each kind of notice in a header, in lower case.
HEADER_MARKS = {"lgpl": ["gnu lesser general public"], "gpl": ["gnu general public", "gnu public license"], "cc": ["creative commons", "create commons"]}
#: The shape words of paired descriptions, and what stands for no filler.
SHAPE = r"(?i)\b(one|two|three|first|second|third|1|2)\b|\bhalf\b"
EMPTY_ROLES = ["", "unknown", "none", "n/a"]


def occurrences(text: Column, part: Column) -> Column:
    """How often ``part`` stands in ``text`` without overlap; an empty part never does."""
    gone = F.length(text) - F.length(F.replace(text, part, F.lit("")))
    return F.when(F.length(part) > 0, (gone / F.length(part)).cast("long")).otherwise(F.lit(0).cast("long"))


def only_place(text: Column, part: Column) -> Column:
    """Start (from 0) of a part that stands exactly once; else null."""
    return F.when(occurrences(text, part) == 1, F.position(part, text) - 1)


def grounded_quote(evidence: Column, field: Column, quote: Column) -> Column:
    """struct(status, start, end): the quote must stand exactly once in that field of a map of texts."""
    text = F.try_element_at(evidence, field)
    n = occurrences(text, quote)
    status = F.when(text.isNull(), "missing_field").when(F.coalesce(F.length(quote), F.lit(0)) == 0, "empty_quote").when(n == 0, "not_found").when(n > 1, "ambiguous").otherwise("grounded")
    start = F.when(status == "grounded", F.position(quote, text) - 1)
    return F.struct(status.alias("status"), start.alias("start"), (start + F.length(quote)).alias("end"))


def repaired(text: Column, fragment: Column, replacement: Column, sha256: Column | None = None) -> Column:
    """The text with its only occurrence of a fragment replaced; null if it doesn't stand exactly once, or if ``sha256`` is given and is not the text's."""
    fits = occurrences(text, fragment) == 1
    if sha256 is not None:
        fits = fits & (F.sha2(text, 256) == sha256)
    return F.when(fits, F.replace(text, fragment, replacement))


def header(text: Column, lines: int = 120) -> Column:
    """The first lines, joined by line feeds; a line ends at CR, LF or both."""
    return F.array_join(F.slice(F.split(text, r"\r\n|\r|\n"), 1, lines), "\n")


def header_class(text: Column, approved: Column, notice: list[str], lines: int = 120) -> Column:
    """The kind of notice in the first lines: approved_notice, mixed, lgpl, gpl, cc or unclassified, in that order of precedence.

    ``approved``: whether the module is approved; only then, and only if all words of ``notice`` stand there, it has the approved
    notice. Marks are signals and no approval.
    """
    top = F.lower(header(text, lines))
    has = lambda mark: F.contains(top, F.lit(mark.lower()))
    found = {kind: reduce(Column.__or__, map(has, marks)) for kind, marks in HEADER_MARKS.items()}
    n = sum((c.cast("int") for c in found.values()), F.lit(0))
    out = F.when(approved & reduce(Column.__and__, map(has, notice)), "approved_notice").when(n > 1, "mixed")
    for kind, c in found.items():
        out = out.when(c, kind)
    return out.otherwise("unclassified")


def line_range(text: Column, first: int, last: int) -> Column:
    """Lines ``first`` to ``last`` (from 1), right-trimmed; null if the text has fewer lines."""
    lines = F.split(text, "\n")
    return F.when(F.size(lines) >= last, F.array_join(F.transform(F.slice(lines, first, last - first + 1), lambda x: F.rtrim(x)), "\n"))


def missing_phrases(text: Column, phrases: list[str]) -> Column:
    return F.array_compact(F.array(*[F.when(~F.contains(F.coalesce(text, F.lit("")), F.lit(p)), F.lit(p)) for p in phrases]))


def same_shape(a: Column, b: Column) -> Column:
    """Either description has a counting word."""
    return a.rlike(SHAPE) | b.rlike(SHAPE)


def without_empty_roles(roles: Column) -> Column:
    """A map of roles without those that are filled by nothing; compared after trimming, letter case kept."""
    return F.map_filter(roles, lambda _, v: ~F.coalesce(F.trim(v), F.lit("")).isin(*EMPTY_ROLES))


def redacted(text: Column, secrets: list[str], most: int = 4000) -> Column:
    for s in sorted(secrets, key=len, reverse=True):
        text = F.replace(text, F.lit(s), F.lit("[redacted]"))
    return F.left(text, F.lit(most))


def tagged_json(text: Column, tag: str) -> Column:
    """All payloads between ``<tag>`` and ``</tag>``."""
    return F.regexp_extract_all(text, F.lit(f"(?s)<{tag}>(.*?)</{tag}>"), F.lit(1))

"""Text cleaning, tokens and indicator patterns as built-in expressions.

Regex classes are spelled out (letters, numbers, white space incl. Unicode)
because ``\\w`` and ``\\s`` are ASCII-only in Java, unlike in the semantics
wanted here.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from inkgraph.functions.arrays import let

# The cleaning patterns, and their order.
SPACE = r"\s\x0B\x1C-\x1F\x85\p{Z}"
CITATION = r"\(Citation:[^)]+\)"
URL = rf"https?://[^{SPACE}]+"
WIKI_LINK = r"\[\[([^\]]+)\]\]"
UNWANTED = rf"[^\p{{L}}\p{{N}}_{SPACE}.,;:()\-]"
BLANKS = rf"[{SPACE}]+"

TOKEN = r"[\p{L}\p{N}_]{2,}"

# Indicator kinds and their patterns.  Lengths are bounded as DNS and mail bound them (labels of at most
# 63 characters, at most 127 of them, local parts of at most 64), so that no repetition of a group runs deep
# enough to exhaust Java's stack and no start position scans an unbounded run.
INDICATORS = {
    "ipv4": r"\b(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\b",
    "url": r"https?://[^\s\"'<>]+",
    "email": r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,126}\.[A-Za-z]{2,63}",
    "domain": r"(?i)\b(?:[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?\.){1,126}(?:xn--[a-z0-9-]{0,58}[a-z0-9]|[a-z]{2,63})\b",
    "md5": r"\b[A-Fa-f0-9]{32}\b",
    "sha1": r"\b[A-Fa-f0-9]{40}\b",
    "sha256": r"\b[A-Fa-f0-9]{64}\b",
    "technique_id": r"\bT[0-9]{4}(?:\.[0-9]{3})?\b",
}
# What every value of a kind holds.  Without it a text is not searched: the mail pattern tries up to 64 characters at each place.
HOLDS = {"email": "@"}


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def drop_citations(text: Column) -> Column:
    return F.regexp_replace(text, CITATION, "")


def drop_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL, "")


def unwrap_links(text: Column) -> Column:
    return F.regexp_replace(text, WIKI_LINK, "$1")


def keep_plain_characters(text: Column) -> Column:
    return F.regexp_replace(text, UNWANTED, " ")


def collapse_blanks(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, BLANKS, " "))


def clean_text(text: Column) -> Column:
    """Null to empty, citations and URLs out, links unwrapped, blanks collapsed."""
    text = text_or_empty(text)
    for step in (drop_citations, drop_urls, unwrap_links, keep_plain_characters, collapse_blanks):
        text = step(text)
    return text


def is_blank(text: Column) -> Column:
    return F.length(collapse_blanks(text_or_empty(text))) == 0


def preview(text: Column, chars: int, ending: str = "") -> Column:
    """The first ``chars`` characters; ``ending`` is appended even to short texts."""
    head = F.substring(text, 1, chars)
    return F.concat(head, F.lit(ending)) if ending else head


def tokens(text: Column) -> Column:
    """Lower-cased runs of at least two word characters."""
    return F.regexp_extract_all(F.lower(text_or_empty(text)), F.lit(TOKEN), F.lit(0))


def adjacent_pairs(items: Column) -> Column:
    """Pairs (left, right) of neighbours in an array; empty below two items."""
    rights = F.slice(items, F.lit(2), F.greatest(F.size(items) - 1, F.lit(0)))
    lefts = F.slice(items, F.lit(1), F.greatest(F.size(items) - 1, F.lit(0)))
    return F.arrays_zip(lefts.alias("left"), rights.alias("right"))


def terms(text: Column) -> Column:
    """Single tokens followed by pairs of neighbouring tokens."""
    return let(tokens(text), lambda words: F.concat(
        words, F.transform(adjacent_pairs(words), lambda p: F.concat_ws(" ", p["left"], p["right"]))
    ))


def indicators(text: Column) -> Column:
    """Distinct (kind, value) indicators found in a text."""
    def found(kind: str, pattern: str) -> Column:
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        if kind in HOLDS:
            values = F.when(F.contains(text, F.lit(HOLDS[kind])), values).otherwise(F.array().cast("array<string>"))
        return F.transform(
            F.array_distinct(values),
            lambda value: F.struct(F.lit(kind).alias("kind"), value.alias("value")),
        )

    return F.concat(*[found(kind, pattern) for kind, pattern in INDICATORS.items()])

"""URL filters: pattern rules indexed by their rarest literal token (built-in expressions only).

Every rule is a regular expression over ``host + path``.  Each rule names the
literal tokens it cannot match without (whole runs of ``[a-z0-9]`` bounded by
other characters); the corpus decides which of them is rarest, and the rule is
filed under that one token.  A URL is cut into the same tokens, fetches the
rules filed under them from a map of bounded size (the rule set is a parameter,
not data), and only those rules run their expression.  All of it is one
projection: no shuffle, no Python worker.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: from there up to ``?``, ``#`` or the end.  A null url or one
without ``://`` has an empty host and path and matches no base rule (the base
rules all need a host).  A base rule fits its host and every subdomain when the
path starts with the rule's path; the longest rule wins, and of two fitting
rules of equal length ``block`` wins.  Without a fitting base rule the verdict
is the method's own rules' (``block`` if any fits, else ``allow``).  Repeated
rows, empty tables and extra columns are carried through row by row; only
``page_id`` and ``url`` are read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

# The base rules of the contract, as (verdict, host, path).
BASE_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

# The method's own rules (our choice): (verdict, expression over host + path, tokens, needs all tokens).
# Expressions repeat no group, so that neither Java's engine nor RE2 recurses or backtracks far on long URLs.
# Host labels and path parts that name advertising, tracking or executable downloads.
OWN_RULES = [
    ("block", r"^(?:[^/]*\.)?(?:ads|adserver|adservice)\.", ("ads", "adserver", "adservice"), False),
    ("block", r"^(?:[^/]*\.)?(?:tracker|tracking|telemetry|analytics)\.", ("tracker", "tracking", "telemetry", "analytics"), False),
    ("block", r"^(?:[^/]*\.)?doubleclick\.", ("doubleclick",), False),
    ("block", r"/(?:ads|banner|banners|popup|popups)(?:/|$)", ("ads", "banner", "banners", "popup", "popups"), False),
    ("block", r"/[^/]*\.(?:exe|scr|msi|apk)$", ("exe", "scr", "msi", "apk"), False),
    ("block", r"/wp-login\.php$", ("wp", "login", "php"), True),
]


@dataclass(frozen=True)
class Rule:
    number: int
    verdict: str
    pattern: str
    tokens: tuple[str, ...]     # tokens a URL must hold to fit: all of them, or one of them if ``alternatives``
    text: str | None            # base rules only: "host" + "path"
    alternatives: bool


def _base(number: int, verdict: str, host: str, path: str) -> Rule:
    pattern = "^(?:[^/]*\\.)?" + re.escape(host) + re.escape(path)
    host_tokens = re.findall(r"[a-z0-9]+", host)
    # a path part is a whole token only if the rule's path goes on after it; "/en/1" also fits "/en/17"
    path_tokens = re.findall(r"[a-z0-9]+(?=[^a-z0-9])", path)
    return Rule(number, verdict, pattern, tuple(host_tokens + path_tokens), host + path, False)


def rules() -> list[Rule]:
    made = [_base(i, *rule) for i, rule in enumerate(BASE_RULES)]
    made += [Rule(len(BASE_RULES) + i, verdict, pattern, tokens, None, not every)
             for i, (verdict, pattern, tokens, every) in enumerate(OWN_RULES)]
    return made


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of the contract; both empty for a null url or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url)))
    host = F.translate(F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit("")), UPPER, LOWER)
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return host, path


def url_tokens(host_path: Column) -> Column:
    """Distinct lower-cased runs of ``[a-z0-9]``: what a URL offers the index."""
    return F.array_distinct(F.regexp_extract_all(F.lower(host_path), F.lit(r"[a-z0-9]+"), 0))


def index_tokens(pages: DataFrame, made: list[Rule]) -> dict[str, list[int]]:
    """token -> rule numbers.  A rule that needs all its tokens is filed under the rarest of them in ``pages``.

    Only the frequencies of the rules' own tokens are counted (partial
    aggregation; the result has at most as many rows as the rules have tokens).
    """
    wanted = sorted({t for rule in made for t in rule.tokens})
    host, path = parts(F.col("__url"))
    words = pages.select(F.col("url").alias("__url")).select(F.explode(url_tokens(F.concat(host, path))).alias("token"))
    counts = {row["token"]: row["count"] for row in words.filter(F.col("token").isin(wanted)).groupBy("token").count().collect()}
    index: dict[str, list[int]] = {}
    for rule in made:
        chosen = rule.tokens if rule.alternatives else [min(rule.tokens, key=lambda t: (counts.get(t, 0), t))]
        for token in chosen:
            index.setdefault(token, []).append(rule.number)
    return index


def judge(pages: DataFrame, made: list[Rule] | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, own_rule): one row per row of ``pages``.

    ``rule`` is the winning base rule as ``host + path`` (null if none fits),
    ``own_rule`` the number of the first of the method's rules that fits (null if none).
    """
    made = rules() if made is None else made
    index = index_tokens(pages, made)
    host, path = parts(F.col("__url"))
    lookup = F.create_map(*[x for token, numbers in sorted(index.items()) for x in (F.lit(token), F.array(*map(F.lit, numbers)))])
    patterns = F.array(*[F.lit(rule.pattern) for rule in made])
    base = [rule for rule in made if rule.text is not None]
    # (length, block first, text) per base rule: the largest struct of the fitting ones wins
    ranks = F.array(*[F.struct(F.lit(len(r.text)).alias("length"), F.lit(r.verdict == "block").alias("block"),
                               F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict")) for r in base])
    own = [rule.number for rule in made if rule.text is None]
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("__url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("__hp", F.concat("host", "path"))
    fetched = F.array_sort(F.array_distinct(F.flatten(F.transform(
        url_tokens(F.col("__hp")), lambda t: F.coalesce(F.try_element_at(lookup, t), F.array().cast("array<int>"))))))
    rows = rows.withColumn("__fits", F.filter(fetched, lambda r: F.rlike(F.col("__hp"), F.element_at(patterns, r + 1))))
    best = F.array_max(F.transform(F.filter(F.col("__fits"), lambda r: r < len(base)), lambda r: F.element_at(ranks, r + 1)))
    first_own = F.array_min(F.filter(F.col("__fits"), lambda r: r.isin(own)))
    rows = rows.withColumn("__best", best).withColumn("own_rule", first_own)
    verdict = F.coalesce(F.col("__best.verdict"), F.when(F.col("own_rule").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    return rows.select("page_id", "host", "path", F.col("__best.text").alias("rule"), verdict.alias("verdict"),
                       F.col("own_rule").cast("int").alias("own_rule"))


def sql(made: list[Rule] | None = None) -> str:
    """DuckDB SQL for ``judge``: the same rules written out as conditions, no index."""
    made = rules() if made is None else made
    base = sorted((r for r in made if r.text is not None), key=lambda r: (-len(r.text), r.verdict != "block"))
    fits = []
    for r in base:
        host, path = BASE_RULES[r.number][1:]
        fits.append(f"WHEN (host = '{host}' OR suffix(host, '.{host}')) AND starts_with(path, '{path}') THEN '{r.text}'")
    verdicts = " ".join(f"WHEN '{r.text}' THEN '{r.verdict}'" for r in base)
    own = " ".join(f"WHEN regexp_matches(host || path, '{r.pattern}') THEN {r.number}" for r in made if r.text is None)
    return f"""
WITH p AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
hp AS (
  SELECT CAST(page_id AS BIGINT) AS page_id,
         translate(coalesce(regexp_extract(rest, '^[^/?#]*', 0), ''), '{UPPER}', '{LOWER}') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM p),
judged AS (
  SELECT *, CASE {' '.join(fits)} END AS rule, CAST(CASE {own} END AS INTEGER) AS own_rule FROM hp)
SELECT page_id, host, path, rule,
       coalesce(CASE rule {verdicts} END, CASE WHEN own_rule IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, own_rule
FROM judged"""

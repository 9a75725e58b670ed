"""Licence notices by a positional index over rare words, in built-in expressions only.

Every notice has a template and a key phrase that must stand in it unchanged.
Document frequencies of all key words are counted over the whole corpus; of
each key phrase the two rarest words are looked up in every text with their
positions.  A position less the word's place in the template is where a notice
would begin; places on which both words agree are verified word by word: first the key
phrase, then the share of the template that stands around it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from inkgraph.functions.arrays import let
from inkgraph.llm.common import texts

# Fixed value: what separates words (all of ASCII but 0-9 and a-z, after lower-casing).
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LEAST_SHARE = 0.6      # of a template's words that must stand at their places around the key phrase


@dataclass(frozen=True)
class Notice:
    label: str
    words: list[str]
    key: list[str]
    base: bool = False

    @property
    def at(self) -> int:
        """Where the key phrase stands in the template."""
        n = len(self.key)
        return next(i for i in range(len(self.words)) if self.words[i: i + n] == self.key)


# Phrases and labels of the base, then wordings of well-known licence notices with their key phrases.
BASE = [("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")]
WORDINGS = [
    ("agpl", "under the terms of the gnu affero general public license", "affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("creative-commons", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", "general public license version 3"),
    ("lgpl", "under the terms of the gnu lesser general public license", "lesser general public license"),
    ("mit", "released under the mit license", "the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "hereby granted free of charge"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("proprietary", "unauthorized copying of this file is strictly prohibited", "unauthorized copying"),
    ("unlicense", "free and unencumbered software released into the public domain", "unencumbered software released"),
]
NOTICES = [Notice(label, phrase.split(), phrase.split(), True) for label, phrase in BASE] + [
    Notice(label, words.split(), key.split()) for label, words, key in WORDINGS
]
KEY_WORDS = sorted({w for n in NOTICES for w in n.key})


def words_of(text: Column) -> Column:
    """Words in order; an empty string stands first or last if the text begins or ends with a separator."""
    return F.split(F.lower(text), SEPARATOR)


def document_frequencies(docs: DataFrame) -> dict[str, int]:
    """Documents in which each key word stands, over all documents; at most one number per key word."""
    present = F.array_intersect(F.array(*map(F.lit, KEY_WORDS)), words_of(F.col("text")))
    rows = docs.select(F.explode(present).alias("word")).groupBy("word").count().collect()
    return {r.word: r["count"] for r in rows}


def rarest(notice: Notice, frequency: dict[str, int]) -> list[tuple[str, int]]:
    """The two rarest different words of the key phrase with their places in the template."""
    place = {w: notice.at + i for i, w in reversed(list(enumerate(notice.key)))}
    return [(w, place[w]) for w in sorted(place, key=lambda w: (frequency.get(w, 0), w))[:2]]


def begins(notice: Notice, frequency: dict[str, int], words: Column, hits: Column) -> Column:
    """Where the notice's template begins (maybe before the text), by intersected positions and the verified key phrase."""
    def postings(word: str, place: int) -> Column:
        return F.transform(F.filter(hits, lambda h: h["word"] == word), lambda h: h["at"] - F.lit(place))

    lists = [postings(*one) for one in rarest(notice, frequency)]
    meeting = F.array_intersect(*lists) if len(lists) > 1 else lists[0]
    key = F.array(*map(F.lit, notice.key))
    def stands(begin: Column) -> Column:
        at = begin + notice.at          # below 0 if the text starts within the key phrase; slice takes places from 1 only
        return (at >= 0) & (F.slice(words, F.greatest(at, F.lit(0)) + 1, len(notice.key)) == key)

    return F.filter(meeting, stands)


def share(notice: Notice, words: Column, begin: Column) -> Column:
    """Share of the template's words that stand at their places."""
    same = [F.when(F.get(words, begin + i) == w, 1).otherwise(0) for i, w in enumerate(notice.words)]
    total = same[0]
    for one in same[1:]:
        total = total + one
    return total / F.lit(float(len(notice.words)))


def shares(notice: Notice, words: Column, begins: Column) -> Column:
    return F.transform(begins, lambda begin: share(notice, words, begin))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    A null or empty text has no words and no labels, score 0; places are null
    where there is no base phrase.  The score is the largest share of a
    template that stands in the text (1 for a base phrase).  Repeated rows give
    repeated results; any number of places is counted.
    """
    rows = texts(docs)
    frequency = document_frequencies(rows)
    anchors = sorted({w for n in NOTICES for w, _ in rarest(n, frequency)})

    def facts(words: Column) -> Column:
        size = F.size(words)
        lead = F.when(F.get(words, F.lit(0)) == "", 1).otherwise(0)
        trail = F.when((size > 1) & (F.get(words, size - 1) == ""), 1).otherwise(0)
        at = F.filter(F.transform(words, lambda w, i: F.when(w.isin(anchors), i)), lambda i: i.isNotNull())
        hits = F.transform(at, lambda i: F.struct(F.get(words, i).alias("word"), i.alias("at")))

        def found(hits: Column) -> Column:
            kinds = [(n, begins(n, frequency, words, hits)) for n in NOTICES]
            base = [F.transform(b, lambda a: a - lead) for n, b in kinds if n.base]
            best = [
                F.struct(F.lit(n.label).alias("label"), F.array_max(shares(n, words, b)).alias("share")) for n, b in kinds
            ]
            return F.struct(
                (size - lead - trail).alias("n_words"), F.concat(*base).alias("places"),
                F.array(*[F.when(F.size(b) > 0, F.lit(n.label)) for n, b in kinds if n.base]).alias("base_labels"),
                F.array(*best).alias("best"),
            )

        return let(hits, found)

    out = rows.select("doc_id", let(words_of(F.col("text")), facts).alias("f"))
    good = F.filter("f.best", lambda b: b["share"] >= LEAST_SHARE)
    joined = lambda names: F.array_join(F.array_sort(F.array_distinct(F.array_compact(names))), ",")
    return out.select(
        "doc_id", F.col("f.n_words").cast("long").alias("n_words"), F.size("f.places").cast("long").alias("n_base"),
        F.array_min("f.places").cast("long").alias("first_word"), F.array_max("f.places").cast("long").alias("last_word"),
        joined(F.col("f.base_labels")).alias("base_labels"), joined(F.transform(good, lambda b: b["label"])).alias("labels"),
        F.coalesce(F.array_max(F.transform(good, lambda b: b["share"])), F.lit(0.0)).alias("score"),
    )


def sql() -> str:
    """The same in DuckDB SQL, without an index: every place of every text is looked at."""
    def listed(items: list[str]) -> str:
        return "[" + ", ".join(f"'{w}'" for w in items) + "]"

    places, best = [], []
    for i, n in enumerate(NOTICES):
        places.append(
            f"list_filter(range(1, len(w) + 1), lambda p: w[p] = '{n.key[0]}' AND w[p:p + {len(n.key) - 1}] = {listed(n.key)}) AS p{i}"
        )
        same = " + ".join(f"CASE WHEN p + {j - n.at} >= 1 AND w[CAST(greatest(p + {j - n.at}, 1) AS BIGINT)] = '{word}' THEN 1 ELSE 0 END" for j, word in enumerate(n.words))
        best.append(f"{{'label': '{n.label}', 'share': list_max(list_transform(p{i}, lambda p: ({same}) / CAST({len(n.words)} AS DOUBLE)))}}")
    base = [i for i, n in enumerate(NOTICES) if n.base]
    every = " || ".join(f"p{i}" for i in base)
    base_labels = ", ".join(f"CASE WHEN len(p{i}) > 0 THEN '{NOTICES[i].label}' END" for i in base)
    return f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
found AS (SELECT doc_id, w, {", ".join(places)} FROM words),
best AS (
  SELECT doc_id, len(w) AS n_words, {every} AS places, [{base_labels}] AS base_labels,
    list_filter([{", ".join(best)}], lambda b: b.share >= {LEAST_SHARE}) AS good
  FROM found)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base,
  CAST(list_min(places) - 1 AS BIGINT) AS first_word, CAST(list_max(places) - 1 AS BIGINT) AS last_word,
  coalesce(array_to_string(list_sort(list_distinct(list_filter(base_labels, lambda x: x IS NOT NULL))), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_transform(good, lambda b: b.label))), ','), '') AS labels,
  coalesce(list_max(list_transform(good, lambda b: b.share)), CAST(0 AS DOUBLE)) AS score
FROM best"""

"""Scoring texts against a keyword dictionary, inside one projection.

A keyword counts once per text and matches as a substring of the lower-cased
text.  The dictionary is a constant of the plan, so a corpus is scored without
any join or shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from inkgraph import fixed_values as fixed
from inkgraph.functions.arrays import let, unnest

MAX_KEYWORDS = 100_000     # checked bound of the dictionary held in the plan

Scorer = Callable[[Column, int], Column]


class KeywordScorer:
    """Ordered labels, each with its keywords; usable wherever a ``Scorer`` is."""

    def __init__(self, keywords: dict[str, list[str]] | None = None):
        self.keywords = fixed.KEYWORDS if keywords is None else keywords
        if sum(map(len, self.keywords.values())) > MAX_KEYWORDS:
            raise ValueError(f"more than {MAX_KEYWORDS} keywords")
        self.labels = list(self.keywords)

    @classmethod
    def from_table(cls, table: DataFrame) -> KeywordScorer:
        """From a (label, label_ord, keyword) table of checked size."""
        rows = table.orderBy("label_ord").limit(MAX_KEYWORDS + 1).collect()
        words: dict[str, list[str]] = {}
        for row in rows:
            words.setdefault(row["label"], []).append(row["keyword"])
        return cls(words)

    def _dictionary(self) -> Column:
        return F.array(*[
            F.struct(F.lit(label).alias("label"), F.array(*map(F.lit, words)).cast("array<string>").alias("words"))
            for label, words in self.keywords.items()
        ])

    def hits(self, text: Column) -> Column:
        """``array<struct<label, label_ord, keyword>>`` of all keywords found."""
        entries = F.array(*[
            F.struct(F.lit(label).alias("label"), F.lit(position).alias("label_ord"), F.lit(word).alias("keyword"))
            for position, (label, words) in enumerate(self.keywords.items())
            for word in words
        ])
        return let(F.lower(text), lambda low: F.filter(entries, lambda e: F.contains(low, e["keyword"])))

    def ratios(self, text: Column) -> Column:
        """Share of each label's keywords that occur, as ``array<double>`` in label order."""
        return let(
            F.lower(text),
            lambda low: F.transform(
                self._dictionary(),
                lambda entry: F.size(F.filter(entry["words"], lambda word: F.contains(low, word)))
                / F.greatest(F.size(entry["words"]), F.lit(1)),
            ),
        )

    def scores(self, text: Column) -> Column:
        """``array<struct<label, label_ord, ratio, score>>``; scores sum to 1, or are all 0."""
        names = F.array(*map(F.lit, self.labels))

        def share(ratios: Column) -> Column:
            total = F.aggregate(ratios, F.lit(0.0), lambda acc, x: acc + x)
            return let(total, lambda t: F.transform(ratios, lambda r, i: F.struct(
                F.get(names, i).alias("label"), i.alias("label_ord"), r.alias("ratio"),
                (r / F.when(t == 0, 1.0).otherwise(t)).alias("score"),
            )))

        return let(self.ratios(text), share)

    def rank(self, text: Column, top: int = 3) -> Column:
        """Best labels first, earlier labels first among equals: ``array<struct<label, score>>``."""
        by_score = F.transform(self.scores(text), lambda s: F.struct(
            (-s["ratio"]).alias("key"), s["label_ord"].alias("label_ord"), s["label"].alias("label"),
            s["score"].alias("score"),
        ))
        return F.transform(
            F.slice(F.array_sort(by_score), 1, top),
            lambda s: F.struct(s["label"].alias("label"), F.round(s["score"], 4).alias("score")),
        )

    __call__ = rank

    def best(self, text: Column) -> Column:
        """The first label of the ranking; a text without hits gets the first label of all."""
        return F.get(self.rank(text, 1), F.lit(0))["label"]


def classify(df: DataFrame, text: str, scorer: Scorer, top: int = 3, column: str = "ranked") -> DataFrame:
    """Add a ranking made by any scorer: a function from (text column, top) to a ranked array."""
    return df.withColumn(column, scorer(F.col(text), top))


def explode_ranked(df: DataFrame, keys: list[str], column: str = "ranked") -> DataFrame:
    """One row per ranked label: keys, rank, label, score."""
    numbered = F.transform(column, lambda e, i: F.struct((i + 1).alias("rank"), e["label"].alias("label"), e["score"].alias("score")))
    return unnest(df, numbered, "entry", *keys).select(*keys, "entry.rank", "entry.label", "entry.score")

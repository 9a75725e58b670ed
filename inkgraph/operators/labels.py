"""From a joined list of slugs to the primary label of a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from inkgraph import fixed_values as fixed


def first_listed(tactics: Column) -> Column:
    return F.trim(F.get(F.split(tactics, ","), F.lit(0)))


def title_label(tactics: Column) -> Column:
    """First entry, each word (hyphens do not separate words) capitalised."""
    return F.initcap(first_listed(tactics))


def slug(label: Column) -> Column:
    return F.lower(F.replace(label, F.lit(" "), F.lit("-")))


def with_primary_label(df: DataFrame, mode: str = "normalized", labels: list[str] | None = None) -> DataFrame:
    """Rows with text and a known first label, plus ``primary_tactic``.

    ``strict`` accepts a slug only when capitalising it gives a label, which
    drops every hyphenated slug; ``normalized`` compares slug with slug.
    """
    known = fixed.LABELS if labels is None else labels
    usable = df.dropna(subset=["text_for_nlp", "tactics"]).filter(F.trim("tactics") != "")
    if mode == "strict":
        return usable.withColumn("primary_tactic", title_label(F.col("tactics"))).filter(
            F.col("primary_tactic").isin(known)
        )
    by_slug = F.create_map(*[F.lit(x) for label in known for x in (label.lower().replace(" ", "-"), label)])
    return usable.withColumn(
        "primary_tactic", F.try_element_at(by_slug, slug(first_listed(F.col("tactics"))))
    ).filter(F.col("primary_tactic").isNotNull())

"""Small helpers over arrays and structs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def or_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def first_field(structs: Column, field: str) -> Column:
    """``field`` of the first struct; empty for null, empty or missing."""
    return or_empty(F.get(structs, F.lit(0))[field])


def field_list(structs: Column, field: str) -> Column:
    return F.transform(
        F.coalesce(structs, F.array().cast(f"array<struct<{field}:string>>")), lambda s: or_empty(s[field])
    )


def joined(items: Column, separator: str = ", ") -> Column:
    return or_empty(F.array_join(items, separator))


def ranked(pairs: list[tuple[Column, Column]], top: int, places: int = 4) -> Column:
    """Best ``top`` of (label, score), earlier entries first among equal scores.

    The result is ``array<struct<label, score>>``; sorting stays inside the row.
    """
    entries = F.array(*[
        F.struct((-score).alias("key"), F.lit(position).alias("position"), label.alias("label"), score.alias("score"))
        for position, (label, score) in enumerate(pairs)
    ])
    return F.transform(
        F.slice(F.array_sort(entries), 1, top),
        lambda e: F.struct(e["label"].alias("label"), F.round(e["score"], places).alias("score")),
    )


def squared_distance(left: Column, right: Column) -> Column:
    return F.aggregate(
        F.zip_with(left, right, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda total, x: total + x
    )


def unit_length(values: Column) -> Column:
    """Divide by the Euclidean norm; an all-zero array stays as it is.

    The norm is repeated into a second array so that it is computed once per
    row, not once per element inside the lambda.
    """
    norm = F.sqrt(F.aggregate(values, F.lit(0.0), lambda total, x: total + x * x))
    return F.zip_with(
        values, F.array_repeat(norm, F.size(values)), lambda x, n: F.when(n > 0, x / n).otherwise(x)
    )


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A plain column would be copied by the optimizer into every lambda that uses
    it, and then computed again for each array element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unnest(df: DataFrame, items: Column | str, name: str, *keep: Column | str) -> DataFrame:
    """One row per array element, as column ``name`` next to ``keep``.

    A plain explode of a computed column makes the optimizer add a filter on its
    size, which computes the column a second time, often in the scan.  The outer
    form does not; the row it adds for an empty array is dropped again.
    """
    return df.select(*keep, F.explode_outer(items).alias(name)).filter(F.col(name).isNotNull())

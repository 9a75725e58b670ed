"""Connected components of links between ids, as rounds of joins over a shrinking list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from inkgraph.session import cut


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id on some link (a, b); the component is its smallest id.

    Each round links all neighbours of an id to the smallest one, first those
    above it, then those below (large star, small star), so that after a number
    of rounds that is logarithmic in practice every link leads to the root.  Minima
    are taken by partial aggregation and joined back: no id's neighbours are
    gathered in one place.
    """
    now = cut(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = cut(large.distinct())
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("x"))
        after = cut(small.select("x.*").filter("a <> b").distinct())
        size = after.count()
        if size == now.count() and after.exceptAll(now).isEmpty():
            roots = after.select("b").distinct()
            return after.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(
                roots.select(F.col("b").alias("id"), F.col("b").alias("component"))
            )
        now = after

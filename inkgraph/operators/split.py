"""An exact, repeatable hold-out split with class shares kept.

The rows of each class are ordered by a hash of their id; the first ones are
held out.  No class is ever sorted as a whole: counts per hash prefix find the
prefix in which the cut falls, and only rows with that prefix are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from inkgraph.operators.skew import lookup_join
from inkgraph.session import cut

PREFIX = 4      # hex digits: 65,536 groups per class


def row_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))


def held_out_counts(counts: DataFrame, label: str, test_share: float) -> DataFrame:
    """(label, n, n_test): ``ceil(test_share * n)`` in total, largest remainders first.

    ``counts`` has one row per class, so the two unpartitioned windows see only
    as many rows as there are classes.
    """
    everything = Window.partitionBy(F.lit(1))
    n_all = F.sum("n").over(everything)
    n_train = n_all - F.ceil(F.round(F.lit(test_share) * n_all, 9))
    sized = counts.withColumns({"n_all": n_all, "n_train": n_train}).withColumns({
        "base": F.expr("(n * n_train) div n_all"), "rest": F.expr("(n * n_train) % n_all"),
    })
    by_rest = everything.orderBy(F.desc("rest"), label)
    extra = F.row_number().over(by_rest) <= F.col("n_train") - F.sum("base").over(everything)
    return sized.select(label, "n", (F.col("n") - F.col("base") - extra.cast("long")).alias("n_test"))


def stratified_split(
    df: DataFrame, key: str, label: str, test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """``df`` with a boolean ``is_test``; ``key`` has to be unique."""
    hashed = df.select(key, label, row_hash(key, seed).alias("h")).withColumn("prefix", F.substring("h", 1, PREFIX))
    groups = cut(hashed.groupBy(label, "prefix").agg(F.count("*").alias("n")))
    wanted = held_out_counts(groups.groupBy(label).agg(F.sum("n").alias("n")), label, test_share)
    upto = F.sum("n").over(Window.partitionBy(label).orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0))
    borders = (
        groups.withColumn("upto", upto)
        .join(wanted.select(label, "n_test"), label)
        .filter((F.col("upto") >= F.col("n_test")) & (F.col("upto") - F.col("n") < F.col("n_test")))
        .select(label, "prefix", (F.col("n_test") - F.col("upto") + F.col("n")).alias("need"))
    )
    in_border = hashed.join(cut(borders), [label, "prefix"])      # one row per class
    order = Window.partitionBy(label, "prefix").orderBy("h", key)
    last = (
        in_border.withColumn("nth", F.row_number().over(order))
        .filter(F.col("nth") == F.col("need"))
        .select(label, F.struct("h", F.col(key).alias("k")).alias("last"))
    )
    marked = lookup_join(df, cut(last), label, how="left")
    mine = F.struct(row_hash(key, seed).alias("h"), F.col(key).alias("k"))
    return marked.withColumn("is_test", F.coalesce(mine <= F.col("last"), F.lit(False))).drop("last")

"""Joins that stay balanced when one key holds a large share of the rows.

A hot key is spread over ``SALTS`` parts on the side where it repeats, and its
few rows on the other side are copied once per part.  Keys that are not hot
keep a single part, so nothing else is copied.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

SALTS = 64
HOT_SHARE = 0.001          # so at most 1,000 keys can be hot, whatever the data size
HOT_ROWS = 1_000_000       # below this a key is never worth splitting
BROADCAST_ROWS = 200_000   # longest table of (node, number) that is broadcast, checked by counting


@dataclass(frozen=True)
class Hot:
    """Hot values of one key column; bounded by ``1 / HOT_SHARE`` entries."""

    values: list = field(default_factory=list)
    salts: int = SALTS

    def _is_hot(self, key: str) -> Column:
        return F.col(key).isin(self.values)

    def spread(self, df: DataFrame, key: str, by: list[str]) -> DataFrame:
        """One salt per row, taken from the ``by`` columns so that retries repeat it."""
        salt = F.lit(0)
        if self.values:
            salt = F.when(self._is_hot(key), F.pmod(F.xxhash64(*by), F.lit(self.salts)).cast("int")).otherwise(salt)
        return df.withColumn("salt", salt)

    def copy(self, df: DataFrame, key: str) -> DataFrame:
        """Rows of hot keys once for each salt."""
        if not self.values:
            return df.withColumn("salt", F.lit(0))
        every = F.sequence(F.lit(0), F.lit(self.salts - 1))
        return df.withColumn("salt", F.explode(F.when(self._is_hot(key), every).otherwise(F.array(F.lit(0)))))


def find_hot(df: DataFrame, key: str, share: float = HOT_SHARE, rows: int = HOT_ROWS, salts: int = SALTS) -> Hot:
    """Keys with more than ``rows`` rows and more than ``share`` of all rows."""
    counts = df.groupBy(key).count()
    total = df.agg(F.count("*").alias("total")).scalar()
    hot = counts.filter((F.col("count") > rows) & (F.col("count") > total * share) & F.col(key).isNotNull())
    return Hot([row[0] for row in hot.select(key).collect()], salts)


def spread_join(
    many: DataFrame, few: DataFrame, key: str, by: list[str], how: str = "inner", hot: Hot | None = None
) -> DataFrame:
    """``many`` joined to ``few`` on ``key``, hot keys of ``many`` split over salts."""
    hot = find_hot(many, key) if hot is None else hot
    if not hot.values:
        return many.join(few, key, how)
    return hot.spread(many, key, by).join(hot.copy(few, key), [key, "salt"], how).drop("salt")


def lookup_join(many: DataFrame, few: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``many`` with the columns that ``few`` has for ``key``; no job runs while the plan is made.

    Adaptive execution decides when the size of ``few`` in bytes is known: it is
    broadcast within ``spark.sql.autoBroadcastJoinThreshold``; beyond that, both
    sides are exchanged and the parts of hot keys of ``many`` are split.
    """
    return many.join(few, key, how)

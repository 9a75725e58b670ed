"""Loading, row keys and bounded tables shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(docs: DataFrame, *keep: Column | str) -> DataFrame:
    """(doc_id, text, keep...); other columns are left unread.  A null text becomes the empty one unless ``text`` is to be kept as it is."""
    text = F.col("text") if "text" in [k for k in keep if isinstance(k, str)] else F.coalesce("text", F.lit("")).alias("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text, *[k for k in keep if not isinstance(k, str) or k != "text"])


def schema_of(rows: DataFrame, *names: str) -> str:
    """The named columns of ``rows`` as the beginning of a schema, in this order."""
    return "".join(f"`{n}` {rows.schema[n].dataType.simpleString()}, " for n in names)


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id's decimal digits, modulo ``folds``; a null id counts as an empty string."""
    digits = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.pmod(F.crc32(digits.cast("binary")), F.lit(folds))


def row_key() -> Column:
    """Tells rows with one doc_id but different texts apart; equal rows share it."""
    return F.xxhash64("text").alias("text_key")


def join_rows(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on (doc_id, text_key), null ids included; ``right`` brings its other columns only."""
    right = right.withColumnsRenamed({"doc_id": "_doc_id", "text_key": "_text_key"})
    on = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_key") == F.col("_text_key"))
    return left.join(right, on, how).drop("_doc_id", "_text_key")


def threshold_for(counts: DataFrame, count: str, most: int) -> int:
    """The smallest count that at most ``most`` rows reach.

    Rows are counted per count (large counts in powers of two), so only a few
    thousand numbers reach the driver and nothing is sorted.
    """
    exact = 4096
    power = F.pow(F.lit(2.0), F.floor(F.log2(F.col(count).cast("double")))).cast("long")
    level = F.when(F.col(count) < exact, F.col(count).cast("long")).otherwise(power)
    kept, least = 0, None
    for row in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):
        if kept + row["count"] > most:
            break
        kept, least = kept + row["count"], row["level"]
    return least if least is not None else 2**62


def spread_lookup(many: DataFrame, few: DataFrame, key: str, rows: str, by: str) -> DataFrame:
    """``many`` left-joined with ``few`` on ``key``; ``few`` has one row per key and in ``rows`` the rows of ``many`` it has.

    A key with more rows of ``many`` than an average task's share is split over
    salts, one per share (at most one per shuffle partition), and its row of
    ``few`` is copied once per salt, so the hot key of a skewed table is read
    by many tasks.  Such keys are fewer than the shuffle partitions, so their
    table is small by construction and broadcast.  ``by`` names a column of
    ``many`` that spreads the rows of one key (a row number, say).
    """
    spark = many.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = few.agg(F.sum(rows)).first()[0] or 0
    share = max(1, total // parts)
    hot = few.filter(F.col(rows) > share).select(key, F.least(F.lit(parts), F.ceil(F.col(rows) / share)).cast("int").alias("__salts"))
    hot = spark.createDataFrame(hot.collect(), hot.schema)      # fewer than ``parts`` rows
    many = many.join(F.broadcast(hot), key, "left").withColumn(
        "__salt", F.when(F.col("__salts").isNull(), 0).otherwise(F.pmod(F.xxhash64(by), F.col("__salts"))).cast("int"))
    few = few.drop(rows).join(F.broadcast(hot), key, "left").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1)))
    return many.drop("__salts").join(few.drop("__salts"), [key, "__salt"], "left").drop("__salt")


def release_memory() -> None:
    """Give freed heap back to the system, after a fit held in the driver or at the end of a worker's task, so later stages start lean.

    Python keeps freed small objects in its own arenas, Arrow its buffers in its
    pool and glibc freed heap pages; all three are returned.  Elsewhere than on glibc it does nothing.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()      # Arrow keeps freed buffers in its own pool
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass

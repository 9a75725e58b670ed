"""Session settings and the one way this package cuts lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(app: str = "inkgraph", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the package defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the session names; invent one only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        context.setCheckpointDir(named)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix=f"inkgraph-{os.getpid()}-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name next to the checkpoints, for tables written between two steps."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/inkgraph-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends, the data outlives any executor.

    A table read back has a known size (so small ones are broadcast at once) and
    none of the constraints of the plan behind it, which in a loop would grow
    with every round.
    """
    path = scratch_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_in_place(df: DataFrame, *keys: str) -> DataFrame:
    """Like ``cut``, but partitioned and sorted by ``keys``, so that joins on them exchange only the other side.

    A checkpoint remembers its partitioning only if its plan is not adaptive;
    adaptive planning is therefore off while this one small plan runs.
    """
    table = cut(df)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return placed(df.sparkSession, lambda: table.repartition(parts, *keys), *keys)


def placed(spark: SparkSession, made: Callable[[], DataFrame], *keys: str) -> DataFrame:
    """A checkpoint of what ``made`` gives, which is already partitioned by ``keys``; planned without adaptive execution."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return made().sortWithinPartitions(*keys).checkpoint(eager=True)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)

"""Classifying texts as they arrive.

Requests are rows of a stream instead of calls to a server.  Every step works
on one row, so no state or watermark is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from inkgraph import fixed_values as fixed
from inkgraph import schemas
from inkgraph.functions.text import is_blank, preview
from inkgraph.operators.classifier import TextClassifier
from inkgraph.operators.keywords import KeywordScorer, Scorer

TOP = 5


def classify_requests(
    requests: DataFrame, model: TextClassifier | None = None, scorer: Scorer | None = None, top: int = TOP
) -> DataFrame:
    """Add both rankings, a text echo, and an error for blank texts, to a frame with ``text``."""
    blank = is_blank(F.col("text"))
    none = F.array().cast(schemas.RANKED)
    rows = requests.withColumn("text", F.trim(F.coalesce("text", F.lit(""))))
    if model is None:
        rows = rows.withColumn("supervised", none)
    else:
        rows = model.rank(rows, "text", top, "supervised")
    return rows.withColumns({
        "zero_shot": F.when(blank, none).otherwise((scorer or KeywordScorer())(F.col("text"), top)),
        "supervised": F.when(blank, none).otherwise(F.col("supervised")),
        "error": F.when(blank, F.lit("No text provided")),
        "text": preview(F.col("text"), fixed.ECHO_CHARS),
    })


def write_classified(requests: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    """Classify a stream into a folder of JSON lines, exactly once."""
    return (
        classify_requests(requests, **options).writeStream.format("json").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )

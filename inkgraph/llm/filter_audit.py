"""Filter interaction audit: truth-table survival words and carry-save positional popcounts.

Five filters fail a document on these conditions (words: maximal
``[^\\x20\\x09-\\x0D]+``, case-sensitive; a null text is the empty one):

* A: fewer than 50 words;
* B: 100 * distinct words < 65 * words;
* C: 100 * characters ``[A-Z]`` > 5 * code points;
* D: the text holds one of ``#$%&*|``;
* E: a document with a smaller doc_id has the identical text, anywhere in the table.
  A null doc_id is smaller than none and has none smaller; rows repeating one
  id and text do not fail E because of each other.

Each document becomes a 32-bit word whose bit ``s`` is set when it survives the
set of filters ``s`` (bit 0: A ... bit 4: E), read from a truth table of its 5-bit
failure mask.  Within each task, words of one (part, good, toxic) group are
summed position by position with carry-save adders (three words in, a sum word
and a carry word of twice the weight out), so a group of n words costs about
2n word operations and 32 counts leave the task.  Spark adds these counts over
tasks; everything after that is arithmetic on 32 numbers per part.

Parts are ``source`` values, a null source being the empty string.  Labels are
taken per doc_id from ``labels`` (good: some row has quality 1, toxic: some row
has toxic 1); documents without labels or id count as neither.  Every part gets
all 600 rows (120 orders x 5 steps), zeros included; an empty table gives none.
Only doc_id, text and source of ``docs`` are read, so other columns never clash.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from inkgraph.llm.common import spread_lookup
from inkgraph.session import cut

# Fixed values of the contract: filter letters in bit order and their thresholds.
LETTERS = "ABCDE"
MIN_WORDS = 50
DISTINCT_PERCENT = 65
UPPER_PERCENT = 5
MARKS = "[#$%&*|]"
WORD = r"[^\x20\x09-\x0D]+"

SURVIVAL = np.array([sum(1 << s for s in range(32) if s & mask == 0) for mask in range(32)], dtype=np.uint32)
POSITIONS = np.arange(32, dtype=np.uint32)


def positional_popcount(words: np.ndarray) -> np.ndarray:
    """counts[i] = number of ``words`` with bit i set, by carry-save adders (exact for any length)."""
    counts = np.zeros(32, dtype=np.int64)
    level, weight = np.asarray(words, dtype=np.uint32), 1
    while level.size:
        carries = []
        while level.size >= 3:
            cut = level.size - level.size % 3
            a, b, c = level[0:cut:3], level[1:cut:3], level[2:cut:3]
            ab = a ^ b
            carries.append((a & b) | (c & ab))
            level = np.concatenate([ab ^ c, level[cut:]])
        for word in level:
            counts += ((word >> POSITIONS) & 1).astype(np.int64) * weight
        level = np.concatenate(carries) if carries else np.empty(0, dtype=np.uint32)
        weight *= 2
    return counts


def _survivors(batches):
    """Per task: (part, good, toxic, subset, survivors) for every group the task saw, all 32 subsets."""
    totals: dict[tuple, np.ndarray] = {}
    for batch in batches:
        words = SURVIVAL[batch["mask"].to_numpy(dtype=np.int64)]
        keys = batch[["part", "good", "toxic"]].reset_index(drop=True)
        for key, index in keys.groupby(["part", "good", "toxic"], sort=False).indices.items():
            counts = positional_popcount(words[index])
            totals[key] = totals[key] + counts if key in totals else counts
    for (part, good, toxic), counts in totals.items():
        yield pd.DataFrame({"part": part, "good": good, "toxic": toxic, "subset": np.arange(32, dtype=np.int32),
                            "survivors": counts})


def failure_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, good, toxic, mask) per row of ``docs``; bit i of mask: the document fails filter LETTERS[i]."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       text.alias("text"))
    words = F.regexp_extract_all("text", F.lit(WORD), 0)
    rows = rows.select(
        "doc_id", "part", F.sha2("text", 256).alias("sha"), F.monotonically_increasing_id().alias("row"),
        (F.when(F.size(words) < MIN_WORDS, 1).otherwise(0)
         + F.when(100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * F.size(words), 2).otherwise(0)
         + F.when(100 * F.regexp_count("text", F.lit("[A-Z]")) > UPPER_PERCENT * F.length("text"), 4).otherwise(0)
         + F.when(F.col("text").rlike(MARKS), 8).otherwise(0)).alias("mask"),
    )
    rows = cut(rows)   # texts are read once; row numbers stay fixed for retries
    first = rows.groupBy("sha").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("rows"))
    rows = spread_lookup(rows, first, "sha", "rows", "row")
    rows = rows.withColumn("mask", F.col("mask") + F.when(F.col("doc_id") > F.col("first_id"), 16).otherwise(0))
    marks = (labels.filter(F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
                  F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")))
    ids = rows.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("rows"))
    marks = marks.join(ids, "doc_id")
    rows = spread_lookup(rows.filter(F.col("doc_id").isNotNull()), marks, "doc_id", "rows", "row").unionByName(
        rows.filter(F.col("doc_id").isNull()).withColumn("good", F.lit(None).cast("int")).withColumn("toxic", F.lit(None).cast("int")),
        allowMissingColumns=True)
    return rows.select("part", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"), "mask")


def subset_survivors(masks: DataFrame) -> DataFrame:
    """(part, subset, surv, surv_good, surv_toxic): documents of the part that no filter of ``subset`` fails."""
    out = "part string, good int, toxic int, subset int, survivors long"
    counts = masks.select("part", F.col("good").cast("int"), F.col("toxic").cast("int"), F.col("mask").cast("int")).mapInPandas(_survivors, out)
    return counts.groupBy("part", "subset").agg(
        F.sum("survivors").alias("surv"),
        F.sum(F.when(F.col("good") == 1, F.col("survivors")).otherwise(0)).alias("surv_good"),
        F.sum(F.when(F.col("toxic") == 1, F.col("survivors")).otherwise(0)).alias("surv_toxic"),
    )


def _steps() -> list[tuple[str, int, str, int, int]]:
    """(filter_order, step, letter, bit, mask of the filters before it) for all 120 orders."""
    made = []
    for order in permutations(LETTERS):
        before = 0
        for step, letter in enumerate(order, start=1):
            bit = 1 << LETTERS.index(letter)
            made.append(("".join(order), step, letter, bit, before))
            before |= bit
    return made


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per (part, filter_order, step): kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    table = subset_survivors(failure_masks(docs, labels))
    per_part = table.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct(
        "subset", F.struct("surv", "surv_good", "surv_toxic")))).alias("s"))
    steps = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(x).alias("letter"),
                               F.lit(b).alias("bit"), F.lit(p).alias("before")) for o, s, x, b, p in _steps()])
    rows = per_part.select("part", "s", F.inline(steps))

    def at(subset, field="surv"):
        return F.element_at("s", subset)[field]

    after = F.col("before") + F.col("bit")
    removed = at(F.col("before")) - at(after)
    rows = rows.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), "letter",
        at(after).alias("kept"),
        removed.alias("removed"),
        ((at(F.lit(0)) - at(F.col("bit"))) - removed).alias("redundant"),
        (at(F.lit(31) - F.col("bit")) - at(F.lit(31))).alias("unique_fails"),
        (at(F.col("before"), "surv_good") - at(after, "surv_good")).alias("good_lost"),
        (at(F.col("before"), "surv_toxic") - at(after, "surv_toxic")).alias("toxic_lost"),
    )
    # 120 rows per (part, filter): a bounded window
    rows = rows.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "letter")))
    return rows.select("part", "filter_order", "step", *[F.col(c).cast("long").alias(c) for c in (
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")])


def sql() -> str:
    """DuckDB SQL for ``audit``: masks per row, survivors per subset by brute force, the 600 steps by joins."""
    letters = ", ".join(f"('{x}', {1 << i})" for i, x in enumerate(LETTERS))
    return f"""
WITH d AS (SELECT doc_id, coalesce(CAST(source AS VARCHAR), '') AS part, coalesce(text, '') AS t FROM documents),
f AS (
  SELECT doc_id, part, t, regexp_extract_all(t, '{WORD}') AS w FROM d),
firsts AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t),
lab AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS tox
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
m AS (
  SELECT f.part, coalesce(lab.good, 0) AS good, coalesce(lab.tox, 0) AS tox,
    (CASE WHEN len(w) < {MIN_WORDS} THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * len(list_distinct(w)) < {DISTINCT_PERCENT} * len(w) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * (length(f.t) - length(regexp_replace(f.t, '[A-Z]', '', 'g'))) > {UPPER_PERCENT} * length(f.t) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(f.t, '{MARKS}') THEN 8 ELSE 0 END)
    + (CASE WHEN f.doc_id > firsts.first_id THEN 16 ELSE 0 END) AS mask
  FROM f JOIN firsts ON f.t = firsts.t LEFT JOIN lab ON lab.doc_id = f.doc_id),
subsets AS (SELECT CAST(range AS INTEGER) AS s FROM range(32)),
surv AS (
  SELECT part, s, count(*) FILTER (WHERE mask & s = 0) AS n,
         count(*) FILTER (WHERE mask & s = 0 AND good = 1) AS ng, count(*) FILTER (WHERE mask & s = 0 AND tox = 1) AS nt
  FROM m, subsets GROUP BY part, s),
letters AS (SELECT * FROM (VALUES {letters}) v(l, bit)),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits,
         [a.l, b.l, c.l, d.l, e.l] AS ls
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31),
steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, ls[step] AS letter, bits[step] AS bit,
         CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS before
  FROM orders, range(1, 6) r(step)),
parts AS (SELECT DISTINCT part FROM m),
rows AS (
  SELECT p.part, st.filter_order, st.step, st.letter,
         x.n AS kept, b.n - x.n AS removed, (z.n - o.n) - (b.n - x.n) AS redundant, u.n - a.n AS unique_fails,
         b.ng - x.ng AS good_lost, b.nt - x.nt AS toxic_lost
  FROM parts p, steps st
  JOIN surv b ON b.part = p.part AND b.s = st.before
  JOIN surv x ON x.part = p.part AND x.s = st.before + st.bit
  JOIN surv z ON z.part = p.part AND z.s = 0
  JOIN surv o ON o.part = p.part AND o.s = st.bit
  JOIN surv u ON u.part = p.part AND u.s = 31 - st.bit
  JOIN surv a ON a.part = p.part AND a.s = 31)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM rows"""

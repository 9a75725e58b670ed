"""Ranked lexical search by NRA: impact-sorted reads with lower and upper score bounds per document.

Scoring (contract): terms are maximal runs of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``
(digits, ASCII letters and every non-ASCII character) after lower-casing A-Z
only; a null text has none.  N counts documents with a term, L all their terms,
n one document's terms, df the documents holding a term, tf its occurrences in
the document.  ``w = floor(1000 * ln((2N + 2) / (2 df + 1)))`` in doubles; with
``m = 50 + (50 n N) div L`` a posting's impact is
``w * ((10^9 tf) div (1000 tf + 20 m))`` and a document's score for an item is
the sum of the impacts of the item's distinct terms.

Method: postings (term, document, impact) are built only for terms that some
item holds, in one pass over the texts, and written bucketed by document.  Impact
levels end at quantiles of all impacts (level 0 holds the highest).  Round r
reads levels 0..r -- the head of every list in impact order -- and keeps
per (item, document) the lower bound (impacts seen) and the upper bound (plus,
for every list of the item not yet seen for that document, the largest impact
left in it).  An item is finished once its best ``k`` documents by lower bound
all have exact scores, no other document seen can reach the k-th (equal scores
go to the smaller doc_id, so ties are settled too), and a document not seen at
all cannot reach it either.  The k-th lower bound of a round bounds the k-th
score from below, so later rounds drop documents whose upper bound is lower
before ranking.  The last round reads every level, so every item finishes.  Nothing is cut: every document and term counts, every item is
answered.

Rows: each document row is a document (repeated rows are ranked apart; a null
doc_id sorts after all others among equal scores).  Rows of ``items`` sharing an
item_id are one item with the union of their terms.  Only documents with a score
above 0 are returned, at most ``k`` per item, ranks 1, 2, ... without gaps.
Empty tables give no rows; only doc_id, text, item_id and text are read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window, functions as F

from inkgraph.session import cut

# Fixed values of the contract.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
K = 50

LEVELS = (0.995, 0.95, 0.75)    # quantiles of impact that end the first levels; the last level holds the rest
BROADCAST_ROWS = 2_000_000      # (item, term) rows up to which the item side is broadcast, checked by counting


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), 0)


def _small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast only if its row count is within BROADCAST_ROWS."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def postings(docs: DataFrame, item_terms: DataFrame) -> DataFrame:
    """(term, key, doc_id, impact > 0) for every term of ``item_terms`` in every document, bucketed by document.

    One pass over the texts gives a row per (document, item term) and one row
    per document (term null) for N and L.  The table is written bucketed by
    document key, so that sums per (item, document) need no exchange later.
    """
    spark = docs.sparkSession
    vocab = _small(item_terms.select("term").distinct().withColumn("wanted", F.lit(True)))
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
                       terms(F.col("text")).alias("t"))
    flat = rows.select("key", "doc_id", F.size("t").alias("n"),
                       F.explode(F.concat(F.array(F.lit(None).cast("string")), "t")).alias("term"))
    flat = flat.join(vocab, "term", "left").filter(F.col("term").isNull() | F.col("wanted").isNotNull())
    tf = cut(flat.groupBy("key", "doc_id", "n", "term").agg(F.count("*").alias("tf")))
    stats = tf.filter(F.col("term").isNull()).agg(
        F.count(F.when(F.col("n") > 0, 1)).alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L")).first()
    n_docs, n_terms = int(stats["N"]), max(1, int(stats["L"]))     # with no terms there are no postings either
    tf = tf.filter(F.col("term").isNotNull())
    weights = cut(tf.groupBy("term").agg(F.count("*").alias("df")).select(
        "term", F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).alias("w")))
    impact = F.expr(f"w * ((1000000000 * tf) div (1000 * tf + 20 * (50 + (50 * n * {n_docs}L) div {n_terms}L)))")
    scored = tf.join(_small(weights), "term").select("term", "key", "doc_id", impact.alias("impact")).filter(F.col("impact") > 0)
    name = f"inkgraph_postings_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    scored.repartition(parts, "key").write.bucketBy(parts, "key").format("parquet").saveAsTable(name)
    return spark.table(name)


def _order(score: Column) -> Column:
    """Sort key of a result: higher score, then smaller doc_id (null last), then row key."""
    return F.struct((-score).alias("s"), F.col("doc_id").isNull().alias("null_id"), F.coalesce("doc_id", F.lit(0)).alias("d"),
                    F.col("key").alias("k"))


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score, rounds): each item's ``k`` best documents with a score above 0."""
    item_id = F.col("item_id").cast("long")
    named = cut(items.select(F.coalesce(item_id.cast("string"), F.lit("null")).alias("name"), item_id.alias("item_id"),
                             F.explode(terms(F.col("text"))).alias("term")).distinct())
    # Items go by a number, as it is part of the key by which bounds are summed.
    numbers = cut(named.select("name").distinct().withColumn("item", F.monotonically_increasing_id()))
    item_terms = cut(named.join(numbers, "name").select("item", "item_id", "term"))
    scored = postings(docs, item_terms)
    cuts = scored.approxQuantile("impact", list(LEVELS), 0.001) if scored.take(1) else []
    level = F.lit(len(cuts))
    for number, value in reversed(list(enumerate(cuts))):
        level = F.when(F.col("impact") >= F.lit(value), number).otherwise(level)
    top = cut(scored.groupBy("term", level.alias("level")).agg(F.max("impact").alias("top")))   # largest impact per list and level
    last = len(cuts)
    active = item_terms
    found = []
    floor = None      # (item, kth_score) of the round before: the k-th score can only be higher
    for r in range(last + 1):
        left = top.filter(F.col("level") > r).groupBy("term").agg(F.max("top").alias("rest"))
        lists = cut(active.join(left, "term", "left").select("item", "term", F.coalesce("rest", F.lit(0)).alias("rest")))
        unseen = cut(lists.groupBy("item").agg(F.sum("rest").alias("unseen")))
        seen = scored.filter(F.col("impact") >= F.lit(cuts[r])) if r < last else scored
        # bucketed by key: the sums per (item, document) are taken where the postings lie; a key has one doc_id
        sums = [F.max("doc_id").alias("doc_id"), F.sum("impact").alias("lower")]
        if r == last:             # nothing is left unseen
            bounds = seen.join(_small(lists.drop("rest")), "term").groupBy("item", "key").agg(*sums).withColumn("upper", F.col("lower"))
        else:
            bounds = (seen.join(_small(lists), "term").groupBy("item", "key").agg(*sums, F.sum("rest").alias("seen_rest"))
                      .join(_small(unseen), "item")
                      .withColumn("upper", F.col("lower") + F.col("unseen") - F.col("seen_rest")))
        if floor is not None:     # a document that cannot reach the k-th score known already takes no part
            bounds = bounds.join(_small(floor), "item", "left").filter(
                F.col("floor").isNull() | (F.col("upper") >= F.col("floor"))).drop("floor")
        ranked = bounds.withColumn("rn", F.row_number().over(Window.partitionBy("item").orderBy(_order(F.col("lower")))))
        best = cut(ranked.filter(F.col("rn") <= k))
        kth = best.filter(F.col("rn") == k).select("item", _order(F.col("lower")).alias("kth"), F.col("lower").alias("kth_score"))
        floor = cut(kth.select("item", F.col("kth_score").alias("floor")))
        if r == last:             # every score is exact and every list read: all items finish
            found.append(best.select("item", "key", "doc_id", F.col("lower").alias("score"), F.lit(r + 1).alias("rounds")))
            break
        # Items that unseen documents or inexact scores leave open anyway need no look at all documents seen.
        status = (unseen.join(best.groupBy("item").agg(F.min((F.col("lower") == F.col("upper")).cast("int")).alias("exact")),
                              "item", "left").join(kth, "item", "left"))
        settled = F.coalesce(F.col("exact"), F.lit(1)).cast("boolean") & F.when(
            F.col("kth_score").isNotNull(), F.col("unseen") < F.col("kth_score")).otherwise(F.col("unseen") == 0)
        hopeful = cut(status.filter(settled).select("item", "kth"))
        if hopeful.isEmpty():
            continue
        challengers = (bounds.join(_small(hopeful), "item")
                       .filter((_order(F.col("lower")) > F.col("kth")) & (_order(F.col("upper")) < F.col("kth")))
                       .select("item").distinct())
        finished = cut(hopeful.select("item").join(challengers, "item", "left_anti"))
        found.append(best.join(finished, "item", "left_semi").select("item", "key", "doc_id", F.col("lower").alias("score"),
                                                                        F.lit(r + 1).alias("rounds")))
        active = active.join(finished, "item", "left_anti")
        if active.isEmpty():
            break
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    ids = item_terms.select("item", "item_id").distinct()
    rank = F.row_number().over(Window.partitionBy("item").orderBy(_order(F.col("score"))))
    return result.join(_small(ids), "item").select("item_id", rank.cast("int").alias("rank"), "doc_id", F.col("score").cast("long").alias("score"), "rounds")


def sql(k: int = K) -> str:
    """DuckDB SQL: every score of every document for every item, ranked."""
    text = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS k, CAST(doc_id AS BIGINT) AS doc_id, {text} AS t FROM documents),
stats AS (SELECT count(*) FILTER (WHERE len(t) > 0) AS n_docs, sum(len(t)) AS n_terms FROM d),
it AS (SELECT DISTINCT CAST(item_id AS BIGINT) AS item_id, unnest({text}) AS term FROM benchmark),
occ AS (SELECT k, unnest(t) AS term FROM d),
tf AS (SELECT k, term, count(*) AS tf FROM occ WHERE term IN (SELECT term FROM it) GROUP BY k, term),
w AS (
  SELECT term, CAST(floor(1000 * ln((2.0 * n_docs + 2) / (2.0 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, stats GROUP BY term, n_docs),
dm AS (SELECT k, doc_id, 50 + (50 * len(t) * n_docs) // n_terms AS m FROM d, stats WHERE len(t) > 0),
imp AS (
  SELECT tf.k, tf.term, w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * dm.m)) AS impact
  FROM tf JOIN w USING (term) JOIN dm USING (k)),
sc AS (SELECT it.item_id, imp.k, sum(impact) AS score FROM it JOIN imp USING (term) GROUP BY it.item_id, imp.k),
ranked AS (
  SELECT item_id, dm.doc_id, score,
         row_number() OVER (PARTITION BY item_id ORDER BY score DESC, dm.doc_id ASC NULLS LAST) AS rank
  FROM sc JOIN dm USING (k) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= {k}"""

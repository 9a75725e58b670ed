"""Best matches of each document among reference texts, by TF-IDF cosine over every term.

Weights are ``(1 + ln tf) * idf`` with ``idf = ln((1 + n) / (1 + df)) + 1`` over
documents and references together (n rows, df keys holding the term), scaled
to unit length over *all* terms of a text: no vocabulary is cut.

Plan:

* Terms are counted by the batch of texts and are 64-bit hashes from then on (the
  chance of any collision among n terms is about n^2 / 2^65); document frequencies
  are counted per hash.  Terms that several keys or a reference hold get their idf
  by a join, in which terms held by more than a task's share of all postings are
  spread over salts; all others share one idf, so norms need no join for them.
* Only terms that some reference holds can add to a cosine, so documents keep
  just those postings (their norm is taken over all their terms first).
* The references form a term-partitioned inverted index: per term, its
  postings and the largest weight in them.  A document's terms are taken by
  falling upper bound ``w_doc * max_ref_weight``.  While the bound of the terms
  left could still lift a new reference above the ``top``-th partial score,
  whole lists are read (prefix filtering); from then on new references cannot
  enter, and the candidates get the rest of their score by looking their own
  terms up (max-score skipping): long lists of common terms are rarely read.
* A reference index over ``block_entries`` postings is cut into blocks that meet
  blocks of documents; the best ``top`` of each block are merged.

Cosines are rounded to 6 places and ranked by falling cosine, then reference id;
only cosines above 0 count.  A null text has no terms; rows sharing a key are one
text; rows with a null key count in n and df but are not matched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from inkgraph.functions.text import tokens
from inkgraph.operators import term_batches
from inkgraph.operators.skew import Hot
from inkgraph.session import cut

BLOCK_ENTRIES = 5_000_000      # postings of one block of references, checked by counting
BLOCK_DOCS = 20_000
PLACES = 6
LOOKUPS = 4_000_000            # (candidate, term) pairs looked up at once
MARGIN = 1e-6                  # a reference left out must stay below the top-th cosine after rounding


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        first = 0
        for some in term_batches.slices(batch.column("tokens")):
            at, term, tf = term_batches.hashed_counts(some)
            rows = pa.array(first + at)
            yield pa.RecordBatch.from_arrays(
                [batch.column("side").take(rows), batch.column("id").take(rows), pa.array(term), pa.array(tf, pa.int64())],
                ["side", "id", "term", "tf"])
            first += len(some)


def term_hashes(both: DataFrame, repeated: bool) -> DataFrame:
    """(side, id, term, tf): a text's terms as 64-bit hashes; counts of rows that share a key are added up."""
    rows = both.select("side", "id", tokens(F.col("text")).alias("tokens"))
    rows = rows.mapInArrow(_hashed, "side int, id long, term long, tf long")
    return rows.groupBy("side", "id", "term").agg(F.sum("tf").alias("tf")) if repeated else rows


def unit_postings(docs: DataFrame, doc: str, refs: DataFrame, ref: str, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(id, term, weight) of documents and of references, unit length over all terms; documents keep reference terms only."""
    both = docs.select(F.lit(0).alias("side"), F.col(doc).cast("long").alias("id"), F.col(text).alias("text")).unionByName(
        refs.select(F.lit(1).alias("side"), F.col(ref).cast("long").alias("id"), F.col(text).alias("text")))
    n, keys = both.groupBy("side", "id").count().agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    tf = cut(term_hashes(both, n != keys))
    idf = F.log((1.0 + n) / (1.0 + F.col("df"))) + 1
    once = math.log((1.0 + n) / 2.0) + 1                 # the idf of a term that one key holds
    held = tf.groupBy("term").agg(F.count("*").alias("df"), F.max("side").alias("in_refs"))
    held = cut(held.filter("df > 1 or in_refs = 1"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(1, tf.count() // parts)
    hot = Hot([r["term"] for r in held.filter(F.col("df") > share).select("term").collect()], salts=parts)   # fewer than parts terms
    joined = hot.spread(tf, "term", ["side", "id"]).join(hot.copy(held, "term"), ["term", "salt"]).drop("salt")
    raw = cut(joined.select("side", "id", "term", "in_refs", (1 + F.log("tf")).alias("times"), idf.alias("idf")))
    # Each term counts as if one key held it; what the terms of several keys have less or more is added.
    alone = tf.select("side", "id", F.pow(1 + F.log("tf"), 2.0).alias("a"), F.lit(0.0).alias("b"))
    several = raw.select("side", "id", F.lit(0.0).alias("a"), (F.pow("times", 2.0) * (F.pow("idf", 2.0) - once * once)).alias("b"))
    norms = alone.unionByName(several).groupBy("side", "id").agg(
        F.sqrt(F.sum("a") * (once * once) + F.sum("b")).alias("norm"))
    kept = raw.filter((F.col("in_refs") == 1) & F.col("id").isNotNull()).join(norms, ["side", "id"])
    unit = cut(kept.select("side", "id", "term", (F.col("times") * F.col("idf") / F.col("norm")).alias("weight")))
    return unit.filter(F.col("side") == 0).drop("side"), unit.filter(F.col("side") == 1).drop("side")


class Index:
    """References of one block: postings by term (weights falling) and each reference's own sorted terms."""

    def __init__(self, refs: pd.DataFrame):
        self.terms, numbers = np.unique(refs["idx"].to_numpy(np.int64), return_inverse=True)
        refs = refs.assign(idx=numbers.astype(np.int64)).sort_values(["ref", "idx"]).reset_index(drop=True)
        self.ids, local = np.unique(refs["ref"].to_numpy(), return_inverse=True)
        terms_, weights = refs["idx"].to_numpy(np.int64), refs["weight"].to_numpy(float)
        n_terms = self.n_terms = len(self.terms)
        self.own_keys = local.astype(np.int64) * n_terms + terms_      # sorted: by reference, then term
        self.own_weights = weights
        order = np.lexsort((-weights, terms_))
        self.rows, self.weights = local[order], weights[order]
        self.start = np.searchsorted(terms_[order], np.arange(n_terms + 1))
        self.top = np.zeros(n_terms)
        np.maximum.at(self.top, terms_, weights)

    def best(self, idx: np.ndarray, w: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids and rounded cosines of the ``top`` best references, and how many of the document's terms were read as lists."""
        place = np.minimum(np.searchsorted(self.terms, idx), max(len(self.terms) - 1, 0))
        known = (self.terms[place] == idx) if len(self.terms) else np.zeros(len(idx), bool)
        idx, w = place[known], w[known]
        bound = w * self.top[idx]
        order = np.argsort(-bound, kind="stable")
        idx, w, bound = idx[order], w[order], bound[order]
        rest = np.concatenate([np.cumsum(bound[::-1])[::-1], [0.0]])
        lengths = self.start[idx + 1] - self.start[idx]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat(self.start[idx] - ends[:-1], lengths) + np.arange(ends[-1])
        rows, contributions = self.rows[at], np.repeat(w, lengths) * self.weights[at]
        n = len(self.ids)

        def partial(j):
            return np.bincount(rows[:ends[j]], contributions[:ends[j]], n)

        def enough(acc, j):
            if np.count_nonzero(acc) < top:
                return False
            return rest[j] < np.partition(acc, n - top)[n - top] - MARGIN

        lo, hi = 0, len(idx)               # the first j after which no new reference can enter
        if not enough(partial(hi), hi):
            lo = hi
        while lo < hi:
            mid = (lo + hi) // 2
            if enough(partial(mid), mid):
                hi = mid
            else:
                lo = mid + 1
        acc = partial(lo)
        found = np.flatnonzero(acc > 0)
        if lo < len(idx) and len(found):       # the rest of each candidate's score, looked up in its own terms
            step = max(1, LOOKUPS // (len(idx) - lo))
            for first in range(0, len(found), step):
                some = found[first:first + step]
                keys = (some[:, None] * self.n_terms + idx[None, lo:]).ravel()
                place = np.minimum(np.searchsorted(self.own_keys, keys), len(self.own_keys) - 1)
                hit = self.own_keys[place] == keys
                acc[some] += np.where(hit, self.own_weights[place], 0.0).reshape(len(some), -1) @ w[lo:]
        sims = np.round(acc[found], PLACES)
        keep = sims > 0
        found, sims = found[keep], sims[keep]
        pick = np.lexsort((self.ids[found], -sims))[:top]
        return self.ids[found[pick]], sims[pick], lo


def _match(docs: pd.DataFrame, index: Index, top: int) -> pd.DataFrame:
    out = [index.best(np.asarray(i, np.int64), np.asarray(w, float), top) for i, w in zip(docs["indices"], docs["weights"])]
    sizes = [len(ids) for ids, _, _ in out]
    return pd.DataFrame({
        "doc": np.repeat(docs["doc"].to_numpy(), sizes).astype(np.int64),
        "rank": np.concatenate([np.arange(1, s + 1) for s in sizes] or [np.empty(0, np.int64)]).astype(np.int32),
        "ref": np.concatenate([ids for ids, _, _ in out] or [np.empty(0, np.int64)]).astype(np.int64),
        "similarity": np.concatenate([s for _, s, _ in out] or [np.empty(0)]),
        "lists_read": np.repeat([r for _, _, r in out], sizes).astype(np.int32),
    })


SCHEMA = "doc long, rank int, ref long, similarity double, lists_read int"


def top_matches(docs: DataFrame, doc: str, refs: DataFrame, ref: str, top: int = 3, text: str = "text",
                block_entries: int = BLOCK_ENTRIES, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(doc, rank, ref, similarity, lists_read): each document's ``top`` references by cosine over all terms."""
    doc_post, ref_post = unit_postings(docs, doc, refs, ref, text)
    spark = docs.sparkSession
    numbered = cut(ref_post.select("term").distinct()).withColumn("idx", F.monotonically_increasing_id())
    numbered = cut(numbered)      # numbers fixed once written
    small = F.broadcast(numbered) if numbered.count() <= block_entries else numbered
    ref_rows = ref_post.join(small, "term").select(F.col("id").alias("ref"), "idx", "weight")
    doc_rows = (doc_post.join(small, "term").groupBy(F.col("id").alias("doc"))
                .agg(F.sort_array(F.collect_list(F.struct("idx", "weight"))).alias("e"))
                .select("doc", F.col("e.idx").alias("indices"), F.col("e.weight").alias("weights")))
    entries = ref_rows.count()
    blocks = max(1, math.ceil(entries / block_entries))
    if blocks == 1:       # entries counted within the bound
        shared = spark.sparkContext.broadcast(Index(ref_rows.toPandas()))

        def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield _match(batch, shared.value, top)

        found = doc_rows.mapInPandas(match, SCHEMA)
    else:
        doc_blocks = max(1, math.ceil(doc_rows.count() / block_docs))
        grid_docs = doc_rows.withColumn("db", F.pmod(F.xxhash64("doc"), F.lit(doc_blocks))).withColumn(
            "rb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")))
        grid_refs = ref_rows.withColumn("rb", F.pmod(F.xxhash64("ref"), F.lit(blocks))).withColumn(
            "db", F.explode(F.sequence(F.lit(0), F.lit(doc_blocks - 1)).cast("array<bigint>")))

        def cell(d: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
            if not len(d) or not len(r):
                d = d.iloc[:0]
            return _match(d, Index(r), top)

        best = grid_docs.groupBy("db", "rb").cogroup(grid_refs.groupBy("db", "rb")).applyInPandas(cell, SCHEMA)
        order = Window.partitionBy("doc").orderBy(F.desc("similarity"), "ref")
        found = best.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= top)
    return found.select(F.col("doc").alias(doc), "rank", F.col("ref").alias(ref), "similarity", "lists_read")

"""Many weighted random walks at once, repeatable whatever the partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from inkgraph.operators.graph import weight_or_default
from inkgraph.session import cut, placed

CHUNK_EDGES = 65_536       # edges of one node that are summed up in order in one group
BUCKETS = 65_536           # hash buckets of nodes; only in those with more than CHUNK_EDGES edges nodes are counted one by one
MAX_SLOTS = 65_536         # slots of [0, 1) per node; further edges only share a slot
MIN_SLOTS = 4              # so that walks meeting at a node with few edges still spread
WIDE = 1_024               # edges up to which a node has MIN_SLOTS; with more it has one for each SLOT_EDGES
SLOT_EDGES = 16
RUN = 1_024                # neighbouring edges of a slot that share a row, at most


def uniform(walk: str, step: int, purpose: str, seed: int) -> Column:
    """A number in [0, 1) that depends on its arguments only."""
    text = F.concat_ws("|", F.col(walk).cast("string"), F.lit(str(step)), F.lit(purpose), F.lit(str(seed)))
    return hash_place(F.md5(text))


def hash_place(digits: Column) -> Column:
    """Where a hash stands among all hashes, in [0, 1): its first 52 bits."""
    return F.conv(F.substring(digits, 1, 13), 16, 10).cast("double") / float(2**52)


def _hubs(rows: DataFrame) -> DataFrame:
    """(src, degree) of nodes with more than ``CHUNK_EDGES`` edges, so at most one for each so many edges."""
    keyed = rows.select("src", F.pmod(F.xxhash64("src"), F.lit(BUCKETS)).cast("int").alias("bucket"))
    full = keyed.groupBy("bucket").count().filter(F.col("count") > CHUNK_EDGES).select("bucket")      # at most BUCKETS rows
    counts = keyed.join(F.broadcast(full), "bucket", "left_semi").groupBy("src").agg(F.count("*").alias("degree"))
    return cut(counts.filter(F.col("degree") > CHUNK_EDGES))


def _interval_parts(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Intervals of the nodes that one group holds, which stay partitioned by ``src``, and of those summed in chunks.

    An edge without ``dst`` has its share too, though it leads nowhere; it comes first.
    """
    rows = edges.select("src", "dst", weight_or_default(F.col("weight")).alias("w"))
    rows = cut(rows.filter(F.col("src").isNotNull() & (F.col("w") > 0)))
    hubs = _hubs(rows)
    digits = F.md5(F.col("dst").cast("string"))
    kept = ["src", "dst", "lo", "hi", "degree", "chunk", "run"]

    def summed(rows: DataFrame, *keys: str) -> DataFrame:
        inside = Window.partitionBy(*keys).orderBy("hash", "dst")
        return rows.withColumns({
            "upto": F.sum("w").over(inside.rowsBetween(Window.unboundedPreceding, 0)),
            "before": F.coalesce(F.sum("w").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
            "size": F.sum("w").over(inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
            "run": F.floor((F.row_number().over(inside) - 1) / RUN),
        })

    few = rows.join(F.broadcast(hubs.select("src")), "src", "left_anti").repartition("src").withColumn("hash", digits)
    whole = Window.partitionBy("src").orderBy("hash", "dst").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    few = summed(few.withColumn("degree", F.count("*").over(whole)), "src").withColumn("chunk", F.lit(0).cast("long"))
    few = few.withColumns({"lo": F.col("before") / F.col("size"), "hi": F.col("upto") / F.col("size")}).select(kept)

    many = rows.join(F.broadcast(hubs), "src").withColumn("hash", digits)
    chunks = F.ceil(F.col("degree") / F.lit(CHUNK_EDGES))
    many = many.withColumn("chunk", F.coalesce(F.floor(hash_place(F.col("hash")) * chunks), F.lit(0)))
    many = cut(summed(many, "src", "chunk").drop("hash", "w"))
    ends = many.groupBy("src", "chunk").agg(F.max("size").alias("size"))
    per_node = Window.partitionBy("src").orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)
    shifts = ends.withColumn("sums", F.sum("size").over(per_node)).withColumns({
        "shift": F.coalesce(F.lag("sums").over(Window.partitionBy("src").orderBy("chunk")), F.lit(0.0)),
        "total": F.max("sums").over(Window.partitionBy("src")),
    })
    many = many.join(shifts.select("src", "chunk", "shift", "total"), ["src", "chunk"]).withColumns({
        "lo": (F.col("shift") + F.col("before")) / F.col("total"), "hi": (F.col("shift") + F.col("upto")) / F.col("total"),
    })
    return few, many.select(kept)


def intervals(edges: DataFrame) -> DataFrame:
    """(src, dst, lo, hi, degree): each edge's share of [0, 1), in order of (md5 of ``dst``, ``dst``).

    The edges of a node are summed in chunks, which are ranges of that hash, and
    the chunks are then shifted by the totals before them: the order is one and
    the same however many chunks a node has.  Edges without weight have no share.
    """
    few, many = _interval_parts(edges)
    return few.unionByName(many).filter(F.col("dst").isNotNull()).select("src", "dst", "lo", "hi", "degree")


def _slots(parts: DataFrame) -> DataFrame:
    """(node, slot, slots, lo, hi, tops, ends): runs of edges by equal slot of [0, 1); edge i of a run ends at ``tops[i]`` and leads to ``ends[i]``."""
    wanted = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("degree") / F.lit(SLOT_EDGES)))).cast("int")
    slots = F.when(F.col("degree") <= WIDE, F.lit(MIN_SLOTS)).otherwise(F.least(F.lit(MAX_SLOTS), F.greatest(F.lit(MIN_SLOTS), wanted)))
    first = F.floor(F.col("lo") * F.col("slots"))
    last = F.least(F.floor(F.col("hi") * F.col("slots")), F.col("slots") - 1)
    rows = parts.filter("lo < hi").withColumn("slots", slots)       # so no two edges of a run end at the same place
    rows = rows.withColumn("slot", F.explode(F.sequence(first, last)))
    edge = F.struct(F.col("hi").alias("top"), F.col("dst").alias("end"))
    runs = rows.groupBy("src", "slot", "chunk", "run").agg(
        F.first("slots").alias("slots"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sort_array(F.collect_list(edge)).alias("e"),
    )
    return runs.select(F.col("src").alias("node"), "slot", "slots", "lo", "hi", F.col("e.top").alias("tops"), F.col("e.end").alias("ends"))


def random_walks(
    edges: DataFrame, starts: DataFrame, walk: str = "walk_id", max_steps: int = 12, stop_probability: float = 0.15,
    seed: int = 42, steps_per_cut: int = 4,
) -> DataFrame:
    """(walk, path, n_moves): nodes in order of first visit, for each (walk, start).

    Before each step a walk may stop; it also stops at a node without out-edges.
    A step is an equi-join on (node, slot of the random number), so walks that
    are at the same hub spread over its slots; a row has the neighbouring edges
    of a slot as arrays.  These rows are partitioned and sorted by that key once;
    in a step only the walks are exchanged.  Only nodes with more than ``WIDE``
    edges have another number of slots than the rest and are looked up.
    """
    spark = edges.sparkSession
    few, many = _interval_parts(edges)
    table = cut(_slots(few).unionByName(_slots(many)))
    wide = cut(table.filter(F.col("slots") != MIN_SLOTS).select(F.col("node").alias("at"), "slots").distinct())
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    moves = placed(spark, lambda: table.drop("slots").repartition(parts, "node", "slot"), "node", "slot")
    state = starts.select(
        walk, F.col("start").alias("node"), F.lit(True).alias("on"), F.array("start").alias("path"), F.lit(0).alias("n_moves")
    )
    for step in range(1, max_steps + 1):
        goes = F.col("on") & (uniform(walk, step, "stop", seed) >= stop_probability)
        u = uniform(walk, step, "move", seed)
        slot = F.floor(F.col("u") * F.coalesce("slots", F.lit(MIN_SLOTS)))
        nowhere = -1 - F.pmod(F.xxhash64(walk), F.lit(MAX_SLOTS))        # no slot: walks that have stopped spread over the tasks
        state = state.join(wide, F.col("node") == F.col("at"), "left").withColumn("u", u)
        state = state.withColumn("slot", F.when(goes, slot).otherwise(nowhere)).drop("at", "slots")
        here = (state["node"] == moves["node"]) & (state["slot"] == moves["slot"])
        passed = F.size(F.filter("tops", lambda top: top <= F.col("u")))
        state = state.join(moves, here & (F.col("u") >= F.col("lo")) & (F.col("u") < F.col("hi")), "left").select(
            walk, state["node"], "path", "n_moves", F.get("ends", passed).alias("next_node"),
        ).select(
            walk, F.coalesce("next_node", "node").alias("node"), F.col("next_node").isNotNull().alias("on"),
            F.when(F.col("next_node").isNull(), F.col("path"))
            .otherwise(F.concat("path", F.array("next_node"))).alias("path"),
            (F.col("n_moves") + F.col("next_node").isNotNull().cast("int")).alias("n_moves"),
        )
        if step % steps_per_cut == 0 and step < max_steps:
            state = cut(state)
    return state.select(walk, F.array_distinct("path").alias("path"), "n_moves")

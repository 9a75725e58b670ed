"""Directed weighted graphs as two tables: building, expanding, simple measures."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from inkgraph import fixed_values as fixed
from inkgraph.operators.skew import find_hot, lookup_join, spread_join
from inkgraph.session import cut


@dataclass(frozen=True)
class Graph:
    """``nodes(id, ...)`` and ``edges(src, dst, weight, ...)``, one edge per ordered pair."""

    nodes: DataFrame
    edges: DataFrame


def last_edge(edges: DataFrame, order: str) -> DataFrame:
    """One edge per ordered pair, the one with the highest ``order``; combined map-side."""
    rest = [c for c in edges.columns if c not in ("src", "dst", order)]
    best = F.max_by(F.struct(*rest), order).alias("e")
    return edges.groupBy("src", "dst").agg(best).select("src", "dst", *[F.col(f"e.{c}") for c in rest])


def build_graph(nodes: DataFrame, edges: DataFrame, order: str | None = None) -> Graph:
    """Isolated nodes stay; end points missing from ``nodes`` are added with empty attributes."""
    edges = last_edge(edges, order) if order else edges
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    known = [c for c in nodes.columns if c != "id"]
    attributes = F.first(F.struct(*known), ignorenulls=True).alias("n") if known else F.count("*").alias("n")
    listed = nodes.select("id", F.struct(*known).alias("n")) if known else nodes.select("id", F.lit(1).alias("n"))
    missing = ends.withColumn("n", F.lit(None).cast(listed.schema["n"].dataType))
    merged = listed.unionByName(missing)
    if not known:
        return Graph(merged.select("id").distinct(), edges)
    return Graph(merged.groupBy("id").agg(F.first("n", ignorenulls=True).alias("n")).select("id", "n.*"), edges)


def expand_to_members(class_edges: DataFrame, members: DataFrame, member_weight: float = fixed.MEMBER_WEIGHT) -> DataFrame:
    """Edges between members: within a class (both directions), and along class edges.

    ``members`` is (class, node).  The result is as large as the pairs it lists;
    a pair given by a class edge replaces the one from within the class.
    """
    inside = (
        members.select("class", F.col("node").alias("src"))
        .join(members.select("class", F.col("node").alias("dst")), "class")
        .filter(F.col("src") != F.col("dst"))
        .select("src", "dst", F.lit(member_weight).alias("weight"), F.lit(fixed.MEMBER_EDGE).alias("edge_type"),
                F.lit(0).alias("ord"))
    )
    starts = members.select(F.col("class").alias("from_class"), F.col("node").alias("src"))
    ends = members.select(F.col("class").alias("to_class"), F.col("node").alias("dst"))
    across = (
        class_edges.select(F.col("src").alias("from_class"), F.col("dst").alias("to_class"), "weight")
        .join(starts, "from_class").join(ends, "to_class")
        .select("src", "dst", "weight", F.lit(fixed.CLASS_EDGE).alias("edge_type"), F.lit(1).alias("ord"))
    )
    return last_edge(inside.unionByName(across), "ord")


def degrees(graph: Graph) -> DataFrame:
    """(id, in_degree, out_degree), zero for nodes without edges; counts are combined map-side."""
    ends = F.explode(F.array(
        F.struct(F.col("src").alias("id"), F.lit(0).alias("i"), F.lit(1).alias("o")),
        F.struct(F.col("dst").alias("id"), F.lit(1).alias("i"), F.lit(0).alias("o")),
    ))
    none = graph.nodes.select("id", F.lit(0).alias("i"), F.lit(0).alias("o"))
    return (
        graph.edges.select(ends.alias("e")).select("e.*").unionByName(none)
        .groupBy("id").agg(F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"))
    )


def size_and_density(graph: Graph) -> DataFrame:
    """One row: n_nodes, n_edges, density = m / (n (n - 1))."""
    parts = graph.nodes.select(F.lit(1).alias("n"), F.lit(0).alias("m")).unionByName(
        graph.edges.select(F.lit(0).alias("n"), F.lit(1).alias("m"))
    )
    sums = parts.agg(F.sum("n").alias("n_nodes"), F.sum("m").alias("n_edges"))
    pairs = F.col("n_nodes") * (F.col("n_nodes") - 1)
    return sums.withColumn("density", F.round(F.coalesce(F.col("n_edges") / F.nullif(pairs, F.lit(0)), F.lit(0.0)), 4))


def weight_or_default(weight: Column) -> Column:
    return F.coalesce(weight, F.lit(fixed.DEFAULT_WEIGHT))


def source_totals(edges: DataFrame) -> DataFrame:
    """(src, total): what the edges of each source weigh together; sources whose total is 0 are left out."""
    weighted = edges.select("src", weight_or_default(F.col("weight")).alias("w"))
    return weighted.groupBy("src").agg(F.sum("w").alias("total")).filter("total <> 0")


def transition_probabilities(edges: DataFrame) -> DataFrame:
    """(src, dst, p): weights divided by the total of their source; a source whose total is 0 has no moves.

    Totals are summed map-side and joined back, so a hub is never gathered in
    one task as a window over ``src`` would do.
    """
    weighted = edges.select("src", "dst", weight_or_default(F.col("weight")).alias("w"))
    return lookup_join(weighted, source_totals(edges), "src").select(
        "src", "dst", (F.col("w") / F.col("total")).alias("p")
    )


def strongest_edges(edges: DataFrame, top: int) -> DataFrame:
    """The ``top`` heaviest out-edges of each node; all but ``top`` are dropped before the shuffle."""
    order = Window.partitionBy("src").orderBy(F.desc("weight"), "dst")
    return edges.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= top).drop("nth")


def transitions(events: DataFrame, actor: str, order: list[str], state: str, chunk: Column) -> DataFrame:
    """(src, dst, weight): how often one state of an actor is followed by another.

    ``chunk`` has to be non-decreasing along ``order`` (a day, for instance).
    Followers are found per (actor, chunk), so a busy actor is many small groups;
    the last event of a chunk gets the first state of the actor's next chunk.
    """
    rows = events.select(actor, F.struct(*order).alias("at"), F.col(state).alias("src"), chunk.alias("chunk"))
    inner = rows.withColumn("dst", F.lead("src").over(Window.partitionBy(actor, "chunk").orderBy("at")))
    edges_of_chunks = rows.groupBy(actor, "chunk").agg(
        F.min_by("src", "at").alias("first"), F.max_by("src", "at").alias("last")
    )
    following = edges_of_chunks.withColumn(
        "dst", F.lead("first").over(Window.partitionBy(actor).orderBy("chunk"))
    )
    steps = inner.select("src", "dst").unionByName(following.select(F.col("last").alias("src"), "dst"))
    return steps.filter(F.col("dst").isNotNull()).groupBy("src", "dst").agg(
        F.count("*").cast("double").alias("weight")
    )


def expected_visits(
    edges: DataFrame, starts: DataFrame, max_steps: int = 12, stop_probability: float = 0.15, steps_per_cut: int = 4
) -> DataFrame:
    """(start, node, visits): expected visits of a walk that may stop before each step.

    Every node also has an edge to itself that carries what was counted so far
    and no mass.  One join and one sum per step are then enough, and the state
    is read once per step.
    """
    moves = transition_probabilities(edges)
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("src")).distinct()
    keep = nodes.select("src", F.col("src").alias("dst"), F.lit(None).cast("double").alias("p"))
    moves = cut(moves.unionByName(keep))
    hot = find_hot(moves, "src")
    state = starts.select(
        F.col("start"), F.col("start").alias("src"), F.lit(1.0).alias("mass"), F.lit(1.0).alias("visits")
    ).join(nodes, "src", "left_semi")
    for step in range(1, max_steps + 1):
        moved = F.col("mass") * (1 - stop_probability) * F.col("p")
        carried = F.col("p").isNull()
        state = (
            spread_join(moves, state, "src", by=["dst"], hot=hot)
            .select(
                "start", F.col("dst").alias("src"),
                F.when(carried, 0.0).otherwise(moved).alias("mass"),
                F.when(carried, F.col("visits")).otherwise(moved).alias("visits"),
            )
            .groupBy("start", "src").agg(F.sum("mass").alias("mass"), F.sum("visits").alias("visits"))
        )
        if step % steps_per_cut == 0 and step < max_steps:
            state = cut(state)
    return state.select("start", F.col("src").alias("node"), "visits")

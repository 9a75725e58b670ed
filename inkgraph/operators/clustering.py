"""KMeans with restarts, top-down hierarchy, centroids, inertia, keywords of clusters."""

from __future__ import annotations

from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml.clustering import BisectingKMeans, KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window, functions as F

from inkgraph.functions.arrays import squared_distance, unnest
from inkgraph.operators import silhouette, tfidf
from inkgraph.operators.skew import lookup_join
from inkgraph.session import cut

RESTARTS = 20
SWEEP_RESTARTS = 15
MAX_CLUSTERS = 10_000      # centroids are the only thing held by every task


def to_vectors(df: DataFrame, column: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(column).cast("array<double>")))


@dataclass(frozen=True)
class Clustering:
    assigned: DataFrame        # input columns plus ``cluster``
    inertia: float
    centroids: list[list[float]]


def _best_kmeans(vectors: DataFrame, k: int, restarts: int, seed: int, parallelism: int) -> KMeansModel:
    """The fit with the lowest inertia; restarts share the cached vectors and run side by side."""
    def run(i: int) -> KMeansModel:
        return KMeans(k=k, seed=seed + i, maxIter=300, tol=1e-4, featuresCol="features").fit(vectors)

    with ThreadPool(min(parallelism, restarts)) as pool:
        models = pool.map(run, range(restarts))
    return min(models, key=lambda model: model.summary.trainingCost)


def kmeans(
    df: DataFrame, column: str, k: int = 4, restarts: int = RESTARTS, seed: int = 42, parallelism: int = 4
) -> Clustering:
    vectors = to_vectors(df, column)
    cached = vectors.select("features").persist()
    try:
        model = _best_kmeans(cached, k, restarts, seed, parallelism)
    finally:
        cached.unpersist()
    assigned = model.setPredictionCol("cluster").transform(vectors).drop("features")
    return Clustering(assigned, model.summary.trainingCost, [c.tolist() for c in model.clusterCenters()])


def bisecting(df: DataFrame, column: str, k: int = 4, seed: int = 42) -> DataFrame:
    """Top-down hierarchy with ``k`` leaves: the choice for large data."""
    vectors = to_vectors(df, column)
    cached = vectors.select("features").persist()
    try:
        model = BisectingKMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(cached)
    finally:
        cached.unpersist()
    return model.transform(vectors).drop("features")


def sweep_k(
    df: DataFrame, key: str, column: str, ks: range = range(2, 8), restarts: int = SWEEP_RESTARTS, seed: int = 42,
    measure: str = "euclidean",
) -> DataFrame:
    """(k, inertia, silhouette) for each k below the number of rows."""
    n = df.count()
    rows = []
    for k in (k for k in ks if k < n):
        result = kmeans(df, column, k, restarts, seed)
        score = silhouette.score(result.assigned, key, column, "cluster", measure)
        rows.append((k, round(result.inertia, 2), round(score, 4)))
    return df.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def centroids(df: DataFrame, column: str, cluster: str = "cluster") -> DataFrame:
    """(cluster, size, centroid): mean vectors, combined map-side."""
    return to_vectors(df, column).groupBy(cluster).agg(
        F.count("*").alias("size"), Summarizer.mean(F.col("features")).alias("mean")
    ).select(cluster, "size", vector_to_array("mean").alias("centroid"))


def nearest_centroid(df: DataFrame, column: str, centres: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Add ``nearest`` and ``distance2``; centroids become one array for every row, so no shuffle."""
    if centres.count() > MAX_CLUSTERS:
        raise ValueError(f"more than {MAX_CLUSTERS} centroids")
    table = centres.agg(F.collect_list(F.struct(F.col(cluster).alias("c"), "centroid")).alias("all")).scalar()
    values = F.col(column).cast("array<double>")
    closest = F.array_min(F.transform(F.col("centres"), lambda c: F.struct(
        squared_distance(F.col("point"), c["centroid"]).alias("d2"), c["c"].alias("c")
    )))
    return (
        df.withColumns({"centres": table, "point": values})
        .withColumn("closest", closest)
        .withColumns({"nearest": F.col("closest.c"), "distance2": F.col("closest.d2")})
        .drop("centres", "point", "closest")
    )


def inertia(df: DataFrame, column: str, cluster: str = "cluster") -> DataFrame:
    """Sum of squared distances of rows to the mean of their own cluster."""
    centres = cut(centroids(df, column, cluster))
    points = df.select(cluster, F.col(column).cast("array<double>").alias("point"))
    own = lookup_join(points, centres, cluster)
    return own.agg(F.sum(squared_distance(F.col("point"), F.col("centroid"))).alias("inertia"))


def cluster_keywords(
    rows: DataFrame, cluster: str, model: tfidf.TfIdf, top: int = 8
) -> DataFrame:
    """(cluster, rank, term, weight): terms with the highest mean weight over all members.

    ``rows`` carries ``cluster``, ``indices`` and ``weights``.  Weights are summed
    map-side to at most clusters x vocabulary rows before any ranking.
    """
    sizes = cut(rows.groupBy(cluster).agg(F.count("*").alias("members")))
    sums = (
        unnest(rows, F.arrays_zip("indices", "weights"), "e", cluster)
        .groupBy(cluster, F.col("e.indices").alias("idx")).agg(F.sum("e.weights").alias("total"))
    )
    order = Window.partitionBy(cluster).orderBy(F.desc("weight"), "idx")
    return (
        lookup_join(sums, sizes, cluster)
        .withColumn("weight", F.round(F.col("total") / F.col("members"), 6))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
        .join(F.broadcast(model.table(rows.sparkSession)), "idx")     # bounded by max_features
        .select(cluster, "rank", "term", "weight")
    )


def keyword_lists(keywords: DataFrame, cluster: str = "cluster") -> DataFrame:
    """(cluster, top_keywords): at most ``top`` terms each, best first."""
    listed = F.array_sort(F.collect_list(F.struct("rank", "term")))
    return keywords.groupBy(cluster).agg(F.transform(listed, lambda e: e["term"]).alias("top_keywords"))

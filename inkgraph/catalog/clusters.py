"""Embeddings, clusterings, their quality, and cluster profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from inkgraph import fixed_values as fixed
from inkgraph.catalog.common import load, q
from inkgraph.catalog.texts import weights_sql
from inkgraph.operators import clustering, hierarchy, lsa, multi_kmeans, profiles, silhouette, tfidf
from inkgraph.plans import reports
from inkgraph.session import cut
from inkgraph.sources import tables

FEATURES = 10_000
COMPONENTS = 50
WEIGHTS_SQL = weights_sql(FEATURES)


def _points(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "embeddings", spread_by="vec_id")


def _docs(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "documents", spread_by="doc_id")


def e1_lsa(spark, folder):
    """Length and first-component share of each document's dense row."""
    dense = lsa.embed(_docs(spark, folder).select("doc_id", "text"), "text", COMPONENTS, FEATURES)
    total = F.aggregate(F.transform("embedding", lambda x: x * x), F.lit(0.0), lambda t, x: t + x)
    first = F.abs(F.get("embedding", F.lit(0)))
    return dense.select("doc_id", F.size("embedding").alias("n"), F.round(F.sqrt(total), 6).alias("length"),
                        F.round(first, 4).alias("first"))


def e2_projection(spark, folder):
    return lsa.project_2d(_points(spark, folder), "embedding").select("vec_id", "x", "y")


def u1_kmeans(spark, folder):
    points = _points(spark, folder)
    fitted = multi_kmeans.fit_many(points, "vec_id", "embedding", [4], clustering.RESTARTS)
    centres, _ = fitted.best(4)
    return multi_kmeans.assign(points, "embedding", centres).select("vec_id", "cluster")


def u2_ward(spark, folder):
    return hierarchy.ward(_points(spark, folder), "vec_id", "embedding", 4).select("vec_id", "cluster")


def u2_bisecting(spark, folder):
    return clustering.bisecting(_points(spark, folder), "embedding", 4).select("vec_id", "cluster")


def u3_silhouette(spark, folder):
    values = silhouette.values(_points(spark, folder), "vec_id", "embedding", "label")
    return values.select("vec_id", "label", *[F.round(c, 6).alias(c) for c in ("a", "b", "silhouette")])


def u3_silhouette_mean(spark, folder):
    values = silhouette.values(_points(spark, folder), "vec_id", "embedding", "label")
    return values.agg(F.round(F.avg("silhouette"), 4).alias("silhouette"))


def u3_silhouette_squared(spark, folder):
    """The linear form, by squared distances."""
    mean = silhouette.score(_points(spark, folder), "vec_id", "embedding", "label", "squared")
    return load(spark, folder, "embeddings").agg(F.count("*").alias("n")).withColumn("silhouette", F.lit(round(mean, 4)))


def u4_inertia(spark, folder):
    return clustering.inertia(_points(spark, folder), "embedding", "label").select(F.round("inertia", 4).alias("inertia"))


def u5_sweep(spark, folder):
    """(k, inertia, silhouette) for k = 2..7, the 15 restarts of every k fitted in the same passes."""
    points = _points(spark, folder)
    ks = list(range(2, 8))
    fitted = multi_kmeans.fit_many(points, "vec_id", "embedding", ks, clustering.SWEEP_RESTARTS)
    found = {k: fitted.best(k) for k in sorted(set(fitted.ks))}
    assigned = points
    for k, (centres, _) in found.items():
        assigned = multi_kmeans.assign(assigned, "embedding", centres, f"cluster{k}").filter(F.col(f"cluster{k}").isNotNull())
    names = [f"cluster{k}" for k in found]
    scores = silhouette.euclidean_scores(cut(assigned), "vec_id", "embedding", names) if found else []
    rows = [(k, round(inertia, 2), round(score, 4)) for (k, (_, inertia)), score in zip(found.items(), scores)]
    return spark.createDataFrame(rows, "k int, inertia double, silhouette double")


def u6_nearest_centroid(spark, folder):
    points = _points(spark, folder)
    centres = cut(clustering.centroids(points, "embedding", "label"))
    found = clustering.nearest_centroid(points, "embedding", centres, "label")
    return found.select("vec_id", "label", "nearest", F.round("distance2", 6).alias("distance2"))


def u7_centroids(spark, folder):
    centres = clustering.centroids(_points(spark, folder), "embedding", "label")
    return centres.select("label", "size", F.posexplode("centroid").alias("dim", "value")).withColumn(
        "value", F.round("value", 6)
    )


def _language_keywords(spark, folder):
    docs = _docs(spark, folder)
    model = tfidf.fit(docs, "text", FEATURES)
    return clustering.cluster_keywords(model.transform(docs, "text"), "lang", model, 8)


def u8_cluster_keywords(spark, folder):
    return _language_keywords(spark, folder)


def _given_clusters(spark, folder):
    """Documents in clusters known from the tables: quality as one, toxicity as the other."""
    rated = load(spark, folder, "labels")
    return (
        rated.select("doc_id", (F.col("quality") * 4).alias("cluster")),
        rated.select("doc_id", F.col("toxic").alias("cluster")),
    )


def u9_profiles(spark, folder):
    km, hac = _given_clusters(spark, folder)
    docs = _docs(spark, folder)
    model = tfidf.fit(docs, "text", FEATURES)
    rows = model.transform(docs.join(km, "doc_id"), "text")
    words = clustering.keyword_lists(clustering.cluster_keywords(rows, "cluster", model, 5))
    out = profiles.profiles(docs, "doc_id", "source", km, hac, tables.profile_names(spark), words)
    return out.withColumn("top_keywords", F.array_join("top_keywords", ", "))


def u10_scatter_join(spark, folder):
    """Given coordinates and clusters, joined to their profile names."""
    points = _points(spark, folder).select(
        "vec_id", F.concat(F.lit("v"), "vec_id").alias("title"), F.col("label").alias("cluster"),
        F.round(F.get("embedding", F.lit(0)).cast("double"), 6).alias("x"),
        F.round(F.get("embedding", F.lit(1)).cast("double"), 6).alias("y"),
    )
    return profiles.scatter(points, "vec_id", "title", tables.profile_names(spark))


def _clustered(spark, folder):
    return reports.cluster_reports(
        _docs(spark, folder), "doc_id", "source", "text", tables.profile_names(spark), n_components=COMPONENTS,
        max_features=FEATURES,
    )


def u9_u10_clustered_reports(spark, folder):
    """Embedding, both clusterings and their silhouettes, projection, keywords and names in one go."""
    result = _clustered(spark, folder)
    place = result.scatter.select(F.col("id").alias("report_id"), "x", "y", "profile")
    return result.profiles.join(place, "report_id").withColumns({
        "top_keywords": F.array_join("top_keywords", ", "),
        "km_silhouette": F.lit(result.km_silhouette), "hac_silhouette": F.lit(result.hac_silhouette),
    })


_PAIRS = """
p AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
m AS (SELECT a.vec_id, a.label, b.label AS other, sum(list_distance(a.v, b.v){power}) AS total,
    count(*) FILTER (WHERE a.vec_id <> b.vec_id) AS n FROM p a CROSS JOIN p b GROUP BY ALL),
ab AS (SELECT vec_id, label, max(CASE WHEN label = other AND n > 0 THEN total / n END) AS a,
    min(CASE WHEN label <> other THEN total / n END) AS b FROM m GROUP BY ALL),
s AS (SELECT *, CASE WHEN a IS NULL OR b IS NULL THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END AS silhouette FROM ab)"""

_CENTRES = """
x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS value, unnest(range(len(embedding)))::INT AS dim FROM embeddings),
c AS (SELECT label, dim, count(*) AS size, avg(value) AS value FROM x GROUP BY ALL)"""

_KEYWORDS = """
means AS (SELECT {cluster} AS cluster, term, round(sum(weight) / any_value(members), 6) AS weight
  FROM unit JOIN {docs} USING (doc_id) JOIN (SELECT {cluster}, count(*) AS members FROM {docs} GROUP BY ALL) USING ({cluster})
  GROUP BY ALL),
words AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY weight DESC, term) AS rank FROM means)"""

_NAMES = "(VALUES " + ", ".join(f"({k}, {q(v)})" for k, v in fixed.PROFILE_NAMES.items()) + ") AS names(cluster, name)"

QUERIES = {
    "e1_lsa": e1_lsa,
    "e2_projection": e2_projection,
    "u1_kmeans": u1_kmeans,
    "u2_ward": u2_ward,
    "u2_bisecting": u2_bisecting,
    "u3_silhouette": u3_silhouette,
    "u3_silhouette_mean": u3_silhouette_mean,
    "u3_silhouette_squared": u3_silhouette_squared,
    "u4_inertia": u4_inertia,
    "u5_sweep": u5_sweep,
    "u6_nearest_centroid": u6_nearest_centroid,
    "u7_centroids": u7_centroids,
    "u8_cluster_keywords": u8_cluster_keywords,
    "u9_profiles": u9_profiles,
    "u10_scatter_join": u10_scatter_join,
    "u9_u10_clustered_reports": u9_u10_clustered_reports,
}

ORACLES = {
    "u3_silhouette": f"WITH {_PAIRS.format(power="")} SELECT vec_id, label, round(a, 6) AS a, round(b, 6) AS b, "
                     "round(silhouette, 6) AS silhouette FROM s",
    "u3_silhouette_mean": f"WITH {_PAIRS.format(power="")} SELECT round(avg(silhouette), 4) AS silhouette FROM s",
    "u3_silhouette_squared": f"WITH {_PAIRS.format(power=' ** 2')} SELECT count(*) AS n, round(avg(silhouette), 4) AS silhouette FROM s",
    "u4_inertia": f"WITH {_CENTRES} SELECT round(sum((x.value - c.value) * (x.value - c.value)), 4) AS inertia "
                  "FROM x JOIN c USING (label, dim)",
    "u6_nearest_centroid": f"""
WITH {_CENTRES},
d AS (SELECT vec_id, x.label, c.label AS nearest, sum((x.value - c.value) * (x.value - c.value)) AS distance2
  FROM x JOIN c USING (dim) GROUP BY ALL)
SELECT vec_id, label, nearest, round(distance2, 6) AS distance2
FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance2, nearest) AS nth FROM d) WHERE nth = 1""",
    "u7_centroids": f"WITH {_CENTRES} SELECT label, size, dim, round(value, 6) AS value FROM c",
    "u8_cluster_keywords": WEIGHTS_SQL + "," + _KEYWORDS.format(cluster="lang", docs="documents") +
    " SELECT cluster AS lang, rank::INT AS rank, term, weight FROM words WHERE rank <= 8",
    "u9_profiles": WEIGHTS_SQL + ", good AS (SELECT doc_id, quality * 4 AS k FROM documents JOIN labels USING (doc_id))," +
    _KEYWORDS.format(cluster="k", docs="good") + f""",
lists AS (SELECT cluster, string_agg(term, ', ' ORDER BY rank) AS top_keywords FROM words WHERE rank <= 5 GROUP BY cluster),
rated AS (SELECT doc_id, quality * 4 AS kmeans_cluster, toxic AS hac_cluster FROM labels)
SELECT doc_id AS report_id, source AS title, kmeans_cluster, hac_cluster,
  coalesce(name, 'Cluster-' || kmeans_cluster) AS actor_profile, coalesce(top_keywords, '') AS top_keywords
FROM documents JOIN rated USING (doc_id) LEFT JOIN {_NAMES} ON names.cluster = kmeans_cluster
LEFT JOIN lists ON lists.cluster = kmeans_cluster""",
    "u10_scatter_join": f"""
SELECT vec_id AS id, 'v' || vec_id AS title, round(embedding[1]::DOUBLE, 6) AS x, round(embedding[2]::DOUBLE, 6) AS y,
  label AS cluster, coalesce(name, 'Cluster-' || label) AS profile FROM embeddings LEFT JOIN {_NAMES} ON names.cluster = label""",
}

"""Queries on vectors and clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import vectors as V
from quern.operators import clustering, dedup, neighbours, reports
from quern.operators.components import connected_components
from quern.shared import table


def _rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("vec"), "label")


def unit_vectors(spark, folder):
    v = table(spark, folder, "embeddings")
    unit = V.unit(F.transform("embedding", lambda x: (x * 3).cast("float")))
    return v.select("vec_id", F.round(V.norm(unit), 3).alias("norm"), *[F.round(unit[i].cast("double"), 3).alias(f"x{i}") for i in (0, 31, 63)])


def neighbours_of_queries(spark, folder):
    rows = _rows(spark, folder)
    return neighbours.nearest(rows.where("vec_id % 20 = 0"), rows, "vec_id", "vec", 20).select("query", "neighbour", F.col("rank").cast("int").alias("rank"))


def similar_pairs(spark, folder):
    found = neighbours.similar_vectors(_rows(spark, folder), "vec_id", "vec", 0.4)
    return found.where("i < j").select("i", "j", F.round("score", 6).alias("score"))


def semantic_duplicates(spark, folder):
    rows = _rows(spark, folder)
    edges = dedup.ranked_edges(neighbours.similar_vectors(rows, "vec_id", "vec", 0.4))
    return dedup.greedy(edges, rows.select(F.col("vec_id").alias("node"), F.col("label").alias("weight"))).select(F.col("node").alias("vec_id"))


def similarity_components(spark, folder):
    pairs = neighbours.similar_vectors(_rows(spark, folder), "vec_id", "vec", 0.4).where("i < j")
    return connected_components(pairs, "i", "j")


def noise_assigned(spark, folder):
    rows = _rows(spark, folder)
    labels = rows.select("vec_id", F.when(F.col("label") == 0, -1).otherwise(F.col("label")).cast("int").alias("cluster_id"))
    return clustering.with_noise_assigned(labels, rows, "vec_id", "vec")


def density_clusters(spark, folder):
    return clustering.density_clusters(_rows(spark, folder), "vec_id", "vec")


def kmeans_clusters(spark, folder):
    return clustering.kmeans(_rows(spark, folder), "vec_id", "vec")


def plane_coordinates(spark, folder):
    return clustering.plane(_rows(spark, folder), "vec_id", "vec")


def similarity_histogram(spark, folder):
    rows = _rows(spark, folder)
    return neighbours.similarity_bins(rows.where("vec_id % 20 = 0"), rows, "vec_id", "vec", 20, -1.0, 1.0)


def neighbour_map(spark, folder):
    return clustering.neighbour_map(_rows(spark, folder), "vec_id", "vec")


def calibration_histogram(spark, folder):
    return neighbours.calibration(_rows(spark, folder), "vec_id", "vec")


def chart_points(spark, folder):
    rows = _rows(spark, folder)
    points = rows.select("vec_id", F.round(F.col("vec")[0], 4).alias("x"), F.round(F.col("vec")[1], 4).alias("y"))
    return reports.scatter(points, rows, "vec_id", "label").withColumn("number", F.col("number").cast("int"))


def label_numbers(spark, folder):
    return reports.colours(table(spark, folder, "qa_raw"), "generation_model").select("generation_model", F.col("number").cast("int").alias("number"))


_DOT = "list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(d.embedding AS DOUBLE[]))"
QUERIES = {f.__name__: f for f in (unit_vectors, neighbours_of_queries, similar_pairs, semantic_duplicates, similarity_components, noise_assigned, density_clusters, kmeans_clusters, plane_coordinates, similarity_histogram, neighbour_map, calibration_histogram, chart_points, label_numbers)}
SQL = {
    "unit_vectors": """WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: 3 * CAST(x AS DOUBLE)) AS v FROM embeddings), n AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS n FROM e),
u AS (SELECT vec_id, list_transform(v, lambda x: CASE WHEN n = 0 THEN 0 ELSE x / n END) AS u FROM n)
SELECT vec_id, round(sqrt(list_sum(list_transform(u, lambda x: x * x))), 3) AS norm, round(u[1], 3) + 0.0 AS x0, round(u[32], 3) + 0.0 AS x31, round(u[64], 3) + 0.0 AS x63 FROM u""",
    "neighbours_of_queries": f"SELECT q.vec_id AS query, d.vec_id AS neighbour, CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY {_DOT} DESC, d.vec_id) AS INT) AS rank FROM embeddings q, embeddings d WHERE q.vec_id % 20 = 0 QUALIFY rank <= 20",
    "similar_pairs": f"SELECT q.vec_id AS i, d.vec_id AS j, round({_DOT}, 6) AS score FROM embeddings q JOIN embeddings d ON q.vec_id < d.vec_id WHERE {_DOT} >= 0.4",
    "semantic_duplicates": f"""WITH RECURSIVE s AS (SELECT q.vec_id AS i, d.vec_id AS j, {_DOT} AS score FROM embeddings q JOIN embeddings d ON {_DOT} >= 0.4),
k AS (SELECT i, j, row_number() OVER (PARTITION BY i ORDER BY score DESC, j) AS rank FROM s),
n AS (SELECT row_number() OVER (ORDER BY i) AS k, i, any_value(a.label) AS wi, list({{'j': j, 'w': b.label}}) AS nb FROM k JOIN embeddings a ON a.vec_id = i JOIN embeddings b ON b.vec_id = j WHERE rank > 1 AND rank <= 20 AND i <> j GROUP BY i),
r AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS gone UNION ALL
SELECT n.k, CASE WHEN list_contains(r.gone, n.i) THEN r.gone ELSE list_concat(list_concat(r.gone, list_transform(list_filter(n.nb, lambda x: NOT list_contains(r.gone, x.j) AND n.wi >= x.w), lambda x: x.j)), CASE WHEN len(list_filter(n.nb, lambda x: NOT list_contains(r.gone, x.j) AND n.wi < x.w)) > 0 THEN [n.i] ELSE CAST([] AS BIGINT[]) END) END FROM r JOIN n ON n.k = r.k + 1)
SELECT DISTINCT unnest(gone) AS vec_id FROM r WHERE k = (SELECT max(k) FROM r)""",
    "similarity_components": f"""WITH RECURSIVE p AS (SELECT q.vec_id AS i, d.vec_id AS j FROM embeddings q JOIN embeddings d ON q.vec_id <> d.vec_id WHERE {_DOT} >= 0.4),
r AS (SELECT DISTINCT i AS node, i AS seen FROM p UNION SELECT r.node, p.j FROM r JOIN p ON r.seen = p.i) SELECT node, min(seen) AS component FROM r GROUP BY node""",
    "noise_assigned": f"""WITH n AS (SELECT q.vec_id, arg_min(d.label, {{'d': list_distance(CAST(q.embedding AS DOUBLE[]), CAST(d.embedding AS DOUBLE[])), 'i': d.vec_id}}) AS l FROM embeddings q, embeddings d WHERE q.label = 0 AND d.label <> 0 GROUP BY 1)
SELECT vec_id, CAST(coalesce(n.l, e.label) AS INT) AS cluster_id FROM embeddings e LEFT JOIN n USING (vec_id)""",
    "similarity_histogram": f"SELECT CAST(least(19, greatest(0, floor(({_DOT} + 1) / 2 * 20))) AS INT) AS bin, count(*) AS count FROM embeddings q, embeddings d WHERE q.vec_id % 20 = 0 AND q.vec_id <> d.vec_id GROUP BY 1",
    "calibration_histogram": f"""WITH e AS (SELECT * FROM embeddings ORDER BY md5('42:' || CAST(vec_id AS VARCHAR)), vec_id LIMIT 300)
SELECT CAST(least(99, greatest(0, floor(({_DOT} + 1) / 2 * 100))) AS INT) AS bin, count(*) AS count FROM e q JOIN e d ON q.vec_id < d.vec_id GROUP BY 1""",
    "chart_points": "SELECT vec_id, round(CAST(embedding[1] AS DOUBLE), 4) + 0.0 AS x, round(CAST(embedding[2] AS DOUBLE), 4) + 0.0 AS y, CAST(label AS VARCHAR) AS value, CAST(dense_rank() OVER (ORDER BY CAST(label AS VARCHAR)) - 1 AS INT) AS number FROM embeddings",
    "label_numbers": "SELECT generation_model, CAST(row_number() OVER (ORDER BY generation_model) - 1 AS INT) AS number FROM (SELECT DISTINCT generation_model FROM qa_raw WHERE generation_model IS NOT NULL)",
}

"""Registered queries for clustering (K*) and cluster validity.

Bindings: ``embeddings`` (64-d unit vectors, 10 labels) - the labels serve as
a fixed clustering for the validity scores, so they have exact oracles; the
lineitem table grouped by line number gives the profile / naming oracles.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import cluster as K
from tessera.plans.catalog import LI_NUM, li, load, query, r6

EMB = "(SELECT vec_id AS id, label AS c, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"

SIL_CTE = f"""p AS {EMB},
pd AS (SELECT a.id, a.c AS ca, b.c AS cb, list_distance(a.v, b.v) ** 2 AS d2 FROM p a JOIN p b ON a.id <> b.id),
pm AS (SELECT id, ca, cb, sum(d2) AS s, count(*) AS n FROM pd GROUP BY ALL),
ab AS (SELECT id, max(CASE WHEN ca = cb THEN s / n END) AS a, min(CASE WHEN ca <> cb THEN s / n END) AS b
       FROM pm GROUP BY id),
sil AS (SELECT avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END) AS silhouette FROM ab)"""

CENT_CTE = """e AS (SELECT label AS c, vec_id AS id, unnest(CAST(embedding AS DOUBLE[])) AS x,
                  generate_subscripts(embedding, 1) AS i FROM embeddings),
cent AS (SELECT c, i, avg(x) AS m, count(*) AS n FROM e GROUP BY c, i),
gm AS (SELECT i, avg(x) AS m FROM e GROUP BY i),
rowd AS (SELECT e.c, e.id, sum((e.x - cent.m) * (e.x - cent.m)) AS dd FROM e JOIN cent ON e.c = cent.c AND e.i = cent.i
         GROUP BY e.c, e.id),
sc AS (SELECT c, avg(sqrt(dd)) AS s FROM rowd GROUP BY c),
cd AS (SELECT a.c AS ca, b.c AS cb, sqrt(sum((a.m - b.m) * (a.m - b.m))) AS dist FROM cent a JOIN cent b
       ON a.i = b.i AND a.c <> b.c GROUP BY 1, 2),
rr AS (SELECT ca, max((s1.s + s2.s) / dist) AS r FROM cd JOIN sc s1 ON s1.c = ca JOIN sc s2 ON s2.c = cb GROUP BY ca),
dbi AS (SELECT avg(r) AS dbi FROM rr),
bw AS (SELECT (SELECT sum(n * (cent.m - gm.m) * (cent.m - gm.m)) FROM cent JOIN gm ON cent.i = gm.i) AS B,
              (SELECT sum(dd) FROM rowd) AS W, (SELECT count(*) FROM embeddings) AS n,
              (SELECT count(DISTINCT label) FROM embeddings) AS k),
chi AS (SELECT (B / (k - 1)) / (W / (n - k)) AS chi, W FROM bw)"""


def emb(spark, sf):
    return load(spark, sf, "embeddings")


@query("m9_silhouette_sq_embeddings", f"WITH {SIL_CTE} SELECT round(silhouette, 6) AS silhouette FROM sil")
def q_m9(spark, sf):
    v = K.silhouette_sq(emb(spark, sf), "embedding", "label")
    return r6(spark.range(1).select(F.lit(v).cast("double").alias("silhouette")))


EUCLID_CTE = SIL_CTE.replace("list_distance(a.v, b.v) ** 2 AS d2", "list_distance(a.v, b.v) AS d2")


@query("m9_silhouette_euclidean_embeddings", f"WITH {EUCLID_CTE} SELECT round(silhouette, 6) AS silhouette FROM sil")
def q_m9_euclidean(spark, sf):
    v = K.silhouette(emb(spark, sf), "embedding", "label", mode="euclidean")
    return r6(spark.range(1).select(F.lit(v).cast("double").alias("silhouette")))


@query("m10_davies_bouldin_embeddings", f"WITH {CENT_CTE} SELECT round(dbi, 6) AS dbi FROM dbi")
def q_m10(spark, sf):
    v = K.davies_bouldin(emb(spark, sf), "embedding", "label")
    return r6(spark.range(1).select(F.lit(v).cast("double").alias("dbi")))


@query("m11_calinski_harabasz_embeddings", f"WITH {CENT_CTE} SELECT round(chi, 6) AS chi FROM chi")
def q_m11(spark, sf):
    v = K.calinski_harabasz(emb(spark, sf), "embedding", "label")
    return r6(spark.range(1).select(F.lit(v).cast("double").alias("chi")))


@query("m14_inertia_embeddings", f"WITH {CENT_CTE} SELECT round(W, 6) AS inertia FROM chi")
def q_m14(spark, sf):
    v = K.within_ss(emb(spark, sf), "embedding", "label")
    return r6(spark.range(1).select(F.lit(v).cast("double").alias("inertia")))


@query("m12_clustering_summary_embeddings", f"""WITH {SIL_CTE}, {CENT_CTE}
SELECT 'labels' AS Algorithm, CAST((SELECT count(DISTINCT label) FROM embeddings) AS INTEGER) AS N_clusters,
       round(silhouette, 6) AS Silhouette, round(dbi, 6) AS DBI, round(chi, 6) AS CHI,
       CAST(0 AS BIGINT) AS n_noise, CAST(NULL AS VARCHAR) AS error FROM sil, dbi, chi""")
def q_m12(spark, sf):
    return r6(K.clustering_summary(emb(spark, sf), "embedding", "label", "labels"))


@query("m12_clustering_summary_single_cluster", """
SELECT 'one' AS Algorithm, CAST(NULL AS INTEGER) AS N_clusters, CAST(NULL AS DOUBLE) AS Silhouette,
       CAST(NULL AS DOUBLE) AS DBI, CAST(NULL AS DOUBLE) AS CHI, CAST(0 AS BIGINT) AS n_noise,
       'not enough clusters' AS error""")
def q_m12b(spark, sf):
    e = emb(spark, sf).withColumn("one", F.lit(0))
    return K.clustering_summary(e, "embedding", "one", "one")


PROFILE_SQL = f"""p AS (SELECT l_linenumber % 3 AS cluster, CAST(l_linestatus = 'O' AS INTEGER) AS label2, *
      FROM lineitem),
prof AS (SELECT cluster, count(*) AS count, round(avg(label2), 3) AS target_rate,
                {', '.join(f'round(avg({c}), 3) AS {c}_mean' for c in LI_NUM)},
                round(avg(l_discount), 3) AS l_discount_rate FROM p GROUP BY cluster),
md AS (SELECT cluster, l_returnflag AS l_returnflag_mode FROM (
        SELECT cluster, l_returnflag, row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, l_returnflag) AS rn
        FROM p GROUP BY cluster, l_returnflag) WHERE rn = 1)"""


def _profile(spark, sf):
    d = li(spark, sf).withColumn("cluster", F.col("l_linenumber") % 3)
    return K.profile_clusters(d, "cluster", "label2", LI_NUM, rate_col="l_discount", mode_col="l_returnflag")


@query("k8_profile_clusters_lineitem", f"""WITH {PROFILE_SQL}
SELECT prof.*, md.l_returnflag_mode FROM prof JOIN md USING (cluster)""")
def q_k8(spark, sf):
    return _profile(spark, sf)


@query("k9_name_clusters_lineitem", f"""WITH {PROFILE_SQL}
SELECT cluster, (['low', 'medium', 'high'])[least(row_number() OVER (ORDER BY target_rate, cluster), 3)] AS risk
FROM prof""")
def q_k9(spark, sf):
    return K.name_clusters(_profile(spark, sf))


DB_EPS, DB_MIN = 1.17, 5


@query("k5_dbscan_embeddings", f"""
WITH RECURSIVE p AS {EMB},
e AS (SELECT a.id AS a, b.id AS b FROM p a JOIN p b ON list_distance(a.v, b.v) <= {DB_EPS}),
core AS (SELECT a AS id FROM e GROUP BY a HAVING count(*) >= {DB_MIN}),
ce AS (SELECT e.a, e.b FROM e JOIN core c1 ON e.a = c1.id JOIN core c2 ON e.b = c2.id),
r(id, lab) AS (SELECT id, id FROM core UNION SELECT ce.b, r.lab FROM r JOIN ce ON ce.a = r.id),
comp AS (SELECT id, min(lab) AS lab FROM r GROUP BY id),
num AS (SELECT lab, CAST(dense_rank() OVER (ORDER BY lab) - 1 AS INTEGER) AS cid FROM (SELECT DISTINCT lab FROM comp)),
cc AS (SELECT comp.id, num.cid FROM comp JOIN num USING (lab)),
bd AS (SELECT e.a AS id, min(cc.cid) AS cid FROM e JOIN cc ON e.b = cc.id WHERE e.a NOT IN (SELECT id FROM core)
       GROUP BY e.a)
SELECT p.id AS vec_id, CAST(coalesce(cc.cid, bd.cid, -1) AS INTEGER) AS cluster
FROM p LEFT JOIN cc ON p.id = cc.id LEFT JOIN bd ON p.id = bd.id""")
def q_k5(spark, sf):
    return K.dbscan(emb(spark, sf), "vec_id", "embedding", DB_EPS, DB_MIN)


# ---------------------------------------------------------- model-based (no SQL oracle)

@query("k2_kmeans_embeddings")
def q_k2(spark, sf):
    e = emb(spark, sf)
    m = K.fit_kmeans(e, "embedding", k=10, n_init=10)
    return K.kmeans_labels(m, e, "embedding", ["vec_id"])


@query("k0_k_selection_embeddings")
def q_k0(spark, sf):
    return K.k_selection(emb(spark, sf), "vec_id", "embedding", k_range=(2, 3, 4, 5, 6, 7), n_init=10)


@query("k6_pca_embeddings")
def q_k6(spark, sf):
    e = emb(spark, sf)
    return K.fit_pca(e, "embedding", 2).transform(e, "embedding", ["vec_id", "label"])


@query("k10_evaluate_kmeans_embeddings")
def q_k10(spark, sf):
    e = emb(spark, sf)
    m = K.fit_kmeans(e, "embedding", k=10, n_init=10)
    lab = K.kmeans_labels(m, e, "embedding", ["vec_id", "embedding"])
    return K.clustering_summary(lab, "embedding", "cluster", "KMeans")


@query("t7_profile_long_lineitem", f"""WITH {PROFILE_SQL}
SELECT cluster, 'count' AS metric, CAST(count AS DOUBLE) AS value FROM prof
UNION ALL SELECT cluster, 'target_rate', target_rate FROM prof
{''.join(f"UNION ALL SELECT cluster, '{c}_mean', {c}_mean FROM prof " for c in LI_NUM)}
UNION ALL SELECT cluster, 'l_discount_rate', l_discount_rate FROM prof""")
def q_t7b(spark, sf):
    from tessera.plans.report import profile_long
    return profile_long(_profile(spark, sf))


@query("t3_clustering_comparison_embeddings")
def q_t3(spark, sf):
    from tessera.plans.report import summarize_clustering
    e = emb(spark, sf)
    km = K.kmeans_labels(K.fit_kmeans(e, "embedding", k=10, n_init=10), e, "embedding", ["vec_id", "embedding"])
    db = K.dbscan(e, "vec_id", "embedding", DB_EPS, DB_MIN)
    return summarize_clustering([K.clustering_summary(km, "embedding", "cluster", "KMeans"),
                                 K.clustering_summary(e.join(db, "vec_id"), "embedding", "cluster", "DBSCAN")])


RADIUS_SQL = f"""
WITH p AS {EMB}
SELECT a.id AS id_a, b.id AS id_b, round(list_distance(a.v, b.v), 6) AS dist
FROM p a JOIN p b ON list_distance(a.v, b.v) <= 1.15"""

KNN_SQL = f"""
WITH p AS {EMB},
d AS (SELECT a.id AS id, b.id AS nbr_id, list_distance(a.v, b.v) AS dist FROM p a JOIN p b ON a.id <> b.id),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, nbr_id) AS rank FROM d)
SELECT id, nbr_id, round(dist, 6) AS dist, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5"""


def _radius(spark, sf, **kw):
    from tessera.operators.neighbors import radius_pairs
    return r6(radius_pairs(emb(spark, sf), "vec_id", "embedding", 1.15, **kw))


def _knn(spark, sf, **kw):
    from tessera.operators.neighbors import knn
    return r6(knn(emb(spark, sf), "vec_id", "embedding", 5, **kw).withColumn("rank", F.col("rank").cast("int")))


@query("k1_radius_pairs_embeddings", RADIUS_SQL)
def q_k1(spark, sf):
    return _radius(spark, sf)


@query("k1_knn_embeddings", KNN_SQL)
def q_k1b(spark, sf):
    return _knn(spark, sf)


@query("k1_radius_pairs_many_cells_embeddings", RADIUS_SQL)
def q_k1_cells(spark, sf):
    return _radius(spark, sf, cell_target=64)


@query("k1_knn_many_cells_embeddings", KNN_SQL)
def q_k1b_cells(spark, sf):
    return _knn(spark, sf, cell_target=64)


# Rows of label 0 count as noise and leave every score
def _clean_rows(cte):
    return cte.replace("FROM embeddings", "FROM (SELECT * FROM embeddings WHERE label <> 0)")


@query("k10_evaluate_with_noise_embeddings", f"""WITH {_clean_rows(SIL_CTE)}, {_clean_rows(CENT_CTE)}
SELECT 'labels' AS Algorithm, CAST((SELECT count(DISTINCT label) FROM embeddings WHERE label <> 0) AS INTEGER) AS N_clusters,
       round(silhouette, 6) AS Silhouette, round(dbi, 6) AS DBI, round(chi, 6) AS CHI,
       (SELECT count(*) FROM embeddings WHERE label = 0) AS n_noise, CAST(NULL AS VARCHAR) AS error FROM sil, dbi, chi""")
def q_k10_noise(spark, sf):
    e = emb(spark, sf).withColumn("cluster", F.when(F.col("label") == 0, -1).otherwise(F.col("label")))
    return r6(K.clustering_summary(e, "embedding", "cluster", "labels"))


# K6 / K7: all components together only turn the space, so every row keeps its distance from the mean
@query("k6_pca_all_components_embeddings", """
WITH e AS (SELECT vec_id, unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
m AS (SELECT i, avg(x) AS m FROM e GROUP BY i)
SELECT vec_id, round(sum((x - m) * (x - m)), 6) AS distance_sq FROM e JOIN m USING (i) GROUP BY vec_id""")
def q_k6_all(spark, sf):
    e = emb(spark, sf)
    width = len(e.select("embedding").first()[0])
    out = K.fit_pca(e, "embedding", width).transform(e, "embedding", ["vec_id"])
    total = sum((F.col(f"pc{k + 1}") * F.col(f"pc{k + 1}") for k in range(width)), F.lit(0.0))
    return r6(out.select("vec_id", total.alias("distance_sq")))

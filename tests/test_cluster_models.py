import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tessera import session
from tessera.operators import cluster as K
from tessera.operators import models as L
from tessera.operators import neighbors as N
from tessera.operators import sampling as S
from tessera.operators import semi as P
from tests.conftest import approx

H17 = [(0, [0.0], 0), (1, [1.0], 0), (2, [10.0], 1), (3, [11.0], 1)]


def test_h17_validity(spark):
    df = spark.createDataFrame(H17, "id int, x array<double>, c int")
    assert approx(K.davies_bouldin(df, "x", "c"), 0.1)
    assert approx(K.calinski_harabasz(df, "x", "c"), 200.0)
    assert approx(K.within_ss(df, "x", "c"), 1.0)
    # squared-Euclidean silhouette against brute force
    X = np.array([[0.0], [1.0], [10.0], [11.0]])
    lab = np.array([0, 0, 1, 1])
    D = ((X[:, None] - X[None]) ** 2).sum(-1)
    s = []
    for i in range(4):
        a = D[i, (lab == lab[i]) & (np.arange(4) != i)].mean()
        b = D[i, lab != lab[i]].mean()
        s.append((b - a) / max(a, b))
    assert approx(K.silhouette_sq(df, "x", "c"), float(np.mean(s)))


def test_silhouette_far_from_the_origin(spark):
    near = spark.createDataFrame(H17, "id int, x array<double>, c int")
    far = near.withColumn("x", F.transform("x", lambda v: v + 1e8))
    assert approx(K.silhouette_sq(far, "x", "c"), K.silhouette_sq(near, "x", "c"), 1e-12)


def test_equal_hash_keys_follow_the_id(spark):
    from tessera.functions.order_stats import ordered_cumsum
    df = spark.createDataFrame([(i, 7) for i in (5, 3, 9, 1)], "id int, k int").repartition(4)
    got = {r["id"]: r["row_in_group"] for r in ordered_cumsum(df, "k", [], tie="id").collect()}
    assert got == {1: 1, 3: 2, 5: 3, 9: 4}


def test_h18_all_noise_error_row(spark):
    df = spark.createDataFrame([(i, x, -1) for i, x, _ in H17], "id int, x array<double>, c int")
    r = K.clustering_summary(df, "x", "c", "DBSCAN").first()
    assert r["error"] and r["Silhouette"] is None and r["n_noise"] == 4


def test_h19_dbscan(spark):
    pts = [(i, [float(v)]) for i, v in enumerate([0, 1, 2, 3, 10])]
    df = spark.createDataFrame(pts, "id int, x array<double>")
    got = [r["cluster"] for r in K.dbscan(df, "id", "x", eps=1.0, min_samples=3).orderBy("id").collect()]
    assert got == [0, 0, 0, 0, -1]


def test_dbscan_copies_are_weighted(spark):
    pts = [(i, [0.0]) for i in range(5)] + [(9, [50.0])]
    df = spark.createDataFrame(pts, "id int, x array<double>")
    got = {r["id"]: r["cluster"] for r in K.dbscan(df, "id", "x", eps=0.5, min_samples=5).collect()}
    assert {got[i] for i in range(5)} == {0} and got[9] == -1


def test_h20_ward(spark):
    df = spark.createDataFrame([(0, [0.0]), (1, [1.0]), (2, [10.0])], "id int, x array<double>")
    labels, link, exact = K.fit_hac(df, "id", "x", k=2)
    rows = link.orderBy("distance").collect()
    assert exact and approx(rows[0]["distance"], 1.0) and approx(rows[1]["distance"], 10.969655, 1e-6)
    lab = {r["id"]: r["cluster"] for r in labels.collect()}
    assert lab[0] == lab[1] != lab[2]


def test_neighbors_exact_with_many_cells(spark):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(300, 5))
    df = spark.createDataFrame([(i, X[i].tolist()) for i in range(300)], "id int, v array<double>")
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    eps = float(np.quantile(D, 0.05))
    pairs = N.radius_pairs(df, "id", "v", eps, cell_target=20).collect()
    assert len(pairs) == int((D <= eps).sum())
    kn = N.knn(df, "id", "v", 4, cell_target=20).toPandas()
    for i in range(0, 300, 37):
        exp = set(np.argsort(D[i] + np.eye(300)[i] * 1e9, kind="stable")[:4])
        assert set(kn[kn.id == i].nbr_id) == exp


def test_tiles_bound_every_group(spark):
    """One pivot (one hot cell), tiny tiles: same pairs and neighbours, and no group exceeds two tiles."""
    rng = np.random.default_rng(5)
    X = rng.normal(size=(240, 3))
    df = spark.createDataFrame([(i, X[i].tolist()) for i in range(240)], "id int, v array<double>")
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    one = X[:1]
    got = {(r.id_a, r.id_b) for r in N.radius_pairs(df, "id", "v", 0.7, pivots=one, cell_target=16).collect()}
    assert got == {(i, j) for i, j in zip(*np.nonzero(D <= 0.7))}
    kn = N.knn(df, "id", "v", 3, pivots=one, cell_target=16).toPandas().sort_values(["id", "rank"])
    want = np.argsort(D + np.eye(240) * 1e9, axis=1, kind="stable")[:, :3]
    assert (kn.nbr_id.to_numpy().reshape(240, 3) == want).all()
    homes = df.select(F.col("id").cast("long").alias("_id"), F.col("v").alias("_v"), F.lit(0).alias("cell"))
    sizes = [r["count"] for r in N.tile_pairs(homes, homes, [], 16).groupBy("cell", "ht", "qt").count().collect()]
    assert len(sizes) == 15 * 15 and max(sizes) <= 4 * 16


def test_repeated_ids_keep_their_neighbours(spark):
    """Rows given twice: the pairs of an id with itself take no neighbour's place, in one block or several."""
    rng = np.random.default_rng(17)
    X = rng.normal(size=(60, 6))
    rows = [(i, X[i].tolist()) for i in range(60)]
    df = spark.createDataFrame(rows + rows[:20], "id int, v array<double>")
    want = N.knn(df, "id", "v", 4).toPandas().sort_values(["id", "rank"], ignore_index=True)     # one tile
    got = N.knn(df, "id", "v", 4, cell_target=5).toPandas().sort_values(["id", "rank"], ignore_index=True)
    assert len(got) == 60 * 4 and got.equals(want)


def test_copies_grow_with_tiles_not_with_cells(spark, monkeypatch):
    """Uniform rows, which no bound rules out: tiny cells are compared in blocks, and a row is copied once per block."""
    rng = np.random.default_rng(15)
    X = rng.normal(size=(400, 24))
    df = spark.createDataFrame([(i, X[i].tolist()) for i in range(400)], "id int, v array<double>")
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    eps = float(np.quantile(D, 0.05))
    copies, real = [], N.tile_pairs
    monkeypatch.setattr(N, "DEFAULT_CELL_TARGET", 100)
    monkeypatch.setattr(N, "tile_pairs", lambda *a: copies.append(real(*a).count()) or real(*a))
    got = {(r.id_a, r.id_b) for r in N.radius_pairs(df, "id", "v", eps, cell_target=5).collect()}
    assert got == {(i, j) for i, j in zip(*np.nonzero(D <= eps))}
    kn = N.knn(df, "id", "v", 4, cell_target=5).toPandas().sort_values(["id", "rank"])
    assert (kn.nbr_id.to_numpy().reshape(400, 4) == np.argsort(D + np.eye(400) * 1e9, axis=1, kind="stable")[:, :4]).all()
    assert len(copies) == 3 and max(copies) <= 400 * 2 * 8        # 20 cells of 20 rows in at most 8 blocks


def test_neighbors_far_from_the_origin(spark):
    """Distances come from differences, so a shift of 1e7 changes no neighbour."""
    rng = np.random.default_rng(6)
    X = np.round(rng.normal(size=(150, 4)) * 64) / 64 + 2.0 ** 23
    df = spark.createDataFrame([(i, X[i].tolist()) for i in range(150)], "id int, v array<double>")
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    kn = N.knn(df, "id", "v", 3, cell_target=40).toPandas().sort_values(["id", "rank"])
    want = np.array([np.lexsort((np.arange(150), D[i] + np.eye(150)[i] * 1e9))[:3] for i in range(150)])
    assert (kn.nbr_id.to_numpy().reshape(150, 3) == want).all()
    assert N.radius_pairs(df, "id", "v", 0.5, cell_target=40).count() == int((D <= 0.5).sum())


def test_neighbors_of_an_empty_table(spark):
    df = spark.createDataFrame([], "id int, v array<double>")
    assert N.radius_pairs(df, "id", "v", 1.0).count() == 0 and N.knn(df, "id", "v", 2).count() == 0


def test_kmeans_invariants_and_pca(spark):
    rng = np.random.default_rng(4)
    X = np.vstack([rng.normal(0, 0.1, (30, 2)), rng.normal(5, 0.1, (30, 2))])
    df = spark.createDataFrame([(i, X[i].tolist()) for i in range(60)], "id int, v array<double>")
    m = K.fit_kmeans(df, "v", k=2, n_init=2)
    lab = K.kmeans_labels(m, df, "v", ["id", "v"]).toPandas()
    cents = np.array([np.asarray(c) for c in m.clusterCenters()])
    for _, r in lab.iterrows():
        d = ((cents - np.array(r["v"])) ** 2).sum(1)
        assert int(np.argmin(d)) == r["cluster"]
    pca = K.fit_pca(df, "v", 2)
    proj = pca.transform(df, "v", ["id"]).toPandas()
    assert abs(proj["pc1"].mean()) < 1e-9 and abs(proj["pc2"].mean()) < 1e-9  # centred


def test_kmeans_runs_share_their_passes(spark, monkeypatch):
    """Four runs of two k: the best of Spark's own runs per k, in as many passes as the longest run has rounds."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    rng = np.random.default_rng(14)
    X = np.vstack([rng.normal(c, 0.6, (60, 3)) for c in (0, 3, 7)])
    df = spark.createDataFrame([(i, X[i].tolist()) for i in range(len(X))], "id int, v array<double>").repartition(3)
    passes, real = [], K._lloyd_pass
    monkeypatch.setattr(K, "_lloyd_pass", lambda *a: passes.append(len(a[1])) or real(*a))
    got = K.fit_kmeans_of(df, "v", (2, 3), n_init=2, seed=5)
    data = df.select(array_to_vector("v").alias("f"))
    own = {k: [KMeans(k=k, seed=5 + i, maxIter=300, tol=1e-4, featuresCol="f").fit(data) for i in range(2)] for k in (2, 3)}
    assert passes[0] == 4 and len(passes) == max(m.summary.numIter for ms in own.values() for m in ms)
    for k, ms in own.items():
        best = min(ms, key=lambda m: m.summary.trainingCost)
        assert abs(got[k].cost - best.summary.trainingCost) < 1e-6 * best.summary.trainingCost
        assert np.allclose(np.sort(got[k].centres, axis=0), np.sort(np.array(best.clusterCenters()), axis=0), atol=1e-6)
    monkeypatch.setattr(K, "DRIVER_BYTES", 0)                      # sums added up by tasks first
    assert np.allclose(np.sort(K.fit_kmeans(df, "v", 3, 2, 5).centres, axis=0), np.sort(got[3].centres, axis=0), atol=1e-6)


def test_profile_and_names(spark):
    df = spark.createDataFrame([(0, 1, 2.0, 1), (0, 0, 4.0, 1), (1, 1, 6.0, 2), (2, 0, 1.0, 3)],
                               "cluster int, target int, x double, cp int")
    prof = K.profile_clusters(df, "cluster", "target", ["x"], mode_col="cp")
    p0 = prof.filter("cluster = 0").first()
    assert p0["count"] == 2 and p0["target_rate"] == 0.5 and p0["x_mean"] == 3.0 and p0["cp_mode"] == 1
    prof2 = spark.createDataFrame([(0, .767), (1, 1.586), (2, .349)], "cluster int, target_rate double")
    names = {r["cluster"]: r["risk"] for r in K.name_clusters(prof2).collect()}
    assert names == {2: "low", 0: "medium", 1: "high"}


def test_splits_folds_partial(spark):
    pdf = pd.DataFrame({"id": range(1000), "y": [i % 3 for i in range(1000)]})
    df = spark.createDataFrame(pdf)
    sp = S.stratified_split(df, "id", "y", 0.2).groupBy("y").agg(F.sum(F.col("is_test").cast("int")).alias("t"))
    assert {r["y"]: r["t"] for r in sp.collect()} == {0: 67, 1: 67, 2: 67}
    fo = S.stratified_folds(df, "id", "y", 5).groupBy("y", "fold").count().toPandas()
    assert fo.groupby("y")["count"].agg(lambda s: s.max() - s.min()).max() <= 1
    n = lambda r: S.partial_labels(spark.createDataFrame(pdf.head(667)), "id", "y", r).filter("is_labeled").count()
    assert [n(r) for r in (0.05, 0.10, 0.20, 0.30)] == [33, 66, 133, 200]  # H22
    assert S.partial_labels(spark.createDataFrame(pdf.head(5)), "id", "y", 0.05).filter("is_labeled").count() == 2


def _toy(spark, n0=40, n1=12, seed=5):
    rng = np.random.default_rng(seed)
    rows = [(i, Vectors.dense(rng.normal(0, 1, 3).tolist()), 0.0) for i in range(n0)]
    rows += [(n0 + i, Vectors.dense(rng.normal(2, 1, 3).tolist()), 1.0) for i in range(n1)]
    return spark.createDataFrame(rows, ["id", "features", "label"])


def test_smote_invariants(spark):
    df = _toy(spark)
    out = L.smote(df, "id").toPandas()
    assert (out.groupby("label").size() == 40).all()
    base = {r.id: np.array(r.features) for r in df.collect()}
    minority = np.array([v for i, v in base.items() if i >= 40])
    for _, r in out[out.synthetic].iterrows():
        x = np.array(r["features"])
        b = base[r["id"]]
        # on a segment from its base row to some minority row
        ok = any(np.allclose(np.cross(np.vstack([x - b, m - b])[:, :3][0], (m - b)), 0, atol=1e-8)
                 and np.dot(x - b, m - b) >= -1e-12 for m in minority)
        assert ok
    with pytest.raises(ValueError):
        L.smote(_toy(spark, 40, 5), "id")  # H27: 5 rows or fewer is an error


def test_smote_of_many_rows_broadcasts_no_rows(spark, monkeypatch):
    df = _toy(spark)
    few = L.smote(df, "id")
    monkeypatch.setattr(session, "BROADCAST_ROWS", 10)
    many = L.smote(df, "id")
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") >= 2                             # rows with their neighbours, then with the neighbours' vectors
    def rows(d):
        return sorted((r["id"], r["label"], r["synthetic"], tuple(r["features"])) for r in d.collect())
    assert rows(many) == rows(few)


def test_neighbour_radii_of_many_rows_are_not_broadcast(spark, monkeypatch):
    g = np.random.default_rng(5)
    df = spark.createDataFrame([(i, g.normal(size=2).tolist()) for i in range(400)], "id long, v array<double>")
    monkeypatch.setattr(N, "DEFAULT_CELL_TARGET", 40)                   # several blocks of cells
    few = sorted(map(tuple, N.knn(df, "id", "v", 3, cell_target=40).select("id", "rank", "nbr_id").collect()))
    hints = []
    join = session.join_rows
    monkeypatch.setattr(session, "BROADCAST_ROWS", 100)
    monkeypatch.setattr(N, "join_rows", lambda *a: hints.append(a[3]) or join(*a))
    assert sorted(map(tuple, N.knn(df, "id", "v", 3, cell_target=40).select("id", "rank", "nbr_id").collect())) == few
    assert hints == [400]


def test_balanced_weights_send_the_classes_not_the_rows(spark):
    rows = spark.range(5000).selectExpr("cast(id % 3 = 0 as double) as label").checkpoint()
    w = S.balanced_weights(rows, "label")
    joins = [x for x in w._jdf.queryExecution().executedPlan().toString().split("\n") if "BroadcastHashJoin" in x]
    assert len(joins) == 1 and "BuildRight" in joins[0]
    got = {r["label"]: (r["w"], r["n"]) for r in w.groupBy("label").agg(F.max("weight").alias("w"), F.count("*").alias("n")).collect()}
    assert got == {1.0: (pytest.approx(5000 / (2 * 1667)), 1667), 0.0: (pytest.approx(5000 / (2 * 3333)), 3333)}


def test_training_rows_are_made_once(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    def note(x):
        seen.add(1)
        return x
    monkeypatch.setattr(L, "smote", lambda df, id_col: df.withColumn("id", F.udf(note, "long")("id")))
    df = _toy(spark)
    assert L.smote_rows(df, "id").count() == df.count() == seen.value
    seen.value = 0
    L.ModelRegistry().train_final(df, "Logistic Regression", id_col="id")
    assert seen.value == df.count()


def test_document_statistics_parse_the_texts_once(spark, monkeypatch, tmp_path):
    from tessera.plans import q_models as Q
    spark.createDataFrame([(i, f"w{i} b!\nc", 7) for i in range(12)], "doc_id long, text string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    plans, scale = [], Q.C.scale
    monkeypatch.setattr(Q.C, "scale", lambda d, *a: plans.append(d._jdf.queryExecution().executedPlan().toString()) or scale(d, *a))
    assert Q.doc_stats(spark, str(tmp_path)).count() == 12
    assert "split" not in plans[0] and "Scan ExistingRDD" in plans[0]


def test_models_fit_predict(spark):
    df = _toy(spark)
    for m in (L.fit_logistic(df), L.fit_random_forest(df, n_trees=10), L.fit_boosted_trees(df, n_rounds=5),
              L.fit_rbf_svm(df, n_components=20)):
        p = m.transform(df).select("prediction", "probability").collect()
        assert len(p) == 52 and all(abs(sum(r["probability"]) - 1) < 1e-6 for r in p)
    three = df.withColumn("label", F.when(F.col("id") % 3 == 0, 2.0).otherwise(F.col("label")))
    p = L.fit_boosted_trees(three, n_rounds=3).transform(three).select("probability").collect()
    assert all(len(r[0]) == 3 and abs(sum(r[0]) - 1) < 1e-6 for r in p)


def _two_classes(spark, n):
    x = F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(1000)) / 1000.0
    y = F.pmod(F.xxhash64(F.lit(8), "id"), F.lit(1000)) / 1000.0
    return spark.range(n).select("id", array_to_vector(F.array(x, y)).alias("features"), (x + y * y > 0.8).cast("double").alias("label"))


def test_forest_rows_are_dealt_over_the_cores(spark, monkeypatch):
    """a training set of some thousand rows was one task, on which every level walked all trees from the root."""
    seen = {}
    whole = L.RandomForestClassifier.fit

    def fit(self, d):
        seen["rows"], seen["ids"] = [n for n in d.rdd.glom().map(len).collect() if n], self.getCacheNodeIds()
        return whole(self, d)
    monkeypatch.setattr(L.RandomForestClassifier, "fit", fit)
    m = L.fit_random_forest(_two_classes(spark, 9_000), n_trees=5, max_depth=30)
    assert len(seen["rows"]) == 4 and sum(seen["rows"]) == 9_000 and max(seen["rows"]) < 3_000 and seen["ids"]
    right = m.transform(_two_classes(spark, 9_000)).filter("label = prediction").count()
    assert right > 8_800
    L.fit_random_forest(_two_classes(spark, 900), n_trees=5)
    assert seen["rows"] == [900]                                   # small sets stay one task


def test_tuning_runs_points_beside_each_other(spark, monkeypatch):
    """a point waited for all folds of the one before; with two folds no more than two fits ran at a time."""
    import threading
    meet, lock, fits = threading.Barrier(4, timeout=120), threading.Lock(), []

    class Fixed:
        def __init__(self, depth):
            self.depth = depth

        def transform(self, df):
            p = F.when(F.lit(self.depth == 10), F.col("label") * 0.8 + 0.1).otherwise(0.5)
            return df.withColumn("probability", F.array(1 - p, p)).withColumn("prediction", (p > 0.5).cast("double"))

    def fit(d, n_trees, max_depth, min_instances):
        with lock:
            fits.append((n_trees, max_depth, min_instances, d.count()))
            n = len(fits)
        if n <= 4:
            meet.wait()
        return Fixed(max_depth)
    monkeypatch.setattr(L, "fit_random_forest", fit)
    d = S.stratified_folds(_two_classes(spark, 400), "id", "label", 2)
    best, table, _ = L.tune(d, "Random Forest", k=2, parallelism=4)
    assert len(fits) == 12 * 2 + 1 and best["max_depth"] == 10     # every point on every fold, and the refit
    rows = [(r["params"], r["mean_average_precision"]) for r in table.collect()]
    assert len(rows) == 12 and all((abs(v - 1.0) < 1e-9) == ("'max_depth': 10" in p) for p, v in rows)


def test_boosted_trees_on_cells_equal_spark_on_rows(spark, monkeypatch):
    """900 rows that share 120 cells: the fit sees cells only and predicts what Spark's own fit on the rows does."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.regression import GBTRegressor
    rng = np.random.default_rng(16)
    X = np.column_stack([rng.integers(0, 10, 900) / 4, rng.integers(0, 6, 900)]).astype(float)
    df = spark.createDataFrame([(i, X[i].tolist(), float(X[i, 0] * X[i, 1] > 3 + rng.normal())) for i in range(900)], "id int, v array<double>, label double")
    df = df.withColumn("features", array_to_vector("v")).drop("v").coalesce(1).cache()
    trained, real = [], L._cells
    monkeypatch.setattr(L, "_cells", lambda *a, **k: trained.append(real(*a, **k)) or trained[-1])
    ours = [r["probability"] for r in L.fit_boosted_trees(df, n_rounds=4).transform(df).orderBy("id").collect()]
    spark_own = GBTClassifier(maxIter=4, maxDepth=5, stepSize=0.1, seed=42).fit(df).transform(df).orderBy("id").collect()
    assert np.allclose(ours, [r["probability"].toArray() for r in spark_own], atol=1e-9)
    y = df.withColumn("label", F.col("label") * 3 + F.col("id") % 7)
    model = L.fit_gbt_regressor(y, n_rounds=3)
    own = GBTRegressor(maxIter=3, maxDepth=5, stepSize=0.1, seed=42).fit(y).transform(y).orderBy("id").collect()
    assert np.allclose([r["prediction"] for r in model.transform(y).orderBy("id").collect()], [r["prediction"] for r in own], atol=1e-9)
    assert [c.count() <= 120 for c in trained] == [True, True] and trained[1].agg(F.sum("_n")).first()[0] == 900
    monkeypatch.setattr(L, "EXACT_ROWS", 500)                       # thresholds of a large table
    assert len(L.fit_bins(df).getOrDefault("thresholds")) == 9 + 5


def test_save_load_same_predictions(spark, tmp_path):
    from pyspark.ml.classification import RandomForestClassificationModel
    df = _toy(spark)
    m = L.fit_random_forest(df, n_trees=5, balanced=False)
    L.save_model(m, str(tmp_path / "rf"))
    m2 = L.load_model(RandomForestClassificationModel, str(tmp_path / "rf"), "rf")
    a = [r["prediction"] for r in m.transform(df).orderBy("id").collect()]
    b = [r["prediction"] for r in m2.transform(df).orderBy("id").collect()]
    assert a == b


def test_self_training_invariants(spark):
    df = _toy(spark).withColumn("partial_label", F.when(F.col("id") % 4 == 0, F.col("label").cast("int"))
                                .otherwise(F.lit(-1)))
    model, pseudo = P.self_training(df, lambda d: L.fit_random_forest(d, n_trees=10), threshold=0.85, max_iter=3)
    ps = {r["id"]: (r["pseudo_label"], r["labeled_iter"]) for r in pseudo.collect()}
    for r in df.collect():
        if r["partial_label"] != -1:
            assert ps[r["id"]] == (r["partial_label"], 0)  # given labels never change
    risk = P.self_training_risk(df, "label", base_fit=lambda d: L.fit_random_forest(d, n_trees=10), max_iter=3).first()
    assert risk["n_unlabeled"] == df.filter("partial_label = -1").count()
    assert risk["n_pseudo_labeled"] == sum(it > 0 for _, it in ps.values())
    whole = L.full_evaluation(model, df, "m")
    assert whole["confusion"].count() == 2 and whole["summary"].first()["Model"] == "m"
    assert {"accuracy", "macro avg", "weighted avg"} < {r["class"] for r in whole["report"].collect()}


def test_svm_rows_are_lifted_by_all_cores(spark, monkeypatch):
    from pyspark.ml.classification import LinearSVC
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 3))
    df = spark.createDataFrame([(Vectors.dense(r), float(r[0] * r[1] > 0)) for r in x.tolist()], ["features", "label"])
    monkeypatch.setattr(L, "SVM_ROWS", 100)
    lifts, spread, fit = [], L.spread, LinearSVC._fit
    monkeypatch.setattr(L, "spread", lambda *a: lifts.append(spread(*a)) or lifts[-1])
    fits = []
    monkeypatch.setattr(LinearSVC, "_fit", lambda self, d: fits.append(d.rdd.getNumPartitions()) or fit(self, d))
    L.fit_rbf_svm(df, n_components=20, max_iter=3)
    assert [d.rdd.getNumPartitions() for d in lifts] == [4] and fits == [1]      # local[4]


def test_random_features_are_those_of_the_formula(spark):
    from tessera.operators.ml_stages import RandomFeatures
    lift = RandomFeatures.rbf(3, 0.5, 7, 11)
    x = np.random.default_rng(2).normal(size=(50, 3))
    df = spark.createDataFrame([(i, Vectors.dense(r)) for i, r in enumerate(x.tolist())], ["id", "features"])
    got = lift.transform(df)
    assert got.schema["_rff"].dataType == df.schema["features"].dataType
    w, b = np.array(lift.getOrDefault(lift.weights)).reshape(7, 3), np.array(lift.getOrDefault(lift.offsets))
    assert np.allclose([r["_rff"].toArray() for r in got.orderBy("id").collect()], np.sqrt(2 / 7) * np.cos(x @ w.T + b), atol=1e-12)
    assert lift.transform(df.filter("id < 0")).collect() == []


def test_self_training_does_not_fit_the_same_rows_twice(spark):
    rows = [(i, Vectors.dense([float(i % 2), float(i)]), i % 2 if i < 20 else -1) for i in range(40)]
    df = spark.createDataFrame(rows, ["id", "features", "partial_label"])
    fits = []

    def fit(d):
        fits.append(d.count())
        return L.fit_logistic(d)
    model, pseudo = P.self_training(df, fit, threshold=1.0)      # no row is that sure: the first model is the last
    assert fits == [20] and model is not None and pseudo.filter("pseudo_label = -1").count() == 20


def test_h24_pseudo_label_risk(spark):
    df = spark.createDataFrame(list(zip([-1, -1, -1, 1], [-1, 0, 1, 1], [1, 0, 0, 1])), "p int, s int, t int")
    r = P.pseudo_label_risk(df, "p", "s", "t").first()
    assert (r["n_unlabeled"], r["n_pseudo_labeled"], r["n_wrong_pseudo"]) == (3, 2, 2)
    assert approx(r["error_rate"], 2 / 3) and r["n_wrong_among_pseudo"] == 1


def test_label_spreading_recovers_two_blobs(spark):
    rng = np.random.default_rng(6)
    X = np.vstack([rng.normal(0, 0.05, (20, 2)), rng.normal(1, 0.05, (20, 2))])
    rows = [(i, X[i].tolist(), (0 if i < 20 else 1) if i in (0, 20) else -1) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, features array<double>, partial_label int")
    for method in ("spreading", "propagation"):
        out = {r["id"]: r["prediction"] for r in P.label_graph_fit(df, "id", method=method, gamma=20.0).collect()}
        assert all(out[i] == (0.0 if i < 20 else 1.0) for i in range(40))


def test_label_graph_reaches_every_row_and_new_rows(spark):
    # row 4 has no neighbour within the graph's radius (1.18 at gamma 20): its nearest labelled row is 2
    rows = [(0, [0.0, 0.0], 0), (1, [0.1, 0.0], -1), (2, [3.0, 0.0], 1), (3, [3.1, 0.0], -1), (4, [9.0, 0.0], -1)]
    df = spark.createDataFrame(rows, "id int, features array<double>, partial_label int")
    new = spark.createDataFrame([(10, [0.05, 0.0]), (11, [3.05, 0.0]), (12, [50.0, 0.0])], "id int, features array<double>")
    for method in ("spreading", "propagation"):
        fit = P.label_graph_fit(df, "id", method=method, gamma=20.0, cell_target=2)
        assert {r["id"]: r["prediction"] for r in fit.collect()} == {0: 0.0, 1: 0.0, 2: 1.0, 3: 1.0, 4: 1.0}
        got = P.label_graph_predict(fit, df, new, [0, 1], gamma=20.0, cell_target=2)
        assert {r["id"]: r["prediction"] for r in got.collect()} == {10: 0.0, 11: 1.0, 12: 1.0}


def test_neighbours_of_other_rows_match_brute_force(spark):
    rng = np.random.default_rng(8)
    H, Q = rng.normal(0, 1, (80, 3)), rng.normal(0, 2, (30, 3))
    home = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(H)], "id long, v array<double>")
    ask = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(Q)], "id long, v array<double>")
    d = np.sqrt(((Q[:, None] - H[None]) ** 2).sum(2))
    near = {(r["id"], r["rank"]): r["nbr_id"] for r in N.knn(home, "id", "v", 3, cell_target=10, queries=ask).collect()}
    assert near == {(i, k + 1): int(j) for i in range(30) for k, j in enumerate(np.argsort(d[i], kind="stable")[:3])}
    within = {(r["id_a"], r["id_b"]) for r in N.radius_pairs(home, "id", "v", 1.0, cell_target=10, queries=ask).collect()}
    assert within == {(int(a), int(b)) for a, b in zip(*np.nonzero(d <= 1.0))}


def test_semi_supervised_results_table(spark):
    p = spark.createDataFrame([(1.0, 1.0, [0.1, 0.9]), (0.0, 0.0, [0.8, 0.2]), (1.0, 0.0, [0.6, 0.4]), (0.0, 0.0, [0.7, 0.3])],
                              "label double, prediction double, probability array<double>")
    r = P.results_table({"A": p}, spark).first()
    assert r["Model"] == "A" and approx(r["F1"], 2 / 3) and approx(r["ROC_AUC"], 1.0) and approx(r["PR_AUC"], 1.0)
    assert callable(P.base_learner("RF")) and callable(P.base_learner("unknown"))


def clustered(seed, n=4000, k=25, dim=6):
    rng = np.random.default_rng(seed)
    mid = rng.normal(size=(k, dim)) * 20
    return mid[rng.integers(k, size=n)] + rng.normal(size=(n, dim)) * 0.3


@pytest.mark.parametrize("dim,spread", [(2, 0.0), (5, 0.0), (5, 1e7), (8, 0.0)])
def test_tree_never_rules_out_a_cell_that_holds_a_neighbour(dim, spread):
    from tessera.operators.pivot_tree import PivotTree, rounding
    rng = np.random.default_rng(dim)
    X = np.concatenate([clustered(dim, 600, 8, dim), rng.normal(size=(200, dim)) * 25, np.zeros((50, dim))]) + spread
    tree = PivotTree.fit(X[::2], 40)
    cell, node, leaf, top = tree.assign(X)
    tree.max_norm = max(tree.max_norm, float(((X - tree.origin) ** 2).sum(1).max()))
    err = float(rounding(dim, tree.max_norm, tree.max_norm))
    for c in range(tree.n_cells):
        mine = leaf[cell == c]
        tree.cell_lo[c] = np.sqrt(max(mine.min() - err, 0)) if len(mine) else np.inf
        tree.cell_hi[c] = np.sqrt(mine.max() + err) if len(mine) else -np.inf
    for t in range(len(tree.tops)):
        tree.top_hi[t] = np.sqrt(top[node == t].max() + err) if (node == t).any() else -np.inf
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    for r in (0.0, 0.5, 3.0, np.inf):
        row, probed = tree.probe(X, np.full(len(X), r))
        seen = np.zeros((len(X), tree.n_cells), bool)
        seen[row, probed] = True
        a, b = np.nonzero(D <= r)
        assert seen[a, cell[b]].all()
        if r == 0.5:
            assert len(row) < len(X) * tree.n_cells / 2


def test_pivot_tree_copies_stay_few_on_clustered_rows(spark):
    """The price of the search: cells a row is copied to (printed), far below the number of cells."""
    from tessera.operators import pivot_tree as PT
    X = clustered(1)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(X)], "_id long, _v array<double>")
    tree = N.fit_tree(df, len(X), 64)
    homes = N.assign_homes(df, tree)
    copies = PT.copies_per_row(homes.select("_id", "_v"), "_v", tree, 0.5)
    print(f"{tree.n_cells} cells, {copies:.2f} copies per row")
    assert tree.n_cells > 30 and copies < tree.n_cells / 5
    D = ((X[:, None] - X[None]) ** 2).sum(-1)
    assert N.radius_pairs(df, "_id", "_v", 0.5, cell_target=64).count() == int((np.sqrt(D) <= 0.5).sum())


def test_pivot_tree_sample_is_bounded_and_repeats(spark):
    from tessera.operators import pivot_tree as PT
    df = spark.range(20_000).select(F.col("id").alias("_id"), F.array(F.rand(3), F.rand(4)).alias("_v"))
    a, b = (PT.sample_rows(d, "_id", "_v", 20_000, 2, max_bytes=16 * 1000) for d in (df, df.repartition(7, "_id")))
    assert 700 < len(a) <= 1000 and len(a) == len(b)


def test_neighbors_of_equal_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(60)] + [(99, None)], "id int, v array<double>")
    kn = N.knn(df, "id", "v", 2, cell_target=10).collect()
    assert {(r["id"], r["rank"]): r["nbr_id"] for r in kn if r["id"] in (0, 5)} == {(0, 1): 1, (0, 2): 2, (5, 1): 0, (5, 2): 1}
    assert N.radius_pairs(df, "id", "v", 0.0, cell_target=10).count() == 3600
    empty = df.filter("id < 0")
    assert N.knn(empty, "id", "v", 2).count() == 0 and N.radius_pairs(empty, "id", "v", 1.0).count() == 0


def _same_predictions(a, b, df):
    want = [(r["prediction"], r["probability"]) for r in a.transform(df).orderBy("id").collect()]
    got = [(r["prediction"], r["probability"]) for r in b.transform(df).orderBy("id").collect()]
    return got == want and len(got) == df.count()


def test_composed_models_predict_the_same_after_reload(spark, tmp_path):
    df = _toy(spark)
    three = df.withColumn("label", F.when(F.col("id") % 3 == 0, 2.0).otherwise(F.col("label")))
    fits = {"svm": (L.fit_rbf_svm(df, n_components=20), df), "gbt3": (L.fit_boosted_trees(three, n_rounds=2), three),
            "forest": (L.fit_random_forest(df, n_trees=5), df)}
    for name, (m, d) in fits.items():
        L.save_fitted(m, f"{tmp_path}/{name}")
        again = L.load_fitted(spark, f"{tmp_path}/{name}")
        assert (again.name, again.classes) == (m.name, m.classes) and _same_predictions(m, again, d), name
    forest = fits["forest"][0]
    assert (L.load_fitted(spark, f"{tmp_path}/forest").feature_importances() == forest.feature_importances()).all()
    with pytest.raises(ValueError):
        L.save_model(fits["gbt3"][0], f"{tmp_path}/single")


def test_cleaner_saved_beside_its_model(spark, tmp_path):
    from tessera.operators import clean as C
    rows = [(i, float(i % 7) if i % 5 else None, ["a", "b", None, "c"][i % 4], i % 3) for i in range(60)]
    raw = spark.createDataFrame(rows, "id int, v double, c string, k int")
    out, cleaner = C.fit_transform(raw, ["v"], ["c", "k"], {"v": 0.0, "k": [2]}, outliers="none")
    m = L.fit_logistic(_toy(spark))
    L.save_fitted(m, f"{tmp_path}/m", cleaner)
    again = L.load_cleaner(f"{tmp_path}/m")
    assert again.feature_names() == cleaner.feature_names() and again.scaler == cleaner.scaler
    new = raw.unionByName(spark.createDataFrame([(99, 3.0, "unseen", 1)], raw.schema))
    assert sorted(map(tuple, again.transform(new).collect())) == sorted(map(tuple, cleaner.transform(new).collect()))
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import VectorAssembler
    from tessera.operators.ml_stages import FittedCleaner
    pipe = PipelineModel([FittedCleaner(cleaner), VectorAssembler(inputCols=cleaner.feature_names(), outputCol="features")])
    pipe.write().overwrite().save(f"{tmp_path}/pipe")
    a, b = (p.transform(new).orderBy("id").collect() for p in (pipe, PipelineModel.load(f"{tmp_path}/pipe")))
    assert [r["features"] for r in a] == [r["features"] for r in b]
    _, strange = C.fit_transform(raw, ["v"], [], {"v": lambda x: x < 0}, outliers="none")
    with pytest.raises(ValueError):
        FittedCleaner(strange).write().overwrite().save(f"{tmp_path}/strange")


def brute_silhouette(X, lab, power):
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1)) ** power
    s = []
    for i in range(len(X)):
        mine = (lab == lab[i]) & (np.arange(len(X)) != i)
        b = min(D[i, lab == c].mean() for c in set(lab) if c != lab[i])
        a = D[i, mine].mean() if mine.any() else None
        s.append(0.0 if a is None or max(a, b) == 0 else (b - a) / max(a, b))
    return float(np.mean(s))


def test_validity_against_brute_force(spark, monkeypatch):
    """Both silhouettes, by broadcast and by tiles, with noise, a singleton and equal rows."""
    rng = np.random.default_rng(2)
    X = np.round(rng.normal(size=(90, 3)) * 4) / 4 + rng.integers(3, size=90)[:, None] * 2
    lab = np.concatenate([rng.integers(0, 4, size=80), [7], [-1] * 9])
    df = spark.createDataFrame([(i, X[i].tolist(), int(lab[i])) for i in range(90)], "id int, x array<double>, c int").repartition(3)
    keep = lab >= 0
    want = [brute_silhouette(X[keep], lab[keep], p) for p in (2, 1)]
    assert approx(K.silhouette_sq(df, "x", "c"), want[0], 1e-9) and approx(K.silhouette(df, "x", "c", "euclidean"), want[1], 1e-9)
    dbi = K.davies_bouldin(df, "x", "c")
    real = K.compare_tiles
    monkeypatch.setattr(K, "compare_tiles", lambda *a: real(*a, tile_rows=7))
    assert approx(K.silhouette_sq(df, "x", "c", centre_bytes=0), want[0], 1e-9)
    assert approx(K.silhouette(df, "x", "c", "euclidean"), want[1], 1e-9) and approx(K.davies_bouldin(df, "x", "c"), dbi, 1e-12)


def test_validity_of_20000_clusters(spark):
    """Clusters of two rows 2 apart, on a line, 10 apart: all scores are known, none needs a literal per cluster."""
    k = 20_000
    df = spark.range(2 * k).select(F.floor(F.col("id") / 2).cast("int").alias("c"),
                                   F.array(F.floor(F.col("id") / 2) * 10.0 + (F.col("id") % 2) * 2.0 - 1.0).alias("x"))
    stats = K.cluster_stats(df, "x", "c")
    assert stats.count() == k and K.within_ss(df, "x", "c", stats=stats) == 2.0 * k
    assert approx(K.davies_bouldin(df, "x", "c", stats), 0.2, 1e-9)
    inner, outer = (82 - 4) / 82, (122 - 4) / 122
    assert approx(K.silhouette_sq(df, "x", "c", stats), ((2 * k - 2) * inner + 2 * outer) / (2 * k), 1e-6)
    pos = np.arange(k) * 10.0
    assert approx(K.calinski_harabasz(df, "x", "c", stats), (2 * ((pos - pos.mean()) ** 2).sum() / (k - 1)) / (2.0 * k / k), 1e-9)


def test_learning_curve_leaves_out_ratios_of_one_class(spark):
    """The rows labelled at 30 % are all of class 0."""
    df = _toy(spark)
    out = P.learning_curve(df, df, "id", lambda d: L.fit_random_forest(d, n_trees=3), ratios=(0.3, 0.6), max_iter=1).collect()
    assert [(r["label_ratio"], r["n_labeled"]) for r in out] == [("60%", 31)]


def test_components_of_a_long_chain_and_a_hub(spark):
    from tessera.operators.components import connected_components
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(7, i) for i in range(200, 300)] + [(5, 7)]
    v = spark.createDataFrame([(i,) for i in [1, 5, 7, *range(100, 161), *range(200, 300)]], "vid long")
    got = {r["vid"]: r["lab"] for r in connected_components(v, spark.createDataFrame(chain + hub, "id_a long, id_b long")).collect()}
    assert got == {1: 1, 5: 5, 7: 5, **{i: 100 for i in range(100, 161)}, **{i: 5 for i in range(200, 300)}}
    assert connected_components(v, spark.createDataFrame([], "id_a long, id_b long")).filter("vid <> lab").count() == 0

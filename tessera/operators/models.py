"""Supervised learning (L1-L15) and SMOTE (F11) on Spark ML.

Models are Spark ML estimators fitted on a ``features`` vector column and a
``label`` double column.  Where the reference's library has no Spark twin the
re-aim is stated on the function (RBF SVM, multiclass boosted trees).
Cross-validation uses the deterministic fold column of
:func:`tessera.operators.sampling.stratified_folds`; folds are independent
Spark jobs submitted from a small thread pool.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.feature import SQLTransformer, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import metrics as M
from tessera.operators.clean import CleanerModel
from tessera.operators.ml_stages import Bins, FittedCleaner, OneVsRestScores, RandomFeatures, Scores
from tessera.operators.neighbors import knn, to_array
from tessera.operators.sampling import balanced_weights, rank_by_hash
from tessera.session import cut_lineage, join_rows, right_size, spread

# ---------------------------------------------------------------- wrappers


class FittedModel:
    """Uniform predict API: adds ``prediction`` (double) and ``probability``
    (array<double>, one entry per class) to a frame with ``features``.

    ``stage`` is the Spark ML transformer that does it, ``spark_model`` the
    estimator's own model inside it (None for composed models)."""

    def __init__(self, name, classes, stage, spark_model=None):
        self.name, self.classes, self.stage, self.spark_model = name, classes, stage, spark_model

    def transform(self, df: DataFrame) -> DataFrame:
        return self.stage.transform(df)

    def feature_importances(self):
        m = self.spark_model
        if m is not None and hasattr(m, "featureImportances"):
            return m.featureImportances.toArray()
        return None


TREE_ROWS = 2_500            # a forest, whose levels cost all trees' work on every row, uses all cores beyond so many rows each


def _weighted(df: DataFrame, balanced: bool, label: str = "label", rows_per_task: int | None = None):
    """Right-sized (small training sets stop paying per-task overhead on
    every optimiser iteration) and, if asked, with balanced class weights.
    ``rows_per_task``: dealt evenly over the cores (:func:`tessera.session.spread`)."""
    n = df.count()
    df, w = right_size(df, n), None
    if balanced:
        df, w = balanced_weights(df, label, "_w"), "_w"
    return spread(df, rows_per_task, n) if rows_per_task else df, w


def _classes(df: DataFrame, label: str = "label") -> list:
    return sorted(r[0] for r in df.select(label).distinct().collect())


def _spark_prob(model, name, classes):
    return FittedModel(name, classes, PipelineModel([model, Scores()]), model)


# L1
def fit_logistic(df: DataFrame, C: float = 1.0, max_iter: int = 1000, balanced: bool = True,
                 tol: float = 1e-4) -> FittedModel:
    """L2-penalised logistic regression; regParam = 1 / (C * sum of weights)
    reproduces the C-parameterised objective."""
    d, w = _weighted(df, balanced)
    total_w = d.agg(F.sum(w) if w else F.count(F.lit(1))).first()[0]
    lr = LogisticRegression(maxIter=max_iter, regParam=1.0 / (C * float(total_w)), elasticNetParam=0.0,
                            standardization=False, tol=tol)
    if w:
        lr.setWeightCol(w)
    return _spark_prob(lr.fit(d), "Logistic Regression", _classes(df))


# L3
def fit_random_forest(df: DataFrame, n_trees: int = 200, max_depth: int = 10, balanced: bool = True,
                      seed: int = 42, min_instances: int = 1) -> FittedModel:
    """Spark's forest.  Rows are dealt over all cores, and each keeps the number of the
    node it is in (``cacheNodeIds``), so a level neither sends the trees grown so far to
    every task nor walks each row down from the root again; the trees are the same."""
    d, w = _weighted(df, balanced, rows_per_task=TREE_ROWS)
    rf = RandomForestClassifier(numTrees=n_trees, maxDepth=max_depth, featureSubsetStrategy="sqrt", seed=seed,
                                minInstancesPerNode=min_instances, cacheNodeIds=True)
    if w:
        rf.setWeightCol(w)
    return _spark_prob(rf.fit(d), "Random Forest", _classes(df))


def _ovr(df: DataFrame, classes: list, fit_binary, name: str) -> FittedModel:
    """One binary model per class; probabilities normalised to sum 1."""
    def one(c):
        return fit_binary(df.withColumn("label", (F.col("label") == F.lit(c)).cast("double"))).stage
    with ThreadPoolExecutor(max_workers=4) as pool:
        models = list(pool.map(one, classes))
    return FittedModel(name, classes, OneVsRestScores(classes, models))


MAX_BINS = 32                # Spark's default for trees
EXACT_ROWS = 10_000          # up to here Spark, too, takes its thresholds from all rows; beyond it from a draw of so many


def _thresholds(values: np.ndarray) -> list:
    """Thresholds Spark's trees try on a feature: between all neighbouring values, or at equal shares of the rows."""
    v, n = np.unique(values, return_counts=True)
    if len(v) <= MAX_BINS:
        return ((v[:-1] + v[1:]) / 2.0).tolist()
    stride = n.sum() / MAX_BINS
    out, seen, target = [], n[0], stride
    for i in range(1, len(v)):
        if abs(seen - target) < abs(seen + n[i] - target):
            out.append((v[i - 1] + v[i]) / 2.0)
            target += stride
        seen += n[i]
    return out


def fit_bins(df: DataFrame) -> Bins:
    """Bins of the features: Spark's thresholds on small tables; on large ones those between all values of
    a feature that has few, else quantiles of all rows."""
    x = df.select(to_array(df, "features").alias("x"))
    rows = x.limit(EXACT_ROWS + 1).collect()
    if len(rows) <= EXACT_ROWS:
        X = np.array([r[0] for r in rows], dtype=float)
        edges = [_thresholds(X[:, i]) for i in range(X.shape[1])]
    else:
        cols = [f"x{i}" for i in range(len(rows[0][0]))]
        wide = x.select(*[F.col("x")[i].alias(c) for i, c in enumerate(cols)])
        kinds = wide.agg(*[F.approx_count_distinct(c, 0.01) for c in cols]).first()
        cut = wide.approxQuantile(cols, [i / MAX_BINS for i in range(1, MAX_BINS)], 0.001)
        edges = [_thresholds(np.array([r[0] for r in wide.select(c).distinct().collect()])) if n <= MAX_BINS else sorted(set(q))
                 for c, n, q in zip(cols, kinds, cut)]
    return Bins(thresholds=[t for e in edges for t in e], counts=[len(e) for e in edges])


def _cells(df: DataFrame, bins: Bins, mean: bool = False) -> DataFrame:
    """Training rows of a boosted tree: one per cell of bins and label, weighted by its rows.
    A tree sees no more of a row than its bins and its label, and rows that share them share
    every residual, so the rounds cost what the cells do, however many rows there are.

    ``mean``: one per cell of bins, with its mean label.  For squared error that is the same
    fit: no split parts a cell, so what its labels vary by adds the same to every choice."""
    d = bins.transform(df.select("features", "label")).select(vector_to_array("_bins").alias("_b"), "label")
    n = F.count(F.lit(1)).cast("double").alias("_n")
    c = cut_lineage(d.groupBy("_b").agg(F.avg("label").alias("label"), n) if mean else d.groupBy("_b", "label").agg(n))
    return right_size(c.select(array_to_vector("_b").alias("_bins"), "label", "_n"))


# L4
def fit_boosted_trees(df: DataFrame, n_rounds: int = 200, max_depth: int = 5, step: float = 0.1,
                      subsample: float = 1.0, seed: int = 42) -> FittedModel:
    """Gradient-boosted trees.  Spark's GBT is binary only, so more than two
    classes are fitted one-vs-rest with normalised probabilities.

    Without subsampling the rounds run on weighted cells of bins (:func:`_cells`);
    with it every row is drawn for itself and the rows stay."""
    classes = _classes(df)
    bins = fit_bins(df) if subsample == 1.0 else None

    def binary(d):
        g = GBTClassifier(maxIter=n_rounds, maxDepth=max_depth, stepSize=step, subsamplingRate=subsample,
                          seed=seed)
        if bins is None:
            return _spark_prob(g.fit(right_size(d)), "GBT", [0.0, 1.0])
        m = g.setFeaturesCol("_bins").setWeightCol("_n").fit(d)
        return FittedModel("GBT", [0.0, 1.0], PipelineModel([bins, m, Scores(["rawPrediction", "_bins"])]), m)

    if bins is not None:
        df = _cells(df, bins)

    if len(classes) <= 2:
        m = binary(df)
        m.name = "XGBoost"
        return m
    return _ovr(df, classes, binary, "XGBoost")


SVM_ROWS = 5_000             # rows a task lifts at least before an SVM fit


# L2
def fit_rbf_svm(df: DataFrame, n_components: int = 200, C: float = 1.0, balanced: bool = True, seed: int = 42,
                max_iter: int = 100, tol: float = 1e-4) -> FittedModel:
    """RBF-kernel SVM re-aimed for Spark: random Fourier features
    cos(W x + b) with W ~ N(0, 2 gamma), gamma = 1 / (d * Var(X)) ('scale'),
    a weighted LinearSVC on them, and Platt calibration of the margin for
    probabilities; one-vs-rest above two classes.  An approximation."""
    x = to_array(df, "features")
    d0 = df.select(x.alias("_x"))
    stats = d0.select(F.explode("_x").alias("v")).agg(F.var_pop("v").alias("var")).first()
    dim = len(d0.first()["_x"])
    lift = RandomFeatures.rbf(dim, 1.0 / (dim * (stats["var"] or 1.0)), n_components, seed)
    classes = _classes(df)

    def binary(d):
        rows, w = d.select("features", "label"), None
        if balanced:
            rows, w = balanced_weights(rows, "label", "_w"), "_w"
        # all cores lift the rows; the fit, some hundred short jobs, goes on with few partitions of them
        n = d.count()
        lifted = lift.transform(spread(rows, SVM_ROWS, n)).persist(StorageLevel.MEMORY_AND_DISK)
        lifted.count()
        dd = right_size(lifted, n)
        svc = LinearSVC(featuresCol="_rff", regParam=1.0 / (C * max(n, 1)), maxIter=max_iter, tol=tol,
                        rawPredictionCol="_margin", predictionCol="_side")
        if w:
            svc.setWeightCol(w)
        sm = svc.fit(dd)
        one = VectorSlicer(inputCol="_margin", outputCol="_mv", indices=[1])
        cal = LogisticRegression(featuresCol="_mv", maxIter=100, tol=tol).fit(one.transform(sm.transform(dd)).select("label", "_mv"))
        lifted.unpersist()
        stage = PipelineModel([lift, sm, one, cal, Scores(["rawPrediction", "_rff", "_margin", "_side", "_mv"])])
        return FittedModel("SVM", [0.0, 1.0], stage, sm)

    if len(classes) <= 2:
        return binary(df)
    return _ovr(df, classes, binary, "SVM")


CLASSIFIERS = {
    "Logistic Regression": lambda d, **kw: fit_logistic(d, **kw),
    "Random Forest": lambda d, **kw: fit_random_forest(d, **kw),
    "XGBoost": lambda d, **kw: fit_boosted_trees(d, **kw),
    "SVM": lambda d, **kw: fit_rbf_svm(d, **kw),
}


# L10-L12
def fit_linear(df: DataFrame) -> FittedModel:
    m = LinearRegression(regParam=0.0, solver="normal").fit(right_size(df))
    return FittedModel("Linear Regression", None, m, m)


def fit_ridge(df: DataFrame, alpha: float = 1.0) -> FittedModel:
    """sum of squares + alpha |beta|^2; Spark scales the penalty by the
    label's std, hence regParam = alpha * std_pop(y) / n."""
    s = df.agg(F.stddev_pop("label").alias("s"), F.count(F.lit(1)).alias("n")).first()
    reg = alpha * (s["s"] or 1.0) / s["n"]
    m = LinearRegression(regParam=reg, elasticNetParam=0.0, standardization=False, solver="normal").fit(right_size(df))
    return FittedModel("Ridge", None, m, m)


def fit_gbt_regressor(df: DataFrame, n_rounds: int = 200, max_depth: int = 5, step: float = 0.1,
                      seed: int = 42) -> FittedModel:
    """Gradient-boosted regression trees with squared error, on weighted cells of bins (:func:`_cells`)."""
    bins = fit_bins(df)
    m = GBTRegressor(featuresCol="_bins", weightCol="_n", maxIter=n_rounds, maxDepth=max_depth, stepSize=step,
                     seed=seed).fit(_cells(df, bins, mean=True))
    return FittedModel("XGBRegressor", None, PipelineModel([bins, m, SQLTransformer(statement="SELECT * EXCEPT (_bins) FROM __THIS__")]), m)


# L13
def regression_comparison(train: DataFrame, test: DataFrame, gbt_rounds: int = 200) -> DataFrame:
    rows = None
    for m in (fit_linear(train), fit_ridge(train), fit_gbt_regressor(train, gbt_rounds)):
        r = M.regression_summary(m.transform(test), "label", "prediction", m.name)
        rows = r if rows is None else rows.unionByName(r)
    return rows.orderBy("MAE")


# F11
def smote(df: DataFrame, id_col: str, k: int = 5, seed: int = 42, label: str = "label",
          features: str = "features") -> DataFrame:
    """Raise every class to the size of the largest one with synthetic rows
    x + u * (neighbour - x), neighbour among the k nearest rows of the same
    class (exact kNN).  Base rows are spread evenly over each class in hash
    order; the neighbour choice and u come from a per-row hash (no rand()).
    Returns the input rows plus synthetic ones (``synthetic`` flag)."""
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    if min(counts.values()) <= k:
        raise ValueError(f"SMOTE needs more than {k} rows in every class: {counts}")
    n_max, n_rows = max(counts.values()), sum(counts.values())
    need = {c: n_max - n for c, n in counts.items() if n < n_max}
    base = df.select(id_col, label, to_array(df, features).alias("_x"))
    out = base.select(id_col, label, "_x", F.lit(False).alias("synthetic"))
    if need:
        nb = knn(base.filter(F.col(label).isin(list(need))), id_col, "_x", k, partition_cols=[label])
        nbrs = nb.groupBy(F.col("id").alias(id_col)).agg(
            F.sort_array(F.collect_list(F.struct("rank", "nbr_id"))).alias("_nb"))
        r = rank_by_hash(base.filter(F.col(label).isin(list(need))), id_col, by=[label], seed=seed)
        per = F.create_map(*[x for c, v in need.items() for x in (F.lit(c), F.lit(v))])
        ncl = F.create_map(*[x for c in need for x in (F.lit(c), F.lit(counts[c]))])
        q, rem = F.floor(F.element_at(per, F.col(label)) / F.element_at(ncl, F.col(label))), \
            F.element_at(per, F.col(label)) % F.element_at(ncl, F.col(label))
        reps = q + F.when(F.col("rank") <= rem, 1).otherwise(0)
        gen = (r.withColumn("_reps", reps.cast("int")).filter(F.col("_reps") > 0)
                .withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_reps") - 1))))
        gen = join_rows(gen, nbrs, id_col, n_rows)
        h = F.xxhash64(F.lit(seed), F.col(id_col), F.col("_j"))
        pick = (F.pmod(h, F.lit(k)) + 1).cast("int")
        u = F.pmod(F.xxhash64(F.lit(seed + 1), F.col(id_col), F.col("_j")), F.lit(1 << 52)) / F.lit(float(1 << 52))
        gen = gen.withColumn("_nid", F.element_at("_nb", pick)["nbr_id"]).withColumn("_u", u)
        nvec = base.select(F.col(id_col).alias("_nid"), F.col("_x").alias("_nx"))
        gen = join_rows(gen, nvec, "_nid", n_rows).select(
            F.col(id_col), label,
            F.zip_with("_x", "_nx", lambda a, b: a + F.col("_u") * (b - a)).alias("_x"),
            F.lit(True).alias("synthetic"))
        out = out.unionByName(gen)
    return out.withColumn(features, array_to_vector("_x")).drop("_x")


def smote_rows(df: DataFrame, id_col: str) -> DataFrame:
    """SMOTE's rows, computed once (their number sizes the table) and checkpointed: the plan is deep,
    so each training pass plans a scan."""
    held = smote(df, id_col).persist(StorageLevel.MEMORY_AND_DISK)
    out = cut_lineage(right_size(held))
    held.unpersist()
    return out


# ---------------------------------------------------------------- evaluation

def evaluate(model: FittedModel, test: DataFrame, name: str | None = None) -> DataFrame:
    """Classification summary of a fitted model on test rows."""
    pred = model.transform(test)
    return M.classification_summary(pred, "label", "prediction", "probability", name or model.name)


def full_evaluation(model: FittedModel, test: DataFrame, name: str | None = None) -> dict:
    """L7 whole: ``summary`` row, ``confusion`` matrix and per-class ``report`` of the test rows, as frames."""
    return evaluate_predictions(model.transform(test), name or model.name)


def evaluate_predictions(pred: DataFrame, name: str = "Model") -> dict:
    """``full_evaluation`` of rows that carry label, prediction and probability already."""
    pred = pred.select("label", "prediction", "probability")
    return {"summary": M.classification_summary(pred, "label", "prediction", "probability", name),
            "confusion": M.confusion_matrix(pred, "label", "prediction"),
            "report": M.classification_report(pred, "label", "prediction")}


def evaluation_long(parts: dict) -> DataFrame:
    """A whole evaluation as one table (part, row, metric, value); values that a row does not have are left out."""
    keys = {"summary": "Model", "confusion": "label", "report": "class"}
    frames = []
    for part, key in keys.items():
        df = parts[part]
        cols = [c for c in df.columns if c != key]
        long = df.select(F.col(key).cast("string").alias("row"), *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(["row"], cols, "metric", "value")
        frames.append(long.filter("value IS NOT NULL").select(F.lit(part).alias("part"), "row", "metric", "value"))
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def _training_rows(data, folds, fold, use_smote, id_col):
    train = data.filter(F.col(folds) != fold).drop(folds)
    return smote_rows(train, id_col) if use_smote else train


def _fold_scores(fit, train, data, folds, fold, multi):
    test = data.filter(F.col(folds) == fold).drop(folds)
    model = fit(train)
    pred = model.transform(test).select("label", "prediction", "probability")
    pred = pred.persist(StorageLevel.MEMORY_AND_DISK)
    pc = M.per_class(pred, "label", "prediction")
    if multi:
        f1 = pc.agg(F.avg("f1")).first()[0]
        auc, ap = M.rank_metrics_ovr(pred, "label", "probability", average="weighted")
    else:
        f1 = pc.filter(F.col("class") == 1.0).select("f1").first()
        f1 = f1[0] if f1 else 0.0
        auc, ap = M.rank_metrics(pred.select("label", F.element_at("probability", 2).alias("s")), "label", "s")
    pred.unpersist()
    return f1, auc, ap


def cross_validate(data: DataFrame, models: dict, folds: str = "fold", k: int = 5, use_smote: bool = True,
                   id_col: str = "id", parallelism: int = 4) -> DataFrame:
    """Per model mean / population std of F1, mean ROC-AUC and PR-AUC over
    the folds (SMOTE inside the training folds only), sorted by PR-AUC."""
    multi = data.select("label").distinct().count() > 2
    data = cut_lineage(right_size(data))
    rows = []
    with ThreadPoolExecutor(max_workers=parallelism) as ex:     # one training table per fold, shared by the models
        trains = list(ex.map(lambda f: _training_rows(data, folds, f, use_smote, id_col), range(k)))
    for name, fit in models.items():
        with ThreadPoolExecutor(max_workers=parallelism) as ex:
            res = list(ex.map(lambda f: _fold_scores(fit, trains[f], data, folds, f, multi), range(k)))
        f1s = np.array([r[0] for r in res], dtype=float)
        rows.append((name, float(f1s.mean()), float(f1s.std()), float(np.mean([r[1] for r in res])),
                     float(np.mean([r[2] for r in res]))))
    out = data.sparkSession.createDataFrame(rows, "model string, f1_mean double, f1_std double, "
                                                  "roc_auc_mean double, pr_auc_mean double")
    return out.orderBy(F.desc("pr_auc_mean"))


# L6
class ModelRegistry(dict):
    def train_final(self, data: DataFrame, name: str = "XGBoost", use_smote: bool = True, id_col: str = "id",
                    **kw) -> FittedModel:
        train = smote_rows(data, id_col) if use_smote else data
        m = CLASSIFIERS[name](train, **kw)
        self[name] = m
        return m


# L8
GRIDS = {
    "XGBoost": {"n_rounds": [100, 200], "max_depth": [3, 5, 7], "step": [0.05, 0.1], "subsample": [0.8, 1.0]},
    "Random Forest": {"n_trees": [100, 200], "max_depth": [None, 5, 10], "min_samples_split": [2, 5]},
}


def tune(data: DataFrame, name: str, folds: str = "fold", k: int = 5, grid: dict | None = None,
         parallelism: int = 4):
    """Grid search over stratified folds scored by average precision; refits
    the best point on all rows.  Returns (best params, score table, model).

    Every (point, fold) is a fit of its own; ``parallelism`` of them run at a time."""
    if name not in GRIDS and grid is None:
        raise ValueError(f"no grid for {name}")
    grid = grid or GRIDS[name]
    keys = list(grid)
    points = [dict(zip(keys, vals)) for vals in _product(*[grid[x] for x in keys])]
    multi = data.select("label").distinct().count() > 2
    data = cut_lineage(right_size(data))

    def fit_point(p):
        kw = dict(p)
        if name == "Random Forest":
            md = kw.pop("max_depth")
            mss = kw.pop("min_samples_split")
            kw["max_depth"] = 30 if md is None else md
            kw["min_instances"] = max(1, mss // 2)
            return lambda d: fit_random_forest(d, **kw)
        return lambda d: fit_boosted_trees(d, **kw)

    def score(job):
        p, f = job
        return _fold_scores(fit_point(p), _training_rows(data, folds, f, False, None), data, folds, f, multi)[2]
    with ThreadPoolExecutor(max_workers=parallelism) as ex:
        aps = list(ex.map(score, [(p, f) for p in points for f in range(k)]))
    rows = [(str(p), float(np.mean(aps[i * k:(i + 1) * k]))) for i, p in enumerate(points)]
    best = max(range(len(points)), key=lambda i: rows[i][1])
    model = fit_point(points[best])(data.drop(folds))
    table = data.sparkSession.createDataFrame(rows, "params string, mean_average_precision double")
    return points[best], table, model


def _product(*lists):
    if not lists:
        yield ()
        return
    for x in lists[0]:
        for rest in _product(*lists[1:]):
            yield (x,) + rest


# L14
def feature_importance(model: FittedModel, names: list, top: int = 20):
    imp = model.feature_importances()
    if imp is None:
        return None
    spark = __import__("pyspark").sql.SparkSession.getActiveSession()
    rows = sorted(zip(names, [float(v) for v in imp]), key=lambda t: (-t[1], t[0]))[:top]
    return spark.createDataFrame(rows, "feature string, importance double")


# L15
def best_model(results: DataFrame, metric: str = "PR_AUC") -> DataFrame:
    return results.orderBy(F.desc(metric), "Model").limit(1)


# S11
def save_model(model: FittedModel, path: str):
    """One Spark ML model alone, in its own format."""
    if model.spark_model is None or model.spark_model.getFeaturesCol() == "_bins":
        raise ValueError("only single Spark ML models can be saved this way; see save_fitted")
    model.spark_model.write().overwrite().save(path)


def load_model(cls, path: str, name: str, classes=None) -> FittedModel:
    m = cls.load(path)
    if hasattr(m, "probability") or "Classification" in type(m).__name__:
        return _spark_prob(m, name, classes)
    return FittedModel(name, classes, m, m)


def save_fitted(model: FittedModel, path: str, cleaner: CleanerModel | None = None):
    """Any fitted model, composed ones (SVM, one-vs-rest) included: its stages and a row with name and classes.

    With ``cleaner``, that is saved beside it, so new raw rows can be prepared as the training rows were."""
    stage = model.stage if isinstance(model.stage, PipelineModel) else PipelineModel([model.stage])
    stage.write().overwrite().save(f"{path}/stages")
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(model.name, model.classes)], "name string, classes array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/about")
    if cleaner is not None:
        FittedCleaner(cleaner).write().overwrite().save(f"{path}/cleaner")


def load_fitted(spark: SparkSession, path: str) -> FittedModel:
    """A model saved by ``save_fitted``; the same predictions as before."""
    about = spark.read.parquet(f"{path}/about").first()
    stage = PipelineModel.load(f"{path}/stages")
    own = next((s for s in stage.stages if isinstance(s, Model) and not isinstance(s, OneVsRestScores)), None)
    return FittedModel(about["name"], about["classes"], stage, own)


def load_cleaner(path: str) -> CleanerModel:
    """The cleaner saved beside a model."""
    return FittedCleaner.load(f"{path}/cleaner").cleaner

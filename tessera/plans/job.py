"""End-to-end job (T6): raw table -> every result table of the reference.

One function of (spark, raw DataFrame, settings) returning a dict of
DataFrames.  Column roles are settings, so the job runs on any table; the
defaults are the reference's preset.  The processed table feeds several
stages, so it is written to a reliable checkpoint once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import params as P
from tessera.operators import clean as C
from tessera.operators import cluster as K
from tessera.operators import features as FE
from tessera.operators import models as L
from tessera.operators import rules as A
from tessera.operators import sampling as S
from tessera.operators import semi as SS
from tessera.plans import report as T
from tessera.session import cut_lineage


@dataclass
class JobSettings:
    id_col: str = "row_id"
    numeric: list = field(default_factory=lambda: list(P.NUMERICAL_COLS))
    categorical: list = field(default_factory=lambda: list(P.CATEGORICAL_COLS))
    target: str = P.TARGET_COL
    sentinels: dict = field(default_factory=lambda: dict(P.SENTINELS))
    preprocessing: dict = field(default_factory=lambda: dict(P.PREPROCESSING))
    association: dict = field(default_factory=lambda: dict(P.ASSOCIATION))
    target_item: str = "disease"
    rate_col: str = "exang"
    mode_col: str = "cp"
    k: int = 3
    n_init: int = 10
    k_range: tuple = tuple(P.CLUSTERING["k_range"])
    dbscan_eps: float = P.CLUSTERING["dbscan_eps"]
    dbscan_min_samples: int = P.CLUSTERING["dbscan_min_samples"]
    cv_folds: int = 5
    models: dict = field(default_factory=lambda: {"Random Forest": {}, "XGBoost": {}, "SVM": {},
                                                   "Logistic Regression": {}})
    regression_target: str = P.REGRESSION_TARGET
    label_ratios: tuple = tuple(P.SEMI["label_ratios"])
    seed: int = P.SEED


def distinct_rows(raw: DataFrame, id_col: str) -> DataFrame:
    """Duplicate rows removed whatever their ids; the smallest id stays."""
    others = [c for c in raw.columns if c != id_col]
    return raw.groupBy(*[F.col(f"`{c}`") for c in others]).agg(F.min(id_col).alias(id_col)).select(*[F.col(f"`{c}`") for c in raw.columns])


def run(spark: SparkSession, raw: DataFrame, s: JobSettings | None = None, skip_semi: bool = False,
        skip_regression: bool = False) -> dict:
    s = s or JobSettings()
    out = {}
    if s.id_col not in raw.columns:
        raw = raw.withColumn(s.id_col, F.monotonically_increasing_id())
        raw = cut_lineage(raw)  # pin the generated ids
    pp = s.preprocessing
    processed, cleaner = C.fit_transform(distinct_rows(raw, s.id_col), s.numeric, s.categorical, s.sentinels, pp["handle_missing"],
                                         pp["outlier_method"], pp["outlier_threshold"], pp["scaling_method"])
    processed = cut_lineage(processed)
    out["processed"] = processed

    # rules from the raw rows (as the reference does)
    tx = FE.transactions(raw)
    a = s.association
    itemsets, rules = A.mine_rules(tx, min_support=a["min_support"], min_confidence=a["min_confidence"],
                                   min_lift=a["min_lift"], max_len=a["max_len"])
    out["itemsets"], out["rules"] = itemsets, rules
    out["target_rules"] = T.top_target_rules(rules, s.target_item, 20)

    # clustering on all processed rows
    feats = [c for c in s.numeric + s.categorical if c in processed.columns]
    X = VectorAssembler(inputCols=feats, outputCol="features").transform(processed)
    X = X.select(s.id_col, "features", *[c for c in processed.columns if c not in (s.id_col,)])
    out["k_table"] = K.k_selection(X, s.id_col, "features", s.k_range, s.n_init, s.seed)
    km = K.fit_kmeans(X, "features", s.k, s.n_init, s.seed)
    km_lab = K.kmeans_labels(km, X, "features", X.columns)
    db_lab = K.dbscan(X, s.id_col, "features", s.dbscan_eps, s.dbscan_min_samples)
    summaries = [K.clustering_summary(km_lab, "features", "cluster", "KMeans"),
                 K.clustering_summary(X.join(db_lab, s.id_col), "features", "cluster", "DBSCAN")]
    out["clustering"] = T.summarize_clustering(summaries)
    pca = K.fit_pca(X, "features", 2)
    out["pca_points"] = pca.transform(km_lab, "features", [s.id_col, "cluster"])
    means = [c for c in s.numeric if c in processed.columns]
    profile = K.profile_clusters(km_lab, "cluster", s.target, means,
                                 rate_col=s.rate_col if s.rate_col in processed.columns else None,
                                 mode_col=s.mode_col if s.mode_col in processed.columns else None)
    out["cluster_profile"], out["cluster_names"] = profile, K.name_clusters(profile)

    # classification
    data = X.select(F.col(s.id_col).alias("id"), "features", F.col(s.target).cast("double").alias("label"))
    split = S.stratified_split(data, "id", "label", P.TEST_SIZE, s.seed)
    train, test = S.train_test(cut_lineage(split))
    folds = S.stratified_folds(train, "id", "label", s.cv_folds, s.seed)
    fits = {n: (lambda d, n=n, kw=kw: L.CLASSIFIERS[n](d, **kw)) for n, kw in s.models.items()}
    out["cv"] = L.cross_validate(folds, fits, k=s.cv_folds, use_smote=True, id_col="id")
    reg = L.ModelRegistry()
    results = []
    for n, kw in s.models.items():
        m = reg.train_final(train, n, use_smote=True, id_col="id", **kw)
        results.append(L.evaluate(m, test, n))
    out["classification"] = T.summarize_classification(results)
    out["best_model"] = L.best_model(out["classification"])

    if not skip_regression and s.regression_target in processed.columns:
        others = [c for c in feats if c != s.regression_target]
        R = VectorAssembler(inputCols=others, outputCol="features").transform(processed).select(
            F.col(s.id_col).alias("id"), "features", F.col(s.regression_target).cast("double").alias("label"),
            F.col(s.target).cast("double").alias("cls"))
        rtr, rte = S.train_test(S.random_split(R, "id", P.TEST_SIZE, s.seed))
        out["regression"] = T.summarize_regression(L.regression_comparison(rtr.drop("cls"), rte.drop("cls")))

    if not skip_semi:
        curve = SS.learning_curve(train, test, "id", lambda d: L.fit_rbf_svm(d), s.label_ratios, s.seed)
        out["semi_supervised"] = T.summarize_semi_supervised(curve)
    return out

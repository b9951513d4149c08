"""Result tables (T1-T5) and chart data (T7): small selects over result frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.metrics import round_numeric
from tessera.operators import rules as A

CLASSIFICATION_COLS = ["Model", "Accuracy", "Precision", "Recall", "F1", "ROC_AUC", "PR_AUC"]
REGRESSION_COLS = ["Model", "MAE", "RMSE", "R2"]


def _union(frames) -> DataFrame:
    frames = frames if isinstance(frames, (list, tuple)) else [frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# T1
def summarize_classification(results) -> DataFrame:
    return round_numeric(_union(results).select(*CLASSIFICATION_COLS), 4).orderBy(F.desc_nulls_last("PR_AUC"), "Model")


# T2
def summarize_regression(results) -> DataFrame:
    return round_numeric(_union(results).select(*REGRESSION_COLS), 4).orderBy("MAE", "Model")


# T3
def summarize_clustering(results) -> DataFrame:
    return _union(results)


# T4
def summarize_semi_supervised(curve: DataFrame) -> DataFrame:
    return round_numeric(curve, 4)


# T5
def top_target_rules(rules: DataFrame, target_item: str, n: int = 20) -> DataFrame:
    return A.format_rules(A.top_rules(A.rules_with_consequent(rules, target_item), n, "lift"))


# T7 chart data
def rule_scatter(rules: DataFrame) -> DataFrame:
    return rules.select("support", "confidence", "lift")


def rule_bars(rules: DataFrame, n: int = 10) -> DataFrame:
    top = A.top_rules(rules, n, "lift")
    return top.select(F.concat_ws(" → ", F.array_join("antecedents", ", "), F.array_join("consequents", ", "))
                      .alias("rule"), "lift")


def profile_long(profile: DataFrame, cluster: str = "cluster") -> DataFrame:
    cols = [c for c, t in profile.dtypes if c != cluster and t in ("double", "bigint", "int")]
    return profile.select(cluster, *[F.col(c).cast("double").alias(c) for c in cols]) \
        .unpivot([cluster], cols, "metric", "value")


def metric_sorted(results: DataFrame, metric: str = "PR_AUC") -> DataFrame:
    return results.orderBy(F.desc_nulls_last(metric))


def semi_curve_long(curve: DataFrame) -> DataFrame:
    cols = [c for c in curve.columns if c.startswith(("pr_auc", "f1"))]
    return curve.unpivot(["label_ratio", "n_labeled"], cols, "metric", "value")


def residuals(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return pred.withColumn("residual", F.col(label) - F.col(prediction))


def residual_histogram(pred: DataFrame, label: str = "label", prediction: str = "prediction", bins: int = 30):
    from tessera.operators.profile import histogram
    return histogram(residuals(pred, label, prediction), ["residual"], bins)

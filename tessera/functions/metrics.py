"""Metrics (M1-M8, M13, M15) over (label, prediction, score) tables.

Counting metrics aggregate to a k x k confusion table (k = classes) first,
so everything after the first partial aggregate is tiny.  Ranking metrics
(ROC-AUC with ties, average precision, curves) aggregate to one row per
distinct score and then take exact running sums with
:func:`tessera.functions.order_stats.ordered_cumsum`: no global window, no
single-task sort.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.order_stats import ordered_cumsum


def _as_array(df: DataFrame, col: str) -> Column:
    t = df.schema[col].dataType
    if isinstance(t, T.ArrayType):
        return F.col(col).cast("array<double>")
    return vector_to_array(F.col(col))


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


# ----------------------------------------------------------------- M5
def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).cast("double").alias("label"),
                      F.col(prediction).cast("double").alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """True class rows x ``pred_<c>`` columns over the union of classes, missing = 0."""
    cm = confusion_counts(df, label, prediction)
    classes = sorted({r[0] for r in cm.select("label").union(cm.select("prediction")).distinct().collect()})
    names = [f"pred_{_fmt(c)}" for c in classes]
    truth = df.sparkSession.createDataFrame([(float(c),) for c in classes], "label double")
    wide = cm.groupBy("label").pivot("prediction", classes).agg(F.sum("n"))
    # classes x classes, bounded by the number of classes
    out = F.broadcast(truth).join(wide, "label", "left")
    return out.select(F.col("label"), *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("long").alias(n)
                                        for c, n in zip(classes, names)])


def _fmt(c):
    return str(int(c)) if float(c).is_integer() else str(c)


# ----------------------------------------------------------------- M1 / M6
def per_class(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """class, precision, recall, f1, support (zero division -> 0)."""
    cm = confusion_counts(df, label, prediction)
    t = cm.groupBy(F.col("label").alias("class")).agg(F.sum("n").alias("support"),
                                                      F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n"))
                                                            .otherwise(0)).alias("tp"))
    p = cm.groupBy(F.col("prediction").alias("class")).agg(F.sum("n").alias("n_pred"))
    j = t.join(p, "class", "full").fillna(0, ["support", "tp", "n_pred"])
    prec = _safe_div(F.col("tp").cast("double"), F.col("n_pred").cast("double"))
    rec = _safe_div(F.col("tp").cast("double"), F.col("support").cast("double"))
    return (j.withColumn("precision", prec).withColumn("recall", rec)
             .withColumn("f1", _safe_div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
             .select("class", "precision", "recall", "f1", F.col("support").cast("long").alias("support"),
                     F.col("tp").cast("long").alias("tp")))


def _row(name, p, r, f):
    return F.struct(F.lit(name).alias("class"), F.col(p).alias("precision"), F.col(r).alias("recall"),
                    F.col(f).alias("f1"), F.col("n").cast("long").alias("support"))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per-class rows plus accuracy, macro avg and weighted avg rows."""
    pc = per_class(df, label, prediction).cache()
    rows = pc.select(F.col("class").cast("string").alias("class"), "precision", "recall", "f1", "support")
    tot = pc.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"),
                 F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                 (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
                 (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
                 (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"))
    extra = tot.select(F.inline(F.array(
        F.struct(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), (F.col("tp") / F.col("n")).alias("f1"),
                 F.col("n").cast("long").alias("support")),
        _row("macro avg", "mp", "mr", "mf"), _row("weighted avg", "wp", "wr", "wf"))))
    return rows.unionByName(extra)


def classification_summary(df: DataFrame, label: str = "label", prediction: str = "prediction",
                           score: str | None = None, model_name: str = "Model", positive: float = 1.0) -> DataFrame:
    """Accuracy, precision, recall, F1 (binary on class 1, macro when the true
    labels have more than two classes), ROC-AUC and PR-AUC (null without scores).

    ``score``: a double column (binary) or a probability vector/array."""
    spark = df.sparkSession
    n_true = df.select(label).distinct().count()
    multi = n_true > 2
    pc = per_class(df, label, prediction)
    if multi:
        head = pc.agg(F.avg("precision").alias("Precision"), F.avg("recall").alias("Recall"), F.avg("f1").alias("F1"),
                      (F.sum("tp") / F.sum("support")).alias("Accuracy"))
    else:
        head = pc.agg(F.max(F.when(F.col("class") == positive, F.col("precision"))).alias("Precision"),
                      F.max(F.when(F.col("class") == positive, F.col("recall"))).alias("Recall"),
                      F.max(F.when(F.col("class") == positive, F.col("f1"))).alias("F1"),
                      (F.sum("tp") / F.sum("support")).alias("Accuracy"))
        head = head.fillna(0.0, ["Precision", "Recall", "F1"])
    if score is None:
        auc, ap = None, None
    elif multi:
        auc, ap = rank_metrics_ovr(df, label, score, average="macro")
    else:
        s = _binary_score(df, score, positive)
        auc, ap = rank_metrics(df.select(F.col(label).alias("_y"), s.alias("_s")), "_y", "_s", positive)
    return head.select(F.lit(model_name).alias("Model"), "Accuracy", "Precision", "Recall", "F1",
                       F.lit(auc).cast("double").alias("ROC_AUC"), F.lit(ap).cast("double").alias("PR_AUC"))


def _binary_score(df, score, positive=1.0):
    t = df.schema[score].dataType
    if isinstance(t, (T.DoubleType, T.FloatType, T.IntegerType, T.LongType, T.DecimalType)):
        return F.col(score).cast("double")
    return F.element_at(_as_array(df, score), int(positive) + 1)


# ----------------------------------------------------------------- M2 / M3 / M13
def score_distribution(df: DataFrame, label: str, score: str, positive=1.0, by: list | None = None) -> DataFrame:
    """One row per distinct score: (by..., score, pos, neg)."""
    by = list(by or [])
    is_pos = (F.col(label).cast("double") == F.lit(float(positive))).cast("long")
    return (df.filter(F.col(score).isNotNull())
              .groupBy(*by, F.col(score).cast("double").alias("score"))
              .agg(F.sum(is_pos).alias("pos"), F.sum(1 - is_pos).alias("neg")))


def _auc_from_dist(dist: DataFrame, by: list) -> DataFrame:
    c = ordered_cumsum(dist, "score", ["pos", "neg"], by=by)
    # negatives strictly below the score + half of the tied negatives
    return (c.groupBy(*by).agg(
        F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") + 0.5 * F.col("neg"))).alias("u"),
        F.sum("pos").alias("P"), F.sum("neg").alias("N"))
        .withColumn("auc", F.when((F.col("P") > 0) & (F.col("N") > 0),
                                  F.col("u") / (F.col("P") * F.col("N")))))


def _rank_from_dist(dist: DataFrame, by: list) -> DataFrame:
    """ROC-AUC (ties half) and step-wise AP from ONE ascending running sum."""
    c = ordered_cumsum(dist, "score", ["pos", "neg"], by=by, with_totals=True)
    tp = F.col("tot_pos") - F.col("cum_pos") + F.col("pos")  # positives scoring >= this score
    fp = F.col("tot_neg") - F.col("cum_neg") + F.col("neg")
    g = c.groupBy(*by).agg(
        F.sum(F.col("pos") * (F.col("cum_neg") - 0.5 * F.col("neg"))).alias("u"),
        F.sum(F.col("pos") * tp / (tp + fp)).alias("s"),
        F.max("tot_pos").alias("P"), F.max("tot_neg").alias("N"))
    return g.select(*by, F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("u") / (F.col("P") * F.col("N"))).alias("auc"),
                    F.when(F.col("P") > 0, F.col("s") / F.col("P")).alias("ap"), "P")


def rank_metrics(df: DataFrame, label: str, score: str, positive=1.0) -> tuple:
    """(ROC-AUC, average precision) of a binary score in one pass."""
    r = _rank_from_dist(score_distribution(df, label, score, positive), []).collect()
    return (r[0]["auc"], r[0]["ap"]) if r else (None, None)


def rank_metrics_ovr(df: DataFrame, label: str, prob: str, average: str = "macro") -> tuple:
    """One-vs-rest (ROC-AUC averaged macro or by prevalence, macro AP)."""
    dist, _ = _ovr_long(df, label, prob)
    per = _rank_from_dist(dist, ["cls"])
    auc = (F.sum(F.col("auc") * F.col("P")) / F.sum("P")) if average == "weighted" else F.avg("auc")
    r = per.agg(auc.alias("auc"), F.avg("ap").alias("ap")).collect()
    return (r[0]["auc"], r[0]["ap"]) if r else (None, None)


def roc_auc_table(df: DataFrame, label: str, score: str, positive=1.0) -> DataFrame:
    return _auc_from_dist(score_distribution(df, label, score, positive), []).select(F.col("auc").alias("roc_auc"))


def average_precision_table(df: DataFrame, label: str, score: str, positive=1.0) -> DataFrame:
    return _ap_from_dist(score_distribution(df, label, score, positive), []).select(F.col("ap").alias("pr_auc"))


def roc_auc(df: DataFrame, label: str, score: str, positive=1.0) -> float | None:
    """Exact ROC-AUC with ties counted half (Mann-Whitney)."""
    r = _auc_from_dist(score_distribution(df, label, score, positive), []).collect()
    return r[0]["auc"] if r else None


def _ap_from_dist(dist: DataFrame, by: list) -> DataFrame:
    c = ordered_cumsum(dist, "score", ["pos", "neg"], by=by, descending=True)
    prec = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    return (c.groupBy(*by).agg(F.sum(F.col("pos") * prec).alias("s"), F.sum("pos").alias("P"))
              .withColumn("ap", F.when(F.col("P") > 0, F.col("s") / F.col("P"))))


def average_precision(df: DataFrame, label: str, score: str, positive=1.0) -> float | None:
    """Step-wise AP = sum over distinct thresholds of (R_n - R_{n-1}) * P_n."""
    r = _ap_from_dist(score_distribution(df, label, score, positive), []).collect()
    return r[0]["ap"] if r else None


def _ovr_long(df: DataFrame, label: str, prob: str) -> DataFrame:
    classes = sorted(r[0] for r in df.select(F.col(label).cast("double")).distinct().collect())
    arr = _as_array(df, prob)
    items = F.array(*[F.struct(F.lit(c).alias("cls"), F.element_at(arr, int(c) + 1).alias("score"),
                               (F.col(label).cast("double") == F.lit(c)).cast("long").alias("is_pos"))
                      for c in classes])
    long = df.select(F.explode(items).alias("s")).select("s.*")
    return (long.groupBy("cls", "score").agg(F.sum("is_pos").alias("pos"), F.sum(1 - F.col("is_pos")).alias("neg")),
            classes)


def roc_auc_ovr(df: DataFrame, label: str, prob: str, average: str = "macro") -> float | None:
    """One-vs-rest ROC-AUC, macro or prevalence-weighted average."""
    dist, _ = _ovr_long(df, label, prob)
    per = _auc_from_dist(dist, ["cls"])
    if average == "weighted":
        r = per.agg((F.sum(F.col("auc") * F.col("P")) / F.sum("P")).alias("v")).collect()
    else:
        r = per.agg(F.avg("auc").alias("v")).collect()
    return r[0]["v"] if r else None


def average_precision_ovr(df: DataFrame, label: str, prob: str) -> float | None:
    dist, _ = _ovr_long(df, label, prob)
    r = _ap_from_dist(dist, ["cls"]).agg(F.avg("ap").alias("v")).collect()
    return r[0]["v"] if r else None


def curve_points(df: DataFrame, label: str, score: str, positive=1.0) -> DataFrame:
    """ROC and PR points, one row per distinct threshold (descending), plus
    the (fpr 0, tpr 0) start with threshold +inf.  PR ends at recall 0,
    precision 1 in the start row."""
    dist = score_distribution(df, label, score, positive)
    c = ordered_cumsum(dist, "score", ["pos", "neg"], descending=True)
    tot = dist.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).collect()[0]
    P, N = F.lit(float(tot["P"] or 0)), F.lit(float(tot["N"] or 0))
    pts = c.select(F.col("score").alias("threshold"), F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"))
    start = df.sparkSession.createDataFrame([(float("inf"), 0, 0)], "threshold double, tp long, fp long")
    j = pts.unionByName(start).withColumns({"P": P, "N": N})
    return j.select("threshold", "tp", "fp",
                    _safe_div(F.col("fp").cast("double"), F.col("N").cast("double")).alias("fpr"),
                    _safe_div(F.col("tp").cast("double"), F.col("P").cast("double")).alias("tpr"),
                    F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp")))
                     .otherwise(F.lit(1.0)).alias("precision"),
                    _safe_div(F.col("tp").cast("double"), F.col("P").cast("double")).alias("recall"))


# ----------------------------------------------------------------- M7
def regression_summary(df: DataFrame, label: str = "label", prediction: str = "prediction",
                       model_name: str = "Model") -> DataFrame:
    """MAE, RMSE, R2 (0 when the target has no variance) in one pass."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    a = df.agg(F.avg(F.abs(y - p)).alias("MAE"), F.sqrt(F.avg((y - p) * (y - p))).alias("RMSE"),
               F.sum((y - p) * (y - p)).alias("ss_res"), (F.var_pop(y) * F.count(y)).alias("ss_tot"))
    return a.select(F.lit(model_name).alias("Model"), "MAE", "RMSE",
                    F.when(F.col("ss_tot") != 0, 1 - F.col("ss_res") / F.col("ss_tot")).otherwise(F.lit(0.0))
                    .alias("R2"))


# ----------------------------------------------------------------- M8
def error_analysis(df: DataFrame, label: str, prediction: str, cols: list, digits: int = 2) -> DataFrame:
    """False negatives (1 -> 0) and false positives (0 -> 1): count and summary."""
    from tessera.operators.profile import describe
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    out = None
    for kind, cond in (("false_negative", (y == 1) & (p == 0)), ("false_positive", (y == 0) & (p == 1))):
        d = describe(df.filter(cond), cols).withColumn("kind", F.lit(kind))
        out = d if out is None else out.unionByName(d)
    return round_numeric(out, digits)


# ----------------------------------------------------------------- M15
def round_numeric(df: DataFrame, digits: int = 4) -> DataFrame:
    return df.select(*[F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])

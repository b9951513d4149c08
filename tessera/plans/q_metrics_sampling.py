"""Registered queries for metrics (M*) and sampling.

Score bindings are derived from the test tables (no model needed):
orders -> binary label "finished", tied scores floor(totalprice / 10000);
lineitem -> 3 classes from the return flag, a fixed prediction and a
probability vector built from discount, tax and quantity.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import metrics as M
from tessera.operators import sampling as S
from tessera.plans.catalog import ORACLES, load, query, r6


def ord_scored(spark, sf):
    o = load(spark, sf, "orders")
    return o.select("o_orderkey", "o_totalprice",
                    (F.col("o_orderstatus") == "F").cast("int").alias("y"),
                    F.floor(F.col("o_totalprice") / 10000).cast("double").alias("s"),
                    (F.col("o_totalprice") >= 250000).cast("int").alias("p"))


ORD_SQL = """(SELECT o_orderkey, o_totalprice, CAST(o_orderstatus = 'F' AS INTEGER) AS y,
  CAST(floor(o_totalprice / 10000) AS DOUBLE) AS s, CAST(o_totalprice >= 250000 AS INTEGER) AS p FROM orders)"""


def li_scored(spark, sf):
    li = load(spark, sf, "lineitem")
    a = F.col("l_discount") + F.lit(0.01)
    b = F.col("l_tax") + F.lit(0.01)
    c = F.col("l_quantity") / F.lit(100.0)
    t = a + b + c
    y = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    return li.select(y.cast("int").alias("y"), (F.col("l_linenumber") % 3).cast("int").alias("p"),
                     F.array(a / t, b / t, c / t).alias("prob"), "l_quantity")


LI_SQL = """(SELECT CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS INTEGER) AS y,
  CAST(l_linenumber % 3 AS INTEGER) AS p, [a / t, b / t, c / t] AS prob, l_quantity
  FROM (SELECT *, a + b + c AS t FROM (SELECT *, l_discount + 0.01::DOUBLE AS a, l_tax + 0.01::DOUBLE AS b,
        l_quantity / 100.0::DOUBLE AS c FROM lineitem)))"""

BIN_RANK_SQL = f"""g AS (SELECT s, sum(y) AS pos, sum(1 - y) AS neg FROM {ORD_SQL} GROUP BY s),
w AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
             sum(pos) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS cp,
             sum(neg) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS cn FROM g),
k AS (SELECT sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc, sum(pos * cp / (cp + cn)) / sum(pos) AS ap
      FROM w)"""

MULTI_CLASSES_SQL = "(SELECT unnest([0, 1, 2]) AS c)"

MULTI_RANK_SQL = f"""l AS (SELECT c, prob[c + 1] AS s, CAST(y = c AS INTEGER) AS pos FROM {LI_SQL}, {MULTI_CLASSES_SQL}),
g AS (SELECT c, s, sum(pos) AS pos, sum(1 - pos) AS neg FROM l GROUP BY c, s),
w AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY c ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
             AS below,
             sum(pos) OVER (PARTITION BY c ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS cp,
             sum(neg) OVER (PARTITION BY c ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS cn FROM g),
k AS (SELECT c, sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc,
             sum(pos * cp / (cp + cn)) / sum(pos) AS ap, sum(pos) AS npos FROM w GROUP BY c)"""

PC_SQL = f"""pc AS (SELECT c, sum(CASE WHEN y = c AND p = c THEN 1 ELSE 0 END) AS tp,
                 sum(CASE WHEN y = c THEN 1 ELSE 0 END) AS nt, sum(CASE WHEN p = c THEN 1 ELSE 0 END) AS np
          FROM {LI_SQL}, {MULTI_CLASSES_SQL} GROUP BY c),
pm AS (SELECT c, tp, nt, np, CASE WHEN np > 0 THEN tp / np ELSE 0 END AS pr,
              CASE WHEN nt > 0 THEN tp / nt ELSE 0 END AS rc FROM pc),
pf AS (SELECT *, CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0 END AS f1 FROM pm)"""


# ------------------------------------------------------------------ metrics

@query("m1_classification_summary_binary_orders", f"""
WITH d AS {ORD_SQL},
cm AS (SELECT count(*) AS n, sum(CASE WHEN y = 1 AND p = 1 THEN 1 ELSE 0 END) AS tp,
              sum(CASE WHEN y = 0 AND p = 0 THEN 1 ELSE 0 END) AS tn,
              sum(CASE WHEN p = 1 THEN 1 ELSE 0 END) AS np, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS nt FROM d),
m AS (SELECT (tp + tn) / n AS acc, CASE WHEN np > 0 THEN tp / np ELSE 0 END AS pr,
             CASE WHEN nt > 0 THEN tp / nt ELSE 0 END AS rc FROM cm), {BIN_RANK_SQL}
SELECT 'orders' AS Model, round(acc, 6) AS Accuracy, round(pr, 6) AS Precision, round(rc, 6) AS Recall,
       round(CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0 END, 6) AS F1,
       round(auc, 6) AS ROC_AUC, round(ap, 6) AS PR_AUC FROM m, k""")
def q_m1(spark, sf):
    return r6(M.classification_summary(ord_scored(spark, sf), "y", "p", "s", model_name="orders"))


@query("m1_classification_summary_multiclass_lineitem", f"""
WITH {PC_SQL}, {MULTI_RANK_SQL}
SELECT 'lineitem' AS Model, round(sum(tp) / sum(nt), 6) AS Accuracy, round(avg(pr), 6) AS Precision,
       round(avg(rc), 6) AS Recall, round(avg(f1), 6) AS F1,
       round((SELECT avg(auc) FROM k), 6) AS ROC_AUC, round((SELECT avg(ap) FROM k), 6) AS PR_AUC FROM pf""")
def q_m1b(spark, sf):
    return r6(M.classification_summary(li_scored(spark, sf), "y", "p", "prob", model_name="lineitem"))


def summary_sql(digits):
    """Both summary rows (orders binary, lineitem macro over its classes)."""
    r = lambda x, name: f"round({x}, {digits}) AS {name}"
    return f"""SELECT * FROM (WITH d AS {ORD_SQL},
cm AS (SELECT count(*) AS n, sum(CASE WHEN y = 1 AND p = 1 THEN 1 ELSE 0 END) AS tp,
              sum(CASE WHEN y = 0 AND p = 0 THEN 1 ELSE 0 END) AS tn,
              sum(CASE WHEN p = 1 THEN 1 ELSE 0 END) AS np, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS nt FROM d),
m AS (SELECT (tp + tn) / n AS acc, CASE WHEN np > 0 THEN tp / np ELSE 0 END AS pr,
             CASE WHEN nt > 0 THEN tp / nt ELSE 0 END AS rc FROM cm), {BIN_RANK_SQL}
SELECT 'orders' AS Model, {r("acc", "Accuracy")}, {r("pr", "Precision")}, {r("rc", "Recall")},
       {r("CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0 END", "F1")}, {r("auc", "ROC_AUC")}, {r("ap", "PR_AUC")}
FROM m, k)
UNION ALL SELECT * FROM (WITH {PC_SQL}, {MULTI_RANK_SQL}
SELECT 'lineitem', {r("sum(tp) / sum(nt)", "Accuracy")}, {r("avg(pr)", "Precision")}, {r("avg(rc)", "Recall")},
       {r("avg(f1)", "F1")}, {r("(SELECT avg(auc) FROM k)", "ROC_AUC")}, {r("(SELECT avg(ap) FROM k)", "PR_AUC")} FROM pf)"""


def _summaries(spark, sf):
    return [M.classification_summary(ord_scored(spark, sf), "y", "p", "s", model_name="orders"),
            M.classification_summary(li_scored(spark, sf), "y", "p", "prob", model_name="lineitem")]


@query("t1_classification_table_fixed_predictions", summary_sql(4))
def q_t1(spark, sf):
    from tessera.plans.report import summarize_classification
    return summarize_classification(_summaries(spark, sf))


@query("l15_best_model_fixed_predictions", f"SELECT * FROM ({summary_sql(4)}) ORDER BY PR_AUC DESC, Model LIMIT 1")
def q_l15b(spark, sf):
    from tessera.operators.models import best_model
    from tessera.plans.report import summarize_classification
    return best_model(summarize_classification(_summaries(spark, sf)))


@query("p8_results_table_fixed_predictions", f"SELECT Model, F1, ROC_AUC, PR_AUC FROM ({summary_sql(6)})")
def q_p8(spark, sf):
    from tessera.operators.semi import results_table
    label, pred = F.col("y").cast("double").alias("label"), F.col("p").cast("double").alias("prediction")
    tables = {"orders": ord_scored(spark, sf).select(label, pred, F.array(-F.col("s"), F.col("s")).alias("probability")),
              "lineitem": li_scored(spark, sf).select(label, pred, F.col("prob").alias("probability"))}
    return r6(results_table(tables, spark))


@query("m2_roc_auc_ties_orders", f"WITH {BIN_RANK_SQL} SELECT round(auc, 6) AS roc_auc FROM k")
def q_m2(spark, sf):
    return r6(M.roc_auc_table(ord_scored(spark, sf), "y", "s"))


@query("m2_roc_auc_ovr_weighted_lineitem", f"""WITH {MULTI_RANK_SQL}
SELECT round(sum(auc * npos) / sum(npos), 6) AS roc_auc FROM k""")
def q_m2b(spark, sf):
    v = M.roc_auc_ovr(li_scored(spark, sf), "y", "prob", average="weighted")
    return r6(spark.range(1).select(F.lit(v).cast("double").alias("roc_auc")))


@query("m3_average_precision_orders", f"WITH {BIN_RANK_SQL} SELECT round(ap, 6) AS pr_auc FROM k")
def q_m3(spark, sf):
    return r6(M.average_precision_table(ord_scored(spark, sf), "y", "s"))


@query("m5_confusion_matrix_lineitem", f"""
SELECT CAST(y AS DOUBLE) AS label, count(*) FILTER (WHERE p = 0) AS pred_0, count(*) FILTER (WHERE p = 1) AS pred_1,
       count(*) FILTER (WHERE p = 2) AS pred_2 FROM {LI_SQL} GROUP BY y""")
def q_m5(spark, sf):
    return M.confusion_matrix(li_scored(spark, sf), "y", "p")


@query("m6_classification_report_lineitem", f"""
WITH {PC_SQL}
SELECT CAST(CAST(c AS DOUBLE) AS VARCHAR) AS class, round(pr, 6) AS precision, round(rc, 6) AS recall,
       round(f1, 6) AS f1, CAST(nt AS BIGINT) AS support FROM pf
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(nt), 6), CAST(sum(nt) AS BIGINT) FROM pf
UNION ALL SELECT 'macro avg', round(avg(pr), 6), round(avg(rc), 6), round(avg(f1), 6), CAST(sum(nt) AS BIGINT) FROM pf
UNION ALL SELECT 'weighted avg', round(sum(pr * nt) / sum(nt), 6), round(sum(rc * nt) / sum(nt), 6),
                 round(sum(f1 * nt) / sum(nt), 6), CAST(sum(nt) AS BIGINT) FROM pf""")
def q_m6(spark, sf):
    return r6(M.classification_report(li_scored(spark, sf), "y", "p"))


@query("m7_regression_summary_orders", f"""
SELECT 'orders' AS Model, round(avg(abs(yt - yp)), 6) AS MAE, round(sqrt(avg((yt - yp) * (yt - yp))), 6) AS RMSE,
       round(1 - sum((yt - yp) * (yt - yp)) / (var_pop(yt) * count(yt)), 6) AS R2
FROM (SELECT o_totalprice / 1000 AS yt, s * 10 + 5 AS yp FROM {ORD_SQL})""")
def q_m7(spark, sf):
    d = ord_scored(spark, sf).select((F.col("o_totalprice") / 1000).alias("yt"), (F.col("s") * 10 + 5).alias("yp"))
    return r6(M.regression_summary(d, "yt", "yp", "orders"))


@query("m8_error_analysis_orders", "\nUNION ALL ".join(f"""
SELECT '{kind}' AS kind, 'o_totalprice' AS column_name, count(o_totalprice) AS count, round(avg(o_totalprice), 2) AS mean,
       round(stddev_samp(o_totalprice), 2) AS std, round(min(o_totalprice), 2) AS min,
       round(quantile_cont(o_totalprice, 0.25), 2) AS q25, round(quantile_cont(o_totalprice, 0.5), 2) AS q50,
       round(quantile_cont(o_totalprice, 0.75), 2) AS q75, round(max(o_totalprice), 2) AS max
FROM {ORD_SQL} WHERE {cond}""" for kind, cond in (("false_negative", "y = 1 AND p = 0"),
                                                 ("false_positive", "y = 0 AND p = 1"))))
def q_m8(spark, sf):
    return M.error_analysis(ord_scored(spark, sf), "y", "p", ["o_totalprice"])


@query("m13_curve_points_orders", f"""
WITH g AS (SELECT s, sum(y) AS pos, sum(1 - y) AS neg FROM {ORD_SQL} GROUP BY s),
t AS (SELECT sum(pos) AS P, sum(neg) AS N FROM g),
c AS (SELECT s AS threshold, sum(pos) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS tp,
             sum(neg) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS fp FROM g
      UNION ALL SELECT 'Infinity'::DOUBLE, 0, 0)
SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(fp / N, 6) AS fpr, round(tp / P, 6) AS tpr,
       round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 1.0 END, 6) AS precision, round(tp / P, 6) AS recall
FROM c, t""")
def q_m13(spark, sf):
    return r6(M.curve_points(ord_scored(spark, sf), "y", "s"))


@query("m15_round_numeric_orders", """
SELECT o_orderkey, round(o_totalprice / 7, 4) AS v FROM orders""")
def q_m15(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", (F.col("o_totalprice") / 7).alias("v"))
    return M.round_numeric(o, 4)


# ------------------------------------------------------------------ sampling

MD5_ORD = "md5('42|' || CAST(o_orderkey AS VARCHAR))"


@query("f8_stratified_split_orders", f"""
SELECT o_orderkey, o_orderstatus,
       row_number() OVER (PARTITION BY o_orderstatus ORDER BY {MD5_ORD})
         <= floor(0.2 * count(*) OVER (PARTITION BY o_orderstatus) + 0.5) AS is_test
FROM orders""")
def q_f8(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return S.stratified_split(o, "o_orderkey", "o_orderstatus", 0.2)


@query("f9_random_split_orders", f"""
SELECT o_orderkey, row_number() OVER (ORDER BY {MD5_ORD}) <= ceil(0.2 * count(*) OVER ()) AS is_test FROM orders""")
def q_f9(spark, sf):
    return S.random_split(load(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.2)


@query("f10_stratified_folds_orders", f"""
SELECT o_orderkey, o_orderstatus,
       CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY {MD5_ORD}) - 1) % 5 AS INTEGER) AS fold
FROM orders""")
def q_f10(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return S.stratified_folds(o, "o_orderkey", "o_orderstatus", 5)


@query("f12_balanced_weights_orders", """
SELECT o_orderkey, o_orderstatus,
       round(CAST(count(*) OVER () AS DOUBLE) / (3 * count(*) OVER (PARTITION BY o_orderstatus)), 6) AS weight
FROM orders""")
def q_f12(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return r6(S.balanced_weights(o, "o_orderstatus"))


@query("f13_partial_labels_quality", """
SELECT doc_id, quality, row_number() OVER (ORDER BY md5('42|' || CAST(doc_id AS VARCHAR)))
         <= greatest(2, CAST(floor(count(*) OVER () * 0.1) AS BIGINT)) AS is_labeled,
       CASE WHEN row_number() OVER (ORDER BY md5('42|' || CAST(doc_id AS VARCHAR)))
         <= greatest(2, CAST(floor(count(*) OVER () * 0.1) AS BIGINT)) THEN quality ELSE -1 END AS partial_label
FROM labels""")
def q_f13(spark, sf):
    lab = load(spark, sf, "labels").select("doc_id", "quality")
    return S.partial_labels(lab, "doc_id", "quality", 0.1)


@query("m4_summary_without_scores_lineitem", f"""
WITH {PC_SQL}
SELECT 'lineitem' AS Model, round(sum(tp) / sum(nt), 6) AS Accuracy, round(avg(pr), 6) AS Precision,
       round(avg(rc), 6) AS Recall, round(avg(f1), 6) AS F1,
       CAST(NULL AS DOUBLE) AS ROC_AUC, CAST(NULL AS DOUBLE) AS PR_AUC FROM pf""")
def q_m4(spark, sf):
    return r6(M.classification_summary(li_scored(spark, sf), "y", "p", None, model_name="lineitem"))


def _report_rows(table):
    return "\nUNION ALL ".join(f"SELECT 'report' AS part, class AS row, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM {table} WHERE {m} IS NOT NULL"
                               for m in ("precision", "recall", "f1", "support"))


@query("l7_whole_evaluation_fixed_predictions_lineitem", f"""
WITH rep AS ({ORACLES["m6_classification_report_lineitem"]}),
cf AS ({ORACLES["m5_confusion_matrix_lineitem"]}),
sm AS ({ORACLES["m1_classification_summary_multiclass_lineitem"]})
{_report_rows("rep")}
UNION ALL SELECT 'confusion', CAST(label AS VARCHAR), metric, CAST(value AS DOUBLE) FROM (UNPIVOT cf ON pred_0, pred_1, pred_2 INTO NAME metric VALUE value)
UNION ALL SELECT 'summary', Model, metric, value FROM (UNPIVOT sm ON Accuracy, Precision, Recall, F1, ROC_AUC, PR_AUC INTO NAME metric VALUE value)""")
def q_l7_whole(spark, sf):
    from tessera.operators.models import evaluate_predictions, evaluation_long
    pred = li_scored(spark, sf).select(F.col("y").cast("double").alias("label"), F.col("p").cast("double").alias("prediction"), F.col("prob").alias("probability"))
    return r6(evaluation_long(evaluate_predictions(pred, "lineitem")))


# predictions of a price from its band of ten thousand: the middle, the lower end, twenty thousand below
REGRESSION_GUESSES = {"middle": "s * 10 + 5", "lower": "s * 10", "shifted": "s * 10 - 20"}


@query("t2_regression_table_fixed_predictions_orders", "\nUNION ALL ".join(f"""
SELECT '{name}' AS Model, round(avg(abs(yt - yp)), 4) AS MAE, round(sqrt(avg((yt - yp) * (yt - yp))), 4) AS RMSE,
       round(1 - sum((yt - yp) * (yt - yp)) / (var_pop(yt) * count(yt)), 4) AS R2
FROM (SELECT o_totalprice / 1000 AS yt, {guess} AS yp FROM {ORD_SQL})""" for name, guess in REGRESSION_GUESSES.items()))
def q_t2_fixed(spark, sf):
    from tessera.plans.report import summarize_regression
    d = ord_scored(spark, sf)
    return summarize_regression([M.regression_summary(d.select((F.col("o_totalprice") / 1000).alias("yt"), F.expr(guess).alias("yp")), "yt", "yp", name)
                                 for name, guess in REGRESSION_GUESSES.items()])

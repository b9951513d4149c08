"""Registered queries for models (L*), SMOTE (F11) and semi-supervised (P*).

Binding: documents joined with labels.  Four text statistics (characters,
words, '!' count, lines) standardised with the cleaning scaler predict
``quality``.  Model outputs have no SQL oracle (checked by invariants in the
tests); the SMOTE class counts and the pseudo-label risk table do.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tessera.functions import metrics as M
from tessera.operators import clean as C
from tessera.operators import models as L
from tessera.operators import sampling as S
from tessera.operators import semi as P
from tessera.plans.catalog import load, query, r6
from tessera.session import cut_lineage

DOC_FEATS = ["n_chars", "n_words", "n_bang", "n_lines"]


def doc_stats(spark, sf, how="inner"):
    d = load(spark, sf, "documents")
    d = d.select("doc_id", F.col("n_chars").cast("double").alias("n_chars"),
                 F.size(F.split("text", r"\s+")).cast("double").alias("n_words"),
                 (F.length("text") - F.length(F.regexp_replace("text", "!", ""))).cast("double").alias("n_bang"),
                 F.size(F.split("text", "\n")).cast("double").alias("n_lines"))
    lab = load(spark, sf, "labels").select("doc_id", "quality")
    d = cut_lineage(d.join(lab, "doc_id", how))     # the scaler makes a pass of its own: texts are parsed once
    d = C.scale(d, DOC_FEATS, "standard")
    asm = VectorAssembler(inputCols=DOC_FEATS, outputCol="features")
    out = asm.transform(d).withColumn("label", F.col("quality").cast("double"))
    # scaled rows feed many small model jobs: cut the plan
    return cut_lineage(out.select(F.col("doc_id").alias("id"), "features", "label", *DOC_FEATS))


def doc_split(spark, sf):
    d = doc_stats(spark, sf)
    return S.train_test(S.stratified_split(d, "id", "label", 0.2))


def _pred(model, test):
    return model.transform(test).select("id", "label", "prediction", "probability")


@query("l1_logistic_regression_documents")
def q_l1(spark, sf):
    tr, te = doc_split(spark, sf)
    return _pred(L.fit_logistic(tr), te)


@query("l2_rbf_svm_documents")
def q_l2(spark, sf):
    tr, te = doc_split(spark, sf)
    return _pred(L.fit_rbf_svm(tr), te)


@query("l3_random_forest_documents")
def q_l3(spark, sf):
    tr, te = doc_split(spark, sf)
    return _pred(L.fit_random_forest(tr, n_trees=200, max_depth=10), te)


@query("l4_boosted_trees_documents")
def q_l4(spark, sf):
    tr, te = doc_split(spark, sf)
    return _pred(L.fit_boosted_trees(tr), te)


@query("l4_boosted_trees_multiclass_orders")
def q_l4b(spark, sf):
    o = load(spark, sf, "orders")
    d = o.select(F.col("o_orderkey").alias("id"),
                 F.when(F.col("o_orderstatus") == "F", 0.0).when(F.col("o_orderstatus") == "O", 1.0)
                  .otherwise(2.0).alias("label"),
                 (F.col("o_totalprice") / 100000).alias("p"),
                 F.dayofyear("o_orderdate").cast("double").alias("doy"),
                 F.year("o_orderdate").cast("double").alias("yr"))
    d = VectorAssembler(inputCols=["p", "doy", "yr"], outputCol="features").transform(d)
    tr, te = S.train_test(S.stratified_split(d, "id", "label", 0.2))
    return _pred(L.fit_boosted_trees(tr), te)


@query("l5_cross_validation_documents")
def q_l5(spark, sf):
    tr, _ = doc_split(spark, sf)
    folds = S.stratified_folds(tr, "id", "label", 5)
    return r6(L.cross_validate(folds, L.CLASSIFIERS, k=5, use_smote=True, id_col="id", parallelism=5))


@query("l7_evaluate_final_model_documents")
def q_l7(spark, sf):
    tr, te = doc_split(spark, sf)
    reg = L.ModelRegistry()
    m = reg.train_final(tr, "Random Forest", use_smote=True, id_col="id", n_trees=200)
    return r6(L.evaluate(m, te, "Random Forest"))


@query("l8_tune_random_forest_documents")
def q_l8(spark, sf):
    tr, _ = doc_split(spark, sf)
    folds = S.stratified_folds(tr, "id", "label", 5)
    _, table, _ = L.tune(folds, "Random Forest", parallelism=5)
    return r6(table)


@query("l13_regression_comparison_documents")
def q_l13(spark, sf):
    d = doc_stats(spark, sf)
    d = VectorAssembler(inputCols=["n_words", "n_bang", "n_lines"], outputCol="rfeat").transform(d)
    d = d.select("id", F.col("rfeat").alias("features"), F.col("n_chars").alias("label"), F.col("label").alias("cls"))
    tr, te = S.train_test(S.stratified_split(d, "id", "cls", 0.2))
    from tessera.plans.report import summarize_regression
    return summarize_regression(L.regression_comparison(tr.drop("cls"), te.drop("cls")))


LINE_SQL = """SELECT count(*) AS n, avg(x) AS mx, avg(y) AS my, covar_pop(x, y) * count(*) AS sxy, var_pop(x) * count(*) AS sxx
FROM (SELECT l_quantity / 50.0::DOUBLE AS x, l_extendedprice / 100000.0::DOUBLE AS y FROM lineitem)"""


def _line(spark, sf, fit):
    """Coefficient and intercept of price on quantity."""
    li = load(spark, sf, "lineitem").select((F.col("l_quantity") / 50.0).alias("x"), (F.col("l_extendedprice") / 100000.0).alias("label"))
    m = fit(VectorAssembler(inputCols=["x"], outputCol="features").transform(li)).spark_model
    return r6(spark.createDataFrame([(float(m.coefficients[0]), float(m.intercept))], "slope double, intercept double"))


@query("l10_linear_regression_lineitem", f"""
SELECT round(sxy / sxx, 6) AS slope, round(my - sxy / sxx * mx, 6) AS intercept FROM ({LINE_SQL})""")
def q_l10(spark, sf):
    return _line(spark, sf, L.fit_linear)


@query("l11_ridge_regression_lineitem", f"""
SELECT round(sxy / (sxx + 500.0), 6) AS slope, round(my - sxy / (sxx + 500.0) * mx, 6) AS intercept FROM ({LINE_SQL})""")
def q_l11(spark, sf):
    return _line(spark, sf, lambda d: L.fit_ridge(d, alpha=500.0))


@query("l14_feature_importance_documents")
def q_l14(spark, sf):
    tr, _ = doc_split(spark, sf)
    return r6(L.feature_importance(L.fit_random_forest(tr, n_trees=200), DOC_FEATS))


@query("l15_classification_comparison_documents")
def q_l15(spark, sf):
    from tessera.plans.report import summarize_classification
    tr, te = doc_split(spark, sf)
    res = [L.evaluate(L.fit_logistic(tr), te), L.evaluate(L.fit_random_forest(tr, n_trees=200), te),
           L.evaluate(L.fit_boosted_trees(tr), te), L.evaluate(L.fit_rbf_svm(tr), te)]
    return summarize_classification(res)


@query("f11_smote_class_counts_documents", """
WITH c AS (SELECT CAST(quality AS DOUBLE) AS label, count(*) AS n FROM documents d JOIN labels l USING (doc_id)
           GROUP BY 1)
SELECT label, (SELECT max(n) FROM c) AS n, (SELECT max(n) FROM c) - n AS n_synthetic FROM c""")
def q_f11(spark, sf):
    d = doc_stats(spark, sf)
    out = L.smote(d.select("id", "features", "label"), "id")
    return out.groupBy("label").agg(F.count(F.lit(1)).alias("n"),
                                    F.count_if("synthetic").cast("long").alias("n_synthetic"))


# ------------------------------------------------------------------ semi-supervised

@query("p1_self_training_documents")
def q_p1(spark, sf):
    d = doc_stats(spark, sf, how="left").withColumn(
        "partial_label", F.coalesce(F.col("label").cast("int"), F.lit(-1)))
    _, pseudo = P.self_training(d, P.base_learner("SVM"), threshold=0.85, max_iter=10, id_col="id")
    return pseudo


GRAPH_SQL = """
WITH e AS (SELECT vec_id AS i, CAST(embedding AS DOUBLE[]) AS x,
                  CASE WHEN row_number() OVER (ORDER BY md5('42|' || CAST(vec_id AS VARCHAR))) <= greatest(2, CAST(floor(count(*) OVER () * 0.1) AS BIGINT))
                       THEN label ELSE -1 END AS p FROM embeddings),
cl AS (SELECT DISTINCT p AS c FROM e WHERE p <> -1),
w AS (SELECT a.i AS a, b.i AS b, exp(-20.0 * list_distance(a.x, b.x) ** 2) AS w FROM e a JOIN e b
      ON list_distance(a.x, b.x) <= sqrt(-ln(1e-12) / 20.0) {no_loops}),
d AS (SELECT a AS i, sum(w) AS d FROM w GROUP BY a),
s AS (SELECT w.a, w.b, {scaled} AS s FROM w JOIN d da ON w.a = da.i JOIN d db ON w.b = db.i),
y AS (SELECT i, c, p, CASE WHEN p = c THEN 1.0 ELSE 0.0 END AS y FROM e, cl),
r1 AS (SELECT y.i, y.c, y.p, y.y, coalesce(q.v, 0.0) AS v FROM y
       LEFT JOIN (SELECT s.a AS i, y.c, sum(s.s * y.y) AS v FROM s JOIN y ON s.b = y.i GROUP BY 1, 2) q ON y.i = q.i AND y.c = q.c),
f1 AS (SELECT i, c, p, y, {step} AS f FROM r1),
r2 AS (SELECT f1.i, f1.c, f1.p, f1.y, coalesce(q.v, 0.0) AS v FROM f1
       LEFT JOIN (SELECT s.a AS i, f1.c, sum(s.s * f1.f) AS v FROM s JOIN f1 ON s.b = f1.i GROUP BY 1, 2) q ON f1.i = q.i AND f1.c = q.c),
f2 AS (SELECT i, c, {step} AS f FROM r2),
tot AS (SELECT i, sum(f) AS t FROM f2 GROUP BY i),
near AS (SELECT a.i, first(b.p ORDER BY list_distance(a.x, b.x), b.i) AS c FROM e a JOIN e b ON b.p <> -1 GROUP BY a.i),
o AS (SELECT f2.i, f2.c, CASE WHEN t > 0 THEN f / t WHEN near.c = f2.c THEN 1.0 ELSE 0.0 END AS q
      FROM f2 JOIN tot ON f2.i = tot.i JOIN near ON f2.i = near.i)
SELECT i AS id, round(max(q), 6) AS top, round(sum(q * (c + 1)), 6) AS centre FROM o GROUP BY i
"""
SPREADING_SQL = GRAPH_SQL.format(no_loops="AND a.i <> b.i", scaled="w.w / sqrt(da.d * db.d)", step="0.2 * v + 0.8 * y")
PROPAGATION_SQL = GRAPH_SQL.format(no_loops="", scaled="w.w / da.d",
                                   step="CASE WHEN p <> -1 THEN y WHEN sum(v) OVER (PARTITION BY i) > 0 THEN v / sum(v) OVER (PARTITION BY i) ELSE 0.0 END")


def _two_rounds(spark, sf, method):
    """Two rounds of the label graph: each row's largest class share and the mean of its classes (plus 1)."""
    e = load(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"), "label")
    part = S.partial_labels(e, "id", "label", 0.1)
    classes = sorted(r[0] for r in part.filter("partial_label <> -1").select("partial_label").distinct().collect())
    fit = P.label_graph_fit(part, "id", method=method, gamma=20.0, alpha=0.2, max_iter=2, tol=0.0)
    q = F.col("label_distribution")
    centre = sum((q[k] * float(c + 1) for k, c in enumerate(classes)), F.lit(0.0))
    return r6(fit.select("id", F.array_max(q).alias("top"), centre.alias("centre")))


@query("p3_label_spreading_two_rounds_embeddings", SPREADING_SQL)
def q_p3_rounds(spark, sf):
    return _two_rounds(spark, sf, "spreading")


@query("p4_label_propagation_two_rounds_embeddings", PROPAGATION_SQL)
def q_p4_rounds(spark, sf):
    return _two_rounds(spark, sf, "propagation")


@query("p3_label_spreading_embeddings")
def q_p3(spark, sf):
    e = load(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"), "label")
    part = S.partial_labels(e, "id", "label", 0.1)
    return P.label_graph_fit(part, "id", method="spreading", gamma=20.0, alpha=0.2, cell_target=100)


@query("p4_label_propagation_embeddings")
def q_p4(spark, sf):
    e = load(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"), "label")
    part = S.partial_labels(e, "id", "label", 0.1)
    return P.label_graph_fit(part, "id", method="propagation", gamma=20.0, cell_target=100)


@query("p5_supervised_only_documents")
def q_p5(spark, sf):
    tr, te = doc_split(spark, sf)
    part = S.partial_labels(tr, "id", "label", 0.2)
    return _pred(P.supervised_only(part), te)


@query("p6_learning_curve_documents")
def q_p6(spark, sf):
    tr, te = doc_split(spark, sf)
    return r6(P.learning_curve(tr, te, "id", P.base_learner("SVM")))


@query("p7_pseudo_label_risk_labels", """
WITH r AS (SELECT doc_id, quality, toxic,
             CASE WHEN row_number() OVER (ORDER BY md5('42|' || CAST(doc_id AS VARCHAR)))
                       <= greatest(2, CAST(floor(count(*) OVER () * 0.1) AS BIGINT)) THEN quality ELSE -1 END AS pl
           FROM labels),
p AS (SELECT *, CASE WHEN pl <> -1 THEN pl WHEN toxic = 1 THEN -1 ELSE 1 END AS pseudo FROM r)
SELECT count(*) FILTER (WHERE pl = -1) AS n_unlabeled,
       count(*) FILTER (WHERE pl = -1 AND pseudo <> -1) AS n_pseudo_labeled,
       count(*) FILTER (WHERE pl = -1 AND pseudo <> quality) AS n_wrong_pseudo,
       count(*) FILTER (WHERE pl = -1 AND pseudo <> -1 AND pseudo <> quality) AS n_wrong_among_pseudo,
       round(count(*) FILTER (WHERE pl = -1 AND pseudo <> quality) / greatest(count(*) FILTER (WHERE pl = -1), 1), 6)
         AS error_rate,
       round(count(*) FILTER (WHERE pl = -1 AND pseudo <> -1 AND pseudo <> quality)
             / greatest(count(*) FILTER (WHERE pl = -1 AND pseudo <> -1), 1), 6) AS error_rate_among_pseudo
FROM p""")
def q_p7(spark, sf):
    lab = load(spark, sf, "labels")
    part = S.partial_labels(lab, "doc_id", "quality", 0.1)
    part = part.withColumn("pseudo", F.when(F.col("partial_label") != -1, F.col("partial_label"))
                           .when(F.col("toxic") == 1, F.lit(-1)).otherwise(F.lit(1)))
    return r6(P.pseudo_label_risk(part, "partial_label", "pseudo", "quality"))

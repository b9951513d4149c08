import pytest
from pyspark.sql import functions as F

from tessera.functions import metrics as M
from tessera.operators import rules as A
from tests.conftest import approx

TX = [(1, ["a", "b", "c"]), (2, ["a", "b"]), (3, ["a", "c"]), (4, ["a", "b", "c"])]


def _sets(df):
    return {tuple(r["items"]): round(r["support"], 6) for r in df.collect()}


def test_h10_itemsets_apriori_equals_fpgrowth(spark):
    tx = spark.createDataFrame(TX, "tid int, items array<string>")
    exp = {("a",): 1.0, ("b",): .75, ("c",): .75, ("a", "b"): .75, ("a", "c"): .75, ("b", "c"): .5,
           ("a", "b", "c"): .5}
    assert _sets(A.frequent_itemsets(tx, min_support=0.5)) == exp
    assert _sets(A.fpgrowth_itemsets(tx, min_support=0.5)) == exp
    assert _sets(A.frequent_itemsets(tx, min_support=0.5, max_len=1)) == {k: v for k, v in exp.items() if len(k) == 1}


def test_h11_rules(spark):
    tx = spark.createDataFrame(TX, "tid int, items array<string>")
    fi = A.frequent_itemsets(tx, min_support=0.5)
    allr = A.generate_rules(fi, 0.0)
    assert allr.count() == 12
    r = {(tuple(x["antecedents"]), tuple(x["consequents"])): x for x in allr.collect()}
    assert approx(r[(("b",), ("a", "c"))]["confidence"], 0.666667, 1e-5)
    assert approx(r[(("b",), ("a", "c"))]["lift"], 0.888889, 1e-5)
    assert approx(r[(("a",), ("b", "c"))]["confidence"], 0.5) and approx(r[(("a",), ("b", "c"))]["lift"], 1.0)


def test_h12_membership_not_text(spark):
    rules = spark.createDataFrame([(["x"], ["no_disease"], 1.0)], "antecedents array<string>, consequents array<string>, lift double")
    assert A.rules_with_consequent(rules, "disease").count() == 0


def test_a11_empty_rules_schema(spark):
    e = A.empty_rules(spark)
    assert e.count() == 0 and A.rules_summary(e).first()["n_rules"] == 0


def test_h13_average_precision_and_auc(spark):
    df = spark.createDataFrame(list(zip([.9, .8, .7, .6, .5], [1, 0, 1, 0, 1])), "s double, y int")
    auc, ap = M.rank_metrics(df, "y", "s")
    assert approx(ap, 0.755556, 1e-5) and approx(auc, 0.5)


def test_h14_all_ties(spark):
    df = spark.createDataFrame([(0.3, 1), (0.3, 0), (0.3, 1), (0.3, 0)], "s double, y int")
    auc, ap = M.rank_metrics(df, "y", "s")
    assert approx(auc, 0.5) and approx(ap, 0.5)


def test_h15_multiclass_macro(spark):
    df = spark.createDataFrame(list(zip([0, 0, 1, 2], [0, 1, 1, 1])), "y int, p int")
    s = M.classification_summary(df, "y", "p").first()
    assert approx(s["Accuracy"], .5) and approx(s["Precision"], .444444, 1e-5)
    assert approx(s["Recall"], .5) and approx(s["F1"], .388889, 1e-5)
    cm = [tuple(r)[1:] for r in M.confusion_matrix(df, "y", "p").orderBy("label").collect()]
    assert cm == [(1, 1, 0), (0, 1, 0), (0, 1, 0)]
    assert s["ROC_AUC"] is None  # M4: no scores -> null


def test_h16_r2_constant(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0)], "y double, p double")
    assert M.regression_summary(df, "y", "p").first()["R2"] == 0.0


def test_curve_points(spark):
    df = spark.createDataFrame(list(zip([.9, .8, .7], [1, 0, 1])), "s double, y int")
    c = M.curve_points(df, "y", "s").orderBy(F.desc("threshold")).collect()
    assert [(r["fpr"], r["tpr"]) for r in c] == [(0.0, 0.0), (0.0, 0.5), (1.0, 0.5), (1.0, 1.0)]
    assert c[0]["precision"] == 1.0 and c[0]["recall"] == 0.0


def test_ovr_matches_binary_per_class(spark):
    rows = [(0, [0.7, 0.2, 0.1]), (1, [0.2, 0.5, 0.3]), (2, [0.1, 0.3, 0.6]), (1, [0.3, 0.4, 0.3]),
            (0, [0.4, 0.4, 0.2]), (2, [0.2, 0.2, 0.6])]
    df = spark.createDataFrame(rows, "y int, prob array<double>")
    auc, ap = M.rank_metrics_ovr(df, "y", "prob")
    per = []
    for c in range(3):
        b = df.select((F.col("y") == c).cast("int").alias("t"), F.col("prob")[c].alias("s"))
        per.append(M.rank_metrics(b, "t", "s"))
    assert approx(auc, sum(p[0] for p in per) / 3) and approx(ap, sum(p[1] for p in per) / 3)


def test_classification_report(spark):
    df = spark.createDataFrame(list(zip([0, 0, 1, 2], [0, 1, 1, 1])), "y int, p int")
    rep = {r["class"]: r for r in M.classification_report(df, "y", "p").collect()}
    assert approx(rep["accuracy"]["f1"], 0.5) and rep["macro avg"]["support"] == 4


@pytest.mark.parametrize("seed,support,max_len", [(1, 0.2, 4), (2, 0.05, None), (3, 0.5, 3), (4, 0.3, 1)])
def test_apriori_against_counting_all_sets(spark, seed, support, max_len):
    import itertools
    import random
    from collections import Counter
    g = random.Random(seed)
    rows = [[x for x in "abcdefg" if g.random() < 0.55] + ["a"] for _ in range(40)] + [["a", "c", "d", "e"]] * 37 + [[], None, ["z", None, "z"]]
    df = spark.createDataFrame([(r,) for r in rows], "items array<string>").repartition(5)
    got = {tuple(r["items"]): (r["freq"], r["support"], r["length"]) for r in A.frequent_itemsets(df, "items", support, max_len).collect()}
    n = Counter(s for r in rows for t in [sorted({x for x in r or [] if x})] for k in range(1, min(len(t), max_len or 9) + 1) for s in itertools.combinations(t, k))
    assert got == {s: (c, c / len(rows), len(s)) for s, c in n.items() if c / len(rows) >= support}


def test_apriori_of_no_rows_and_no_frequent_items(spark):
    none = spark.createDataFrame([], "items array<string>")
    assert A.frequent_itemsets(none, "items", 0.1).count() == 0
    lone = spark.createDataFrame([([str(i)],) for i in range(30)], "items array<string>")
    assert A.frequent_itemsets(lone, "items", 0.5).count() == 0 and A.frequent_itemsets(lone, "items", 0.01).count() == 30

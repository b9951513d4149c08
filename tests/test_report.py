from tessera.plans import report as T


def test_result_tables(spark):
    c = [spark.createDataFrame([(n, .5, .4, .3, .2, .1, p)], "Model string, Accuracy double, Precision double, "
                               "Recall double, F1 double, ROC_AUC double, PR_AUC double") for n, p in
         (("a", 0.123456), ("b", 0.9))]
    t1 = T.summarize_classification(c).collect()
    assert [r["Model"] for r in t1] == ["b", "a"] and t1[1]["PR_AUC"] == 0.1235
    r = [spark.createDataFrame([(n, m, 1.0, 0.5)], "Model string, MAE double, RMSE double, R2 double")
         for n, m in (("x", 2.0), ("y", 1.0))]
    assert [x["Model"] for x in T.summarize_regression(r).collect()] == ["y", "x"]
    k = T.summarize_clustering([spark.createDataFrame([("KMeans", 0.2)], "Algorithm string, Silhouette double"),
                                spark.createDataFrame([("DBSCAN", "err")], "Algorithm string, error string")])
    assert k.count() == 2 and set(k.columns) == {"Algorithm", "Silhouette", "error"}
    rules = spark.createDataFrame([(["a"], ["b"], 0.5, 0.8, 2.0)], "antecedents array<string>, "
                                  "consequents array<string>, support double, confidence double, lift double")
    assert T.rule_bars(rules).first()["rule"] == "a → b"
    pred = spark.createDataFrame([(1.0, 0.5), (2.0, 2.5)], "label double, prediction double")
    assert sorted(x["residual"] for x in T.residuals(pred).collect()) == [-0.5, 0.5]
    assert T.residual_histogram(pred, bins=2).count() == 2

import pytest
from pyspark.sql import functions as F

from tessera.operators import clean as C
from tessera.operators import features as FE
from tessera.operators import profile as E
from tests.conftest import approx

X = [(1, 1.0), (2, 2.0), (3, 3.0), (4, 10.0)]


def col(df, c, order="id"):
    return [r[0] for r in df.orderBy(order).select(c).collect()]


def test_h2_standard_scale(spark):
    df = spark.createDataFrame(X, "id int, x double")
    got = col(C.scale(df, ["x"], "standard"), "x")
    for g, e in zip(got, [-0.848528, -0.565685, -0.282843, 1.697056]):
        assert approx(g, e, 1e-6)


def test_h3_robust_scale(spark):
    df = spark.createDataFrame(X, "id int, x double")
    got = col(C.scale(df, ["x"], "robust"), "x")
    for g, e in zip(got, [-0.5, -0.166667, 0.166667, 2.5]):
        assert approx(g, e, 1e-5)


def test_h1_iqr_removes_outlier(spark):
    df = spark.createDataFrame(X, "id int, x double")
    assert col(C.iqr_filter(df, ["x"]), "x") == [1.0, 2.0, 3.0]


def test_h4_constant_column(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 5.0)], "id int, x double")
    for m in ("standard", "minmax", "robust"):
        assert col(C.scale(df, ["x"], m), "x") == [0.0, 0.0, 0.0]
    assert C.zscore_filter(df, ["x"]).count() == 0
    assert C.iqr_filter(df, ["x"]).count() == 3
    assert C.remove_outliers(df, ["x"], "none").count() == 3


def test_h5_mode_smallest_on_tie(spark):
    df = spark.createDataFrame([(2,), (2,), (1,), (1,), (3,), (None,)], "c int")
    assert C.most_frequent(df, "c") == 1
    fn, fc = C.fit_impute(df, [], ["c"])
    assert sorted(col(C.apply_impute(df, fn, fc), "c", "c")) == [1, 1, 1, 2, 2, 3]


def test_h6_encode_text(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a"), (4, "b")], "id int, c string")
    codes = C.fit_codes(df, ["c"])
    assert col(C.encode_categoricals(df, ["c"], codes), "c") == [1, -1, 0, 1]
    # unseen text at transform time -> -1 (fitted map is kept)
    new = spark.createDataFrame([(5, "z")], "id int, c string")
    assert col(C.encode_categoricals(new, ["c"], codes), "c") == [-1]


def test_fit_transform_order_and_transform(spark):
    rows = [(i, float(v), c) for i, (v, c) in enumerate([(1, "x"), (2, "y"), (0, "x"), (3, "y"), (100, "x"),
                                                        (2, "y"), (2, "y")])]
    df = spark.createDataFrame(rows, "id int, v double, c string")
    out, model = C.fit_transform(df, ["v"], ["c"], sentinels={"v": 0.0})
    # imputed 2 for the sentinel; Q1 2, Q3 2.5 -> fences [1.25, 3.25] drop 1 and 100
    assert out.count() == 5
    assert model.feature_names() == ["v", "c"]
    t = model.transform(spark.createDataFrame([(9, 0.0, "y")], "id int, v double, c string")).first()
    assert t["c"] == 1 and approx(t["v"], (model.fill_num["v"] - model.scaler["v"][0]) / model.scaler["v"][1])


def test_h7_h8_bins(spark):
    df = spark.createDataFrame([(float(v),) for v in [-1, 0, 0.9, 1, 2, 5.9, 6]], "oldpeak double")
    got = col(FE.discretize_all(df), "oldpeak_bin", "oldpeak")
    assert got == ["zero", "mild", "mild", "moderate", "severe", "severe", None]
    ages = spark.createDataFrame([(a,) for a in [39, 40, 69, 70, 99, 100]], "age int")
    assert col(FE.discretize_all(ages), "age_bin", "age") == ["<40", "40-50", "60-70", "70+", "70+", None]


def test_h9_transactions(spark):
    df = spark.createDataFrame([(50, None, 2, 1.0)], "age int, chol int, target int, ca double")
    items = FE.transactions(df).first()["items"]
    assert items == ["age=50-60", "ca=1", "unknown"]
    assert not any(i.startswith("chol=") for i in items)


def test_onehot(spark):
    tx = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["c"])], "tid int, items array<string>")
    m = FE.onehot_matrix(tx, "tid").orderBy("tid").collect()
    assert m[0].asDict() == {"tid": 1, "a": True, "b": True, "c": False}


def test_describe_and_profile(spark):
    df = spark.createDataFrame(X, "id int, x double")
    d = E.describe(df, ["x"]).first()
    assert (d["count"], d["q25"], d["q50"], d["q75"], d["max"]) == (4, 1.75, 2.5, 4.75, 10.0)
    h = E.histogram(df, ["x"], bins=3).orderBy("bin").collect()
    assert [r["count"] for r in h] == [3, 0, 1]
    assert E.missing_counts(spark.createDataFrame([(None, 1)], "a int, b int"), only_positive=True).count() == 1


def test_missing_column_validation(spark):
    from tessera.sources.io import validate_schema
    with pytest.raises(ValueError, match="missing columns"):
        validate_schema(spark.createDataFrame([(1,)], "a int"), ["a", "b"])


def test_e4_types_and_f7_xy(spark):
    df = spark.createDataFrame([(63, 1, 145.0, 1), (40, 0, 120.0, 0)], "age int, sex int, trestbps double, target int")
    types = {r["column"]: r["dtype"] for r in E.column_types(df).collect()}
    assert types == {"age": "int", "sex": "int", "trestbps": "double", "target": "int"}
    xy = FE.get_X_y(df).collect()
    assert len(xy[0]["features"]) == 3 and xy[0]["label"] == 1.0  # absent preset columns are skipped
    assert "label" not in FE.get_X_y(df.drop("target")).columns
    ex = FE.get_X_y(df.withColumns({c: df["age"] for c in ["cp", "chol", "thalach", "exang", "oldpeak"]}),
                    extra_features=True).first()
    assert len(ex["features"]) == 13


def test_codes_of_many_categories(spark):
    n = 20_000
    df = spark.range(2 * n).select((F.col("id") % n).cast("string").alias("c"), F.lit(1).alias("one"))
    codes = C.fit_codes(df, ["c", "one"])
    assert list(codes) == ["c"]
    want = {v: i for i, v in enumerate(sorted(str(i) for i in range(n)))}
    assert {r["v"]: r["code"] for r in codes["c"].collect()} == want
    new = spark.createDataFrame([("0",), ("19999",), ("unseen",), (None,)], "c string")
    got = {r["k"]: r["c"] for r in C.encode_categoricals(new.withColumn("k", F.col("c")), ["c"], codes).collect()}
    assert got == {"0": 0, "19999": want["19999"], "unseen": -1, None: -1}


def test_codes_of_an_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "c string")
    codes = C.fit_codes(df, ["c"])
    assert codes["c"].count() == 0 and [r["c"] for r in C.encode_categoricals(df, ["c"], codes).collect()] == [-1, -1]


def test_onehot_sparse_of_many_items(spark):
    tx = spark.range(2_000).select(F.col("id").alias("tid"), F.transform(F.sequence(F.lit(0), F.lit(9)), lambda k: F.format_string("i%05d", F.col("id") * 10 + k)).alias("items"))
    rows, codes = FE.onehot_sparse(tx, "tid")
    got = {r["tid"]: r["onehot"] for r in rows.collect()}
    assert codes.count() == 20_000 and len(got) == 2_000
    assert all(v.size == 20_000 and v.indices.tolist() == list(range(10 * t, 10 * t + 10)) for t, v in got.items())
    new = spark.createDataFrame([(1, ["i00003", "i00003", "unseen", None]), (2, []), (3, None)], "tid long, items array<string>")
    again = {r["tid"]: r["onehot"].indices.tolist() for r in FE.onehot_sparse(new, "tid", codes=codes)[0].collect()}
    assert again == {1: [3], 2: [], 3: []}


def test_correlation_gram_of_300_columns(spark):
    import numpy as np
    import pandas as pd
    g = np.random.default_rng(3)
    x = g.normal(1e6, 5.0, (200, 300)) + g.normal(0, 4.0, (200, 1))
    x[g.random(x.shape) < 0.1] = np.nan
    x[:, 7] = 2.5
    pdf = pd.DataFrame(x, columns=[f"x{i}" for i in range(300)])
    got = E.correlation_gram(spark.createDataFrame(pdf).repartition(5)).toPandas().pivot(index="col_a", columns="col_b", values="corr")
    want = pdf.corr().loc[got.index, got.columns]
    want.loc["x7"] = want["x7"] = np.nan
    np.testing.assert_allclose(got.to_numpy("f8"), want.to_numpy(), atol=1e-8)

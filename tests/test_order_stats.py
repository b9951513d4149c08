import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.functions import order_stats as OS
from tests.conftest import approx


def test_h1_quantiles(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    q = OS.exact_quantiles(df, ["x"], [0.25, 0.5, 0.75])
    assert (q[("x", 0.25)], q[("x", 0.5)], q[("x", 0.75)]) == (1.75, 2.5, 4.75)


def test_quantiles_match_numpy_with_refinement_and_hot_value(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.exponential(10, 6000), np.full(3000, 7.25)])  # a third of rows share one value
    rng.shuffle(x)
    y = rng.normal(size=len(x))
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y})).repartition(4)
    probs = [0.1, 0.25, 0.5, 0.75, 0.9]
    # tiny brackets force histogram passes and the final ranked pass
    q = OS.exact_quantiles(df, ["x", "y"], probs, max_bracket=50, bins=16)
    for c, v in (("x", x), ("y", y)):
        for p in probs:
            assert approx(q[(c, p)], float(np.quantile(v, p)), 1e-12)


def test_quantiles_nulls_and_empty(spark):
    df = spark.createDataFrame([(None,), (4.0,), (None,), (2.0,)], "x double")
    assert OS.exact_quantiles(df, ["x"], [0.5])[("x", 0.5)] == 3.0
    e = spark.createDataFrame([], "x double")
    assert OS.exact_quantiles(e, ["x"], [0.5])[("x", 0.5)] is None


def test_ordered_cumsum_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(OS, "TARGET_ROWS_PER_TASK", 50)  # force ~40 buckets
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 2000), "k": rng.permutation(2000).astype(float),
                        "v": rng.integers(0, 5, 2000)})
    df = spark.createDataFrame(pdf)
    out = OS.ordered_cumsum(df, "k", ["v"], by=["g"]).toPandas().sort_values(["g", "k"])
    exp = pdf.sort_values(["g", "k"]).assign(cum=lambda d: d.groupby("g")["v"].cumsum(),
                                              rn=lambda d: d.groupby("g").cumcount() + 1)
    assert list(out["cum_v"]) == list(exp["cum"])
    assert list(out["row_in_group"]) == list(exp["rn"])
    desc = OS.ordered_cumsum(df, "k", ["v"], descending=True, with_totals=True).toPandas().sort_values("k")
    assert list(desc["cum_v"]) == list(pdf.sort_values("k")["v"][::-1].cumsum()[::-1])
    assert set(desc["tot_v"]) == {pdf["v"].sum()}


@pytest.mark.parametrize("max_bracket,bins", [(200_000, 1024), (20, 4), (1, 2)])
def test_grouped_quantiles_against_numpy(spark, max_bracket, bins):
    rng = np.random.default_rng(bins)
    rows = []
    for g, n in (("a", 400), ("b", 1), ("c", 37), ("hot", 900), ("none", 3)):
        for i in range(n):
            x = None if g == "none" else float(rng.choice([rng.normal(), 7.0, 7.0]) if g == "hot" else rng.integers(-5, 6) * 1.5)
            rows.append((g, x, None if i % 3 else float("inf") if i % 2 else float(i)))
    rows += [(None, 1.0, 1.0), ("c", float("nan"), 2.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {(r["g"], r["c"]): (r["n"], r["q"]) for r in OS.grouped_quantiles(df, "g", ["x", "y"], probs, max_bracket=max_bracket, bins=bins).collect()}
    assert len(got) == 10
    for (g, c), (n, q) in got.items():
        v = [r["xy".index(c) + 1] for r in rows if r[0] == g]
        v = [x for x in v if x is not None and not np.isnan(x)]
        assert n == len(v)
        if not v:
            assert q == [None] * 5
        elif c == "x":
            assert np.allclose(q, np.quantile(v, probs), rtol=1e-12, atol=1e-12), (g, c)
        else:
            assert q[0] == min(v) and q[-1] == max(v)


def test_grouped_quantiles_of_many_groups(spark):
    n = 10_000
    df = spark.range(3 * n).select((F.col("id") % n).alias("k"), (F.floor(F.col("id") / n) * 2.0 + F.col("id") % n).alias("x"))
    out = OS.grouped_quantiles(df, "k", ["x"], [0.25, 0.5]).select("g", "n", F.col("q")[0].alias("a"), F.col("q")[1].alias("b"))
    assert out.count() == n and out.filter("n <> 3 OR a <> g + 1.0 OR b <> g + 2.0").count() == 0

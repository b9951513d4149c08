import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import clean as C
from tessera.sources import io as IO


def test_s1_csv_load_repair_validate(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text("id,dataset,age,sex,cp,trestbps,chol,fbs,restecg,thalch,exang,oldpeak,slope,ca,thal,num\n"
                 "1,x,63,1,3,145,233,1,0,150,0,2.3,0,0,1,1\n")
    df = IO.load_raw(spark, str(p))
    assert "thalach" in df.columns and "target" in df.columns and "id" not in df.columns
    with pytest.raises(FileNotFoundError):
        IO.load_raw(spark, str(tmp_path / "missing.csv"))
    with pytest.raises(ValueError):
        IO.load_raw(spark, str(p), required=["nope"])


def test_s6_s7_s9_s10_round_trips(spark, tmp_path):
    df = spark.createDataFrame([("m", 0.5, 0.25, 0.1, 0.2, 0.3, 0.4)],
                               "Model string, Accuracy double, Precision double, Recall double, F1 double, "
                               "ROC_AUC double, PR_AUC double")
    IO.save_processed(df, str(tmp_path / "p"))
    assert IO.load_processed(spark, str(tmp_path / "p")).count() == 1
    IO.save_table(df, str(tmp_path / "t"), index="Model")
    assert IO.read_result(spark, str(tmp_path / "t"), "classification").first()["PR_AUC"] == 0.4
    IO.save_json(spark, {"a": 1, "b": np.float32(2.5)}, str(tmp_path / "j"))
    txt = spark.read.text(str(tmp_path / "j")).first()[0]
    assert json.loads(txt)["a"] == 1


def test_streaming_transform(spark, tmp_path):
    rows = [(1, 10.0, "a"), (2, 0.0, "b"), (3, 30.0, "a")]
    df = spark.createDataFrame(rows, "id int, v double, c string")
    _, model = C.fit_transform(df, ["v"], ["c"], {"v": 0.0}, outliers="none")
    src = tmp_path / "in"
    df.write.parquet(str(src))
    from tessera.streaming.clean_stream import clean_files_to_parquet
    q = clean_files_to_parquet(spark, str(src), df.schema, model, str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out")).orderBy("id").collect()
    batch = model.transform(df).orderBy("id").collect()
    assert [tuple(r) for r in out] == [tuple(r) for r in batch]


def test_end_to_end_job(spark):
    from tessera.plans.job import JobSettings, run
    rng = np.random.default_rng(7)
    n = 120
    rows = []
    for i in range(n):
        t = int(rng.random() < 0.4)
        rows.append((i, int(rng.integers(35, 75)), int(rng.integers(0, 2)), int(rng.integers(0, 4)),
                     int(rng.integers(100, 180)) if rng.random() > .05 else 0, int(rng.integers(150, 350)),
                     int(rng.integers(0, 2)), int(rng.integers(0, 3)), int(rng.integers(90, 200)), t,
                     float(np.round(rng.random() * 4, 1)), int(rng.integers(0, 3)), int(rng.integers(0, 5)),
                     int(rng.integers(0, 4)), t))
    cols = "row_id age sex cp trestbps chol fbs restecg thalach exang oldpeak slope ca thal target".split()
    raw = spark.createDataFrame(rows, cols)
    s = JobSettings(n_init=1, k_range=(2, 3), dbscan_eps=2.5, cv_folds=2,
                    models={"Random Forest": {"n_trees": 10}, "Logistic Regression": {}},
                    association={"min_support": 0.2, "min_confidence": 0.6, "min_lift": 1.0, "max_len": 3})
    out = run(spark, raw, s, skip_semi=True)
    for k in ("processed", "itemsets", "rules", "clustering", "cv", "classification", "regression"):
        assert out[k].count() > 0
    assert {r["Algorithm"] for r in out["clustering"].collect()} == {"KMeans", "DBSCAN"} and out["classification"].count() == 2


def test_stream_with_many_categories(spark, tmp_path):
    n = 20_000
    df = spark.range(n).select(F.col("id").cast("int").alias("id"), F.col("id").cast("double").alias("v"), F.concat(F.lit("c"), F.col("id")).alias("c"))
    _, model = C.fit_transform(df, ["v"], ["c"], outliers="none")
    df.write.parquet(str(tmp_path / "in"))
    from tessera.streaming.clean_stream import clean_files_to_parquet
    clean_files_to_parquet(spark, str(tmp_path / "in"), df.schema, model, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.agg(F.countDistinct("c"), F.min("c"), F.max("c")).first()[:3] == (n, 0, n - 1)

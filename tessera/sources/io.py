"""Sources and sinks (S1-S11) on Spark's readers and writers."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import params as P


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


# S1-S4
def load_raw(spark: SparkSession, path: str, schema: str | T.StructType | None = None,
             renames: dict | None = None, drop: list | None = None, required: list | None = None) -> DataFrame:
    """CSV with header; inferred types unless a schema is given; rename map
    (absent names ignored), drop extra columns if present, then check the
    required columns (error lists the missing names)."""
    if not _exists(spark, path):
        raise FileNotFoundError(path)
    r = spark.read.option("header", True)
    df = r.schema(schema).csv(path) if schema is not None else r.option("inferSchema", True).csv(path)
    df = rename_columns(df, P.RENAMES if renames is None else renames)
    df = drop_extra(df, P.DROP_IF_PRESENT if drop is None else drop)
    validate_schema(df, P.RAW_COLUMNS if required is None else required)
    return df


def rename_columns(df: DataFrame, renames: dict) -> DataFrame:
    present = {a: b for a, b in renames.items() if a in df.columns}
    return df.withColumnsRenamed(present) if present else df


def drop_extra(df: DataFrame, names: list) -> DataFrame:
    """Without the named columns; absent names are ignored."""
    return df.drop(*[c for c in names if c in df.columns])


def validate_schema(df: DataFrame, required: list) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


# S5 / S6
def load_processed(spark: SparkSession, path: str) -> DataFrame:
    if not _exists(spark, path):
        raise FileNotFoundError(path)
    return spark.read.parquet(path)


def save_processed(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


# S7 / S8
def save_table(df: DataFrame, path: str, index: str | None = None, mode: str = "overwrite") -> None:
    """CSV with header.  ``index`` names a column written first (the
    reference's optional index); nested values are written as JSON text."""
    out = df
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            out = out.withColumn(f.name, F.to_json(F.col(f.name)))
    if index:
        out = out.select(index, *[c for c in out.columns if c != index])
    out.write.mode(mode).option("header", True).csv(path)


def save_rules(rules: DataFrame, path: str) -> None:
    from tessera.operators.rules import format_rules
    save_table(format_rules(rules), path)


# S9
def save_json(spark: SparkSession, data: dict, path: str, mode: str = "overwrite") -> None:
    """One-row JSON report; values JSON cannot hold are written as strings."""
    def norm(v):
        try:
            json.dumps(v)
            return v
        except TypeError:
            return str(v)
    payload = json.dumps({k: norm(v) for k, v in data.items()})
    spark.createDataFrame([(payload,)], "value string").write.mode(mode).text(path)


# S10
RESULT_SCHEMAS = {
    "classification": "Model string, Accuracy double, Precision double, Recall double, F1 double, "
                      "ROC_AUC double, PR_AUC double",
    "regression": "Model string, MAE double, RMSE double, R2 double",
    "clustering": "Algorithm string, N_clusters int, Silhouette double, DBI double, CHI double, "
                  "n_noise bigint, error string",
    "cv": "model string, f1_mean double, f1_std double, roc_auc_mean double, pr_auc_mean double",
    "semi": "label_ratio string, n_labeled long, pr_auc_supervised double, pr_auc_self_training double, "
            "f1_supervised double, f1_self_training double",
    "rules": "antecedents string, consequents string, support double, confidence double, lift double",
}


def read_result(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.option("header", True).schema(RESULT_SCHEMAS[kind]).csv(path)


# S11 lives with the models: tessera.operators.models.save_model / load_model

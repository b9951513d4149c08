"""Deterministic splits, folds, class weights and partial labels.

Row order comes from ``md5(seed|id)`` so every run, every executor retry
and the DuckDB oracle see the same order.  "The first k rows of each class
in that order" needs an exact rank within the class; a window partitioned
by class would sort a whole class (possibly a third of the table) in one
task, so the rank comes from :func:`ordered_cumsum` instead: the hash key is
uniform, so it is cut into equal buckets of bounded size without a sketch.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.order_stats import ordered_cumsum

HASH_HEX = 15  # leading md5 hex digits used as a numeric key (60 bits)
HASH_RANGE = (0, 16 ** HASH_HEX)


def hash_key(id_col: str, seed: int = 42) -> Column:
    """Uniform bigint in [0, 16^15): leading hex of md5('<seed>|<id>').
    Order by it = order by the md5 text."""
    h = F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_col).cast("string")))
    return F.conv(F.substring(h, 1, HASH_HEX), 16, 10).cast("bigint")


def rank_by_hash(df: DataFrame, id_col: str, by: list | None = None, seed: int = 42, out: str = "rank") -> DataFrame:
    """Exact 1-based rank of each row by its hash key within ``by`` groups."""
    d = df.withColumn("_hk", hash_key(id_col, seed))
    r = ordered_cumsum(d, "_hk", [], by=by, key_range=HASH_RANGE, tie=id_col)  # equal hash prefixes: by id
    return r.withColumnRenamed("row_in_group", out).drop("_hk")


def _class_counts(df: DataFrame, by: str) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("_n_class"))


# F8
def stratified_split(df: DataFrame, id_col: str, label: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``is_test``: the first floor(test_size * n_c + 0.5) rows of each
    class in hash order go to test."""
    r = rank_by_hash(df, id_col, by=[label], seed=seed).join(_class_counts(df, label), label)
    n_test = F.floor(F.lit(test_size) * F.col("_n_class") + F.lit(0.5))
    return r.withColumn("is_test", F.col("rank") <= n_test).drop("rank", "_n_class")


# F9
def random_split(df: DataFrame, id_col: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``is_test``: the first ceil(test_size * n) rows in hash order."""
    n = df.count()
    k = math.ceil(test_size * n)
    r = rank_by_hash(df, id_col, seed=seed)
    return r.withColumn("is_test", F.col("rank") <= F.lit(k)).drop("rank")


def train_test(df_with_flag: DataFrame) -> tuple:
    return (df_with_flag.filter(~F.col("is_test")).drop("is_test"),
            df_with_flag.filter(F.col("is_test")).drop("is_test"))


# F10
def stratified_folds(df: DataFrame, id_col: str, label: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Adds ``fold`` = (rank within class - 1) mod k: fold sizes per class differ by at most one."""
    r = rank_by_hash(df, id_col, by=[label], seed=seed)
    return r.withColumn("fold", ((F.col("rank") - 1) % k).cast("int")).drop("rank")


# F12
BROADCAST_CLASSES = 10_000


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """w_c = n / (k * n_c)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n_class"))
    tot = counts.agg(F.sum("_n_class").alias("n"), F.count(F.lit(1)).alias("k")).collect()[0]
    w = counts.select(label, (F.lit(float(tot["n"])) / (F.lit(float(tot["k"])) * F.col("_n_class"))).alias(out))
    # without the hint Spark may broadcast the rows, which it takes for the smaller side
    return df.join(F.broadcast(w) if tot["k"] <= BROADCAST_CLASSES else w, label)


# F13
def partial_labels(df: DataFrame, id_col: str, label: str, ratio: float, seed: int = 42,
                   out: str = "partial_label", min_labels: int = 2) -> DataFrame:
    """Keep max(min_labels, int(n * ratio)) labels chosen by hash order over
    all rows (not stratified); the rest become -1.  Adds ``is_labeled``."""
    n = df.count()
    keep = max(min_labels, int(n * ratio))
    r = rank_by_hash(df, id_col, seed=seed)
    lab = F.col("rank") <= F.lit(keep)
    return (r.withColumn("is_labeled", lab)
             .withColumn(out, F.when(lab, F.col(label).cast("int")).otherwise(F.lit(-1)))
             .drop("rank"))

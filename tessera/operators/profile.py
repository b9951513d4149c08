"""Profiling (E1-E14): every operator is one or two aggregate passes.

Each function takes a DataFrame plus column names and returns a DataFrame,
so it works on any table.  Statistics that need exact quantiles use
:mod:`tessera.functions.order_stats` (bounded tasks at any scale).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.order_stats import exact_quantiles, grouped_quantiles, keyed_values
from tessera.session import write_shared

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude=()) -> list:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in set(exclude)]


def _long(df_one_row: DataFrame, names: list, value_name: str, key_name: str = "column_name") -> DataFrame:
    """Unpivot a one-row aggregate with one column per name."""
    return df_one_row.unpivot([], [F.col(f"`{n}`").alias(n) for n in names], key_name, value_name) \
        if names else df_one_row.sparkSession.createDataFrame([], f"{key_name} string, {value_name} double")


# E1
def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


# E2
def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Counts of non-null values, most frequent first (ties by value)."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.desc("count"), F.asc(col)))


# E3
def missing_counts(df: DataFrame, cols: list | None = None, only_positive: bool = False) -> DataFrame:
    cols = list(cols or df.columns)
    one = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).cast("long").alias(c) for c in cols])
    out = one.unpivot([], [F.col(f"`{c}`") for c in cols], "column_name", "n_missing")
    return out.filter(F.col("n_missing") > 0) if only_positive else out


# E4
def column_types(df: DataFrame) -> DataFrame:
    """Schema as a table: position, column, Spark type."""
    rows = [(i, n, t) for i, (n, t) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, dtype string")


# E5
def describe(df: DataFrame, cols: list | None = None) -> DataFrame:
    """count, mean, std (n-1), min, 25/50/75 % (exact, linear), max per column."""
    cols = list(cols or numeric_columns(df))
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`").cast("double")
        aggs.append(F.struct(F.lit(c).alias("column_name"), F.count(x).alias("count"), F.avg(x).alias("mean"),
                             F.stddev_samp(x).alias("std"), F.min(x).alias("min"),
                             F.lit(q[(c, 0.25)]).cast("double").alias("q25"),
                             F.lit(q[(c, 0.5)]).cast("double").alias("q50"),
                             F.lit(q[(c, 0.75)]).cast("double").alias("q75"),
                             F.max(x).alias("max")).alias(f"s{i}"))
    return df.agg(F.array(*aggs).alias("a")).select(F.inline("a"))


# E6
def target_rate(df: DataFrame, target: str, positive=1, negative=0) -> DataFrame:
    """Share of positive rows in % and class ratio n_negative / n_positive."""
    t = F.col(target)
    n1 = F.count_if(t == F.lit(positive))
    n0 = F.count_if(t == F.lit(negative))
    return df.agg((F.avg((t == F.lit(positive)).cast("double")) * 100).alias("target_rate_pct"),
                  n0.cast("long").alias("n_negative"), n1.cast("long").alias("n_positive"),
                  (n0 / F.nullif(n1, F.lit(0))).cast("double").alias("class_ratio"))


# E7
def sentinel_counts(df: DataFrame, sentinels: dict) -> DataFrame:
    """How many rows hold each column's sentinel value (columns absent are skipped)."""
    from tessera.operators.clean import sentinel_condition
    items = [(c, v) for c, v in sentinels.items() if c in df.columns]
    if not items:
        return df.sparkSession.createDataFrame([], "column_name string, n_sentinel long")
    one = df.agg(*[F.count_if(sentinel_condition(c, v)).cast("long").alias(c) for c, v in items])
    return one.unpivot([], [F.col(f"`{c}`") for c, _ in items], "column_name", "n_sentinel")


# E8
def correlation_matrix(df: DataFrame, cols: list | None = None, lower_only: bool = False) -> DataFrame:
    """Pearson correlation of every column pair (pairwise complete), long form."""
    cols = list(cols or numeric_columns(df))
    aggs, pairs = [], []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if lower_only and i <= j:
                continue
            if j < i and not lower_only:
                continue  # symmetric: compute once, mirror below
            aggs.append(F.corr(F.col(f"`{a}`").cast("double"), F.col(f"`{b}`").cast("double")).alias(f"c{i}_{j}"))
            pairs.append((i, j))
    one = df.agg(*aggs)
    structs = []
    for i, j in pairs:
        v = F.col(f"c{i}_{j}")
        structs.append(F.struct(F.lit(cols[i]).alias("col_a"), F.lit(cols[j]).alias("col_b"), v.alias("corr")))
        if not lower_only and i != j:
            structs.append(F.struct(F.lit(cols[j]).alias("col_a"), F.lit(cols[i]).alias("col_b"), v.alias("corr")))
    return one.select(F.inline(F.array(*structs)))


def correlation_gram(df: DataFrame, cols: list | None = None, slots: int = 64) -> DataFrame:
    """``correlation_matrix`` for many columns: one pass of blocked matrix products.

    Every task adds up counts, sums, squares and cross products of its rows around the
    column means (pairwise complete) and returns one record per column; records are
    summed over ``slots``, then over columns, as a stream, so no task holds more than
    its columns.  Nulls and NaN are missing; a pair with a constant side is null."""
    import numpy as np
    import pandas as pd
    cols = list(cols or numeric_columns(df))
    c = len(cols)
    num = df.select(*[F.col(f"`{x}`").cast("double").alias(f"c{i}") for i, x in enumerate(cols)])
    means = num.agg(*[F.avg(F.nanvl(f"c{i}", F.lit(None).cast("double"))) for i in range(c)]).first()
    centre = np.array([0.0 if m is None else m for m in means])

    def products(batches):
        total = np.zeros((4, c, c))
        for pdf in batches:
            x = pdf.to_numpy("f8", na_value=np.nan) - centre
            there = ~np.isnan(x)
            x, m = np.where(there, x, 0.0), there.astype("f8")
            total += [m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x]
        n, s, q, p = total
        parts = np.stack([n, s, s.T, q, q.T, p], axis=1)        # by column: one row per statistic
        yield pd.DataFrame({"i": np.arange(c, dtype="i4"), "parts": [a.tobytes() for a in parts]})

    def summed(batches):
        total: dict[int, np.ndarray] = {}
        for pdf in batches:
            for i, b in zip(pdf["i"], pdf["parts"]):
                a = np.frombuffer(b)
                total[i] = total[i] + a if i in total else a
        yield pd.DataFrame({"i": pd.array(list(total), "int32"), "parts": [a.tobytes() for a in total.values()]})

    def correlations(batches):
        for pdf in batches:
            for i, b in zip(pdf["i"], pdf["parts"]):
                n, sx, sy, qx, qy, p = np.frombuffer(b).reshape(6, c)
                vx, vy = n * qx - sx * sx, n * qy - sy * sy
                ok = (vx > 1e-10 * n * qx) & (vy > 1e-10 * n * qy)
                r = np.where(ok, (n * p - sx * sy) / np.sqrt(np.where(ok, vx * vy, 1.0)), np.nan)
                yield pd.DataFrame({"col_a": cols[i], "col_b": cols, "corr": pd.array([float(v) if k else None for v, k in zip(r, ok)], "Float64")})
    one = num.mapInPandas(products, "i int, parts binary").withColumn("slot", F.spark_partition_id() % slots)
    by_slot = one.repartition("i", "slot").select("i", "parts").mapInPandas(summed, "i int, parts binary")
    return by_slot.repartition("i").mapInPandas(summed, "i int, parts binary").mapInPandas(correlations, "col_a string, col_b string, corr double")


# E9
def correlation_with_target(df: DataFrame, target: str, cols: list | None = None) -> DataFrame:
    cols = [c for c in (cols or numeric_columns(df)) if c != target]
    one = df.agg(*[F.corr(F.col(f"`{c}`").cast("double"), F.col(target).cast("double")).alias(c) for c in cols])
    out = one.unpivot([], [F.col(f"`{c}`") for c in cols], "column_name", "corr")
    return out.orderBy(F.desc_nulls_last(F.abs("corr")), "column_name")


# E10
def crosstab(df: DataFrame, col: str, target: str, target_values: list | None = None) -> DataFrame:
    """Category x target counts, one column ``<target>_<value>`` per class, missing = 0."""
    if target_values is None:
        target_values = sorted(r[0] for r in df.select(target).distinct().filter(F.col(target).isNotNull()).collect())
    g = (df.filter(F.col(col).isNotNull() & F.col(target).isNotNull())
           .groupBy(col).pivot(target, target_values).agg(F.count(F.lit(1))))
    ren = [F.coalesce(F.col(f"`{v}`"), F.lit(0)).cast("long").alias(f"{target}_{v}") for v in target_values]
    return g.select(col, *ren)


# E11
def histogram(df: DataFrame, cols: list | None = None, bins: int = 30, exclude=()) -> DataFrame:
    """Equal-width bins from min to max (max falls in the last bin), every bin listed."""
    cols = list(cols or numeric_columns(df, exclude))
    stats = df.agg(*[F.struct(F.min(F.col(f"`{c}`").cast("double")).alias("lo"),
                              F.max(F.col(f"`{c}`").cast("double")).alias("hi")).alias(f"s{i}")
                     for i, c in enumerate(cols)]).collect()[0]
    parts = []
    for i, c in enumerate(cols):
        lo, hi = stats[f"s{i}"]["lo"], stats[f"s{i}"]["hi"]
        if lo is None:
            continue
        width = (hi - lo) / bins if hi > lo else 1.0
        x = F.col(f"`{c}`").cast("double")
        b = F.least(F.lit(bins - 1), F.floor((x - F.lit(lo)) / F.lit(width)).cast("int"))
        parts.append(F.when(x.isNotNull(), F.struct(F.lit(c).alias("column_name"), b.alias("bin"))))
    if not parts:
        return df.sparkSession.createDataFrame([], "column_name string, bin int, bin_lo double, bin_hi double, count long")
    counts = (df.select(F.explode(F.filter(F.array(*parts), lambda s: s.isNotNull())).alias("s"))
                .groupBy("s.column_name", "s.bin").agg(F.count(F.lit(1)).alias("count")))
    frame = []
    for i, c in enumerate(cols):
        lo, hi = stats[f"s{i}"]["lo"], stats[f"s{i}"]["hi"]
        if lo is None:
            continue
        width = (hi - lo) / bins if hi > lo else 1.0
        for k in range(bins):
            frame.append((c, k, lo + k * width, lo + (k + 1) * width if k < bins - 1 else (hi if hi > lo else lo + 1.0)))
    grid = df.sparkSession.createDataFrame(frame, "column_name string, bin int, bin_lo double, bin_hi double")
    # the grid is (#columns x bins) rows: bounded, broadcast
    return (F.broadcast(grid).join(counts, ["column_name", "bin"], "left")
              .select("column_name", "bin", "bin_lo", "bin_hi", F.coalesce("count", F.lit(0)).cast("long").alias("count")))


# E12
def box_stats(df: DataFrame, target: str, cols: list | None = None, whisker: float = 1.5) -> DataFrame:
    """Per class and column: Q1, median, Q3, whiskers (extreme data inside the fences), flier count.

    Any number of classes: quartiles and fences are a table that the rows are joined with."""
    cols = list(cols or numeric_columns(df, exclude=[target]))
    q = grouped_quantiles(df, target, cols, [0.25, 0.5, 0.75])
    box = write_shared(q.select("g", "c", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3")), "boxes")
    reach = F.lit(whisker) * (F.col("q3") - F.col("q1"))
    x = F.col("x")
    inside = (x >= F.col("q1") - reach) & (x <= F.col("q3") + reach)
    res = (keyed_values(df, target, cols).join(box, ["g", "c"]).groupBy("g", "c", "q1", "median", "q3")
           .agg(F.min(F.when(inside, x)).alias("whisker_lo"), F.max(F.when(inside, x)).alias("whisker_hi"),
                F.count_if(x.isNotNull() & ~inside).cast("long").alias("n_fliers")))
    return res.select(F.col("g").alias(target), F.col("c").alias("column_name"), "q1", "median", "q3", "whisker_lo", "whisker_hi", "n_fliers")


# E13
def class_distribution(df: DataFrame, target: str) -> DataFrame:
    g = df.groupBy(target).agg(F.count(F.lit(1)).alias("count"))
    # window over the aggregated classes only (bounded number of rows)
    return g.withColumn("share_pct", F.col("count") * 100.0 / F.sum("count").over(Window.partitionBy())) \
            .orderBy(target)


# E14
def before_after(before: DataFrame, after: DataFrame, cols: list | None = None) -> DataFrame:
    """Shape, total missing and per-column means before vs after a cleaning step."""
    cols = [c for c in (cols or numeric_columns(before)) if c in after.columns]

    def summary(d):
        aggs = [F.count(F.lit(1)).cast("double").alias("n_rows"),
                F.lit(float(len(d.columns))).alias("n_cols"),
                sum((F.count_if(F.col(f"`{c}`").isNull()) for c in d.columns), F.lit(0)).cast("double").alias("n_missing")]
        aggs += [F.avg(F.col(f"`{c}`").cast("double")).alias(f"mean_{c}") for c in cols]
        names = ["n_rows", "n_cols", "n_missing"] + [f"mean_{c}" for c in cols]
        return d.agg(*aggs).unpivot([], [F.col(f"`{n}`") for n in names], "metric", "value")

    return summary(before).withColumnRenamed("value", "before") \
        .join(summary(after).withColumnRenamed("value", "after"), "metric", "inner")

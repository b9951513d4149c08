"""Feature engineering (F1-F7): all narrow expressions, no UDF, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import params as P

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


# F1
def bin_expr(x: Column, edges: list, labels: list) -> Column:
    """Label of the half-open bin [lo, hi); outside every bin -> null
    (the last upper edge is excluded as well)."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    e = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x >= F.lit(lo)) & (x < F.lit(hi))
        e = F.when(cond, F.lit(lab)) if e is None else e.when(cond, F.lit(lab))
    return e


def bin_column(df: DataFrame, col: str, edges: list, labels: list, out: str | None = None) -> DataFrame:
    return df.withColumn(out or f"{col}_bin", bin_expr(_c(col), edges, labels))


# F2 / F3
def discretize_all(df: DataFrame, bins: dict | None = None) -> DataFrame:
    """``bins``: {column: (edges, labels, output name)}; defaults are the
    reference's preset.  Absent columns are skipped."""
    bins = P.BINS if bins is None else bins
    cols = {out: bin_expr(_c(c), e, lab) for c, (e, lab, out) in bins.items() if c in df.columns}
    return df.withColumns(cols) if cols else df


# F4
def product(df: DataFrame, out: str, *cols: str) -> DataFrame:
    e = F.lit(1)
    for c in cols:
        e = e * _c(c)
    return df.withColumn(out, e)


def safe_ratio(df: DataFrame, out: str, num: str, den: str, eps: float = 1e-6) -> DataFrame:
    return df.withColumn(out, _c(num) / (_c(den) + F.lit(eps)))


def linear_combination(df: DataFrame, out: str, terms: dict, const: float = 0.0) -> DataFrame:
    e = F.lit(const)
    for c, w in terms.items():
        e = e + F.lit(w) * _c(c)
    return df.withColumn(out, e)


RISK_FEATURES = ["age_sex_risk", "chol_bp_ratio", "hr_reserve", "exang_oldpeak", "cp_exang"]


def risk_features(df: DataFrame, age="age", sex="sex", chol="chol", trestbps="trestbps",
                  thalach="thalach", exang="exang", oldpeak="oldpeak", cp="cp") -> DataFrame:
    """The reference's five derived columns (one projection)."""
    return df.withColumns({
        "age_sex_risk": _c(age) * _c(sex),
        "chol_bp_ratio": _c(chol) / (_c(trestbps) + F.lit(1e-6)),
        "hr_reserve": F.lit(220) - _c(age) - _c(thalach),
        "exang_oldpeak": _c(exang) * _c(oldpeak),
        "cp_exang": _c(cp) * _c(exang),
    })


# F5
def item_text(df: DataFrame, col: str) -> Column:
    """Value as item text; integral-valued numbers print without a fraction."""
    t = df.schema[col].dataType
    x = _c(col)
    if isinstance(t, T.BooleanType):
        return F.when(x, F.lit("True")).when(~x, F.lit("False"))
    if isinstance(t, INTEGRAL):
        return x.cast("bigint").cast("string")
    if isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
        d = x.cast("double")
        return F.when(d == F.floor(d), d.cast("bigint").cast("string")).otherwise(d.cast("string"))
    return x.cast("string")


def transactions(df: DataFrame, item_columns: dict | None = None, target: str | None = P.TARGET_COL,
                 target_items: dict | None = None, other_item: str = P.TARGET_ITEM_OTHER,
                 keep: list | None = None, out: str = "items", bins: dict | None = None) -> DataFrame:
    """One ``array<string>`` of ``prefix=value`` items per row, in the fixed
    column order, nulls skipped, plus a target item when the target exists.
    The reference preset bins the numeric columns first (``bins``)."""
    if item_columns is None:
        item_columns = P.ITEM_COLUMNS
        bins = P.BINS if bins is None else bins
    if bins:
        df = discretize_all(df, bins)
    target_items = P.TARGET_ITEMS if target_items is None else target_items
    parts = [F.concat(F.lit(f"{p}="), item_text(df, c)) for c, p in item_columns.items() if c in df.columns]
    if target and target in df.columns:
        t = _c(target).cast("bigint")
        e = F.lit(other_item)
        for k, v in sorted(target_items.items(), reverse=True):
            e = F.when(t == F.lit(k), F.lit(v)).otherwise(e)
        parts.append(e)
    arr = F.filter(F.array(*parts), lambda s: s.isNotNull()) if parts else F.array().cast("array<string>")
    return df.select(*[_c(k) for k in (keep or [])], arr.alias(out))


# F6
def onehot_long(tx: DataFrame, tid: str, items: str = "items") -> DataFrame:
    """(tid, item) pairs with duplicates in a row collapsed: the scalable form."""
    return tx.select(tid, F.explode(F.array_distinct(items)).alias("item"))


def onehot_matrix(tx: DataFrame, tid: str, items: str = "items", max_items: int = 5_000) -> DataFrame:
    """Boolean matrix, one column per item in sorted order (bounded width; ``onehot_sparse`` has no bound)."""
    long = onehot_long(tx, tid, items)
    names = sorted(r[0] for r in long.select("item").distinct().limit(max_items + 1).collect())
    if len(names) > max_items:
        raise ValueError(f"more than {max_items} distinct items; use onehot_sparse")
    wide = long.groupBy(tid).pivot("item", names).agg(F.count(F.lit(1)))
    return wide.select(tid, *[F.coalesce(_c(n) > 0, F.lit(False)).alias(n) for n in names])


def onehot_sparse(tx: DataFrame, tid: str, items: str = "items", codes: DataFrame | None = None,
                  out: str = "onehot") -> tuple:
    """Sparse 0/1 vector per ``tid`` over any number of items: ``(frame, codes)``.

    ``codes`` (v, code) numbers the items in sorted order and is a table, not a list
    on the driver; pass the one of an earlier call to encode new rows the
    same way (unseen items set nothing).  A row without items has an empty vector."""
    from pyspark.ml.linalg import SparseVector, VectorUDT

    from tessera.operators.clean import code_table
    if codes is None:
        codes = code_table(tx.select(F.explode(_c(items)).alias("v")))
    width = codes.count()
    vector = F.udf(lambda on: SparseVector(width, on, [1.0] * len(on)), VectorUDT())
    long = tx.select(_c(tid), F.explode_outer(F.array_distinct(_c(items))).alias("_item"))
    coded = long.join(codes.select(F.col("v").alias("_item"), F.col("code").alias("_code")), "_item", "left")
    rows = coded.groupBy(_c(tid)).agg(F.array_sort(F.collect_set("_code")).alias("_on"))   # bounded by the items of a row
    return rows.select(_c(tid), vector("_on").alias(out)), codes


# F7
def get_X_y(df: DataFrame, feature_cols: list | None = None, target: str | None = P.TARGET_COL,
            extra_features: bool = False, features_col: str = "features", label_col: str = "label",
            keep: list | None = None) -> DataFrame:
    """Feature vector (+ ``label`` when the target exists).  Missing
    feature columns are skipped."""
    from pyspark.ml.feature import VectorAssembler
    cols = list(feature_cols or P.FEATURE_COLS)
    if extra_features:
        df = risk_features(df)
        cols += RISK_FEATURES
    cols = [c for c in cols if c in df.columns]
    asm = VectorAssembler(inputCols=cols, outputCol=features_col, handleInvalid="keep")
    out = asm.transform(df.withColumns({c: _c(c).cast("double") for c in cols}))
    sel = [*(keep or []), features_col]
    if target and target in df.columns:
        out = out.withColumn(label_col, _c(target).cast("double"))
        sel.append(label_col)
    return out.select(*sel)

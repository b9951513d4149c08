"""Registered queries for profiling (E*) and cleaning (C*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import clean as C
from tessera.operators import profile as E
from tessera.plans.catalog import CUST_SENT_SQL, LI_NUM, cust_fixed, cust_sentinels, li, load, query, r6

LI_LABEL_SQL = "(SELECT *, CAST(l_linestatus = 'O' AS INTEGER) AS label2 FROM lineitem)"


# ------------------------------------------------------------------ profiling

@query("e1_shape_lineitem", "SELECT count(*) AS n_rows, 11 AS n_cols FROM lineitem")
def q_e1(spark, sf):
    return E.shape(load(spark, sf, "lineitem"))


@query("e2_value_counts_returnflag", """
SELECT l_returnflag, count(*) AS count FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY 1""")
def q_e2(spark, sf):
    return E.value_counts(load(spark, sf, "lineitem"), "l_returnflag")


@query("e3_missing_counts_customer", f"""
WITH s AS ({CUST_SENT_SQL})
SELECT 'c_custkey' AS column_name, CAST(count(*) FILTER (WHERE c_custkey IS NULL) AS BIGINT) AS n_missing FROM s
UNION ALL SELECT 'c_acctbal', count(*) FILTER (WHERE c_acctbal IS NULL) FROM s
UNION ALL SELECT 'c_nationkey', count(*) FILTER (WHERE c_nationkey IS NULL) FROM s
UNION ALL SELECT 'c_mktsegment', count(*) FILTER (WHERE c_mktsegment IS NULL) FROM s""")
def q_e3(spark, sf):
    return E.missing_counts(cust_fixed(spark, sf))


def _describe_sql(table, cols):
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"""SELECT '{c}' AS column_name, count({x}) AS count, round(avg({x}), 6) AS mean,
  round(stddev_samp({x}), 6) AS std, round(min({x}), 6) AS min, round(quantile_cont({x}, 0.25), 6) AS q25,
  round(quantile_cont({x}, 0.5), 6) AS q50, round(quantile_cont({x}, 0.75), 6) AS q75,
  round(max({x}), 6) AS max FROM {table}""")
    return "\nUNION ALL ".join(parts)


@query("e5_describe_events", _describe_sql("events", ["value", "user_id"]))
def q_e5(spark, sf):
    return r6(E.describe(load(spark, sf, "events"), ["value", "user_id"]))


@query("e5_describe_lineitem", _describe_sql("lineitem", LI_NUM))
def q_e5b(spark, sf):
    return r6(E.describe(load(spark, sf, "lineitem"), LI_NUM))


@query("e6_target_rate_lineitem", f"""
SELECT round(avg(CAST(label2 = 1 AS DOUBLE)) * 100, 6) AS target_rate_pct,
       count(*) FILTER (WHERE label2 = 0) AS n_negative, count(*) FILTER (WHERE label2 = 1) AS n_positive,
       round(CAST(count(*) FILTER (WHERE label2 = 0) AS DOUBLE) / count(*) FILTER (WHERE label2 = 1), 6) AS class_ratio
FROM {LI_LABEL_SQL}""")
def q_e6(spark, sf):
    return r6(E.target_rate(li(spark, sf), "label2"))


@query("e7_sentinel_counts_customer", """
SELECT 'c_acctbal' AS column_name, count(*) FILTER (WHERE c_acctbal < 0) AS n_sentinel FROM customer
UNION ALL SELECT 'c_nationkey', count(*) FILTER (WHERE c_nationkey = 0) FROM customer""")
def q_e7(spark, sf):
    return E.sentinel_counts(load(spark, sf, "customer"), cust_sentinels())


def _corr_sql():
    parts = []
    for a in LI_NUM:
        for b in LI_NUM:
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM lineitem")
    return "\nUNION ALL ".join(parts)


@query("e8_correlation_matrix_lineitem", _corr_sql())
def q_e8(spark, sf):
    return r6(E.correlation_matrix(load(spark, sf, "lineitem"), LI_NUM))


@query("e8_correlation_gram_lineitem", _corr_sql())
def q_e8b(spark, sf):
    return r6(E.correlation_gram(load(spark, sf, "lineitem"), LI_NUM))


@query("e9_correlation_with_target_lineitem", "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(corr({c}, CAST(label2 AS DOUBLE)), 6) AS corr FROM {LI_LABEL_SQL}"
    for c in LI_NUM))
def q_e9(spark, sf):
    return r6(E.correlation_with_target(li(spark, sf), "label2", LI_NUM))


@query("e10_crosstab_returnflag_label", f"""
SELECT l_returnflag, count(*) FILTER (WHERE label2 = 0) AS label2_0, count(*) FILTER (WHERE label2 = 1) AS label2_1
FROM {LI_LABEL_SQL} GROUP BY 1""")
def q_e10(spark, sf):
    return E.crosstab(li(spark, sf), "l_returnflag", "label2")


def _hist_sql(table, cols, bins=30):
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"""SELECT * FROM (
  WITH s AS (SELECT min({x}) AS lo, max({x}) AS hi FROM {table}),
  b AS (SELECT LEAST({bins - 1}, CAST(floor(({x} - lo) / ((hi - lo) / {bins})) AS INTEGER)) AS bin
        FROM {table}, s WHERE {c} IS NOT NULL),
  g AS (SELECT CAST(i AS INTEGER) AS bin, lo + i * ((hi - lo) / {bins}) AS bin_lo,
               CASE WHEN i < {bins - 1} THEN lo + (i + 1) * ((hi - lo) / {bins}) ELSE hi END AS bin_hi
        FROM s, range({bins}) t(i))
  SELECT '{c}' AS column_name, g.bin, round(g.bin_lo, 6) AS bin_lo, round(g.bin_hi, 6) AS bin_hi,
         count(b.bin) AS count
  FROM g LEFT JOIN b ON g.bin = b.bin GROUP BY ALL)""")
    return "\nUNION ALL ".join(parts)


@query("e11_histogram_events", _hist_sql("events", ["value", "user_id"]))
def q_e11(spark, sf):
    return r6(E.histogram(load(spark, sf, "events"), ["value", "user_id"]))


@query("e12_box_stats_events_by_type", """
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                  quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1)
SELECT e.event_type, 'value' AS column_name, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(min(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_lo,
  round(max(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_hi,
  count(*) FILTER (WHERE value IS NOT NULL AND NOT (value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1)))
    AS n_fliers
FROM events e JOIN q ON e.event_type = q.event_type GROUP BY e.event_type, q1, median, q3""")
def q_e12(spark, sf):
    return r6(E.box_stats(load(spark, sf, "events"), "event_type", ["value"]))


@query("e13_class_distribution_orders", """
SELECT o_orderstatus, count(*) AS count,
       round(CAST(count(*) AS DOUBLE) * 100.0 / sum(count(*)) OVER (), 6) AS share_pct
FROM orders GROUP BY 1""")
def q_e13(spark, sf):
    return r6(E.class_distribution(load(spark, sf, "orders"), "o_orderstatus"))


@query("e14_before_after_customer", f"""
WITH b AS (SELECT c_custkey, c_acctbal, c_nationkey, c_mktsegment FROM customer), a AS ({CUST_SENT_SQL}),
sb AS (SELECT count(*) AS n, avg(c_acctbal) AS m1, avg(c_nationkey) AS m2,
              count(*) FILTER (WHERE c_acctbal IS NULL) + count(*) FILTER (WHERE c_nationkey IS NULL) AS nm FROM b),
sa AS (SELECT count(*) AS n, avg(c_acctbal) AS m1, avg(c_nationkey) AS m2,
              count(*) FILTER (WHERE c_acctbal IS NULL) + count(*) FILTER (WHERE c_nationkey IS NULL) AS nm FROM a)
SELECT 'n_rows' AS metric, CAST(sb.n AS DOUBLE) AS before, CAST(sa.n AS DOUBLE) AS after FROM sb, sa
UNION ALL SELECT 'n_cols', 4.0::DOUBLE, 4.0::DOUBLE
UNION ALL SELECT 'n_missing', CAST(sb.nm AS DOUBLE), CAST(sa.nm AS DOUBLE) FROM sb, sa
UNION ALL SELECT 'mean_c_acctbal', round(sb.m1, 6), round(sa.m1, 6) FROM sb, sa
UNION ALL SELECT 'mean_c_nationkey', round(sb.m2, 6), round(sa.m2, 6) FROM sb, sa""")
def q_e14(spark, sf):
    before = load(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")
    return r6(E.before_after(before, cust_fixed(spark, sf), ["c_acctbal", "c_nationkey"]))


# ------------------------------------------------------------------ cleaning

@query("c1_drop_duplicates_documents", "SELECT DISTINCT text, lang FROM documents")
def q_c1(spark, sf):
    return C.drop_duplicates(load(spark, sf, "documents").select("text", "lang"))


@query("c1_duplicate_report_documents", """
SELECT CAST(count(*) AS BIGINT) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents)) AS n_distinct,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents)) AS n_duplicates FROM documents""")
def q_c1b(spark, sf):
    return C.duplicate_report(load(spark, sf, "documents").select("text", "lang"))


@query("c2_sentinels_customer", CUST_SENT_SQL)
def q_c2(spark, sf):
    return cust_fixed(spark, sf)


MODE_NATION_SQL = """(SELECT c_nationkey AS v FROM s WHERE c_nationkey IS NOT NULL GROUP BY 1
                     ORDER BY count(*) DESC, v ASC LIMIT 1)"""


def _impute_sql(num_stat, from_s=True):
    src = " FROM s" if from_s else ""
    return f"""
WITH s AS ({CUST_SENT_SQL}), m AS (SELECT {num_stat} AS fill{src}), md AS {MODE_NATION_SQL}
SELECT c_custkey, round(coalesce(c_acctbal, fill), 6) AS c_acctbal, coalesce(c_nationkey, v) AS c_nationkey,
       c_mktsegment FROM s, m, md"""


def _impute_q(method):
    def fn(spark, sf):
        d = cust_fixed(spark, sf)
        fn_, fc = C.fit_impute(d, ["c_acctbal"], ["c_nationkey", "c_mktsegment"], method)
        return r6(C.apply_impute(d, fn_, fc))
    return fn


query("c3_impute_median_customer", _impute_sql("quantile_cont(c_acctbal, 0.5)"))(_impute_q("median"))
query("c3_impute_mean_customer", _impute_sql("avg(c_acctbal)"))(_impute_q("mean"))
query("c3_impute_most_frequent_customer", _impute_sql(
    "(SELECT c_acctbal FROM s WHERE c_acctbal IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, c_acctbal LIMIT 1)", False))(
    _impute_q("most_frequent"))


@query("c5_drop_missing_customer", f"""
SELECT * FROM ({CUST_SENT_SQL}) WHERE c_acctbal IS NOT NULL AND c_nationkey IS NOT NULL AND c_mktsegment IS NOT NULL""")
def q_c5(spark, sf):
    return C.drop_missing(cust_fixed(spark, sf))


@query("c6_iqr_filter_events", """
WITH f AS (SELECT quantile_cont(value, 0.25) AS a1, quantile_cont(value, 0.75) AS a3,
                  quantile_cont(user_id, 0.25) AS b1, quantile_cont(user_id, 0.75) AS b3 FROM events)
SELECT event_id, value, user_id FROM events, f
WHERE value >= a1 - 1.5 * (a3 - a1) AND value <= a3 + 1.5 * (a3 - a1)
  AND user_id >= b1 - 1.5 * (b3 - b1) AND user_id <= b3 + 1.5 * (b3 - b1)""")
def q_c6(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "value", "user_id")
    return C.iqr_filter(ev, ["value", "user_id"], 1.5)


@query("c7_zscore_filter_events", """
WITH f AS (SELECT avg(value) AS m1, stddev_pop(value) AS s1, avg(user_id) AS m2, stddev_pop(user_id) AS s2 FROM events)
SELECT event_id, value, user_id FROM events, f
WHERE abs((value - m1) / s1) < 3 AND abs((user_id - m2) / s2) < 3""")
def q_c7(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "value", "user_id")
    return C.zscore_filter(ev, ["value", "user_id"])


@query("c8_outliers_none_events", "SELECT event_id, value FROM events")
def q_c8(spark, sf):
    return C.remove_outliers(load(spark, sf, "events").select("event_id", "value"), ["value"], "none")


@query("c9_encode_customer", """
SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS c_mktsegment,
       CAST(c_nationkey AS INTEGER) AS c_nationkey FROM customer""")
def q_c9(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return C.encode_categoricals(c, ["c_mktsegment", "c_nationkey"], C.fit_codes(c, ["c_mktsegment", "c_nationkey"]))


@query("c10_standard_scale_events", """
WITH f AS (SELECT avg(value) AS m, stddev_pop(value) AS s FROM events)
SELECT event_id, round((value - m) / s, 6) AS value FROM events, f""")
def q_c10(spark, sf):
    return r6(C.scale(load(spark, sf, "events").select("event_id", "value"), ["value"], "standard"))


@query("c11_minmax_scale_events", """
WITH f AS (SELECT min(value) AS a, max(value) AS b FROM events)
SELECT event_id, round((value - a) / (b - a), 6) AS value FROM events, f""")
def q_c11(spark, sf):
    return r6(C.scale(load(spark, sf, "events").select("event_id", "value"), ["value"], "minmax"))


@query("c12_robust_scale_events", """
WITH f AS (SELECT quantile_cont(value, 0.5) AS m, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS r
           FROM events)
SELECT event_id, round((value - m) / r, 6) AS value FROM events, f""")
def q_c12(spark, sf):
    return r6(C.scale(load(spark, sf, "events").select("event_id", "value"), ["value"], "robust"))


FIT_SQL = f"""
WITH d AS (SELECT DISTINCT c_custkey, c_acctbal, c_nationkey, c_mktsegment FROM customer),
s AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
             CASE WHEN c_nationkey = 0 THEN NULL ELSE c_nationkey END AS c_nationkey, c_mktsegment FROM d),
m AS (SELECT quantile_cont(c_acctbal, 0.5) AS med FROM s), md AS {MODE_NATION_SQL},
i AS (SELECT c_custkey, coalesce(c_acctbal, med) AS c_acctbal, coalesce(c_nationkey, v) AS c_nationkey, c_mktsegment
      FROM s, m, md),
f AS (SELECT quantile_cont(c_acctbal, 0.25) AS q1, quantile_cont(c_acctbal, 0.75) AS q3 FROM i),
o AS (SELECT i.* FROM i, f WHERE c_acctbal >= q1 - 1.5 * (q3 - q1) AND c_acctbal <= q3 + 1.5 * (q3 - q1)),
e AS (SELECT c_custkey, c_acctbal, CAST(c_nationkey AS INTEGER) AS c_nationkey,
             CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS c_mktsegment FROM o),
st AS (SELECT avg(c_acctbal) AS mu, stddev_pop(c_acctbal) AS sd FROM e)"""


@query("c13_fit_transform_customer", FIT_SQL + """
SELECT c_custkey, round((c_acctbal - mu) / sd, 6) AS c_acctbal, c_nationkey, c_mktsegment FROM e, st""")
def q_c13(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")
    out, _ = C.fit_transform(c, ["c_acctbal"], ["c_nationkey", "c_mktsegment"], cust_sentinels())
    return r6(out)


@query("c14_transform_supplier_with_customer_fit", FIT_SQL + """
SELECT s_suppkey, round((coalesce(CASE WHEN s_acctbal < 0 THEN NULL ELSE s_acctbal END, med) - mu) / sd, 6) AS c_acctbal,
       CAST(coalesce(CASE WHEN s_nationkey = 0 THEN NULL ELSE s_nationkey END, v) AS INTEGER) AS c_nationkey
FROM supplier, st, m, md""")
def q_c14(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")
    _, model = C.fit_transform(c, ["c_acctbal"], ["c_nationkey", "c_mktsegment"], cust_sentinels())
    s = load(spark, sf, "supplier").select("s_suppkey", F.col("s_acctbal").alias("c_acctbal"),
                                           F.col("s_nationkey").alias("c_nationkey"))
    return r6(model.transform(s))


# ------------------------------------------------------------------ sources

@query("s2_rename_columns_customer", """
SELECT c_custkey AS custkey, c_name, c_nationkey AS nation, c_acctbal, c_mktsegment FROM customer""")
def q_s2(spark, sf):
    from tessera.sources.io import rename_columns
    return rename_columns(load(spark, sf, "customer"),
                          {"c_custkey": "custkey", "c_nationkey": "nation", "absent_column": "x"})


@query("s3_drop_extra_columns_customer", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def q_s3(spark, sf):
    from tessera.sources.io import drop_extra
    return drop_extra(load(spark, sf, "customer"), ["c_name", "c_mktsegment", "absent_column"])


@query("e4_column_types_orders", """
SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS position, column_name AS "column",
       CASE column_type WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS dtype
FROM (DESCRIBE SELECT * FROM orders)""")
def q_e4(spark, sf):
    return E.column_types(load(spark, sf, "orders"))


@query("f7_features_and_label_lineitem", """
SELECT l_orderkey, l_linenumber, [round(l_quantity, 6), round(l_extendedprice, 6), round(l_discount, 6), round(l_tax, 6)] AS features,
       CAST(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS DOUBLE) AS label
FROM lineitem""")
def q_f7(spark, sf):
    from pyspark.ml.functions import vector_to_array

    from tessera.operators.features import get_X_y
    from tessera.plans.catalog import LI_NUM, li
    out = get_X_y(li(spark, sf), [*LI_NUM[:2], "absent_column", *LI_NUM[2:]], target="label2", keep=["l_orderkey", "l_linenumber"])
    return r6(out.withColumn("features", vector_to_array("features")))


@query("s5_parquet_scan_orders", "SELECT * FROM orders")
def q_s5(spark, sf):
    from tessera.sources.io import load_processed
    return load_processed(spark, f"{sf}/orders.parquet")

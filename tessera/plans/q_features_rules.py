"""Registered queries for features (F1-F7) and association rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import features as FE
from tessera.operators import rules as A
from tessera.plans.catalog import load, query, r6

BIG = 1_000_000_000_000

# ------------------------------------------------------------- bindings

CONV_LEN = ([0, 100, 500, BIG], ["short", "medium", "long"])
DOC_LEN = ([0, 1000, 3000, BIG], ["short", "medium", "long"])
QUALITY_ITEMS = {0: "quality=0", 1: "quality=1"}


def _case_sql(x, edges, labels):
    arms = " ".join(f"WHEN {x} >= {lo} AND {x} < {hi} THEN '{lab}'"
                    for lo, hi, lab in zip(edges[:-1], edges[1:], labels))
    return f"(CASE {arms} END)"


def conv_tx(spark, sf):
    c = load(spark, sf, "conversations")
    c = c.withColumn("len_bin", FE.bin_expr(F.length("text"), *CONV_LEN))
    return FE.transactions(c, {"turn": "turn", "role": "role", "len_bin": "len"}, target=None,
                           keep=["conv_id", "turn"])


CONV_TX_SQL = f"""SELECT conv_id, turn, list_filter(['turn=' || CAST(turn AS VARCHAR), 'role=' || role,
  'len=' || {_case_sql('length(text)', *CONV_LEN)}], lambda x: x IS NOT NULL) AS items FROM conversations"""


def doc_tx(spark, sf):
    d = load(spark, sf, "documents").join(load(spark, sf, "labels"), "doc_id")
    d = d.withColumns({"len_bin": FE.bin_expr(F.col("n_chars"), *DOC_LEN),
                       "bang": F.col("text").contains("!").cast("int")})
    return FE.transactions(d, {"lang": "lang", "len_bin": "len", "bang": "bang"}, target="quality",
                           target_items=QUALITY_ITEMS, keep=["doc_id"])


DOC_TX_SQL = f"""SELECT d.doc_id, list_filter(['lang=' || lang, 'len=' || {_case_sql('n_chars', *DOC_LEN)},
  'bang=' || CAST(CAST(contains(text, '!') AS INTEGER) AS VARCHAR),
  CASE WHEN CAST(quality AS BIGINT) = 0 THEN 'quality=0' WHEN CAST(quality AS BIGINT) = 1 THEN 'quality=1'
       ELSE 'unknown' END], lambda x: x IS NOT NULL) AS items
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""


def li_tx(spark, sf):
    li = load(spark, sf, "lineitem").withColumn("shipyear", F.year("l_shipdate"))
    return FE.transactions(li, {"l_returnflag": "rf", "l_linestatus": "ls", "l_linenumber": "ln",
                                "shipyear": "yr"}, target=None)


LI_TX_SQL = """SELECT list_filter(['rf=' || l_returnflag, 'ls=' || l_linestatus,
  'ln=' || CAST(l_linenumber AS VARCHAR), 'yr=' || CAST(year(l_shipdate) AS VARCHAR)],
  lambda x: x IS NOT NULL) AS items FROM lineitem"""


def itemsets_cte(tx_sql, ms, max_len=4):
    """CTE chain ending in ``fi(items, freq, support)`` (unrounded)."""
    cte = f"""tx AS ({tx_sql}),
t AS (SELECT row_number() OVER () AS tid,
             list_sort(list_distinct(list_filter(items, lambda x: x IS NOT NULL))) AS items FROM tx),
nn AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM t),
e AS (SELECT tid, unnest(items) AS item FROM t),
l1 AS (SELECT item AS i1, count(*) AS freq FROM e GROUP BY 1 HAVING count(*) / (SELECT n FROM nn) >= {ms}),
e1 AS (SELECT e.tid, e.item FROM e JOIN l1 ON e.item = l1.i1)"""
    names = ["i1"]
    unions = ["SELECT [i1] AS items, freq FROM l1"]
    for k in range(2, max_len + 1):
        al = [f"x{j}" for j in range(1, k + 1)]
        joins = " ".join(f"JOIN e1 {al[j]} ON {al[j]}.tid = x1.tid AND {al[j - 1]}.item < {al[j]}.item"
                         for j in range(1, k))
        cols = ", ".join(f"{a}.item AS i{j + 1}" for j, a in enumerate(al))
        grp = ", ".join(str(j + 1) for j in range(k))
        cte += f""",
l{k} AS (SELECT {cols}, count(*) AS freq FROM e1 x1 {joins} GROUP BY {grp}
        HAVING count(*) / (SELECT n FROM nn) >= {ms})"""
        unions.append(f"SELECT [{', '.join(f'i{j}' for j in range(1, k + 1))}] AS items, freq FROM l{k}")
    cte += f""",
fi0 AS ({' UNION ALL '.join(unions)}),
fi AS (SELECT items, freq, freq / (SELECT n FROM nn) AS support FROM fi0)"""
    return cte


def itemsets_sql(tx_sql, ms, max_len=4):
    return f"""WITH {itemsets_cte(tx_sql, ms, max_len)}
SELECT items, CAST(freq AS BIGINT) AS freq, round(support, 6) AS support, CAST(len(items) AS INTEGER) AS length
FROM fi"""


def rules_cte(mc):
    return f"""r AS (SELECT a.items AS antecedents, list_filter(s.items, lambda x: NOT list_contains(a.items, x)) AS consequents,
             s.support AS support, a.support AS antecedent_support
      FROM fi s JOIN fi a ON len(a.items) < len(s.items) AND list_has_all(s.items, a.items)),
r2 AS (SELECT r.*, c.support AS consequent_support, r.support / r.antecedent_support AS confidence
       FROM r JOIN fi c ON c.items = r.consequents),
rules AS (SELECT antecedents, consequents, antecedent_support, consequent_support, support, confidence,
                 support / (antecedent_support * consequent_support) AS lift,
                 support - antecedent_support * consequent_support AS leverage,
                 CASE WHEN confidence >= 1 THEN 'Infinity'::DOUBLE
                      ELSE (1 - consequent_support) / (1 - confidence) END AS conviction
          FROM r2 WHERE confidence >= {mc})"""


RULE_COLS_SQL = """antecedents, consequents, round(antecedent_support, 6) AS antecedent_support,
  round(consequent_support, 6) AS consequent_support, round(support, 6) AS support,
  round(confidence, 6) AS confidence, round(lift, 6) AS lift, round(leverage, 6) AS leverage,
  round(conviction, 6) AS conviction"""


# ------------------------------------------------------------- features

DISC = ([0.0, 0.02, 0.05, 0.08, 0.1], ["none", "low", "mid", "high"])


@query("f1_bin_lineitem_discount", f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {_case_sql('l_discount', *DISC)} AS disc_bin FROM lineitem""")
def q_f1(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_discount")
    return FE.bin_column(li, "l_discount", *DISC, out="disc_bin").drop("l_discount")


LI_BINS = {"l_quantity": ([0, 10, 25, 40, 51], ["few", "some", "many", "bulk"], "qty_bin"),
           "l_discount": (*DISC, "disc_bin"),
           "l_tax": ([0.0, 0.04, 0.08], ["low", "high"], "tax_bin")}


@query("f2_discretize_all_lineitem", f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       {_case_sql('l_quantity', *LI_BINS['l_quantity'][:2])} AS qty_bin,
       {_case_sql('l_discount', *DISC)} AS disc_bin, {_case_sql('l_tax', *LI_BINS['l_tax'][:2])} AS tax_bin
FROM lineitem""")
def q_f2(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                            "l_quantity", "l_discount", "l_tax")
    return FE.discretize_all(li, LI_BINS).drop("l_quantity", "l_discount", "l_tax")


@query("f4_derived_columns_lineitem", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round(l_quantity * l_discount, 6) AS qty_disc,
       round(l_extendedprice / (l_quantity + 1e-6), 6) AS unit_price,
       round(220 - l_quantity - l_tax * 100, 6) AS reserve FROM lineitem""")
def q_f4(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                            "l_quantity", "l_discount", "l_extendedprice", "l_tax")
    li = FE.product(li, "qty_disc", "l_quantity", "l_discount")
    li = FE.safe_ratio(li, "unit_price", "l_extendedprice", "l_quantity")
    li = FE.linear_combination(li, "reserve", {"l_quantity": -1.0, "l_tax": -100.0}, 220.0)
    return r6(li.drop("l_quantity", "l_discount", "l_extendedprice", "l_tax"))


@query("f5_transactions_conversations", CONV_TX_SQL)
def q_f5(spark, sf):
    return conv_tx(spark, sf)


@query("f5_transactions_documents", DOC_TX_SQL)
def q_f5b(spark, sf):
    return doc_tx(spark, sf)


@query("f6_onehot_long_conversations", f"""
SELECT DISTINCT conv_id * 1000 + turn AS tid, unnest(items) AS item FROM ({CONV_TX_SQL})""")
def q_f6(spark, sf):
    tx = conv_tx(spark, sf).withColumn("tid", F.col("conv_id") * 1000 + F.col("turn"))
    return FE.onehot_long(tx, "tid")


def _onehot_sql():
    items = ([f"turn={i}" for i in range(8)] + ["role=assistant", "role=system", "role=user"]
             + ["len=long", "len=medium", "len=short"])
    cols = ", ".join(f"bool_or(item = '{i}') AS \"{i}\"" for i in sorted(items))
    return f"""SELECT tid, {cols} FROM (SELECT conv_id * 1000 + turn AS tid, unnest(items) AS item
FROM ({CONV_TX_SQL})) GROUP BY tid"""


@query("f6_onehot_matrix_conversations", _onehot_sql())
def q_f6b(spark, sf):
    tx = conv_tx(spark, sf).withColumn("tid", F.col("conv_id") * 1000 + F.col("turn"))
    return FE.onehot_matrix(tx, "tid")


@query("f6_onehot_sparse_conversations", f"""
WITH long AS (SELECT DISTINCT conv_id * 1000 + turn AS tid, unnest(items) AS item FROM ({CONV_TX_SQL})),
codes AS (SELECT item, row_number() OVER (ORDER BY item) - 1 AS code FROM (SELECT DISTINCT item FROM long))
SELECT tid, (SELECT count(*) FROM codes) AS width, string_agg(CAST(code AS VARCHAR), ',' ORDER BY code) AS positions
FROM long JOIN codes USING (item) GROUP BY tid""")
def q_f6c(spark, sf):
    from pyspark.ml.functions import vector_to_array
    tx = conv_tx(spark, sf).withColumn("tid", F.col("conv_id") * 1000 + F.col("turn"))
    rows, _ = FE.onehot_sparse(tx, "tid")
    dense = vector_to_array("onehot")
    on = F.filter(F.transform(dense, lambda x, i: F.when(x == 1.0, i)), lambda i: i.isNotNull())
    return rows.select("tid", F.size(dense).cast("long").alias("width"), F.array_join(on.cast("array<string>"), ",").alias("positions"))


# ------------------------------------------------------------- rules

@query("a1_apriori_itemsets_lineitem", itemsets_sql(LI_TX_SQL, 0.05))
def q_a1(spark, sf):
    return r6(A.frequent_itemsets(li_tx(spark, sf), min_support=0.05, max_len=4))


@query("a1_apriori_itemsets_conversations", itemsets_sql(CONV_TX_SQL, 0.02))
def q_a1b(spark, sf):
    return r6(A.frequent_itemsets(conv_tx(spark, sf), min_support=0.02, max_len=4))


@query("a2_fpgrowth_itemsets_lineitem", itemsets_sql(LI_TX_SQL, 0.05))
def q_a2(spark, sf):
    return r6(A.fpgrowth_itemsets(li_tx(spark, sf), min_support=0.05, max_len=4))


@query("a2_fpgrowth_itemsets_documents", itemsets_sql(DOC_TX_SQL, 0.02))
def q_a2b(spark, sf):
    return r6(A.fpgrowth_itemsets(doc_tx(spark, sf), min_support=0.02, max_len=4))


@query("a4_top_itemsets_lineitem", f"""WITH {itemsets_cte(LI_TX_SQL, 0.05)}
SELECT items, CAST(freq AS BIGINT) AS freq, round(support, 6) AS support, CAST(len(items) AS INTEGER) AS length
FROM fi ORDER BY support DESC, items LIMIT 10""")
def q_a4(spark, sf):
    return r6(A.top_itemsets(A.frequent_itemsets(li_tx(spark, sf), min_support=0.05), 10))


@query("a5_rules_conversations", f"""WITH {itemsets_cte(CONV_TX_SQL, 0.02)}, {rules_cte(0.6)}
SELECT {RULE_COLS_SQL} FROM rules""")
def q_a5(spark, sf):
    fi = A.frequent_itemsets(conv_tx(spark, sf), min_support=0.02)
    return r6(A.generate_rules(fi, 0.6))


@query("a6_rules_lift_documents", f"""WITH {itemsets_cte(DOC_TX_SQL, 0.02)}, {rules_cte(0.6)}
SELECT {RULE_COLS_SQL} FROM rules WHERE lift >= 1.2""")
def q_a6(spark, sf):
    _, rules = A.mine_rules(doc_tx(spark, sf), min_support=0.02, min_confidence=0.6, min_lift=1.2)
    return r6(rules)


@query("a7_rules_to_target_documents", f"""WITH {itemsets_cte(DOC_TX_SQL, 0.02)}, {rules_cte(0.6)}
SELECT {RULE_COLS_SQL} FROM rules WHERE lift >= 1.2 AND list_contains(consequents, 'quality=0')""")
def q_a7(spark, sf):
    _, rules = A.mine_rules(doc_tx(spark, sf), min_support=0.02, min_confidence=0.6, min_lift=1.2)
    return r6(A.rules_with_consequent(rules, "quality=0"))


@query("a8_top_rules_conversations", f"""WITH {itemsets_cte(CONV_TX_SQL, 0.02)}, {rules_cte(0.3)}
SELECT {RULE_COLS_SQL} FROM rules ORDER BY lift DESC, antecedents, consequents LIMIT 5""")
def q_a8(spark, sf):
    fi = A.frequent_itemsets(conv_tx(spark, sf), min_support=0.02)
    return r6(A.top_rules(A.generate_rules(fi, 0.3), 5, "lift"))


@query("a9_rules_summary_conversations", f"""WITH {itemsets_cte(CONV_TX_SQL, 0.02)}, {rules_cte(0.3)}
SELECT count(*) AS n_rules, round(avg(support), 6) AS mean_support, round(avg(confidence), 6) AS mean_confidence,
       round(avg(lift), 6) AS mean_lift, round(max(lift), 6) AS max_lift FROM rules WHERE lift >= 1.2""")
def q_a9(spark, sf):
    _, rules = A.mine_rules(conv_tx(spark, sf), min_support=0.02, min_confidence=0.3, min_lift=1.2)
    return r6(A.rules_summary(rules))


@query("a10_format_rules_conversations", f"""WITH {itemsets_cte(CONV_TX_SQL, 0.02)}, {rules_cte(0.6)}
SELECT array_to_string(list_sort(antecedents), ', ') AS antecedents,
       array_to_string(list_sort(consequents), ', ') AS consequents,
       round(support, 4) AS support, round(confidence, 4) AS confidence, round(lift, 4) AS lift
FROM rules WHERE lift >= 1.2""")
def q_a10(spark, sf):
    _, rules = A.mine_rules(conv_tx(spark, sf), min_support=0.02, min_confidence=0.6, min_lift=1.2)
    return A.format_rules(rules)


@query("a11_rules_lineitem_empty", f"""WITH {itemsets_cte(LI_TX_SQL, 0.05)}, {rules_cte(0.6)}
SELECT {RULE_COLS_SQL} FROM rules WHERE lift >= 1.2""")
def q_a11(spark, sf):
    # lineitem columns are independent: no rule reaches lift 1.2 (empty, fixed schema)
    _, rules = A.mine_rules(li_tx(spark, sf), min_support=0.05, min_confidence=0.6, min_lift=1.2)
    return r6(rules)


# ------------------------------------------------------------- result tables / chart data

@query("t5_top_target_rules_documents", f"""WITH {itemsets_cte(DOC_TX_SQL, 0.02)}, {rules_cte(0.6)}
SELECT array_to_string(list_sort(antecedents), ', ') AS antecedents,
       array_to_string(list_sort(consequents), ', ') AS consequents,
       round(support, 4) AS support, round(confidence, 4) AS confidence, round(lift, 4) AS lift
FROM rules WHERE lift >= 1.2 AND list_contains(consequents, 'quality=0')
ORDER BY rules.lift DESC, rules.antecedents, rules.consequents LIMIT 20""")
def q_t5(spark, sf):
    from tessera.plans.report import top_target_rules
    _, rules = A.mine_rules(doc_tx(spark, sf), min_support=0.02, min_confidence=0.6, min_lift=1.2)
    return top_target_rules(rules, "quality=0", 20)


@query("t7_rule_bars_conversations", f"""WITH {itemsets_cte(CONV_TX_SQL, 0.02)}, {rules_cte(0.6)}
SELECT array_to_string(antecedents, ', ') || ' → ' || array_to_string(consequents, ', ') AS rule, round(lift, 6) AS lift
FROM rules WHERE lift >= 1.2 ORDER BY lift DESC, antecedents, consequents LIMIT 10""")
def q_t7(spark, sf):
    from tessera.plans.report import rule_bars
    _, rules = A.mine_rules(conv_tx(spark, sf), min_support=0.02, min_confidence=0.6, min_lift=1.2)
    return r6(rule_bars(rules, 10))

"""Association rules.

Frequent itemsets are mined level by level, and every level is a table: only
row counts reach the driver.

1. Equal transactions collapse to one row with a weight, so a hot group of
   copies costs one row.
2. Items, then pairs of frequent items, are counted from the rows themselves (an
   explode into a partial ``groupBy``): pairs that never meet cost nothing.
3. From three items on, candidates come from a self-join of the level before on
   all items but the last, and lose those with an infrequent subset.  They are
   counted with bitmaps: each itemset has one bitmap of 32,768 transactions per
   bucket, and a candidate's is the AND of its two parents'.  A weight is spread
   over binary digits: a row of weight 5 is a transaction of plane 0 and one of
   plane 2, and a bit of plane b counts 2^b.

An itemset of size k is frequent only if it has at least ``min_support * n``
supporting rows, and a row supports at most ``C(w, k)`` k-sets (``w`` = row
width), so there are at most ``C(w, k) / min_support`` frequent k-sets whatever
``n`` is; joins with the level tables are broadcast while their files are small.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import write_shared

ITEMSET_SCHEMA = "items array<string>, freq bigint, support double, length int"
RULE_SCHEMA = ("antecedents array<string>, consequents array<string>, antecedent_support double, "
               "consequent_support double, support double, confidence double, lift double, "
               "leverage double, conviction double")


def prepare_transactions(tx: DataFrame, items: str = "items") -> DataFrame:
    """Distinct, sorted, non-null items per row (duplicates in a row collapse)."""
    return tx.select(F.sort_array(F.array_distinct(F.filter(F.col(items), lambda x: x.isNotNull()))).alias("items"))


def least_count(min_support: float, n: int) -> int:
    """Smallest count whose support ``count / n`` reaches ``min_support``
    (the product ``min_support * n`` may round above it)."""
    c = max(0, math.floor(min_support * n) - 1)
    while c / n < min_support:
        c += 1
    return c


def frequent_itemsets(tx: DataFrame, items: str = "items", min_support: float = 0.1,
                      max_len: int | None = 4) -> DataFrame:
    """Level-wise (Apriori) frequent itemsets: ``support = freq / n >= min_support``
    over all ``n`` rows (empty rows included), size <= ``max_len`` (None: any)."""
    spark = tx.sparkSession
    distinct = write_shared(prepare_transactions(tx, items).groupBy("items").agg(F.count(F.lit(1)).alias("w")), "transactions")
    n = distinct.agg(F.sum("w")).first()[0]
    if not n or (max_len is not None and max_len < 1):
        return spark.createDataFrame([], ITEMSET_SCHEMA)
    least = F.lit(least_count(min_support, n))

    def counted(sets: DataFrame) -> DataFrame:
        return write_shared(sets.groupBy("items").agg(F.sum("w").alias("freq")).filter(F.col("freq") >= least), "itemsets")

    levels = [counted(distinct.select(F.explode("items").alias("i"), "w").select(F.array("i").alias("items"), "w"))]
    if max_len is None or max_len > 1:
        rows = _frequent_rows(distinct, levels[0])
        levels.append(counted(rows.select(F.explode(_pairs("items")).alias("items"), "w")))
    k, bits = 3, None
    while (max_len is None or k <= max_len) and not levels[-1].isEmpty():
        if bits is None:
            bits = _pair_bitmaps(rows, levels[1])
        cand = _candidates(levels[-1], k)
        met = write_shared(_meet(cand.select("items", F.col("left").alias("x"), F.col("right").alias("y")), bits, "items"), "bitmaps")
        weight = F.bitmap_count("bits") * F.expr("shiftleft(1L, plane)")
        levels.append(counted(met.select("items", weight.alias("w"))))
        bits = met.join(levels[-1].select("items"), "items", "left_semi")
        k += 1
    found = levels[0]
    for one in levels[1:]:
        found = found.unionByName(one)
    return found.select("items", F.col("freq").cast("bigint").alias("freq"), (F.col("freq") / F.lit(float(n))).alias("support"),
                        F.size("items").alias("length"))


def _frequent_rows(distinct: DataFrame, singles: DataFrame) -> DataFrame:
    """Transactions without their infrequent items, again collapsed; those of fewer than two items support no larger set."""
    one = singles.select(F.col("items")[0].alias("i"))
    known = (distinct.withColumn("t", F.monotonically_increasing_id()).select("t", "w", F.explode("items").alias("i")).join(one, "i"))
    kept = known.groupBy("t", "w").agg(F.sort_array(F.collect_list("i")).alias("items")).filter(F.size("items") > 1)
    return write_shared(kept.groupBy("items").agg(F.sum("w").alias("w")), "transactions")


def _pairs(items: str):
    """All two-element subsets of a sorted array."""
    return F.flatten(F.transform(items, lambda x, i: F.transform(F.slice(items, i + 2, F.size(items)), lambda y: F.array(x, y))))


def _pair_bitmaps(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """(items, plane, bucket, bits) of the frequent pairs."""
    digits = F.expr("filter(sequence(0, 62), b -> shiftright(w, b) & 1 = 1)")
    # rows of a plane lie together, so that their numbers share buckets
    tids = write_shared(rows.select("items", F.explode(digits).alias("plane")).sortWithinPartitions("plane")
                        .withColumn("tid", F.monotonically_increasing_id()), "transactions")
    single = (tids.select(F.explode("items").alias("i"), "plane", F.bitmap_bucket_number("tid").alias("bucket"), F.bitmap_bit_position("tid").alias("bit"))
                  .groupBy("i", "plane", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits")))
    single = write_shared(single.select(F.array("i").alias("items"), "plane", "bucket", "bits"), "bitmaps")
    parents = pairs.select("items", F.array(F.col("items")[0]).alias("x"), F.array(F.col("items")[1]).alias("y"))
    return write_shared(_meet(parents, single, "items"), "bitmaps")


def _candidates(level: DataFrame, k: int) -> DataFrame:
    """(items, left, right): k-sets whose subsets of k - 1 items are all in ``level``; left and right lack the
    last and the last but one item."""
    head = level.select(F.slice("items", 1, k - 2).alias("head"), F.element_at("items", -1).alias("last"), F.col("items").alias("set"))
    a, b = head.select("head", F.col("last").alias("p"), F.col("set").alias("left")), head.select("head", F.col("last").alias("q"), F.col("set").alias("right"))
    cand = a.join(b, "head").filter("p < q").select(F.concat("left", F.array("q")).alias("items"), "left", "right")
    # the other subsets lack one item of the head
    rest = F.transform(F.sequence(F.lit(0), F.lit(k - 3)), lambda j: F.filter("items", lambda x, i: i != j))
    whole = (cand.select("items", F.explode(rest).alias("sub")).join(level.select(F.col("items").alias("sub")), "sub", "left_semi")
                 .groupBy("items").count().filter(F.col("count") == k - 2).select("items"))
    return cand.join(whole, "items")


def _both(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([np.bitwise_and(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)).tobytes() for x, y in zip(a, b)], dtype=object)


def _meet(parents: DataFrame, bits: DataFrame, key: str) -> DataFrame:
    """(items, plane, bucket, bits): the AND of the bitmaps of ``x`` and ``y``; empty ones are left out."""
    left = bits.select(F.col(key).alias("x"), "plane", "bucket", F.col("bits").alias("bx"))
    right = bits.select(F.col(key).alias("y"), "plane", "bucket", F.col("bits").alias("by"))
    both = F.pandas_udf(_both, "binary")
    met = parents.join(left, "x").join(right, ["y", "plane", "bucket"])
    return met.select("items", "plane", "bucket", both("bx", "by").alias("bits")).filter(F.bitmap_count("bits") > 0)


def fpgrowth_itemsets(tx: DataFrame, items: str = "items", min_support: float = 0.1,
                      max_len: int | None = 4) -> DataFrame:
    """A2: the same itemsets through Spark ML's parallel FP-growth."""
    from pyspark.ml.fpm import FPGrowth
    t = prepare_transactions(tx, items).persist(StorageLevel.MEMORY_AND_DISK)
    n = t.count()
    if n == 0:
        return tx.sparkSession.createDataFrame([], ITEMSET_SCHEMA)
    model = FPGrowth(itemsCol="items", minSupport=max(0.0, (least_count(min_support, n) - 0.5) / n), minConfidence=1.0).fit(t)
    fi = model.freqItemsets
    if max_len is not None:
        fi = fi.filter(F.size("items") <= max_len)
    return fi.select(F.array_sort("items").alias("items"), F.col("freq").cast("bigint").alias("freq"),
                     (F.col("freq") / F.lit(float(n))).alias("support"), F.size("items").alias("length"))


# A3
def with_length(itemsets: DataFrame) -> DataFrame:
    return itemsets.withColumn("length", F.size("items"))


# A4
def top_itemsets(itemsets: DataFrame, n: int = 10) -> DataFrame:
    return itemsets.orderBy(F.desc("support"), F.asc("items")).limit(n)


# A5
def generate_rules(itemsets: DataFrame, min_confidence: float = 0.6) -> DataFrame:
    """Every non-empty proper split A -> C of every itemset of size >= 2.

    The two support lookups are joins on the sorted item arrays; Spark broadcasts
    the itemset table while it is small (see the bound in the module doc)."""
    big = itemsets.filter(F.col("length") >= 2)
    masks = F.sequence(F.lit(1), F.pow(F.lit(2), F.col("length")).cast("int") - 2)
    splits = big.select("items", "support", F.explode(masks).alias("m"))
    def bit(i):
        return F.col("m").bitwiseAND(F.pow(F.lit(2), i).cast("int"))
    ante = F.filter("items", lambda x, i: bit(i) != 0)
    cons = F.filter("items", lambda x, i: bit(i) == 0)
    r = splits.select(ante.alias("antecedents"), cons.alias("consequents"), "support")
    sup = itemsets.select("items", F.col("support").alias("s"))
    r = (r.join(sup.withColumnRenamed("items", "antecedents").withColumnRenamed("s", "antecedent_support"), "antecedents")
          .join(sup.withColumnRenamed("items", "consequents").withColumnRenamed("s", "consequent_support"), "consequents"))
    conf = F.col("support") / F.col("antecedent_support")
    # lift as s / (sa * sc): symmetric, so A->C and C->A tie exactly
    r = r.withColumn("confidence", conf).withColumn(
        "lift", F.col("support") / (F.col("antecedent_support") * F.col("consequent_support")))
    r = r.withColumn("leverage", F.col("support") - F.col("antecedent_support") * F.col("consequent_support"))
    r = r.withColumn("conviction", F.when(F.col("confidence") >= 1, F.lit(float("inf")))
                     .otherwise((1 - F.col("consequent_support")) / (1 - F.col("confidence"))))
    r = r.filter(F.col("confidence") >= F.lit(min_confidence))
    return r.select("antecedents", "consequents", "antecedent_support", "consequent_support", "support",
                    "confidence", "lift", "leverage", "conviction")


# A6
def filter_rules(rules: DataFrame, min_lift: float = 1.2) -> DataFrame:
    return rules.filter(F.col("lift") >= F.lit(min_lift)).orderBy(F.desc("lift"), "antecedents", "consequents")


def mine_rules(tx: DataFrame, items: str = "items", min_support: float = 0.1, min_confidence: float = 0.6,
               min_lift: float = 1.2, max_len: int | None = 4, algorithm: str = "apriori") -> tuple:
    """Itemsets -> rules with the confidence and lift filters (A1/A2 + A5 + A6)."""
    miner = fpgrowth_itemsets if algorithm == "fpgrowth" else frequent_itemsets
    fi = miner(tx, items, min_support, max_len)
    return fi, filter_rules(generate_rules(fi, min_confidence), min_lift)


# A7
def rules_with_consequent(rules: DataFrame, item: str) -> DataFrame:
    """Rules whose consequent set contains ``item`` (membership, not text)."""
    return rules.filter(F.array_contains("consequents", item)).orderBy(F.desc("lift"), "antecedents", "consequents")


# A8
def top_rules(rules: DataFrame, n: int = 20, metric: str = "lift") -> DataFrame:
    return rules.orderBy(F.desc(metric), "antecedents", "consequents").limit(n)


# A9
def rules_summary(rules: DataFrame) -> DataFrame:
    return rules.agg(F.count(F.lit(1)).alias("n_rules"), F.avg("support").alias("mean_support"),
                     F.avg("confidence").alias("mean_confidence"), F.avg("lift").alias("mean_lift"),
                     F.max("lift").alias("max_lift"))


# A10
def format_rules(rules: DataFrame, digits: int = 4) -> DataFrame:
    return rules.select(F.array_join(F.array_sort("antecedents"), ", ").alias("antecedents"),
                        F.array_join(F.array_sort("consequents"), ", ").alias("consequents"),
                        F.round("support", digits).alias("support"),
                        F.round("confidence", digits).alias("confidence"),
                        F.round("lift", digits).alias("lift"))


# A11
def empty_rules(spark) -> DataFrame:
    return spark.createDataFrame([], RULE_SCHEMA)

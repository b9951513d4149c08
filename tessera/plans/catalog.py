"""Registered queries: each operator bound to the driver's test tables.

Every entry is ``(spark, sf_dir) -> DataFrame`` over whole tables, with an
equivalent DuckDB SQL string when the operator is SQL-expressible.  Computed
doubles are rounded to 6 digits on both sides so the comparison does not
depend on floating-point summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def r6(df: DataFrame) -> DataFrame:
    """Round every double/float column (also inside arrays) to 6 digits."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(c.cast("double"), 6).alias(f.name))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, (T.DoubleType, T.FloatType)):
            out.append(F.transform(c, lambda x: F.round(x.cast("double"), 6)).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


# ------------------------------------------------------------ table bindings

def li(spark, sf):
    """lineitem with a binary label (open line) and a 3-class label."""
    return load(spark, sf, "lineitem").withColumns({
        "label2": (F.col("l_linestatus") == "O").cast("int"),
    })


LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LI_CAT = ["l_returnflag", "l_linestatus", "l_linenumber"]


def cust_sentinels():
    # negative balances and nation 0 play the reference's "impossible value" role
    return {"c_acctbal": lambda x: x < 0, "c_nationkey": 0}


CUST_SENT_SQL = """
  SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
         CASE WHEN c_nationkey = 0 THEN NULL ELSE c_nationkey END AS c_nationkey, c_mktsegment
  FROM customer"""


def cust_fixed(spark, sf):
    from tessera.operators.clean import fix_sentinels
    c = load(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")
    return fix_sentinels(c, cust_sentinels())


def register_all():
    # importing the modules registers their queries
    from tessera.plans import q_profile_clean  # noqa: F401
    for mod in ("q_features_rules", "q_metrics_sampling", "q_cluster", "q_models"):
        try:
            __import__(f"tessera.plans.{mod}")
        except ModuleNotFoundError as e:
            if e.name != f"tessera.plans.{mod}":
                raise
    return QUERIES, ORACLES

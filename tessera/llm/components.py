"""Connected components of an edge table, distributed.

Alternating large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond"): every node of a component ends up linked
to its smallest id.  A step is one minimum per node (partial aggregation) and
one equi-join on the node, which AQE splits where a node has very many edges;
nothing is gathered per node.  Each round is written to the shared checkpoint
folder and the previous one deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_staged, staged


def _stars(pairs: DataFrame) -> DataFrame:
    """Pairs u -> v of one orientation: link every v (and u) to the smallest id seen from u."""
    low = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    linked = pairs.join(low, "u")
    return linked.select(F.col("v").alias("a"), F.col("m").alias("b")).union(low.select(F.col("u").alias("a"), F.col("m").alias("b")))


def _clean(edges: DataFrame) -> DataFrame:
    """a > b, no loops, no repeats."""
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with an edge; component is the smallest node id reachable.

    Runs until the edges are stars around the smallest ids (no round limit)."""
    now = staged(_clean(edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))), "cc-edges")
    while True:
        # large star: neighbours above a node move to the smallest id around it
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        up = now.select(F.col("b").alias("u"), F.col("a").alias("v"))
        large = up.join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        # small star: a node and its smaller neighbours move to the smallest of them
        small = _clean(_stars(_clean(large).select(F.col("a").alias("u"), F.col("b").alias("v"))))
        new = staged(small, "cc-edges")
        drop_staged(now)
        now = new
        # done when every node has one edge and no centre has an edge upwards
        centres = now.select(F.col("b").alias("a")).distinct()
        unfinished = now.groupBy("a").count().filter("count > 1").limit(1).count() + now.join(centres, "a", "left_semi").limit(1).count()
        if not unfinished:
            break
    members = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

"""Connected components of an edge table (used by DBSCAN, K5).

Alternating star steps: around every node, its larger neighbours move to the
smallest id in sight (large star), then the node and its smaller neighbours do
(small star), until every component is a star around its smallest id.  A step is
a minimum per node (partial aggregation) and a join on the node, which AQE
splits where one node has very many edges; nothing is keyed by the component, so
a giant component is no hot key.  Every round is written to the shared folder
and the round before is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import drop_shared, write_shared


def _edges(pairs: DataFrame) -> DataFrame:
    """hi > lo, each edge once."""
    return (pairs.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return _edges(e.select(F.col("lo").alias("u"), F.col("hi").alias("a")).join(low, "u").select("a", F.col("m").alias("b")))


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = e.join(low, "hi").select(F.col("lo").alias("a"), F.col("m").alias("b"))
    return _edges(moved.union(low.select(F.col("hi").alias("a"), F.col("m").alias("b"))))


def connected_components(vertices: DataFrame, edges: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """(vid, lab) of every vertex; lab is the smallest vertex id of its component.

    ``edges`` holds (id_a, id_b) in one or both directions.  Rounds go on until
    nothing changes; with ``max_rounds``, more rounds raise an error."""
    now = write_shared(_edges(edges.select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))), "edges")
    mark, rounds = None, 0
    while True:
        new = write_shared(_small_star(_large_star(now)), "edges")
        drop_shared(now)
        now = new
        rounds += 1
        got = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)"))).first())
        if got == mark or not got[0]:
            break
        mark = got
        if max_rounds is not None and rounds >= max_rounds:
            raise RuntimeError(f"components still change after {max_rounds} rounds")
    return vertices.select("vid").join(now.select(F.col("hi").alias("vid"), "lo"), "vid", "left").select("vid", F.coalesce("lo", "vid").alias("lab"))

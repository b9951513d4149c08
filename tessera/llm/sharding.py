"""Minimum-cost-flow resharding.

Given the byte sizes of the present shards and the capacities of the new ones,
a minimum-cost flow over (old shard -> new shard) arcs finds the block
transfers that move the fewest bytes (an arc from a shard to itself is free).
Each old shard is then read as one sequence of rows; the flow cuts it into
consecutive blocks, the block that stays first, and a row goes where the
middle of its bytes falls.  Only the shard sizes reach the driver (one number
per old shard: a manifest); rows are numbered with bucketed running sums, so a
shard with a third of the corpus is spread over many tasks.

Null texts count as empty (size 1, crc 0); null shard labels form the layout's
shard of the empty name; repeated rows and repeated ids are separate rows;
an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop_staged, gapless_rank, running_sum, staged, with_row_id

ROWS_PER_FILE = 1_000_000


def min_cost_flow(supply: list[int], capacity: list[int], cost) -> dict[tuple[int, int], int]:
    """Cheapest transport of ``supply`` into ``capacity``: {(i, j): units}.

    Successive shortest paths with potentials (Dijkstra on the residual
    bipartite graph).  ``cost(i, j)`` is the price per unit, at least 0."""
    if sum(capacity) < sum(supply):
        raise ValueError("capacities are smaller than the shards")
    n, m = len(supply), len(capacity)
    left, room = list(supply), list(capacity)
    price = [[cost(i, j) for j in range(m)] for i in range(n)]
    flow: dict[tuple[int, int], int] = {}
    pot = [0.0] * (n + m)
    while any(left):
        dist = [float("inf")] * (n + m)
        via = [-1] * (n + m)
        heap = [(0.0, i) for i in range(n) if left[i] > 0]
        for _, i in heap:
            dist[i] = 0.0
        heapq.heapify(heap)
        while heap:
            d, u = heapq.heappop(heap)
            if d > dist[u]:
                continue
            if u < n:
                step = ((n + j, price[u][j]) for j in range(m))
            else:
                step = ((i, -price[i][u - n]) for i in range(n) if flow.get((i, u - n), 0) > 0)
            for v, c in step:
                nd = d + c + pot[u] - pot[v]
                if nd < dist[v] - 1e-12:
                    dist[v], via[v] = nd, u
                    heapq.heappush(heap, (nd, v))
        end = min((j for j in range(m) if room[j] > 0), key=lambda j: dist[n + j] + pot[n + j])
        path, v = [], n + end
        while via[v] >= 0:
            path.append((via[v], v))
            v = via[v]
        push = min([left[v], room[end]] + [flow[(b, a - n)] for a, b in path if a >= n])
        for a, b in path:
            if a < n:
                flow[(a, b - n)] = flow.get((a, b - n), 0) + push
            else:
                flow[(b, a - n)] -= push
        left[v] -= push
        room[end] -= push
        far = max(x for x in dist if x < float("inf"))
        pot = [p + min(d, far) for p, d in zip(pot, dist)]
    return {k: f for k, f in flow.items() if f > 0}


def plan_transfers(old_bytes: dict[int, int], capacity: list[int]) -> list[tuple[int, int, int, int]]:
    """Blocks (old shard, new shard, first byte, end byte) moving the fewest bytes."""
    olds = sorted(old_bytes)
    flow = min_cost_flow([old_bytes[o] for o in olds], capacity, lambda i, j: 0 if olds[i] == j else 1)
    blocks = []
    for i, o in enumerate(olds):
        at = 0
        mine = sorted(((j, f) for (a, j), f in flow.items() if a == i), key=lambda x: (x[0] != o, x[0]))
        for k, (j, f) in enumerate(mine):
            end = 1 << 62 if k == len(mine) - 1 else at + f
            blocks.append((o, j, at, end))
            at += f
    return blocks


def equal_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (i < total % shards) for i in range(shards)]


def reshard(rows: DataFrame, n_shards: int, capacity=None) -> DataFrame:
    """Place rows (``rid`` unique and staged, ``old_shard`` int, ``size`` long) into ``n_shards``.

    Adds ``shard`` int and ``slot`` long (0.. inside each shard).  ``capacity``
    is a list of bytes per new shard, equal shares if None."""
    spark = rows.sparkSession
    per = rows.groupBy("old_shard").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    n_rows = sum(r["n"] for r in per)
    old_bytes = {r["old_shard"]: r["b"] for r in per}
    capacity = capacity or equal_capacities(sum(old_bytes.values()), n_shards)
    blocks = plan_transfers(old_bytes, capacity)
    schema = T.StructType([T.StructField(c, T.IntegerType()) for c in ("b_old", "shard")]
                          + [T.StructField(c, T.LongType()) for c in ("b_lo", "b_hi")])
    # at most (old shards x new shards) rows: bounded by the two manifests, not by the corpus
    plan = F.broadcast(spark.createDataFrame(blocks, schema))
    placed = running_sum(rows, ["old_shard"], "rid", n_rows, "size", "at")
    mid = F.col("at") + F.floor(F.col("size") / 2)
    placed = placed.join(plan, (F.col("old_shard") == F.col("b_old")) & (mid >= F.col("b_lo")) & (mid < F.col("b_hi")))
    placed = placed.drop("at", "b_old", "b_lo", "b_hi")
    return gapless_rank(placed, ["shard"], "rid", n_rows, "slot")


def layout_by_source(docs: DataFrame, n_old: int) -> DataFrame:
    """(doc_id, size, text_crc32, old_shard, rid): the present layout keeps a source in one of ``n_old`` shards."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return with_row_id(docs.select(
        F.col("doc_id"),
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.pmod(F.crc32(F.coalesce(F.col("source").cast("string"), F.lit("")).cast("binary")), F.lit(n_old))
        .cast("int").alias("old_shard")))


def reshard_documents(docs: DataFrame, n_shards: int = 16, n_old: int = 12) -> DataFrame:
    """Digest of the resharding of ``docs``: one row per document."""
    out = reshard(staged(layout_by_source(docs, n_old), "shard-rows"), n_shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "old_shard")


class Rewrite(NamedTuple):
    """Shards of a rewritten layout: ``written`` have new files, ``emptied`` stay without rows, ``removed`` are no more."""

    written: list[int]
    emptied: list[int]
    removed: list[int]


def rewrite_layout(rows: DataFrame, n_shards: int, capacity: list[int] | None, out_dir: str) -> Rewrite:
    """Reshard whole rows and rewrite only the shards that change, also in the folder they came from.

    ``rows`` carry ``old_shard``, ``size`` and a unique, staged ``rid`` besides
    their own columns, whatever the names of those; a column ``shard`` is the old
    layout's and is replaced.  Shards that neither lose nor gain rows are left
    alone.  The others are first written whole to a new folder inside
    ``out_dir``; only then each ``out_dir/shard=k`` moves aside, its successor
    takes its place, and the old files go last, so a job that is lost before the
    swap leaves the layout as it was.  Files hold the columns of ``rows`` but
    ``old_shard`` and ``rid``, in order of the new slots."""
    spark = rows.sparkSession
    own = [c for c in rows.columns if c not in ("old_shard", "size", "rid", "shard")]
    packed = rows.select("old_shard", "size", "rid", F.struct(F.lit(True).alias("any"), *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(own)]).alias("row"))
    placed = staged(reshard(packed, n_shards, capacity), "shard-placed")
    pairs = placed.filter("old_shard <> shard").select("old_shard", "shard").distinct().collect()      # at most old x new shards
    touched = {r["shard"] for r in pairs} | {r["old_shard"] for r in pairs}
    held = {r["shard"] for r in placed.select("shard").distinct().collect()}
    written = sorted(touched & held)
    gone = sorted(touched - held)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    tag = uuid.uuid4().hex[:12]

    def path(*parts):
        return jvm.org.apache.hadoop.fs.Path("/".join((out_dir.rstrip("/"), *parts)))
    fs = path().getFileSystem(conf)
    if written:
        out = placed.filter(F.col("shard").isin(written)).repartition("shard", F.floor(F.col("slot") / ROWS_PER_FILE)).sortWithinPartitions("shard", "slot")
        out.select(*[F.col(f"row.c{k}").alias(c) for k, c in enumerate(own)], "size", "shard").write.partitionBy("shard").parquet(f"{out_dir.rstrip('/')}/_new-{tag}")
    fs.mkdirs(path(f"_old-{tag}"))
    for k in written + gone:
        if fs.exists(path(f"shard={k}")) and not fs.rename(path(f"shard={k}"), path(f"_old-{tag}", f"shard={k}")):
            raise OSError(f"shard {k} could not be moved aside; its files are unchanged")
        if k in held and not fs.rename(path(f"_new-{tag}", f"shard={k}"), path(f"shard={k}")):
            raise OSError(f"shard {k} could not be put in place; its rows are in _new-{tag} of the layout")
    fs.delete(path(f"_old-{tag}"), True)
    fs.delete(path(f"_new-{tag}"), True)
    drop_staged(placed)
    return Rewrite(written, [k for k in gone if k < n_shards], [k for k in gone if k >= n_shards])


def rewrite_affected(rows: DataFrame, n_shards: int, capacity: list[int] | None, out_dir: str) -> list[int]:
    """The shards that ``rewrite_layout`` wrote."""
    return rewrite_layout(rows, n_shards, capacity, out_dir).written

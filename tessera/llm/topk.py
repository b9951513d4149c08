"""Exact top-k search by integer inner product with block-at-a-time pruning.

Rows are grouped into blocks of about ``BLOCK_ROWS`` similar vectors (nearest
of the pivots fitted on a bounded sample; a crowded pivot is split by hash, so
no block grows with the number of equal vectors).  A block is one row of the
staged index: its forward index (row ids and the integer matrix) and, per
component ("term"), the largest and smallest value.

For a query the block bound is the sum over components of the larger of
q * max and q * min.  Each query takes the blocks of a task in descending
order of its bounds, scores them through their forward index and stops at the
first bound below its present k-th score (ties go on, they may have smaller
ids).  The k-th score starts from the query's exact scores against the pivot
sample, a lower bound that prunes from the first block on.  Queries travel in
chunks of ``QUERY_CHUNK`` (a bounded broadcast) over the index, so neither
vectors nor queries are shuffled against each other; each task returns at most
k rows per query and a window keeps the best.

Vectors that are null, empty or hold null or non-finite components take no
part, nor do rows without id.  Shorter vectors count as padded with zeros.
Equal ids on different rows are different candidates; a row is never its own
candidate.  Scores are exact while 64-bit floats hold them (below 2**53).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, with_row_id

BLOCK_ROWS = 1024
SAMPLE_ROWS = 4096
MAX_PIVOTS = 512      # pivots only shape the blocks; every row is indexed whatever their number
QUERY_CHUNK = 8192
SCALE = 64.0


def _matrix(cells, dim: int) -> np.ndarray:
    out = np.zeros((len(cells), dim))
    for i, c in enumerate(cells):
        v = np.frombuffer(c, dtype="<f8")
        out[i, :len(v)] = v
    return out


def quantised(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, rid, dim, vec): floor(64 x) as packed doubles of the vectors that take part."""
    src = with_row_id(df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("_v")))

    def run(batches):
        for pdf in batches:
            keep, vecs = [], []
            for i, v in enumerate(pdf["_v"]):
                if v is None or len(v) == 0:
                    continue
                x = np.asarray([np.nan if c is None else c for c in v] if v.dtype == object else v, dtype="f8")
                if np.isfinite(x).all():
                    keep.append(i)
                    vecs.append(np.floor(SCALE * x).astype("<f8"))
            part = pdf.iloc[keep]
            yield pd.DataFrame({"vec_id": part["vec_id"].to_numpy(dtype="int64"), "rid": part["rid"].to_numpy(),
                                "dim": [len(v) for v in vecs], "vec": [v.tobytes() for v in vecs]})
    return src.filter("vec_id IS NOT NULL").mapInPandas(run, "vec_id long, rid long, dim int, vec binary")


def fit_pivots(sample: np.ndarray, k: int, rounds: int = 5) -> np.ndarray:
    """A few k-means rounds on the bounded sample (deterministic start)."""
    k = max(1, min(k, len(sample)))
    pivots = sample[np.linspace(0, len(sample) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = (sample @ pivots.T - (pivots ** 2).sum(1) / 2).argmax(1)
        for j in np.unique(near):
            pivots[j] = sample[near == j].mean(0)
    return pivots


def build_blocks(vectors: DataFrame, pivots: np.ndarray, n_rows: int, dim: int) -> DataFrame:
    """The staged block index: ids, rids, mat (packed), hi, lo per block."""
    half = (pivots ** 2).sum(1) / 2

    def nearest(batches):
        for pdf in batches:
            if len(pdf):
                m = _matrix(pdf["vec"].tolist(), dim)
                pdf["pivot"] = (m @ pivots.T - half).argmax(1).astype("int32")
                yield pdf
    rows = vectors.mapInPandas(nearest, "vec_id long, rid long, dim int, vec binary, pivot int")
    sizes = {r["pivot"]: r["count"] for r in rows.groupBy("pivot").count().collect()}  # at most MAX_PIVOTS
    parts = F.create_map(*[F.lit(x) for p, c in sizes.items() for x in (p, max(1, -(-c // BLOCK_ROWS)))])
    rows = rows.withColumn("part", F.pmod(F.xxhash64("rid"), parts[F.col("pivot")]).cast("int"))

    def pack(key, pdf):
        pdf = pdf.sort_values(["vec_id", "rid"])
        m = _matrix(pdf["vec"].tolist(), dim)
        return pd.DataFrame({"ids": [pdf["vec_id"].to_numpy("<i8").tobytes()], "rids": [pdf["rid"].to_numpy("<i8").tobytes()],
                             "mat": [m.tobytes()], "hi": [m.max(0).tobytes()], "lo": [m.min(0).tobytes()]})
    schema = "ids binary, rids binary, mat binary, hi binary, lo binary"
    return staged(rows.groupBy("pivot", "part").applyInPandas(pack, schema), "topk-blocks")


class _Best:
    """The k best (score, id) of every query so far; ``kth`` bounds them from below."""

    def __init__(self, n: int, k: int, kth: np.ndarray):
        self.k, self.kth = k, kth.copy()
        self.q = np.empty(0, "i8")
        self.s = np.empty(0)
        self.v = np.empty(0, "i8")

    def add(self, q, s, v):
        if len(q):
            self.q, self.s, self.v = np.concatenate([self.q, q]), np.concatenate([self.s, s]), np.concatenate([self.v, v])

    def trim(self):
        if not len(self.q):
            return
        o = np.lexsort((self.v, -self.s, self.q))
        q, s, v = self.q[o], self.s[o], self.v[o]
        first = np.r_[0, np.flatnonzero(np.diff(q)) + 1]
        rank = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
        keep = rank < self.k
        last = rank == self.k - 1
        self.kth[q[last]] = np.maximum(self.kth[q[last]], s[last])
        self.q, self.s, self.v = q[keep], s[keep], v[keep]


def search_blocks(blocks: list[dict], queries: np.ndarray, q_rids: np.ndarray, best: _Best, dim: int) -> int:
    """Score the blocks for every query in descending order of its bounds; returns scored (query, block) pairs."""
    hi = np.stack([np.frombuffer(b["hi"], "<f8") for b in blocks])
    lo = np.stack([np.frombuffer(b["lo"], "<f8") for b in blocks])
    bound = np.maximum(queries, 0) @ hi.T + np.minimum(queries, 0) @ lo.T
    order = np.argsort(-bound, axis=1, kind="stable")
    live = np.arange(len(queries))
    loaded: dict[int, tuple] = {}
    scored = 0
    for step in range(len(blocks)):
        nxt = order[live, step]
        on = bound[live, nxt] >= best.kth[live]
        live, nxt = live[on], nxt[on]   # bounds only fall: a pruned query is done with these blocks
        if not len(live):
            break
        for b in np.unique(nxt):
            if b not in loaded:
                x = blocks[b]
                loaded[b] = (np.frombuffer(x["ids"], "<i8"), np.frombuffer(x["rids"], "<i8"), np.frombuffer(x["mat"], "<f8").reshape(-1, dim))
            ids, rids, mat = loaded[b]
            qs = live[nxt == b]
            scored += len(qs)
            score = queries[qs] @ mat.T
            i, j = np.nonzero((score >= best.kth[qs][:, None]) & (rids[None, :] != q_rids[qs][:, None]))
            best.add(qs[i], score[i, j], ids[j])
        best.trim()
    return scored


def top_k(df: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id is divisible by ``every``."""
    spark = df.sparkSession
    vectors = staged(quantised(df), "topk-vectors")
    stat = vectors.agg(F.count("*").alias("n"), F.max("dim").alias("d")).first()
    schema = "query_rid long, query_id long, vec_id long, score long"
    if not stat["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dim = stat["d"]
    sample = vectors.orderBy(F.xxhash64("rid"), "rid").limit(SAMPLE_ROWS).collect()
    sample_m, sample_r = _matrix([r["vec"] for r in sample], dim), np.array([r["rid"] for r in sample])
    pivots = fit_pivots(sample_m, min(MAX_PIVOTS, -(-stat["n"] // BLOCK_ROWS)))
    blocks = build_blocks(vectors, pivots, stat["n"], dim)

    def start(queries, rids):
        """k-th best score against the sample: a lower bound of the true one."""
        s = queries @ sample_m.T
        s[rids[:, None] == sample_r[None, :]] = -np.inf
        return -np.partition(-s, k - 1, axis=1)[:, k - 1] if s.shape[1] >= k else np.full(len(queries), -np.inf)

    found = None
    asked = vectors.filter(F.col("vec_id") % every == 0)
    chunk: list = []

    def search(chunk):
        q_m = _matrix([r["vec"] for r in chunk], dim)
        q_r, q_id = np.array([r["rid"] for r in chunk]), np.array([r["vec_id"] for r in chunk])
        shared = spark.sparkContext.broadcast((q_m, q_r, q_id, start(q_m, q_r)))

        def run(batches):
            queries, rids, qids, kth = shared.value
            best = _Best(len(queries), k, kth)
            for rb in batches:
                rows = rb.to_pylist()
                if rows:
                    search_blocks(rows, queries, rids, best, dim)
            import pyarrow as pa
            yield pa.RecordBatch.from_arrays(
                [pa.array(rids[best.q]), pa.array(qids[best.q]), pa.array(best.v), pa.array(best.s.astype("i8"))],
                names=["query_rid", "query_id", "vec_id", "score"])
        return staged(blocks.mapInArrow(run, schema), "topk-found")

    for r in asked.toLocalIterator():
        chunk.append(r)
        if len(chunk) == QUERY_CHUNK:
            part = search(chunk)
            found, chunk = part if found is None else found.unionByName(part), []
    if chunk:
        part = search(chunk)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    w = Window.partitionBy("query_rid").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Clustering (K0-K10) and cluster validity.

Inputs are a row id plus a feature column (array or ML vector).  Validity
scores rest on a table with one row per cluster (size, centre, sum of squared
and mean distance to it), so any number of clusters works:

* silhouette: with squared Euclidean distance from that table (the mean of
  |x - y|^2 over a cluster is |x - c|^2 plus the cluster's mean square), or
  ``mode="euclidean"``, exact, which compares all rows in pairs of blocks: n^2 / 2
  distances, for tables where that is affordable;
* Davies-Bouldin: tiles of clusters against tiles of clusters;
* Calinski-Harabasz and inertia: sums over the table.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.order_stats import ordered_cumsum
from tessera.operators.block_pairs import SCREEN_CELLS, NearPairs, each_pair, pack_blocks, paired, place_rows
from tessera.operators.components import connected_components
from tessera.operators.neighbors import _exact, block_rows, compare_tiles, sq_dist, to_array
from tessera.operators.pivot_tree import sq_distances
from tessera.session import drop_shared, join_rows, write_shared


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


CENTRE_BYTES = 32 << 20       # centres up to this size are broadcast for the silhouette; beyond it they meet the rows in tiles


# ------------------------------------------------------------------ stats
def _members(df: DataFrame, features: str, cluster: str) -> DataFrame:
    """(k, x) of the rows that are not noise."""
    return df.filter(F.col(cluster) != -1).select(F.col(cluster).alias("k"), to_array(df, features).alias("x"))


def _sq(a: str, b: str, dim: int) -> Column:
    """Squared distance of two array columns, unrolled for code generation."""
    terms = [(F.col(a)[i] - F.col(b)[i]) * (F.col(a)[i] - F.col(b)[i]) for i in range(dim)]
    return sum(terms[1:], terms[0]) if terms else F.lit(0.0)


def cluster_stats(df: DataFrame, features: str, cluster: str = "cluster") -> DataFrame:
    """One row per cluster, noise (-1) left out: k, j (a number), n, centre c, w (sum of squared
    distances to c), m (mean distance to c).  Two passes over the rows; written, so it is computed once."""
    rows = _members(df, features, cluster)
    head = rows.select(F.size("x")).first()
    if head is None:
        kind = df.schema[cluster].dataType.simpleString()
        return df.sparkSession.createDataFrame([], f"k {kind}, j long, n long, c array<double>, w double, m double")
    dim = head[0]
    table = write_shared(rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.avg(F.col("x")[i]) for i in range(dim)]).alias("c"))
                         .withColumn("j", F.monotonically_increasing_id()), "clusters")
    d2 = _sq("x", "c", dim)
    spread = rows.join(table, "k").select("k", d2.alias("d2")).groupBy("k").agg(F.sum("d2").alias("w"), F.avg(F.sqrt("d2")).alias("m"))
    return write_shared(table.join(spread, "k").select("k", "j", "n", F.col("c").cast("array<double>").alias("c"), "w", "m"), "clusters")


# ------------------------------------------------------------------ M9
def _squared_scores(X, own, C, v, n):
    """(a, b) per row: mean squared distance within its own cluster (numbered ``own``; -1: not among these) and to the nearest other one."""
    a, b = np.full(len(X), np.nan), np.full(len(X), np.inf)
    step = max(1, 4_000_000 // len(C))
    for lo in range(0, len(X), step):
        at = np.arange(lo, min(lo + step, len(X)))
        d = sq_distances(X[at], C) + v[None, :]
        has = np.flatnonzero(own[at] >= 0)
        mine = own[at][has]
        with np.errstate(divide="ignore", invalid="ignore"):
            a[at[has]] = np.where(n[mine] > 1, d[has, mine] * n[mine] / (n[mine] - 1), np.nan)
        d[has, mine] = np.inf
        b[at] = d.min(1)
    return a, b


def _score(a: Column, b: Column) -> Column:
    """Silhouette of a row; members of singletons (no ``a``) score 0."""
    top = F.greatest(a, b)
    return F.when(a.isNull() | F.isnan(a) | (top <= 0), F.lit(0.0)).otherwise((b - a) / top)


def silhouette_sq(df: DataFrame, features: str, cluster: str = "cluster", stats: DataFrame | None = None,
                  centre_bytes: int = CENTRE_BYTES) -> float | None:
    """Mean silhouette with squared Euclidean distance (noise excluded).
    Singletons score 0; a(i) averages over the other members of i's cluster.

    Every row meets every centre: from a broadcast while the centres' size, which
    is checked, is at most ``centre_bytes``, else in tiles.  Distances are taken
    around the centres' mean, so data far from the origin lose no digits."""
    stats = cluster_stats(df, features, cluster) if stats is None else stats
    k = stats.count()
    if k < 2:
        return None
    dim = len(stats.select("c").first()[0])
    rows = _members(df, features, cluster).join(stats.select("k", "j"), "k").select("x", "j")
    if k * (dim + 3) * 8 <= centre_bytes:
        pdf = stats.select("j", "n", "c", (F.col("w") / F.col("n")).alias("v")).toPandas().sort_values("j")
        C = np.stack(pdf["c"].to_numpy()).astype(float)
        about = (pdf["j"].to_numpy(), pdf["n"].to_numpy(float), C - C.mean(0), pdf["v"].to_numpy(float), C.mean(0))
        shared = df.sparkSession.sparkContext.broadcast(about)

        def run(batches):
            j, n, centre, v, origin = shared.value
            for b in batches:
                if len(b):
                    got = _squared_scores(np.stack(b["x"].to_numpy()).astype(float) - origin, np.searchsorted(j, b["j"].to_numpy()), centre, v, n)
                    yield pd.DataFrame({"a": got[0], "b": got[1]})
        scored = rows.mapInPandas(run, "a double, b double")
    else:
        held = write_shared(rows.withColumn("_id", F.monotonically_increasing_id()), "members")
        homes = stats.select(F.col("j").alias("_id"), F.concat("c", F.array(F.col("w") / F.col("n"), F.col("n").cast("double"))).alias("_v"))
        asks = held.select("_id", F.concat("x", F.array(F.col("j").cast("double"))).alias("_v"))

        def tile(home, ask):
            H, Q = np.stack(home["_v"].to_numpy()), np.stack(ask["_v"].to_numpy())
            at = {i: p for p, i in enumerate(home["_id"])}
            own = np.array([at.get(int(j), -1) for j in Q[:, dim]])
            origin = H[:, :dim].mean(0)
            a, b = _squared_scores(Q[:, :dim] - origin, own, H[:, :dim] - origin, H[:, dim], H[:, dim + 1])
            return pd.DataFrame({"_id": ask["_id"].to_numpy(), "a": a, "b": b})
        parts = compare_tiles(homes, asks, tile, "_id long, a double, b double")
        scored = parts.groupBy("_id").agg(F.max(F.when(~F.isnan("a"), F.col("a"))).alias("a"), F.min("b").alias("b"))
    return scored.agg(F.avg(_score(F.col("a"), F.col("b")))).first()[0]


class _Members:
    """A packed block of rows in order of their clusters (val: cluster's number, its rows, 1 if it is cut over blocks)."""

    def __init__(self, block):
        order = np.argsort(block.val[:, 0], kind="stable")
        self.b, self.X, self.centre = block.b, block.X[order], block.centre
        val = block.val[order]
        self.start = np.flatnonzero(np.r_[True, val[1:, 0] != val[:-1, 0]])
        self.number, self.size = val[self.start, 0], val[self.start, 1]
        self.cut = bool(val[0, 2])
        self.own = np.repeat(np.arange(len(self.start)), np.diff(np.r_[self.start, len(val)]))


def _distances(A: _Members, B: _Members, lo: int, hi: int) -> np.ndarray:
    """Euclidean distances of rows lo..hi of A to all of B; small ones from differences, so no digits are lost."""
    origin = (A.centre + B.centre) / 2
    P, Q = A.X[lo:hi] - origin, B.X - origin
    pn, qn = (P * P).sum(1), (Q * Q).sum(1)
    d = P @ Q.T
    d *= -2.0
    d += pn[:, None]
    d += qn[None, :]
    i, j = np.nonzero(d <= 1e-4 * (pn.max() + qn.max()))
    np.sqrt(np.maximum(d, 0.0, out=d), out=d)
    d[i, j] = _exact(A.X[lo:hi], B.X, i, j)
    return d


def _silhouette_parts(pairs):
    """((block, cluster, its rows, whether its own), sums of distances) for clusters cut over blocks, and for those
    that lie whole in a block ((block, -1, 0, False), smallest mean distance) and ((block, -2, 0, True), own mean distance)."""
    out = {}

    def put(key, value, how):
        out[key] = how(out[key], value) if key in out else value

    def take(M, sums, N):
        """``sums`` (rows of M x clusters of N) of all of N's rows, or of some if N's cluster is cut."""
        if N.cut:
            put((M.b, N.number[0], N.size[0], M.cut and M.number[0] == N.number[0]), sums[:, 0], np.add)

    last = None
    for x, y in each_pair(pairs):
        A = last if last is not None and last.b == x.b else _Members(x)
        last = A
        B = A if x is y else _Members(y)
        step = max(1, SCREEN_CELLS // len(B.X))
        to_b, best_a, own_a = [], [], []
        best_b, carry, sums_b = np.full(len(B.X), np.inf), 0.0, np.zeros(len(B.X))
        for lo in range(0, len(A.X), step):
            hi = min(lo + step, len(A.X))
            d = _distances(A, B, lo, hi)
            sums = np.add.reduceat(d, B.start, axis=1)
            if B.cut:
                to_b.append(sums)
            else:
                if A is B:
                    at, own = np.arange(hi - lo), A.own[lo:hi]
                    with np.errstate(divide="ignore", invalid="ignore"):
                        own_a.append(np.where(B.size[own] > 1, sums[at, own] / (B.size[own] - 1), np.nan))
                    sums[at, own] = np.inf
                best_a.append((sums / B.size).min(1))
            if A is B:
                continue
            if A.cut:
                sums_b += d.sum(0)
                continue
            # clusters of A that end here; one that goes on is carried to the next rows
            groups = np.arange(A.own[lo], A.own[hi - 1] + 1)
            back = np.add.reduceat(d, np.maximum(A.start[groups] - lo, 0), axis=0)
            back[0] += carry
            done = len(groups) if hi == len(A.X) or A.own[hi] != A.own[hi - 1] else len(groups) - 1
            carry = back[done] if done < len(groups) else 0.0
            if done:
                best_b = np.minimum(best_b, (back[:done] / A.size[groups[:done], None]).min(0))
        if B.cut:
            take(A, np.concatenate(to_b), B)
        else:
            put((A.b, -1.0, 0.0, False), np.concatenate(best_a), np.minimum)
            if A is B:
                put((A.b, -2.0, 0.0, True), np.concatenate(own_a), np.minimum)
        if A is not B:
            if A.cut:
                take(B, sums_b[:, None], A)
            else:
                put((B.b, -1.0, 0.0, False), best_b, np.minimum)
    return list(out.items())


def _mean_of(part):
    """(block, (own mean distance or None, mean distance to another cluster or None)) of a part whose sums are whole."""
    (b, number, n, own), v = part
    if number >= 0:
        v = v / n if not own else v / (n - 1) if n > 1 else np.full(len(v), np.nan)
    return b, ((v, None) if own else (None, v))


def _block_score(part) -> tuple:
    """(sum of the rows' silhouettes, rows) of a block."""
    a, b = part
    with np.errstate(invalid="ignore", divide="ignore"):
        s = np.where(np.isnan(a) | ~(np.maximum(a, b) > 0), 0.0, (b - a) / np.maximum(a, b))
    return float(s.sum()), len(s)


def silhouette_euclidean(df: DataFrame, features: str, cluster: str = "cluster", stats: DataFrame | None = None,
                         tile_rows: int | None = None) -> float | None:
    """Mean silhouette with Euclidean distance, exact (noise excluded, singletons score 0).

    All rows are compared: n^2 / 2 distances in all, in pairs of blocks of rows
    (:mod:`tessera.operators.block_pairs`), so neither rows nor distances are copied to disk.
    Clusters larger than a block are cut over blocks of their own, the others lie whole in
    one, so a pair of blocks leaves a number per row whatever the number of clusters."""
    stats = cluster_stats(df, features, cluster) if stats is None else stats
    if stats.count() < 2:
        return None
    head = stats.agg(F.max(F.size("c")), F.sum("n")).first()
    n = int(head[1])
    room = tile_rows or block_rows(n, head[0], 1)
    one = stats.select("k", "j", F.col("n").cast("double").alias("n"), F.when(F.col("n") > room, F.ceil(F.col("n") / room)).otherwise(0).cast("double").alias("pieces"))
    one = ordered_cumsum(one.withColumn("own", F.when(F.col("pieces") > 0, 0.0).otherwise(F.col("n"))), "j", ["own", "pieces"])
    # whole clusters share even numbers of blocks; pieces of a cut one have odd ones
    shared = 2 * F.floor((F.col("cum_own") - F.col("own")) / room)
    piece = 2 * (F.col("cum_pieces") - 1 - F.pmod(F.xxhash64("_id"), F.greatest(F.col("pieces"), F.lit(1.0)).cast("long"))) + 1
    cut = F.col("pieces") > 0
    rows = _members(df, features, cluster).join(one, "k").withColumn("_id", F.monotonically_increasing_id())
    held = write_shared(rows.select("_id", F.col("x").alias("_v"), "pieces", "n", "cum_pieces", "cum_own", "own", F.col("row_in_group").cast("double").alias("number")), "members")
    packed = pack_blocks(held.select("_id", "_v", F.when(cut, piece).otherwise(shared).cast("long").alias("b"),
                                     F.array("number", "n", cut.cast("double")).alias("val")))
    drop_shared(held)
    records, pairs = paired(packed, n)
    parts = records.getNumPartitions()

    # the smallest mean (a negative number) is no sum
    sums = (pairs.mapPartitions(_silhouette_parts).map(lambda p: (p[0], (p[0][1] >= 0, p[1])))
            .reduceByKey(lambda x, y: (x[0], x[1] + y[1] if x[0] else np.minimum(x[1], y[1])), parts).mapValues(lambda v: v[1]))

    def nearer(x, y):
        return (y[0] if x[0] is None else x[0], y[1] if x[1] is None else x[1] if y[1] is None else np.minimum(x[1], y[1]))
    total, count = sums.map(_mean_of).reduceByKey(nearer, parts).values().map(_block_score).reduce(lambda x, y: (x[0] + y[0], x[1] + y[1]))
    records.unpersist()
    drop_shared(packed)
    return total / count


def silhouette(df: DataFrame, features: str, cluster: str = "cluster", mode: str = "squared") -> float | None:
    """M9 by ``mode``: "squared" (any table) or "euclidean" (n^2 distances)."""
    return {"squared": silhouette_sq, "euclidean": silhouette_euclidean}[mode](df, features, cluster)


# ------------------------------------------------------------------ M10 / M11 / M14
def davies_bouldin(df: DataFrame, features: str, cluster: str = "cluster", stats: DataFrame | None = None) -> float | None:
    """Mean over clusters of the largest (m_i + m_j) / |c_i - c_j|; clusters with one centre: infinity."""
    stats = cluster_stats(df, features, cluster) if stats is None else stats
    if stats.count() < 2:
        return None
    dim = len(stats.select("c").first()[0])
    points = stats.select(F.col("j").alias("_id"), F.concat("c", F.array("m")).alias("_v"))

    def tile(home, ask):
        H, Q = np.stack(home["_v"].to_numpy()), np.stack(ask["_v"].to_numpy())
        hid, best = home["_id"].to_numpy(), []
        for i, q in zip(ask["_id"], Q):
            d = np.sqrt(((H[:, :dim] - q[:dim]) ** 2).sum(1))
            with np.errstate(divide="ignore", invalid="ignore"):
                r = np.where(d > 0, (H[:, dim] + q[dim]) / d, np.inf)
            best.append(np.where(hid == i, -np.inf, r).max())
        return pd.DataFrame({"_id": ask["_id"].to_numpy(), "r": best})
    worst = compare_tiles(points, None, tile, "_id long, r double").groupBy("_id").agg(F.max("r").alias("r"))
    return worst.agg(F.avg("r")).first()[0]


def within_ss(df: DataFrame, features: str, cluster: str = "cluster", centers: dict | None = None,
              stats: DataFrame | None = None) -> float:
    """Inertia: sum of squared distances to the cluster centre (mean by default)."""
    if centers is None:
        stats = cluster_stats(df, features, cluster) if stats is None else stats
        return float(stats.agg(F.sum("w")).first()[0] or 0.0)
    rows = _members(df, features, cluster)
    given = df.sparkSession.createDataFrame([(c, [float(x) for x in v]) for c, v in centers.items()],
                                            T.StructType([T.StructField("k", df.schema[cluster].dataType), T.StructField("c", T.ArrayType(T.DoubleType()))]))
    return float(rows.join(given, "k").agg(F.sum(sq_dist(F.col("x"), F.col("c")))).first()[0] or 0.0)


def calinski_harabasz(df: DataFrame, features: str, cluster: str = "cluster", stats: DataFrame | None = None) -> float | None:
    stats = cluster_stats(df, features, cluster) if stats is None else stats
    k = stats.count()
    if k < 2:
        return None
    dim = len(stats.select("c").first()[0])
    n = F.col("n").cast("double")
    total = stats.agg(F.sum(n).alias("n"), F.sum("w").alias("w"), *[(F.sum(F.col("c")[i] * n) / F.sum(n)).alias(f"m{i}") for i in range(dim)]).first()
    off = [(F.col("c")[i] - F.lit(total[f"m{i}"])) * (F.col("c")[i] - F.lit(total[f"m{i}"])) for i in range(dim)]
    between = stats.agg(F.sum(n * sum(off[1:], off[0]))).first()[0]
    return float("inf") if total["w"] == 0 else (between / (k - 1)) / (total["w"] / (total["n"] - k))


# ------------------------------------------------------------------ M12 / K10
def clustering_summary(df: DataFrame, features: str, cluster: str = "cluster", algorithm: str = "KMeans") -> DataFrame:
    """One row: Algorithm, N_clusters, Silhouette, DBI, CHI, n_noise, error.
    Fewer than two non-noise rows or clusters -> only ``error`` is set."""
    spark = df.sparkSession
    stats = cluster_stats(df, features, cluster)
    n_noise = df.filter(F.col(cluster) == -1).count()
    k, n_valid = stats.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    schema = ("Algorithm string, N_clusters int, Silhouette double, DBI double, CHI double, "
              "n_noise bigint, error string")
    if n_valid < 2 or k < 2:
        return spark.createDataFrame([(algorithm, None, None, None, None, n_noise, "not enough clusters")], schema)
    row = (algorithm, k, silhouette_sq(df, features, cluster, stats), davies_bouldin(df, features, cluster, stats),
           calinski_harabasz(df, features, cluster, stats), n_noise, None)
    return spark.createDataFrame([row], schema)


# ------------------------------------------------------------------ K2 / K0
STARTS_AT_ONCE = 8
BLOCK_ROWS = 1_024            # rows of a packed block of vectors
DRIVER_BYTES = 1 << 20        # sums of a pass that reach the driver as they are; more are added up by tasks first


class KMeansFit:
    """Centres of a k-means run and its training cost (of the last pass, as Spark's own summary gives it)."""

    def __init__(self, centres: np.ndarray, cost: float):
        self.centres, self.cost = centres, cost

    def clusterCenters(self) -> list:
        return list(self.centres)

    def predict(self, x: Column) -> Column:
        """Number of the nearest centre of an array column."""
        origin = self.centres.mean(0)
        centres = self.centres - origin

        def nearest(v: pd.Series) -> pd.Series:
            if not len(v):
                return pd.Series([], dtype="int32")
            return pd.Series(sq_distances(np.stack(v.to_numpy()).astype(float) - origin, centres).argmin(1).astype("int32"))
        return F.pandas_udf(nearest, "int")(x)


def _packed(df: DataFrame, features: str) -> RDD:
    """Vectors of ``features`` packed in blocks of at most ``BLOCK_ROWS`` rows: the bytes of their doubles."""
    def run(batches):
        for pdf in batches:
            for lo in range(0, len(pdf), BLOCK_ROWS):
                yield pd.DataFrame({"b": [np.stack(pdf["x"].iloc[lo:lo + BLOCK_ROWS].to_numpy()).astype(float).tobytes()]})
    return df.select(to_array(df, features).alias("x")).mapInPandas(run, "b binary").rdd.map(lambda r: bytes(r[0]))


def _lloyd_pass(blocks: RDD, runs: list, origin: np.ndarray) -> tuple:
    """One pass for several runs at once: (rows, sum of their vectors, sum of squared distances) of every centre, run after run."""
    dim = len(origin)
    cuts = np.cumsum([0] + [len(c) for c in runs])
    shared = blocks.context.broadcast((np.concatenate(runs), cuts, origin))

    def run(packed):
        C, cuts, origin = shared.value
        norm = (C * C).sum(1)
        total = np.zeros((len(C), dim + 2))
        for raw in packed:
            X = np.frombuffer(raw).reshape(-1, dim) - origin
            d = norm[None, :] - 2.0 * (X @ C.T)
            own = np.zeros(d.shape)
            at, sq = np.arange(len(X)), (X * X).sum(1)
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                own[at, lo + d[:, lo:hi].argmin(1)] = 1.0
            total[:, 0] += own.sum(0)
            total[:, 1] += (own * np.maximum(d + sq[:, None], 0.0)).sum(0)
            total[:, 2:] += own.T @ X
        yield total
    parts = blocks.mapPartitions(run)
    size = int(cuts[-1]) * (dim + 2) * 8
    few = blocks.getNumPartitions() * size <= DRIVER_BYTES
    out = sum(parts.collect()) if few else parts.treeReduce(lambda a, b: a + b)
    shared.destroy()
    return out[:, 0], out[:, 2:], out[:, 1], cuts


def _lloyd(blocks: RDD, starts: list, max_iter: int, tol: float) -> list:
    """(centres, cost) of a k-means run from each of ``starts`` (arrays of centres), all in the same passes over the rows.

    A run ends when none of its centres moves by more than ``tol``; the others go on.  A centre without rows stays."""
    origin = np.concatenate(starts).mean(0)
    runs, cost = [c - origin for c in starts], [0.0] * len(starts)
    going = list(range(len(runs)))
    for _ in range(max_iter):
        n, sums, sq, cuts = _lloyd_pass(blocks, [runs[r] for r in going], origin)
        left = []
        for p, r in enumerate(going):
            part = slice(cuts[p], cuts[p + 1])
            cost[r] = float(sq[part].sum())
            has = n[part] > 0
            new = runs[r].copy()
            new[has] = sums[part][has] / n[part][has, None]
            if (((new - runs[r]) ** 2).sum(1) > tol * tol).any():
                left.append(r)
            runs[r] = new
        going = left
        if not going:
            break
    return [(c + origin, v) for c, v in zip(runs, cost)]


def fit_kmeans_of(df: DataFrame, features: str, ks, n_init: int = 10, seed: int = 42, max_iter: int = 300, tol: float = 1e-4) -> dict:
    """{k: best of ``n_init`` seeded k-means|| runs by training cost}.  Spark ML chooses the starting
    centres; the rounds of all runs share their passes, so a round of any number of runs is one job."""
    from pyspark.ml.clustering import KMeans
    data = df.select(array_to_vector(to_array(df, features)).alias("_fv")).persist(StorageLevel.MEMORY_AND_DISK)

    def start(run):
        k, i = run
        m = KMeans(k=k, seed=seed + i, maxIter=0, tol=tol, featuresCol="_fv", predictionCol="cluster").fit(data)
        return np.array(m.clusterCenters(), dtype=float)
    data.count()                                   # one pass fills the cache for all starts
    runs = [(k, i) for k in ks for i in range(n_init)]
    with ThreadPoolExecutor(max_workers=STARTS_AT_ONCE) as pool:
        starts = list(pool.map(start, runs))
    data.unpersist()
    blocks = _packed(df, features).persist(StorageLevel.MEMORY_AND_DISK)
    best = {}
    for (k, i), (centres, cost) in zip(runs, _lloyd(blocks, starts, max_iter, tol)):
        if k not in best or (cost, i) < best[k][:2]:
            best[k] = (cost, i, centres)
    blocks.unpersist()
    return {k: KMeansFit(centres, cost) for k, (cost, _, centres) in best.items()}


def fit_kmeans(df: DataFrame, features: str, k: int = 3, n_init: int = 10, seed: int = 42, max_iter: int = 300,
               tol: float = 1e-4) -> KMeansFit:
    """Best of ``n_init`` seeded k-means|| runs by training cost."""
    return fit_kmeans_of(df, features, [k], n_init, seed, max_iter, tol)[k]


def kmeans_labels(model: KMeansFit, df: DataFrame, features: str, keep: list) -> DataFrame:
    return df.select(*keep, model.predict(to_array(df, features)).alias("cluster"))


def k_selection(df: DataFrame, id_col: str, features: str, k_range=(2, 3, 4, 5, 6, 7), n_init: int = 10,
                seed: int = 42) -> DataFrame:
    """k, inertia, silhouette (squared), DBI, CHI for every k (report only)."""
    base = df.select(id_col, features).persist(StorageLevel.MEMORY_AND_DISK)
    fits = fit_kmeans_of(base, features, k_range, n_init, seed)
    rows = []
    for k in k_range:
        lab = kmeans_labels(fits[k], base, features, [id_col, features]).persist(StorageLevel.MEMORY_AND_DISK)
        st = cluster_stats(lab, features)
        rows.append((k, fits[k].cost, silhouette_sq(lab, features, stats=st),
                     davies_bouldin(lab, features, stats=st), calinski_harabasz(lab, features, stats=st)))
        lab.unpersist()
    base.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double, dbi double, chi double")


# ------------------------------------------------------------------ K6 / K7
class PCAModel:
    def __init__(self, mean: np.ndarray, components: np.ndarray, explained: np.ndarray):
        self.mean, self.components, self.explained = mean, components, explained

    def transform(self, df: DataFrame, features: str, keep: list, prefix: str = "pc") -> DataFrame:
        x = to_array(df, features)
        mu = F.lit(self.mean.tolist())
        cols = [_dot(F.zip_with(x, mu, lambda a, b: a - b), F.lit(c.tolist())).alias(f"{prefix}{i + 1}")
                for i, c in enumerate(self.components)]
        return df.select(*keep, *cols)


def fit_pca(df: DataFrame, features: str, n_components: int = 2) -> PCAModel:
    """Centred PCA; each component's largest-magnitude loading is made positive."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.stat import Summarizer
    v = df.select(array_to_vector(to_array(df, features)).alias("_fv"))
    mean = np.asarray(v.select(Summarizer.mean(F.col("_fv"))).first()[0].toArray(), dtype=float)
    centred = v.select(array_to_vector(F.zip_with(vector_to_array_col("_fv"), F.lit(mean.tolist()),
                                                  lambda a, b: a - b)).alias("_fv"))
    m = PCA(k=n_components, inputCol="_fv").fit(centred)
    comps = m.pc.toArray().T.copy()
    for i in range(len(comps)):
        j = int(np.argmax(np.abs(comps[i])))
        if comps[i][j] < 0:
            comps[i] = -comps[i]
    return PCAModel(mean, comps, m.explainedVariance.toArray())


def vector_to_array_col(c: str) -> Column:
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(F.col(c))


# ------------------------------------------------------------------ K5
def dbscan(df: DataFrame, id_col: str, features: str, eps: float = 0.5, min_samples: int = 5,
           cell_target: int = 4_000, max_rounds: int | None = None, tile_rows: int | None = None) -> DataFrame:
    """(id, cluster) with noise = -1.  Identical vectors are collapsed first
    (their count is a weight), so a hot group of copies is one point.  The pairs
    within eps are never a table: one pass over pairs of blocks of rows
    (:mod:`tessera.operators.block_pairs`) counts neighbours, another links cores.

    core: weighted neighbour count (itself included) >= min_samples;
    clusters: connected components of core-core edges (star steps, every round
    written); border rows take the lowest cluster of
    their core neighbours; clusters are numbered by their smallest core id."""
    x = df.select(F.col(id_col).alias("_id"), to_array(df, features).alias("_x"))
    distinct = x.groupBy("_x").agg(F.min("_id").alias("vid"), F.count(F.lit(1)).alias("w"))
    distinct = write_shared(distinct, "vectors")
    points = distinct.filter("vid IS NOT NULL AND _x IS NOT NULL").select(F.col("vid").cast("long").alias("_id"), F.col("_x").alias("_v"))
    placed, n = place_rows(points, cell_target, tile_rows)
    weight = distinct.groupBy(F.col("vid").alias("_id")).agg(F.array(F.sum("w").cast("double")).alias("val"))
    near = NearPairs(placed, n, float(eps))
    deg = near.sums(weight, 1, lambda d: np.ones(len(d)))
    core = write_shared(deg.filter(F.col("s")[0] >= min_samples).select(F.col("i").alias("vid")), "cores")
    drop_shared(deg)
    flagged = join_rows(weight.select("_id"), core.select(F.col("vid").alias("_id"), F.lit(1.0).alias("core")), "_id", n, "left").select("_id", F.array(F.coalesce("core", F.lit(0.0))).alias("val"))
    links = near.core_links(flagged)
    near.close()
    lab = write_shared(connected_components(core.select("vid"), links.filter("core"), max_rounds), "labels")
    # number clusters 0.. by smallest core id (distributed rank over the distinct labels)
    roots = lab.select("lab").distinct()
    nr = roots.count()
    ranks = ordered_cumsum(roots, "lab", [], n_rows=nr).select("lab", (F.col("row_in_group") - 1).cast("int").alias("cid"))
    core_c = lab.join(ranks, "lab").select("vid", "cid")
    border = (links.filter("NOT core").join(core_c.withColumnRenamed("vid", "id_b"), "id_b")
                   .groupBy(F.col("id_a").alias("vid")).agg(F.min("cid").alias("cid")))
    vlab = core_c.unionByName(border)
    per_vec = distinct.join(vlab, "vid", "left").select("_x", F.coalesce("cid", F.lit(-1)).alias("cluster"))
    return x.join(per_vec, "_x").select(F.col("_id").alias(id_col), "cluster")


# ------------------------------------------------------------------ K3 / K4
def _ward(points: np.ndarray, weights: np.ndarray):
    """Weighted Ward merges on a bounded set (<= max_micro) of micro-cluster
    centres, Lance-Williams updates on the squared Ward distance.
    Returns scipy-style rows (left, right, distance, size)."""
    m = len(points)
    if m < 2:
        return []
    n = weights.astype(float).copy()
    diff = points[:, None, :] - points[None, :, :]
    d2 = (diff ** 2).sum(-1) * (2 * n[:, None] * n[None, :] / (n[:, None] + n[None, :]))
    np.fill_diagonal(d2, np.inf)
    ids = list(range(m))
    alive = np.ones(m, dtype=bool)
    rows = []
    for step in range(m - 1):
        flat = int(np.argmin(d2))
        a, b = divmod(flat, m)
        if a > b:
            a, b = b, a
        dab = d2[a, b]
        na, nb = n[a], n[b]
        nk = n
        upd = ((nk + na) * d2[a] + (nk + nb) * d2[b] - nk * dab) / (nk + na + nb)
        rows.append((ids[a], ids[b], float(np.sqrt(dab)), na + nb))
        # the merged cluster takes slot a; slot b is retired
        d2[a, :] = upd
        d2[:, a] = upd
        d2[a, a] = np.inf
        d2[b, :] = np.inf
        d2[:, b] = np.inf
        alive[b] = False
        n[a] = na + nb
        ids[a] = m + step
    return rows


def fit_hac(df: DataFrame, id_col: str, features: str, k: int = 3, max_micro: int = 500, seed: int = 42):
    """Ward agglomerative clustering to k clusters.

    Phase 1 (distributed): identical vectors collapse; if more than
    ``max_micro`` distinct vectors remain, k-means cuts them into
    ``max_micro`` micro-clusters.  Phase 2: weighted Ward merges over those
    bounded centres.  Exact when distinct rows <= ``max_micro``.
    Returns (labels (id, cluster), linkage DataFrame, exact flag)."""
    spark = df.sparkSession
    x = df.select(F.col(id_col).alias("_id"), to_array(df, features).alias("_x"))
    distinct = x.groupBy("_x").agg(F.count(F.lit(1)).alias("w"), F.min("_id").alias("vid"))
    rows = distinct.limit(max_micro + 1).collect()
    if len(rows) <= max_micro:
        rows = sorted(rows, key=lambda r: r["vid"])
        pts = np.array([r["_x"] for r in rows], dtype=float)
        w = np.array([r["w"] for r in rows], dtype=float)
        mapping = spark.createDataFrame([(r["_x"], i) for i, r in enumerate(rows)], "_x array<double>, micro int")
        exact = True
    else:
        from pyspark.ml.clustering import KMeans
        dv = distinct.withColumn("_fv", array_to_vector("_x"))
        km = KMeans(k=max_micro, seed=seed, featuresCol="_fv", predictionCol="micro", weightCol="w").fit(dv)
        assigned = km.transform(dv).select("_x", F.col("micro").cast("int"), "w")
        agg = {r["micro"]: r["w"] for r in assigned.groupBy("micro").agg(F.sum("w").alias("w")).collect()}
        cents = km.clusterCenters()
        pts = np.array([np.asarray(c, dtype=float) for c in cents])
        w = np.array([agg.get(i, 0.0) for i in range(len(cents))])
        keep = w > 0
        pts, w = pts[keep], w[keep]
        remap = {old: new for new, old in enumerate(np.nonzero(keep)[0])}
        rm = F.create_map(*[x for o, n in remap.items() for x in (F.lit(int(o)), F.lit(int(n)))])
        mapping = assigned.select("_x", F.element_at(rm, F.col("micro")).alias("micro"))
        exact = False
    link = _ward(pts, w)
    m = len(pts)
    # cut: undo the last k-1 merges
    parent = {}
    for i, (a, b, _, _) in enumerate(link[: max(0, m - k)]):
        parent[a] = m + i
        parent[b] = m + i

    def root(i):
        while i in parent:
            i = parent[i]
        return i

    roots = {i: root(i) for i in range(m)}
    order = {r: j for j, r in enumerate(sorted(set(roots.values()), key=lambda r: min(i for i in roots if roots[i] == r)))}
    cl = F.create_map(*[x for i in range(m) for x in (F.lit(i), F.lit(order[roots[i]]))])
    labels = x.join(mapping, "_x").select(F.col("_id").alias(id_col), F.element_at(cl, F.col("micro")).alias("cluster"))
    linkage = spark.createDataFrame([(int(a), int(b), float(d), float(s)) for a, b, d, s in link],
                                    "left int, right int, distance double, size double")
    return labels, linkage, exact


# ------------------------------------------------------------------ K8 / K9
def profile_clusters(df: DataFrame, cluster: str = "cluster", target: str | None = "target",
                     mean_cols: list | None = None, rate_col: str | None = None, mode_col: str | None = None,
                     digits: int = 3) -> DataFrame:
    """count, target rate (the row count without target), means, a rate and the
    mode (smallest on tie) per cluster, rounded."""
    mean_cols = list(mean_cols or [])
    aggs = [F.count(F.lit(1)).alias("count"),
            (F.avg(F.col(target).cast("double")) if target and target in df.columns else F.count(F.lit(1)).cast("double"))
            .alias("target_rate")]
    aggs += [F.avg(F.col(c).cast("double")).alias(f"{c}_mean") for c in mean_cols]
    if rate_col:
        aggs.append(F.avg(F.col(rate_col).cast("double")).alias(f"{rate_col}_rate"))
    prof = df.groupBy(cluster).agg(*aggs)
    if mode_col:
        w = Window.partitionBy(cluster).orderBy(F.desc("n"), F.asc(mode_col))
        mode = (df.filter(F.col(mode_col).isNotNull()).groupBy(cluster, mode_col).agg(F.count(F.lit(1)).alias("n"))
                  .withColumn("rn", F.row_number().over(w)).filter("rn = 1")
                  .select(cluster, F.col(mode_col).alias(f"{mode_col}_mode")))
        prof = prof.join(mode, cluster, "left")
    return prof.select(*[F.round(F.col(c), digits).alias(c) if c not in (cluster, "count", f"{mode_col}_mode")
                         else F.col(c) for c in prof.columns])


def name_clusters(profile: DataFrame, cluster: str = "cluster", rate: str = "target_rate",
                  tiers=("low", "medium", "high")) -> DataFrame:
    """Clusters sorted by rate ascending get the tier names; later ranks are the last tier."""
    if rate not in profile.columns:
        return profile.sparkSession.createDataFrame([], f"{cluster} int, risk string")
    # window over the profile table: one row per cluster
    w = Window.orderBy(F.col(rate).asc_nulls_last(), F.col(cluster))
    t = F.lit(list(tiers))
    rn = F.row_number().over(w)
    return profile.select(cluster, F.element_at(t, F.least(rn, F.lit(len(tiers))).cast("int")).alias("risk"))

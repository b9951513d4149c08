"""Two-level pivot tree: the index of the exact neighbour search (K1).

Fitted on a bounded sample (the rows of smallest hash), it cuts space into
*nodes* (around the nearest top pivot) and every node into *cells* (around the
nearest of the node's leaf pivots).  A row finds its cell with about
2 * sqrt(cells) distances.  All rows are assigned; the sample only shapes the
cells.  One aggregate over the assigned rows then gives each cell its smallest
and largest distance to the leaf pivot, and each node its largest distance to
the top pivot.

For a query x a cell can be left out when one of these lower bounds on the
distance to its rows exceeds the radius (h: the node or leaf nearest to x):

* half space:  (|x - p|^2 - |x - p_h|^2) / (2 |p - p_h|), for the node among all
  nodes and for the leaf among the leaves of its node;
* ball and hole:  |x - p| - largest,  smallest - |x - p|.

Gaps between pivots are computed once.  Bounds are relaxed by the rounding
error of the squared distances, so no neighbour is lost.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE_BYTES = 64 << 20      # vectors of the sample on the driver, whatever the table's size
ROWS_PER_PIVOT = 8           # sample rows a leaf pivot stands on
BLOCK_CELLS = 4_000_000      # distances held at once by a task


def rounding(dim: int, qn, hn):
    """Bound of the rounding error of |q|^2 + |h|^2 - 2 q.h."""
    return 8.0 * (dim + 2) * np.finfo(float).eps * (qn + hn)


def sq_distances(X: np.ndarray, P: np.ndarray) -> np.ndarray:
    return np.maximum((X * X).sum(1)[:, None] + (P * P).sum(1)[None, :] - 2.0 * (X @ P.T), 0.0)


def centres(X: np.ndarray, k: int, rng, rounds: int = 6) -> np.ndarray:
    """At most ``k`` pivots of the sample: a spread choice (each next one drawn by its squared
    distance to those chosen), then Lloyd rounds.  Equal rows yield fewer pivots."""
    k = min(k, len(X))
    picked = [int(rng.integers(len(X)))]
    d = sq_distances(X, X[picked[:1]])[:, 0]
    while len(picked) < k and d.sum() > 0:
        picked.append(int(rng.choice(len(X), p=d / d.sum())))
        d = np.minimum(d, sq_distances(X, X[picked[-1:]])[:, 0])
    P = X[picked].copy()
    for _ in range(rounds):
        near = sq_distances(X, P).argmin(1)
        n = np.bincount(near, minlength=len(P))
        sums = np.zeros_like(P)
        np.add.at(sums, near, X)
        P = sums[n > 0] / n[n > 0, None]
    return P


def gaps(P: np.ndarray) -> np.ndarray:
    return np.sqrt(((P[:, None, :] - P[None, :, :]) ** 2).sum(-1)) if len(P) < 512 else np.sqrt(sq_distances(P, P))


class PivotTree:
    """tops: (k1, d); leaves[t]: (k2, d); cells are numbered node by node."""

    def __init__(self, tops: np.ndarray, leaves: list[np.ndarray]):
        self.origin = tops.mean(0)          # everything is measured from here: data far from 0 lose no digits
        self.tops, self.leaves = tops, leaves = tops - self.origin, [x - self.origin for x in leaves]
        self.first = np.cumsum([0] + [len(x) for x in leaves])
        self.n_cells = int(self.first[-1])
        self.top_gap = gaps(tops)
        self.leaf_gap = [gaps(x) for x in leaves]
        self.max_norm = max(float((x * x).sum(1).max()) for x in [tops, *leaves])
        self.cell_lo = np.zeros(self.n_cells)
        self.cell_hi = np.full(self.n_cells, np.inf)
        self.top_hi = np.full(len(tops), np.inf)
        self.cell_rows = np.zeros(self.n_cells, "i8")

    @classmethod
    def fit(cls, sample: np.ndarray, n_cells: int, seed: int = 42) -> PivotTree:
        rng = np.random.default_rng(seed)
        n_cells = max(1, min(n_cells, len(sample) // ROWS_PER_PIVOT or 1))
        tops = centres(sample, math.ceil(math.sqrt(n_cells)), rng)
        near = sq_distances(sample, tops).argmin(1)
        leaves = []
        for t in range(len(tops)):
            mine = sample[near == t]
            k = round(n_cells * len(mine) / len(sample))
            leaves.append(centres(mine, k, rng) if k > 1 and len(mine) else tops[t:t + 1])
        return cls(tops, leaves)

    @classmethod
    def of(cls, pivots: np.ndarray) -> PivotTree:
        """A tree whose cells are those around given pivots."""
        return cls(pivots.mean(0, keepdims=True), [pivots])

    # ---- rows -> cells

    def assign(self, X: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(cell, node, squared distance to the leaf pivot, squared distance to the top pivot) of every row."""
        X = X - self.origin
        node, top = np.empty(len(X), "i4"), np.empty(len(X))
        step = max(1, BLOCK_CELLS // len(self.tops))
        for lo in range(0, len(X), step):
            d = sq_distances(X[lo:lo + step], self.tops)
            node[lo:lo + step] = d.argmin(1)
            top[lo:lo + step] = d.min(1)
        cell, leaf = np.empty(len(X), "i4"), np.empty(len(X))
        for t in np.unique(node):
            at = np.flatnonzero(node == t)
            d = sq_distances(X[at], self.leaves[t])
            cell[at] = self.first[t] + d.argmin(1)
            leaf[at] = d.min(1)
        return cell, node, leaf, top

    def probe(self, X: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of every cell that may hold a row within ``radius`` (one per row of X)."""
        X = X - self.origin
        rows, cells = [], []
        step = max(1, BLOCK_CELLS // max(len(self.tops), max(len(x) for x in self.leaves)))
        for lo in range(0, len(X), step):
            x, r = X[lo:lo + step], radius[lo:lo + step]
            # error of a squared distance between any row, query and pivot
            err = rounding(x.shape[1], (x * x).sum(1), self.max_norm)
            d = sq_distances(x, self.tops)
            see = self._near(d, self.top_gap, r, err) & self._reach(d, 0.0, self.top_hi[None, :], r, err)
            for t in np.flatnonzero(see.any(0)):
                at = np.flatnonzero(see[:, t])
                d = sq_distances(x[at], self.leaves[t])
                part = slice(self.first[t], self.first[t + 1])
                ok = self._near(d, self.leaf_gap[t], r[at], err[at])
                ok &= self._reach(d, self.cell_lo[None, part], self.cell_hi[None, part], r[at], err[at])
                i, j = np.nonzero(ok)
                rows.append(lo + at[i])
                cells.append(self.first[t] + j)
        if not rows:
            return np.empty(0, "i8"), np.empty(0, "i8")
        return np.concatenate(rows), np.concatenate(cells)

    @staticmethod
    def _near(d: np.ndarray, gap: np.ndarray, r: np.ndarray, err: np.ndarray) -> np.ndarray:
        """Half-space bound; pivots that coincide cannot be told apart."""
        h = d.argmin(1)
        bound = np.full(d.shape, np.inf)
        np.multiply(2.0 * (1 + 1e-9) * r[:, None], gap[h], out=bound, where=gap[h] > 0)
        return d - d[np.arange(len(d)), h][:, None] - 4.0 * err[:, None] <= bound

    @staticmethod
    def _reach(d: np.ndarray, lo, hi, r: np.ndarray, err: np.ndarray) -> np.ndarray:
        """Ball and hole bounds."""
        r = (r * (1 + 1e-9))[:, None]
        near, far = np.sqrt(np.maximum(d - err[:, None], 0.0)), np.sqrt(d + err[:, None])
        return (near - hi <= r) & (lo - far <= r)


def sample_rows(points: DataFrame, id_col: str, vec: str, n_rows: int, dim: int, max_bytes: int = SAMPLE_BYTES) -> np.ndarray:
    """Vectors of about ``max_bytes / (8 dim)`` rows at most: those of smallest id hash, the same in every run."""
    limit = max(1, max_bytes // (8 * dim))
    share = min(1.0, 0.9 * limit / n_rows) if n_rows > limit else 1.0
    picked = points if share >= 1.0 else points.filter(F.pmod(F.xxhash64(F.col(id_col), F.lit(23)), F.lit(1 << 30)) < int(share * (1 << 30)))
    pdf = picked.select(id_col, vec).limit(limit).toPandas().sort_values(id_col, kind="stable")
    return np.stack(pdf[vec].to_numpy()).astype(float) if len(pdf) else np.zeros((1, dim))


def wanted_cells(n_rows: int, cell_target: int) -> int:
    """One cell per ``cell_target`` rows, never more than sqrt(n) (finding a cell would cost more than it saves)."""
    return max(1, min(math.ceil(n_rows / cell_target), math.ceil(math.sqrt(n_rows))))


def with_cells(df: DataFrame, vec: str, tree: PivotTree) -> DataFrame:
    """Adds _home (cell), _node, and _leaf_d, _top_d (squared distances to the two pivots)."""
    added = [T.StructField("_home", T.IntegerType()), T.StructField("_node", T.IntegerType()),
             T.StructField("_leaf_d", T.DoubleType()), T.StructField("_top_d", T.DoubleType())]
    schema = T.StructType(df.schema.fields + added)
    shared = df.sparkSession.sparkContext.broadcast(tree)

    def run(batches):
        for pdf in batches:
            if len(pdf):
                cell, node, leaf, top = shared.value.assign(np.stack(pdf[vec].to_numpy()).astype(float))
                yield pdf.assign(_home=cell, _node=node, _leaf_d=leaf, _top_d=top)
    return df.mapInPandas(run, schema)


def set_bounds(tree: PivotTree, assigned: DataFrame, vec: str, dim: int) -> None:
    """Distance bounds of the cells and nodes over all assigned rows: one row per cell reaches the driver."""
    norm = F.aggregate(F.zip_with(vec, F.lit(tree.origin.tolist()), lambda v, o: (v - o) * (v - o)), F.lit(0.0), lambda s, v: s + v)
    got = (assigned.groupBy("_home").agg(F.min("_leaf_d"), F.max("_leaf_d"), F.max("_top_d"), F.max(norm), F.count(F.lit(1))).collect())
    tree.max_norm = max([tree.max_norm, *[r[4] for r in got]])
    err = float(rounding(dim, tree.max_norm, tree.max_norm))
    tree.cell_lo[:], tree.cell_hi[:], tree.top_hi[:] = np.inf, -np.inf, -np.inf       # cells without rows are never probed
    for cell, lo, hi, top, _, n in got:
        tree.cell_rows[cell] = n
        t = int(np.searchsorted(tree.first, cell, "right")) - 1
        tree.cell_lo[cell] = math.sqrt(max(lo - err, 0.0))
        tree.cell_hi[cell] = math.sqrt(hi + err)
        tree.top_hi[t] = max(tree.top_hi[t], math.sqrt(top + err))


def with_probes(df: DataFrame, vec: str, tree: PivotTree, radius, block: np.ndarray | None = None) -> DataFrame:
    """Adds _cells: the cells to compare a row with for ``radius`` (a number, or the name of a column; null: all cells).

    With ``block`` (a number per cell) the blocks of those cells instead, each once."""
    schema = T.StructType(df.schema.fields + [T.StructField("_cells", T.ArrayType(T.IntegerType()))])
    shared = df.sparkSession.sparkContext.broadcast(tree)

    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            X = np.stack(pdf[vec].to_numpy()).astype(float)
            r = pdf[radius].fillna(np.inf).to_numpy() if isinstance(radius, str) else np.full(len(X), float(radius))
            row, cell = shared.value.probe(X, r)
            if block is not None:
                row, cell = np.divmod(np.unique(row * (int(block[-1]) + 1) + block[cell]), int(block[-1]) + 1)
            order = np.argsort(row, kind="stable")
            cuts = np.searchsorted(row[order], np.arange(1, len(X)))
            yield pdf.assign(_cells=[c.astype("i4") for c in np.split(cell[order], cuts)])
    return df.mapInPandas(run, schema)


def copies_per_row(df: DataFrame, vec: str, tree: PivotTree, radius) -> float:
    """Mean number of cells a row is copied to (1: only its own), the price of the search."""
    return with_probes(df, vec, tree, radius).agg(F.avg(F.size("_cells"))).first()[0] or 0.0

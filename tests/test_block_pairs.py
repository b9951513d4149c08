"""Pairs of rows that are never a table: label graph (P3/P4), DBSCAN (K5), Euclidean silhouette (M9)."""

import numpy as np
import pytest

from tessera.operators import block_pairs as B
from tessera.operators import cluster as K
from tessera.operators import semi as P

from tests.conftest import approx


def _frame(spark, ids, X, more, schema):
    return spark.createDataFrame([(i, [float(v) for v in x], *m) for i, x, m in zip(ids, X, more)], schema).coalesce(2)


def _rows_written(monkeypatch, module):
    """Largest table that ``module`` or the block pairs write."""
    seen = []
    for m in (module, B):
        def write(df, name, f=m.write_shared, **kw):
            out = f(df, name, **kw)
            seen.append((out.count(), name))
            return out
        monkeypatch.setattr(m, "write_shared", write)
    return seen


def _label_rounds(ids, X, part, method, rounds, gamma=20.0, alpha=0.2):
    """Dense label graph over rows without nulls; rows of one id are one node."""
    classes = sorted({p for p in part if p != -1})
    d = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    w = np.where(d <= np.sqrt(-np.log(1e-12) / gamma), np.exp(-gamma * d * d), 0.0)
    if method == "spreading":
        w[ids[:, None] == ids[None]] = 0.0
    same = (ids[:, None] == ids[None]).astype(float)
    y = np.array([[float(p == c) for c in classes] for p in part])
    v = y
    deg = same @ w.sum(1)
    q = np.where(deg > 0, 1 / np.sqrt(np.where(deg > 0, deg, 1)), 0.0)[:, None]
    for _ in range(rounds):
        if method == "spreading":
            v = alpha * q * (same @ (w @ (q * (same @ v)))) + (1 - alpha) * y
        else:
            s = same @ (w @ (same @ v))
            t = s.sum(1, keepdims=True)
            v = np.where((np.array(part) != -1)[:, None], y, np.where(t > 0, s / np.where(t > 0, t, 1), 0.0))
    t = v.sum(1, keepdims=True)
    return np.where(t > 0, v / np.where(t > 0, t, 1), 0.0)


@pytest.mark.parametrize("method", ["spreading", "propagation"])
def test_label_graph_of_many_blocks_is_the_dense_one(spark, method):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(120, 3)) * 0.7
    ids = np.arange(120)
    ids[7] = 5                                               # two rows of one id
    part = [int(rng.integers(0, 3)) if i % 6 == 0 else -1 for i in range(120)]
    df = _frame(spark, [*map(int, ids)], X, [(p,) for p in part], "id long, features array<double>, partial_label int")
    got = P.label_graph_fit(df, "id", method=method, max_iter=3, tol=0.0, cell_target=8, tile_rows=20).collect()
    want = _label_rounds(ids, X, part, method, 3)
    by_id = {}
    for i, w in zip(ids, want):
        by_id.setdefault(int(i), []).append(w)
    for r in got:
        if sum(by_id[r["id"]][0]) > 0 and r["id"] != 5:
            assert np.allclose(r["label_distribution"], by_id[r["id"]][0], atol=1e-9)


def test_label_graph_writes_no_edges(spark, monkeypatch):
    rng = np.random.default_rng(4)
    n = 300
    df = _frame(spark, range(n), rng.normal(size=(n, 2)) * 0.1, [(i % 2 if i < 30 else -1,) for i in range(n)],
                "id long, features array<double>, partial_label int")
    seen = _rows_written(monkeypatch, P)
    for method in ("spreading", "propagation"):
        P.label_graph_fit(df, "id", method=method, max_iter=2, tol=0.0).collect()
    assert max(seen)[0] <= n, max(seen)                      # the graph has about n * n edges


def _dbscan(X, eps, least):
    near = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1)) <= eps
    core = near.sum(1) >= least
    lab = np.where(core, np.arange(len(X)), -1)
    while True:
        new = np.where(core, [min([lab[j] for j in np.flatnonzero(near[i] & core)], default=-1) for i in range(len(X))], -1)
        if (new == lab).all():
            break
        lab = new
    number = {r: k for k, r in enumerate(sorted(set(lab[core])))}
    return [number[lab[i]] if core[i] else min([number[lab[j]] for j in np.flatnonzero(near[i] & core)], default=-1) for i in range(len(X))]


def test_dbscan_of_many_blocks(spark):
    rng = np.random.default_rng(5)
    X = np.concatenate([rng.normal(size=(60, 2)) * 0.4 + c for c in ([0, 0], [3, 0], [0, 4])] + [rng.uniform(-3, 7, size=(40, 2))])
    df = _frame(spark, range(len(X)), X, [()] * len(X), "id long, x array<double>")
    got = [r["cluster"] for r in K.dbscan(df, "id", "x", 0.35, 5, cell_target=8, tile_rows=30).orderBy("id").collect()]
    assert got == _dbscan(X, 0.35, 5)
    assert -1 in got and max(got) >= 2


def test_dbscan_writes_no_pairs(spark, monkeypatch):
    rng = np.random.default_rng(6)
    X = rng.normal(size=(300, 2)) * 0.1
    seen = _rows_written(monkeypatch, K)
    got = K.dbscan(_frame(spark, range(300), X, [()] * 300, "id long, x array<double>"), "id", "x", 1.0, 5).collect()
    assert {r["cluster"] for r in got} == {0}
    assert max(seen)[0] <= 300, max(seen)                    # 300 * 300 pairs lie within eps


def _silhouette(X, lab):
    d = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    s = []
    for i in range(len(X)):
        own = lab == lab[i]
        a, b = d[i, own].sum() / max(own.sum() - 1, 1), min(d[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s.append(0.0 if own.sum() == 1 or max(a, b) <= 0 else (b - a) / max(a, b))
    return float(np.mean(s))


@pytest.mark.parametrize("tile_rows", [None, 7, 30, 90])
def test_euclidean_silhouette_of_cut_and_whole_clusters(spark, tile_rows):
    rng = np.random.default_rng(7)
    lab = np.r_[np.arange(30) + 10, rng.integers(0, 3, 170), rng.integers(3, 8, 30), [-1] * 5]      # singletons, large and small clusters, noise
    X = rng.normal(size=(8, 3))[lab % 8] * 5 + rng.normal(size=(len(lab), 3)) + 1e5
    X[40:60] = X[40]
    df = _frame(spark, range(len(X)), X, [(int(c),) for c in lab], "id long, x array<double>, cluster int")
    assert approx(K.silhouette_euclidean(df, "x", tile_rows=tile_rows), _silhouette(X[lab != -1], lab[lab != -1]), 1e-9)


def test_euclidean_silhouette_copies_no_rows(spark, monkeypatch):
    """Rows are packed once; only numbers per row and block leave the tasks (tiles of rows were dealt out as copies)."""
    rng = np.random.default_rng(8)
    X = rng.normal(size=(400, 3))
    df = _frame(spark, range(400), X, [(i % 4,) for i in range(400)], "id long, x array<double>, cluster int")
    monkeypatch.setattr(K, "compare_tiles", None)
    seen = _rows_written(monkeypatch, K)
    K.silhouette_euclidean(df, "x", tile_rows=50)
    assert max(seen)[0] <= 400


def test_screening_misses_no_pair():
    rng = np.random.default_rng(9)

    def block(b, X):
        X = np.ascontiguousarray(X)
        return B.Block((b, np.arange(len(X)).astype("i8").tobytes(), X.tobytes(), False, np.ones((len(X), 1)).tobytes(), 1))
    for shift in (0.0, 1e7):
        for scale in (1.0, 1e-4):
            X, Y = rng.normal(size=(203, 5)) * scale + shift, rng.normal(size=(131, 5)) * scale + shift
            Y[:20] = X[:20]
            for r in (0.0, 0.5 * scale, 1.7 * scale, 50 * scale):
                want = np.sqrt(((X[:, None] - Y[None]) ** 2).sum(-1)) <= r
                got = np.zeros_like(want)
                for i, j, _ in B.near_pairs(block(0, X), block(1, Y), r):
                    assert not got[i, j].any()
                    got[i, j] = True
                assert (got == want).all()


@pytest.mark.parametrize("room", [0, 3_000, 1 << 30])
def test_pairs_that_find_no_room_are_searched_again(spark, room):
    rng = np.random.default_rng(11)
    X = rng.normal(size=(200, 2))
    points = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(X)], "_id long, _v array<double>")
    placed, n = B.place_rows(points, 8, 40)
    near = B.NearPairs(placed, n, 0.8, room)
    values = points.selectExpr("_id", "array(cast(_id as double), 1.0) AS val")
    w = np.where(np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1)) <= 0.8, 1.0, 0.0)
    for _ in range(2):
        got = {r["i"]: r["s"] for r in near.sums(values, 2, lambda d: np.ones(len(d))).collect()}
        assert np.array_equal(np.array([got[i] for i in range(200)]), np.column_stack([w @ np.arange(200.0), w.sum(1)]))
    kept = [sum(len(x[2]) for x in k) for k in near.kept.collect() if k is not None]
    assert sum(kept) <= room and (len(kept) > 0) == (room > 0)
    near.close()

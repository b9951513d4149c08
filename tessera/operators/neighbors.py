"""Exact Euclidean neighbour search without a cross join (K1).

A two-level pivot tree (:mod:`tessera.operators.pivot_tree`), fitted on a bounded
sample, gives every point a *home* cell.  A query point is copied into the cells
that the tree's distance bounds cannot rule out for its radius and meets their
home points there.  Every pair within the radius is found exactly once, whatever
the pivots are; good pivots only make it cheaper.

A cell may hold any share of the rows, so it is not the unit of work.  Neighbouring
small cells form a *block* of about one tile of rows, and a query point is copied
once to a block however many of its cells it asks for: where the bounds rule
out little (uniform rows of many dimensions), copies grow with the number of
tiles, not of cells.  A block's home points and its query copies are cut into
tiles (by a hash of the id), and every (home tile, query tile) of a block is its
own group: a task never holds more than two tiles, and a hot cell spreads over as
many tasks as it has tile pairs.  A tile pair is one numpy distance block, worked
off in row chunks of bounded size; only the pairs that qualify leave the task.
A tile has ``DEFAULT_CELL_TARGET`` rows, more in large tables (``block_rows``), at most
``TILE_BYTES`` of vectors: a table of n rows is copied n / tile times.
Tables of at most ``cell_target`` rows are one tile, compared with itself.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import pivot_tree as PT
from tessera.session import cut_lineage, join_rows

DEFAULT_CELL_TARGET = 4_000
BLOCK_CELLS = 4_000_000  # distances (and vector components) held at once by a task
TILE_BYTES = 16 << 20    # vectors of one tile at most
TILES = 8                # tiles a table is cut into before they grow beyond DEFAULT_CELL_TARGET rows


def to_array(df: DataFrame, col: str) -> Column:
    t = df.schema[col].dataType
    if isinstance(t, T.ArrayType):
        return F.col(col).cast("array<double>")
    return vector_to_array(F.col(col)).cast("array<double>")


def sq_dist(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)


def dist(a: Column, b: Column, dim: int | None = None) -> Column:
    """Euclidean distance.  With the dimension known the sum is unrolled
    into plain arithmetic on array elements, which whole-stage codegen
    compiles (higher-order lambdas are interpreted row by row)."""
    if dim is None:
        return F.sqrt(sq_dist(a, b))
    terms = [(a[i] - b[i]) * (a[i] - b[i]) for i in range(dim)]
    acc = terms[0]
    for t in terms[1:]:
        acc = acc + t
    return F.sqrt(acc)


def fit_tree(points: DataFrame, n_rows: int, cell_target: int = DEFAULT_CELL_TARGET, seed: int = 42) -> PT.PivotTree:
    """Pivot tree over (_id, _v) rows, fitted on a bounded sample."""
    dim = len(points.select("_v").first()[0])
    return PT.PivotTree.fit(PT.sample_rows(points, "_id", "_v", n_rows, dim), PT.wanted_cells(n_rows, cell_target), seed)


def assign_homes(points: DataFrame, tree: PT.PivotTree) -> DataFrame:
    """Rows with their home cell, checkpointed: the tree's bounds are taken over them."""
    held = cut_lineage(PT.with_cells(points, "_v", tree))
    PT.set_bounds(tree, held, "_v", len(tree.origin))
    return held


def block_rows(n_rows: int, dim: int, cell_target: int) -> int:
    """Rows of a tile: an eighth of the table within the default and ``TILE_BYTES`` of vectors."""
    return max(1, cell_target, min(max(DEFAULT_CELL_TARGET, n_rows // TILES), max(1, TILE_BYTES // (8 * dim))))


def blocks_of_cells(tree: PT.PivotTree, tile_rows: int) -> np.ndarray:
    """Block of every cell: neighbouring cells (nodes in turn) up to ``tile_rows`` home rows; a larger cell is a block alone."""
    out, block, held = np.zeros(tree.n_cells, "i4"), 0, 0
    for c, n in enumerate(tree.cell_rows):
        if held and held + n > tile_rows:
            block, held = block + 1, 0
        out[c] = block
        held += int(n)
    return out


def _exact(Q, H, qi, hi):
    """Distances of the listed pairs from their differences, in bounded slices."""
    out = np.empty(len(qi))
    step = max(1, BLOCK_CELLS // Q.shape[1])
    for lo in range(0, len(qi), step):
        s = slice(lo, lo + step)
        out[s] = np.sqrt(((Q[qi[s]] - H[hi[s]]) ** 2).sum(1))
    return out


def _blocks(pdf):
    """Home rows of a tile pair and its query rows in chunks of bounded size:
    (home ids, H, query ids, Q, approximate squared distances, their error)."""
    home, qry = (pdf[pdf["_is_home"]], pdf[~pdf["_is_home"]]) if "_is_home" in pdf else (pdf, pdf)
    if home.empty or qry.empty:
        return
    H = np.stack(home["_v"].to_numpy()).astype(float)
    hid = home["_id"].to_numpy()
    hn = (H * H).sum(1)
    Qall = np.stack(qry["_v"].to_numpy()).astype(float)
    qid = qry["_id"].to_numpy()
    step = max(1, BLOCK_CELLS // len(H))
    for lo in range(0, len(Qall), step):
        Q = Qall[lo:lo + step]
        qn = (Q * Q).sum(1)
        yield hid, H, qid[lo:lo + step], Q, qn[:, None] + hn[None, :] - 2.0 * (Q @ H.T), PT.rounding(H.shape[1], qn, hn.max())


def _pairs_within(radius: float):
    """Kernel of a tile pair: candidates from the matrix product, kept by their exact distance."""
    import pandas as pd

    def fn(pdf):
        out = [pd.DataFrame({"id_a": np.empty(0, "i8"), "id_b": np.empty(0, "i8"), "dist": np.empty(0)})]
        for hid, H, qid, Q, d2, err in _blocks(pdf):
            qi, hi = np.nonzero(d2 <= radius * radius * (1 + 1e-9) + err[:, None])
            d = _exact(Q, H, qi, hi)
            keep = d <= radius
            out.append(pd.DataFrame({"id_a": qid[qi[keep]], "id_b": hid[hi[keep]], "dist": d[keep]}))
        return pd.concat(out, ignore_index=True)
    return fn


def _knn_within(k: int, part: list):
    """Kernel of a tile pair: the k nearest home rows of every query row (exact distance, ties by id)."""
    import pandas as pd

    def fn(pdf):
        out = []
        for hid, H, qid, Q, d2, err in _blocks(pdf):
            kk = min(k, len(H))
            kth = np.partition(d2, kk - 1, axis=1)[:, kk - 1]
            qi, hi = np.nonzero(d2 <= (kth + 2.0 * err)[:, None])
            d = _exact(Q, H, qi, hi)
            o = np.lexsort((hid[hi], d, qi))
            qi, hi, d = qi[o], hi[o], d[o]
            first = np.searchsorted(qi, np.arange(len(Q)))
            keep = np.arange(len(qi)) - first[qi] < kk
            frame = pd.DataFrame({"id_a": qid[qi[keep]], "id_b": hid[hi[keep]], "dist": d[keep]})
            for c in part:
                frame[c] = pdf[c].iloc[0]
            out.append(frame)
        cols = [*part, "id_a", "id_b", "dist"]
        return pd.concat(out, ignore_index=True)[cols] if out else pd.DataFrame({c: [] for c in cols})
    return fn


def tile_pairs(home: DataFrame, probes: DataFrame, part: list, tile_rows: int) -> DataFrame:
    """Rows keyed by (part, cell, ht, qt): every home tile of a cell with every query tile of it.

    ``home`` and ``probes`` hold (part, _id, _v, cell).  A tile has about
    ``tile_rows`` rows, so a group's size does not depend on the cell's."""
    key = [*part, "cell"]

    def tiles(n):
        return F.ceil(F.col(n) / F.lit(tile_rows)).cast("int")
    sizes = (home.groupBy(*key).agg(F.count(F.lit(1)).alias("_nh"))
                 .join(probes.groupBy(*key).agg(F.count(F.lit(1)).alias("_nq")), key)
                 .select(*key, tiles("_nh").alias("_th"), tiles("_nq").alias("_tq")))
    own = F.xxhash64("_id", F.lit(17))

    def spread(rows, mine, n_mine, other, n_other, is_home):
        return (rows.join(sizes, key).withColumn(mine, F.pmod(own, F.col(n_mine)).cast("int"))
                    .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(n_other) - 1)))
                    .select(*key, "ht", "qt", "_id", "_v", F.lit(is_home).alias("_is_home")))
    return (spread(home, "ht", "_th", "qt", "_tq", True)
            .unionByName(spread(probes, "qt", "_tq", "ht", "_th", False)))


def compare_tiles(home: DataFrame, asked: DataFrame | None, kernel, schema: str, tile_rows: int = DEFAULT_CELL_TARGET) -> DataFrame:
    """``kernel(home rows, query rows)`` over every pair of a home tile and a query tile of (_id, _v)
    rows (``asked`` None: the home rows).  Few rows are one group."""
    import pandas as pd
    names = T._parse_datatype_string(schema).fieldNames()

    def fn(pdf):
        h, q = (pdf[pdf["_is_home"]], pdf[~pdf["_is_home"]]) if "_is_home" in pdf else (pdf, pdf)
        return kernel(h, q) if len(h) and len(q) else pd.DataFrame({c: [] for c in names})

    if all(d.limit(tile_rows + 1).count() <= tile_rows for d in ([home] if asked is None else [home, asked])):
        return _one_tile(home, asked, []).groupBy("_tile").applyInPandas(fn, schema)
    cell = F.lit(0).alias("cell")
    ask = home if asked is None else asked
    return tile_pairs(home.select("_id", "_v", cell), ask.select("_id", "_v", cell), [], tile_rows).groupBy("cell", "ht", "qt").applyInPandas(fn, schema)


def _points(df: DataFrame, part: list, id_col: str, vec: str) -> DataFrame:
    return df.select(*[F.col(c) for c in part], F.col(id_col).cast("long").alias("_id"),
                     to_array(df, vec).alias("_v")).filter("_v IS NOT NULL")


def _homes(a: DataFrame, part: list, block: np.ndarray) -> DataFrame:
    return a.select(*part, "_id", "_v", F.element_at(F.lit(block.tolist()), F.col("_home") + 1).alias("cell"))


def _one_tile(base: DataFrame, asked: DataFrame | None, part: list) -> DataFrame:
    """Groups of a table that is one tile: its rows, or its rows and the queries'."""
    if asked is None:
        rows = base
    else:
        rows = base.withColumn("_is_home", F.lit(True)).unionByName(asked.withColumn("_is_home", F.lit(False)))
    return rows.withColumn("_tile", F.lit(0)) if not part else rows


def _setup(df, part, id_col, vec, pivots, n_rows, cell_target, seed, queries):
    """(points, query points or None, tree or None): no tree for tables of one tile."""
    base = _points(df, part, id_col, vec)
    asked = None if queries is None else _points(queries, part, id_col, vec)
    if pivots is not None:
        return base, asked, PT.PivotTree.of(np.asarray(pivots, dtype=float))
    n = n_rows if n_rows is not None else base.count()
    small = n <= cell_target and (asked is None or asked.limit(cell_target + 1).count() <= cell_target)
    return base, asked, None if small else fit_tree(base, n, cell_target, seed)


def radius_pairs(df: DataFrame, id_col: str, vec: str, eps: float, pivots: np.ndarray | None = None,
                 n_rows: int | None = None, cell_target: int = DEFAULT_CELL_TARGET, seed: int = 42,
                 queries: DataFrame | None = None) -> DataFrame:
    """All ordered pairs (id_a, id_b, dist) with dist <= eps, self pairs included.

    With ``queries`` (same columns) id_a runs over its rows instead of those of ``df``."""
    schema = "id_a long, id_b long, dist double"
    base, asked, tree = _setup(df, [], id_col, vec, pivots, n_rows, cell_target, seed, queries)
    if tree is None:
        return _one_tile(base, asked, []).groupBy("_tile").applyInPandas(_pairs_within(float(eps)), schema)
    homes = assign_homes(base, tree)
    tile_rows = block_rows(int(tree.cell_rows.sum()), len(tree.origin), cell_target)
    block = blocks_of_cells(tree, tile_rows)
    ask = PT.with_probes(homes.select("_id", "_v") if asked is None else asked, "_v", tree, float(eps), block)
    probes = ask.select("_id", "_v", F.explode("_cells").alias("cell"))
    return tile_pairs(_homes(homes, [], block), probes, [], tile_rows).groupBy("cell", "ht", "qt").applyInPandas(_pairs_within(float(eps)), schema)


def knn(df: DataFrame, id_col: str, vec: str, k: int, include_self: bool = False,
        pivots: np.ndarray | None = None, cell_target: int = DEFAULT_CELL_TARGET, seed: int = 42,
        partition_cols: list | None = None, queries: DataFrame | None = None) -> DataFrame:
    """Exact k nearest neighbours (id, nbr_id, dist, rank); ties by neighbour id.

    With ``queries`` (same columns) the neighbours in ``df`` of its rows, equal ids included.

    ``partition_cols`` restricts neighbours to rows with equal values there
    (e.g. the class, for SMOTE): the cell key becomes (partition, cell)."""
    part = list(partition_cols or [])
    include_self = include_self or queries is not None
    kk = k + (0 if include_self else 1)
    base, asked, tree = _setup(df, part, id_col, vec, pivots, None, cell_target, seed, queries)
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in base.schema.fields if f.name in part]
                       + ["id_a long", "id_b long", "dist double"])
    nearest = Window.partitionBy(*part, "id_a").orderBy("dist", "id_b")  # per row: its bounded candidate list
    if tree is None:
        own = _one_tile(base, asked, part).groupBy(*(part or ["_tile"])).applyInPandas(_knn_within(kk, part), schema)
    else:
        own = _knn_in_cells(base, asked, tree, kk, include_self, part, cell_target, schema, nearest)
    cand = own if include_self else own.filter(F.col("id_a") != F.col("id_b"))
    ranked = cand.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k)
    return ranked.select(*part, F.col("id_a").alias("id"), F.col("id_b").alias("nbr_id"), "dist", "rank")


def _knn_in_cells(base, asked, tree, kk, include_self, part, cell_target, schema, nearest):
    """At least the kk nearest of every row: those of its home block bound the radius, then the blocks within it."""
    homes = assign_homes(base, tree)
    ask = homes if asked is None else PT.with_cells(asked, "_v", tree)
    group = [*part, "cell", "ht", "qt"]
    tile_rows = block_rows(int(tree.cell_rows.sum()), len(tree.origin), cell_target)
    block = blocks_of_cells(tree, tile_rows)
    own = (tile_pairs(_homes(homes, part, block), _homes(ask, part, block), part, tile_rows).groupBy(*group).applyInPandas(_knn_within(kk, part), schema))
    want = kk if include_self else kk - 1         # ids may repeat: pairs of an id with itself take no neighbour's place
    own = own if include_self else own.filter(F.col("id_a") != F.col("id_b"))
    own = own.withColumn("_r", F.row_number().over(nearest)).filter(F.col("_r") <= want).drop("_r")
    if block[-1] == 0:
        return own
    own = cut_lineage(own)
    # a row whose own block holds too few rows has no bound and probes every block
    radius = (own.groupBy(*part, F.col("id_a").alias("_id")).agg(F.max("dist").alias("_max"), F.count(F.lit(1)).alias("_n"))
                 .select(*part, "_id", F.when(F.col("_n") >= want, F.col("_max")).alias("_r")))
    bounded = ask.select(*part, "_id", "_v", "_home")
    bounded = join_rows(bounded, radius, [*part, "_id"], int(tree.cell_rows.sum()), "left")
    home = F.element_at(F.lit(block.tolist()), F.col("_home") + 1)
    probes = (PT.with_probes(bounded, "_v", tree, "_r", block).select(*part, "_id", "_v", home.alias("_home"), F.explode("_cells").alias("cell"))
                .filter(F.col("cell") != F.col("_home")).drop("_home"))
    other = tile_pairs(_homes(homes, part, block), probes, part, tile_rows).groupBy(*group).applyInPandas(_knn_within(kk, part), schema)
    return own.unionByName(other)

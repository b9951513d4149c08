"""Exact order statistics without funnelling a column through one task.

Spark's exact ``percentile`` aggregate keeps a map of every distinct value of
the column inside the single final-aggregation task, and a ``Window`` without
(or with a coarse) ``partitionBy`` sorts a whole group inside one task.  Both
are fine for a few thousand rows and both break on a 100 TB table.  The primitives here stay exact and keep every task bounded:

``values_at_ranks`` / ``exact_quantiles``
    1. one aggregate pass: count, min, max and ``percentile_approx`` (a
       bounded sketch) per column;
    2. a verification pass turns the sketch answer into a bracket
       ``[lo, hi]`` that provably contains the wanted rank, with the exact
       number of values below ``lo``;
    3. while a bracket still holds more than ``max_bracket`` values, one
       histogram pass (``bins`` equal-width sub-buckets, partial aggregation
       map-side) narrows it; a single-valued bucket resolves it at once;
    4. a final pass ranks the (bounded) bracket contents with a window
       partitioned by target.
    Only O(targets x bins) numbers ever reach the driver.

``grouped_quantiles``
    The same refinement per (group, column) for any number of groups: brackets
    are rows of a table, and nothing but row counts reaches the driver.

``ordered_cumsum``
    Exact running sums (and row numbers) along an order key within groups:
    the key range is cut into buckets of ~``TARGET_ROWS_PER_TASK`` rows, each
    bucket is summed in parallel, bucket offsets come from a tiny table, and
    the running sum inside a bucket is a window partitioned by
    ``(group, bucket)``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import TARGET_ROWS_PER_TASK, write_shared

DEFAULT_ACCURACY = 10_000
DEFAULT_MAX_BRACKET = 200_000
DEFAULT_BINS = 1024


def _num(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def values_at_ranks(df: DataFrame, cols: list, ranks: dict, counts: dict | None = None,
                    accuracy: int = DEFAULT_ACCURACY, max_bracket: int = DEFAULT_MAX_BRACKET,
                    bins: int = DEFAULT_BINS) -> dict:
    """Exact value of each 0-based rank among the non-null values of a column.

    ``ranks`` maps column name -> list of ranks.  Returns ``{(col, rank): value}``.
    ``counts`` may carry ``{col: (n, min, max)}`` from an earlier pass.
    """
    cols = list(cols)
    if counts is None:
        counts = column_counts(df, cols)
    targets = []  # dicts with the refinement state
    for c in cols:
        n, mn, mx = counts[c]
        for r in sorted(set(int(x) for x in ranks.get(c, []))):
            if n == 0 or r < 0 or r >= n:
                continue
            t = {"col": c, "rank": r, "lo": mn, "hi": mx, "below": 0, "inside": n, "value": None}
            if mn == mx or r == 0:
                t["value"] = mn
            elif r == n - 1:
                t["value"] = mx
            targets.append(t)

    open_t = [t for t in targets if t["value"] is None]
    if open_t:
        _seed_from_sketch(df, open_t, counts, accuracy)
    for _ in range(64):
        big = [t for t in targets if t["value"] is None and t["inside"] > max_bracket]
        if not big:
            break
        _histogram_pass(df, big, bins)
    rest = [t for t in targets if t["value"] is None]
    if rest:
        _final_pass(df, rest)
    return {(t["col"], t["rank"]): t["value"] for t in targets}


def column_counts(df: DataFrame, cols: list) -> dict:
    aggs = []
    for i, c in enumerate(cols):
        x = _num(c)
        aggs += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"mn{i}"), F.max(x).alias(f"mx{i}")]
    row = df.agg(*aggs).collect()[0]
    return {c: (int(row[f"n{i}"]), row[f"mn{i}"], row[f"mx{i}"]) for i, c in enumerate(cols)}


def _seed_from_sketch(df, targets, counts, accuracy):
    """Sketch brackets, then one exact verification pass."""
    margin = 3.0 / accuracy
    by_col: dict = {}
    for t in targets:
        by_col.setdefault(t["col"], []).append(t)
    aggs = []
    plan = []
    for i, (c, ts) in enumerate(by_col.items()):
        n = counts[c][0]
        fr = []
        for t in ts:
            f = t["rank"] / max(n - 1, 1)
            fr += [max(0.0, f - margin), min(1.0, f + margin)]
        aggs.append(F.percentile_approx(_num(c), fr, accuracy).alias(f"a{i}"))
        plan.append((i, c, ts))
    row = df.agg(*aggs).collect()[0]
    for i, c, ts in plan:
        vals = row[f"a{i}"]
        for j, t in enumerate(ts):
            t["lo"], t["hi"] = vals[2 * j], vals[2 * j + 1]
    # verification: exact count below lo and inside [lo, hi]
    vaggs = []
    for k, t in enumerate(targets):
        x = _num(t["col"])
        vaggs += [F.count_if(x < F.lit(t["lo"])).alias(f"b{k}"),
                  F.count_if((x >= F.lit(t["lo"])) & (x <= F.lit(t["hi"]))).alias(f"i{k}")]
    vrow = df.agg(*vaggs).collect()[0]
    for k, t in enumerate(targets):
        below, inside = int(vrow[f"b{k}"]), int(vrow[f"i{k}"])
        if below <= t["rank"] < below + inside:
            t["below"], t["inside"] = below, inside
        else:  # sketch missed: fall back to the full range
            n, mn, mx = counts[t["col"]]
            t["lo"], t["hi"], t["below"], t["inside"] = mn, mx, 0, n
        if t["lo"] == t["hi"]:
            t["value"] = t["lo"]


def _any_inside(brackets) -> Column:
    """Plain range predicate (codegen'd, pushed to the scan): only rows inside
    some bracket reach the per-row array expressions."""
    cond = None
    for c, lo, hi in brackets:
        x = _num(c)
        one = (x >= F.lit(lo)) & (x <= F.lit(hi))
        cond = one if cond is None else cond | one
    return cond


def _histogram_pass(df, targets, bins):
    brackets = {}
    for t in targets:
        brackets.setdefault((t["col"], t["lo"], t["hi"]), []).append(t)
    items = []
    keys = list(brackets)
    for b, (c, lo, hi) in enumerate(keys):
        x = _num(c)
        width = (hi - lo) / bins
        bucket = F.least(F.lit(bins - 1), F.floor((x - F.lit(lo)) / F.lit(width)).cast("int"))
        items.append(F.when((x >= F.lit(lo)) & (x <= F.lit(hi)),
                            F.struct(F.lit(b).alias("b"), bucket.alias("k"), x.alias("x"))))
    arr = F.filter(F.array(*items), lambda s: s.isNotNull())
    hist = (df.filter(_any_inside([(c, lo, hi) for c, lo, hi in keys])).select(F.explode(arr).alias("s"))
              .groupBy(F.col("s.b").alias("b"), F.col("s.k").alias("k"))
              .agg(F.count("*").alias("cnt"), F.min("s.x").alias("mn"), F.max("s.x").alias("mx"))
              .collect())
    per = {}
    for r in hist:
        per.setdefault(r["b"], []).append((r["k"], int(r["cnt"]), r["mn"], r["mx"]))
    for b, key in enumerate(keys):
        rows = sorted(per.get(b, []))
        for t in brackets[key]:
            need = t["rank"] - t["below"]
            acc = 0
            for _, cnt, mn, mx in rows:
                if acc + cnt > need:
                    off = need - acc
                    t["below"] += acc
                    t["lo"], t["hi"], t["inside"] = mn, mx, cnt
                    if mn == mx or off == 0:
                        t["value"] = mn
                    elif off == cnt - 1:
                        t["value"] = mx
                    break
                acc += cnt


def _final_pass(df, targets):
    items = []
    offs = {}
    for k, t in enumerate(targets):
        x = _num(t["col"])
        items.append(F.when((x >= F.lit(t["lo"])) & (x <= F.lit(t["hi"])),
                            F.struct(F.lit(k).alias("t"), x.alias("x"))))
        offs[k] = t["rank"] - t["below"] + 1
    arr = F.filter(F.array(*items), lambda s: s.isNotNull())
    want = F.create_map(*[F.lit(v) for kv in offs.items() for v in kv])
    w = Window.partitionBy("t").orderBy("x")
    inside = _any_inside([(t["col"], t["lo"], t["hi"]) for t in targets])
    rows = (df.filter(inside).select(F.explode(arr).alias("s")).select("s.t", "s.x")
              .withColumn("rn", F.row_number().over(w))
              .filter(F.col("rn") == F.element_at(want, F.col("t")))
              .collect())
    for r in rows:
        targets[r["t"]]["value"] = r["x"]


def exact_quantiles(df: DataFrame, cols: list, probs: list, **kw) -> dict:
    """Linear-interpolated quantiles (numpy / DuckDB ``quantile_cont`` rule).

    Returns ``{(col, p): value}``; ``None`` for an all-null column.
    """
    cols = list(cols)
    counts = column_counts(df, cols)
    ranks = {}
    for c in cols:
        n = counts[c][0]
        rs = []
        for p in probs:
            if n:
                pos = p * (n - 1)
                rs += [math.floor(pos), math.ceil(pos)]
        ranks[c] = rs
    vals = values_at_ranks(df, cols, ranks, counts=counts, **kw)
    out = {}
    for c in cols:
        n = counts[c][0]
        for p in probs:
            if not n:
                out[(c, p)] = None
                continue
            pos = p * (n - 1)
            lo, hi = math.floor(pos), math.ceil(pos)
            vlo, vhi = vals[(c, lo)], vals[(c, hi)]
            out[(c, p)] = vlo + (vhi - vlo) * (pos - lo) if hi != lo else vlo
    return out


def keyed_values(df: DataFrame, by: str, cols: list) -> DataFrame:
    """(g, c, x): one row per row and column, g the value of ``by`` (null groups are left out), x null or a number."""
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"`{c}`").cast("double").alias("x")) for c in cols])
    long = df.filter(F.col(f"`{by}`").isNotNull()).select(F.col(f"`{by}`").alias("g"), F.explode(pairs).alias("s"))
    return long.select("g", "s.c", F.when(~F.isnan("s.x"), F.col("s.x")).alias("x"))


def grouped_quantiles(df: DataFrame, by: str, cols: list, probs: list, max_bracket: int = DEFAULT_MAX_BRACKET,
                      bins: int = DEFAULT_BINS) -> DataFrame:
    """Exact linear-interpolated quantiles per value of ``by`` and column: (g, c, n, q), q in the order of ``probs``.

    The groups may be any number.  (group, column) is a key and the brackets of
    the wanted ranks are a table: a histogram pass narrows those that hold more
    than ``max_bracket`` values (a hot group; a value that fills a bucket alone
    is found at once), then the rows inside the brackets are ranked, a window
    per bracket.  Nulls and NaN do not count; a column without values has n = 0
    and null quantiles."""
    rows = keyed_values(df, by, cols)
    stats = write_shared(rows.groupBy("g", "c").agg(F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")), "groups")
    at = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    ranks = F.array_distinct(F.array(*[f(a).cast("long") for a in at for f in (F.floor, F.ceil)]))
    # a bracket: values lo..hi of a key, ``below`` values under it, ``inside`` values in it, and the ranks wanted from it
    brackets = stats.filter("n > 0").select("g", "c", "lo", "hi", F.lit(0).cast("long").alias("below"), F.col("n").alias("inside"), ranks.alias("ranks"))
    big = (F.col("inside") > max_bracket) & (F.col("lo") < F.col("hi"))
    while not brackets.filter(big).isEmpty():
        brackets = write_shared(brackets.filter(~big).unionByName(_narrowed(rows, brackets.filter(big), bins)), "brackets")
    one = brackets.filter("lo = hi").select("g", "c", F.explode("ranks").alias("rank"), F.col("lo").alias("x"))
    many = brackets.filter("lo < hi")
    inside = rows.join(many, ["g", "c"]).filter("x >= lo AND x <= hi")
    here = F.row_number().over(Window.partitionBy("g", "c", "lo").orderBy("x")) - 1 + F.col("below")
    ranked = inside.withColumn("rank", here.cast("long")).filter(F.array_contains("ranks", F.col("rank"))).select("g", "c", "rank", "x")
    values = one.unionByName(ranked).groupBy("g", "c").agg(F.map_from_entries(F.collect_list(F.struct("rank", "x"))).alias("v"))
    got = stats.select("g", "c", "n").join(values, ["g", "c"], "left")
    q = []
    for a in at:
        lo, hi = F.element_at("v", F.floor(a).cast("long")), F.element_at("v", F.ceil(a).cast("long"))
        q.append(F.when(F.ceil(a) == F.floor(a), lo).otherwise(lo + (hi - lo) * (a - F.floor(a))))
    return got.select("g", "c", "n", F.array(*q).alias("q"))


def _narrowed(rows: DataFrame, brackets: DataFrame, bins: int) -> DataFrame:
    """One histogram pass: each wanted rank moves to the bucket of its bracket that holds it."""
    width = F.col("hi") / bins - F.col("lo") / bins
    place = F.nanvl((F.col("x") - F.col("lo")) / width, F.lit(bins / 2.0))           # infinite ends: the rest lies between them
    k = (F.when(F.col("x") == F.col("lo"), 0).when(F.col("x") == F.col("hi"), bins - 1)
         .otherwise(F.least(F.lit(bins - 1), F.floor(place).cast("int"))))
    hist = (rows.join(brackets, ["g", "c"]).filter("x >= lo AND x <= hi").withColumn("k", k)
                .groupBy("g", "c", F.col("lo").alias("old"), "k").agg(F.count(F.lit(1)).alias("inside"), F.min("x").alias("lo"), F.max("x").alias("hi"),
                                                                     F.first("below").alias("base"), F.first("ranks").alias("all")))
    up = Window.partitionBy("g", "c", "old").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)     # at most ``bins`` rows
    hist = hist.withColumn("below", F.col("base") + F.coalesce(F.sum("inside").over(up), F.lit(0)))
    mine = F.filter("all", lambda r: (r >= F.col("below")) & (r < F.col("below") + F.col("inside")))
    return hist.withColumn("ranks", mine).filter(F.size("ranks") > 0).select("g", "c", "lo", "hi", "below", "inside", "ranks")


# ---------------------------------------------------------------- running sums

def _n_buckets(n: int) -> int:
    return max(1, math.ceil(n / TARGET_ROWS_PER_TASK))


def ordered_cumsum(df: DataFrame, order_col: str, value_cols: list, by: list | None = None,
                   descending: bool = False, key_range: tuple | None = None,
                   n_rows: int | None = None, with_totals: bool = False, tie: str | None = None) -> DataFrame:
    """Inclusive running sums ``cum_<v>`` of ``value_cols`` along ``order_col``
    within ``by`` groups, plus ``row_in_group`` (1-based row number).

    Rows sharing an order value follow the ``tie`` column (a unique id makes
    the order the same in every run); without one their relative order is
    arbitrary, and callers pre-aggregate by the order value.
    ``key_range=(lo, hi)`` declares a uniformly spread key (e.g. a hash) so
    buckets are computed without a sketch.
    """
    by = list(by or [])
    n = n_rows if n_rows is not None else df.count()
    nb = _n_buckets(n)
    o = F.col(order_col)
    d = df
    if nb == 1:
        bucket = F.lit(0)
    elif key_range is not None:
        lo, hi = key_range
        bucket = F.least(F.lit(nb - 1), F.floor((o.cast("double") - F.lit(float(lo)))
                                                 / F.lit((float(hi) - float(lo)) / nb)).cast("int"))
    else:
        from pyspark.ml.feature import Bucketizer
        cuts = df.agg(F.percentile_approx(o.cast("double"), [i / nb for i in range(1, nb)],
                                          max(DEFAULT_ACCURACY, 10 * nb))).collect()[0][0]
        # any monotone bucketing keeps the running sums exact; Bucketizer does a
        # binary search per row in the JVM (NaN keys: an extra last bucket)
        splits = [float("-inf")] + sorted(set(float(c) for c in cuts)) + [float("inf")]
        nb = len(splits)
        d = Bucketizer(splits=splits, inputCol="_key", outputCol="_bkd", handleInvalid="keep").transform(
            df.withColumn("_key", o.cast("double"))).drop("_key")
        bucket = F.col("_bkd").cast("int")
    if descending:
        bucket = F.lit(nb - 1) - bucket
    d = d.withColumn("_bk", bucket).withColumn("_one", F.lit(1))
    if "_bkd" in d.columns:
        d = d.drop("_bkd")
    vals = list(value_cols) + ["_one"]
    totals = d.groupBy(*by, "_bk").agg(*[F.sum(v).alias(f"_t_{v}") for v in vals])
    wt = Window.partitionBy(*by).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, "_bk", *[F.coalesce(F.sum(f"_t_{v}").over(wt), F.lit(0)).alias(f"_o_{v}")
                                         for v in vals])
    # offsets has (#groups x #buckets) rows; Spark broadcasts it only if its measured size allows
    d = d.join(offsets, on=[*by, "_bk"], how="inner")
    if with_totals:  # group totals ``tot_<v>``: one row per group
        gkey = by or ["_g"]
        gt = totals.withColumn("_g", F.lit(0)).groupBy(*gkey).agg(
            *[F.sum(f"_t_{v}").alias(f"tot_{v}") for v in value_cols])
        d = d.withColumn("_g", F.lit(0)).join(gt, on=gkey, how="inner").drop("_g")
    ordcol = o.desc() if descending else o.asc()
    wi = Window.partitionBy(*by, "_bk").orderBy(ordcol, *([F.col(tie)] if tie else [])).rowsBetween(Window.unboundedPreceding, 0)
    out = d
    for v in value_cols:
        out = out.withColumn(f"cum_{v}", F.sum(v).over(wi) + F.col(f"_o_{v}"))
    out = out.withColumn("row_in_group", (F.sum("_one").over(wi) + F.col("_o__one")).cast("long"))
    return out.drop("_bk", "_one", *[f"_o_{v}" for v in vals])

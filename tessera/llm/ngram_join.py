"""N-gram Jaccard join: a size-aware heavy-light join of shingle sets.

Two documents link when their sets of distinct five-word shingles have a
Jaccard similarity of at least ``num / den`` (0.8).  Steps:

1. Sets.  Each whole text becomes a sorted array of 64-bit shingle hashes.
   Documents with equal sets form a class, which goes on as one set.
2. Live tokens.  In hash order, linked sets of n tokens must share ``k`` tokens
   of their first ``n - c + k`` (c: least overlap; k a twentieth of n).  Tokens
   that only one set has cannot be shared, so sets with fewer than k tokens
   found elsewhere leave, exactly.  The remaining sets are ordered rarest token
   first; only those with at least c shared tokens stay.
3. Heavy-light.  Tokens with equal inverted lists (one line that many texts
   share, one passage of a group of copies) count as one list from here: the
   name of a list is its length and the exclusive or of its sets' hashes, and
   tokens are ordered by list.  Small sets enumerate the 2-subsets of the lists of
   their rarest ``n - c + 2`` tokens, and each list that holds two of them:
   linked small sets share one.  Large sets are found
   through the lists of the rarest ``n - c + 1`` tokens, which the
   small sets they may link with join too.  The boundary between small and
   large is the size at which the summed cost - subsets enumerated below,
   list entries scanned above - is least.
4. Verification.  Sets that share a signature are chained to the smallest set
   of that signature (never expanded into pairs); connected candidates form
   groups, groups are cut into blocks of bounded size, and every pair of blocks
   is compared exactly by one matrix product.  A block pair returns link
   counts and a spanning forest of its links, not the pairs.
5. Components of the forests, by smallest doc_id; copies take their class's.

Sets are unequal tokens of 64-bit hashes (xxh3 of the words, mixed); two
different shingles of one compared pair collide with probability below 1e-12.
Null texts and texts without words have an empty set and link with nothing;
repeated rows and ids are separate documents of the same class.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_staged, session_settings, staged
from .components import connected_components
from .shingles import set_name, shingle_set, word_hashes

BLOCK_TOKENS = 262_144    # tokens of the sets in one verification block
PREFIX_SHARE = 20         # k = n // PREFIX_SHARE + 1 shared prefix tokens in step 2
SIZE_CLASSES_PER_OCTAVE = 4
#: Spark's runtime filter of a join, whatever the size of its sides (at most 8 MB of bits; a full filter passes all rows on).
BLOOM_JOIN = {"spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
              "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
              "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1TB"}


def least_overlap(n, num: int, den: int):
    """Smallest overlap c of a set of n tokens with any set it links with: ceil(num / den * n)."""
    return F.ceil(n * num / den).cast("long")


def set_table(docs: DataFrame, num: int, den: int) -> DataFrame:
    """Staged (doc_id, text_name, n, sid, pre): size and name of every document's set and its prefix in hash order.

    Only prefixes (about a quarter of the tokens) are written; whole sets are
    made again for the few sets that may have a partner."""
    def run(batches):
        import pyarrow as pa
        for rb in batches:
            n, sid, pre = [], [], []
            for text in rb.column("text").to_pylist():
                s = shingle_set(word_hashes(text))
                m = len(s)
                n.append(m)
                sid.append(set_name(s) if m else None)
                pre.append(s[:m - -(-m * num // den) + m // PREFIX_SHARE + 1].tobytes())
            yield pa.RecordBatch.from_arrays([rb.column("doc_id"), rb.column("text_name"), pa.array(n, pa.int64()), pa.array(sid, pa.int64()), pa.array(pre, pa.binary())],
                                             names=["doc_id", "text_name", "n", "sid", "pre"])
    text = F.col("text").cast("string")
    sets = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_name"), text.alias("text")).mapInArrow(
        run, "doc_id long, text_name long, n long, sid long, pre binary")
    return staged(sets, "join-sets")


def row_name(text_name, doc_id):
    """64-bit name of a document's row: its text and its id, if it has one."""
    return F.xxhash64(text_name, doc_id)


def sets_of_texts(batches):
    """(sid, id, copies, text) -> (sid, n, toks, id, copies): the packed distinct shingles of whole texts."""
    import pyarrow as pa
    for rb in batches:
        sets = [shingle_set(word_hashes(t)) for t in rb.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([rb.column("sid"), pa.array([len(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary()),
                                          rb.column("id"), rb.column("copies")], names=["sid", "n", "toks", "id", "copies"])


def tokens_of(rows: DataFrame, column: str) -> DataFrame:
    """(sid, tok): one row per token of the packed ``column``."""
    def run(batches):
        import pyarrow as pa
        for rb in batches:
            sid = rb.column("sid").to_numpy(zero_copy_only=False)
            toks = [np.frombuffer(x, "<i8") for x in rb.column(column).to_pylist()]
            flat = np.concatenate(toks) if toks else np.empty(0, "i8")
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(sid, [len(t) for t in toks]), pa.int64()), pa.array(flat, pa.int64())], names=["sid", "tok"])
    return rows.select("sid", column).mapInArrow(run, "sid long, tok long")


def live_sets(docs: DataFrame, sets: DataFrame, classes: DataFrame, num: int, den: int):
    """Staged sets that may have a partner: (sid, n, n_live, rare) with the (length, name) of the lists of their rarest shared tokens, and (sid, n, copies, toks)."""
    pre = tokens_of(sets.filter("n > 0"), "pre")       # copies repeat the rows of their set
    shared = pre.groupBy("tok").agg(F.min("sid").alias("x"), F.max("sid").alias("y")).filter("x < y").select("tok")
    live = pre.join(shared, "tok").groupBy("sid").agg(F.count("*").alias("live"))
    k = F.floor(F.col("n") / PREFIX_SHARE) + 1
    survivors = staged(classes.join(live, "sid").filter(F.col("live") >= k * F.col("copies")).select("sid", "id", "copies", "row"), "join-survivors")
    # most documents have no partner: a Bloom filter of the survivors keeps their texts out of the shuffle
    text = F.col("text").cast("string")
    every = docs.select(row_name(F.xxhash64(text), F.col("doc_id").cast("long")).alias("row"), text.alias("text"))
    # rows repeated whole share their name, so they meet here; sets travel no further than their texts did
    texts = every.join(survivors.filter("copies > 0"), "row").dropDuplicates(["row"]).select("sid", "id", "copies", "text")
    with session_settings(docs.sparkSession, BLOOM_JOIN):
        kept = staged(texts.mapInArrow(sets_of_texts, "sid long, n long, toks binary, id long, copies long"), "join-kept")
    tokens = tokens_of(kept, "toks")
    # any function of the token serves as its list's name: sets that share two tokens share two names, or one name twice
    df = tokens.groupBy("tok").agg(F.count("*").alias("df"), F.bit_xor(F.xxhash64("sid")).alias("list")).filter("df > 1")
    ranked = (tokens.join(df, "tok").groupBy("sid")
              .agg(F.array_sort(F.collect_list(F.struct("df", "list"))).alias("rare")))   # one set's tokens: bounded by its text
    need = least_overlap(F.col("n"), num, den)
    live = F.size("rare").cast("long")
    out = (kept.select("sid", "n").join(ranked, "sid").filter(live >= need).withColumn("n_live", live)
           .withColumn("rare", F.slice("rare", 1, (F.col("n_live") - need + 2).cast("int"))))    # all that signatures need
    return staged(out, "join-live"), kept


def rarest(live_column: str, num: int, den: int, more: int):
    """Lists of the ``n - c + more`` rarest tokens of a set, less those that no other set has, in order."""
    need = least_overlap(F.col("n"), num, den)
    return F.slice(live_column, 1, F.greatest(F.lit(0), F.col("n_live") - need + more).cast("int"))


def twice(lists):
    """The lists that hold two or more of the tokens."""
    return F.array_distinct(F.filter(lists, lambda x, i: (i > 0) & (F.get(lists, i - 1) == x)))


def boundary(live: DataFrame, num: int, den: int) -> float:
    """Largest size of a small set: minimises subsets enumerated plus list entries scanned.

    Costs are summed per size class (a quarter octave), so the table that
    reaches the driver is bounded by the logarithm of the longest text."""
    one, two = rarest("rare", num, den, 1), rarest("rare", num, den, 2)
    lists = F.size(F.array_distinct(two))
    subsets = lists * (lists - 1) / 2 + F.size(twice(two))
    scans = F.aggregate(F.array_distinct(one), F.lit(0).cast("long"), lambda a, x: a + x["df"])
    size = F.floor(F.log2("n") * SIZE_CLASSES_PER_OCTAVE).cast("int")
    rows = live.groupBy(size.alias("s")).agg(F.sum(subsets).alias("subsets"), F.sum(scans).alias("scans")).orderBy("s").collect()
    best, cut = None, 0.0
    for k in range(len(rows) + 1):
        cost = sum(r["subsets"] for r in rows[:k]) + sum(r["scans"] for r in rows[k:])
        if best is None or cost < best:
            best, cut = cost, (2 ** (rows[k - 1]["s"] / SIZE_CLASSES_PER_OCTAVE + 1 / SIZE_CLASSES_PER_OCTAVE) if k else 0.0)
    return cut


def signatures(live: DataFrame, cut: float, num: int, den: int) -> DataFrame:
    """(id, sig, kind): 2-subsets of the lists of small sets; lists of large sets and of small sets near the boundary."""
    n = F.col("n")
    names = live.withColumn("one", F.transform(rarest("rare", num, den, 1), lambda x: x["list"])).withColumn(
        "two", F.transform(rarest("rare", num, den, 2), lambda x: x["list"]))
    lists = F.array_distinct("two")
    pairs = F.flatten(F.transform(lists, lambda x, i: F.transform(
        F.slice(lists, i + 2, F.size(lists)), lambda y: F.xxhash64(F.least(x, y), F.greatest(x, y)))))
    both = F.concat(pairs, F.transform(twice(F.col("two")), lambda x: F.xxhash64(x, x)))
    small = names.filter(n < cut).select(F.col("sid").alias("id"), F.explode(both).alias("sig"), F.lit(2).alias("kind"))
    large = names.filter(n >= cut * num / den).select(F.col("sid").alias("id"), F.explode(F.array_distinct("one")).alias("sig"), F.lit(1).alias("kind"))
    return small.union(large)


def candidate_groups(live: DataFrame, cut: float, num: int, den: int) -> DataFrame:
    """(node, component) over sets chained to the smallest set of each signature."""
    sig = signatures(live, cut, num, den)
    first = sig.groupBy("kind", "sig").agg(F.min("id").alias("b"), F.max("id").alias("z")).filter("b < z").drop("z")
    return connected_components(sig.join(first, ["kind", "sig"]).filter("id <> b").select(F.col("id").alias("a"), "b").distinct())


def _compare(ids_a, sets_a, ids_b, sets_b, same: bool, num: int, den: int):
    """Boolean link matrix of two blocks of sets."""
    na, nb = np.array([len(s) for s in sets_a]), np.array([len(s) for s in sets_b])
    flat_a = np.concatenate(sets_a)
    flat_b = flat_a if same else np.concatenate(sets_b)
    common = np.intersect1d(np.unique(flat_a), np.unique(flat_b)) if not same else np.unique(flat_a)
    inter = np.zeros((len(sets_a), len(sets_b)), "f4")
    step = max(1, 4_000_000 // max(len(sets_a), len(sets_b)))    # dense columns at a time

    def cells(flat, sizes):
        row = np.repeat(np.arange(len(sizes)), sizes)
        col = np.searchsorted(common, flat)
        ok = col < len(common)
        ok[ok] = common[col[ok]] == flat[ok]
        row, col = row[ok], col[ok]
        o = np.argsort(col, kind="stable")
        return row[o], col[o]
    ra, ca = cells(flat_a, na)
    rb, cb = (ra, ca) if same else cells(flat_b, nb)
    for lo in range(0, len(common), step):
        w = min(step, len(common) - lo)
        a, b = slice(*np.searchsorted(ca, [lo, lo + w])), slice(*np.searchsorted(cb, [lo, lo + w]))
        x = np.zeros((len(sets_a), w), "f4")
        x[ra[a], ca[a] - lo] = 1
        if same:
            y = x
        else:
            y = np.zeros((len(sets_b), w), "f4")
            y[rb[b], cb[b] - lo] = 1
        inter += x @ y.T
    inter = inter.astype("i8")
    link = den * inter >= num * (na[:, None] + nb[None, :] - inter)
    return np.triu(link, 1) if same else link


def _forest(i, j, n):
    """Edges of a spanning forest of the links (union-find over block members)."""
    root = np.arange(n)

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    keep = []
    for e, (a, b) in enumerate(zip(i.tolist(), j.tolist())):
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
            keep.append(e)
            n -= 1
            if n <= 1:
                break
    return keep


def verified(kept: DataFrame, groups: DataFrame, num: int, den: int) -> DataFrame:
    """(id, other, links): exact link counts (other null) and forest edges (links null) of block pairs."""
    sets = kept.select(F.col("sid").alias("id"), "n", "toks", "copies").join(groups.select(F.col("node").alias("id"), "component"), "id")
    total = groups.join(kept.select(F.col("sid").alias("node"), "n"), "node").groupBy("component").agg(
        F.ceil(F.sum("n") / BLOCK_TOKENS).cast("int").alias("blocks"))
    sets = sets.join(total, "component").withColumn("blk", F.pmod(F.xxhash64("id", F.lit(3)), F.col("blocks")).cast("int"))
    sets = sets.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sets = sets.withColumn("i", F.least("blk", "o")).withColumn("j", F.greatest("blk", "o"))

    def run(key, pdf):
        _, bi, bj = key
        a = pdf[pdf["blk"] == bi]
        b = a if bi == bj else pdf[pdf["blk"] == bj]
        out = {"id": [], "other": [], "links": []}
        if len(a) and len(b):
            sa, sb = ([np.frombuffer(x, "<i8") for x in f["toks"]] for f in (a, b))
            ia, ib = a["id"].to_numpy(), b["id"].to_numpy()
            link = _compare(ia, sa, ib, sb, bi == bj, num, den)
            ca, cb = a["copies"].to_numpy(), b["copies"].to_numpy()
            for ids, counts in ((ia, link @ cb), (ib, ca @ link)):
                on = counts > 0
                out["id"] += ids[on].tolist()
                out["other"] += [None] * int(on.sum())
                out["links"] += counts[on].tolist()
            x, y = np.nonzero(link)
            for e in _forest(x, y if bi == bj else y + len(a), len(a) if bi == bj else len(a) + len(b)):
                out["id"].append(int(ia[x[e]]))
                out["other"].append(int(ib[y[e]]))
                out["links"].append(None)
        return pd.DataFrame({"id": pd.array(out["id"], "Int64"), "other": pd.array(out["other"], "Int64"), "links": pd.array(out["links"], "Int64")})
    return sets.select("component", "i", "j", "blk", "id", "copies", "toks").groupBy("component", "i", "j").applyInPandas(run, "id long, other long, links long")


def linked_classes(docs: DataFrame, num: int, den: int):
    """(rows, classes): staged (doc_id, text_name, n, sid) of every document, and (sid, id, copies, component, links) of
    every distinct set; ``component`` names the group, ``id`` is the class's smallest doc_id."""
    sets = set_table(docs, num, den)
    classes = staged(sets.filter("n > 0").groupBy("sid").agg(F.min("doc_id").alias("id"), F.count("*").alias("copies"), F.first("n").alias("n"),
                                                               F.min(row_name("text_name", "doc_id")).alias("row")), "join-classes")
    live, kept = live_sets(docs, sets, classes, num, den)
    slim = staged(sets.select("doc_id", "text_name", "n", "sid"), "join-names")
    drop_staged(sets)       # no later step reads the prefixes
    cut = boundary(live, num, den)
    groups = staged(candidate_groups(live, cut, num, den), "join-groups")
    # sets outside all groups stay out of the shuffle, too (Spark builds a Bloom filter of a side that has a filter)
    with session_settings(docs.sparkSession, BLOOM_JOIN):
        found = staged(verified(kept, groups.filter("component <= node"), num, den), "join-links")
    comps = connected_components(found.filter("other IS NOT NULL").select(F.col("id").alias("a"), F.col("other").alias("b")))
    links = found.filter("links IS NOT NULL").groupBy("id").agg(F.sum("links").alias("links"))
    # sets are named by sid from here; a component's id is the smallest doc_id of its classes
    ids = classes.select("sid", "id", "copies").join(comps.select(F.col("node").alias("sid"), "component"), "sid", "left")
    return slim, ids.withColumn("component", F.coalesce("component", "sid")).join(links.withColumnRenamed("id", "sid"), "sid", "left")


def jaccard_components(docs: DataFrame, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links, class_id of every document.

    Rows without doc_id link by their text as all others do; component_id and
    class_id are null where no row of the group has an id."""
    slim, ids = linked_classes(docs, num, den)
    low = ids.groupBy("component").agg(F.min("id").alias("component_id"))
    per_class = (ids.join(low, "component")
                 .select("sid", F.col("id").alias("class_id"), "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    out = slim.select("doc_id", F.col("n").alias("n_shingles"), "sid").join(per_class, "sid", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("class_id", "doc_id").alias("class_id"))


def keep_one_per_group(docs: DataFrame, num: int = 80, den: int = 100) -> DataFrame:
    """Documents of which one row of each linked group stays: that of the smallest doc_id, once.

    The choice is made by row, not by id: of rows that share an id each belongs to
    the group of its own text.  A group in which no row has an id keeps one of
    them.  Rows without words link with nothing and all stay."""
    slim, classes = linked_classes(docs, num, den)
    rows = slim.filter("n > 0").join(classes.select("sid", "component"), "sid")
    # ids first, the smallest of them; texts of one id by name
    head = rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_name"))).alias("h"))
    head = staged(head.select(F.col("h.doc_id").alias("head_id"), F.col("h.text_name").alias("head_text")), "join-heads")
    text = F.col("text").cast("string")
    words = F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.filter(words).select(F.col("doc_id").cast("long").alias("id"), F.xxhash64(text).alias("name"), row)
    stay = keyed.join(head, (F.col("name") == F.col("head_text")) & F.col("id").eqNullSafe(F.col("head_id")), "left_semi")
    return stay.dropDuplicates(["id", "name"]).select("row.*").union(docs.filter(~words))

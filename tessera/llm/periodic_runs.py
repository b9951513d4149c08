"""Periodic runs of words: online dyadic square catching.

A square is a stretch of words repeated at once (period q, 2q words).  Words
are appended to a stream; for every power of two B the stream is cut into
blocks of B words.  When a block is complete, a catcher watches it: a stretch
of equal words at distance q that is at least 2B - 1 long holds a whole
block, so each completed block is looked up among the windows of B words that
end in the newly appended words, at the distances q that belong to B (about 2B
of them).  Where window and block agree, a suffix comparison is opened on
diagonal q: it is extended to the left once and advanced by every further
word, until two words differ.  It reports when it has become a square; squares
of one diagonal merge because the comparison goes on, squares of multiples of
the smallest period because they end up with the same stretch.

Windows are compared by 64-bit hashes kept per level (a window's hash comes
from its two halves, mixed), so a level costs a few vector operations per
append however many words are appended at once: a word at a time, a document,
or a batch of documents parted by words that occur nowhere else.  Two words
apart are taken as equal when their 64-bit hashes are.

Costs: O(words) comparisons a level, and log2(longest document) levels.
Memory: the words of the documents in the stream and one hash a word and level.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import sole_cache

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
CACHE = 500_000
APPEND = 1 << 16          # words appended at once; only memory and speed depend on it
TEXTS_AT_ONCE = 500       # texts whose words are held at once
C1, C2, C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * C2
    x = (x ^ (x >> np.uint64(27))) * C3
    return x ^ (x >> np.uint64(31))


def level_distances(min_words: int, longest: int) -> list[tuple[int, int, int]]:
    """(B, first q, last q) so that every run has its period in the row of a block it must hold.

    A run of period q has at least max(min_words, 2q) words, so at least
    max(min_words - q, q) of them agree with the word q later."""
    out: list[list[int]] = []
    q = 1
    while max(min_words, 2 * q) <= longest:
        agree = max(min_words - q, q)
        b = 1 << (((agree + 1) // 2).bit_length() - 1)            # largest power with 2b - 1 <= agree
        # the same block length holds on for a range of distances
        if agree == q:
            last = max(q, 4 * b - 2)                              # up to the next power
        else:
            last = q
        last = min(last, longest // 2)
        if out and out[-1][0] == b and out[-1][2] == q - 1:
            out[-1][2] = last
        else:
            out.append([b, q, last])
        q = last + 1
    return [tuple(x) for x in out]


class SquareCatcher:
    """Runs of an appended word stream (uint64 word hashes).

    ``append`` takes any number of words; ``end`` closes what is open.
    ``runs`` holds (start, length, period) of maximal stretches of at least
    ``max(min_words, 2 * period)`` words, the period being the smallest."""

    def __init__(self, min_words: int = 12, longest: int = 1 << 40):
        self.min_words = min_words
        self.levels = level_distances(min_words, longest)
        self.top = max((b for b, _, _ in self.levels), default=1)
        self.n = 0
        self.hashes: list[np.ndarray] = [np.empty(0, "u8")]       # per level: hash of every complete window of 2^level words
        self.open_q = np.empty(0, "i8")                           # open comparisons, at most one a diagonal,
        self.open_x = np.empty(0, "i8")                           # with the first word that agrees
        self.found: dict[tuple[int, int], int] = {}               # (start, end) -> smallest period

    # ---- windows

    def _grow(self, words: np.ndarray) -> None:
        """Append words to level 0 and complete the windows of the higher levels they end."""
        self.hashes[0] = np.concatenate([self.hashes[0], words])
        self.n = len(self.hashes[0])
        level, b = 0, 1
        while b < self.top and 2 * b <= self.n:
            if level + 1 == len(self.hashes):
                self.hashes.append(np.empty(0, "u8"))
            low, up = self.hashes[level], self.hashes[level + 1]
            old, new = len(up), max(self.n - 2 * b + 1, 0)
            if new > old:
                more = mixed(low[old:new] * C1 + low[old + b:new + b])
                self.hashes[level + 1] = np.concatenate([up, more])
            level, b = level + 1, 2 * b

    # ---- comparisons

    def _right(self, y: np.ndarray, q: np.ndarray) -> np.ndarray:
        """End of agreement: largest e >= y with word[i] == word[i + q] for y <= i < e (many at once)."""
        y = y.copy()
        for level in [*range(len(self.hashes)), *range(len(self.hashes) - 1, -1, -1)]:
            h, b = self.hashes[level], 1 << level
            if len(h):
                ok = y + q < len(h)
                a = np.where(ok, y, 0)
                y += b * (ok & (h[a] == h[np.where(ok, y + q, 0)]))
        while True:                                               # single steps settle what the powers left
            h = self.hashes[0]
            ok = y + q < self.n
            ok &= h[np.where(ok, y, 0)] == h[np.where(ok, y + q, 0)]
            if not ok.any():
                return y
            go = np.flatnonzero(ok)
            y[go] = self._right(y[go] + 1, q[go])

    def _left(self, x: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Start of agreement: smallest s <= x with word[i] == word[i + q] for s <= i < x."""
        x = x.copy()
        for level in [*range(len(self.hashes)), *range(len(self.hashes) - 1, -1, -1)]:
            h, b = self.hashes[level], 1 << level
            if len(h):
                s = x - b
                ok = (s >= 0) & (s + q < len(h))
                x -= b * (ok & (h[np.where(ok, s, 0)] == h[np.where(ok, s + q, 0)]))
        while True:
            h = self.hashes[0]
            s = x - 1
            ok = s >= 0
            ok &= h[np.where(ok, s, 0)] == h[np.where(ok, s + q, 0)]
            if not ok.any():
                return x
            go = np.flatnonzero(ok)
            x[go] = self._left(x[go] - 1, q[go])

    def _report(self, x, y, q) -> None:
        """Comparisons that ended: those long enough are runs."""
        big = (y - x >= q) & (y - x + q >= self.min_words)
        for a, e, p in zip(x[big].tolist(), (y + q)[big].tolist(), q[big].tolist()):
            if self.found.get((a, e), p) >= p:
                self.found[a, e] = p

    def append(self, words: np.ndarray) -> None:
        before = self.n
        self._grow(words)
        # every open comparison is advanced by the new words
        y = self._right(before - self.open_q, self.open_q)
        going = y + self.open_q == self.n
        self._report(self.open_x[~going], y[~going], self.open_q[~going])
        open_q, open_x = [self.open_q[going]], [self.open_x[going]]
        reach: dict[int, int] = dict(zip(self.open_q.tolist(), y.tolist()))
        # the catchers of completed blocks look at the windows the new words end
        for b, q0, q1 in self.levels:
            if q0 + b > self.n:                                   # no window is complete yet
                continue
            m, q = self._hits(before, b, q0, q1)
            if not len(m):
                continue
            order = np.lexsort((m, q))
            m, q = m[order], q[order]
            chain = np.ones(len(m), bool)                         # neighbouring blocks on one diagonal agree as one stretch
            chain[1:] = (q[1:] != q[:-1]) | (m[1:] != m[:-1] + 1)
            head = np.flatnonzero(chain)
            tail = np.append(head[1:], len(m)) - 1
            x, e, q = m[head] * b, (m[tail] + 1) * b, q[head]
            if reach:                                             # blocks inside a comparison already open are known
                new = np.array([at >= reach.get(d, -1) for at, d in zip(e.tolist(), q.tolist())], bool)
                x, e, q = x[new], e[new], q[new]
            e = self._right(e, q)
            x = self._left(x, q)
            # several chains of a diagonal may lie in one stretch
            order = np.lexsort((x, q))
            x, e, q = x[order], e[order], q[order]
            one = np.ones(len(x), bool)
            one[1:] = (x[1:] != x[:-1]) | (q[1:] != q[:-1])
            x, e, q = x[one], e[one], q[one]
            going = e + q == self.n
            self._report(x[~going], e[~going], q[~going])
            open_q.append(q[going])
            open_x.append(x[going])
        self.open_q, self.open_x = np.concatenate(open_q), np.concatenate(open_x)

    def _hits(self, before: int, b: int, q0: int, q1: int) -> tuple[np.ndarray, np.ndarray]:
        """(block, distance) pairs whose windows agree, the later window ending in words after ``before``."""
        h = self.hashes[b.bit_length() - 1]
        lo = max(0, -(-(before + 1 - q1 - b) // b))               # first block whose farthest window ends in the new words
        hi = (self.n - b - q0) // b + 1                           # past the last block whose nearest window is complete
        if hi <= lo:
            return np.empty(0, "i8"), np.empty(0, "i8")
        wide = q1 - q0 + 1
        starts = np.arange(lo, hi) * b
        full = min(hi, max(lo, (len(h) - q1 - 1) // b + 1))       # blocks with all their windows complete
        got_m, got_q = [], []
        if full > lo:
            view = np.lib.stride_tricks.as_strided(h[lo * b + q0:], (full - lo, wide), (8 * b, 8), writeable=False)
            m, j = np.nonzero(view == h[starts[:full - lo], None])
            got_m.append(m + lo)
            got_q.append(j + q0)
        for m in range(full, hi):                                 # the last few: windows still to come
            j = np.flatnonzero(h[m * b + q0:m * b + q1 + 1] == h[m * b])
            got_m.append(np.full(len(j), m))
            got_q.append(j + q0)
        m, q = np.concatenate(got_m), np.concatenate(got_q)
        new = m * b + q + b > before
        return m[new], q[new]

    def end(self) -> list[tuple[int, int, int]]:
        """Close the stream: (start, length, period) of all runs, by start and period."""
        self._report(self.open_x, self.n - self.open_q, self.open_q)
        self.open_q = self.open_x = np.empty(0, "i8")
        return sorted((a, e - a, p) for (a, e), p in self.found.items())


def word_ids(words: list[bytes]) -> np.ndarray:
    """uint64 hash of every word (its bytes as they are)."""
    import xxhash
    known = sole_cache("run words", dict)
    if len(known) > CACHE:
        known.clear()
    try:
        return np.array([known[w] for w in words], "u8")
    except KeyError:
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        return np.array([known[w] for w in words], "u8")


def runs_of_streams(ids: list[np.ndarray], min_words: int = 12, at_once: int = APPEND) -> list[list[tuple[int, int, int]]]:
    """Runs of each word sequence.

    Sequences of like length share a stream, parted by single words; a square
    cannot hold a word that occurs once.  A longer sequence has a stream of its
    own, appended piece by piece."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in ids]
    todo = sorted((i for i in range(len(ids)) if len(ids[i]) >= min_words), key=lambda i: len(ids[i]))
    at = 0
    while at < len(todo):
        group, size = [], 0
        while at < len(todo) and (not group or size + len(ids[todo[at]]) < at_once):
            group.append(todo[at])
            size += len(ids[todo[at]]) + 1
            at += 1
        catcher = SquareCatcher(min_words, len(ids[group[-1]]))
        starts, parts, n = [], [], 0
        for k, i in enumerate(group):
            starts.append(n)
            parts += [ids[i], mixed(np.array([k + 1], "u8") * C1)]      # a parting word of its own
            n += len(ids[i]) + 1
        stream = np.concatenate(parts)
        for s in range(0, n, at_once):
            catcher.append(stream[s:s + at_once])
        for start, length, period in catcher.end():
            k = int(np.searchsorted(starts, start, "right")) - 1
            out[group[k]].append((start - starts[k], length, period))
    return out


def collapsed_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words outside runs and the first period of each run."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return [w for w, k in zip(words, keep) if k]


RUNS = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def find_runs(docs: DataFrame, min_words: int = 12, columns=("doc_id",), text: str = "text") -> DataFrame:
    """``columns`` of docs with n_words, runs (by start, then period) and the collapsed text.

    A null text has no words and no runs; its collapsed text is empty.  Rows are
    judged one by one.  ``columns`` may not hold the three names added."""
    clash = {"n_words", "runs", "collapsed"} & set(columns)
    if clash:
        raise ValueError(f"rename columns {sorted(clash)} first")
    body = "_text"
    while body in {c.lower() for c in columns}:
        body += "_"
    src = docs.select(*[F.col(f"`{c}`") for c in columns], F.col(f"`{text}`").cast("string").alias(body))
    fields = src.schema.fields[:-1]
    schema = T.StructType(fields + list(T._parse_datatype_string(RUNS).fields))

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        for rb in (whole.slice(at, TEXTS_AT_ONCE) for whole in batches for at in range(0, whole.num_rows, TEXTS_AT_ONCE)):
            words = [WORDS.findall(t.encode("utf-8", "surrogatepass")) if t else [] for t in rb.column(body).to_pylist()]
            runs = runs_of_streams([word_ids(w) for w in words], min_words)
            kept = [b" ".join(collapsed_words(w, r)) for w, r in zip(words, runs)]
            spans = [[{"start": a, "length": n, "period": p} for a, n, p in r] for r in runs]
            cols = [rb.column(f.name).cast(arrow.field(f.name).type) for f in fields]
            cols += [pa.array([len(w) for w in words], pa.int64()), pa.array(spans, arrow.field("runs").type),
                     pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    return src.mapInArrow(run, schema)


def run_digest(found: DataFrame) -> DataFrame:
    """Per document: n_runs, the longest run, and digests of all runs and of the collapsed text."""
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    # smallest of (-length, start, period): the longest run, ties to the first
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period"))))
    return (found.withColumn("_best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_best.start").alias("start"), (-F.col("_best.n")).alias("length"),
                    F.col("_best.period").alias("period"), F.floor(F.lit(1000) * -F.col("_best.n") / F.col("_best.period")).cast("long").alias("exponent_milli"),
                    F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words", "runs"))


def plant_runs(docs: DataFrame) -> DataFrame:
    """Every document whose crc32(doc_id) is divisible by 10 becomes periodic from a word on (words joined by blanks).

    With h the crc32 and g = floor(h / 10): word i >= a becomes word
    a + (i - a) % p, a = g % n, p = 1 + floor((n - a) / (3 + g % 8)).  A null
    doc_id is left as it is."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    n = F.size("_w")
    a = g % n
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
    at = F.transform(F.sequence(F.lit(1), n), lambda i: F.when(i <= F.col("_a"), i).otherwise(F.col("_a") + F.pmod(i - 1 - F.col("_a"), F.col("_p")) + 1))
    planted = F.array_join(F.transform(F.col("_at"), lambda i: F.element_at("_w", i.cast("int"))), " ")
    out = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("_w"))
    out = out.withColumn("_a", F.when(n > 0, a)).withColumn("_p", F.when(n > 0, p)).withColumn("_at", F.when(n > 0, at))
    return out.select("doc_id", F.when(n > 0, planted).otherwise(F.col("text")).alias("text"))

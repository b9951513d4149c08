"""Quality classifier: a byte-level convolutional network in numpy.

Every byte has a learned embedding; learned filters of ``WIDTH`` bytes slide
over the whole document with stride ``STRIDE``; their rectified responses are
max-pooled inside overlapping chunks (``2 * SEGMENT`` positions, half shared
with the neighbour).  The chunk maxima are combined by maximum and by mean over
all chunks into one logistic probability.  No text is cut: scoring walks long
documents block by block.

Training uses a bounded sample of labelled rows that are not held out: the
first ``max_rows`` by hash whose texts fit ``max_bytes`` (documented
parameters, independent of the corpus); their whole texts are used.  Scoring is
one narrow map over all documents.

Null texts score as empty; labels that are null do not count; repeated labels
of an id count as the largest.  Without labels of both kinds the score is the
smoothed rate of label 1 (0.5 without any).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out

DIM, WIDTH, STRIDE, FILTERS, SEGMENT = 8, 16, 2, 24, 48
MAX_ROWS, MAX_BYTES, EPOCHS, BATCH = 2000, 6_000_000, 6, 32
BLOCK = 16_384          # positions convolved at a time


class ByteCNN:
    def __init__(self, seed: int = 7, prior: float = 0.0):
        g = np.random.default_rng(seed)
        self.emb = g.normal(0, 0.5, (257, DIM)).astype("f4")      # 256: padding
        self.emb[256] = 0
        self.k = g.normal(0, (WIDTH * DIM) ** -0.5, (WIDTH * DIM, FILTERS)).astype("f4")
        self.kb = np.zeros(FILTERS, "f4")
        self.w = g.normal(0, 0.1, 2 * FILTERS).astype("f4")
        self.b = np.array([prior], "f4")
        self.constant = None

    PARAMS = ("emb", "k", "kb", "w", "b")

    @staticmethod
    def positions(n: int) -> int:
        """Filter positions of n bytes: whole segments that cover every byte."""
        need = max(1, -(-max(n - WIDTH, 0) // STRIDE) + 1)
        return -(-need // SEGMENT) * SEGMENT

    def layout(self, texts: list[bytes]):
        """Padded bytes of all texts in a row and the number of segments of each."""
        segs = [self.positions(len(t)) // SEGMENT for t in texts]
        parts = []
        for t, s in zip(texts, segs):
            a = np.full(s * SEGMENT * STRIDE, 256, "i2")
            raw = np.frombuffer(t, "u1")
            a[:min(len(raw), len(a))] = raw[:len(a)]
            tail = np.full(WIDTH, 256, "i2")
            rest = raw[len(a):]
            tail[:len(rest)] = rest
            parts.append((a, tail))
        return segs, parts

    def windows(self, a, tail):
        """Byte windows (positions x WIDTH) of one padded text."""
        full = np.concatenate([a, tail])
        return np.lib.stride_tricks.sliding_window_view(full, WIDTH)[:len(a):STRIDE]

    def conv(self, win):
        x = self.emb[win].reshape(len(win), WIDTH * DIM)
        return np.maximum(x @ self.k + self.kb, 0)

    def segments(self, texts: list[bytes]) -> tuple[np.ndarray, list[int]]:
        """Maxima of every segment of every text, block by block."""
        segs, parts = self.layout(texts)
        out = np.empty((sum(segs), FILTERS), "f4")
        done, pending, held = 0, [], 0
        step = BLOCK // SEGMENT * SEGMENT

        def flush():
            nonlocal done, pending, held
            if pending:
                r = self.conv(np.concatenate(pending) if len(pending) > 1 else pending[0])
                m = r.reshape(-1, SEGMENT, FILTERS).max(1)
                out[done:done + len(m)] = m
                done, pending, held = done + len(m), [], 0
        for a, tail in parts:
            win = self.windows(a, tail)
            for i in range(0, len(win), step):
                w = win[i:i + step]
                if held + len(w) > step:
                    flush()
                pending.append(w)
                held += len(w)
        flush()
        return out, segs

    @staticmethod
    def pool(seg: np.ndarray, segs: list[int]):
        """Document features: max and mean over overlapping chunks of two segments."""
        starts = np.r_[0, np.cumsum(segs)[:-1]]
        nxt = np.arange(len(seg)) + 1
        last = starts + np.asarray(segs) - 1
        nxt[last] = last          # the last chunk of a text is its last segment
        chunk = np.maximum(seg, seg[nxt])
        return np.concatenate([np.maximum.reduceat(seg, starts), np.add.reduceat(chunk, starts) / np.asarray(segs)[:, None]], 1), starts, nxt

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        seg, segs = self.segments(texts)
        z = self.pool(seg, segs)[0] @ self.w + self.b[0]
        return 1 / (1 + np.exp(-z.astype("f8")))

    def gradients(self, texts: list[bytes], y: np.ndarray):
        segs, parts = self.layout(texts)
        win = np.concatenate([self.windows(a, t) for a, t in parts])
        r = self.conv(win).reshape(-1, SEGMENT, FILTERS)
        at = r.argmax(1)
        seg = np.take_along_axis(r, at[:, None, :], 1)[:, 0]
        feat, starts, nxt = self.pool(seg, segs)
        p = 1 / (1 + np.exp(-(feat @ self.w + self.b[0])))
        dz = ((p - y) / len(y)).astype("f4")
        owner = np.repeat(np.arange(len(segs)), segs)
        g = np.zeros_like(seg)
        # mean over chunks: to whichever of the two segments holds the maximum
        dm = (dz / np.asarray(segs))[owner][:, None] * self.w[FILTERS:]
        own = seg >= seg[nxt]
        g += np.where(own, dm, 0)
        np.add.at(g, nxt, np.where(own, 0, dm))
        # maximum over the document
        top = np.maximum.reduceat(seg, starts)
        hit = seg == top[owner]
        g += np.where(hit, dz[owner][:, None] * self.w[:FILTERS], 0) / np.maximum(np.add.reduceat(hit, starts)[owner], 1)
        g[seg <= 0] = 0
        bytes_at = win[(np.arange(len(seg)) * SEGMENT)[:, None] + at]              # segment x filter x WIDTH
        x = self.emb[bytes_at].reshape(len(seg), FILTERS, WIDTH * DIM)
        dk = np.einsum("sf,sfi->if", g, x, optimize=True)
        dx = (g[:, :, None] * self.k.T[None]).reshape(-1, DIM)
        flat = bytes_at.ravel()
        demb = np.stack([np.bincount(flat, weights=dx[:, d], minlength=257) for d in range(DIM)], 1).astype("f4")
        demb[256] = 0
        return {"emb": demb, "k": dk, "kb": g.sum(0), "w": feat.T @ dz, "b": dz.sum(keepdims=True)}

    def fit(self, texts: list[bytes], y, epochs: int = EPOCHS, rate: float = 0.01, seed: int = 11):
        y = np.asarray(y, "f4")
        if len(set(y.tolist())) < 2:
            self.constant = float((y.sum() + 0.5) / (len(y) + 1)) if len(y) else 0.5
            return self
        self.b[0] = np.log(y.mean() / (1 - y.mean()))
        g = np.random.default_rng(seed)
        m = {p: np.zeros_like(getattr(self, p)) for p in self.PARAMS}
        v = {p: np.zeros_like(getattr(self, p)) for p in self.PARAMS}
        steps = max(epochs * -(-len(texts) // BATCH), 300)
        t = 0
        while t < steps:
            order = g.permutation(len(texts))
            for i in range(0, len(order), BATCH):
                pick = order[i:i + BATCH]
                t += 1
                lr = rate * (1 - t / (steps + 1)) + 1e-4
                for p, d in self.gradients([texts[j] for j in pick], y[pick]).items():
                    m[p] += 0.1 * (d - m[p])
                    v[p] += 0.01 * (d * d - v[p])
                    getattr(self, p)[...] -= lr * (m[p] / (1 - 0.9 ** t)) / (np.sqrt(v[p] / (1 - 0.99 ** t)) + 1e-8)
                if t >= steps:
                    break
        return self


def training_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, max_bytes: int):
    """(texts, labels) of a bounded sample of labelled rows that are not held out."""
    y = (labels.filter(F.col(label).isNotNull() & ~held_out("doc_id")).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
         .withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(max_rows))
    rows = docs.select("doc_id", F.col("text").cast("string")).filter(F.col("text").isNotNull())
    known = rows.join(F.broadcast(y), "doc_id")    # at most max_rows labels
    sizes = known.groupBy("doc_id", "h", "y").agg(F.max(F.octet_length("text")).alias("n")).orderBy("h", "doc_id").collect()
    ids, total = [], 0
    for r in sizes:
        if total + r["n"] <= max_bytes:
            total += r["n"]
            ids.append((r["doc_id"],))
    if not ids:
        return [], []
    pick = docs.sparkSession.createDataFrame(ids, "doc_id long")
    got = known.join(F.broadcast(pick), "doc_id").groupBy("doc_id", "y").agg(F.max("text").alias("text")).collect()
    got.sort(key=lambda r: r["doc_id"])
    return [r["text"].encode("utf-8") for r in got], [r["y"] for r in got]


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> ByteCNN:
    texts, y = training_sample(docs, labels, label, max_rows, max_bytes)
    return ByteCNN().fit(texts, y)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, label: str = "quality") -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    net = docs.sparkSession.sparkContext.broadcast(train(docs, labels, label))

    def run(batches):
        import pyarrow as pa
        for rb in batches:
            texts = [(t or "").encode("utf-8") for t in rb.column("text").to_pylist()]
            scores = [net.value.score(texts[i:i + 64]) for i in range(0, len(texts), 64)]
            s = np.concatenate(scores) if scores else np.empty(0)
            yield pa.RecordBatch.from_arrays([rb.column("doc_id"), pa.array(s, pa.float64())], names=["doc_id", "score"])
    src = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = src.mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

"""Line dedup by sorted ranges of line hashes; the result is a keep bitmap per document.

1. Every text is split at ``\\n`` in its map task.  A line's key is the line
   without white space at both ends, A-Z lower-cased; keys of at least
   ``min_chars`` code points leave the task as (128-bit hash, doc_id, tag,
   position), never as text.  ``tag`` is a hash of the whole text, so rows that
   share a doc_id keep bitmaps of their own without a staged row id.
2. These rows are range-partitioned and sorted by (hash, doc_id descending,
   position).  The range bounds hold the document as well, so a line that a
   third of all documents share is spread over many partitions.
3. Each partition is streamed once: the first document of a hash is the one
   that keeps it, further documents lose it once ``min_docs`` different ones
   have been seen.  Only the first and the last hash of a partition can have
   rows elsewhere: what is open about them leaves undecided, with the first
   documents seen of each.  These summaries (at most two hashes a partition, so
   they may be broadcast) settle the undecided rows.
4. Lost positions are gathered per document into a compressed bitmap.

Documents are told apart by doc_id: rows with the same doc_id count as one
holder, and a null doc_id counts as one document below all others.  Null and
empty texts are one empty line.  Repeated lines of the document that keeps a
key all stay.  Columns of the caller never take part, so their names are free.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

BLANKS = b" \t\n\x0b\x0c\r"
LINES = "h1 long, h2 long, doc long, tag long, pos int"
STREAM = LINES + ", kind int"
DROP, OPEN, SEEN = 0, 1, 2
NO_DOC = -(1 << 63)          # sorts below every id; stands for a null doc_id


def line_keys(text: str | None, min_chars: int) -> list[tuple[int, bytes]]:
    """(position, key) of the lines whose key has at least ``min_chars`` code points."""
    if not text:
        return []
    out = []
    for i, line in enumerate(text.encode("utf-8", "surrogatepass").lower().split(b"\n")):
        key = line.strip(BLANKS)
        if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "surrogatepass")) >= min_chars):
            out.append((i, key))
    return out


def row_tag(text):
    """Hash that tells rows of one doc_id apart by their texts."""
    return F.coalesce(F.xxhash64(text), F.lit(0))


def hashed_lines(docs: DataFrame, min_chars: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per line that can be dropped: h1, h2 (its key's hash), doc, tag, pos."""
    src = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_DOC)).alias("doc"),
                      row_tag(F.col(text)).alias("tag"), F.col(text).cast("string").alias("text"))

    def run(batches):
        import pyarrow as pa
        import xxhash
        for rb in batches:
            digests, at, pos = [], [], []
            for r, t in enumerate(rb.column("text").to_pylist()):
                keys = line_keys(t, min_chars)
                digests += [xxhash.xxh3_128_digest(k) for _, k in keys]
                pos += [i for i, _ in keys]
                at += [r] * len(keys)
            h = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[:, 0]), pa.array(h[:, 1]), rb.column("doc").take(take), rb.column("tag").take(take), pa.array(pos, pa.int32())],
                names=["h1", "h2", "doc", "tag", "pos"])

    return src.mapInArrow(run, LINES)


class HashStream:
    """Decides sorted rows of (hash, doc descending) as they pass.

    What it holds of earlier rows: the current hash, its first ``min_docs``
    documents, and the rows met before the last of these was seen."""

    def __init__(self, min_docs: int):
        self.min_docs = min_docs
        self.held: pd.DataFrame | None = None      # rows of the last hash that still wait
        self.hash: tuple | None = None
        self.docs: list[int] = []
        self.first_hash: tuple | None = None

    def feed(self, rows: pd.DataFrame):
        """Yield decided (DROP) and undecided (OPEN, SEEN) rows; the last hash stays held."""
        if not len(rows):
            return
        h1, h2, doc = (rows[c].to_numpy() for c in ("h1", "h2", "doc"))
        new = np.ones(len(rows), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        new[0] = self.hash != (h1[0], h2[0])
        starts = np.flatnonzero(new)
        lead = starts[0] if len(starts) else len(rows)
        if lead:                                   # the hash of the last batch goes on
            yield from self._more(rows.iloc[:lead], doc[:lead])
        if not len(starts):
            return
        yield from self._close()
        last = starts[-1]
        inner = rows.iloc[starts[0]:last]
        if len(inner):
            if self.first_hash is None:            # the partition's first hash is never decided here
                n = (starts[1] if len(starts) > 1 else last) - starts[0]
                self._open(inner.iloc[:n])
                yield from self._more(inner.iloc[:n], inner["doc"].to_numpy()[:n])
                yield from self._close()
                inner = inner.iloc[n:]
            if len(inner):
                yield self._decide(inner)
        self._open(rows.iloc[last:])
        yield from self._more(rows.iloc[last:], doc[last:])

    def _open(self, rows) -> None:
        self.hash = (rows["h1"].iloc[0], rows["h2"].iloc[0])
        if self.first_hash is None:
            self.first_hash = self.hash
        self.docs, self.held = [], None

    def _more(self, rows, doc):
        """Rows of the current hash, which may go on in the next batch or partition.

        Its first document is known unless the hash opened the partition; rows
        wait until enough documents are seen."""
        if len(self.docs) < self.min_docs:
            for d in pd.unique(doc):
                if len(self.docs) < self.min_docs and (not self.docs or self.docs[-1] != d):
                    self.docs.append(int(d))
            rows = rows if self.held is None else pd.concat([self.held, rows])
            self.held = rows
        if len(self.docs) >= self.min_docs and len(rows):
            self.held = None
            if self.hash == self.first_hash:
                yield rows.assign(kind=OPEN)
            else:
                yield rows[rows["doc"].to_numpy() != self.docs[0]].assign(kind=DROP)

    def _close(self, at_end: bool = False):
        """The current hash is over: settle what waits.

        Only the partition's first and last hash may have rows elsewhere."""
        if self.hash is None:
            return
        if self.hash == self.first_hash or at_end:
            if self.held is not None:
                yield self.held.assign(kind=OPEN)
            yield self._seen()
        self.hash, self.held = None, None

    def _seen(self):
        n = len(self.docs)
        return pd.DataFrame({"h1": [self.hash[0]] * n, "h2": [self.hash[1]] * n, "doc": self.docs, "tag": [0] * n, "pos": [0] * n, "kind": [SEEN] * n})

    def _decide(self, rows):
        """Whole groups inside the partition: drop all but the first document's rows where enough documents hold the key."""
        h1, h2, doc = (rows[c].to_numpy() for c in ("h1", "h2", "doc"))
        head = np.ones(len(rows), bool)
        head[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        group = np.cumsum(head) - 1
        other = head.copy()
        other[1:] |= doc[1:] != doc[:-1]
        n_docs = np.bincount(group, weights=other)
        top = doc[np.flatnonzero(head)]
        return rows[(n_docs[group] >= self.min_docs) & (doc != top[group])].assign(kind=DROP)

    def end(self):
        yield from self._close(at_end=True)


def dropped_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, tag, pos) of every line that its document loses."""
    order = [F.col("h1"), F.col("h2"), F.col("doc").desc(), F.col("tag"), F.col("pos")]
    rows = hashed_lines(docs, min_chars, doc_id, text)
    ordered = rows.repartitionByRange(*order[:4]).sortWithinPartitions(*order)

    def run(batches):
        stream = HashStream(min_docs)
        for pdf in batches:
            yield from stream.feed(pdf)
        yield from stream.end()

    passed = staged(ordered.mapInPandas(run, STREAM), "line-stream")
    # summaries of the hashes at partition ends, merged per hash: at most two rows a partition
    tops = F.slice(F.sort_array(F.collect_set("doc"), asc=False), 1, min_docs)
    ends = (passed.filter(F.col("kind") == SEEN).groupBy("h1", "h2").agg(tops.alias("tops"))
            .filter(F.size("tops") >= min_docs).select("h1", "h2", F.col("tops")[0].alias("top")))
    late = passed.filter(F.col("kind") == OPEN).join(F.broadcast(ends), ["h1", "h2"]).filter("doc <> top")
    return passed.filter(F.col("kind") == DROP).select("doc", "tag", "pos").unionByName(late.select("doc", "tag", "pos"))


def pack_bits(positions: np.ndarray) -> bytes:
    """Compressed bitmap: bit i is 0 where line i is dropped; lines past its end stay."""
    if len(positions) == 0:
        return b""
    bits = np.ones(int(positions.max()) // 8 * 8 + 8, np.uint8)       # whole bytes: padding bits stay 1
    bits[positions] = 0
    return zlib.compress(np.packbits(bits).tobytes(), 1)


def unpack_bits(bitmap: bytes | None, n: int) -> np.ndarray:
    """Keep flags of ``n`` lines."""
    keep = np.ones(n, bool)
    if bitmap:
        got = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[:n]
        keep[:len(got)] = got.astype(bool)
    return keep


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, tag, n_dropped, keep) of the documents that lose lines; all others keep all of theirs."""
    lost = dropped_lines(docs, min_chars, min_docs, doc_id, text)
    per = lost.groupBy("doc", "tag").agg(F.collect_set("pos").alias("at"))       # equal rows lose equal lines: a set
    pack = F.pandas_udf(lambda s: s.map(lambda a: pack_bits(np.asarray(a, np.int64))), "binary")
    return per.select("doc", "tag", F.size("at").cast("long").alias("n_dropped"), pack("at").alias("keep"))


def kept_lines(text: str | None, bitmap: bytes | None) -> str:
    """The text without its dropped lines."""
    text = text or ""
    if not bitmap:
        return text
    lines = text.split("\n")
    return "\n".join([line for line, k in zip(lines, unpack_bits(bitmap, len(lines))) if k])


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, n_lines, n_dropped, keep) of every row of ``docs``; keep is null where nothing is lost."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), body.alias("text"),
                       F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_DOC)).alias("doc"), row_tag(F.col(text)).alias("tag"))
    n_lines = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1
    return (rows.join(bitmaps, ["doc", "tag"], "left")
            .select("doc_id", "text", n_lines.cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), "keep"))


def line_digest(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Digest per document: n_lines, n_dropped, kept_sha256 and the keep bitmap."""
    apply = F.pandas_udf(lambda t, k: pd.Series([kept_lines(a, b) for a, b in zip(t, k)], dtype=object), "string")
    rows = with_bitmaps(docs, keep_bitmaps(docs, min_chars, min_docs))
    # only texts that lose lines go to Python
    kept = F.when(F.col("keep").isNull(), F.col("text")).otherwise(apply(F.when(F.col("keep").isNotNull(), F.col("text")), F.col("keep")))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(kept, 256).alias("kept_sha256"), "keep")

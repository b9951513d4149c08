"""Best-fit packing with large-item matching.

Documents become token pieces of at most ``capacity`` ids; only longer
documents are cut.  Packing works on the histogram of piece lengths (at most
``capacity`` numbers, whatever the corpus size):

1. pieces above a third of the capacity: no three fit together, so they pair
   at most twice per sequence.  Greedy matching takes the longest and gives it
   the longest partner that still fits.
2. smaller pieces, longest first, go into the sequence whose gap is smallest
   and still large enough (best fit), repeatedly, in bulk for equal lengths.
   Only when no gap fits is a new sequence opened.

The result is a list of runs (length, first rank, end rank, pieces per
sequence, first sequence, offset).  Ranks inside a length come from bucketed
windows, so placing pieces is a broadcast join with that bounded list and a
length shared by a third of all pieces is spread over many tasks.

Null texts are empty documents (their one token is the end id).
"""

from __future__ import annotations

import bisect
import os
import re
import zlib
from array import array

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import gapless_rank, sole_cache, staged, with_row_id

END_ID = 1
WORD_CACHE = 250_000
CUT_CACHE = 400_000
TEXTS_AT_ONCE = 1_000
CUTS_AT_ONCE = 2_000
CONTROL = re.compile("[\x1c-\x1f]").search


def public_vocabulary(name: str) -> str:
    """Path of an installed public vocabulary file (the same on every machine)."""
    import public_tokenizers
    return public_tokenizers.path(name)


class WordTokenizer:
    """Packed uint32 ids of texts, through bounded caches of words.

    ``word_bpe`` normalises (NFC, white space, lower case) and cuts a text into
    letter runs, single digits and other runs before merging; it never merges
    across white space or across those cuts.  So the ids of a text are those
    of its white-space separated words in order, and those of a plain word
    (``PLAIN``: ASCII or Latin letters and simple signs, where Python's lower
    case and NFC are the tokenizer's) are those of its cuts.  Every other word
    goes to the tokenizer as it is; texts with control separators, which
    Python splits at and the tokenizer does not, go there whole."""

    PLAIN = re.compile(r"[A-Za-z0-9.,;:!?#$%&*()\[\]\-+=/_@\"\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch
    CUTS = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+").findall

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tok = Tokenizer.from_file(path)
        self.words: dict[str, bytes] = {}
        self.cuts: dict[str, bytes] = {}
        vocabulary = self.tok.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)      # ids that end a cut
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def _ids(self, texts: list[str]) -> list[bytes]:
        encoded = self.tok.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in encoded]

    def _cut_ids(self, cuts: list[str]) -> list[bytes]:
        """Ids of each cut.  Many cuts are encoded as one text: blanks keep them apart and the
        last id of each is marked as an end of word."""
        out: list[bytes] = []
        for at in range(0, len(cuts), CUTS_AT_ONCE):
            part = cuts[at:at + CUTS_AT_ONCE]
            ids = self._ids([" ".join(part)])[0]
            stops = (4 * (np.flatnonzero(self.ends[np.frombuffer(ids, "u4")]) + 1)).tolist()
            if len(stops) != len(part):
                out += self._ids(part)      # a vocabulary without end marks
            else:
                out += [ids[lo:hi] for lo, hi in zip([0, *stops], stops)]
        return out

    def _learn(self, words) -> None:
        """Cache the ids of new words; only cuts not seen before reach the tokenizer."""
        whole, parts, single = [], {}, {}
        for w in words:
            if not self.PLAIN(w):
                whole.append(w)
            elif w.isalpha():
                single[w] = w.lower()
            elif w[:-1].isalpha() and not w[-1].isalnum():
                parts[w] = (w[:-1].lower(), w[-1])
            else:
                parts[w] = self.CUTS(w.lower())
        cuts = self.cuts
        new = {c for c in single.values() if c not in cuts}
        new.update(c for p in parts.values() for c in p if c not in cuts)
        new = list(new)
        cuts.update(zip(new, self._cut_ids(new)))
        self.words.update(zip(whole, self._ids(whole)))
        self.words.update((w, cuts[c]) for w, c in single.items() if w != c)     # others are cuts themselves
        self.words.update((w, b"".join([cuts[c] for c in p])) for w, p in parts.items())

    def encode_all(self, texts) -> list[bytes]:
        """Ids of each text, packed; None counts as empty."""
        import pyarrow as pa
        if len(self.words) > WORD_CACHE:
            self.words.clear()
        if len(self.cuts) > CUT_CACHE:
            self.cuts.clear()
        words: list[str] = []
        until = []          # words of the texts up to each one
        for t in texts:
            if t and not CONTROL(t):
                words += t.split()
            until.append(len(words))
        coded = pa.array(words, pa.large_string())
        del words           # a batch's largest part: gone before the next ones come
        coded = coded.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        seen, cuts = self.words, self.cuts
        self._learn([w for w in distinct if w not in cuts and w not in seen])
        known = [cuts[w] if w in cuts else seen[w] for w in distinct]
        # ids of the words in a row: where each word's ids start among those of the distinct words, and how many
        flat = np.frombuffer(b"".join(known), "<u4")
        sizes = np.fromiter(map(len, known), "i8", len(known)) // 4
        at = coded.indices.to_numpy(zero_copy_only=False)
        n = sizes[at]
        stops = np.concatenate([[0], np.cumsum(n)])
        del known, distinct, coded
        place = np.arange(stops[-1])
        place += np.repeat((np.cumsum(sizes) - sizes)[at] - stops[:-1], n)
        del at, n
        ids = flat[place].view("u1")
        del place
        ends = (4 * stops[[0, *until]]).tolist()
        return [self._ids([t])[0] if t and CONTROL(t) else ids[lo:hi].tobytes() for t, lo, hi in zip(texts, ends, ends[1:])]


def worker_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer and word cache per Python worker, kept between tasks."""
    return sole_cache(f"tokenizer {path}", lambda: WordTokenizer(path))


PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
])


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    def run(batches):
        tok = worker_tokenizer(tokenizer_path)
        end = np.asarray([END_ID], dtype="<u4").tobytes()
        for pdf in batches:
            texts = [t if isinstance(t, str) else None for t in pdf["text"]]
            docs_ids = pdf["doc_id"].astype("Int64").tolist()
            for at in range(0, len(texts), TEXTS_AT_ONCE):
                out = []
                for doc, ids in zip(docs_ids[at:], tok.encode_all(texts[at:at + TEXTS_AT_ONCE])):
                    ids += end
                    n = len(ids) // 4
                    for k, s in enumerate(range(0, n, capacity)):
                        part = ids[4 * s:4 * (s + capacity)]
                        out.append((doc, k, s, len(part) // 4, zlib.crc32(part)))
                frame = pd.DataFrame(out, columns=PIECES.fieldNames())
                frame["doc_id"] = frame["doc_id"].astype("Int64")
                yield frame
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInPandas(run, PIECES)


def plan_packing(counts: dict[int, int], capacity: int) -> tuple[list[tuple], int]:
    """Runs (length, rank_lo, rank_hi, per_bin, first_bin, offset) and the number of sequences.

    A piece of that length with rank r in [rank_lo, rank_hi) lies in sequence
    first_bin + (r - rank_lo) // per_bin at offset + (r - rank_lo) % per_bin * length."""
    left = {n: c for n, c in counts.items() if c > 0}
    ranks = dict.fromkeys(left, 0)
    runs: list[tuple] = []
    bins = 0
    gaps: dict[int, list[tuple[int, int]]] = {}   # gap -> [(first bin, bins)]
    order: list[int] = []                         # gaps in use, ascending

    def add_gap(gap, first, n):
        if gap > 0 and n > 0:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(order, gap)
            gaps[gap].append((first, n))

    def place(length, n, per, first, offset):
        runs.append((length, ranks[length], ranks[length] + n, per, first, offset))
        ranks[length] += n
        left[length] -= n

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        if not left[a]:
            large.pop()
            continue
        k = bisect.bisect_right(large, capacity - a) - 1
        while k >= 0 and not left[large[k]]:
            large.pop(k)
            k -= 1
        b = large[k] if k >= 0 else None
        if b == a and left[a] < 2:
            k -= 1
            while k >= 0 and not left[large[k]]:
                k -= 1
            b = large[k] if k >= 0 else None
        if b is None:
            n = left[a]
            place(a, n, 1, bins, 0)
            add_gap(capacity - a, bins, n)
        elif b == a:
            n = left[a] // 2
            place(a, 2 * n, 2, bins, 0)
            add_gap(capacity - 2 * a, bins, n)
        else:
            n = min(left[a], left[b])
            place(a, n, 1, bins, 0)
            place(b, n, 1, bins, a)
            add_gap(capacity - a - b, bins, n)
        bins += n
    for size in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[size]:
            k = bisect.bisect_left(order, size)
            if k == len(order):
                per = capacity // size
                full, rest = divmod(left[size], per)
                if full:
                    place(size, full * per, per, bins, 0)
                    add_gap(capacity - per * size, bins, full)
                    bins += full
                if rest:
                    place(size, rest, rest, bins, 0)
                    add_gap(capacity - rest * size, bins, 1)
                    bins += 1
                continue
            gap = order[k]
            first, n = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                order.pop(k)
            per = gap // size
            full = min(n, left[size] // per)
            if full:
                place(size, full * per, per, first, capacity - gap)
                add_gap(gap - per * size, first, full)
            first, n = first + full, n - full
            if n and left[size]:   # fewer than ``per`` pieces remain
                rest = left[size]
                place(size, rest, rest, first, capacity - gap)
                add_gap(gap - rest * size, first, 1)
                first, n = first + 1, n - 1
            add_gap(gap, first, n)
    return runs, bins


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """Add sequence_id and offset to staged pieces (``rid`` unique, ``length`` 1..capacity)."""
    spark = pieces.sparkSession
    hist = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    runs, _ = plan_packing(hist, capacity)
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("p_len", "r_lo", "r_hi", "per", "first", "off")])
    # bounded by the capacity (lengths and splits of gaps), whatever the number of pieces
    plan = F.broadcast(spark.createDataFrame(runs, schema))
    ranked = gapless_rank(pieces, ["length"], "rid", sum(hist.values()), "rk")
    j = ranked.join(plan, (F.col("length") == F.col("p_len")) & (F.col("rk") >= F.col("r_lo")) & (F.col("rk") < F.col("r_hi")))
    at = F.col("rk") - F.col("r_lo")
    return (j.withColumn("sequence_id", F.col("first") + F.floor(at / F.col("per")).cast("long"))
            .withColumn("offset", F.col("off") + (at % F.col("per")) * F.col("length"))
            .drop("p_len", "r_lo", "r_hi", "per", "first", "off", "rk", "rid"))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 4096) -> DataFrame:
    """Pack whole documents: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = staged(with_row_id(token_pieces(docs, tokenizer_path, capacity)), "pack-pieces")
    return pack(pieces, capacity)

"""Benchmark decontamination with a generalised suffix automaton.

The words of all benchmark items go into one generalised suffix automaton
(Blumer et al.).  Training documents stream through it word by word; the state
holds the longest suffix of the words read so far that occurs in some item.  A
matching length of at least ``window`` marks the last ``window`` words as hit;
items shorter than a window are hit where the whole item is matched.

The benchmark is cut into blocks of at most ``BLOCK_WORDS`` words (or one
longer item).  Tasks build one automaton per block and write it to the shared
folder; the driver hands on one block at a time as a broadcast.  Documents meet
the blocks one after another in a narrow map, their hits so far written in
between, so a worker holds one automaton however large the benchmark is, no
result is lost and documents are never shuffled.

Null texts have no words; empty items are no window; repeated items and
documents are judged one by one.  Items without id mark the words they hit and
count together as one item, which has no place in a list of item_ids.
"""

from __future__ import annotations

import pickle
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop_staged, free_name, staged

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLOCK_WORDS = 400_000
BYTES_PER_WORD = 8        # rough: sets how many tasks build automata, nothing else
BLOCKS_PER_TASK = 8


def words_of(text) -> list[bytes]:
    """A-Z lower-cased, then maximal runs of letters, digits and non-ASCII characters."""
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if isinstance(text, str) else []


class ItemAutomaton:
    """Generalised suffix automaton of word sequences.

    ``short`` lists for each state the items of fewer than ``window`` words
    that end a match there; ``full`` gives the items that hold the ``window``
    words behind a state."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        ends: list[set] = [set()]
        short: dict[int, set] = {}
        for item, words in items:
            if not words:
                continue
            last = 0
            for w in words:
                last = self._extend(last, self.ids.setdefault(w, len(self.ids)))
                while len(ends) < len(self.next):
                    ends.append(set())
                ends[last].add(item)
            if len(words) < window:
                short.setdefault(last, set()).add((item, len(words)))
        # items of a state: those of all states below it in the link tree
        for s in sorted(range(1, len(self.next)), key=self.len.__getitem__, reverse=True):
            if self.link[s] > 0 and self.len[self.link[s]] >= window:
                ends[self.link[s]] |= ends[s]
        self.full: dict[int, frozenset] = {}
        self.short: dict[int, tuple] = {}
        up = sorted(range(1, len(self.next)), key=self.len.__getitem__)
        for s in up:
            p = self.link[s]
            if self.len[s] >= window:
                # the state that holds exactly the last ``window`` words
                self.full[s] = self.full[p] if self.len[p] >= window else frozenset(ends[s])
            got = set(self.short.get(p, ())) | short.get(s, set())
            if got:
                self.short[s] = tuple(got)

    def _new(self, length, nxt, link):
        self.next.append(nxt)
        self.link.append(link)
        self.len.append(length)
        return len(self.next) - 1

    def _split(self, p, c, q):
        clone = self._new(self.len[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last, c):
        q = self.next[last].get(c)
        if q is not None:
            return q if self.len[q] == self.len[last] + 1 else self._split(last, c, q)
        cur = self._new(self.len[last] + 1, {}, 0)
        p = last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p != -1:
            q = self.next[p][c]
            self.link[cur] = q if self.len[q] == self.len[p] + 1 else self._split(p, c, q)
        return cur

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Hit spans (first word, end word), merged, and the items found."""
        nxt, link, length, window = self.next, self.link, self.len, self.window
        short, full = self.short, self.full
        get = self.ids.get
        spans: list[list[int]] = []
        items: set = set()
        s = n = 0
        root = nxt[0]
        for i, w in enumerate(words):
            c = get(w)
            if c is None:
                s = n = 0
                continue
            t = nxt[s].get(c) if s else root.get(c)
            if t is None:
                while s and c not in nxt[s]:
                    s = link[s]
                n = length[s]
                t = nxt[s].get(c)
                if t is None:
                    n = 0
                    continue
            s = t
            n += 1
            lo = i + 1
            if n >= window:
                lo = i + 1 - window
                items |= full[s]
            if s in short:
                for item, k in short[s]:
                    if k <= n:
                        items.add(item)
                        lo = min(lo, i + 1 - k)
            if lo <= i:
                while spans and spans[-1][0] >= lo:
                    spans.pop()
                if spans and spans[-1][1] >= lo:
                    spans[-1][1] = i + 1
                else:
                    spans.append([lo, i + 1])
        return [(a, b) for a, b in spans], items


def automata(batches, window: int, block_words: int):
    """Batches of (item_id, text) -> (seq, automaton): pickled automata of at most ``block_words`` words each."""
    def packed(seq, block):
        return pd.DataFrame({"seq": [seq], "automaton": [pickle.dumps(ItemAutomaton(block, window), pickle.HIGHEST_PROTOCOL)]})
    block, n, seq = [], 0, 0
    for pdf in batches:
        for item, text in zip(pdf["item_id"], pdf["text"]):
            words = words_of(text)
            if not words:
                continue
            if block and n + len(words) > block_words:
                yield packed(seq, block)
                block, n, seq = [], 0, seq + 1
            block.append((item, words))
            n += len(words)
    if block:
        yield packed(seq, block)


def item_blocks(benchmark: DataFrame, window: int, block_words: int = BLOCK_WORDS):
    """Yield one broadcast automaton per block of the benchmark; tasks build them, one task for about ``BLOCKS_PER_TASK``."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(1, -(-size // (block_words * BYTES_PER_WORD * BLOCKS_PER_TASK)))
    built = items.repartition(tasks).mapInPandas(lambda b: automata(b, window, block_words), "seq int, automaton binary")
    built = staged(built.withColumn("task", F.spark_partition_id()), "bench-automata")
    # names of the blocks: a few bytes for every BLOCK_WORDS words
    for r in built.select("task", "seq").orderBy("task", "seq").collect():
        one = built.filter((F.col("task") == r["task"]) & (F.col("seq") == r["seq"])).select("automaton").first()[0]
        yield spark.sparkContext.broadcast(pickle.loads(one))
    drop_staged(built)


HIT_TYPES = ("long", "array<struct<lo:int,hi:int>>", "array<string>")
HITS = ("n_words", "hit_spans", "item_ids")


def merge_spans(spans):
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = 10, columns=("doc_id",), text: str = "text", names=HITS) -> DataFrame:
    """``columns`` of docs with n_words, hit_spans (word positions) and item_ids (sorted as strings; a null for items without id).

    ``names`` are those of the three new columns, which ``columns`` must not hold."""
    own = [F.col(c) for c in columns] + ([] if text in columns else [F.col(text)])
    now, first = docs.select(*own), True
    blocks = iter(item_blocks(benchmark, window))
    shared = next(blocks, None)
    while True:
        after = next(blocks, None) if shared is not None else None
        last = after is None
        out = scan_block(now, shared, columns, text, names, first, last)
        if last:
            return out
        out = staged(out, "bench-hits")
        if not first:
            drop_staged(now)
        shared.unpersist()
        now, first, shared = out, False, after


def scan_block(src: DataFrame, shared, columns, text: str, names, first: bool, last: bool) -> DataFrame:
    """One pass of the documents over one automaton (none: no hits), added to the hits that ``src`` brings unless it is the ``first``."""
    keep = [f for f in src.schema.fields if f.name not in names and (f.name in columns or not last)]
    schema = T.StructType(keep + [T.StructField(n, T._parse_datatype_string(k)) for n, k in zip(names, HIT_TYPES)])

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        auto = shared.value if shared is not None else None
        for rb in batches:
            n_words, spans, found = [], [], []
            before = None if first else [rb.column(n).to_pylist() for n in names[1:]]
            for k, text_value in enumerate(rb.column(text).to_pylist()):
                words = words_of(text_value)
                got, ids = auto.scan(words) if auto else ([], set())
                if before:
                    got = merge_spans(got + [(x["lo"], x["hi"]) for x in before[0][k]])
                    ids = ids.union(before[1][k])
                n_words.append(len(words))
                spans.append([{"lo": a, "hi": z} for a, z in got])
                found.append(sorted(x for x in ids if x is not None) + [None] * (None in ids))
            cols = [rb.column(f.name).cast(arrow.field(f.name).type) for f in keep]
            cols += [pa.array(x, type=arrow.field(k).type) for k, x in zip(names, (n_words, spans, found))]
            yield pa.RecordBatch.from_arrays(cols, schema=arrow)
    return src.mapInArrow(run, schema)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Digest per document: n_words, n_hit, n_items, items_sha256, contaminated (and the spans)."""
    h = find_hits(docs, benchmark, window)
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + (s["hi"] - s["lo"]).cast("long"))
    return (h.withColumn("n_hit", hit)
            .select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                    F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated"), "hit_spans"))


def remove_hits(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_hit: int = 0,
                max_coverage: float = 0.5) -> DataFrame:
    """Documents without their hit spans; those covered above ``max_coverage`` go.

    A document with at most ``max_hit`` hit words is left as it is.  All input
    columns return; ``text`` loses the bytes from the first to the last word of
    each span, and ``n_chars``, if present, is the new length in characters."""
    names = tuple(free_name(docs.columns, f"_{n}") for n in HITS)
    h = find_hits(docs, benchmark, window, columns=tuple(docs.columns), names=names)
    n_hit = F.aggregate(names[1], F.lit(0), lambda a, s: a + s["hi"] - s["lo"])
    h = h.filter(n_hit <= F.greatest(F.lit(max_hit), F.col(names[0]) * F.lit(max_coverage)))
    cut = F.pandas_udf(cut_words, "string")
    out = h.withColumn("text", F.when(n_hit > max_hit, cut("text", names[1])).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(n_hit > max_hit, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def cut_words(texts: pd.Series, spans: pd.Series) -> pd.Series:
    """Remove word spans (positions by ``words_of``) from texts."""
    out = []
    for text, sp in zip(texts, spans):
        if not isinstance(text, str) or sp is None or len(sp) == 0:
            out.append(text)
            continue
        raw = text.encode("utf-8")
        at = [m.span() for m in WORD.finditer(raw.lower())]
        parts, pos = [], 0
        for s in sp:
            parts.append(raw[pos:at[s["lo"]][0]])
            pos = at[s["hi"] - 1][1]
        out.append(b"".join(parts + [raw[pos:]]).decode("utf-8"))
    return pd.Series(out, dtype=object)

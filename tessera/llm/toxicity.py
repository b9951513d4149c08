"""Toxicity with noisy-channel deobfuscation.

1. A character trigram model of the language is counted over all documents
   (27 symbols: a-z and "other"; one bounded count table, summed by Spark).
2. Words that look disguised - digits or signs among letters, letters spaced
   out, letters repeated three times or more - are read as a lattice: every
   character offers the letters it may stand for (leetspeak), or nothing
   (separators, repetitions), each at a channel cost.  Blanks of spaced-out
   runs and separators may also be word boundaries (symbol 0 of the model);
   words joined by signs are looked up by their parts, too.  Viterbi search finds the
   letters with the best channel x character model probability.
3. The restored text is scored.  Evidence of a word, or of its beginning, is
   the lower confidence bound of its log odds of label 1 (document counts over
   a bounded sample of labelled rows that are not held out).  Only evidence
   above everything that random labellings of the same texts produce counts;
   the strongest distinct words of the whole document add up on top of the
   prior log odds.

Null texts score as empty; null labels do not count; repeated labels of an id
count as the largest.  Without labels of both kinds every score is the
smoothed rate of label 1 (0.5 without any).
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ARROW_ROWS, free_name, held_out, release_caches, session_settings, staged

MAX_ROWS = 20_000       # labelled rows learned from at most (bounded training sample)
TOP_WORDS = 5           # strongest distinct words that count
CHANCE_DRAWS = 8        # random labellings that show what evidence chance gives
CACHE = 300_000

# What a sign may stand for in disguised words.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "{": "c", "€": "e", "£": "l", "¢": "c",
        "#": "h", "%": "x", "*": "aeiou"}
SEPARATORS = frozenset(".-_*~'`^/\\,:;|+= ")
COST_LEET, COST_DROP, COST_REPEAT, COST_KEEP_SIGN = 1.0, 1.0, 0.3, 9.0
BREAKS = (0.0, -2.0)    # channel costs of a word boundary between single characters; each gives a reading
PARTS = re.compile(r"[\W_]+")
SINGLES = re.compile(r"(?:(?<=\s)|\A)\S(?:[ \t]+\S[.,;:!?]?){2,}(?!\S)")

EDGE = ".,;:!?\"'()[]{}<>*#$%&~`^|/\\=_+-"
ODD = re.compile(r"[^\W\d_].*[\d@$!|+(<{€£¢#%*._~'`^/\\:-]+.*[^\W\d_]|[\d@$!|(€£][^\W\d_]{2}|[^\W\d_]{2}[\d@$!|(€£]|([^\W\d_])\1\1")
SIGNED = re.compile(r"[\"'(\[]*([$@!|][^\W\d_]\S*?|[^\W\d_]\S*?[$@]{1,2})[.,;:?!\"')\]]*(?<![$@]{3})")
SPACED = re.compile(r"(?<!\S)(?:[^\s.,;:!?]{1,2}[ \t]+){3,}[^\s]{1,2}(?!\S)")


def symbol(ch: str) -> int:
    return ord(ch) - 96 if "a" <= ch <= "z" else 0


def trigram_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """27 x 27 x 27 counts over all texts (word boundaries and foreign letters are symbol 0)."""
    table = np.zeros(256, "i4")
    for c in range(26):
        table[97 + c] = table[65 + c] = c + 1

    def count(batches):
        import pyarrow as pa
        release_caches()
        total = np.zeros(27 ** 3, "i8")
        for rb in batches:
            for t in rb.column(0).to_pylist():
                if t:
                    s = table[np.frombuffer(f"  {t} ".encode("utf-8"), "u1")]
                    total += np.bincount(s[:-2] * 729 + s[1:-1] * 27 + s[2:], minlength=27 ** 3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["g", "n"])
    counts = docs.select(F.col(text).cast("string")).mapInArrow(count, "g int, n long").groupBy("g").agg(F.sum("n").alias("n"))
    out = np.zeros(27 ** 3)
    with session_settings(docs.sparkSession, ARROW_ROWS):
        for r in counts.collect():     # at most 27 ** 3 rows
            out[r["g"]] = r["n"]
    return out.reshape(27, 27, 27)


def char_model(counts: np.ndarray) -> np.ndarray:
    """-log p(c | a, b), interpolated with bigrams and unigrams."""
    uni = (counts.sum((0, 1)) + 1) / (counts.sum() + 27)
    bi = (counts.sum(0) + 20 * uni) / (counts.sum(0).sum(1, keepdims=True) + 20)
    tri = (counts + 20 * bi[None]) / (counts.sum(2, keepdims=True) + 20)
    return -np.log(tri)


def lattice(word: str, split: bool = False, price: float = 0.0) -> list[list[tuple[str, float]]]:
    """For every character of a disguised word the readings (letter or nothing) and their channel cost.

    With ``split``, blanks and separators may be a word boundary, read as a blank: a blank
    between single characters at cost ``price``, one beside a longer token always."""
    out, prev = [], ""
    if split:
        tokens = word.lower().split()
        for k, token in enumerate(tokens):
            if k:
                out.append([(" ", price)] + ([("", 0.0)] if len(token.strip(EDGE)) < 2 and len(tokens[k - 1].strip(EDGE)) < 2 else []))
            for ch, options in zip(token, lattice(token)):
                out.append(options + [(" ", COST_DROP)] if ch in SEPARATORS else options)
        return out
    for ch in word.lower():
        if ch.isalpha():
            options = [(ch, 0.0)]
            if ch == prev:
                options.append(("", COST_REPEAT))
        else:
            options = [(c, COST_LEET) for c in LEET.get(ch, "")]
            if ch == prev:
                options.append(("", COST_REPEAT))
            elif ch in SEPARATORS:
                options.append(("", COST_DROP))
            elif not options or ch in "!|+(<{#%":
                options.append(("", COST_KEEP_SIGN if ch.isdigit() else COST_DROP + 1))
        out.append(options or [("", COST_KEEP_SIGN)])
        prev = ch
    return out


def restore(word: str, model: np.ndarray, split: bool = False, boundary: float = 0.0) -> str:
    """Most probable letters behind a disguised word (Viterbi over the lattice); with ``split``, words with blanks between."""
    # state: last two symbols -> (cost, back pointer as nested pairs)
    states = {(0, 0): (0.0, None)}
    for options in lattice(word, split, boundary):
        new: dict = {}
        for (a, b), (cost, back) in states.items():
            row = model[a, b]
            for letter, price in options:
                if letter:
                    c = symbol(letter)
                    # a word starts as a text does
                    key, total, trail = (0, 0) if letter == " " else (b, c), cost + price + row[c], (back, letter)
                else:
                    key, total, trail = (a, b), cost + price, back
                if key not in new or total < new[key][0]:
                    new[key] = (total, trail)
        states = new
    _, back = min(((cost + model[a, b, 0], back) for (a, b), (cost, back) in states.items()), key=lambda x: x[0])
    letters = []
    while back is not None:
        back, c = back
        letters.append(c)
    return "".join(reversed(letters))


class Reader:
    """Distinct restored words of a text, with a bounded cache of words."""

    def __init__(self, model: np.ndarray):
        self.model = model
        self.cache: dict[str, tuple[str, ...]] = {}

    def read(self, w: str) -> tuple[str, ...]:
        """Readings of a word: its parts between signs, its core without outer signs and,
        where signs at its edges may be letters (one or two of them), the core with them."""
        got = self.cache.get(w)
        if got is None:
            core = w.strip(EDGE).lower()
            got = (restore(core, self.model) if ODD.search(core) else core,)
            parts = [p for p in PARTS.split(core) if p]
            if len(parts) > 1:
                whole = restore(core, self.model, True).split() if ODD.search(core) else []
                got = (*(restore(p, self.model) if ODD.search(p) else p for p in parts if len(p) > 1), *whole, *got)
            m = SIGNED.fullmatch(w) if len(core) > 1 else None
            if m:
                got += (restore(m.group(1).lower(), self.model),)
            if len(self.cache) > CACHE:
                self.cache.clear()
            self.cache[w] = got
        return got

    def words(self, text: str) -> set[str]:
        found: set[str] = set()
        for w in set(text.split()):
            found.update(self.read(w))
        for m in SPACED.finditer(text):     # l e t t e r s spaced out
            found.update(self.spaced(m.group()))
        found.discard("")
        return found

    def spaced(self, run: str) -> set[str]:
        """Words of a run of short tokens: single characters joined, and the run with its likeliest word boundaries."""
        found: set[str] = set()
        for m in SINGLES.finditer(run):
            found.add(restore("".join(t[0] for t in m.group().split()), self.model))
        tokens = run.split()
        if sum(len(t) == 1 or not t[-1].isalnum() for t in tokens) >= len(tokens) - 1:
            found.add(restore("".join(t[0] for t in tokens), self.model))
        if found:
            for price in BREAKS:
                found.update(restore(run, self.model, True, price).split())
        return found

    def restored_text(self, text: str) -> str:
        """The text with disguised words replaced by their reading."""
        def spaced(m):
            tokens = m.group().split()
            if sum(len(t) == 1 or not t[-1].isalnum() for t in tokens) >= len(tokens) - 1:
                return restore("".join(t[0] for t in tokens), self.model)
            return m.group()
        text = SPACED.sub(spaced, text)
        return re.sub(r"\S+", lambda m: self.read(m.group())[-1] if ODD.search(m.group().strip(EDGE)) or SIGNED.fullmatch(m.group()) else m.group(), text)


def features(word: str) -> tuple[str, ...]:
    """The word and its beginnings of 4 to 6 letters (stems that endings follow)."""
    return (word, *(word[:n] + "*" for n in (4, 5, 6) if n < len(word)))


def evidence_table(docs: DataFrame, labels: DataFrame, reader_model: np.ndarray, label: str = "toxic", max_rows: int = MAX_ROWS):
    """(prior log odds or constant rate, {feature: evidence})."""
    y = (labels.filter(F.col(label).isNotNull() & ~held_out("doc_id")).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
         .withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(max_rows).drop("h"))
    n = {r["y"]: r["count"] for r in y.groupBy("y").count().collect()}
    pos, neg = n.get(1, 0), n.get(0, 0)
    if not pos or not neg:
        return None, (pos + 0.5) / (pos + neg + 1), {}
    known = docs.select("doc_id", F.col("text").cast("string")).join(F.broadcast(y), "doc_id")   # at most max_rows labels
    model = docs.sparkSession.sparkContext.broadcast(reader_model)
    names = ["n"] + [f"p{k}" for k in range(CHANCE_DRAWS + 1)]    # p0: label 1; p1..: random labels
    rate = pos / (pos + neg)

    def count(batches):
        release_caches()
        reader = Reader(model.value)
        for pdf in batches:
            seen: dict[str, np.ndarray] = {}
            for text, label_value in zip(pdf["text"], pdf["y"]):
                if isinstance(text, str):
                    draw = [(zlib.crc32(f"{k} {text}".encode()) / 2 ** 32) < rate for k in range(CHANCE_DRAWS)]
                    row = np.array([1, label_value, *draw], "i8")
                    for f in {f for w in reader.words(text) for f in features(w)}:
                        if f in seen:
                            seen[f] += row
                        else:
                            seen[f] = row.copy()
            m = np.array(list(seen.values())).reshape(-1, len(names))
            yield pd.DataFrame({"f": list(seen), **{c: m[:, i] for i, c in enumerate(names)}})
    c = known.select("text", "y").mapInPandas(count, "f string, " + ", ".join(f"{c} long" for c in names))
    c = c.groupBy("f").agg(*[F.sum(k).alias(k) for k in names])
    prior = float(np.log(pos / neg))

    def evidence(k):
        a, b = F.col(f"p{k}") + 0.5, F.col("n") - F.col(f"p{k}") + 0.5
        return F.when(F.col(f"p{k}") >= 2, F.log(a / b) - prior - 1.645 * F.sqrt(1 / a + 1 / b))
    c = staged(c.select("f", *[evidence(k).alias(f"e{k}") for k in range(CHANCE_DRAWS + 1)]).filter(
        F.greatest(*[F.coalesce(F.col(f"e{k}"), F.lit(0.0)) for k in range(CHANCE_DRAWS + 1)]) > 0), "toxic-evidence")
    chance = c.agg(F.max(F.greatest(*[F.coalesce(F.col(f"e{k}"), F.lit(0.0)) for k in range(1, CHANCE_DRAWS + 1)]))).first()[0] or 0.0
    # bounded: features of at most max_rows sampled documents
    return prior, None, {r["f"]: r["e0"] for r in c.filter(F.col("e0") > chance).select("f", "e0").collect()}


class Scorer:
    def __init__(self, model, prior, constant, evidence):
        self.reader, self.prior, self.constant, self.evidence = Reader(model), prior, constant, evidence

    def score(self, text) -> float:
        if self.constant is not None:
            return self.constant
        get = self.evidence.get
        found = []
        for w in self.reader.words(text or ""):
            e = max(get(f, 0.0) for f in features(w))
            if e:
                found.append(e)
        z = self.prior + sum(sorted(found)[-TOP_WORDS:])
        return float(1 / (1 + np.exp(-z)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_ROWS):
    """Broadcast (character model, prior, constant, evidence)."""
    model = char_model(trigram_counts(docs)).astype("f4")
    return docs.sparkSession.sparkContext.broadcast((model, *evidence_table(docs, labels, model, label, max_rows)))


def scored(docs: DataFrame, labels: DataFrame, columns=("doc_id",), score: str = "_score") -> DataFrame:
    """``columns`` of docs and ``score`` (a name that is not among them) in [0, 1]."""
    shared = fit(docs, labels)
    # the text crosses to Python once: as its column where that is kept as a string
    own = "text" in columns and docs.schema["text"].dataType.simpleString() == "string"
    source = "text" if own else free_name(columns, "_text")
    src = docs.select(*columns) if own else docs.select(*columns, F.col("text").cast("string").alias(source))
    fields = [f for f in src.schema.fields if own or f.name != source]
    kept = [f.name for f in fields]

    def run(batches):
        import pyarrow as pa
        release_caches()
        scorer = Scorer(*shared.value)
        for rb in batches:
            s = [scorer.score(t) for t in rb.column(source).to_pylist()]
            yield pa.RecordBatch.from_arrays([rb.column(c) for c in kept] + [pa.array(s, pa.float64())], names=kept + [score])
    from pyspark.sql import types as T
    return src.mapInArrow(run, T.StructType(fields + [T.StructField(score, T.DoubleType())]))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    out = scored(docs, labels)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), F.col("_score").alias("score"),
                      (F.col("_score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Documents scored below ``threshold``, with all their columns."""
    score = free_name(docs.columns, "_score")
    return scored(docs, labels, columns=tuple(docs.columns), score=score).filter(F.col(score) < threshold).drop(score)

"""Spelling variant grouping with a variable-length gram index.

Two words are near when they differ by one inserted, deleted or replaced code
point.  Near words are found without comparing all words:

1. *Gram dictionary.*  Grams of ``Q_MIN`` code points are extended to at most
   ``q_max`` where they are frequent.  The dictionary is pruned by frequency: only
   grams held by more than ``total / MAX_FREQUENT`` of all gram places are
   extended, so the set of extended grams is bounded whatever the vocabulary (it
   is broadcast); rarer grams end the extension and need not be listed.
2. *Decomposition.*  At each place of a word the gram grows until it is rare,
   ``q_max`` long or ends with the word.  What it is depends only on the code
   points it covers.
3. *Affected grams.*  One edit affects only grams that cover its place, so at
   most ``NAG(word)`` grams change, the most that cover one code point.  Near
   words share at least ``grams(word) - NAG(word)`` grams at places that
   correspond, and this is at least 1 for ``q_max = min_chars - 2``.
4. *List merging.*  By that bound a word needs only its ``NAG + 1`` rarest grams:
   near words share one of them.  A list is named by gram, word length and place;
   a word looks into the lists of its own length and, for an insertion, of the
   words one shorter (place unchanged left of the edit, one less right of it).
5. *Verify.*  Merged candidates are checked by edit distance.

Each word then points to its near word of largest count if that count is
``ratio`` times its own; following the pointers (doubling, at most
log(largest count) / log(ratio) steps deep) gives its root.

Null texts hold no words.  Word counts are exact; no list is cut, and AQE splits
lists that are long.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_staged, staged

RUN = re.compile(rb"[A-Za-z\xC0-\xFF]+")
Q_MIN = 2
MAX_FREQUENT = 65_536        # bounds the broadcast dictionary: at most (q_max - 1) times as many grams
LEAST_FREQUENT = 8           # grams of fewer places are never extended
FLUSH = 200_000              # distinct words a task counts before it sends them on


def runs_of(text: str | None) -> list[bytes]:
    """Letter runs, A-Z lower-cased, in Latin-1 (characters beyond it part runs)."""
    return RUN.findall(text.encode("latin-1", "replace").lower()) if text else []


def unchanged(prefix: int, run: bytes) -> bytes:
    return run


def count_words(docs: DataFrame, min_chars: int, min_count: int, alter=unchanged, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of all words of at least ``min_chars`` code points and ``min_count`` occurrences.

    ``alter(crc, run)`` may change a run of a document; ``crc`` is the crc32 of
    ``<doc_id>:``, which a crc32 of the run can go on from."""
    src = docs.select(F.col(doc_id).cast("string").alias("doc"), F.col(text).cast("string").alias("text"))

    def run(batches):
        import pyarrow as pa

        def out(counts):
            words = list(counts)
            return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in words], pa.string()),
                                               pa.array([counts[w] for w in words], pa.int64())], names=["word", "n"])
        counts: Counter = Counter()
        for rb in batches:
            for doc, t in zip(rb.column("doc").to_pylist(), rb.column("text").to_pylist()):
                crc = None if doc is None else zlib.crc32(doc.encode() + b":")
                for w, n in Counter(runs_of(t)).items():
                    if crc is not None:
                        w = alter(crc, w)
                    if len(w) >= min_chars:
                        counts[w] += n
            if len(counts) > FLUSH:
                yield out(counts)
                counts.clear()
        yield out(counts)

    return src.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


# ------------------------------------------------------------------ gram index

def frequent_grams(words: DataFrame, q_max: int, max_frequent: int = MAX_FREQUENT, least: int = LEAST_FREQUENT) -> dict[str, int]:
    """Grams of Q_MIN..q_max code points that more than ``total / max_frequent`` places hold, with their counts.

    Counted over all words; at most (q_max - Q_MIN + 1) * max_frequent grams reach the driver."""
    grams = None
    for q in range(Q_MIN, q_max + 1):
        places = F.when(F.length("word") >= q, F.sequence(F.lit(1), F.length("word") - (q - 1)))
        one = words.select(F.explode(F.transform(places, lambda p: F.substring("word", p, q))).alias("gram"))
        grams = one if grams is None else grams.union(one)
    total = words.agg(F.sum(F.length("word") - 1)).first()[0] or 0
    floor = max(least, total // max_frequent)
    counted = grams.groupBy("gram").count().filter(F.col("count") > floor)
    return {r["gram"]: r["count"] for r in counted.toLocalIterator()}


def decompose(word: str, frequent: dict[str, int], q_max: int) -> list[str]:
    """The gram of each place but the last: grown while frequent, up to q_max or the word's end."""
    n = len(word)
    out = []
    for p in range(n - 1):
        e = p + Q_MIN
        while e < n and e - p < q_max and word[p:e] in frequent:
            e += 1
        out.append(word[p:e])
    return out


def affected(grams: list[str]) -> int:
    """NAG: the most grams one edit can change.

    Replacing or deleting a code point changes grams that cover it.  An insertion changes
    grams around it, or, at the end, grams that ended with the word: fewer than cover a neighbour."""
    cover = [0] * (len(grams) + 1)
    for p, g in enumerate(grams):
        for i in range(p, p + len(g)):
            cover[i] += 1
    return max(cover)


def chosen(word: str, frequent: dict[str, int], q_max: int) -> list[tuple[int, str]]:
    """(place, gram) of the NAG + 1 rarest grams.

    All words order grams alike: by count, grams below the dictionary's bound first,
    then by the gram, then by place."""
    grams = decompose(word, frequent, q_max)
    order = sorted(range(len(grams)), key=lambda p: (frequent.get(grams[p], 0), grams[p], p))
    return [(p, grams[p]) for p in order[:affected(grams) + 1]]


LISTS = "id long, word string, chars int, place int, gram string"


def gram_lists(words: DataFrame, frequent: dict[str, int], q_max: int) -> DataFrame:
    """One row per word and chosen gram."""
    shared = words.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        import pyarrow as pa
        for rb in batches:
            freq = shared.value
            rows = [(i, w, len(w), p, g) for i, w in zip(rb.column("id").to_pylist(), rb.column("word").to_pylist())
                    for p, g in chosen(w, freq, q_max)]
            cols = list(zip(*rows)) or [[], [], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string()))],
                                             names=["id", "word", "chars", "place", "gram"])

    return words.select("id", "word").mapInArrow(run, LISTS)


def near_pairs(words: DataFrame, q_max: int, max_frequent: int = MAX_FREQUENT) -> DataFrame:
    """(a, b): ids of words that differ by one edit, each pair once.

    ``words`` has id (unique, fixed) and word."""
    lists = staged(gram_lists(words, frequent_grams(words, q_max, max_frequent), q_max), "gram-lists")
    held = lists.select(F.xxhash64("gram", "chars", "place").alias("list"), F.col("id").alias("b"), F.col("word").alias("word_b"))
    # lists a word looks into: its own length; one shorter, left and right of the edit
    looks = F.array(F.struct(F.col("chars").alias("chars"), F.col("place").alias("place")),
                    F.struct((F.col("chars") - 1).alias("chars"), F.col("place").alias("place")),
                    F.struct((F.col("chars") - 1).alias("chars"), (F.col("place") - 1).alias("place")))
    asks = (lists.select("id", "word", "gram", F.col("chars").alias("c"), F.explode(looks).alias("at"))
            .select(F.xxhash64("gram", "at.chars", "at.place").alias("list"), F.col("id").alias("a"), F.col("word").alias("word_a")))
    # hashes name lists; the verification below is exact
    longer = F.length("word_a") - F.length("word_b")
    merged = asks.join(held, "list").filter((longer == 1) | ((longer == 0) & (F.col("a") < F.col("b"))))
    near = merged.filter(F.levenshtein("word_a", "word_b", 1) == 1)
    return near.select("a", "b").distinct()


# ------------------------------------------------------------------ forms and roots

def follow(forms: DataFrame) -> DataFrame:
    """(id, root) of every row of (id, form): the pointer followed to its end (pointer doubling)."""
    now = staged(forms.select("id", F.coalesce("form", "id").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("id").alias("root"), F.col("root").alias("next"))
        new = staged(now.join(ahead, "root").select("id", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "spelling-roots")
        drop_staged(now)
        now = new
        if not now.filter("moved").limit(1).count():
            return now.select("id", "root")


def group_variants(counts: DataFrame, min_chars: int = 6, ratio: int = 5, max_frequent: int = MAX_FREQUENT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of ``counts`` (word, n: words distinct, n above 0).

    All words must have at least ``min_chars`` (4 or more) code points."""
    if min_chars < 4:
        raise ValueError("grams can be told from their edits only in words of at least 4 code points")
    words = staged(counts.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "spelling-words")
    pairs = staged(near_pairs(words, min_chars - 2, max_frequent), "spelling-pairs")
    both = pairs.select(F.col("a").alias("id"), F.col("b").alias("other")).union(pairs.select(F.col("b").alias("id"), F.col("a").alias("other")))
    other = words.select(F.col("id").alias("other"), F.col("word").alias("w"), F.col("n").alias("m"))
    # smallest of (-n, word): the near word of largest count, ties to the first in code-point order
    best = (both.join(other, "other").groupBy("id")
            .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), F.col("w").alias("w"), F.col("other").alias("other"))).alias("top")))
    rows = words.join(best, "id", "left")
    has = F.coalesce(-F.col("top.m") >= ratio * F.col("n"), F.lit(False))
    formed = staged(rows.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                F.when(has, F.col("top.w")).alias("form"), F.when(has, F.col("top.other")).alias("to"), F.when(has, -F.col("top.m")).alias("form_n")), "spelling-forms")
    # only words with a form, and the forms themselves, take part in following
    linked = formed.filter("to is not null").select("id", F.col("to").alias("form"))
    ends = linked.select(F.col("form").alias("id")).distinct().join(linked.select("id"), "id", "left_anti").select("id", F.lit(None).cast("long").alias("form"))
    roots = follow(linked.union(ends)).join(words.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root").select("id", "root_word")
    return (formed.join(roots, "id", "left")
            .select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"))


def delete_by_crc(divisor: int):
    """Alter a run whose crc32 of ``<doc_id>:<run>`` is divisible: it loses the code point crc32 % length.

    The crc32 is that of UTF-8, the run itself is Latin-1."""
    def alter(crc: int, run: bytes) -> bytes:
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), crc)
        if h % divisor:
            return run
        at = h % len(run)
        return run[:at] + run[at + 1:]
    return alter


def variants_of_documents(docs: DataFrame, min_chars: int = 6, min_count: int = 5, ratio: int = 5, alter=unchanged) -> DataFrame:
    """Spelling variants among the words of whole texts."""
    return group_variants(count_words(docs, min_chars, min_count, alter), min_chars, ratio)

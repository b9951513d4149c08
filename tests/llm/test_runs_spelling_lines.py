"""Periodic runs, spelling variants and line dedup against brute force, and their edge rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from tessera.llm import line_dedup, periodic_runs, spelling
from tessera.llm import queries as corpus
from tessera.llm.periodic_runs import SquareCatcher, level_distances, mixed, runs_of_streams

DOC = "doc_id long, text string, lang string, n_words long, keep string, doc string, tag string, h1 string, word string, n string, id string, _text string"
EDGE = [None, "", "   ", "one", "a b c", "a\n\nb", "\n", "é ü ß × ÷", "x" * 5000, "w " * 3000]


def docs_of(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, "en", *[7], *["z"] * 8) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC)


# ------------------------------------------------------------------ op11

def brute_runs(w, m=12):
    n, out = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i - s >= q and i - s + q >= m:
                out.setdefault((s, i + q), q)
    return sorted((a, e - a, p) for (a, e), p in out.items())


def random_docs(g):
    docs = []
    for _ in range(g.randrange(1, 7)):
        n, k = g.randrange(0, g.choice([10, 40, 150, 400])), g.choice([1, 2, 3, 5, 50])
        w = [g.randrange(k) for _ in range(n)]
        if n and g.random() < .5:
            a = g.randrange(n)
            p = 1 + (n - a) // (3 + g.randrange(8))
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        docs.append(w)
    return docs


def hashed(w):
    return mixed(np.array(w, "u8") + np.uint64(77)) if w else np.empty(0, "u8")


@pytest.mark.parametrize("seed", range(60))
def test_runs_match_brute_force_however_words_are_appended(seed):
    g = random.Random(seed)
    docs, m = random_docs(g), g.choice([12, 12, 2, 5, 30])
    want = [brute_runs(w, m) for w in docs]
    for at_once in (1 << 16, 64, 7, 1):
        assert runs_of_streams([hashed(w) for w in docs], m, at_once) == want


def test_every_distance_has_a_block_its_runs_must_hold():
    for m in (2, 5, 12, 30):
        rows = level_distances(m, 500)
        assert [q for _, a, z in rows for q in range(a, z + 1)] == list(range(1, 251))
        for b, a, z in rows:
            assert all(2 * b - 1 <= max(m - q, q) for q in range(a, z + 1))


def test_a_run_is_reported_once_with_its_smallest_period():
    c = SquareCatcher(12, 1000)
    for w in [1] * 40 + [2, 3] * 20 + list(range(10, 30)):
        c.append(hashed([w]))
    assert c.end() == [(0, 40, 1), (40, 40, 2)]


def planted_words(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def run_row(doc_id, words):
    runs = brute_runs(words)
    keep = [True] * len(words)
    for s, n, p in runs:
        keep[s + p:s + n] = [False] * (n - p)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (doc_id, len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
            hashlib.sha256("".join(f"{a},{n},{p}\n" for a, n, p in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for w, k in zip(words, keep) if k).encode()).hexdigest())


def test_op11_query_against_brute_force(spark, tmp_path):
    g = random.Random(4)
    texts = EDGE + [" \t".join(f"w{x}" for x in w) for _ in range(40) for w in random_docs(g)]
    ids = list(range(len(texts)))
    ids[12], ids[13] = None, ids[14]
    docs_of(spark, texts, ids).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(repr, (tuple(r) for r in corpus.QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect())))
    split = [[] if t is None else [w.decode() for w in periodic_runs.WORDS.findall(t.encode())] for t in texts]
    assert got == sorted(repr(run_row(i, planted_words(i, w))) for i, w in zip(ids, split))


def test_find_runs_keeps_columns_and_refuses_clashes(spark):
    docs = docs_of(spark, EDGE).drop("n_words")
    out = periodic_runs.find_runs(docs, columns=docs.columns).collect()
    assert len(out) == len(EDGE) and out[-1]["runs"][0].asDict() == {"start": 0, "length": 3000, "period": 1}
    assert out[-1]["collapsed"] == "w" and out[0]["collapsed"] == "" and out[0]["_text"] == "z"
    with pytest.raises(ValueError):
        periodic_runs.find_runs(docs_of(spark, EDGE), columns=["n_words"])
    assert periodic_runs.find_runs(docs_of(spark, [])).count() == 0


# ------------------------------------------------------------------ op12

def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(counts, ratio=5):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        top = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = top if top is not None and counts[top] >= ratio * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(map(repr, out))


def variant_words(g, n, alphabet):
    words = {"".join(g.choice(alphabet) for _ in range(g.randrange(6, 11))) for _ in range(n)}
    for w in list(words):
        i = g.randrange(len(w))
        words |= {w[:i] + w[i + 1:], w[:i] + g.choice(alphabet) + w[i:], w[:i] + g.choice(alphabet) + w[i + 1:], w + g.choice(alphabet)}
    return [w for w in words if len(w) >= 6]


@pytest.mark.parametrize("alphabet", ["ab", "abcé", "abcdefghijklmnop"])
def test_chosen_grams_of_near_words_meet(alphabet):
    g = random.Random(len(alphabet))
    words = variant_words(g, 60, alphabet)
    grams = Counter(w[p:p + q] for w in words for q in (2, 3, 4) for p in range(len(w) - q + 1))
    frequent = {x: n for x, n in grams.items() if n > 12}
    lists = {w: spelling.chosen(w, frequent, 4) for w in words}
    for w in words:
        assert len(lists[w]) == spelling.affected(spelling.decompose(w, frequent, 4)) + 1 <= len(w) - 1
        for v in words:
            if one_edit(w, v) and len(w) >= len(v):
                shift = len(w) - len(v)
                assert any(a == b and (p == r or p == r + shift) for p, a in lists[w] for r, b in lists[v]), (w, v)


@pytest.mark.parametrize("alphabet,max_frequent", [("abc", 65_536), ("abc", 20), ("abcdefghé", 200)])
def test_variants_match_brute_force(spark, alphabet, max_frequent):
    g = random.Random(7)
    counts = {w: g.choice([5, 6, 9, 30, 200, 2000]) for w in variant_words(g, 50, alphabet)}
    got = spelling.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long"), max_frequent=max_frequent).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute_variants(counts)


def test_op12_query_against_brute_force(spark, tmp_path):
    g = random.Random(3)
    pool = variant_words(g, 12, "abcdé")
    texts = EDGE + [" ".join(g.choice(pool[: 1 + int(len(pool) * g.random() ** 2)]).capitalize() + g.choice(["", ",", "1", "-Σ"]) for _ in range(120)) for _ in range(40)]
    ids = list(range(len(texts)))
    ids[12], ids[13] = None, ids[14]
    docs_of(spark, texts, ids).write.parquet(f"{tmp_path}/documents.parquet")
    counts = Counter()
    alter = spelling.delete_by_crc(199)
    for i, t in zip(ids, texts):
        for w in spelling.runs_of(t):
            counts[w if i is None else alter(zlib.crc32(f"{i}:".encode()), w)] += 1
    counts = {w.decode("latin-1"): n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    got = corpus.QUERIES["op12_spelling_variants"](spark, str(tmp_path)).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute_variants(counts)
    assert any(r["form"] for r in got)


def test_the_deleted_letter_follows_the_rule():
    alter = spelling.delete_by_crc(3)
    for run in (b"letter", "éàçèùô".encode("latin-1")):
        h = zlib.crc32(f"12:{run.decode('latin-1')}".encode())
        got = alter(zlib.crc32(b"12:"), run)
        assert got == (run if h % 3 else run[:h % 6] + run[h % 6 + 1:])


def test_variants_of_no_words(spark):
    assert spelling.variants_of_documents(docs_of(spark, [])).count() == 0
    assert spelling.variants_of_documents(docs_of(spark, EDGE)).count() == 0
    with pytest.raises(ValueError):
        spelling.group_variants(spark.createDataFrame([], "word string, n long"), min_chars=3)


# ------------------------------------------------------------------ op13

def brute_lines(rows, min_chars=20, min_docs=3):
    held = defaultdict(set)
    for i, t in rows:
        for _, k in line_dedup.line_keys(t, min_chars):
            held[k].add(line_dedup.NO_DOC if i is None else i)
    out = []
    for i, t in rows:
        me = line_dedup.NO_DOC if i is None else i
        lost = {p for p, k in line_dedup.line_keys(t, min_chars) if len(held[k]) >= min_docs and max(held[k]) != me}
        lines = (t or "").split("\n")
        kept = "\n".join(x for j, x in enumerate(lines) if j not in lost)
        out.append((i, len(lines), len(lost), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(map(repr, out))


def test_op13_query_against_brute_force(spark, tmp_path):
    g = random.Random(5)
    pool = [f" line number {k} of the pool, Ééé" + "\t" * (k % 3) for k in range(30)] + ["short", "", "   ", "Ü" * 19, "ü" * 20]
    texts = EDGE + ["\n".join(g.choice([x, x.upper() if x.isascii() else x, x + "\r"]) for x in g.choices(pool, k=g.randrange(1, 40))) for _ in range(150)]
    texts += [texts[20]] * 4 + ["the hot line of a third of all rows\n" * 50] * 80
    ids = [g.choice([k, k, k % 7, None]) for k in range(len(texts))]
    docs_of(spark, texts, ids).repartition(7).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus.QUERIES["op13_line_dedup"](spark, str(tmp_path)).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute_lines(list(zip(ids, texts)))
    assert sum(r["n_dropped"] for r in got) > 1000


@pytest.mark.parametrize("seed", range(12))
def test_the_stream_settles_hashes_that_cross_batches_and_partitions(seed):
    g = random.Random(seed)
    rows = pd.DataFrame(sorted((g.randrange(6), 0, -g.randrange(g.choice([2, 9])), 0, p) for p in range(120)), columns=["h1", "h2", "doc", "tag", "pos"])
    rows["doc"] = -rows["doc"]
    got, cut = [], sorted(g.sample(range(120), 4))
    for part in (rows.iloc[a:b] for a, b in zip([0, *cut], [*cut, 120])):      # partitions, each in batches
        stream = line_dedup.HashStream(3)
        for s in range(0, len(part), 7):
            got += list(stream.feed(part.iloc[s:s + 7]))
        got += list(stream.end())
    out = pd.concat(got)
    seen = out[out.kind == line_dedup.SEEN].groupby("h1")["doc"].unique()
    assert (out.kind == line_dedup.SEEN).sum() <= 2 * 5 * 3
    lost = set(out[out.kind == line_dedup.DROP].pos)
    for _, r in out[out.kind == line_dedup.OPEN].iterrows():
        tops = sorted(seen[r.h1], reverse=True)
        if len(tops) >= 3 and r.doc != tops[0]:
            lost.add(r.pos)
    holders = rows.groupby("h1")["doc"].agg(["nunique", "max"])
    assert lost == {r.pos for r in rows.itertuples() if holders["nunique"][r.h1] >= 3 and r.doc != holders["max"][r.h1]}


def test_bitmaps_round_trip():
    g = random.Random(1)
    for n in (1, 7, 8, 9, 1000):
        lost = np.array(sorted(g.sample(range(n), g.randrange(1, n + 1))))
        keep = line_dedup.unpack_bits(line_dedup.pack_bits(lost), n)
        assert list(np.flatnonzero(~keep)) == list(lost)
    assert line_dedup.unpack_bits(None, 3).all() and line_dedup.kept_lines("a\nb", line_dedup.pack_bits(np.array([0]))) == "b"


def test_lines_of_no_documents(spark):
    assert line_dedup.line_digest(docs_of(spark, [])).count() == 0

"""Operator kernels against hand-worked or brute-force answers (no Spark)."""

import itertools
import random
import zlib

import numpy as np
import pytest

from tessera.llm import decontaminate, html_render, ngram_join, packing, sharding, shingles, substring_dedup, topk, toxicity
from tessera.llm.quality_cnn import ByteCNN


# ------------------------------------------------------------------ op1

def brute_moved(old, cap):
    """Least bytes moved: everything beyond what a shard can keep."""
    return sum(max(0, s - (cap[o] if o < len(cap) else 0)) for o, s in old.items())


@pytest.mark.parametrize("seed", range(8))
def test_flow_moves_the_fewest_bytes(seed):
    g = random.Random(seed)
    old = {i: g.randrange(0, 500) for i in range(g.randrange(1, 9))}
    cap = sharding.equal_capacities(sum(old.values()), g.randrange(1, 9))
    blocks = sharding.plan_transfers(old, cap)
    size = {b: 0 for b in range(len(cap))}
    moved = 0
    for o, j, lo, hi in blocks:
        n = min(hi, old[o]) - lo
        size[j] += n
        moved += n * (o != j)
    assert [size[j] for j in range(len(cap))] == cap
    assert moved == brute_moved(old, cap)


def test_flow_respects_arc_costs():
    flow = sharding.min_cost_flow([5, 5], [5, 5], lambda i, j: [[3, 1], [1, 9]][i][j])
    assert flow == {(0, 1): 5, (1, 0): 5}
    with pytest.raises(ValueError):
        sharding.min_cost_flow([5], [4], lambda i, j: 0)


# ------------------------------------------------------------------ op2

def jaccard(a, b):
    a, b = set(a.tolist()), set(b.tolist())
    return len(a & b) / len(a | b) if a | b else 0.0


def test_shingle_sets():
    w = shingles.word_hashes
    assert len(shingles.shingle_set(w(""))) == 0 and len(shingles.shingle_set(w(None))) == 0
    assert len(shingles.shingle_set(w("a b c"))) == 1
    assert shingles.shingle_set(w("A b\tC")).tolist() == shingles.shingle_set(w("a  B c")).tolist()
    assert shingles.shingle_set(w("a b c")).tolist() != shingles.shingle_set(w("a b")).tolist()
    assert len(shingles.shingle_set(w("a a a a a a a"))) == 1
    assert len(shingles.shingle_set(w("a b c d e f g"))) == 3
    assert w("x y").shape == (1,) and w("É").tolist() != w("é").tolist()


def test_block_comparison_matches_brute_force():
    g = np.random.default_rng(1)
    base = g.integers(0, 60, 40)
    sets = [np.unique(np.where(g.random(40) < 0.06, g.integers(60, 99, 40), base)) for _ in range(25)] + [np.unique(g.integers(0, 99, 9)) for _ in range(9)]
    ids = np.arange(len(sets))
    link = ngram_join._compare(ids, sets, ids, sets, True, 80, 100)
    want = np.array([[i < j and jaccard(a, b) >= 0.8 for j, b in enumerate(sets)] for i, a in enumerate(sets)])
    assert (link == want).all() and want.sum() > 10
    cross = ngram_join._compare(ids[:20], sets[:20], ids[20:], sets[20:], False, 80, 100)
    assert (cross == want[:20, 20:]).all()


# ------------------------------------------------------------------ op3

@pytest.mark.parametrize("seed", range(6))
def test_compact_windows_are_cartesian_tree_nodes(seed):
    g = np.random.default_rng(seed)
    t = int(g.integers(2, 9))
    texts = [g.integers(1, 1 << 62, int(n)).astype("u8") for n in g.integers(0, 60, 5)]
    text, h, sig, c, lo, hi = substring_dedup.compact_windows(texts, t)
    low = (1 << 28) - 1
    for i, s in enumerate(texts):
        for k in range(substring_dedup.HASHES):
            v = [int(x) & ~low for x in shingles.mix(s ^ substring_dedup.SEEDS[k])]
            want = {}
            for a in range(len(s) - t + 1):
                m = min(range(a, a + t), key=lambda p: (v[p], p))
                want.setdefault(m, []).append(a)
            on = (text == i) & (h == k)
            got = {int(p): (int(a), int(b)) for p, a, b in zip(c[on], lo[on], hi[on])}
            assert got == {m: (min(x), max(x)) for m, x in want.items()}


def test_match_finds_exact_and_edited_passages():
    words = [f"w{i}" for i in range(400)]
    other = [f"o{i}" for i in range(300)]
    a = other[:60] + words[100:160] + other[60:130]
    edited = list(words)
    edited[130] = "changed"
    sh = lambda x: shingles.shingle_hashes(shingles.word_hashes(" ".join(x)))
    got = substring_dedup.match(sh(a), sh(words), [60 - 100], 46)
    assert got == [(60, 116, 100)]
    assert substring_dedup.match(sh(a), sh(other), [0], 46) == [(0, 56, 0)]
    assert substring_dedup.match(sh(a[60:110]), sh(words), [-100], 46) == [(0, 46, 100)]
    near = substring_dedup.match(sh(a), sh(edited), [-40], 46)
    assert near and near[0][0] <= 61 and near[0][1] >= 110
    assert substring_dedup.match(sh(a), sh(list(reversed(words))), [-40, 0, 7], 46) == []


# ------------------------------------------------------------------ op4

def test_block_search_is_exact_with_ties():
    g = np.random.default_rng(3)
    m = g.integers(-3, 4, (300, 6)).astype(float)
    ids = np.arange(300) * 2
    blocks = []
    for part in np.array_split(np.arange(300), 13):
        blocks.append({"ids": ids[part].astype("<i8").tobytes(), "rids": part.astype("<i8").tobytes(), "mat": m[part].tobytes(),
                       "hi": m[part].max(0).tobytes(), "lo": m[part].min(0).tobytes()})
    q = np.arange(0, 300, 10)
    best = topk._Best(len(q), 7, np.full(len(q), -np.inf))
    scored = topk.search_blocks(blocks, m[q], q, best, 6)
    for k, r in enumerate(q):
        s = m @ m[r]
        want = sorted((-s[j], ids[j]) for j in range(300) if j != r)[:7]
        on = best.q == k
        assert sorted(zip(-best.s[on], best.v[on])) == want
    assert scored <= len(q) * len(blocks)


# ------------------------------------------------------------------ op5

def test_network_learns_and_pools_the_whole_text():
    good, bad = b"plain words follow one another here. ", b"### $$$ &&& %%% "
    texts = [good * n for n in range(1, 20)] + [good * n + bad * 3 + good * n for n in range(1, 20)]
    net = ByteCNN().fit(texts, [1] * 19 + [0] * 19)
    s = net.score(texts)
    assert s[:19].min() > s[19:].max()
    assert net.score([good * 4000 + bad * 30])[0] < net.score([good * 4000])[0]     # the end of a long text counts
    assert np.allclose(net.score(texts), [net.score([t])[0] for t in texts], atol=1e-5)
    assert 0 <= net.score([b""])[0] <= 1
    assert ByteCNN().fit([b"x"], [1]).score([b"y", b""]).tolist() == [0.75, 0.75]
    assert ByteCNN().fit([], []).score([b"y"]).tolist() == [0.5]


def test_gradients_match_finite_differences():
    net = ByteCNN(seed=5)
    texts, y = [b"abc def ghi " * 9, b"xyz !!! " * 20, b"q"], np.array([1, 0, 1], "f4")
    for p in net.PARAMS:
        setattr(net, p, getattr(net, p).astype("f8"))

    def loss():
        s = np.clip(net.score(texts), 1e-12, 1 - 1e-12)
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))
    got = net.gradients(texts, y)
    for p, at in (("w", 3), ("b", 0), ("kb", 5), ("k", (17, 2)), ("emb", (97, 1))):
        a = getattr(net, p)
        keep = a[at]
        a[at] = keep + 1e-3
        up = loss()
        a[at] = keep - 1e-3
        down = loss()
        a[at] = keep
        assert abs((up - down) / 2e-3 - np.asarray(got[p])[at]) < 2e-3, p


# ------------------------------------------------------------------ op6

def brute_hits(words, items, window):
    hit, found = set(), set()
    for item, w in items:
        n = min(window, len(w))
        if not n:
            continue
        grams = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}
        for i in range(len(words) - n + 1):
            if tuple(words[i:i + n]) in grams:
                found.add(item)
                hit.update(range(i, i + n))
    return hit, found


@pytest.mark.parametrize("seed", range(40))
def test_automaton_matches_brute_force(seed):
    g = random.Random(seed)
    abc = [bytes([97 + i]) for i in range(g.randrange(2, 5))]
    window = g.randrange(2, 5)
    items = [(k, [g.choice(abc) for _ in range(g.randrange(0, 9))]) for k in range(g.randrange(1, 6))]
    auto = decontaminate.ItemAutomaton(items, window)
    for _ in range(10):
        words = [g.choice(abc + [b"zz"]) for _ in range(g.randrange(0, 25))]
        spans, found = auto.scan(words)
        hit, want = brute_hits(words, items, window)
        assert {p for a, b in spans for p in range(a, b)} == hit and found == want
        assert all(x[1] < y[0] for x, y in itertools.pairwise(spans))


def test_words_rule():
    assert decontaminate.words_of("Ab-c É9 x_y") == [b"ab", b"c", "É9".encode(), b"x", b"y"]
    assert decontaminate.words_of(None) == [] and decontaminate.words_of("... !") == []


# ------------------------------------------------------------------ op7

@pytest.mark.parametrize("seed", range(12))
def test_packing_is_gapless_and_tight(seed):
    g = random.Random(seed)
    cap = g.choice([10, 64, 4096])
    counts = {}
    for _ in range(g.randrange(1, 400)):
        n = g.randrange(1, cap + 1) if g.random() < 0.5 else g.randrange(1, max(2, cap // 6))
        counts[n] = counts.get(n, 0) + g.choice([1, 1, 7])
    runs, bins = packing.plan_packing(dict(counts), cap)
    content, placed = {}, {}
    for n, lo, hi, per, first, off in runs:
        assert lo == placed.get(n, 0)
        placed[n] = hi
        for r in range(hi - lo):
            content.setdefault(first + r // per, []).append((off + r % per * n, n))
    assert placed == counts and len(content) == bins
    for items in content.values():
        at = 0
        for off, n in sorted(items):
            assert off == at
            at += n
        assert at <= cap
    total = sum(n * c for n, c in counts.items())
    large = sum(c for n, c in counts.items() if 2 * n > cap)
    assert bins <= 1.25 * max(-(-total // cap), large) + 2


def test_tokenizer_lets_go_of_a_batch_in_steps():
    """Pipeline, memory: the words of a batch stayed beside the arrays of their ids (102 bytes a word at the peak)."""
    import tracemalloc
    w = packing.WordTokenizer(packing.public_vocabulary("word_bpe_49k.json"))
    texts = [" ".join(f"word{chr(97 + (i * j) % 26)}" for j in range(1000)) for i in range(100)]
    w.encode_all(texts[:30])
    tracemalloc.start()
    try:
        got = w.encode_all(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 75 * 100_000
    assert got[7] == w._ids([texts[7]])[0] and w.encode_all([None, ""]) == [b"", b""] and w.encode_all([]) == []


def test_word_tokenizer_equals_the_tokenizer():
    path = packing.public_vocabulary("word_bpe_49k.json")
    w = packing.WordTokenizer(path)
    texts = ["", " a  b ", "It's don't 12 345!! \u0085x", "é ́x", "<|endoftext|> a<|startoftext|>b", "a\x1cb", "İstanbul ΣΑΣ ß",
             "​z a​b", "日本 語", "ÀÉÖØÞßÿ× ª º A_B x² [x](y) --", "a\x00b", "word " * 50 + "end."]
    for t, ids in zip(texts, w.encode_all(texts)):
        assert ids == np.asarray(w.tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t
    assert w.encode_all([None]) == [b""]


# ------------------------------------------------------------------ op8

@pytest.fixture(scope="module")
def char_model():
    words = "the idiot and a stupid loser of pathetic trash is worthless clown moron scum that whether with from this".split()
    n = np.zeros((27, 27, 27))
    for w in words:
        s = [0, 0, *map(toxicity.symbol, w), 0]
        for a, b, c in zip(s, s[1:], s[2:]):
            n[a, b, c] += 50
    return toxicity.char_model(n)


@pytest.mark.parametrize("seen,plain", [("1d1ot", "idiot"), ("ID10T", "idiot"), ("st*pid", "stupid"), ("l.o.s.e.r", "loser"), ("i-d-i-o-t", "idiot"),
                                        ("loooooser", "loser"), ("p4th3t1c", "pathetic"), ("tr@sh!!", "trash"), ("cl0wn.", "clown"), ("$cum", "scum"),
                                        ("worthle$$", "worthless"), ("\"moron\"", "moron"), ("THE!!", "the"), ("the***", "the")])
def test_disguised_words_are_restored(char_model, seen, plain):
    assert plain in toxicity.Reader(char_model).read(seen)


def test_spaced_letters_and_numbers(char_model):
    r = toxicity.Reader(char_model)
    assert "idiot" in r.words("with i d i o t from")
    assert r.restored_text("this 1d1ot and") == "this idiot and"
    assert "555-2485" in r.words("call 555-2485 now") or "555-2485".strip("-") in r.words("call 555-2485 now")
    assert r.words("") == set()
    score = toxicity.Scorer(char_model, -2.0, None, {"idiot": 5.0})
    assert score.score("the 1d1ot") > 0.5 > score.score("the clown") and 0 <= score.score(None) < 0.5


# ------------------------------------------------------------------ op10

PAGE = """<html><head><title>T</title><style>x{}</style></head><body><h1>Head &amp; er</h1><p>One <b>two</b>three<br>four
 five<p>Next<ul><li>a<li>b<ul><li>c</ul></ul><ol start=3><li>x<li>y</ol>
<table><tr><th>Name<th>Qty<tr><td>Apple pie<td>3<tr><td>Fig<td>12</table><div hidden>no</div>
<div style="visibility:hidden">no<span style="visibility: visible">yes</span></div><pre>
 keep   this</pre><script>var t="</p>";</script>last <a href="a>b">link</a></b></i>"""


def test_rendering():
    assert html_render.render(PAGE) == (
        "Head & er\n\nOne twothree\nfour five\n\nNext\n\n- a\n- b\n  - c\n\n3. x\n4. y\n\nName       Qty\nApple pie  3\nFig        12\n\n"
        "yes\n\n keep   this\n\nlast link")


@pytest.mark.parametrize("html,text", [("", ""), ("  ", ""), ("<", "<"), ("<p", ""), ("<!--", ""), ("a<!-- b -->c", "ac"), ("<table><td>a", "a"),
                                       ("1 < 2 &lt; 3", "1 < 2 < 3"), ("<P>A</P><SCRIPT>z</SCRIPT>B", "A\n\nB"), ("<select><option>a</select>q", "a q"),
                                       ("<details><summary>S</summary>no</details>", "S"), ("x</div></p>y", "xy"), ("a&#65;&bogus;", "aA&bogus;")])
def test_rendering_of_fragments(html, text):
    assert html_render.render(html) == text


def test_rendering_of_deep_and_wide_pages():
    assert html_render.render("<div>" * 30_000 + "deep") == "deep"
    assert html_render.render("<table><tr><td>" * 200 + "z") == "z"
    assert html_render.render("<p>w" * 5000).count("w") == 5000


def test_crc_helper_is_zlib():
    assert zlib.crc32(b"17") % 5 in range(5)


def test_later_matches_pass_unrelated_anchor_and_chains():
    t = 46
    line = [f"line{i}" for i in range(12)]
    base = [f"w{i}" for i in range(30)] + line + [f"x{i}" for i in range(30)]
    sh = lambda w: shingles.shingle_hashes(np.array([zlib.crc32(x.encode()) for x in w], "u8")).astype("u4")
    other = [f"o{i}" for i in range(30)] + line + [f"p{i}" for i in range(30)]
    near = base[:5] + ["changed"] + base[6:]
    far = near[:40] + ["again"] + near[41:]
    got = lambda texts: substring_dedup.later_matches(np.zeros(len(texts), "i8"), np.arange(len(texts)), np.zeros(len(texts), "i8"),
                                                      [None] + [np.ones(len(sh(w)) - t + 1, bool) for w in texts[1:]], [sh(w) for w in texts], t)
    assert got([other, base, near]) == [(2, 1, 0)]                      # 0 shares the line only
    assert {(a, b) for a, b, _ in got([base, near, far])} >= {(1, 0), (2, 1)}   # each smaller document that holds a start
    assert got([other, base, [f"q{i}" for i in range(30)] + line + base[:20]]) == []


@pytest.mark.parametrize("text, word", [("you are a s t u p i d man", "stupid"), ("he is s t u p i d", "stupid"), ("i s t u p i d i d i o t", "idiot"),
                                        ("oh you/idiot there", "idiot"), ("such-idiots all", "idiots"), ("you...idiot", "idiot"), ("you,idiot", "idiot")])
def test_word_boundaries_are_decoded(char_model, text, word):
    assert word in toxicity.Reader(char_model).words(text)


@pytest.mark.parametrize("html,text", [
    ("x <math><mi>a</mi><mo>+</mo><mi>b</mi><annotation>no</annotation></math> y", "x a+b y"),
    ("<svg><title>t</title><path d='x'/><text>A</text><text>B</text><desc>no</desc></svg>z", "A B z"), ("<svg><g><p>out</p>in", "out\n\nin"),
    ("a<select><option>one<option selected>two</select>b", "a two b"), ("<select><option disabled>no<option>a</select>", "a"),
    ("<select><optgroup><option hidden>h<option>x</optgroup></select>", "x"), ("<select multiple><option>a<option>b</select>c", "a\nb\nc"), ("<select></select>q", "q")])
def test_formulas_drawings_and_choices(html, text):
    assert html_render.render(html) == text


@pytest.mark.parametrize("html,text", [
    ("<tr><th colspan=2>Wide header cell<th>c<tr><td>a<td>b<td>d", "Wide header cell  c\na  b              d"),
    ("<tr><td rowspan=2>a<td>b<tr><td>c", "a  b\n   c"), ("<tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d", "a  b\n   c\n   d"),
    ("<tr><td colspan=1000>a<td>b<tr><td>q<td>r<td>s", "a        b\nq  r  s"),
    ("<tr><td rowspan=2 colspan=2>big<td>1<tr><td>2<tr><td>x<td>y<td>3", "big   1\n      2\nx  y  3"),
    ("<tr><td colspan=x rowspan=-1>a<td colspan=99999999999>b", "a  b"), ("<tr><td>a<td><td>c<tr><td><tr><td>longer<td>x", "a          c\nlonger  x")])
def test_cells_span_columns_and_rows(html, text):
    assert html_render.render(f"<table>{html}</table>") == text

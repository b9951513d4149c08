"""Corpus operators on Spark: brute force, edge rows and the pipeline on small tables."""

import random
import zlib

import pytest

import corpus_pipeline
from tessera.llm import decontaminate, html_render, ngram_join, packing, quality_cnn, sharding, substring_dedup, topk, toxicity, url_reputation
from tessera.llm.components import connected_components
from tessera.llm.common import gapless_rank, running_sum, staged, with_row_id

DOC = "doc_id long, text string, lang string, source string, n_chars long, rid string, size string, length string"


def docs_of(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, "en", f"s{i % 3}" if i % 5 else None, None if t is None else len(t), "r", "s", "l") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC)


def prose(seed, n):
    g = random.Random(seed)
    return [f"{g.choice('bcdfglmnprst')}{g.choice('aeiou')}{g.choice('lmnrst')}{g.randrange(999)}" for _ in range(n)]


EDGE = [None, "", "   ", "one", "a b c", "the end", "the end", "é ü ß", "x" * 5000]


def test_ranks_and_sums(spark):
    df = staged(with_row_id(spark.range(1000).selectExpr("id % 3 as k", "id + 1 as v")), "t")
    r = gapless_rank(df, ["k"], "rid", 1000, "rk").collect()
    for k in range(3):
        assert sorted(x["rk"] for x in r if x["k"] == k) == list(range(len([x for x in r if x["k"] == k])))
    s = sorted((x["at"], x["v"]) for x in running_sum(df, ["k"], "rid", 1000, "v", "at").collect() if x["k"] == 1)
    at = 0
    for a, v in s:
        assert a == at
        at += v


@pytest.mark.parametrize("seed", range(3))
def test_components_match_union_find(spark, seed):
    g = random.Random(seed)
    edges = [(g.randrange(60), g.randrange(60)) for _ in range(g.randrange(20, 60))] + [(100 + i, 101 + i) for i in range(25)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


def test_sharding_of_edge_rows(spark):
    out = sharding.reshard_documents(docs_of(spark, EDGE * 20, ids=[i // 2 for i in range(len(EDGE) * 20)])).collect()
    assert len(out) == len(EDGE) * 20
    size = [0] * 16
    for r in out:
        size[r["shard"]] += r["size"]
    assert max(size) - min(size) <= 2 * 5001
    for k in range(16):
        assert sorted(r["slot"] for r in out if r["shard"] == k) == list(range(sum(r["shard"] == k for r in out)))
    assert sum(r["size"] == 1 for r in out) == 40 and all(r["grown_shard"] is None and r["law"] == "bytes" for r in out)
    assert sharding.reshard_documents(docs_of(spark, [])).count() == 0


def test_rewrite_touches_only_affected_shards(spark, tmp_path):
    rows = staged(with_row_id(spark.createDataFrame([(k, 10, f"t{i}") for k, n in ((0, 6), (1, 2), (2, 4)) for i in range(n)], "old_shard int, size long, text string")), "t")
    written = sharding.rewrite_affected(rows, 3, [40, 40, 40], str(tmp_path / "out"))
    assert written == [0, 1]
    back = spark.read.parquet(str(tmp_path / "out")).groupBy("shard").count().collect()
    assert {r["shard"]: r["count"] for r in back} == {0: 4, 1: 4}


def brute_jaccard(texts):
    def grams(t):
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    s = [grams(t) for t in texts]
    n = len(s)
    link = [[i != j and bool(s[i]) and bool(s[j]) and 100 * len(s[i] & s[j]) >= 80 * len(s[i] | s[j]) for j in range(n)] for i in range(n)]
    comp = list(range(n))
    for _ in range(n):
        for i in range(n):
            for j in range(n):
                if link[i][j]:
                    comp[i] = comp[j] = min(comp[i], comp[j])
    return [len(x) for x in s], comp, [sum(r) for r in link]


def near_copies():
    g = random.Random(5)
    texts = []
    for k in range(12):
        base = prose(k, g.choice([6, 9, 30, 80, 200]))
        for _ in range(g.choice([1, 2, 5])):
            w = list(base)
            for _ in range(g.choice([0, 0, 1, 2])):
                w[g.randrange(len(w))] = f"edit{g.randrange(9999)}"
            texts.append(" ".join(w))
    line = " ".join(prose(99, 20))
    return texts + [line + " " + " ".join(prose(200 + k, 40)) for k in range(6)] + EDGE


def test_jaccard_join_matches_brute_force(spark):
    texts = near_copies()
    n, comp, links = brute_jaccard(texts)
    got = {r["doc_id"]: r for r in ngram_join.jaccard_components(docs_of(spark, texts)).collect()}
    assert [got[i]["n_shingles"] for i in range(len(texts))] == n
    assert [got[i]["component_id"] for i in range(len(texts))] == comp
    assert [got[i]["n_links"] for i in range(len(texts))] == links
    assert len(set(comp)) < len(texts) - 10


def test_jaccard_join_both_sides_of_the_boundary(spark, monkeypatch):
    texts = near_copies()
    _, comp, links = brute_jaccard(texts)
    monkeypatch.setattr(ngram_join, "BLOCK_TOKENS", 60)       # many verification blocks
    for cut in (0.0, 40.0, 1e9):                              # all large, mixed, all small
        monkeypatch.setattr(ngram_join, "boundary", lambda *a, c=cut: c)
        got = {r["doc_id"]: r for r in ngram_join.jaccard_components(docs_of(spark, texts)).collect()}
        assert [got[i]["component_id"] for i in range(len(texts))] == comp, cut
        assert [got[i]["n_links"] for i in range(len(texts))] == links, cut


def test_jaccard_join_of_sets_that_share_one_list(spark, monkeypatch):
    """Pairs at exactly 0.8 whose shared tokens have equal inverted lists: one list is all they share."""
    texts = []
    for k in range(4):
        base = prose(300 + k, 94)                             # 90 shingles
        for same in (80, 79):                                 # 80 of 100, then 79 of 101
            other = prose(400 + 10 * k + same, 94)
            texts += [" ".join([f"{k}x{same}{w}" for w in base]), " ".join([f"{k}x{same}{w}" for w in base[:same + 4]] + other[same + 4:])]
    _, comp, links = brute_jaccard(texts)
    assert links == [1, 1, 0, 0] * 4
    for cut in (0.0, 1e9):
        monkeypatch.setattr(ngram_join, "boundary", lambda *a, c=cut: c)
        got = {r["doc_id"]: r for r in ngram_join.jaccard_components(docs_of(spark, texts)).collect()}
        assert [got[i]["component_id"] for i in range(len(texts))] == comp, cut


def test_one_document_of_each_group_stays(spark):
    texts = near_copies()
    comp = brute_jaccard(texts)[1]
    d = docs_of(spark, texts)
    kept = ngram_join.keep_one_per_group(d)
    assert kept.columns == d.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(comp))


def test_repeated_passages_and_their_removal(spark):
    p, q = prose(1, 60), prose(2, 55)
    texts = [" ".join(prose(10, 80) + p + prose(11, 40)), " ".join(prose(12, 30) + p), " ".join(prose(13, 90)), " ".join(q + prose(14, 70) + p),
             " ".join(prose(15, 20) + q), " ".join(p[:40] + prose(16, 60)), " ".join(prose(13, 90)), *EDGE]
    d = docs_of(spark, texts)
    rows = substring_dedup.repeated_passages(d).collect()
    cut = sorted((r["doc_id"], r["start_word"], r["end_word"], r["first_doc_id"]) for r in rows if not r["keep"])
    assert cut == [(1, 30, 90, 0), (3, 125, 185, 0), (4, 20, 75, 3), (6, 0, 90, 2)]
    assert {r["doc_id"] for r in rows if r["keep"]} == {0, 2, 3}
    left = {r["doc_id"]: r for r in substring_dedup.remove_repeats(d).collect()}
    assert set(left) == set(range(len(texts))) - {6}
    joined = [(" " + " ".join((left[i]["text"] or "").split()) + " ") for i in left]
    for words in (p, q, prose(13, 90)):
        assert sum(" ".join(words) in t for t in joined) == 1
    assert left[2]["text"] == texts[2] and left[5]["text"] == texts[5]
    assert left[1]["n_chars"] == len(left[1]["text"])


def test_unrelated_anchor_does_not_hide_a_repeat(spark):
    """Documents that share short lines with an earlier one and a passage among themselves."""
    line = prose(50, 9)
    p = prose(51, 55)
    texts = [" ".join(prose(60 + k, 45) + line + prose(70 + k, 45)) for k in range(5)]
    texts += [" ".join(prose(80, 50) + line + p), " ".join(prose(81, 33) + line + p + prose(82, 20))]
    rows = substring_dedup.repeated_passages(docs_of(spark, texts)).collect()
    assert [(r["doc_id"], r["end_word"] - r["start_word"]) for r in rows if not r["keep"]] == [(6, 64)]


def test_top_k_matches_brute_force(spark):
    g = random.Random(4)
    vec = [[g.choice([-1.5, -0.3, 0.0, 0.01, 0.4, 2.0]) for _ in range(5)] for _ in range(150)] + [[0.5] * 5] * 70
    rows = [(i, v) for i, v in enumerate(vec)] + [(400, None), (420, [1.0, float("nan"), 0.0, 0.0, 0.0]), (440, [None, 1.0, 1.0, 1.0, 1.0]), (None, [1.0] * 5), (460, [])]
    got = {}
    for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    import numpy as np
    m = np.floor(64 * np.array(vec, "f4").astype("f8"))
    for q in range(0, 220, 20):
        s = m @ m[q]
        want = sorted((-s[j], j) for j in range(220) if j != q)[:20]
        assert sorted(got[q]) == [(k + 1, j, -x) for k, (x, j) in enumerate(want)]
    assert set(got) == set(range(0, 220, 20))
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def labelled(spark, good, bad, col):
    texts = good + bad + EDGE
    labels = [(i, int(i < len(good)) if col == "quality" else int(len(good) <= i < len(good) + len(bad)), None) for i in range(len(good) + len(bad))]
    other = "toxic" if col == "quality" else "quality"
    lab = spark.createDataFrame(labels + [(None, 1, None), (3, None, None)], f"doc_id long, {col} int, {other} int")
    return docs_of(spark, texts), lab, len(good), len(bad)


def test_quality_and_toxicity_scores(spark, monkeypatch):
    monkeypatch.setattr(quality_cnn, "EPOCHS", 3)
    clean = [" ".join(f"{w[:3]}{'aeiou'[i % 5]}" for i, w in enumerate(prose(k, 40))).capitalize() + "." for k in range(60)]
    junk = [" ".join(w + "$$$ ###" for w in prose(k, 40)) for k in range(100, 140)]
    d, lab, g, b = labelled(spark, clean, junk, "quality")
    out = {r["doc_id"]: r for r in quality_cnn.score_documents(d, lab).collect()}
    assert len(out) == d.count() and all(0 <= r["score"] <= 1 for r in out.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in out.items())
    held = [i for i in range(g + b) if out[i]["held_out"]]
    assert all(out[i]["predicted"] == (i < g) for i in held)
    rude = [c.replace(" ", " idiot ", 1) for c in clean[:40]]
    d, lab, g, b = labelled(spark, clean, rude, "toxic")
    out = {r["doc_id"]: r for r in toxicity.score_documents(d, lab).collect()}
    assert all(out[i]["predicted"] == (i >= g) for i in range(g + b))
    kept = toxicity.keep_clean(d, lab)
    assert kept.columns == d.columns and {r["doc_id"] for r in kept.collect()} == set(range(g)) | set(range(g + b, g + b + len(EDGE)))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in toxicity.score_documents(d, none).collect()} == {0.5}
    assert {r["score"] for r in quality_cnn.score_documents(d, none).collect()} == {0.5}


def test_decontamination_and_removal(spark):
    item = prose(1, 30)
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "Two Words"), (3, None), (4, "..."), (10, " ".join(item[5:20]))], "item_id long, text string")
    texts = [" ".join(prose(2, 20) + item[8:22] + prose(3, 20)), "say two, words!", " ".join(item), " ".join(item[:9]), *EDGE]
    d = docs_of(spark, texts)
    out = {r["doc_id"]: r for r in decontaminate.contamination(d, bench).collect()}
    assert [(out[i]["n_words"], out[i]["n_hit"], out[i]["n_items"]) for i in range(5)] == [(54, 14, 2), (3, 2, 1), (30, 30, 2), (9, 0, 0), (0, 0, 0)]
    import hashlib
    assert out[0]["items_sha256"] == hashlib.sha256(b"1,10").hexdigest() and out[4]["items_sha256"] == hashlib.sha256(b"").hexdigest()
    left = {r["doc_id"]: r["text"] for r in decontaminate.remove_hits(d, bench).collect()}
    assert set(left) == set(range(len(texts))) - {1, 2}
    assert left[0].split() == prose(2, 20) + prose(3, 20) and all(left[i] == texts[i] for i in left if i)


def test_decontamination_in_blocks(spark, monkeypatch):
    items = [prose(k, 14) for k in range(6)]
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    d = docs_of(spark, [" ".join(items[k] + prose(40 + k, 5) + items[(k + 1) % 6][2:]) for k in range(6)])
    want = {r["doc_id"]: tuple(r) for r in decontaminate.contamination(d, bench).collect()}
    blocks = list(decontaminate.item_blocks(bench, 10, block_words=20))
    assert len(blocks) == 6
    monkeypatch.setattr(decontaminate, "item_blocks", lambda *a, **k: blocks)
    assert {r["doc_id"]: tuple(r) for r in decontaminate.contamination(d, bench).collect()} == want


def test_packing_of_documents(spark):
    texts = EDGE + [" ".join(prose(k, 50 * k)) for k in range(1, 12)]
    path = packing.public_vocabulary("word_bpe_49k.json")
    rows = packing.pack_documents(docs_of(spark, texts), path, capacity=512).collect()
    bins, docs = {}, {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        docs.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for b in bins.values():
        at = 0
        for off, n in sorted(b):
            assert off == at
            at += n
        assert at <= 512
    import numpy as np
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    for i, t in enumerate(texts):
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        assert sorted(docs[i]) == [(k, s, len(ids[s:s + 512]), zlib.crc32(ids[s:s + 512].tobytes())) for k, s in enumerate(range(0, len(ids), 512))]
    assert packing.pack_documents(docs_of(spark, []), path).count() == 0


def test_url_rules_and_reputation(spark):
    urls = [None, "no scheme", "http://A.Example.ORG/es/1", "http://example.org/en/12", "http://x.org", "http://x.org/a?b", "https://b.com/fr/", "https://b.com/de/x#y",
            "http://myexample.org/es/", "http://bad.net/1", "http://bad.net/2?x", "ftp://good.net", "http://h.io?q/z", "http://com/fr/a"]
    urls += [f"http://bad.net/{i}" for i in range(40)] + [f"http://good.net/{i}" for i in range(40)]
    pages = spark.createDataFrame([(i, u, "<p>") for i, u in enumerate(urls)], "page_id long, url string, html string")
    lab = spark.createDataFrame([(i, int("bad" not in u)) for i, u in enumerate(urls) if u and ".net" in u] + [(None, 1), (0, None)], "doc_id long, quality int")
    out = {r["page_id"]: r for r in url_reputation.judge(pages, lab).collect()}
    assert len(out) == len(urls)
    assert [(out[i]["host"], out[i]["path"], out[i]["rule"]) for i in range(9)] == [
        ("", "", None), ("", "", None), ("a.example.org", "/es/1", "example.org/es/"), ("example.org", "/en/12", "example.org/en/1"), ("x.org", "", None),
        ("x.org", "/a", "org/"), ("b.com", "/fr/", "com/fr/"), ("b.com", "/de/x", "com/de/"), ("myexample.org", "/es/", "org/")]
    assert (out[12]["host"], out[12]["path"], out[13]["rule"]) == ("h.io", "", "com/fr/")
    assert [out[i]["verdict"] for i in (2, 3, 5, 6, 7, 9, 11)] == ["block", "block", "allow", "allow", "block", "block", "allow"]
    assert url_reputation.judge(pages, lab.limit(0)).count() == len(urls)


def test_html_rows(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a<p>b"), (1, "u", "<p>a<p>b"), (2, None, None), (3, "u", "")], "page_id long, url string, html string")
    out = sorted((r["page_id"], str(r["text"]), r["n_chars"]) for r in html_render.extract_text(pages).collect())
    assert out == [(1, "a\n\nb", 4), (1, "a\n\nb", 4), (2, "None", None), (3, "", 0)]


def test_operators_on_empty_documents(spark):
    d = docs_of(spark, [])
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert ngram_join.jaccard_components(d).count() == 0
    assert substring_dedup.repeated_passages(d).count() == 0 and substring_dedup.remove_repeats(d).count() == 0
    assert toxicity.score_documents(d, lab).count() == 0 and quality_cnn.score_documents(d, lab).count() == 0
    assert decontaminate.contamination(d, bench).count() == 0


def test_pipeline(spark, tmp_path):
    item, p = prose(1, 30), prose(2, 60)
    clean = [" ".join(prose(10 + k, 60)) for k in range(40)]
    rude = [" ".join(prose(60 + k, 30) + ["idiot", "scum"] + prose(90 + k, 30)) for k in range(30)]
    near = clean[3].split()
    near[4] = "changed"
    texts = clean + rude + [" ".join(near), clean[5], " ".join(prose(200, 40) + p), " ".join(prose(201, 50) + p), " ".join(prose(202, 60) + item[:15]), *EDGE]
    from pyspark.sql import functions as F
    docs_of(spark, texts).drop("rid", "size", "length").withColumn("extra", F.lit(1)).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(40 <= i < 70)) for i in range(70)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    d = spark.read.parquet(str(tmp_path / "documents.parquet"))
    frames = [d]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(staged(stage(spark, frames[-1], str(tmp_path)), "t"))
    ids = [{r["doc_id"] for r in f.select("doc_id").collect()} for f in frames]
    assert all(f.columns == d.columns for f in frames[:-1])
    assert ids[1] == ids[0] - set(range(40, 70))
    assert ids[2] == ids[1] - {70, 71, 75 + 6}                      # a near copy, a copy, the second "the end"
    assert ids[3] == ids[2] and ids[4] == ids[3] and ids[5] == ids[4]
    text = {r["doc_id"]: r["text"] for r in frames[4].collect()}
    assert sum(" ".join(p) in (t or "") for t in text.values()) == 1
    assert text[74].split() == prose(202, 60) and text[3] == clean[3]
    want = sorted(tuple(r) for r in frames[5].select("doc_id", "piece", "length", "ids_crc32").collect())
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "piece", "length", "ids_crc32").collect()) == want


def covered(rows, doc):
    return {k for r in rows if r["doc_id"] == doc and not r["keep"] for k in range(r["start_word"], r["end_word"])}


def test_near_repeats_survive_unrelated_anchors(spark):
    # 0 shares a frequent line with every passage; the later copy has 49 words in a row, then one that differs
    line = prose(1, 42)
    texts, ids = [" ".join(prose(2, 40) + line + prose(3, 40))], [0]
    for k in range(40):
        words = prose(100 + k, 6) + line + prose(200 + k, 6)
        copy = words[:4] + ["changed"] + words[5:]
        texts += [" ".join(prose(300 + k, 30) + words), " ".join(prose(400 + k, 20) + copy + prose(500 + k, 30))]
        ids += [1 + k, 101 + k]
    rows = substring_dedup.repeated_passages(docs_of(spark, texts, ids)).collect()
    assert sum(len(covered(rows, 101 + k)) >= 49 for k in range(40)) >= 38


def test_exact_repeats_beside_verified_passages(spark):
    # 201 + k holds a passage of 1 + k and, beside it, one of 101 + k around a line of 0
    line = prose(1, 40)
    texts, ids = [" ".join(prose(2, 40) + line + prose(3, 40))], [0]
    for k in range(60):
        p, q = prose(100 + k, 60), prose(200 + k, 6) + line + prose(300 + k, 6)
        texts += [" ".join(prose(400 + k, 20) + p), " ".join(q + prose(500 + k, 20)), " ".join(p + q)]
        ids += [1 + k, 101 + k, 201 + k]
    rows = substring_dedup.repeated_passages(docs_of(spark, texts, ids)).collect()
    assert [k for k in range(60) if len(covered(rows, 201 + k)) < 112] == []


def layout(path):
    return {d.name: sorted(f.name for f in d.glob("*.parquet")) for d in path.glob("shard=*")}


def test_rewriting_a_layout_in_its_own_folder(spark, tmp_path):
    from pyspark.sql import functions as F
    out = tmp_path / "layout"
    names = ("at", "slot", "_b", "row", "text")
    first = spark.createDataFrame([(k, 10, i, f"{i}", None, i * 2, f"t{i}") for k, n in ((0, 6), (1, 2), (2, 4)) for i in range(n)],
                                  "shard int, size long, at long, slot string, _b int, row int, text string")
    first.write.partitionBy("shard").parquet(str(out))
    before = layout(out)
    want = sorted((r["at"], r["slot"], r["_b"], r["row"], r["text"]) for r in first.collect())

    def rows():
        return staged(with_row_id(spark.read.parquet(str(out)).withColumn("old_shard", F.col("shard"))), "t")
    got = sharding.rewrite_layout(rows(), 3, [40, 40, 40], str(out))
    assert got == ([0, 1], [], [])
    back = spark.read.parquet(str(out))
    assert sorted(tuple(r) for r in back.select(*names).collect()) == want       # no row lost, no column touched
    assert {r["shard"]: r["count"] for r in back.groupBy("shard").count().collect()} == {0: 4, 1: 4, 2: 4}
    assert layout(out)["shard=2"] == before["shard=2"] and {d.name for d in out.iterdir() if d.is_dir()} == {"shard=0", "shard=1", "shard=2"}
    assert sharding.rewrite_layout(rows(), 2, [60, 60], str(out)) == ([0, 1], [], [2])     # fewer shards
    assert sorted(tuple(r) for r in spark.read.parquet(str(out)).select(*names).collect()) == want and "shard=2" not in layout(out)
    assert sharding.rewrite_layout(rows(), 2, [120, 0], str(out)) == ([0], [1], [])        # a shard left without rows
    assert sorted(tuple(r) for r in spark.read.parquet(str(out)).select(*names).collect()) == want and set(layout(out)) == {"shard=0"}
    assert sharding.rewrite_layout(rows(), 2, [120, 0], str(out)) == ([], [], [])          # nothing moves


def test_jaccard_join_of_null_and_repeated_ids(spark):
    base = prose(900, 60)
    near = " ".join(base[:59] + ["other"])
    texts = [" ".join(base), near, " ".join(base) + " tail", *[" ".join(prose(901, 40)), " ".join(prose(901, 39) + ["x"])], " ".join(prose(902, 30)), None, None]
    ids = [None, 5, 7, None, None, 5, 5, None]
    d = docs_of(spark, texts, ids)
    comp, links = brute_jaccard(texts)[1:]
    got = sorted((r["doc_id"] or 0, r["component_id"] or 0, r["n_links"]) for r in ngram_join.jaccard_components(d).collect())
    low = [min([j for j, c in zip(ids, comp) if c == comp[i] and j is not None], default=0) for i in range(len(ids))]
    assert got == sorted((ids[i] or 0, low[i], links[i]) for i in range(len(ids))) and links[:5] == [2, 2, 2, 1, 1]
    kept = [(r["doc_id"], r["text"]) for r in ngram_join.keep_one_per_group(d).collect()]
    assert (5, near) in kept and (5, texts[5]) in kept and (5, None) in kept and (None, None) in kept       # both texts of 5: their own groups
    assert sum(t in texts[3:5] for _, t in kept) == 1 and len(kept) == 5
    twice = docs_of(spark, [near, texts[0], texts[5]], [2, 1, 1])
    assert sorted((r["doc_id"], r["text"]) for r in ngram_join.keep_one_per_group(twice).collect()) == sorted([(1, texts[0]), (1, texts[5])])
    twice = docs_of(spark, [texts[0], near, texts[5]], [1, 2, 2])
    assert sorted((r["doc_id"], r["text"]) for r in ngram_join.keep_one_per_group(twice).collect()) == sorted([(1, texts[0]), (2, texts[5])])


def test_jaccard_join_makes_each_set_where_its_text_is(spark, monkeypatch):
    base = prose(950, 60)
    texts = [" ".join(base), " ".join(base), " ".join(base[:59] + ["other"]), " ".join(prose(951, 60)), " ".join(base).upper()]
    d = docs_of(spark, texts, [3, 3, 4, 5, None])
    plans = {}

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        out = staged(df, name)
        if name == "join-kept":
            plans["rows"] = sorted((r["id"], r["copies"], r["n"]) for r in out.collect())
        return out
    monkeypatch.setattr(ngram_join, "staged", noted)
    comp, links = brute_jaccard(texts)[1:]
    got = sorted((r["doc_id"] or 0, r["component_id"], r["n_links"]) for r in ngram_join.jaccard_components(d).collect())
    assert got == [(0, 3, 3), (3, 3, 3), (3, 3, 3), (4, 3, 3), (5, 5, 0)] and links == [3, 3, 3, 0, 3] and comp[4] == comp[0]
    assert plans["rows"] == [(3, 3, 56), (4, 1, 56)]                    # one row per class, whichever of its rows was read
    assert "Exchange" not in plans["join-kept"].split("MapInArrow")[0]  # the packed sets were shuffled once more before


def test_decontamination_of_items_without_id(spark):
    import hashlib
    item, other = prose(1, 10), prose(2, 12)
    bench = spark.createDataFrame([(None, " ".join(item)), (7, " ".join(other)), (None, " ".join(prose(3, 11)))], "item_id long, text string")
    d = docs_of(spark, [" ".join(prose(4, 5) + item), " ".join(item + other), " ".join(other), None])
    for words in (400_000, 5):      # one block; one block for each item
        blocks = list(decontaminate.item_blocks(bench, 10, block_words=words))
        assert len(blocks) == (1 if words > 5 else 3)
        with pytest.MonkeyPatch.context() as m:
            m.setattr(decontaminate, "item_blocks", lambda *a, b=blocks: b)
            out = {r["doc_id"]: r for r in decontaminate.contamination(d, bench).collect()}
        sha = [hashlib.sha256(x).hexdigest() for x in (b"", b"7")]
        assert [(out[i]["n_hit"], out[i]["n_items"], out[i]["items_sha256"], out[i]["contaminated"]) for i in range(4)] == [
            (10, 1, sha[0], True), (22, 2, sha[1], True), (12, 1, sha[1], True), (0, 0, sha[0], False)]


def test_columns_of_any_name_pass_the_filters(spark):
    from pyspark.sql import functions as F
    names = ["n_words", "hit_spans", "item_ids", "_n_words", "_score", "_text", "_sig", "_first", "_spans", "_k", "_d", "_s", "_fs", "row", "name", "id", "text_name", "sid"]
    item, p = prose(1, 30), prose(2, 60)
    texts = [" ".join(prose(3, 40) + p), " ".join(prose(4, 50) + p), " ".join(prose(5, 60) + item[:15]), " ".join(prose(6, 30)), " ".join(prose(6, 30)), None, ""]
    d = docs_of(spark, texts)
    d = d.select("*", *[F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in names])
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for out, ids in ((decontaminate.remove_hits(d, bench), range(7)), (substring_dedup.remove_repeats(d), range(7)),
                     (ngram_join.keep_one_per_group(d), (0, 1, 2, 3, 5, 6)), (toxicity.keep_clean(d, lab, threshold=0.6), range(7))):
        rows = out.collect()
        assert out.columns == d.columns and sorted(r["doc_id"] for r in rows) == list(ids)
        assert all(r[n] == f"{n}{r['doc_id']}" for r in rows for n in names)

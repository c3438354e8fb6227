"""Each operator against a brute-force version or an exact round trip, and on nulls,
empty and long texts, ties, repeated rows, empty tables and clashing column names."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.llm import ann, langid, licenses, mixing, simhash, sitetree, spdropout, toxicity, urlfilter, vecdedup
from tabforge.llm.components import components

SF = "/root/testdata/sf0.01"
DOC = "doc_id long, text string, lang string, source string"


def _docs(spark, rows):
    return spark.createDataFrame(rows, DOC)


# ---------------------------------------------------------------- components


def test_components_match_union_find(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    got = dict(components(spark.createDataFrame(pairs, "a long, b long")).collect())
    assert got == {a: find(a) for p in pairs if p[0] != p[1] for a in p}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- op1


def test_url_rules(spark):
    urls = [
        ("http://A.Example.NET/en/1?q#f", "a.example.net", "/en/1", "example.net/en/", "allow"),
        ("https://example.net/en", "example.net", "/en", "net/", "block"),
        ("http://notexample.com/de/x", "notexample.com", "/de/x", None, "allow"),
        ("http://x.example.com/de/", "x.example.com", "/de/", "example.com/de/", "block"),
        ("ftp://net", "net", "", None, "allow"),
        ("net/en/", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("http://org?x=/fr/", "org", "", None, "allow"),
        ("http://a..org/fr/\n?", "a..org", "/fr/\n", "org/fr/", "allow"),
        ("", "", "", None, "allow"),
    ]
    rows = [(i % 7, u[0], "mine", "kept") for i, u in enumerate(urls * 2)]
    df = spark.createDataFrame(rows, "page_id int, url string, rule string, key string")
    out = urlfilter.judge(df, urlfilter.contract_rules(spark)).collect()
    got = sorted(((r.url or "", r.host, r.path, r.rule or "", r.verdict, r.key) for r in out))
    assert got == sorted((u or "", h, p, r or "", v, "kept") for u, h, p, r, v in urls * 2)
    assert urlfilter.judge(df.limit(0), urlfilter.contract_rules(spark)).count() == 0
    none = urlfilter.judge(df, urlfilter.contract_rules(spark).limit(0)).select("verdict").distinct().collect()
    assert [r.verdict for r in none] == ["allow"]


def test_url_filter_with_many_entries_has_no_false_positive(spark):
    listed = spark.range(5000).select(
        F.concat(F.lit("h"), F.col("id"), F.lit(".example")).alias("host"), F.lit("/a/").alias("path"), F.lit("block").alias("verdict")
    )
    urls = spark.range(9000).select(
        F.col("id").alias("page_id"), F.concat(F.lit("http://www.h"), F.col("id"), F.lit(".example/a/b")).alias("url")
    )
    out = urlfilter.judge(urls, listed)
    assert out.where("verdict = 'block'").agg(F.count("*"), F.min("page_id"), F.max("page_id")).first()[:] == (5000, 0, 4999)


# ---------------------------------------------------------------- op2


def test_targets_water_filling(spark):
    sizes = {"a": 100, "b": 5000, "c": 3000, "d": 10, None: 700}
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    weights = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2]))
    left, open_, want = float(sum(sizes.values())), set(sizes), {}
    while True:
        level = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if 3 * sizes[s] <= weights[s] * level}
        if not full:
            break
        for s in full:
            want[s] = 3.0 * sizes[s]
            left -= want[s]
        open_ -= full
    want |= {s: weights[s] * level for s in open_}
    assert got == pytest.approx(want) and sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_mix_meets_targets_and_reruns_agree(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = mixing.mix(docs, ranges=64).cache()
    for r in out.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g"), F.max("size").alias("m")).collect():
        assert abs(r.t - r.g) <= r.m / 2 + 1
    assert out.where("taken > 3 * size or taken % greatest(size, 1) <> 0").count() == 0
    again = mixing.mix(docs.repartition(7)).select("doc_id", "taken")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.select("doc_id", "taken").collect()))


def test_mix_edges(spark):
    docs = _docs(spark, [(1, None, "en", "a"), (2, "", "en", "a"), (3, "x y", None, None), (None, "z " * 5000, "en", "b"), (3, "x y", None, None)])
    out = mixing.mix(docs.withColumn("target", F.lit("old")).withColumn("u", F.lit(9))).collect()
    assert len(out) == 5 and {r.u for r in out} == {9}
    assert sorted((r["size"], r.source_size, r.taken <= 3 * r["size"]) for r in out)[:2] == [(0, 0, True), (0, 0, True)]
    assert mixing.mix(docs.limit(0)).count() == 0
    rows = mixing.repeated(mixing.mix(docs), docs.columns)
    assert rows.columns == docs.columns


# ---------------------------------------------------------------- op3, op4


def _vectors(seed=0, n=600, d=20):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)).astype(np.float32)
    x[100:160] = x[100] + 0.02 * rng.normal(size=(60, d))
    x[200:230] = x[200]
    return x


def _bad():
    return [(900, None), (901, []), (902, [0.0] * 20), (903, [float("nan")] * 20), (904, [1.0, None] * 10), (905, [float("inf")] * 20), (None, [1.0] * 20)]


def test_ann_recall_and_exact_scores(spark):
    x = _vectors()
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + _bad()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in ann.search(df, df.where("vec_id % 50 = 0")).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    y = x.astype(float)
    y /= np.sqrt((y * y).sum(axis=1))[:, None]
    hits = 0
    for q, found in got.items():
        found.sort()
        cos = y @ y[q]
        cos[q] = -2
        best = np.lexsort((np.arange(len(y)), -np.round(cos, 9)))[:5]
        hits += len(set(best) & {v for _, v, _ in found})
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        assert all(abs(s - cos[v]) < 1e-9 for _, v, s in found)
    assert len(got) == 12 and hits >= 0.9 * 60
    assert [v for _, v, _ in got[200]] == [201, 202, 203, 204, 205]  # ties go to the smaller ids


def test_ann_small_tables_give_all_candidates(spark):
    rows = [(0, [1.0, 0.0]), (50, [0.0, 1.0]), (7, [-1.0, 0.0]), (0, [1.0, 0.0]), (8, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("list", F.lit(1)).withColumn("mark", F.lit(1))
    got = sorted(tuple(r) for r in ann.search(df, df.where("vec_id % 50 = 0")).collect())
    assert [(q, k, v) for q, k, v, _ in got] == [(0, 1, 50), (0, 2, 7), (50, 1, 0), (50, 2, 0), (50, 3, 7)]
    assert ann.search(df.limit(0), df.limit(0)).count() == 0


def test_vector_links_match_brute_force(spark):
    x = _vectors(1)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + _bad() + [(5, x[5].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("code", F.lit(0))
    got = {}
    for r in vecdedup.near_duplicates(df).collect():
        got.setdefault(r.vec_id, []).append((r.n_links, r.component_id, r.kept))
    y = np.vstack([x, x[5:6]]).astype(float)
    y /= np.sqrt((y * y).sum(axis=1))[:, None]
    link = (y * 1.0) @ y.T >= 0.9
    np.fill_diagonal(link, False)
    ids = np.array([*range(len(x)), 5])
    label = ids.copy()
    while True:
        new = np.array([min(label[i], label[link[i]].min()) if link[i].any() else label[i] for i in range(len(ids))])
        if (new == label).all():
            break
        label = new
    for i, n, c in zip(ids, link.sum(axis=1), label):
        assert (n, c, i == c) in got[i], i
    for i, _ in _bad():
        assert got[i] == [(0, i, True)]
    assert vecdedup.near_duplicates(df.limit(0)).count() == 0


def test_vector_cells_split_hot_buckets(spark, monkeypatch):
    monkeypatch.setattr(vecdedup, "CELL", 16)
    x = _vectors(2, 300)
    x[:90] = x[0] + 0.01 * np.random.default_rng(0).normal(size=(90, 20))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    rows = {r.vec_id: r for r in vecdedup.near_duplicates(df).collect()}
    assert all(rows[i].n_links == 89 and rows[i].component_id == 0 for i in range(90))


# ---------------------------------------------------------------- op5

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar no-comments">
<header><h1>Site</h1></header><nav><a>menu</a></nav><div id="cookie-notice">cookies</div><main><article>
<header><h1>A &amp; B&nbsp;C</h1></header><p>One<br>two <b>three</b>&#33;<p>Four<script>if(a<b){"</p>"}</script>
<div class="share">Share</div><ul><li>x<li>y</ul>%s<form>q <input></form>tail</article>
<section class="comments"><article class="comment"><p>Nice</p></article></section></main><aside>s</aside><footer>f</footer></body>"""


def test_main_text_of_a_page():
    assert sitetree.Page(PAGE % "").text() == "A & B C\n\nOne two three!\n\nFour\n\nx\n\ny\n\ntail"
    assert sitetree.Page("plain <b>text</b>").text() == "plain text"
    assert sitetree.Page("").text() == "" and sitetree.Page("<p>a</p").text() == "a"
    assert sitetree.Page("<article><p>x" + " y" * 200_000).text() == "x" + " y" * 200_000


def test_style_tree_removes_repeated_branches(spark):
    pages = [(i, f"http://s.example/{i}", PAGE % f"<div class='z'>Join our club</div><p>Quoted by all</p><div>Own {i}</div>") for i in range(40)]
    plain = "<body><div class='a'>Welcome to us</div><div class='b'><p>Story number %d</p></div></body>"
    pages += [(100 + i, f"http://p.example/{i}", plain % i) for i in range(40)]
    pages += [(200, None, plain % 1), (201, "http://p.example/x", None), (202, "http://p.example/y", ""), (0, "http://s.example/0", pages[0][2])]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit("mine")).withColumn("text", F.lit("old"))
    out = {}
    for r in sitetree.main_text(df).collect():
        out.setdefault(r.page_id, []).append((r.text, r.n_chars, r.host))
    assert len(out[0]) == 2 and out[0][0] == out[0][1]
    text = out[3][0][0]
    assert "Join our club" not in text and "Quoted by all" in text and "Own 3" in text
    assert out[104][0] == ("Story number 4", 14, "mine")
    assert out[200][0][0] == "Welcome to us\n\nStory number 1" and out[201][0][:2] == ("", 0) and out[202][0][:2] == ("", 0)
    assert sitetree.main_text(df.limit(0)).count() == 0


def test_style_tree_judges_the_whole_page(spark):
    html = "<body><nav><ul><li>link %d</li></ul></nav><div class='x'>Same words</div><div class='y'>Lead %d</div><article><p>Text %d</p></article><footer>f</footer></body>"
    pages = [(i, f"http://w.example/{i}", html % (i, i, i)) for i in range(30)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    rows = sitetree.style_rows(df.withColumn("host", F.lit("w")))
    kinds = {r.kind: r["count"] for r in rows.groupBy("kind").count().collect()}
    assert kinds == {sitetree.MARKED: 30 * 4, sitetree.OUTSIDE: 30 * 2}
    out = {r.page_id: r.text for r in sitetree.main_text(df).collect()}
    assert out[7] == "Lead 7\n\nText 7"  # unmarked text that differs everywhere is important, repeated text is not
    assert sitetree.Page(pages[7][2]).text() == "Text 7"  # without a tree the prior decides


def test_copies_of_a_page_keep_their_article(spark):
    html = "<body><article><h1>Title %d</h1><div class='body'><div><p>Story %d</p></div></div><div class='club'><div>Join us</div></div></article></body>"
    pages = [(i, f"http://c.example/{i}", html % (i, i)) for i in range(60)]
    pages += [(100 + i, f"http://c.example/copy/{i}", html % (7, 7)) for i in range(30)]
    out = {r.page_id: r.text for r in sitetree.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert out[3] == "Title 3\n\nStory 3"  # what stands on many different pages still goes
    assert {out[i] for i in out if i >= 100 or i == 7} == {"Title 7\n\nStory 7"}


def test_class_words_inside_the_article_are_only_hints(spark):
    own = "<h2 id='related-work'>Related work</h2><section id='discussion'><h3 id='sharing-data'>Data</h3><p class='notice'>Seen %d</p></section><div id='menu'>Soup %d</div>"
    html = "<body><article><h1>T</h1>" + own + "<div class='newsletter-box'><div>Our letter</div></div><div class='share'>Share</div></article></body>"
    alone = sitetree.Page(html % (1, 1)).text()
    assert alone == "T\n\nRelated work\n\nData\n\nSeen 1\n\nSoup 1\n\nOur letter"
    pages = [(i, f"http://d.example/{i}", html % (i, i)) for i in range(30)]
    out = {r.page_id: r.text for r in sitetree.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert out[9] == "T\n\nRelated work\n\nData\n\nSeen 9\n\nSoup 9"


def test_long_quoted_attributes():
    assert sitetree.Page("<article><p title=\"%s<b>c>\">x</p></article>" % ("a > " * 5000)).text() == "x"
    assert sitetree.Page("<article><p>x</p>%s</article>" % ("<i a=\"' \n" * 20_001)).text() == "x"
    assert sitetree.Page("<article><p>5\" <b x=>y</b> it's</p></article>").text() == "5\" y it's"


# ---------------------------------------------------------------- op6


def test_chain_marginals_match_enumeration():
    rng = np.random.default_rng(1)
    sizes = np.array([0, 3, 200, 64, 65, 1, 700, 0])
    e, trans = rng.normal(0, 3, sizes.sum()), rng.normal(0, 2, (2, 2))
    got = toxicity.Lattice(sizes).marginals(e, trans)
    at = 0
    for n in sizes:
        t, f, b = np.exp(trans), np.zeros((n, 2)), np.ones((n, 2))
        v, w = np.array([1.0, 0.0]), np.ones(2)
        for i in range(n):
            v = (v @ t) * np.array([1, np.exp(e[at + i])])
            v /= v.sum()
            f[i] = v
        for i in range(n - 1, -1, -1):
            b[i] = w
            w = t @ (w * np.array([1, np.exp(e[at + i])]))
            w /= w.sum()
        want = (f * b)[:, 1] / (f * b).sum(axis=1)
        assert np.allclose(got[at : at + n], want)
        at += n


def test_toxicity_on_held_out_documents_and_edges(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = toxicity.predictions(docs, labels).join(labels, "doc_id").where("held_out").collect()
    toxic = [r for r in rows if r.toxic == 1]
    assert len(toxic) > 30 and sum(r.predicted for r in toxic) >= 0.9 * len(toxic)
    assert sum(r.predicted for r in rows if r.toxic == 0) <= 0.02 * len(rows)
    assert all(r.spans for r in toxic if r.predicted)
    model = toxicity.train(docs, labels)
    odd = _docs(spark, [(1, None, "x", "y"), (2, "", "x", "y"), (None, "you idiot, you idiot!", "x", "y"), (2, "fine " * 300_000, "x", "y")])
    got = toxicity.score_docs(odd.withColumn("score", F.lit("old")), model, with_spans=True).collect()
    assert [r.score >= 0.5 for r in got] == [False, False, True, False] and all(0 <= r.score <= 1 for r in got)
    assert [s.start for s in got[2].spans] == [4, 15] and got[2].spans[0].end == 9
    assert toxicity.score_docs(odd.limit(0), model).count() == 0
    blank = toxicity.train(odd, labels.limit(0))
    assert {r.score < 0.5 for r in toxicity.score_docs(odd, blank).collect()} == {True}


def _labelled(spark, n, word, pad=1):
    rng = random.Random(7)
    filler = ["w" + "".join(rng.choices("aeioulmnrst", k=5)) for _ in range(4000)]
    rows = []
    for i in range(2 * n):
        words = rng.choices(filler, k=25 * pad)
        if i % 2:
            words = [word(i) if k % 5 == 2 else w for k, w in enumerate(words)]
        rows.append((i, " ".join(words), "en", "s"))
    return _docs(spark, rows), spark.createDataFrame([(i, 1, i % 2) for i in range(2 * n)], "doc_id long, quality int, toxic int")


def test_toxic_words_of_late_ids_are_learned(spark):
    docs, labels = _labelled(spark, 700, lambda i: "blorgface" if i < 1000 else "zinkhead")
    model = toxicity.train(docs, labels)
    odd = _docs(spark, [(1, "you blorgface blorgface", "en", "s"), (2, "you zinkhead zinkhead", "en", "s"), (3, "you are fine", "en", "s")])
    assert [r.score >= 0.5 for r in toxicity.score_docs(odd, model).orderBy("doc_id").collect()] == [True, True, False]


def test_long_labelled_texts_are_learned_from(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TRAIN_CHARS", 1000)
    docs, labels = _labelled(spark, 100, lambda i: "blorgface", pad=20)
    assert docs.agg(F.min(F.length("text"))).first()[0] > 1000
    texts, y = toxicity.training_sample(docs, labels)
    assert len(texts) > 100 and max(map(len, texts)) <= 1010 and {"blorgface" in t for t, k in zip(texts, y) if k} == {True}
    got = toxicity.score_docs(docs, toxicity.train(docs, labels)).collect()
    assert all((r.score >= 0.5) == (r.doc_id % 2 == 1) for r in got)


# ---------------------------------------------------------------- op7


def _plain_fingerprint(text):
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_golay_keys_meet_within_two_bits():
    rng = np.random.default_rng(0)
    f = rng.integers(-(2**63), 2**63 - 1, 2000, dtype=np.int64)
    g = f.copy().view(np.uint64)
    for i in range(len(g)):
        for b in rng.choice(64, rng.integers(0, 3), replace=False):
            g[i] ^= np.uint64(1) << np.uint64(b)
    keys = []
    for v in (f, g.view(np.int64)):
        rows, k = simhash.candidate_keys(v)
        sets = [set() for _ in v]
        for r, x in zip(rows, k):
            sets[r].add(int(x))
        keys.append(sets)
    assert all(a & b for a, b in zip(*keys))


def test_simhash_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(5000, None), (5001, ""), (5002, " \t\n"), (5003, "a b"), (5003, "a b"), (5004, "w " * 300_000), (None, "A  B")], docs.schema)
    rows = docs.unionAll(extra).collect()
    got = simhash.near_duplicates(docs.unionAll(extra).withColumn("key", F.lit(1))).collect()
    ids = [r.doc_id for r in rows]
    fp = np.array([_plain_fingerprint(r.text) for r in rows], dtype=np.uint64)
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 2
    label = np.array([10**9 if i is None else i for i in ids])
    while True:
        new = np.array([label[near[i]].min() for i in range(len(ids))])
        if (new == label).all():
            break
        label = new
    want = sorted((str(i), format(int(f), "016x"), int(c)) for i, f, c in zip(ids, fp, label))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_simhash_cells_and_one_of_each(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL", 8)
    fps = spark.createDataFrame([((1 << a) | (1 << b),) for a in range(20) for b in range(a)] + [(0,)], "fp long")
    labels = components(simhash.fingerprint_links(fps)).select("label").distinct().count()
    assert labels == 1
    rows = [(4, "same text here now", "en", "s"), (2, "same text here now", "de", "t"), (2, "same text here now", "de", "t"), (9, "other words are in this one", "en", "s"), (None, None, None, None)]
    docs = _docs(spark, rows)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.lang) for r in kept.collect()) == [("2", "de"), ("9", "en"), ("None", None)]


# ---------------------------------------------------------------- op8


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], prev + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_patience_is_a_common_subsequence():
    rng = random.Random(5)
    for _ in range(200):
        a = [rng.choice("abcdefghij") for _ in range(rng.randrange(25))]
        b = [rng.choice("abcdefghij") for _ in range(rng.randrange(25))]
        pairs: list = []
        licenses.patience(a, 0, len(a), b, 0, len(b), pairs)
        pairs.sort()
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
        assert len(pairs) <= _lcs(a, b)


def test_license_notices(spark):
    mit = dict((n, t) for n, t in reversed(licenses.TEMPLATES) if len(t) > 100)["MIT"]
    text = "Intro. RELEASED under the MIT\nLicense! " + "filler words go here " * 4000 + mit.replace("free of charge", "gratis") + " end."
    rows = [(1, text), (2, None), (3, ""), (4, "no notice: all rights are reserved elsewhere, all the time"), (5, "All rights reserved.\n" * 3), (None, "Licensed under CC BY-NC 4.0.")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("license", F.lit("x"))
    got = [(r.doc_id, r.license) for r in licenses.scan_docs(df).collect()]
    assert sorted(map(str, got)) == sorted(map(str, [(1, "MIT"), (1, "MIT"), *[(5, "all-rights-reserved")] * 3, (None, "CC-BY-NC-4.0")]))
    spans = [r for r in licenses.scan_docs(df).collect() if r.doc_id == 1]
    assert text[spans[0].start_pos : spans[0].end_pos] == "RELEASED under the MIT\nLicense" and 0.8 <= spans[1].coverage < 1
    assert licenses.scan_docs(df.limit(0)).count() == 0 and licenses.scan_docs(df, templates=()).count() == 0


def test_far_words_do_not_hide_a_notice():
    scan = licenses.Scanner().scan
    for text in ("At all times all rights reserved", "all of it: all rights reserved", "All rights reserved where rights are reserved", "all in all: all rights reserved, all of them reserved"):
        assert [m[0] for m in scan(text)] == ["all-rights-reserved"], text
    match = scan("At all times all rights reserved")[0]
    assert match[1:4] == (13, 32, 3)


def test_large_gaps_get_a_longest_common_subsequence(monkeypatch):
    monkeypatch.setattr(licenses, "LCS_CELLS", 6)
    rng = random.Random(2)
    for _ in range(200):
        x, y = (rng.choices("abc", k=rng.randrange(1, 25)) for _ in range(2))
        out = []
        licenses.common(x, 0, len(x), y, 0, len(y), out)
        out.sort()
        best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i, j in ((i, j) for i in range(len(x)) for j in range(len(y))):
            best[i + 1][j + 1] = best[i][j] + 1 if x[i] == y[j] else max(best[i][j + 1], best[i + 1][j])
        assert len(out) == best[-1][-1] and all(x[i] == y[j] for i, j in out)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(out, out[1:]))


def test_license_lines_of_the_documents_are_all_found(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lines = [t for _, t in licenses.TEMPLATES if t.endswith(".")]
    want = {r.doc_id for r in docs.collect() if any(line in r.text for line in lines)}
    assert {r.doc_id for r in licenses.scan_docs(docs).collect()} == want and want


# ---------------------------------------------------------------- op9


def test_without_dropout_pieces_equal_the_public_library():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=spdropout.MODEL_PATH)
    texts = ["the heavenly thing", " a  b\n\nc½ ﬁ", "   ", "日本語 テキスト 🎉", "x" * 300 + " " + "ab" * 90, "tab\there\r\n", "für Öäß"]
    ids, bounds = spdropout.Segmenter(spdropout.load(), 0.0, 1).encode(texts, [0] * len(texts))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [model.encode(t) for t in texts]


def test_dropout_round_trip_and_variety(spark):
    texts = [None, "", "▁a ▁ b▁", "<0x0A> \x00", "the heavenly thing " * 20, "the heavenly thing " * 20, "q" * 20_000]
    rows = [(i if i else None, t, "x", "y") for i, t in enumerate(texts)]
    df = _docs(spark, rows).withColumn("pieces", F.lit("old"))
    out = spdropout.encode_docs(df, rate=0.3, variants=3).cache()
    back = spdropout.decode_docs(out).collect()
    assert all(r.lossless and r.decoded == r.text for r in back)
    by_text = {(r.doc_id, r.text): r.pieces for r in back}
    assert by_text[(None, None)] is None and by_text[(1, "")] == []
    again = spdropout.encode_docs(df.repartition(5), rate=0.3, variants=3).collect()
    assert {(r.doc_id, r.text): r.pieces for r in again} == by_text
    seeds = {tuple(spdropout.encode_docs(df.where("doc_id = 4"), rate=0.3, seed=s).first().pieces) for s in range(6)}
    assert len(seeds) > 1
    assert spdropout.encode_docs(df.limit(0)).count() == 0


def test_heap_and_rows_agree():
    pieces = spdropout.load()
    for rate in (0.0, 0.1, 0.5):
        seg = spdropout.Segmenter(pieces, rate, 3)
        words = ["▁heavenlything", "▁thanderinged", "▁▁▁▁a", "aaaa", "x", "▁naïveté"]
        keys = np.array([spdropout.stretch_key(w, 3, 0) for w in words], dtype=np.uint64)
        sym, _, bounds = seg.in_rows(words, keys)
        for i, w in enumerate(words):
            assert [s for *_, s in seg.by_heap(w, int(keys[i]))] == sym[bounds[i] : bounds[i + 1]].tolist()


def test_every_occurrence_of_a_word_draws_anew(spark):
    word, many = " heavenlything", 400
    out = spdropout.encode_docs(_docs(spark, [(i, word[1:] + word * (many - 1), "x", "y") for i in range(8)])).collect()
    pieces = spdropout.load()
    ways = []
    for r in out:
        text, own = "", []
        for i in r.pieces:
            text += pieces.raw[i].decode()
            own.append(i)
            if text == word:
                ways.append((r.doc_id, tuple(own)))
                text, own = "", []
        assert r.lossless and text == ""
    assert len(ways) == 8 * many and len({w for _, w in ways}) > 10
    assert all(len({w for d, w in ways if d == i}) > 5 for i in range(8))
    assert len({tuple(r.pieces) for r in out}) == 8
    copies = _docs(spark, [(1, word * 20, "x", "y")]).withColumn("n", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    assert len({tuple(r.pieces) for r in spdropout.encode_docs(copies, copy_col="n").collect()}) == 3


def test_decision_trees_give_what_the_agenda_gives(monkeypatch):
    pieces, rng = spdropout.load(), random.Random(4)
    vocabulary = ["heavenlything", "thanderinged", "a", "naïveté", "日本語", "x" * 70, "▁", "the", "q" * 40, "\n", " "]
    texts = [" ".join(rng.choices(vocabulary, k=60)) for _ in range(40)] + [None, ""]
    doc_keys = [rng.getrandbits(63) for _ in texts]
    for many in (spdropout.MANY, 20):
        monkeypatch.setattr(spdropout, "MANY", many)
        seg = spdropout.Segmenter(pieces, 0.3, 5)
        for a in range(0, len(texts), 7):  # later calls walk down the trees of earlier ones
            ids, bounds = seg.encode(texts[a : a + 7], doc_keys[a : a + 7])
            for text, key, b, e in zip(texts[a:], doc_keys[a:], bounds, bounds[1:]):
                want, place = [], 0
                for part_no, part in enumerate(text.split("▁") if text else []):
                    words = [""] * (part_no > 0) + seg.cut(((" " if part_no == 0 else "") + part).replace(" ", "▁"))
                    for w in words:
                        k = int(spdropout.place_keys(np.array([key], dtype=np.uint64), np.array([place]))[0])
                        want += seg._spell(w, seg.by_heap(w, k)) if w else seg.bytes_of("▁")
                        place += 1
                assert ids[b:e].tolist() == want


# ---------------------------------------------------------------- op10


def test_language_network_on_held_out_documents_and_edges(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    net = langid.train(docs)
    rows = langid.identify(docs.select("doc_id", "text", "lang"), net).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)
    odd = _docs(spark, [(1, None, "x", "y"), (2, "", "x", "y"), (None, "12 !?", None, "y"), (3, "der die und " * 100_000, "x", "y"), (3, "é", "x", "y")])
    got = langid.identify(odd.withColumn("score", F.lit("old")), net).collect()
    assert [r.lang_pred for r in got][:4] == ["und", "und", "und", "de"] and got[4].lang_pred != "und"
    assert langid.identify(odd.limit(0), net).count() == 0
    assert langid.train(docs.limit(0)) is None and langid.train(docs.withColumn("lang", F.lit(None).cast("string"))) is None
    assert {r.lang_pred for r in langid.identify(odd, None).collect()} == {"und"}


def test_folded_tables_equal_the_convolution():
    rng = np.random.default_rng(0)
    f = [rng.normal(size=(w, langid.EMBED, langid.FILTERS)).astype(np.float32) for w in langid.WIDTHS]
    n = langid.FILTERS * len(langid.WIDTHS)
    net = langid.ByteCNN(["a"], rng.normal(size=(256, langid.EMBED)).astype(np.float32), f, np.zeros(n), np.zeros((n, 1)), np.zeros(1))
    win = langid.windows_of(bytes(rng.integers(0, 256, 700, dtype=np.uint8)))
    e = net.embed[win]
    want = [sum(e[:, o : o + langid.WINDOW] @ f[k][o] for o in range(w)).max(axis=1) for k, w in enumerate(langid.WIDTHS)]
    assert np.allclose(langid.responses(win, *net.tables()), np.concatenate(want, axis=1), atol=1e-4)

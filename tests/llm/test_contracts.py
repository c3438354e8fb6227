"""Faults found in review: one test each, with the inputs that showed them."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tabforge.llm import langid, licenses, simhash, toxicity, urlfilter
from tabforge.llm.common import free_name

DOC = "doc_id long, text string, lang string, source string"


def test_free_names(spark):
    df = spark.createDataFrame([(1, 2)], "`_Best` int, `_best_` int")
    assert free_name(df, "_best") == "_best__" and free_name(df, "x") == "x"


def test_url_filter_with_an_own_best_column(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x", "mine", "k")], "page_id int, url string, _best string, key string")
    out = urlfilter.judge(pages, urlfilter.contract_rules(spark)).first()
    assert (out["_best"], out.key, out.verdict, out.rule) == ("mine", "k", "block", "net/")


def test_one_of_each_with_own_helper_names_and_shared_ids(spark):
    rows = [(1, "a b c d e f g"), (1, "p q r s t u v w x"), (1, "a b c d e f g"), (2, "a b c d e f g"), (None, "z " * 30), (None, "k l m n o p")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(str, simhash.one_of_each(df).collect()))
    for c in ("_id", "_fp", "_group", "_print", "group_key", "fingerprint", "component_id", "_rows"):
        df = df.withColumn(c, F.lit(f"own {c}"))
    out = simhash.one_of_each(df.withColumn("m", F.create_map(F.lit("a"), F.lit(1)))).collect()
    assert sorted(str(r) for r in [type(r)(doc_id=r.doc_id, text=r.text) for r in out]) == want and len(out) == 4
    assert all(r[c] == f"own {c}" for r in out for c in ("_id", "_fp", "_group", "_print"))


@pytest.mark.parametrize("text", ["½", "² ³", "Ⅷ", "①②", "5 _", "", None, "٣"])
def test_texts_without_a_letter_have_no_language(text):
    net = langid.fit(langid.windows_of(b"some words of a text " * 30), ["en"] * 3)
    assert langid.predict_texts([text, "x½"], net) == (["und", "en"], [0.0, 1.0])


def test_every_language_can_be_learned(spark, monkeypatch):
    """More languages than documents per language allow: each has fewer texts, none is left out."""
    rows = [(i, f"text number {i} in language {i % 300} " * 3, f"l{i % 300}", "s") for i in range(3000)]
    df = spark.createDataFrame(rows, DOC)
    monkeypatch.setattr(langid, "TRAIN_DOCS", 900)
    windows, langs = langid.training_sample(df)
    assert set(langs) == {f"l{i}" for i in range(300)} and len(windows) == len(langs) <= 900 * langid.WINDOWS_PER_TEXT
    monkeypatch.setattr(langid, "TRAIN_DOCS", 100)
    assert len(set(langid.training_sample(df)[1])) == 100


def test_toxic_offsets_are_those_of_the_text():
    text = "İ" * 5 + " fooXX bar İx"
    words = toxicity.tokens(text)
    spans = toxicity.spans_of(text, __import__("numpy").array([0, 0.9, 0, 0.8]))
    assert len(words) == 4 and [text[s["start"] : s["end"]] for s in spans] == ["fooXX", "İx"]
    for plain in ("Ein Straßenfest, ÉTÉ", "Σοφός ΟΔΟΣ", "A b́c"):
        assert toxicity.tokens(plain) == re.findall(r"\w+", plain.lower())


def test_license_positions_are_those_of_the_text():
    text = "İİİ İ said: Released under the MIT License. İ"
    ((name, start, end, *_),) = licenses.Scanner().scan(text)
    assert name == "MIT" and text[start:end] == "Released under the MIT License"


def test_inclusion_follows_the_length_weights(spark):
    """Over many seeds long documents are taken in proportion to their weights, sources meet their targets."""
    from tabforge.llm import mixing

    lengths = [4] * 60 + [20] * 60 + [70] * 20
    rows = [(i, "w " * n, "en", s) for s in ("a", "b") for i, n in enumerate(lengths)]
    docs = spark.createDataFrame(rows, DOC).cache()
    total = sum(lengths)
    taken = {k: 0 for k in (4, 20, 70)}
    seeds = range(12)
    for seed in seeds:
        out = mixing.mix(docs, weights=(5.0, 1.0), max_repeat=1.6, seed=seed, ranges=64).select("source", "size", "taken", "copies", "target").collect()
        for s in ("a", "b"):
            part = [r for r in out if r.source == s]
            assert abs(sum(r.taken for r in part) - part[0].target) <= 35 and max(r.copies for r in part) <= 2
        for r in out:
            if r.source == "b":
                assert r.target == pytest.approx(0.4 * total)
                taken[r["size"]] += r.copies
    share = {n: taken[n] / (lengths.count(n) * len(seeds)) for n in taken}
    # mean 20 words: 4 is short (weight 1), 20 middling (1.5), 70 long (2); a common factor fills 0.4 of all words
    factor = 0.4 * total / sum(n * g * lengths.count(n) for n, g in ((4, 1.0), (20, 1.5), (70, 2.0)))
    for n, g in ((4, 1.0), (20, 1.5), (70, 2.0)):
        assert share[n] == pytest.approx(factor * g, abs=0.07)


def test_certain_classes_and_shared_ids(spark):
    from tabforge.llm import mixing

    lengths = [4] * 30 + [20] * 30 + [70] * 10
    rows = [(None if i % 2 else 1, "w " * n + f"x{i}", "en", "a") for i, n in enumerate(lengths)] + [(9, "y", "en", "b")]
    out = mixing.mix(spark.createDataFrame(rows, DOC), weights=(0.95, 10.0), max_repeat=1.0, ranges=16).collect()
    part = [r for r in out if r.source == "a"]
    long = [r for r in part if r["size"] > 60]
    assert len(out) == 71 and abs(sum(r.taken for r in part) - part[0].target) <= 36
    assert all(r.copies == 1 for r in long)  # nearly all words are wanted: the long ones are certain


def test_a_long_list_of_whole_urls(spark):
    """3,000 listed URLs of hundreds of lengths: a page makes as many keys as its host has lengths."""
    import random

    rng = random.Random(5)
    listed = [(f"h{i % 50}.example", "/" + "p" * rng.randrange(400) + str(i), rng.choice(["block", "allow"])) for i in range(3000)]
    rules = spark.createDataFrame(listed, "host string, path string, verdict string")
    urls = [(k, f"http://{rng.choice(['', 'www.'])}{h}{p}{rng.choice(['', '/x', '?q'])}") for k, (h, p, _) in enumerate(rng.sample(listed, 300))]
    urls += [(1000 + k, f"http://h{k}.example/pp") for k in range(60)]
    got = {r.page_id: (r.rule, r.verdict) for r in urlfilter.judge(spark.createDataFrame(urls, "page_id int, url string"), rules).collect()}
    for k, url in urls:
        host, path = re.match(r"http://([^/]*)([^?]*)", url).groups()
        fits = [(h + p, v) for h, p, v in listed if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert got[k] == (max(fits, key=lambda f: len(f[0])) if fits else (None, "allow")), url
    hosts = spark.createDataFrame([("h1.example", [3, 400])], "suffix string, lengths array<int>")
    places = spark.createDataFrame([("www.h1.example", "/pppp"), ("h2.example", "/pppp"), ("", "/x")], "host string, path string")
    assert [r.key for r in urlfilter.candidate_keys(places, hosts).collect()] == ["h1.example/pp"]


def test_signed_zeros_are_one_vector(spark):
    from tabforge.llm import vecdedup

    rows = [(1, [0.0, 1.0]), (2, [-0.0, 1.0]), (3, [1.0, 0.0]), (4, [1.0, -0.0]), (5, [-1.0, 0.0])]
    out = vecdedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in out) == [
        (1, 1, 1, True), (2, 1, 1, False), (3, 1, 3, True), (4, 1, 3, False), (5, 0, 5, True)]

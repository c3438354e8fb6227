"""The style tree on the query's own table, against a plain version, and on hostile pages."""

from __future__ import annotations

import math
import re
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tabforge.llm import sitetree
from tabforge.llm.urlfilter import host_and_path

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")


def test_the_tree_decides_on_the_given_pages(spark, pages):
    """With marks off, only what the tree finds unimportant goes: it removes every menu, advert
    and footer of the given pages by itself, and the text is the article's."""
    alone = {r.page_id: r for r in sitetree.main_text(pages, marks=False).collect()}
    both = {r.page_id: r for r in sitetree.main_text(pages).collect()}
    assert len(alone) == len(both) == 2500
    assert all(alone[i].text == both[i].text and alone[i].text for i in alone)
    assert sum(r.tree_removed for r in both.values()) == 3 * 2500
    for r in pages.limit(200).collect():  # without any decision the whole page would come out
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        assert both[r.page_id].n_chars <= len(article)
        assert len(" ".join(t for _, t in sitetree.Page(r.html).blocks)) > both[r.page_id].n_chars + 10


def test_importance_matches_a_plain_version(spark, pages):
    got = {(r.host, r.place): (r.m, r.importance) for r in sitetree.tree_report(pages).collect()}
    looks, features = defaultdict(lambda: defaultdict(set)), defaultdict(lambda: defaultdict(set))
    rows = pages.select(host_and_path(F.col("url"))[0].alias("host"), "page_id", "html").collect()
    kids = {}
    for r in rows:
        page = sitetree.Page(r.html)
        key = page.text()  # copies of a page count as one
        for _, place, look, said, k, _ in page.judged():
            looks[r.host, place][look].add((key, said))
            kids[r.host, place] = max(k, kids.get((r.host, place), 0))
        for place, names in page.marked():
            for f in names:
                features[r.host, place][f].add(key)
    checked = 0
    for (host, place), named in features.items():
        shares = [len(s) for s in looks[host, place].values()]
        n_all, m = sum(shares), len(set.union(*named.values()))
        if m < sitetree.MIN_PAGES:
            assert (host, place) not in got
            continue
        shown = -sum(n / n_all * math.log(n / n_all, n_all) for n in shares)
        told = sum(1 - math.log(len(s), m) for s in named.values()) / len(named)
        fade = sitetree.GAMMA ** kids[host, place]
        assert got[host, place] == (m, pytest.approx((1 - fade) * shown + fade * told))
        checked += 1
    assert checked == len(got) > 100


def test_unique_marked_text_goes_by_its_marks(spark):
    """Reader comments are as unique as an article: with marks off the tree leaves them, marks remove them."""
    words = lambda i, n: " ".join(f"w{i}x{k}" for k in range(n))
    html = "<body><nav><a href='/a'>Home</a> <a href='/b'>News</a></nav><article><p>%s</p></article><div class='comments'>%s</div></body>"
    rows = [(i, f"http://c.example/{i}", html % (words(i, 40), words(1000 + i, 120))) for i in range(30)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for marks, want in ((True, words(3, 40)), (False, words(3, 40) + "\n\n" + words(1003, 120))):
        out = {r.page_id: r for r in sitetree.main_text(df, marks).collect()}
        assert out[3].text == want and out[3].tree_removed == 1  # the menu, by the tree


def test_few_pages_go_by_their_marks(spark):
    html = "<body><nav>menu</nav><article><p>Text %d</p></article></body>"
    df = spark.createDataFrame([(i, f"http://c{i}.example/", html % i) for i in range(5)], "page_id long, url string, html string")
    for marks in (True, False):
        assert sorted((r.text, r.tree_removed) for r in sitetree.main_text(df, marks).collect()) == [(f"Text {i}", 0) for i in range(5)]


def test_own_columns_named_like_helpers(spark, pages):
    df = pages.limit(30)
    for c in ("_site", "_low", "_low_host", "host", "branches"):
        df = df.withColumn(c, F.lit(f"own {c}"))
    out = sitetree.main_text(df.withColumn("tree_removed", F.lit("old"))).collect()
    assert len(out) == 30
    assert all(r[c] == f"own {c}" for r in out for c in ("_site", "_low", "_low_host", "host", "branches"))


@pytest.mark.parametrize(
    "part", ["<div>x", "<b><p></p>", "<center><p>a</p></i>", "<li>x<b>", "<table><td>y", "<b>", "</p>x<i>", "<a href=z>q<hr>"]
)
def test_hostile_pages_take_linear_time(part):
    def took(n):
        t = time.perf_counter()
        page = sitetree.Page(part * n + "end")
        page.text({1}), page.judged(), page.marked(), page.removed({1})
        return time.perf_counter() - t

    took(500)
    assert took(16_000) < 20 * took(2000) + 0.5


@pytest.mark.parametrize("limit", ["BROADCAST_BYTES", "HOST_KEYS"])
def test_many_findings_are_looked_up_by_page(spark, monkeypatch, limit):
    """Hosts with more findings than a page should carry: the same texts by a join of each page's own keys."""
    html = "<body><nav>menu</nav><div class='x%d'>Same words</div><div class='y'>Lead %d</div><article><h1>T %d</h1><div class='z'>Join us</div><p>Text %d</p></article></body>"
    rows = [(i, f"http://s{i % 2}.example/{i}", html % (i % 6, i, i, i)) for i in range(60)]
    rows += [(100, None, html % (1, 1, 1, 1)), (101, "http://s0.example/x", None), (102, "http://s1.example/", rows[3][2]), (3, *rows[3][1:])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("_print", F.lit("own")).withColumn("key", F.lit("k"))
    want = sorted(map(tuple, sitetree.main_text(df).collect()), key=str)
    monkeypatch.setattr(sitetree, limit, 1)
    got = sorted(map(tuple, sitetree.main_text(df).collect()), key=str)
    assert got == want and len(got) == 64
    assert sum(r[-1] for r in got) > 100 and any(r[5] == "Lead 7\n\nT 7\n\nText 7" for r in got)

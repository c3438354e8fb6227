"""Scores of the two classifiers against slow versions that follow the definitions."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from tabforge.llm import langid, toxicity

SF = "/root/testdata/sf0.01"


def slow_toxicity(model: toxicity.ToxicField, text: str | None) -> float:
    """Forward-backward in the log domain over one text, then the logistic score."""
    words = toxicity.tokens(text)
    e = [model.bias + sum(model.weights.get(f, 0.0) for f in toxicity.features(w)) for w in words]
    e = [max(-30.0, min(30.0, v)) for v in e]
    t = model.trans
    ahead = []
    state = [0.0, -math.inf]
    add = lambda a, b: max(a, b) + math.log1p(math.exp(-abs(a - b))) if min(a, b) > -math.inf else max(a, b)
    for v in e:
        state = [add(state[0] + t[0, s], state[1] + t[1, s]) + (v if s else 0.0) for s in (0, 1)]
        ahead.append(state)
    back = [0.0, 0.0]
    p = []
    for i in range(len(e) - 1, -1, -1):
        a, b = ahead[i][0] + back[0], ahead[i][1] + back[1]
        p.append(math.exp(b - add(a, b)))
        back = [add(t[s, 0] + back[0], t[s, 1] + e[i] + back[1]) for s in (0, 1)]
    a, b, c = model.score
    mass = sum(x for x in p if x >= toxicity.FLOOR)
    return 1 / (1 + math.exp(-(a + b * max(p, default=0.0) + c * math.log1p(mass))))


def test_toxicity_scores_are_those_of_the_field(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.train(docs, labels)
    assert model.weights
    some = docs.where("n_chars < 3000").limit(150).unionByName(docs.join(labels.where("toxic = 1"), "doc_id", "left_semi").limit(40)).distinct()
    some = some.unionAll(spark.createDataFrame([(-1, None, None, None, 0), (-2, "", None, None, 0), (-3, "İ İdiot idiot!", None, None, 0)], some.schema))
    rows = toxicity.score_docs(some, model).collect()
    assert len(rows) > 150 and max(r.score for r in rows) > 0.5
    for r in rows:
        assert abs(r.score - slow_toxicity(model, r.text)) < 1e-6, r.doc_id


def slow_language(net: langid.ByteCNN, text: str) -> tuple[str, float]:
    """Each filter at each place of each window, the largest response, softmax, mean by length."""
    raw = text.encode("utf-8", "replace")
    total, n = np.zeros(len(net.langs)), max(1, -(-len(raw) // langid.WINDOW))
    padded = raw + bytes(n * langid.WINDOW + 3 - len(raw))
    for k in range(n):
        window = padded[k * langid.WINDOW : (k + 1) * langid.WINDOW + 3]
        pooled = []
        for bank, width in zip(net.filters, langid.WIDTHS):
            vectors = net.embed[list(window)].astype(np.float64)
            places = [sum(vectors[i + o] @ bank[o] for o in range(width)) for i in range(langid.WINDOW)]
            pooled.append(np.max(places, axis=0))
        h = np.maximum(np.concatenate(pooled) + net.bias, 0) @ net.dense + net.dense_bias
        q = np.exp(h - h.max())
        size = langid.WINDOW if k < n - 1 else max(1, len(raw) - k * langid.WINDOW)
        total += q / q.sum() * size
    total /= total.sum()
    return net.langs[int(total.argmax())], float(total.max())


def test_languages_are_those_of_the_network(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    net = langid.train(docs)
    texts = [r.text for r in docs.where("n_chars between 1 and 900").select("text").limit(40).collect()] + ["a", "é" * 300, "x " * 127 + "yz"]
    langs, scores = langid.predict_texts(texts, net)
    for text, lang, score in zip(texts, langs, scores):
        want, share = slow_language(net, text)
        assert lang == want and abs(score - share) < 1e-4


def test_models_keep_their_quality_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = langid.predictions(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null")
    n, right = rows.agg(F.count("*"), F.count_if(F.col("lang") == F.col("lang_pred"))).first()
    assert n > 1000 and right >= 0.98 * n

"""The corpus pipeline: stages chain, keep clean documents and columns, and agree with a plain version."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import _plain_fingerprint

SF = "/root/testdata/sf0.01"


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "toxicity", "SimHash near-dedup", "mixing sources", "piece encoding"]
    first = corpus_pipeline.language_stage(spark, docs, SF)
    assert first.columns == docs.columns and first.count() == docs.count()  # all of these texts have letters
    second = corpus_pipeline.toxicity_stage(spark, first, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    clean = labels.where("toxic = 0").join(docs, "doc_id")
    assert second.columns == docs.columns
    assert clean.join(second, "doc_id", "left_semi").count() == clean.count()
    third = corpus_pipeline.dedup_stage(spark, second.cache(), SF).cache()
    rows = second.select("doc_id", "text").collect()
    fps = {r.doc_id: _plain_fingerprint(r.text) for r in rows}
    label = {i: i for i in fps}
    while True:
        new = {i: min(label[j] for j in fps if (fps[i] ^ fps[j]).bit_count() <= 2) for i in fps}
        if new == label:
            break
        label = new
    assert sorted(r.doc_id for r in third.select("doc_id").collect()) == sorted(i for i, c in label.items() if i == c)
    fourth = corpus_pipeline.mixing_stage(spark, third, SF)
    assert fourth.columns == docs.columns
    assert fourth.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    fifth = corpus_pipeline.encoding_stage(spark, fourth, SF)
    assert fifth.count() == fourth.count() and fifth.where("not lossless").count() == 0


def test_language_stage_without_a_network_keeps_texts(spark):
    texts = ["Der Hund", "été", "12 !?", "", None]
    docs = spark.createDataFrame([(i, t, None, "s", 0) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.language_stage(spark, docs, SF)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [0, 1]


def test_copies_of_a_document_are_segmented_anew(spark):
    rows = [(1, "heavenly things wandering " * 20, "en", "s", 0)] * 3 + [(2, "other words", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    runs = [sorted(tuple(r.pieces) for r in corpus_pipeline.encoding_stage(spark, d, SF).collect()) for d in (docs, docs.repartition(4))]
    assert runs[0] == runs[1] and len(set(runs[0])) == 4


def test_stages_take_odd_documents(spark, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "Der Hund und die Katze", "de", "s", 22), (3, "Der Hund und die Katze", "de", "s", 22), (None, "x y z", "en", None, 5), (4, "a " * 200_000, "en", "s", 400_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(4, 1, 0), (3, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for empty in (False, True):
        now = docs.limit(0) if empty else docs
        for _, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, str(tmp_path))
            n = now.count()
            assert (n == 0) if empty else n >= 0


def test_stages_keep_own_columns(spark):
    """Own columns named like a stage's results or helpers come through every stage but the last."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    own = ("score", "lang_pred", "size", "source_size", "target", "copies", "taken", "_id", "_fp", "_mix_source", "_mix_q", "Spans", "_copy", "_best")
    docs = docs.select("*", *[F.lit(f"own {c}").alias(c) for c in own]).cache()
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SF).cache()
        assert now.columns == docs.columns, name
        row = now.first()
        assert row and all(row[c] == f"own {c}" for c in own), name


def test_unsure_texts_stay(spark):
    """Mixed languages and repeated words leave the network unsure; only texts without a letter go."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.lang: r.text for r in docs.where("lang is not null and n_chars > 800").select("lang", "text").collect()}
    odd = [" ".join(t[:400] for t in texts.values()), "Is " * 500, "Was " * 3000, "word", "12 -", "½"]
    rows = docs.unionByName(spark.createDataFrame([(10**6 + i, t, None, "s", len(t)) for i, t in enumerate(odd)], "doc_id long, text string, lang string, source string, n_chars long"))
    kept = {r.doc_id for r in corpus_pipeline.language_stage(spark, rows, SF).select("doc_id").collect()}
    assert kept == {r.doc_id for r in docs.select("doc_id").collect()} | {10**6 + i for i in range(4)}

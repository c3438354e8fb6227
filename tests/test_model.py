"""Training and scoring: quality bound on held-out rows, foreign-model
scoring in Arrow batches, routed scoring, bounded preview."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.operators import experiment, metrics, model, sampling
from tabforge.sources import tables

SF = "/root/testdata/sf0.1"


def _docs(spark, sf=SF):
    lab = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col("quality").alias("y"))
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "source", "n_chars")
    return lab.join(docs, "doc_id")


def test_model_beats_base_rate_on_held_out(spark):
    t = sampling.assign_split_hash(_docs(spark), ["doc_id"], 0.3, 11)
    train, test = t.filter(F.col("split") == "train"), t.filter(F.col("split") == "test")
    m = model.train(train, ["lang", "source"], ["n_chars"], "y", model.BoostParams(0.1, 20, 3))
    scored = model.score(test, m, keep=["doc_id", "y"])
    ll = metrics.log_loss(scored, "y", "probability", digits=None).first()["log_loss"]
    p = train.agg(F.avg("y")).first()[0]
    base = test.select(
        F.avg(-(F.col("y") * F.log(F.lit(p)) + (1 - F.col("y")) * F.log(F.lit(1 - p))))
    ).first()[0]
    assert ll < base
    assert scored.count() == test.count()


class _LengthRule:
    """A stand-in foreign model: anything with a vectorised ``predict``."""

    def predict(self, frame):
        return (frame["n_chars"] > 2000).astype("float64")


def test_score_foreign_matches_expression(spark):
    docs = _docs(spark, "/root/testdata/sf0.001")
    out = model.score_foreign(docs, _LengthRule, ["n_chars"])
    bad = out.filter(F.col("prediction") != (F.col("n_chars") > 2000).cast("double")).count()
    assert bad == 0 and out.count() == docs.count()


def test_routed_scoring_uses_the_arm_model(spark):
    docs = _docs(spark, "/root/testdata/sf0.01")
    m_a = model.train(docs, ["lang"], ["n_chars"], "y", model.BoostParams(0.1, 3, 2))
    m_b = model.train(docs, [], ["n_chars"], "y", model.BoostParams(0.1, 3, 2))
    routed = experiment.route(docs, "doc_id", ("A", "B"))
    out = experiment.score_routed(routed, "arm", {"A": m_a, "B": m_b})
    assert out.filter(F.col("arm") != F.col("model")).count() == 0
    assert out.count() == docs.count()


def test_preview_is_bounded(spark):
    pdf = tables.preview(spark.read.parquet(f"{SF}/lineitem.parquet"), 7)
    assert len(pdf) == 7

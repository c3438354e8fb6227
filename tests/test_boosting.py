"""Boosted trees against a search of every split, and on held-out rows with missing values."""

from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabforge.operators import boosting, metrics, sampling
from tabforge.operators.boosting import TreeParams

SCHEMA = "id long, x double, z double, c string, y int"


def small(n=240, seed=1):
    """Few distinct values, so bins are exact; a third of x is missing and tells about y."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x = rng.choice([None, *[float(v) for v in range(8)], *[float(v) for v in range(8)]]) if i % 17 else float("nan")
        c = rng.choice(["a", "b", "c", "d", None])
        score = (2.0 if x is None or x != x else 0.3 * x - 1) + {"a": 1.5, "b": -1, "c": 1.2, "d": -0.5, None: 0}[c]
        rows.append((i, x, float(rng.randrange(5)), c, int(rng.random() < 1 / (1 + math.exp(-score)))))
    return rows


def missing(v):
    return v is None or v != v


def every_split(rows, feature, p, margin=0.0):
    """The best gain over all cuts and sides of missing (numbers), over all sets of values (categories)."""
    g = [1 / (1 + math.exp(-margin)) - r[4] for r in rows]
    h = [(gi + r[4]) * (1 - gi - r[4]) for gi, r in zip(g, rows)]

    def gain(inside):
        n, a, b = sum(inside), sum(x for x, i in zip(g, inside) if i), sum(x for x, i in zip(h, inside) if i)
        if n < p.min_rows or len(rows) - n < p.min_rows:
            return -math.inf
        return a * a / (b + p.l2) + (sum(g) - a) ** 2 / (sum(h) - b + p.l2) - sum(g) ** 2 / (sum(h) + p.l2)

    col = {"x": 1, "z": 2, "c": 3}[feature]
    values = sorted({r[col] for r in rows if not missing(r[col])})
    if feature == "c":
        sets = [set(s) for k in range(len(values) + 1) for s in itertools.combinations([*values, None], k)]
        return max(gain([r[col] in s for r in rows]) for s in sets)
    best = -math.inf
    for cut, side in itertools.product([-math.inf, *values], (False, True)):
        best = max(best, gain([side if missing(r[col]) else r[col] <= cut for r in rows]))
    return best


def test_first_splits_are_the_best(spark):
    rows = small()
    p = TreeParams(min_rows=5, cat_smooth=0.0, l2=1e-9)  # without smoothing the gradient order holds the best set
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = {r["feature"]: r for r in boosting.split_report(df, ["x", "z"], ["c"], "y", p)}
    rate = sum(r[4] for r in rows) / len(rows)
    for feature in ("x", "z", "c"):
        want = every_split(rows, feature, p, math.log(rate / (1 - rate)))
        assert found[feature]["gain"] == pytest.approx(want, rel=1e-9)
    assert found["x"]["missing_left"] in (True, False) and found["c"]["values"]


def test_a_tree_is_grown_by_the_best_splits(spark):
    """Both levels of a tree: every node's gain is the best of all splits of the rows that reach it."""
    rows = small(400, 2)
    p = TreeParams(min_rows=5, cat_smooth=0.0, l2=1e-9, n_trees=1, max_depth=2, learning_rate=1.0)
    model = boosting.train_boosted(spark.createDataFrame(rows, SCHEMA).repartition(4), ["x", "z"], ["c"], "y", p)
    tree, (told) = model.trees[0], model.nodes()
    cols = [[r[1] for r in rows], [r[2] for r in rows], [r[3] for r in rows]]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.float64()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.string())], names=["_x0", "_x1", "_x2"]
    )
    bins = model.binning.bins(batch)
    assert {t["node"] for t in told} == {0, 1, 2}
    for t in told:
        here = np.ones(len(rows), dtype=bool)
        if t["node"]:
            goes = tree.left[0, bins[:, tree.feature[0]]]
            here = goes if t["node"] == 1 else ~goes
        inside = [r for r, i in zip(rows, here) if i]
        best = max(every_split(inside, f, p, model.base) for f in ("x", "z", "c"))
        assert t["gain"] == pytest.approx(best, rel=1e-6)
        g = sum(1 / (1 + math.exp(-model.base)) - r[4] for r in inside)
        if t["node"]:
            q = 1 / (1 + math.exp(-model.base))
            assert tree.value[t["node"]] == pytest.approx(-g / (len(inside) * q * (1 - q)), rel=1e-6)


def test_training_loss_falls_and_checkpoints_change_nothing(spark):
    df = spark.createDataFrame(small(600, 3), SCHEMA).repartition(4)
    losses, margins = [], []
    for n, every in ((1, 10), (4, 10), (12, 10), (12, 2)):
        model = boosting.train_boosted(df, ["x", "z"], ["c"], "y", TreeParams(n_trees=n, max_depth=3, min_rows=5, checkpoint_every=every))
        scored = boosting.score_boosted(df, model)
        losses.append(metrics.log_loss(scored, "y", "probability", digits=None).first()["log_loss"])
        margins.append({r.id: r.probability for r in scored.collect()})
    assert losses[0] > losses[1] > losses[2]
    assert max(abs(margins[2][i] - margins[3][i]) for i in margins[2]) < 1e-9


def test_missing_values_beat_the_base_rate_on_held_out(spark):
    """Real documents, a third of the lengths missing where quality is low: the learner uses that."""
    sf = "/root/testdata/sf0.1"
    lab = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col("quality").alias("y"))
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "source", "n_chars")
    gone = (F.col("doc_id") % 3 == 0) | ((F.col("y") == 0) & (F.col("doc_id") % 5 == 0))
    t = lab.join(docs, "doc_id").withColumn("n_chars", F.when(~gone, F.col("n_chars")))
    t = sampling.assign_split_hash(t, ["doc_id"], 0.3, 11)
    train, test = t.filter(F.col("split") == "train"), t.filter(F.col("split") == "test")
    model = boosting.train_boosted(train, ["n_chars"], ["lang", "source"], "y", TreeParams(n_trees=15, max_depth=3))
    scored = boosting.score_boosted(test, model, keep=["doc_id", "y", "n_chars"])
    loss = metrics.log_loss(scored, "y", "probability", digits=None).first()["log_loss"]
    p = train.agg(F.avg("y")).first()[0]
    base = test.select(F.avg(-(F.col("y") * F.log(F.lit(p)) + (1 - F.col("y")) * F.log(F.lit(1 - p))))).first()[0]
    assert loss < base - 0.01
    assert scored.count() == test.count()
    lost, there = (scored.where(c).agg(F.avg("probability")).first()[0] for c in ("n_chars is null", "n_chars is not null"))
    assert lost < there  # missing lengths mean low quality here


def test_odd_rows_and_names(spark):
    rows = [(i, None if i % 3 else float(i % 5), float("nan"), None if i % 2 else "k", i % 2 if i % 7 else None) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    p = TreeParams(n_trees=3, max_depth=2, min_rows=5)
    model = boosting.train_boosted(df, ["x", "z"], ["c"], "y", p)
    new = spark.createDataFrame([(1, None, None, "unseen", None), (2, float("nan"), float("inf"), None, None), (3, 1e300, -1e300, "k", None)], SCHEMA)
    new = new.withColumn("probability", F.lit("mine")).withColumn("own", F.lit(5)).withColumn("_x0", F.lit(6))
    out = boosting.score_boosted(new, model).collect()
    assert [r.own for r in out] == [5, 5, 5] and [r["_x0"] for r in out] == [6, 6, 6]
    assert all(0 <= r.probability <= 1 and r.prediction == int(r.probability > 0.5) for r in out)
    for data in (df.limit(0), df.where("y = 1"), df.withColumn("y", F.lit(None).cast("int"))):
        flat = boosting.train_boosted(data, ["x"], ["c"], "y", p)
        assert flat.trees == [] and 0 < boosting.score_boosted(new, flat).first().probability < 1
    with pytest.raises(ValueError):
        boosting.train_boosted(df, ["x", "x"], [], "y")


def test_many_values_are_cut_at_quantiles(spark):
    df = spark.range(20_000).select(F.col("id").cast("double").alias("x"), F.concat(F.lit("v"), F.col("id") % 500).alias("c"), (F.col("id") > 7000).cast("int").alias("y"))
    binning = boosting.fit_binning(df, ["x"], ["c"], 32)
    assert len(binning.cuts["x"]) <= 31 and len(binning.values["c"]) == 32
    report = {r["feature"]: r for r in boosting.split_report(df, ["x"], ["c"], "y", TreeParams(max_bins=32))}
    assert abs(report["x"]["up_to"] - 7000) < 20_000 / 32

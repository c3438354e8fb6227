"""The logged evaluation: the four counts must reproduce the logged
accuracy, precision, recall and F1 to 15 digits."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tabforge.operators import metrics

# The logged confusion counts and metrics of the monitored model.
TN, FP, FN, TP = 378, 4184, 166, 13784
LOGGED = {
    "accuracy": 0.7650172860847018,
    "precision": 0.7671415850400712,
    "recall": 0.9881003584229391,
    "f1": 0.8637132652421831,
}


def _eval_rows(spark):
    n = TN + FP + FN + TP
    i = F.col("id")
    y = F.when(i < TN + FP, 0).otherwise(1)
    p = F.when(i < TN, 0).when(i < TN + FP, 1).when(i < TN + FP + FN, 0).otherwise(1)
    return spark.range(n).select(y.alias("y"), p.alias("pred"))


def test_counts_and_rates(spark):
    row = metrics.class_metrics(_eval_rows(spark), "y", pred="pred", digits=None).first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (TN, FP, FN, TP)
    assert row["example_count"] == 18512
    for k, v in LOGGED.items():
        assert row[k] == pytest.approx(v, rel=1e-15, abs=1e-15)


def test_auc_ties_count_half(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "y int, s double")
    assert metrics.roc_auc(df, "y", "s", digits=None).first()["roc_auc"] == pytest.approx(0.875)
    # AP: thresholds 0.9 (P=1), 0.5 (P=2/3), 0.1 (P=1/2): 0.5*1 + 0.5*2/3
    assert metrics.pr_auc(df, "y", "s", digits=None).first()["pr_auc"] == pytest.approx(0.5 + 1 / 3)


def test_log_loss_clips(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 0.0), (1, 0.0)], "y int, s double")
    v = metrics.log_loss(df, "y", "s", digits=None).first()["log_loss"]
    assert v == pytest.approx(34.538776394910684 / 3, rel=1e-9)


def test_gate_ties_pass_and_missing_champion_passes(spark):
    rows = [("new", 1, 0.9), ("new", 0, 0.1), ("old", 1, 0.9), ("old", 0, 0.1)]
    df = spark.createDataFrame(rows, "m string, y int, s double")
    assert metrics.champion_gate(df, "m", "new", "old", "y", "s").first()["improved"] is True
    assert metrics.champion_gate(df, "m", "new", "absent", "y", "s").first()["improved"] is True


def test_pr_auc_trapezoid_hand_computed(spark):
    # thresholds 0.9: (r=.5, p=1); 0.5: (r=1, p=2/3); 0.1: (r=1, p=1/2); start (0, 1)
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "y int, s double")
    v = metrics.pr_auc(df, "y", "s", digits=None, method="trapezoid").first()["pr_auc"]
    assert v == pytest.approx(0.5 * (1 + 1) / 2 + 0.5 * (2 / 3 + 1) / 2)

"""Every major operator accepts an empty input."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tabforge.operators import clean, drift, features, metrics, profile, runs, sampling, synth
from tabforge.plans.prefix import dense_index

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def empty_events(spark):
    return spark.read.parquet(f"{SF}/events.parquet").filter(F.lit(False))


CASES = {
    "window_profile": lambda e: profile.window_profile(e, "ts", "30 minutes", ["event_type"], ["value"], ["user_id"]),
    "window_profile_salted": lambda e: profile.window_profile(
        e, "ts", "30 minutes", ["event_type"], ["value"], ["user_id"], salt=4
    ),
    "column_profile": lambda e: profile.column_profile(e, ["value", "event_type"]),
    "collapse_rare": lambda e: clean.collapse_rare(e, "event_type", 5),
    "value_counts": lambda e: metrics.value_counts(e, "event_type"),
    "roc_auc": lambda e: metrics.roc_auc(e.withColumn("y", F.lit(1)), "y", "value"),
    "pr_auc": lambda e: metrics.pr_auc(e.withColumn("y", F.lit(1)), "y", "value"),
    "drift_ks": lambda e: drift.drift_numeric(e, e, ["value"]),
    "drift_cat": lambda e: drift.drift_categorical(e, e, ["event_type"]),
    "split_exact": lambda e: sampling.assign_split_exact(e, ["event_id"], 0.2, 1),
    "resample": lambda e: sampling.resample(e, "event_id"),
    "dense_index": lambda e: dense_index(e, "event_id"),
    "encode": lambda e: features.apply_codes(e, features.fit_codes(e, ["event_type"]), ["event_type"]),
    "metric_history": lambda e: runs.metric_history(e, "user_id", "event_type", "value", "ts"),
    "synthesize": lambda e: synth.synthesize(e.select("value", "event_type", "ts"), synth.SynthSpec(n=5, id_col=None)),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_empty_input(spark, empty_events, name):
    out = CASES[name](empty_events)
    out.collect()

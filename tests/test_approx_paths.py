"""Approximate (sketch) paths stay close to the exact ones; cluster settings."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tabforge.operators import profile
from tabforge.session import cluster_conf

SF = "/root/testdata/sf0.01"


def test_hll_distinct_close_to_exact(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    exact = profile.window_profile(ev, "ts", "1 day", ["event_type"], ["value"], ["user_id"])
    approx = profile.window_profile(ev, "ts", "1 day", ["event_type"], ["value"], ["user_id"], exact_distinct=False)
    a = {(r["window_start"], r["event_type"]): r["user_id_distinct"] for r in exact.collect()}
    b = {(r["window_start"], r["event_type"]): r["user_id_distinct"] for r in approx.collect()}
    assert a.keys() == b.keys()
    assert all(abs(a[k] - b[k]) <= max(2, 0.1 * a[k]) for k in a)


def test_salted_hll_close_to_exact(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    exact = profile.window_profile(ev, "ts", "1 day", ["event_type"], ["value"], ["user_id"])
    salted = profile.window_profile(
        ev, "ts", "1 day", ["event_type"], ["value"], ["user_id"], exact_distinct=False, salt=4
    )
    a = {(r["window_start"], r["event_type"]): r for r in exact.collect()}
    b = {(r["window_start"], r["event_type"]): r for r in salted.collect()}
    for k, r in a.items():
        s = b[k]
        assert s["n_rows"] == r["n_rows"] and s["value_mean"] == pytest.approx(r["value_mean"], abs=1e-6)
        assert abs(s["user_id_distinct"] - r["user_id_distinct"]) <= max(2, 0.1 * r["user_id_distinct"])
        assert s["value_p50"] == r["value_p50"]


def test_column_profile_approx(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    a = {r["column_name"]: r["n_distinct"] for r in profile.column_profile(ev, ["user_id", "event_id"]).collect()}
    b = {r["column_name"]: r["n_distinct"]
         for r in profile.column_profile(ev, ["user_id", "event_id"], exact_distinct=False).collect()}
    assert all(abs(a[k] - b[k]) <= 0.1 * a[k] for k in a)


def test_cluster_conf_scales_with_input():
    small, big = cluster_conf(64, 1.0), cluster_conf(8000, 100.0)
    assert int(big["spark.sql.shuffle.partitions"]) >= 100 * 1024 * 1024 // 512
    assert int(small["spark.sql.shuffle.partitions"]) >= 3 * 64
    assert big["spark.cleaner.referenceTracking.cleanCheckpoints"] == "true"

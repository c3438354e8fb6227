"""Merged profiles: exact where they must be, within the sketches' bounds elsewhere, without the log."""

from __future__ import annotations

import math
import uuid

import pytest
from pyspark.sql import functions as F

from tabforge.operators import profile, sketches
from tabforge.session import scratch_path

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def states(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").select("ts", "event_type", "user_id", "value")
    path = scratch_path(spark, f"profiles/{uuid.uuid4().hex}")
    sketches.store(sketches.profile_state(ev, "ts", "30 minutes", ["event_type"], ["value"], ["user_id"]), path)
    return ev, path


@pytest.mark.parametrize("width,keys", [("30 minutes", ["event_type"]), ("1 day", ["event_type"]), ("1 day", []), ("10 days", ["event_type"])])
def test_rollup_matches_the_rows(spark, states, width, keys):
    ev, path = states
    got = sketches.finish(sketches.merge_states(sketches.stored(spark, path), width, keys), (0.1, 0.5, 0.95))
    want = profile.window_profile(ev, "ts", width, keys, ["value"], ["user_id"], quantiles=(0.5,))
    cols = ["window_start", *keys, "n_rows", "value_nulls", "value_min", "value_max", "value_mean", "value_sd", "user_id_nulls"]
    assert sorted(map(tuple, got.select(*cols).collect()), key=str) == sorted(map(tuple, want.select(*cols).collect()), key=str)
    exact = {tuple(r[c] for c in ["window_start", *keys]): r for r in want.collect()}
    rows = {}
    timed = ev.withColumn("w", profile.tumbling("ts", width)["start"])
    for r in timed.where("value is not null").select("w", *keys, "value").collect():
        rows.setdefault(tuple(r)[:-1], []).append(r.value)
    for r in got.collect():
        at = tuple(r[c] for c in ["window_start", *keys])
        values = sorted(rows[at])
        for q in (10, 50, 95):
            v = r[f"value_p{q}_approx"]
            low, high = sum(x < v for x in values) / len(values), sum(x <= v for x in values) / len(values)
            assert low - 0.03 - 1 / len(values) <= q / 100 <= high + 0.03 + 1 / len(values)
        true = exact[at]["user_id_distinct"]
        assert abs(r.user_id_distinct_approx - true) <= max(1, 6 * 1.04 / math.sqrt(2**sketches.LG_K) * true)


def test_rollup_reads_no_log(spark, states):
    _, path = states
    merged = sketches.finish(sketches.merge_states(sketches.stored(spark, path, "2024-01-03", "2024-01-05"), "1 day"))
    files = merged.inputFiles()
    assert files and all("/profiles/" in f and "events" not in f for f in files)
    assert {r.window_start.strftime("%Y-%m-%d") for r in merged.collect()} == {"2024-01-03", "2024-01-04"}
    text = sketches.stored(spark, path, "2024-01-03")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in text or "PartitionFilters: [(cast(day" in text


def test_a_day_is_replaced(spark, states):
    ev, path = states
    before = {f for f in spark.read.parquet(path).inputFiles()}
    day = ev.where("to_date(ts) = '2024-01-04'")
    sketches.store(sketches.profile_state(day.withColumn("value", F.lit(1.0)), "ts", "30 minutes", ["event_type"], ["value"], ["user_id"]), path)
    after = {f for f in spark.read.parquet(path).inputFiles()}
    assert {f for f in before if "day=2024-01-04" not in f} == {f for f in after if "day=2024-01-04" not in f}
    sd = sketches.finish(sketches.merge_states(sketches.stored(spark, path, "2024-01-04", "2024-01-05"), "1 day")).first()
    assert (sd.value_min, sd.value_max, sd.value_sd, sd.n_rows) == (1.0, 1.0, 0.0, day.count())
    sketches.store(sketches.profile_state(day, "ts", "30 minutes", ["event_type"], ["value"], ["user_id"]), path)


def test_states_of_odd_rows(spark):
    """NULL times and keys, a column of NULLs, one row, large offsets (no cancellation), text values."""
    rows = [("2024-01-01 00:10:00", None, 1e9 + i, None, "a" * (i % 3)) for i in range(60)]
    rows += [(None, "x", 5.0, None, None), (None, "x", None, None, "b"), ("2024-01-01 01:10:00", "x", 7.0, None, "c")]
    df = spark.createDataFrame(rows, "ts string, k string, v double, none double, t string").withColumn("ts", F.col("ts").cast("timestamp"))
    state = sketches.profile_state(df, "ts", "30 minutes", ["k"], ["v", "none"], ["t"])
    out = {(r.window_start is None, r.k): r for r in sketches.finish(sketches.merge_states(state, "1 day", ["k"])).collect()}
    assert set(out) == {(False, None), (True, "x"), (False, "x")}
    big = out[False, None]
    assert big.n_rows == 60 and big.v_mean == 1e9 + 29.5 and abs(big.v_sd - math.sqrt(305)) < 1e-5 and big.t_distinct_approx == 3
    assert big.none_nulls == 60 and big.none_mean is None and big.none_p50_approx is None
    lost = out[True, "x"]
    assert (lost.n_rows, lost.v_nulls, lost.v_mean, lost.v_sd, lost.t_nulls, lost.t_distinct_approx) == (2, 1, 5.0, None, 1, 1)
    assert sketches.finish(sketches.merge_states(state.limit(0), "1 day", ["k"])).count() == 0


def test_salted_hot_window_merges_exactly(spark):
    """A third of all rows in one window: buffers merge per task, no task gathers them."""
    df = spark.range(0, 60_000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-01 00:00:00")).otherwise(F.lit("2024-01-02 00:00:00")).cast("timestamp").alias("ts"),
        (F.col("id") % 1000).cast("double").alias("v"), F.col("id").alias("u"),
    )
    out = {r.window_start.day: r for r in sketches.finish(sketches.profile_state(df, "ts", "30 minutes", [], ["v"], ["u"])).collect()}
    assert out[1].n_rows == 20_000 and abs(out[1].u_distinct_approx - 20_000) < 2000 and abs(out[1].v_p50_approx - 500) < 40

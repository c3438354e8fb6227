"""Sketches in stream state and the account of late rows, against a plain replay of the batches."""

from __future__ import annotations

import datetime as dt
import random
import uuid

from pyspark.sql import functions as F

from tabforge.operators import sketches
from tabforge.session import scratch_path
from tabforge.streaming import ingest

SCHEMA = "ts timestamp, k string, v double, u long"
DAY = dt.datetime(2024, 1, 1)


def replay(drops: list[list[tuple]], delay=dt.timedelta(hours=1), width=dt.timedelta(minutes=30)):
    """(windows, late, untimed): each drop is one run; a row is late if its window ended by the
    mark of the runs before it."""
    windows: dict = {}
    late = untimed = 0
    latest = None
    for rows in drops:
        mark = latest - delay if latest is not None else dt.datetime.min
        mark = mark.replace(microsecond=mark.microsecond // 1000 * 1000)
        for ts, k, v, u in rows:
            if ts is None:
                untimed += 1
                continue
            start = ts - (ts - DAY) % width
            if start + width <= mark:
                late += 1
            else:
                windows.setdefault((start, k), []).append((v, u))
        latest = max([r[0] for r in rows if r[0] is not None] + ([latest] if latest else []), default=None)
    return windows, late, untimed


def test_every_row_is_emitted_open_or_late(spark):
    rng = random.Random(4)
    drops = []
    for hour in range(0, 24, 2):  # each drop is two hours further on, a third of its rows come late
        rows = []
        for _ in range(250):
            back = rng.choice([0, 0, 1, 3, 9]) if hour else 0
            ts = DAY + dt.timedelta(hours=hour + 2 * rng.random() - back) if rng.random() > 0.02 else None
            rows.append((ts, rng.choice(["a", "b", None]), rng.choice([rng.gauss(0, 1), None]), rng.randrange(40)))
        drops.append(rows)
    base = scratch_path(spark, f"late/{uuid.uuid4().hex}")
    landing, sink, ckpt, ledger = (f"{base}/{x}" for x in ("in", "out", "ck", "ledger"))
    for rows in drops:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(landing)
        stream = ingest.file_stream(spark, landing, spark.createDataFrame([], SCHEMA).schema)
        ingest.run_counted(ingest.profile_state_stream(stream, "ts", "30 minutes", ["k"], ["v"], ["u"]), sink, ckpt, ledger)
    windows, late, untimed = replay(drops)
    told = ingest.account(spark, sink, ckpt, ledger, ["k"], ["v"], ["u"]).first()
    assert late > 200 and untimed > 10
    assert (told.input_rows, told.untimed_rows, told.late_rows) == (3000, untimed, late)
    assert told.emitted_rows + told.open_rows == sum(map(len, windows.values())) and told.open_rows > 0

    emitted, still = spark.read.parquet(sink), ingest.open_states(spark, ckpt, ["k"], ["v"], ["u"])
    assert emitted.select("window_start", "k").intersect(still.select("window_start", "k")).count() == 0
    got = sketches.finish(emitted.unionByName(still), (0.5,)).collect()
    assert {(r.window_start, r.k) for r in got} == set(windows) and len(got) == len(windows)
    for r in got:
        rows = windows[r.window_start, r.k]
        values = sorted(v for v, _ in rows if v is not None)
        assert (r.n_rows, r.v_nulls) == (len(rows), len(rows) - len(values))
        assert r.u_distinct_approx == len({u for _, u in rows})
        if values:  # few values: the sketch is exact
            assert r.v_p50_approx == values[-(-len(values) // 2) - 1]
            assert abs(r.v_mean - sum(values) / len(values)) < 1e-6
        else:
            assert r.v_p50_approx is None and r.v_mean is None
    # a run without new files changes nothing, and rolled-up states are whole
    stream = ingest.file_stream(spark, landing, spark.createDataFrame([], SCHEMA).schema)
    ingest.run_counted(ingest.profile_state_stream(stream, "ts", "30 minutes", ["k"], ["v"], ["u"]), sink, ckpt, ledger)
    assert ingest.account(spark, sink, ckpt, ledger, ["k"], ["v"], ["u"]).first() == told
    day = sketches.merge_states(emitted.unionByName(still), "1 day").agg(F.sum("n_rows")).first()[0]
    assert day == told.emitted_rows + told.open_rows


def test_many_values_stay_within_the_bound(spark):
    base = scratch_path(spark, f"late/{uuid.uuid4().hex}")
    rows = spark.range(0, 40_000, 1, 4).select(
        F.lit("2024-01-01 00:05:00").cast("timestamp").alias("ts"), F.lit("a").alias("k"),
        (F.pmod(F.xxhash64("id"), F.lit(10_000))).cast("double").alias("v"), F.col("id").alias("u"),
    )
    rows.write.parquet(f"{base}/in")
    stream = ingest.file_stream(spark, f"{base}/in", rows.schema, max_files_per_trigger=1)
    ingest.run_counted(ingest.profile_state_stream(stream, "ts", "30 minutes", ["k"], ["v"], ["u"]), f"{base}/out", f"{base}/ck", f"{base}/led")
    (r,) = ingest.open_windows(spark, f"{base}/ck", ["k"], ["v"], ["u"], (0.1, 0.9)).collect()
    assert r.n_rows == 40_000 and abs(r.u_distinct_approx - 40_000) < 4000
    assert abs(r.v_p10_approx - 1000) < 350 and abs(r.v_p90_approx - 9000) < 350
    assert ingest.counted(spark, f"{base}/led").agg(F.sum("rows")).first()[0] == 40_000


def test_a_missing_batch_is_told(spark):
    base = scratch_path(spark, f"late/{uuid.uuid4().hex}")
    spark.createDataFrame([(1, 5, 0, None, "x")], ingest.LEDGER).write.parquet(f"{base}/led")
    spark.createDataFrame([(DAY, "a", 1.0, 1)], SCHEMA).write.parquet(f"{base}/in")
    stream = ingest.file_stream(spark, f"{base}/in", spark.createDataFrame([], SCHEMA).schema)
    ingest.run_counted(ingest.profile_state_stream(stream, "ts", "30 minutes", ["k"], ["v"], ["u"]), f"{base}/out", f"{base}/ck", f"{base}/led2")
    assert ingest.account(spark, f"{base}/out", f"{base}/ck", f"{base}/led", ["k"], ["v"], ["u"]).first().late_rows is None
    assert ingest.account(spark, f"{base}/out", f"{base}/ck", f"{base}/led2", ["k"], ["v"], ["u"]).first().late_rows == 0

"""Duplicates over restarts: dropped from the checkpoint's state, which stays bounded."""

from __future__ import annotations

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tabforge.session import scratch_path
from tabforge.streaming import ingest

SCHEMA = "databricks_request_id string, request_time timestamp, v int"
DAY = dt.datetime(2024, 1, 1)


def deliver(spark, base, rows, rocksdb):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = ingest.file_stream(spark, f"{base}/in", spark.createDataFrame([], SCHEMA).schema)
    if rocksdb:
        with ingest.rocksdb_state(spark):
            ingest.run_available(ingest.dedup_requests(stream), f"{base}/out", f"{base}/ck")
    else:
        ingest.run_available(ingest.dedup_requests(stream), f"{base}/out", f"{base}/ck")
    return ingest.state_rows(spark, f"{base}/ck")


@pytest.mark.parametrize("rocksdb", [True, False])
def test_a_copy_after_a_restart_is_dropped(spark, rocksdb):
    base = scratch_path(spark, f"dedup/{uuid.uuid4().hex}")
    hours = [[(f"r{h}-{i}", DAY + dt.timedelta(hours=h, minutes=i % 60), i) for i in range(100)] for h in range(6)]
    sizes = []
    for h, rows in enumerate(hours):  # each hour with half of the hour before once more, then all of it again
        again = [(r[0], r[1] + dt.timedelta(seconds=5), -1) for r in hours[h - 1][::2]] if h else []
        sizes.append(deliver(spark, base, rows + again, rocksdb))
        sizes.append(deliver(spark, base, [(*r[:2], -1) for r in rows], rocksdb))
    got = spark.read.parquet(f"{base}/out")
    assert got.count() == 600 == got.select("databricks_request_id").distinct().count()
    assert got.where("v < 0").count() == 0
    assert max(sizes) <= 300 and sizes[-1] <= 300  # ids of the delay's span, not of all hours


def test_rocksdb_state_is_asked_for_inside_only(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    with ingest.rocksdb_state(spark):
        assert "RocksDB" in spark.conf.get(key)
    assert spark.conf.get(key, None) == before
    base = scratch_path(spark, f"dedup/{uuid.uuid4().hex}")
    deliver(spark, base, [("a", DAY, 1), ("a", DAY, 2), ("b", DAY, 3)], True)
    files = [f for d, _, fs in os.walk(f"{base}/ck/state".replace("file:", "")) for f in fs]
    assert any(f.endswith((".zip", ".changelog")) for f in files)
    assert spark.read.parquet(f"{base}/out").agg(F.count("*")).first()[0] == 2

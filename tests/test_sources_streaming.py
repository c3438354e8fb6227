"""Sinks, versions, incremental loads and streams re-run safely."""

from __future__ import annotations

import re
import uuid

import pytest
from pyspark.sql import functions as F

from tabforge.session import scratch_path
from tabforge.sources import tables, versions
from tabforge.streaming import ingest

SF = "/root/testdata/sf0.001"


def test_versions_and_time_travel(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_orderstatus")
    path = scratch_path(spark, f"t/{uuid.uuid4().hex}")
    assert versions.latest_version(spark, path) is None and versions.history(spark, path).count() == 0
    kinds = [o.filter(F.col("o_orderstatus") == s) for s in "FOP"]
    wrote = [versions.write_version(kinds[0], path), versions.write_version(kinds[1], path, "APPEND", mode="append"),
             versions.write_version(kinds[2], path), versions.write_version(o.limit(0), path, "CLEAR"), versions.write_version(kinds[0], path, mode="append")]
    assert wrote == [0, 1, 2, 3, 4] and versions.latest_version(spark, path) == 4
    n = [k.count() for k in kinds]
    sizes = [n[0], n[0] + n[1], n[2], 0, n[0]]
    assert [versions.read_version(spark, path, v).count() for v in range(5)] == sizes
    got = versions.history(spark, path).collect()
    assert [(r.version, r.operation, r.num_rows) for r in got] == [(v, op, sizes[v]) for v, op in reversed(list(enumerate(["WRITE", "APPEND", "WRITE", "CLEAR", "WRITE"])))]
    assert versions.read_version(spark, path).columns == o.columns
    plan = versions.read_version(spark, path, 1)._jdf.queryExecution().executedPlan().toString()
    assert "snapshot" in re.search(r"PartitionFilters: \[([^\]]*)\]", plan)[1]
    with pytest.raises(ValueError):
        versions.read_version(spark, path, 9)
    with pytest.raises(ValueError):
        versions.write_version(o.withColumn("version", F.lit(1)), path)


def test_lineage_gives_the_rows_a_run_used(spark):
    rows = spark.range(10).select("id", (F.col("id") * 2).alias("x"))
    path, lineage = (scratch_path(spark, f"{k}/{uuid.uuid4().hex}") for k in ("t", "lineage"))
    versions.write_version(rows.where("id < 4"), path)
    versions.log_input(spark, lineage, "a", "training", path)
    versions.write_version(rows.where("id >= 4"), path, mode="append")
    versions.log_input(spark, lineage, "a", "testing", path)
    versions.write_version(rows.where("id = 9"), path)
    versions.log_input(spark, lineage, "b", "training", path, 0)
    versions.log_input(spark, lineage, "c", "training", path)
    want = {("a", "training"): range(4), ("a", "testing"): range(10), ("b", "training"): range(4), ("c", "training"): [9]}
    for (run, context), ids in want.items():
        assert sorted(r.id for r in versions.read_by_lineage(spark, lineage, run, context).collect()) == list(ids)
    every = versions.rows_by_lineage(spark.read.parquet(lineage), path).collect()
    assert sorted((r.run_id, r.context, r.id) for r in every) == sorted((*k, i) for k, ids in want.items() for i in ids)
    with pytest.raises(ValueError):
        versions.read_by_lineage(spark, lineage, "c", "testing")


def test_bucketed_history_is_not_shuffled(spark):
    name = f"history_{uuid.uuid4().hex}"
    place = scratch_path(spark, f"tables/{name}")
    old = spark.range(5000).select(F.when(F.col("id") != 7, F.col("id")).alias("k"), F.lit("old").alias("v"), (F.col("id") % 4).alias("day"))
    load = lambda src: versions.load_new_bucketed(src, name, ["k"], 4, place, ["day"], "day")
    assert load(old.unionAll(old)) == 5000
    new = spark.range(4000, 6000).select(F.when(F.col("id") != 4001, F.col("id")).alias("k"), F.lit("new").alias("v"), (F.col("id") % 4).alias("day"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        plan = versions.new_rows_bucketed(new, name, ["k"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    lines = plan.split("\n")
    join = next(i for i, x in enumerate(lines) if "LeftAnti" in x and "SortMergeJoin" in x)
    scan = next(i for i, x in enumerate(lines) if i > join and f"{name}[" in x or "Bucketed: true" in x)
    assert "Bucketed: true" in lines[scan] and "SelectedBucketsCount: 4 out of 4" in lines[scan]
    right = next(i for i in range(scan, join, -1) if lines[i].lstrip(" :").startswith("+-") and "Sort [" in lines[i])
    assert not any("Exchange" in x for x in lines[right : scan + 1])
    assert load(new) == 1000  # 5000 to 5999; the NULL key is there already, as are the others
    assert load(new) == 0 and load(new.limit(0)) == 0
    got = spark.table(name).groupBy("v").agg(F.count("*"), F.count_distinct("k")).collect()
    assert sorted(map(tuple, got)) == [("new", 1000, 1000), ("old", 5000, 4999)]
    spark.sql(f"DROP TABLE {name}")


def test_digests_leave_unchanged_ranges_alone(spark):
    old = spark.range(20_000).select("id", F.lit("a").alias("v"), F.when(F.col("id") % 3 == 0, F.col("id")).alias("n"))
    new = old.where("id not in (5, 6)").withColumn("v", F.when(F.col("id") == 777, "b").otherwise(F.col("v")))
    new = new.unionAll(spark.createDataFrame([(20_001, None, None), (None, "x", 1)], "id long, v string, n long"))
    ranges = versions.changed_ranges(old, new, ["id"], coarse=16, fine=256)
    assert 1 <= ranges.count() <= 5  # one for each changed key at most, of 4,096
    got = versions.change_feed_digest(old, new, ["id"], coarse=16, fine=256)
    want = versions.change_feed(old, new, ["id"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str) and want.count() == 6
    # only the rows of those ranges meet in the join
    kept = versions._ranged(old, ["id"], ["v", "n"], 16, 256).join(ranges, ["_coarse", "_fine"], "left_semi").count()
    assert kept < 100
    same = versions.change_feed_digest(old, old.repartition(7), ["id"])
    assert same.count() == 0
    twice = versions.changed_ranges(old, old.unionAll(old.where("id = 9")), ["id"])
    assert twice.count() == 1  # a repeated row is a change of its range
    stored = [versions.digests(df, ["id"], coarse=16, fine=256) for df in (old, new)]
    by_store = versions.change_feed_digest(old, new, ["id"], None, *stored, coarse=16, fine=256)
    assert sorted(map(tuple, by_store.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_load_new_is_idempotent(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "value")
    target = scratch_path(spark, f"inc/{uuid.uuid4().hex}")
    assert versions.load_new(ev, target, ["event_id"]) == ev.count()
    assert versions.load_new(ev, target, ["event_id"]) == 0
    assert spark.read.parquet(target).count() == ev.count()


def test_change_feed_kinds(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, None), (4, "d")], "k int, v string")
    got = sorted(tuple(r) for r in versions.change_feed(old, new, ["k"]).collect())
    assert got == [(1, "a", "delete"), (2, "B", "update_postimage"), (2, "b", "update_preimage"), (4, "d", "insert")]


def test_csv_tokens(spark):
    path = scratch_path(spark, f"csv/{uuid.uuid4().hex}")
    with open_local(path) as f:
        f.write('a,b\n1,N/A\n2,none\n3,\n4,NULL\n"5","x,y"\n')
    df = tables.read_csv_na(spark, path, "a int, b string").orderBy("a").collect()
    assert [r["b"] for r in df] == [None, "none", None, None, "x,y"]


class open_local:
    """Write one small text file into a local scratch folder (tests only)."""

    def __init__(self, path):
        import os

        self.dir = path.replace("file:", "")
        os.makedirs(self.dir, exist_ok=True)
        self.f = open(os.path.join(self.dir, "part-0.csv"), "w")

    def __enter__(self):
        return self.f

    def __exit__(self, *a):
        self.f.close()


def test_stream_rerun_adds_nothing(spark):
    base = scratch_path(spark, f"s/{uuid.uuid4().hex}")
    landing, sink, ckpt = f"{base}/in", f"{base}/out", f"{base}/ck"
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "value")
    ev.write.parquet(landing)
    for _ in range(2):
        ingest.run_available(ingest.file_stream(spark, landing, ev.schema), sink, ckpt)
    assert spark.read.parquet(sink).count() == ev.count()


def test_stream_equals_batch_on_closed_windows(spark):
    from tabforge.operators import profile

    base = scratch_path(spark, f"s/{uuid.uuid4().hex}")
    landing, sink, ckpt = f"{base}/in", f"{base}/out", f"{base}/ck"
    ev = spark.read.parquet(f"{SF}/events.parquet").select("ts", "event_type", "value")
    ev.write.parquet(landing)
    stream = ingest.file_stream(spark, landing, spark.read.parquet(landing).schema)
    ingest.run_available(ingest.window_profile_stream(stream, "ts", "30 minutes", ["event_type"], ["value"]), sink, ckpt)
    streamed = spark.read.parquet(sink)
    batch = profile.window_profile(ev, "ts", "30 minutes", ["event_type"], ["value"], quantiles=())
    watermark = ev.agg(F.max(F.col("ts").cast("timestamp"))).first()[0]
    import datetime as dt

    closed = batch.filter(F.col("window_end") <= F.lit(watermark - dt.timedelta(hours=1)))
    cols = ["window_start", "event_type", "n_rows", "value_min", "value_max", "value_mean", "value_sd"]
    a = sorted(tuple(r) for r in streamed.select(*cols).collect())
    b = sorted(tuple(r) for r in closed.select(*cols).collect())
    assert a == b and len(a) > 0


def test_refresh_counts_are_whole(spark):
    from pyspark.sql import types as T

    from tabforge.plans.monitoring import monitoring_table, refresh_monitoring

    schema = T.StructType([T.StructField("a", T.LongType())])
    rows = [
        (f"r{i}", f"2024-01-01 00:{i:02d}:00", 5, '{"dataframe_records":[{"a":%d},{"a":%d}]}' % (i, i + 100),
         '{"predictions":[1,0]}' if i % 3 else "bad")
        for i in range(30)
    ]
    log = spark.createDataFrame(
        rows, "databricks_request_id string, request_time string, execution_duration_ms long, request string, "
        "response string",
    ).withColumn("request_time", F.col("request_time").cast("timestamp")).repartition(4)
    target = scratch_path(spark, f"mon/{uuid.uuid4().hex}")
    first = refresh_monitoring(log, target, "m", schema, first_prediction_only=False)
    assert (first.log_rows, first.flattened_rows, first.valid_rows) == (30, 60, 40)
    assert first.written_rows == 40 == monitoring_table(spark, target).count()
    assert first.skipped_requests == 10  # the "bad" responses: processed, all rows dropped
    again = refresh_monitoring(log, target, "m", schema)
    assert (again.log_rows, again.written_rows) == (0, 0)
    assert monitoring_table(spark, target).count() == 40


def test_refresh_does_not_depend_on_the_cut(spark):
    """Requests without predictions show only while none has one, in any grouping;
    repeats, NULL ids and an empty first run included."""
    from pyspark.sql import types as T

    from tabforge.plans.monitoring import monitoring_table, refresh_monitoring

    schema = T.StructType([T.StructField("a", T.LongType())])
    rows = [(None if i % 4 == 0 else f"r{i}", f"2024-01-01 00:{i:02d}:00", 5, '{"dataframe_records":[{"a":%d}]}' % i,
             "bad" if i < 5 else '{"predictions":[1]}') for i in range(10)]
    log = spark.createDataFrame(
        rows + rows[:3], "databricks_request_id string, request_time string, execution_duration_ms long, request string, "
        "response string",
    ).withColumn("request_time", F.col("request_time").cast("timestamp"))
    early = F.col("request_time") < "2024-01-01 00:05:00"
    results = []
    for cuts in ([F.lit(True)], [early, ~early], [F.lit(False), early, ~early, F.lit(True)]):
        target = scratch_path(spark, f"mon/{uuid.uuid4().hex}")
        for k, cut in enumerate(cuts):
            refresh_monitoring(log.where(cut), target, "m", schema)
            if len(cuts) == 2 and k == 0:
                assert monitoring_table(spark, target).count() == 5  # no prediction so far: all rows
        results.append(sorted(r["a"] for r in monitoring_table(spark, target).collect()))
    assert results == [[5, 6, 7, 8, 9]] * 3


def test_new_rows_null_and_repeated_keys(spark):
    target = scratch_path(spark, f"inc/{uuid.uuid4().hex}")
    src = spark.createDataFrame([(None, 1), (1, 2), (1, 2), (2, 3)], "k int, v int")
    assert [versions.load_new(src.limit(0), target, ["k"])] + [versions.load_new(src, target, ["k"]) for _ in range(3)] == [0, 3, 0, 0]
    old = spark.createDataFrame([(None, "a")], "k int, v string")
    assert versions.change_feed(old, old, ["k"]).count() == 0


def test_large_csv_is_split_and_typed(spark):
    path = scratch_path(spark, f"csv/{uuid.uuid4().hex}")
    spark.range(0, 60_000, 1, 1).select("id", (F.col("id") / 3).alias("x"), F.lit("N/A").alias("none"), (F.col("id") > 5).alias("b")).coalesce(
        1).write.option("header", True).csv(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        df = tables.read_csv_na(spark, path)
        assert df.rdd.getNumPartitions() >= 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [t for _, t in df.dtypes] == ["bigint", "double", "string", "boolean"]
    assert df.agg(F.sum("id")).first()[0] == 60_000 * 59_999 // 2


def test_monitoring_time_range_prunes_day_partitions(spark):
    from pyspark.sql import types as T

    from tabforge.plans.monitoring import monitoring_table, refresh_monitoring

    schema = T.StructType([T.StructField("a", T.LongType())])
    rows = [(f"r{i}", f"2024-01-{1 + i % 5:02d} 10:00:00", 5, '{"dataframe_records":[{"a":%d}]}' % i,
             '{"predictions":[1]}') for i in range(20)]
    log = spark.createDataFrame(
        rows, "databricks_request_id string, request_time string, execution_duration_ms long, request string, "
        "response string",
    ).withColumn("request_time", F.col("request_time").cast("timestamp"))
    target = scratch_path(spark, f"mon/{uuid.uuid4().hex}")
    refresh_monitoring(log, target, "m", schema)
    part = monitoring_table(spark, target, "2024-01-02 00:00:00", "2024-01-03 00:00:00")
    assert part.count() == 4
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = part._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan)[1]
    assert "day#" in filters and ">=" in filters and "<=" in filters


def _files(path):
    import os

    place = path.replace("file:", "")
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(place) for f in fs if f.endswith(".parquet")}


def test_reload_replaces_its_partitions_only(spark):
    path = scratch_path(spark, f"reload/{uuid.uuid4().hex}")
    rows = spark.range(1000).select("id", (F.col("id") % 5).cast("string").alias("day"), F.lit(0).alias("v"))
    tables.overwrite_partitions(rows, path, ["day"])
    before = _files(path)
    for part in (rows.where("day = '3' and id < 100"), rows.where("day = '3'"), rows.where("day = '3'")):
        tables.overwrite_partitions(part.withColumn("v", F.lit(1)), path, ["day"])
    tables.overwrite_partitions(rows.limit(0), path, ["day"])
    after = _files(path)
    others = {f: t for f, t in before.items() if "day=3" not in f}
    assert others and others == {f: t for f, t in after.items() if "day=3" not in f}
    got = spark.read.parquet(path).groupBy("day", "v").count().collect()
    assert sorted((str(r.day), r.v, r["count"]) for r in got) == [(str(d), int(d == 3), 200) for d in range(5)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"


def test_reload_of_a_named_table(spark):
    name = f"reload_{uuid.uuid4().hex}"
    place = scratch_path(spark, f"tables/{name}")
    rows = spark.range(90).select("id", (F.col("id") % 3).alias("day"), F.lit("a").alias("v"))
    tables.overwrite_partitions(rows, name, ["day"], location=place)
    part = rows.where("day = 1").withColumn("v", F.lit("b")).select("day", "v", "id")  # its columns in another order
    for _ in range(2):
        tables.overwrite_partitions(part, name, ["day"])
    tables.overwrite_partitions(part.limit(0), name, ["day"])
    got = spark.table(name).groupBy("day", "v").agg(F.count("*").alias("n"), F.sum("id").alias("s")).collect()
    assert sorted(map(tuple, got)) == [(0, "a", 30, 1305), (1, "b", 30, 1335), (2, "a", 30, 1365)]
    spark.sql(f"DROP TABLE {name}")


def test_write_once_parameters(spark):
    from tabforge.operators import runs

    logged = spark.createDataFrame([("r", "a", "1"), ("r", "b", None), ("r", None, "n"), (None, "a", "2")], "run_id string, key string, value string")
    new = [("r", "a", "1"), ("r", "a", "2"), ("r", "b", None), ("r", "b", "x"), ("r", None, "n"), ("r", None, "m"), (None, "a", "2"), (None, None, "q"),
           ("r", "new", "2"), ("r", "new", "1"), ("r", "new", "1"), ("s", "a", "9"), ("s", "z", None), ("s", "z", "1")]
    got = runs.merge_params(logged, spark.createDataFrame(new, logged.schema)).collect()
    want = dict.fromkeys(new, "rejected")
    want |= dict.fromkeys([("r", "a", "1"), ("r", "b", None), ("r", None, "n"), (None, "a", "2")], "unchanged")
    want |= dict.fromkeys([(None, None, "q"), ("r", "new", "1"), ("s", "a", "9"), ("s", "z", None)], "accepted")
    assert sorted(((r.run_id, r.key, r.value, r.status) for r in got), key=str) == sorted(((*n, want[n]) for n in new), key=str)
    ordered = spark.createDataFrame([("r", "k", "b", 1), ("r", "k", "a", 2)], "run_id string, key string, value string, t int")
    assert {(r.value, r.status) for r in runs.merge_params(logged, ordered, "t").collect()} == {("b", "accepted"), ("a", "rejected")}

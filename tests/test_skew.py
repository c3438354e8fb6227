"""Hot keys: a group holding a third of the rows is spread, not piled up."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.operators import profile
from tabforge.plans import prefix
from tabforge.plans.prefix import dense_index, ranged


def _hot(spark, n=30_000):
    # key 0 holds a third of the rows; the rest spread over 1000 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("k"),
        F.col("id").alias("t"),
    )


def test_hot_group_spreads_over_ranges(spark):
    df = _hot(spark)
    b = ranged(df, [F.col("k"), F.col("t")], 16)
    sizes = [r["count"] for r in b.groupBy("_range").count().collect()]
    assert len(sizes) >= 14 and max(sizes) <= 3 * (30_000 / 16)
    assert b.filter(F.col("k") == 0).select("_range").distinct().count() >= 5


def test_strings_with_a_common_start_spread(spark):
    df = spark.range(20_000).select(F.concat(F.lit("https://www.example.org/a/very/long/prefix/"), F.col("id")).alias("url"))
    sizes = [r["count"] for r in ranged(df, [F.col("url")], 16).groupBy("_range").count().collect()]
    assert len(sizes) >= 14 and max(sizes) <= 3 * (20_000 / 16)


def test_quantiles_are_exact_in_big_groups(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 != 0, F.lit("k")).alias("k"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("ts"),
        (F.hash("id") / 7.0).alias("x"),
    )
    values = sorted(r["x"] for r in df.where("k is null").select("x").collect())
    for salt in (0, 4):
        both = df.withColumn("y", F.col("x"))
        rows = profile.window_profile(both, "ts", "30 minutes", ["k"], ["x"], ["y"], quantiles=(0.5, 0.99), salt=salt).collect()
        row = next(r for r in rows if r["k"] is None)
        assert row["n_rows"] == 10_000 and row["x_p50"] == values[4_999] and row["x_p99"] == values[9_899]
        assert row["y_distinct"] == len(set(values))


def test_rows_without_a_time_keep_a_window(spark):
    df = spark.createDataFrame([("2024-01-01 00:10:00", 1.0), (None, 2.0), (None, 4.0)], "ts string, x double")
    rows = profile.window_profile(df.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "30 minutes", [], ["x"]).collect()
    got = {r["window_start"] is None: (r["n_rows"], r["x_mean"], r["x_p50"]) for r in rows}
    assert got == {False: (1, 1.0, 1.0), True: (2, 3.0, 2.0)}


def test_dense_index_exact_for_hot_group(spark):
    df = _hot(spark)
    idx = dense_index(df, "t", groups=["k"], buckets=16)
    hot = idx.filter(F.col("k") == 0).agg(F.min("row_index"), F.max("row_index"), F.count_distinct("row_index"))
    assert tuple(hot.first()) == (0, 9_999, 10_000)


def test_salted_profile_spreads_hot_key_and_stays_exact(spark):
    df = _hot(spark).repartition(8).select(
        "k", (F.lit("2024-01-01 00:00:00").cast("timestamp")).alias("ts"), (F.col("t") % 97).cast("double").alias("x")
    )
    salted = profile.window_profile(df, "ts", "30 minutes", ["k"], ["x"], salt=8).filter("k = 0").first()
    plain = profile.window_profile(df, "ts", "30 minutes", ["k"], ["x"]).filter("k = 0").first()
    for c in ("n_rows", "x_min", "x_max", "x_mean", "x_sd"):
        assert salted[c] == plain[c], c
    salts = df.filter("k = 0").select((F.spark_partition_id() % 8).alias("s")).distinct().count()
    assert salts == 8


def test_dense_index_spreads_copies(spark):
    """A third of the rows are copies of one: they are dealt over the ranges, and every
    row of a group still has a number of its own."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.lit("g").alias("g")
    )
    out = prefix.dense_index(rows, "k", ["g"], buckets=8, into="i", total="n").withColumn("part", F.spark_partition_id())
    got = out.agg(F.count("*"), F.count_distinct("i"), F.min("i"), F.max("i"), F.min("n"), F.max("n")).first()
    assert tuple(got) == (30_000, 30_000, 0, 29_999, 30_000, 30_000)
    keys = [F.col("g"), F.col("k"), F.col("_print"), F.col("_place")]
    src = rows.withColumn("_print", prefix.row_print(rows)).sortWithinPartitions("g", "k", "_print")
    dealt = prefix.ranged(src.withColumn("_place", F.monotonically_increasing_id()), keys, 8)
    sizes = [r["count"] for r in dealt.groupBy("_range").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 30_000 / 8 * 1.5
    ordered = out.orderBy("i").select("k").collect()
    assert [r.k for r in ordered] == sorted(r.k for r in ordered)

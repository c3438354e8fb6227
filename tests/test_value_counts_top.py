"""Most frequent values by sketch and exact recount, against counting everything."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tabforge.operators import clean, metrics


def same(df, col, n, track=metrics.TRACK):
    got = [tuple(r) for r in metrics.value_counts_top(df, col, n, track=track).collect()]
    want = [tuple(r) for r in metrics.value_counts(df, col, n=n).collect()]
    assert got == want and len(got) == min(n, df.select(col).distinct().count())
    return got


def zipf(spark, n=200_000):
    """Value v about n / v times, 40,000 distinct, spread over 12 partitions; some NULLs."""
    v = F.floor(F.pow(F.lit(40_000.0), F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 1_000_000.0)).cast("long")
    return spark.range(0, n, 1, 12).select(F.when(F.col("id") % 11 != 0, F.concat(F.lit("word "), v)).alias("w"), v.alias("v"))


@pytest.mark.parametrize("n", [1, 10, 25])
def test_frequent_values_are_exact(spark, n):
    df = zipf(spark)
    got = [r[0] for r in same(df, "w", n)]
    assert got[:2] == [None, "word 1"][:n]
    same(df, "v", n)


def test_only_candidates_are_counted(spark):
    df = zipf(spark)
    rows, hashes = metrics.top_candidates(df, F.col("w"), 1024)
    assert rows == 200_000 and len(hashes) <= 1024 < df.select("w").distinct().count() / 10
    least = metrics.value_counts(df, "w", n=10).agg(F.min("count")).first()[0]
    assert least > metrics.unseen_at_most(rows, 1024)  # so the first sketch proves the result


def test_the_bound_holds_for_what_a_sketch_leaves_out(spark):
    for track in (8, 64, 512):
        for df in (zipf(spark, 50_000), spark.range(0, 50_000, 1, 9).select((F.col("id") % 5000).alias("v"), F.lit("x").alias("w"))):
            rows, hashes = metrics.top_candidates(df, F.col("v"), track)
            left = df.where(~F.xxhash64("v").isin(hashes)) if hashes else df
            most = left.groupBy("v").count().agg(F.max("count")).first()[0] or 0
            assert most <= metrics.unseen_at_most(rows, track)


def test_even_values_fall_back_to_counting_all(spark, monkeypatch):
    monkeypatch.setattr(metrics, "MOST_TRACKED", 64)
    df = spark.range(0, 30_000, 1, 6).select((F.col("id") % 3000).alias("v"))
    assert [r[0] for r in same(df, "v", 5, track=8)] == [0, 1, 2, 3, 4]


def test_small_and_odd_inputs(spark):
    df = spark.createDataFrame([(None,), ("",), ("a",), ("a",), (None,), ("b",)], "`odd name` string")
    assert same(df, "odd name", 10) == [(None, 2, 0.333333), ("a", 2, 0.333333), ("", 1, 0.166667), ("b", 1, 0.166667)]
    assert metrics.value_counts_top(df.limit(0), "odd name", 3).count() == 0
    nan = spark.createDataFrame([(float("nan"),), (float("nan"),), (0.0,), (-0.0,), (0.0,)], "v double")
    assert [r["count"] for r in metrics.value_counts_top(nan, "v", 2).collect()] == [3, 2]


def test_collapse_to_top(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 3 + [(None,)] * 4 + [("c",)], "v string")
    got = clean.collapse_to_top(df, "v", 2, into="w").groupBy("v", "w").count().collect()
    assert sorted(map(tuple, got), key=str) == [("Unknown", "Unknown", 4), ("a", "a", 5), ("b", "Other", 3), ("c", "Other", 1)]

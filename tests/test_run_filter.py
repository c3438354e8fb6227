"""Run search by filter text: what it returns, what reaches the scan, what it refuses."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tabforge.operators.run_filter import FilterError, run_filter, run_order, search

SCHEMA = "run_id string, run_name string, status string, start_time long, `odd name` string, metrics map<string,double>, params map<string,string>, tags map<string,string>"
ROWS = [
    ("a", "one", "FINISHED", 10, "x", {"auc": 0.5, "my key": 1.0}, {"n": "1"}, {"job.source.type": "JOB", "it's": "q"}),
    ("b", "two", "FINISHED", 30, "y", {"auc": float("nan")}, {"n": None}, {"job.source.type": "LOCAL"}),
    ("c", "Two-3", "FAILED", 30, None, {"auc": 0.9}, {}, {}),
    ("d", None, None, None, "it's", None, None, None),
]


@pytest.fixture(scope="module")
def runs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("runs") / "runs.parquet")
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize(
    "text,want",
    [
        (None, "abcd"), ("  ", "abcd"), ("status = 'FINISHED'", "ab"), ("status != 'FINISHED'", "c"), ("start_time >= 30", "bc"),
        ("start_time<3e1 and status='FINISHED'", "a"), ("run_name LIKE 't%'", "b"), ("run_name ilike 't%'", "bc"), ("run_name NOT LIKE 't%'", "ac"),
        ("metrics.auc > 0.5", "c"), ("metrics.auc != 0.5", "c"), ("metrics.auc is null", "bd"), ("metrics.auc IS  NOT NULL", "ac"),
        ("metrics.\"my key\" = 1", "a"), ("metrics.`my key` <= +1.0", "a"), ("metric.'my key' > -1", "a"),
        ("tags.job.source.type != 'JOB'", "b"), ("tags.job.source.type IN ('JOB', \"LOCAL\")", "ab"), ("tags.\"it's\" = 'q'", "a"),
        ("params.n = '1'", "a"), ("params.n is null", "bcd"), ("`odd name` = 'it''s'", "d"), ("attributes.`odd name` in ('x','y')", "ab"),
        ("run_id not in ('a')", "bcd"), ("status='FINISHED'  AND\tstart_time > 10 AND run_id <> 'z'", "b"),
    ],
)
def test_filters(runs, text, want):
    assert "".join(sorted(r.run_id for r in search(runs, text).collect())) == want


@pytest.mark.parametrize(
    "text,position",
    [
        ("status == 'x'", 8), ("status = FINISHED", 9), ("status = 'x", 9), ("start_time > '5'", 13), ("status > 5", 9), ("nope = 'x'", 0),
        ("status = 'x' OR status = 'y'", 13), ("status = 'x' AND", 13), ("status = 'x' AND  ", 18), ("AND status = 'x'", 0),
        ("status = 'x' status = 'y'", 13), ("metrics = 1", 0), ("other.key = 'x'", 0), ("start_time LIKE '3%'", 11), ("status IN ()", 11),
        ("status IN ('x'", 14), ("metrics.auc > 1x", 14), ("status", 6), ("metrics.auc", 11), ("status = 'x' ; drop", 13), ("tags. = 'x'", 0),
    ],
)
def test_bad_filters_tell_their_position(runs, text, position):
    with pytest.raises(FilterError) as e:
        run_filter(text, runs.schema)
    assert e.value.position == position and f"position {position}" in str(e.value)


def test_scalar_comparisons_reach_the_scan(spark, runs):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    out = search(runs, "status = 'FINISHED' AND start_time > 5 AND run_id IN ('a', 'b') AND metrics.auc > 0.1")
    plan = out._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters") :].split("\n")[0]
    for part in ("EqualTo(status,FINISHED)", "GreaterThan(start_time,5)", "In(run_id, [a,b])"):
        assert part in pushed


def test_order_and_limit(runs):
    assert [r.run_id for r in search(runs).collect()] == ["b", "c", "a", "d"]
    assert [r.run_id for r in search(runs, "", ["start_time ASC", "run_id desc"]).collect()] == ["a", "c", "b", "d"]
    assert [r.run_id for r in search(runs, "", ["metrics.auc DESC"], 2).collect()] == ["c", "a"]
    assert [r.run_id for r in search(runs, "", ["tags.`job.source.type`"], 2).collect()] == ["a", "b"]
    for text in ("start_time UP", "nope ASC", "start_time ASC DESC"):
        with pytest.raises(FilterError):
            run_order(text, runs.schema)


def test_a_filter_is_one_column(runs):
    out = runs.withColumn("hit", F.coalesce(run_filter("metrics.auc >= 0.5", runs.schema), F.lit(False)))
    assert {r.run_id: r.hit for r in out.collect()} == {"a": True, "b": False, "c": True, "d": False}

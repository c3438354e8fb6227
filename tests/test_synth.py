"""Generator cases: reference-shaped output, weights aligned to values,
constant timestamps, drift."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tabforge.operators import clean, synth
from tests.test_clean_golden import CAT, FIVE, NUM, RAW_SCHEMA


def _cleaned(spark):
    return clean.clean(spark.createDataFrame(FIVE, RAW_SCHEMA), clean.entity_spec([], []))


@pytest.mark.parametrize("n, drift", [(10, False), (10, True), (5, False)])
def test_row_count_and_columns(spark, n, drift):
    src = clean.clean(spark.createDataFrame(FIVE, RAW_SCHEMA), clean.entity_spec(NUM, CAT))
    spec = synth.SynthSpec(n=n, seed=1, row_id=None, floor_cols={"Height": 0.1, "Weight": 0.1}, drift=drift,
                           drift_scale={"Height": 1.5, "Weight": 1.5},
                           drift_redraw={"Gender": [("Male", 0.7), ("Female", 0.3)]})
    out = synth.synthesize(src, spec)
    assert out.count() == n
    assert set(out.columns) == set(src.columns)
    heights = [r["Height"] for r in out.collect()]
    assert all(h is None or h >= 0.1 for h in heights)
    if drift:
        assert {r["Gender"] for r in out.collect()} <= {"Male", "Female"}


def test_target_and_id_only(spark):
    src = _cleaned(spark).select("Alive", "Id")
    out = synth.synthesize(src, synth.SynthSpec(n=10, seed=2, row_id=None, id_base=1_700_000_000_000))
    rows = out.collect()
    assert out.columns == ["Alive", "Id"] and len(rows) == 10
    assert sorted(int(r["Id"]) for r in rows) == list(range(1_700_000_000_000, 1_700_000_000_010))


def test_weights_follow_values(spark):
    # 'rare' first in value order, 'common' holds 75 %.
    src = spark.range(400).select(F.when(F.col("id") < 100, "a_rare").otherwise("b_common").alias("v"))
    out = synth.synthesize(src, synth.SynthSpec(n=20000, seed=3, id_col=None, row_id=None))
    share = out.filter(F.col("v") == "b_common").count() / 20000
    assert share == pytest.approx(0.75, abs=0.02)


def test_null_is_a_category(spark):
    src = spark.range(100).select(F.when(F.col("id") < 50, None).otherwise("x").alias("v"))
    out = synth.synthesize(src, synth.SynthSpec(n=4000, seed=4, id_col=None, row_id=None))
    assert out.filter(F.col("v").isNull()).count() / 4000 == pytest.approx(0.5, abs=0.04)


def test_constant_timestamp(spark):
    t = dt.datetime(2024, 1, 2, 3, 4, 5)
    src = spark.createDataFrame([(t,), (t,)], "ts timestamp")
    out = synth.synthesize(src, synth.SynthSpec(n=5, seed=5, id_col=None, row_id=None)).collect()
    assert {r["ts"] for r in out} == {t}


def test_moments_match(spark):
    src = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").select("l_quantity")
    out = synth.synthesize(src, synth.SynthSpec(n=60000, seed=6, id_col=None, row_id=None))
    a = src.agg(F.avg("l_quantity"), F.stddev("l_quantity")).first()
    b = out.agg(F.avg("l_quantity"), F.stddev("l_quantity")).first()
    assert b[0] == pytest.approx(a[0], rel=0.02) and b[1] == pytest.approx(a[1], rel=0.02)

"""Plan-shape guards: no cartesian or nested-loop joins anywhere in the
catalog, filters reach the Parquet scan, projections prune columns."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from tabforge.plans import prefix

SF = "/root/testdata/sf0.001"
NAMES = sorted(entry.queries())


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_cartesian_or_nested_loop_join(spark, name):
    plan = _plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("keep_in", "In(o_orderpriority"),
        ("binarise_target", "In(o_orderstatus"),
        ("incremental_load", "ts"),
    ],
)
def test_filters_pushed_to_scan(spark, name, pushed):
    plan = _plan(entry.queries()[name](spark, SF))
    assert "PushedFilters" in plan and pushed in plan, plan


def test_projection_pruned(spark, monkeypatch):
    """The whole plan, its checkpoint taken out: every scan reads only what the profile needs."""
    monkeypatch.setattr(prefix, "materialise", lambda df: df)
    plan = _plan(entry.queries()["window_profile"](spark, SF))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert scans and all("event_id" not in s and "ts:" in s for s in scans), scans


def test_profile_reads_its_source_once(spark, monkeypatch):
    """Behind the checkpoint of the counts there is no scan left, before it there is one."""
    seen = []
    kept = prefix.materialise
    monkeypatch.setattr(prefix, "materialise", lambda df: (seen.append(_plan(df)), kept(df))[1])
    last = _plan(entry.queries()["window_profile"](spark, SF))
    assert len(seen) == 1 and seen[0].count("FileScan parquet") == 1 and "FileScan parquet" not in last

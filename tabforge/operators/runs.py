"""Experiment run logs as tables.

A run table has one row per run: ``run_id, run_name, status, start_time,
end_time`` (epoch ms), ``metrics map<string,double>``, ``params
map<string,string>``, ``tags map<string,string>`` and ``inputs
array<struct<context,name,version>>``.  Metric history is a long table
``(run_id, key, step, value, ts)``.  Everything is filters, algebraic
aggregates (partial before the shuffle) and small joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.plans.prefix import dense_index


def search_runs(
    runs: DataFrame,
    status: str | None = None,
    started_after: int | None = None,
    name_like: str | None = None,
    metric_gt: dict[str, float] | None = None,
    tag_eq: dict[str, str] | None = None,
    tag_ne: dict[str, str] | None = None,
    order_by: list[Column] | None = None,
) -> DataFrame:
    """AND-ed run filters (R1) with an ordering (R2).

    A missing metric or tag makes its predicate NULL, so the run is not
    returned (the tracking service's rule); scalar columns push down.
    """
    cond = F.lit(True)
    if status is not None:
        cond = cond & (F.col("status") == status)
    if started_after is not None:
        cond = cond & (F.col("start_time") > F.lit(started_after))
    if name_like is not None:
        cond = cond & F.col("run_name").like(name_like)
    for k, v in (metric_gt or {}).items():
        cond = cond & (F.try_element_at(F.col("metrics"), F.lit(k)) > F.lit(v))
    for k, v in (tag_eq or {}).items():
        cond = cond & (F.try_element_at(F.col("tags"), F.lit(k)) == F.lit(v))
    for k, v in (tag_ne or {}).items():
        cond = cond & (F.try_element_at(F.col("tags"), F.lit(k)) != F.lit(v))
    out = runs.filter(F.coalesce(cond, F.lit(False)))
    return out.orderBy(*(order_by or [F.desc("start_time"), F.asc("run_id")]))


def find_by_tag(runs: DataFrame, key: str, value: str, n: int = 1) -> DataFrame:
    """First ``n`` runs (latest start first) carrying ``tags[key] = value``."""
    return search_runs(runs, tag_eq={key: value}).limit(n)


def metric_history(
    events: DataFrame, run_col: str, key_col: str, value_col: str, ts_col: str, tiebreak_col: str | None = None
) -> DataFrame:
    """Long metric table with a 0-based step per (run, key) in time order.

    The step is a dense index per (run, key) computed with the bucketed
    prefix pattern, so one very long run is spread over many tasks;
    ``tiebreak_col`` (e.g. an event id) orders events with equal times.
    """
    src = events.select(
        F.col(run_col).alias("run_id"),
        F.col(key_col).alias("key"),
        F.col(value_col).cast("double").alias("value"),
        F.col(ts_col).alias("ts"),
        *([F.col(tiebreak_col).alias("_tb")] if tiebreak_col else []),
    )
    idx = dense_index(
        src, "ts", groups=["run_id", "key"], into="step", tiebreak=["_tb"] if tiebreak_col else None
    )
    return idx.drop("_tb")


def metric_latest(history: DataFrame) -> DataFrame:
    """Latest value per (run, key): ``max_by(value, (step, ts))``."""
    return history.groupBy("run_id", "key").agg(
        F.max_by("value", F.struct("step", "ts")).alias("value"), F.max("step").alias("step")
    )


def merge_params(existing: DataFrame, new: DataFrame, order_col: str | None = None) -> DataFrame:
    """Write-once parameters (R5): a new key is ``accepted``, the same value
    again is ``unchanged``, a different value for a logged key is
    ``rejected``.

    NULL is a run, a key or a value like any other: a key logged with NULL is logged.  Of
    several values for one new key in a batch the first by ``order_col`` (NULL first, then the
    smaller value) is accepted, on each row that has it; the others are rejected.  One
    aggregate finds what holds each key, one join brings it to the new rows."""
    by = F.col(order_col) if order_col else F.lit(None).cast("int")
    here = new.select("run_id", "key", F.lit(1).alias("_turn"), by.alias("_order"), "value")
    logged = existing.select("run_id", "key", F.lit(0).alias("_turn"), F.lit(None).cast(here.schema["_order"].dataType).alias("_order"), "value")
    holder = logged.unionByName(here).groupBy("run_id", "key").agg(F.min(F.struct("_turn", "_order", "value")).alias("_held"))
    holder = holder.select(F.col("run_id").alias("_run"), F.col("key").alias("_key"), "_held")
    j = new.join(holder, new["run_id"].eqNullSafe(F.col("_run")) & new["key"].eqNullSafe(F.col("_key")), "left")
    same = F.col("value").eqNullSafe(F.col("_held.value"))
    status = F.when(~same, "rejected").when(F.col("_held._turn") == 0, "unchanged").otherwise("accepted")
    return j.select("run_id", "key", "value", status.alias("status"))


def rollup_children(runs: DataFrame, parent_col: str, metric: str) -> DataFrame:
    """Parent summary of nested runs (R6): children, best metric and the
    child holding it — algebraic aggregates, partial before the shuffle."""
    m = F.try_element_at(F.col("metrics"), F.lit(metric))
    return runs.groupBy(parent_col).agg(
        F.count(F.lit(1)).alias("n_children"),
        F.max(m).alias(f"best_{metric}"),
        F.max_by(F.col("run_id"), F.struct(m, F.col("run_id"))).alias("best_run_id"),
    )


def input_by_context(runs: DataFrame, context: str, inputs_col: str = "inputs") -> Column:
    """The first dataset input carrying ``context`` (R7), NULL if none."""
    return F.get(F.filter(F.col(inputs_col), lambda x: x["context"] == F.lit(context)), 0)


def latest_by(df: DataFrame, key: str, version: str, order: str) -> DataFrame:
    """Latest version per key by ``order`` and the highest version."""
    return df.groupBy(key).agg(
        F.max_by(F.col(version), F.struct(F.col(order), F.col(version))).alias("latest_version"),
        F.max(version).alias("max_version"),
        F.count(F.lit(1)).alias("n_versions"),
    )

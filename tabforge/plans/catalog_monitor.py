"""Catalog: monitoring queries — window profiles, class shares, drift."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tabforge.functions.timefn import ts_text
from tabforge.operators import drift, profile, sketches
from tabforge.operators.payload import parse_json
from tabforge.plans.registry import register
from tabforge.session import scratch_path
from tabforge.sources.tables import load

# Base / current cut of the events month used by every drift query.
DRIFT_CUT = "2024-01-16 00:00:00"


_WINDOW_PROFILE_SQL = """
WITH e AS (
  SELECT time_bucket(INTERVAL '30 minutes', ts) AS ws, event_type, user_id, value,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
  FROM events)
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(ws + INTERVAL '30 minutes', '%Y-%m-%d %H:%M:%S') AS window_end,
       event_type,
       count(*) AS n_rows,
       count(*) FILTER (WHERE value IS NULL) AS value_nulls,
       min(value) AS value_min, max(value) AS value_max,
       round(avg(value), 6) AS value_mean, round(stddev_samp(value), 6) AS value_sd,
       quantile_disc(value, 0.5) AS value_p50,
       count(*) FILTER (WHERE k IS NULL) AS k_nulls,
       min(k) AS k_min, max(k) AS k_max,
       round(avg(k), 6) AS k_mean, round(stddev_samp(k), 6) AS k_sd,
       quantile_disc(k, 0.5) AS k_p50,
       count(*) FILTER (WHERE user_id IS NULL) AS user_id_nulls,
       count(DISTINCT user_id) AS user_id_distinct
FROM e GROUP BY ws, event_type
"""


def _events_with_k(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    return parse_json(ev, "props", "k long", into="p").select(
        "ts", "event_type", "user_id", "value", F.col("p.k").cast("double").alias("k")
    )


def _text_windows(df):
    return df.withColumns(
        {"window_start": ts_text(F.col("window_start")), "window_end": ts_text(F.col("window_end"))}
    )


@register("window_profile", oracle=_WINDOW_PROFILE_SQL)
def q_window_profile(spark, sf_dir):
    """Flagship: events → parse props JSON → 30-minute profile per event type."""
    ev = _events_with_k(spark, sf_dir)
    prof = profile.window_profile(
        ev, "ts", "30 minutes", keys=["event_type"], num_cols=["value", "k"], cat_cols=["user_id"]
    )
    return _text_windows(prof)


_ROLLUP_SQL = """
WITH e AS (
  SELECT time_bucket(INTERVAL '{width}', ts) AS ws, {key}, user_id, value,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
  FROM events)
SELECT '{width}' AS width, strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n_rows,
       count(*) FILTER (WHERE value IS NULL) AS value_nulls, min(value) AS value_min, max(value) AS value_max,
       round(avg(value), 6) AS value_mean, round(stddev_samp(value), 6) AS value_sd,
       count(*) FILTER (WHERE k IS NULL) AS k_nulls, min(k) AS k_min, max(k) AS k_max,
       round(avg(k), 6) AS k_mean, round(stddev_samp(k), 6) AS k_sd,
       count(*) FILTER (WHERE user_id IS NULL) AS user_id_nulls, true AS p50_in_range, true AS distinct_in_range
FROM e GROUP BY ws, event_type
"""


@register(
    "profile_rollup",
    oracle="SELECT * FROM ("
    + _ROLLUP_SQL.format(width="1 day", key="event_type")
    + ") UNION ALL SELECT * FROM ("
    + _ROLLUP_SQL.format(width="6 hours", key="'all' AS event_type")
    + ")",
)
def q_profile_rollup(spark, sf_dir):
    """30-minute states stored by day (one day of them twice), rolled up from the stored table
    alone: to days by event type, and to six hours over all types."""
    ev = _events_with_k(spark, sf_dir)
    path = scratch_path(spark, f"profiles/{uuid.uuid4().hex}")
    state = sketches.profile_state(ev, "ts", "30 minutes", ["event_type"], ["value", "k"], ["user_id"])
    sketches.store(state, path)
    again = sketches.profile_state(ev.where("to_date(ts) = '2024-01-05'"), "ts", "30 minutes", ["event_type"], ["value", "k"], ["user_id"])
    sketches.store(again, path)
    days = sketches.merge_states(sketches.stored(spark, path), "1 day", ["event_type"])
    hours = sketches.merge_states(sketches.stored(spark, path), "6 hours").withColumn("event_type", F.lit("all"))
    both = days.withColumn("width", F.lit("1 day")).unionByName(hours.withColumn("width", F.lit("6 hours")))
    out = sketches.finish(both)
    flags = {
        "p50_in_range": F.col("value_p50_approx").between(F.col("value_min"), F.col("value_max")),
        "distinct_in_range": F.col("user_id_distinct_approx").between(1, F.col("n_rows") * 1.1 + 1),
    }
    return _text_windows(out.withColumns(flags)).drop("window_end", "value_p50_approx", "k_p50_approx", "user_id_distinct_approx")


@register(
    "window_classes",
    oracle="""
WITH g AS (
  SELECT time_bucket(INTERVAL '30 minutes', ts) AS ws, event_type, CAST(value > 50 AS INTEGER) AS prediction,
         count(*) AS n
  FROM events GROUP BY 1, 2, 3)
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(ws + INTERVAL '30 minutes', '%Y-%m-%d %H:%M:%S') AS window_end,
       event_type, prediction, n, round(n / sum(n) OVER (PARTITION BY ws, event_type), 6) AS share
FROM g
""",
)
def q_window_classes(spark, sf_dir):
    ev = load(spark, sf_dir, "events").withColumn("prediction", (F.col("value") > 50).cast("int"))
    return _text_windows(profile.window_classes(ev, "ts", "prediction", "30 minutes", ["event_type"]))


def _base_cur(spark, sf_dir):
    ev = _events_with_k(spark, sf_dir)
    is_base = F.col("ts") < F.lit(DRIFT_CUT).cast("timestamp_ntz")
    return ev.filter(is_base), ev.filter(~is_base)


_DRIFT_EVENTS_SQL = f"""
WITH e AS (SELECT CAST(ts < TIMESTAMP '{DRIFT_CUT}' AS INTEGER) AS is_base, value,
                  CAST(user_id AS DOUBLE) AS user_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
                  coalesce(event_type, '<null>') AS event_type_s, coalesce(CAST(user_id AS VARCHAR), '<null>') AS user_s
           FROM events)"""


@register(
    "drift_ks",
    oracle=_DRIFT_EVENTS_SQL
    + """,
l AS (SELECT 'value' AS column_name, value AS v, is_base FROM e
      UNION ALL SELECT 'user_id', user_id, is_base FROM e
      UNION ALL SELECT 'k', k, is_base FROM e),
g AS (SELECT column_name, v, sum(is_base) AS nb, sum(1 - is_base) AS nc FROM l WHERE v IS NOT NULL GROUP BY 1, 2),
c AS (SELECT column_name, v, nb, nc,
             sum(nb) OVER (PARTITION BY column_name ORDER BY v) AS cb,
             sum(nc) OVER (PARTITION BY column_name ORDER BY v) AS cc,
             sum(nb) OVER (PARTITION BY column_name) AS tb,
             sum(nc) OVER (PARTITION BY column_name) AS tc FROM g)
SELECT column_name, round(max(abs(cb / tb - cc / tc)), 6) AS ks_d,
       round(sum(v * nb) / sum(nb), 6) AS base_mean, round(sum(v * nc) / sum(nc), 6) AS cur_mean,
       round(sum(v * nc) / sum(nc) - sum(v * nb) / sum(nb), 6) AS mean_shift
FROM c GROUP BY column_name
""",
)
def q_drift_ks(spark, sf_dir):
    base, cur = _base_cur(spark, sf_dir)
    return drift.drift_numeric(base, cur, ["value", "user_id", "k"])


_CAT_SQL = (
    _DRIFT_EVENTS_SQL
    + """,
l AS (SELECT 'event_type' AS column_name, event_type_s AS v, is_base FROM e
      UNION ALL SELECT 'user_id', user_s, is_base FROM e),
g AS (SELECT column_name, v, sum(is_base) AS nb, sum(1 - is_base) AS nc FROM l GROUP BY 1, 2),
t AS (SELECT *, sum(nb) OVER (PARTITION BY column_name) AS tb, sum(nc) OVER (PARTITION BY column_name) AS tc FROM g),
s AS (SELECT column_name, nb, nc, tb, tc, nb / tb AS p, nc / tc AS q,
             (nb + nc) * tb / (tb + tc) AS eb, (nb + nc) * tc / (tb + tc) AS ec FROM t)
"""
)


@register(
    "drift_psi",
    oracle=_CAT_SQL
    + """SELECT column_name,
       round(sum((greatest(q, 1e-4) - greatest(p, 1e-4)) * ln(greatest(q, 1e-4) / greatest(p, 1e-4))), 6) AS psi
FROM s GROUP BY column_name""",
)
def q_drift_psi(spark, sf_dir):
    base, cur = _base_cur(spark, sf_dir)
    return drift.drift_categorical(base, cur, ["event_type", "user_id"]).select("column_name", "psi")


@register(
    "drift_js",
    oracle=_CAT_SQL
    + """SELECT column_name,
       round(sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END
                 + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2, 6) AS js
FROM s GROUP BY column_name""",
)
def q_drift_js(spark, sf_dir):
    base, cur = _base_cur(spark, sf_dir)
    return drift.drift_categorical(base, cur, ["event_type", "user_id"]).select("column_name", "js")


@register(
    "drift_chi2",
    oracle=_CAT_SQL
    + """SELECT column_name, round(sum(pow(nb - eb, 2) / eb + pow(nc - ec, 2) / ec), 6) AS chi2,
       count(*) - 1 AS dof
FROM s GROUP BY column_name""",
)
def q_drift_chi2(spark, sf_dir):
    base, cur = _base_cur(spark, sf_dir)
    return drift.drift_categorical(base, cur, ["event_type", "user_id"]).select("column_name", "chi2", "dof")


@register(
    "drift_consecutive",
    oracle="""
WITH p AS (
  SELECT time_bucket(INTERVAL '30 minutes', ts) AS ws, event_type, count(*) AS n_rows,
         round(avg(value), 6) AS value_mean
  FROM events GROUP BY 1, 2),
l AS (SELECT *, lag(n_rows) OVER (PARTITION BY event_type ORDER BY ws) AS prev_n_rows,
             lag(value_mean) OVER (PARTITION BY event_type ORDER BY ws) AS prev_value_mean FROM p)
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, n_rows, value_mean,
       prev_n_rows, n_rows - prev_n_rows AS delta_n_rows,
       prev_value_mean, round(value_mean - prev_value_mean, 6) AS delta_value_mean
FROM l
""",
)
def q_drift_consecutive(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    prof = profile.window_profile(ev, "ts", "30 minutes", keys=["event_type"], num_cols=["value"], quantiles=())
    prof = prof.select("window_start", "event_type", "n_rows", "value_mean")
    out = drift.drift_consecutive(prof, ["event_type"], "window_start", ["n_rows", "value_mean"])
    return out.withColumn("window_start", ts_text(F.col("window_start")))


@register("window_profile_salted", oracle=_WINDOW_PROFILE_SQL)
def q_window_profile_salted(spark, sf_dir):
    """The flagship profile through the hot-key plan: two-stage salted
    aggregation with mergeable moments."""
    ev = _events_with_k(spark, sf_dir)
    prof = profile.window_profile(
        ev, "ts", "30 minutes", keys=["event_type"], num_cols=["value", "k"], cat_cols=["user_id"], salt=8
    )
    return _text_windows(prof)


@register(
    "window_profile_hot_groups",
    oracle="""
WITH e AS (
  SELECT CASE WHEN l_linenumber < 7 THEN date_trunc('day', l_shipdate) + INTERVAL 1 HOUR END AS ts,
         nullif(l_returnflag, 'A') AS flag, l_extendedprice AS price, l_suppkey FROM lineitem),
w AS (SELECT CASE WHEN ts IS NOT NULL
                  THEN CAST(floor(epoch_us(ts) / 315360000000000.0) AS BIGINT) * 315360000000000 END AS us, * FROM e)
SELECT us // 1000000 AS start_s, flag, count(*) AS n_rows, min(price) AS price_min, max(price) AS price_max,
       round(avg(price), 4) AS price_mean,
       quantile_disc(price, 0.01) AS price_p01, quantile_disc(price, 0.5) AS price_p50, quantile_disc(price, 0.99) AS price_p99,
       count(DISTINCT l_suppkey) AS l_suppkey_distinct
FROM w GROUP BY us, flag
""",
)
def q_window_profile_hot_groups(spark, sf_dir):
    """Windows of ten years over all line items: groups of tens of thousands of rows
    with exact quantiles and distinct counts, a NULL key group, and the rows
    without a time in a window of their own."""
    li = load(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") < 7, F.date_trunc("day", F.col("l_shipdate").cast("timestamp")) + F.expr("interval 1 hour")).alias("ts"),
        F.nullif("l_returnflag", F.lit("A")).alias("flag"),
        F.col("l_extendedprice").alias("price"),
        "l_suppkey",
    )
    prof = profile.window_profile(li, "ts", "3650 days", ["flag"], ["price"], ["l_suppkey"], quantiles=(0.01, 0.5, 0.99))
    return prof.select(
        F.unix_seconds("window_start").alias("start_s"), "flag", "n_rows", "price_min", "price_max",
        F.round("price_mean", 4).alias("price_mean"), "price_p01", "price_p50", "price_p99", "l_suppkey_distinct",
    )

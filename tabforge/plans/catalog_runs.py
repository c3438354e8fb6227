"""Catalog: run-log queries (R1-R8, J6, S10) over runs derived from ``events``.

run = user, metric = event type (latest value), step = order of ``ts``;
tags, params and dataset inputs are derived from the same aggregates.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tabforge.operators import runs as R
from tabforge.operators.payload import parse_tag
from tabforge.operators.run_filter import run_filter
from tabforge.plans.registry import register
from tabforge.session import scratch_path
from tabforge.sources.tables import load, read_json_docs

CUT = "2024-01-16 00:00:00"
TYPES = ["click", "view", "purchase", "signup", "error"]


def run_table(spark, sf_dir):
    """One row per run.  Two aggregations keyed by user (partial before the
    shuffle); the metric map collects at most one entry per event type."""
    ev = load(spark, sf_dir, "events")
    latest = ev.groupBy("user_id", "event_type").agg(F.max_by("value", "ts").alias("v"))
    metrics = latest.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("event_type", "v"))).alias("metrics")
    )
    base = ev.groupBy("user_id").agg(
        F.min("ts").alias("t0"),
        F.max("ts").alias("t1"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("event_type") == "error").alias("n_err"),
        F.count_if(F.col("ts") < F.lit(CUT).cast("timestamp_ntz")).alias("n_base"),
    )
    u = F.col("user_id")
    return base.join(metrics, "user_id").select(
        F.concat(F.lit("run-"), u.cast("string")).alias("run_id"),
        F.concat(F.lit("demo-run-"), (u % 7).cast("string")).alias("run_name"),
        F.when(F.col("n_err") >= 15, "FAILED").otherwise("FINISHED").alias("status"),
        F.unix_millis(F.col("t0").cast("timestamp")).alias("start_time"),
        F.unix_millis(F.col("t1").cast("timestamp")).alias("end_time"),
        "metrics",
        F.create_map(F.lit("n_events"), F.col("n").cast("string"), F.lit("type"), F.lit("demo")).alias("params"),
        F.create_map(
            F.lit("source"),
            F.when(u % 3 == 0, "JOB").otherwise("LOCAL"),
            F.lit("git_sha"),
            F.concat(F.lit("sha"), (u % 4).cast("string")),
            F.lit("cluster_info"),
            F.to_json(F.struct(F.col("n").alias("n_events"), "n_err")),
        ).alias("tags"),
        F.array(
            F.struct(F.lit("training").alias("context"), F.lit("events_base").alias("name"),
                     F.col("n_base").alias("version")),
            F.struct(F.lit("testing").alias("context"), F.lit("events_current").alias("name"),
                     (F.col("n") - F.col("n_base")).alias("version")),
        ).alias("inputs"),
        F.concat(F.lit("parent-"), (u % 10).cast("string")).alias("parent_run_id"),
    )


_M = ", ".join(f"max(v) FILTER (WHERE event_type = '{t}') AS m_{t}" for t in TYPES)
RUNS_SQL = f"""
WITH lat AS (SELECT user_id, event_type, arg_max(value, ts) AS v FROM events GROUP BY 1, 2),
lp AS (SELECT user_id, {_M} FROM lat GROUP BY user_id),
base AS (SELECT user_id, min(ts) AS t0, max(ts) AS t1, count(*) AS n,
                count(*) FILTER (WHERE event_type = 'error') AS n_err,
                count(*) FILTER (WHERE ts < TIMESTAMP '{CUT}') AS n_base FROM events GROUP BY 1),
runs AS (SELECT 'run-' || CAST(b.user_id AS VARCHAR) AS run_id,
                'demo-run-' || CAST(b.user_id % 7 AS VARCHAR) AS run_name,
                CASE WHEN n_err >= 15 THEN 'FAILED' ELSE 'FINISHED' END AS status,
                epoch_us(t0) // 1000 AS start_time, epoch_us(t1) // 1000 AS end_time,
                CASE WHEN b.user_id % 3 = 0 THEN 'JOB' ELSE 'LOCAL' END AS tag_source,
                'sha' || CAST(b.user_id % 4 AS VARCHAR) AS tag_git_sha,
                'parent-' || CAST(b.user_id % 10 AS VARCHAR) AS parent_run_id,
                n, n_err, n_base, lp.* EXCLUDE (user_id)
         FROM base b JOIN lp ON b.user_id = lp.user_id)
"""

_START_AFTER = 1704070800000  # 2024-01-01 01:00:00 UTC in epoch ms


@register(
    "run_search",
    oracle=RUNS_SQL
    + f"""
SELECT run_id, run_name, status, start_time FROM runs
WHERE status = 'FINISHED' AND start_time > {_START_AFTER} AND run_name LIKE '%run-1%'
  AND m_click > 10 AND tag_source != 'JOB'
""",
)
def q_run_search(spark, sf_dir):
    """status = FINISHED AND start_time > t AND name LIKE AND metric > AND tag !=."""
    out = R.search_runs(
        run_table(spark, sf_dir),
        status="FINISHED",
        started_after=_START_AFTER,
        name_like="%run-1%",
        metric_gt={"click": 10},
        tag_ne={"source": "JOB"},
    )
    return out.select("run_id", "run_name", "status", "start_time")


#: Filter texts, and the same conditions in SQL over the runs' flat columns.
FILTERS = [
    (
        f"status='FINISHED' AND start_time>{_START_AFTER} AND run_name LIKE '%run-1%' AND metrics.click>10 AND tags.source!='JOB'",
        f"status = 'FINISHED' AND start_time > {_START_AFTER} AND run_name LIKE '%run-1%' AND m_click > 10 AND tag_source <> 'JOB'",
    ),
    ("", "true"),
    ("attributes.run_name ILIKE 'DEMO-run-_'", "run_name ILIKE 'DEMO-run-_'"),
    ("run_id IN ('run-1', 'run-2', \"run-30\")", "run_id IN ('run-1', 'run-2', 'run-30')"),
    ("metrics.`click` <= 50.5 and metrics.\"error\" >= 1e1", "m_click <= 50.5 AND m_error >= 10"),
    ("params.n_events NOT IN ('60', '61') AND params.n_events LIKE '6%'", "n NOT IN (60, 61) AND CAST(n AS VARCHAR) LIKE '6%'"),
    ("params.type LIKE 'de%' AND tags.git_sha NOT LIKE '%1'", "tag_git_sha NOT LIKE '%1'"),
    (f"end_time >= {_START_AFTER + 2_500_000_000} AND start_time < {_START_AFTER + 9_000_000}",
     f"end_time >= {_START_AFTER + 2_500_000_000} AND start_time < {_START_AFTER + 9_000_000}"),
    ("tags.missing != 'x'", "false"),
    ("status <> 'FAILED' AND tag.`git_sha` ilike 'SHA3' AND metric.signup != 0 AND param.missing IS NULL",
     "status <> 'FAILED' AND tag_git_sha = 'sha3' AND m_signup <> 0"),
]


@register(
    "run_search_text",
    oracle=RUNS_SQL
    + "\nUNION ALL\n".join(f"SELECT {i} AS filter, run_id, run_name, status, start_time FROM runs WHERE {sql}" for i, (_, sql) in enumerate(FILTERS)),
)
def q_run_search_text(spark, sf_dir):
    """Ten filter texts over all runs, in one scan: each run once for every filter it fulfils."""
    runs = run_table(spark, sf_dir)
    met = [F.when(run_filter(text, runs.schema), F.lit(i)) for i, (text, _) in enumerate(FILTERS)]
    out = runs.withColumn("filter", F.explode(F.array_compact(F.array(*met))))
    return out.select("filter", "run_id", "run_name", "status", "start_time")


@register(
    "run_find_by_tag",
    oracle=RUNS_SQL + "SELECT run_id, start_time FROM runs WHERE tag_git_sha = 'sha1' "
    "ORDER BY start_time DESC, run_id LIMIT 1",
)
def q_run_find_by_tag(spark, sf_dir):
    return R.find_by_tag(run_table(spark, sf_dir), "git_sha", "sha1").select("run_id", "start_time")


def _history(spark, sf_dir):
    ev = load(spark, sf_dir, "events").withColumn("run_id", F.concat(F.lit("run-"), F.col("user_id").cast("string")))
    return R.metric_history(ev, "run_id", "event_type", "value", "ts", tiebreak_col="event_id")


@register(
    "metric_history",
    oracle="""
SELECT 'run-' || CAST(user_id AS VARCHAR) AS run_id, event_type AS key,
       row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) - 1 AS step, value
FROM events
""",
)
def q_metric_history(spark, sf_dir):
    return _history(spark, sf_dir).select("run_id", "key", "step", "value")


@register(
    "metric_latest",
    oracle="""
SELECT 'run-' || CAST(user_id AS VARCHAR) AS run_id, event_type AS key, arg_max(value, ts) AS value,
       count(*) - 1 AS step
FROM events GROUP BY user_id, event_type
""",
)
def q_metric_latest(spark, sf_dir):
    return R.metric_latest(_history(spark, sf_dir))


def _params(ev, before: bool, types):
    """Key = event type, but NULL for clicks; value = count mod 3, but NULL for 0."""
    cond = F.col("ts") < F.lit(CUT).cast("timestamp_ntz")
    src = ev.filter(cond if before else ~cond).filter(F.col("event_type").isin(types))
    n = F.count(F.lit(1))
    return src.groupBy("user_id", "event_type").agg(n.alias("n")).select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"),
        F.when(F.col("event_type") != "click", F.col("event_type")).alias("key"),
        F.when(F.col("n") % 3 != 0, (F.col("n") % 3).cast("string")).alias("value"),
        "n",
    )


@register(
    "params_merge",
    oracle=f"""
WITH k AS (SELECT 'run-' || CAST(user_id AS VARCHAR) AS run_id, CASE WHEN event_type <> 'click' THEN event_type END AS key,
                  event_type, ts < TIMESTAMP '{CUT}' AS logged, count(*) AS n FROM events GROUP BY user_id, event_type, ts < TIMESTAMP '{CUT}'),
e AS (SELECT run_id, key, CASE WHEN n % 3 <> 0 THEN CAST(n % 3 AS VARCHAR) END AS value FROM k WHERE logged AND event_type IN ('click', 'view')),
n AS (SELECT run_id, key, CASE WHEN n % 3 <> 0 THEN CAST(n % 3 AS VARCHAR) END AS value FROM k WHERE NOT logged
      UNION ALL SELECT run_id, key, CAST(n % 2 AS VARCHAR) FROM k WHERE NOT logged AND event_type IN ('purchase', 'view')),
h AS (SELECT *, row_number() OVER (PARTITION BY run_id, key ORDER BY turn, value NULLS FIRST) AS place
      FROM (SELECT *, 0 AS turn FROM e UNION ALL SELECT *, 1 AS turn FROM n))
SELECT n.run_id, n.key, n.value,
       CASE WHEN n.value IS DISTINCT FROM h.value THEN 'rejected' WHEN h.turn = 0 THEN 'unchanged' ELSE 'accepted' END AS status
FROM n JOIN h ON h.place = 1 AND n.run_id = h.run_id AND n.key IS NOT DISTINCT FROM h.key
""",
)
def q_params_merge(spark, sf_dir):
    """Parameters logged in the first half (click/view only) vs the second half (all types,
    two values for some keys): new keys accepted, equal values unchanged, others rejected;
    one key is NULL, as are some logged and some new values."""
    ev = load(spark, sf_dir, "events")
    new = _params(ev, False, TYPES)
    twice = new.where("key in ('purchase', 'view')").withColumn("value", (F.col("n") % 2).cast("string"))
    return R.merge_params(_params(ev, True, ["click", "view"]).drop("n"), new.unionAll(twice).drop("n"))


@register(
    "run_rollup",
    oracle=RUNS_SQL
    + """, best AS (SELECT parent_run_id, count(*) AS n_children, max(m_purchase) AS best_purchase FROM runs
               GROUP BY parent_run_id)
SELECT b.parent_run_id, b.n_children, b.best_purchase,
       (SELECT max(r.run_id) FROM runs r WHERE r.parent_run_id = b.parent_run_id AND r.m_purchase = b.best_purchase)
         AS best_run_id
FROM best b
""",
)
def q_run_rollup(spark, sf_dir):
    return R.rollup_children(run_table(spark, sf_dir), "parent_run_id", "purchase")


@register(
    "array_find",
    oracle=RUNS_SQL + "SELECT run_id, n_base AS training_version, n - n_base AS testing_version, "
    "'events_base' AS training_name FROM runs",
)
def q_array_find(spark, sf_dir):
    t = run_table(spark, sf_dir)
    tr = R.input_by_context(t, "training")
    te = R.input_by_context(t, "testing")
    return t.select(
        "run_id",
        tr["version"].alias("training_version"),
        te["version"].alias("testing_version"),
        tr["name"].alias("training_name"),
    )


@register(
    "latest_version",
    oracle="""
WITH reg AS (SELECT event_type AS name, user_id AS version, min(ts) AS created FROM events GROUP BY 1, 2),
m AS (SELECT name, max(created) AS last_created, max(version) AS max_version, count(*) AS n_versions
      FROM reg GROUP BY name)
SELECT m.name,
       (SELECT max(version) FROM reg r WHERE r.name = m.name AND r.created = m.last_created) AS latest_version,
       max_version, n_versions
FROM m
""",
)
def q_latest_version(spark, sf_dir):
    """Registry stand-in: model = event type, version = user id, created =
    first event; alias 'latest' = most recently created version."""
    ev = load(spark, sf_dir, "events")
    reg = ev.groupBy(F.col("event_type").alias("name"), F.col("user_id").alias("version")).agg(
        F.min("ts").alias("created")
    )
    return R.latest_by(reg, "name", "version", "created")


@register(
    "run_tag_json",
    oracle=RUNS_SQL + "SELECT run_id, n AS n_events, n_err FROM runs",
)
def q_run_tag_json(spark, sf_dir):
    """JSON held in a tag value, parsed with a schema."""
    t = parse_tag(run_table(spark, sf_dir), "tags", "cluster_info", "n_events long, n_err long", into="ci")
    return t.select("run_id", F.col("ci.n_events").alias("n_events"), F.col("ci.n_err").alias("n_err"))


RUN_DOC_SCHEMA = (
    "run_id string, run_name string, status string, start_time long, end_time long, "
    "metrics map<string,double>, params map<string,string>, tags map<string,string>, "
    "inputs array<struct<context:string,name:string,version:long>>, parent_run_id string"
)


@register(
    "run_docs_roundtrip",
    oracle=RUNS_SQL + "SELECT run_id, status, CAST(n AS VARCHAR) AS n_events, m_error FROM runs",
)
def q_run_docs_roundtrip(spark, sf_dir):
    """Run documents written as JSON to the shared scratch folder and read
    back with an explicit schema (document sink + source)."""
    path = scratch_path(spark, f"run_docs/{uuid.uuid4().hex}")
    run_table(spark, sf_dir).write.mode("overwrite").json(path)
    docs = read_json_docs(spark, path, RUN_DOC_SCHEMA, multi_line=False)
    return docs.select(
        "run_id",
        "status",
        F.try_element_at("params", F.lit("n_events")).alias("n_events"),
        F.try_element_at("metrics", F.lit("error")).alias("m_error"),
    )

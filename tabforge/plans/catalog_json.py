"""Catalog: JSON parsing, request-log building and flattening.

The request log is *derived from* ``customer`` by the payload builder: one
request per key range of customers (ordered by key), the response carrying
one prediction per record.  The oracle computes the
expected flattened rows straight from ``customer``.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.operators import payload
from tabforge.plans.registry import register
from tabforge.sources.tables import load

_BAD_JSON_SQL = """CASE event_type WHEN 'error' THEN 'not json'
                        WHEN 'click' THEN '{"k": "x' || CAST(event_id AS VARCHAR) || '"}'
                        ELSE props END"""


def _bad_json(ev):
    return F.when(F.col("event_type") == "error", F.lit("not json")).when(
        F.col("event_type") == "click", F.concat(F.lit('{"k": "x'), F.col("event_id").cast("string"), F.lit('"}'))
    ).otherwise(F.col("props"))


@register(
    "json_parse",
    oracle=f"""
WITH t AS (SELECT event_id, {_BAD_JSON_SQL} AS txt FROM events)
SELECT event_id,
       CASE WHEN json_valid(txt) THEN TRY_CAST(json_extract_string(txt, '$.k') AS BIGINT) END AS k,
       CASE WHEN json_valid(txt) THEN json_extract_string(txt, '$.k') END AS k_text
FROM t
""",
)
def q_json_parse(spark, sf_dir):
    """Fixed-schema parse; bad text → NULL fields; a wrongly typed field is
    NULL under ``long`` but kept as text under ``string``."""
    ev = load(spark, sf_dir, "events").select("event_id", _bad_json(F.col("event_type")).alias("txt"))
    out = payload.parse_json(ev, "txt", "k long", into="p")
    out = payload.parse_json(out, "txt", "k string", into="s")
    return out.select("event_id", F.col("p.k").alias("k"), F.col("s.k").alias("k_text"))


@register(
    "response_parse",
    oracle="""
SELECT event_id,
       CASE event_type
            WHEN 'click' THEN CAST(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 AS VARCHAR) || ',1'
            WHEN 'view' THEN CAST(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 AS VARCHAR)
            WHEN 'signup' THEN '' END AS predictions,
       CASE WHEN event_type = 'click' THEN 2 WHEN event_type = 'view' THEN 1 WHEN event_type = 'signup' THEN 0 END
         AS n_predictions,
       CASE WHEN event_type = 'view' THEN 't' || CAST(event_id AS VARCHAR) END AS trace
FROM events
""",
)
def q_response_parse(spark, sf_dir):
    """Both response envelopes: ``[k%2, 1]`` arrays and the label map
    ``{"Survival prediction": ["alive"|"dead"]}``; ``bad`` text and
    string arrays give NULL, an empty array gives no first element."""
    ev = load(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    resp = (
        F.when(F.col("event_type") == "click", F.concat(F.lit('{"predictions": ['), (k % 2).cast("string"), F.lit(", 1]}")))
        .when(
            F.col("event_type") == "view",
            F.concat(
                F.lit('{"predictions": {"Survival prediction": ["'),
                F.when(k % 2 == 1, F.lit("alive")).otherwise(F.lit("dead")),
                F.lit('"]}, "databricks_output": {"trace": "t'),
                F.col("event_id").cast("string"),
                F.lit('"}}'),
            ),
        )
        .when(F.col("event_type") == "error", F.lit("bad"))
        .when(F.col("event_type") == "signup", F.lit('{"predictions": []}'))
        .otherwise(F.lit('{"predictions": ["alive"]}'))
    )
    parsed = payload.parse_response(ev.select("event_id", resp.alias("response")), "response", into="r")
    return parsed.select(
        "event_id",
        F.when(
            F.col("r.predictions").isNotNull(), F.array_join(F.transform("r.predictions", lambda x: x.cast("string")), ",")
        ).alias("predictions"),
        F.when(F.col("r.predictions").isNotNull(), F.size(F.col("r.predictions"))).alias("n_predictions"),
        F.col("r.databricks_output.trace").alias("trace"),
    )


CUSTOMER_RECORD = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
    ]
)


EVENT_RECORD = T.StructType([T.StructField("at", T.StringType()), T.StructField("event_id", T.LongType())])


def request_log(spark, sf_dir):
    """Request log derived from ``customer``: one request per key range of
    50 customers (a bounded batch), records ordered by key.

    Columns: ``databricks_request_id, request_time, execution_duration_ms,
    request, response``.
    """
    c = load(spark, sf_dir, "customer").select(
        F.floor(F.col("c_custkey") / 50).alias("batch"),
        "c_custkey",
        F.nullif("c_acctbal", F.lit(0.0)).alias("c_acctbal"),
        "c_mktsegment",
    )
    recs = F.array_sort(F.collect_list(F.struct(*[F.col(f.name) for f in CUSTOMER_RECORD.fields])))
    g = c.groupBy("batch").agg(recs.alias("records"))
    preds = F.transform(F.col("records"), lambda r: F.coalesce((r["c_acctbal"] > 5000).cast("int"), F.lit(0)))
    return g.select(
        F.concat(F.lit("req-"), F.col("batch").cast("string")).alias("databricks_request_id"),
        (
            F.lit("2024-01-01 00:00:00").cast("timestamp")
            + F.make_interval(mins=(F.col("batch") * 7).cast("int"), secs=F.lit(0.75))
        ).alias("request_time"),
        (F.size("records") * 10).cast("long").alias("execution_duration_ms"),
        F.to_json(F.struct(F.col("records").alias("dataframe_records")), {"ignoreNullFields": "false"}).alias(
            "request"
        ),
        F.to_json(F.struct(preds.alias("predictions"))).alias("response"),
    )


_FLAT_SQL = """
WITH b AS (SELECT c_custkey // 50 AS batch, * FROM customer),
c AS (SELECT batch, c_custkey, nullif(c_acctbal, 0.0) AS c_acctbal, c_mktsegment,
                  coalesce(CAST(nullif(c_acctbal, 0.0) > 5000 AS INTEGER), 0) AS pred,
                  TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(batch * 7 AS BIGINT))
                    + INTERVAL '750 milliseconds' AS rt,
                  count(*) OVER (PARTITION BY batch) AS n_in_req,
                  first_value(coalesce(CAST(nullif(c_acctbal, 0.0) > 5000 AS INTEGER), 0))
                    OVER (PARTITION BY batch ORDER BY c_custkey) AS first_pred
           FROM b)
SELECT strftime(rt, '%Y-%m-%d %H:%M:%S.%g') AS timestamp, epoch_us(rt) // 1000000 * 1000 AS timestamp_ms,
       'req-' || CAST(batch AS VARCHAR) AS databricks_request_id, n_in_req * 10 AS execution_duration_ms,
       c_custkey, c_acctbal, c_mktsegment, {pred} AS prediction, 'customer-model' AS model_name
FROM c"""


def _flatten(spark, sf_dir, first_only):
    log = request_log(spark, sf_dir)
    flat = payload.flatten_payload(
        log, "customer-model", CUSTOMER_RECORD, first_prediction_only=first_only
    )
    flat = payload.drop_null_or_keep(flat, ["prediction"])
    return flat.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSS"))


@register("payload_flatten", oracle=_FLAT_SQL.format(pred="pred"))
def q_payload_flatten(spark, sf_dir):
    """Request log → monitoring rows: parse, explode with position, match
    each record with the prediction at its position, epoch ms, drop rows
    without a prediction unless none has one.  One narrow stage."""
    return _flatten(spark, sf_dir, first_only=False)


@register("payload_flatten_first", oracle=_FLAT_SQL.format(pred="first_pred"))
def q_payload_flatten_first(spark, sf_dir):
    """Same, with the monitored job's rule: every record of a request gets
    the request's first prediction."""
    return _flatten(spark, sf_dir, first_only=True)


@register(
    "payload_roundtrip",
    oracle="""
SELECT c_custkey, c_acctbal, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment,
       c_mktsegment = 'BUILDING' AS null_kept
FROM customer
""",
)
def q_payload_roundtrip(spark, sf_dir):
    """One request body per row with explicit nulls, parsed back."""
    c = load(spark, sf_dir, "customer").select(
        "c_custkey", "c_acctbal", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment")
    )
    body = payload.to_payload(c, ["c_custkey", "c_acctbal", "c_mktsegment"])
    parsed = payload.parse_json(body, "payload", payload.request_schema(CUSTOMER_RECORD), into="p")
    rec = F.get(F.col("p.dataframe_records"), 0)
    return parsed.select(
        rec["c_custkey"].alias("c_custkey"),
        rec["c_acctbal"].alias("c_acctbal"),
        rec["c_mktsegment"].alias("c_mktsegment"),
        F.col("payload").contains('"c_mktsegment":null').alias("null_kept"),
    )


@register(
    "metrics_pivot",
    oracle="""
SELECT event_type, max(value) AS value, max(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS k,
       max(CAST(hour(ts) AS DOUBLE)) AS hour
FROM events GROUP BY event_type
""",
)
def q_metrics_pivot(spark, sf_dir):
    """Per-row metric arrays exploded to (key, value) rows, then pivoted to
    one row per model (event type) over a known key list (no distinct job)."""
    ev = load(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    arr = F.array(
        F.struct(F.lit("value").alias("_key"), F.col("value").cast("double").alias("_value")),
        F.struct(F.lit("k").alias("_key"), k.alias("_value")),
        F.struct(F.lit("hour").alias("_key"), F.hour("ts").cast("double").alias("_value")),
    )
    long = payload.metrics_long(ev.select("event_type", arr.alias("metrics")), "metrics", ["event_type"])
    return payload.metrics_wide(long, ["event_type"], "_key", "_value", ["value", "k", "hour"])


@register(
    "monitoring_refresh",
    oracle=_FLAT_SQL.format(pred="first_pred").replace(
        "'req-' || CAST(batch AS VARCHAR) AS databricks_request_id",
        "CASE WHEN batch % 10 != 3 THEN 'req-' || CAST(batch AS VARCHAR) END AS databricks_request_id",
    ),
)
def q_monitoring_refresh(spark, sf_dir):
    """The whole monitoring refresh: an empty log first, then one with repeated
    requests and requests without an id, then the same again (which appends
    nothing); returns the monitoring table."""
    import uuid

    from tabforge.plans.monitoring import monitoring_table, refresh_monitoring
    from tabforge.session import scratch_path

    target = scratch_path(spark, f"monitoring/{uuid.uuid4().hex}")
    log = request_log(spark, sf_dir)
    n_requests = log.count()
    nothing = refresh_monitoring(log.limit(0), target, "customer-model", CUSTOMER_RECORD)
    # half of the requests are delivered twice, and some come without an id
    noisy = log.withColumn(
        "databricks_request_id", F.when(~F.col("databricks_request_id").endswith("3"), F.col("databricks_request_id"))
    )
    noisy = noisy.unionAll(noisy.where(F.hash("request") % 2 == 0))
    first = refresh_monitoring(noisy, target, "customer-model", CUSTOMER_RECORD)
    second = refresh_monitoring(noisy, target, "customer-model", CUSTOMER_RECORD)
    assert nothing.log_rows == nothing.written_rows == 0, nothing
    out = monitoring_table(spark, target).drop("day")
    assert (first.log_rows, second.log_rows, second.written_rows) == (n_requests, 0, 0), (first, second)
    assert first.written_rows == first.flattened_rows == out.count(), first
    return out.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSS"))


@register(
    "payload_batches",
    oracle="""
WITH i AS (SELECT *, row_number() OVER (ORDER BY c_custkey) - 1 AS rn FROM customer)
SELECT rn // 64 AS batch, count(*) OVER (PARTITION BY rn // 64) AS n_records, rn % 64 AS pos,
       c_custkey, c_acctbal, c_mktsegment FROM i
""",
)
def q_payload_batches(spark, sf_dir):
    """Request bodies of at most 64 records each, in key order; every record of
    every batch is parsed back."""
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    b = payload.to_payload_batches(c, ["c_custkey", "c_acctbal", "c_mktsegment"], "c_custkey", 64)
    parsed = payload.parse_json(b, "payload", payload.request_schema(CUSTOMER_RECORD), into="p")
    return _records(parsed)


def _records(parsed):
    """Every record of parsed batches with its place: batch, n_records, pos and the record's fields."""
    out = parsed.select("batch", "n_records", F.posexplode("p.dataframe_records").alias("pos", "r"))
    return out.select(*[F.col(c).cast("long").alias(c) for c in ("batch", "n_records", "pos")], "r.*")


@register(
    "payload_batches_by_time",
    oracle="""
WITH i AS (SELECT event_id, value, row_number() OVER (ORDER BY ts, event_id) - 1 AS rn, ts FROM events),
k AS (SELECT *, count(*) OVER (PARTITION BY ts) AS same FROM i)
SELECT rn // 100 AS batch, count(*) OVER (PARTITION BY rn // 100) AS n_records, rn % 100 AS pos,
       strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS at, CASE WHEN same = 1 THEN event_id END AS event_id FROM k
""",
)
def q_payload_batches_by_time(spark, sf_dir):
    """Batches in the order of a zone-less time: sizes and order are exact even
    where times tie (the id is shown where the time is unique)."""
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at")
    same = F.count(F.lit(1)).over(Window.partitionBy("ts"))
    ev = load(spark, sf_dir, "events").select("ts", at, F.when(same == 1, F.col("event_id")).alias("event_id"))
    b = payload.to_payload_batches(ev, ["at", "event_id"], "ts", 100)
    return _records(payload.parse_json(b, "payload", payload.request_schema(EVENT_RECORD), into="p"))

"""JSON and nested data: request/response parsing, record explosion, the
monitoring-table flattening, payload building, metric arrays (J1-J7, P17-P20).

Everything here is narrow (row-local) except the P17 "any valid row"
check, which is a scalar subquery (one tiny global aggregate) instead of a
count round-trip through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions.timefn import as_timestamp, epoch_ms

# The monitored model's request record schema and response
# envelope, field names and types as the request log defines them.
REQUEST_RECORD_SCHEMA = T.StructType(
    [
        T.StructField("Height", T.DoubleType()),
        T.StructField("Weight", T.DoubleType()),
        T.StructField("Universe", T.StringType()),
        T.StructField("Identity", T.StringType()),
        T.StructField("Gender", T.StringType()),
        T.StructField("Marital_Status", T.StringType()),
        T.StructField("Teams", T.StringType()),
        T.StructField("Origin", T.StringType()),
        T.StructField("Magic", T.StringType()),
        T.StructField("Mutant", T.StringType()),
    ]
)
RESPONSE_OUTPUT_SCHEMA = T.StructType(
    [T.StructField("trace", T.StringType()), T.StructField("databricks_request_id", T.StringType())]
)


def request_schema(record_schema: T.StructType = REQUEST_RECORD_SCHEMA) -> T.StructType:
    return T.StructType([T.StructField("dataframe_records", T.ArrayType(record_schema))])


def parse_json(df: DataFrame, col: str, schema: T.StructType | str, into: str | None = None) -> DataFrame:
    """Parse a JSON text column with a fixed schema.

    PERMISSIVE: unparsable text gives a struct of NULLs, a wrongly typed
    field gives NULL in that field only.  Catalyst prunes unused fields.
    """
    return df.withColumn(into or f"{col}_parsed", F.from_json(F.col(col), schema, {"mode": "PERMISSIVE"}))


def _label_predictions(text: Column, positive_label: str) -> Column:
    """Predictions from the label envelope ``{"predictions": {"<name>": [...]}}``."""
    as_labels = F.from_json(text, "predictions map<string,array<string>>").getField("predictions")
    first_list = F.element_at(F.map_values(as_labels), 1)
    return F.transform(first_list, lambda x: F.when(F.lower(x) == F.lit(positive_label.lower()), 1).otherwise(0))


def response_predictions(text: Column, positive_label: str = "alive") -> Column:
    """``array<int>`` predictions from either response envelope.

    Accepts ``{"predictions": [1, 0]}`` and the label envelope
    ``{"predictions": {"<name>": ["alive", "dead"]}}``; labels decode to
    1 when equal to ``positive_label`` (case-insensitive), else 0.
    """
    as_ints = F.from_json(text, "predictions array<int>").getField("predictions")
    return F.coalesce(as_ints, _label_predictions(text, positive_label))


def parse_response(df: DataFrame, col: str = "response", into: str = "parsed_response",
                   positive_label: str = "alive") -> DataFrame:
    """Response JSON → ``struct<predictions array<int>, databricks_output struct>``.

    One ``from_json`` reads the integer predictions and the output struct;
    the label-map reading runs only for rows where that gave no predictions
    (``coalesce`` evaluates lazily).
    """
    env = T.StructType(
        [
            T.StructField("predictions", T.ArrayType(T.IntegerType())),
            T.StructField("databricks_output", RESPONSE_OUTPUT_SCHEMA),
        ]
    )
    parsed = df.withColumn("_env", F.from_json(F.col(col), env))
    preds = F.coalesce(F.col("_env.predictions"), _label_predictions(F.col(col), positive_label))
    out = parsed.withColumn(
        into, F.struct(preds.alias("predictions"), F.col("_env.databricks_output").alias("databricks_output"))
    )
    return out.drop("_env")


def explode_records(df: DataFrame, col: str, into: str = "record", outer: bool = False, pos: str = "pos") -> DataFrame:
    """One row per array element, keeping the element position."""
    gen = F.posexplode_outer(F.col(col)) if outer else F.posexplode(F.col(col))
    return df.select("*", gen.alias(pos, into))


def flatten_payload(
    df: DataFrame,
    model_name: str,
    record_schema: T.StructType = REQUEST_RECORD_SCHEMA,
    request_col: str = "request",
    response_col: str = "response",
    time_col: str = "request_time",
    id_col: str = "databricks_request_id",
    duration_col: str = "execution_duration_ms",
    first_prediction_only: bool = True,
    exact_ms: bool = False,
    keep: list[str] | None = None,
    outer: bool = False,
) -> DataFrame:
    """Request log → monitoring table, one narrow stage.

    Columns: ``timestamp, timestamp_ms, <id>, <duration>, <record fields>,
    prediction, model_name``.  ``first_prediction_only`` gives every
    exploded record the first prediction of its response (the monitored
    job's behaviour); otherwise the prediction at the record's position.
    ``keep`` columns of the log ride along; ``outer`` keeps one row for a request
    without records and adds ``_pos``, which is NULL there, and ``_any``, whether any
    record of the request has a prediction.
    """
    parsed = parse_json(df, request_col, request_schema(record_schema), into="_req")
    parsed = parse_response(parsed, response_col, into="_resp")
    preds, records = F.col("_resp.predictions"), F.col("_req.dataframe_records")
    own = F.slice(preds, 1, F.when(F.size(records) > 0, F.lit(1) if first_prediction_only else F.size(records)).otherwise(0))
    if outer:
        parsed = parsed.withColumn("_any", F.coalesce(F.exists(own, lambda x: x.cast("int").isNotNull()), F.lit(False)))
    exploded = explode_records(parsed, "_req.dataframe_records", into="_rec", pos="_pos", outer=outer)
    prediction = F.get(preds, 0) if first_prediction_only else F.get(preds, F.col("_pos"))
    return exploded.select(
        as_timestamp(F.col(time_col)).alias("timestamp"),
        epoch_ms(F.col(time_col), exact=exact_ms).alias("timestamp_ms"),
        F.col(id_col),
        F.col(duration_col),
        *[F.col(f"_rec.{f.name}").alias(f.name) for f in record_schema.fields],
        prediction.cast("int").alias("prediction"),
        F.lit(model_name).alias("model_name"),
        *[F.col(c) for c in keep or []],
        *([F.col("_pos"), F.col("_any")] if outer else []),
    )


def drop_null_or_keep(df: DataFrame, cols: list[str], lazy: bool = True) -> DataFrame:
    """Drop rows NULL in ``cols`` — unless that would drop every row.

    One plan, no job while it is built: a scalar subquery looks whether any row is
    valid, and stops at the first it finds (``limit 1`` under the maximum).
    ``lazy=False`` looks at once, so the plan that is returned has no subquery.
    No cross join either way.
    """
    valid = F.lit(True)
    for c in cols:
        valid = valid & F.col(c).isNotNull()
    if not lazy:
        return df.filter(valid) if df.filter(valid).limit(1).count() > 0 else df
    any_valid = df.filter(valid).select(F.lit(1).alias("one")).limit(1).agg(F.max("one").alias("any_valid")).scalar()
    return df.filter(valid | (F.coalesce(any_valid, F.lit(0)) == 0))


def to_payload(df: DataFrame, cols: list[str], into: str = "payload", keep: list[str] | None = None) -> DataFrame:
    """One request body per row: ``{"dataframe_records":[{...}]}`` with
    explicit nulls (J5).  ``keep`` columns (e.g. an id) ride along."""
    body = F.to_json(
        F.struct(F.array(F.struct(*[F.col(c) for c in cols])).alias("dataframe_records")),
        {"ignoreNullFields": "false"},
    )
    return df.select(*(keep or []), body.alias(into))


def to_payload_batches(
    df: DataFrame, cols: list[str], order_col: str, batch_size: int, into: str = "payload"
) -> DataFrame:
    """Requests of at most ``batch_size`` records, in ``order_col`` order.

    Rows get a dense index without a one-task window
    (:func:`tabforge.plans.prefix.dense_index`); ``batch = index //
    batch_size`` bounds every group, so ``collect_list`` never gathers more
    than ``batch_size`` records.  Output ``(batch, n_records, payload)``.
    """
    from tabforge.plans.prefix import dense_index

    idx = dense_index(df, order_col, into="_i").withColumn(
        "batch", F.floor(F.col("_i") / batch_size)
    )
    rec = F.struct(F.col("_i"), *[F.col(c) for c in cols])
    grouped = idx.groupBy("batch").agg(F.array_sort(F.collect_list(rec)).alias("_recs"))
    records = F.transform(F.col("_recs"), lambda r: F.struct(*[r[c].alias(c) for c in cols]))
    return grouped.select(
        "batch",
        F.size("_recs").alias("n_records"),
        F.to_json(F.struct(records.alias("dataframe_records")), {"ignoreNullFields": "false"}).alias(into),
    )


def parse_tag(df: DataFrame, map_col: str, key: str, schema: T.StructType | str, into: str) -> DataFrame:
    """JSON text held in a map value, parsed with a schema."""
    return df.withColumn(into, F.from_json(F.try_element_at(F.col(map_col), F.lit(key)), schema))


def metrics_long(df: DataFrame, array_col: str, id_cols: list[str]) -> DataFrame:
    """Explode an array of metric structs to one row per metric."""
    return df.select(*id_cols, F.explode(F.col(array_col)).alias("_m")).select(*id_cols, "_m.*")


def metrics_wide(long_df: DataFrame, id_cols: list[str], key: str, value: str, keys: list[str]) -> DataFrame:
    """Pivot metric rows to one row per id with a column per known key.

    The key list is given, so Spark does not run a distinct job to find it.
    """
    return long_df.groupBy(*id_cols).pivot(key, keys).agg(F.max(value))

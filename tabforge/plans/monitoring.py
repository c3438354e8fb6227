"""The monitoring refresh as one Spark job per run.

Request log → new requests only → flatten (parse, explode, position-matched or
first prediction, epoch ms) → append to the monitoring table.

A refresh is one pass: the log's JSON is parsed once, by the job that writes, and every
count is observed on that write.  Rows without a prediction are stored beside the others, in
the table's ``valid=0`` partitions, and requests without any record in ``valid=-1``, so all
that was processed is committed by one job; :func:`monitoring_table` shows ``valid=0`` only if no
row of the whole table has a prediction.  So that rule never depends on how the
log was cut into refreshes or micro-batches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.operators.payload import REQUEST_RECORD_SCHEMA, flatten_payload
from tabforge.sources.tables import path_exists

KEY = "request_key"
KEY_SCHEMA = T.StructType([T.StructField(KEY, T.StringType()), T.StructField("day", T.DateType())])


@dataclass
class RefreshCounts:
    """Row counts of one refresh (driver-side metadata)."""

    log_rows: int
    flattened_rows: int
    valid_rows: int
    written_rows: int
    skipped_requests: int = 0


def _keyed(log: DataFrame, id_col: str) -> DataFrame:
    """``log`` with its request key (the id, or for a NULL id a digest of the request) and day."""
    text = F.concat_ws("|", F.col("request_time").cast("string"), F.coalesce("request", F.lit("")), F.coalesce("response", F.lit("")))
    return log.withColumns({KEY: F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("row:"), F.md5(text))), "day": F.to_date("request_time")})


def _seen(spark: SparkSession, target_path: str, log: DataFrame) -> DataFrame:
    """Keys processed before, read from the day partitions that ``log`` touches only."""
    first, last = log.agg(F.min("day"), F.max("day")).first()
    near = F.col("day").isNull() if first is None else F.col("day").isNull() | F.col("day").between(F.lit(first), F.lit(last))
    if not path_exists(spark, target_path):
        return spark.createDataFrame([], KEY_SCHEMA).select(KEY)
    # an explicit schema: a table without files yet is an empty table
    return spark.read.schema(KEY_SCHEMA).parquet(target_path).where(near).select(KEY).distinct()


def refresh_monitoring(
    log: DataFrame,
    target_path: str,
    model_name: str,
    record_schema: T.StructType = REQUEST_RECORD_SCHEMA,
    id_col: str = "databricks_request_id",
    first_prediction_only: bool = True,
) -> RefreshCounts:
    """Append the new part of ``log`` to the monitoring table at ``target_path``.

    New are requests that the table has no row of, requests without any record included.
    A request that the log holds more than once counts once (the earliest); requests with a
    NULL id are told apart by their content.  One write commits all of it, so a failed refresh
    leaves nothing and a repeated one adds nothing.
    """
    spark = log.sparkSession
    keyed = _keyed(log, id_col)
    fresh = keyed.join(_seen(spark, target_path, keyed), KEY, "left_anti")
    whole = F.struct(*[F.col(c) for c in keyed.columns if c != KEY])
    one = fresh.groupBy(KEY).agg(F.min_by(whole, F.struct("request_time", F.xxhash64("request", "response"))).alias("_one"))
    fresh = one.select(KEY, "_one.*")
    # posexplode drops requests without records: an outer parse keeps one empty row for each
    flat = flatten_payload(
        fresh, model_name, record_schema, id_col=id_col, first_prediction_only=first_prediction_only, keep=[KEY, "day"], outer=True
    )
    valid, first = F.col("prediction").isNotNull(), F.col("_pos") == 0
    obs = Observation("refresh")
    flat = flat.observe(
        obs,
        F.count_if(F.col("_pos").isNull() | first).alias("requests"),
        F.count("_pos").alias("rows"),
        F.count_if(valid & F.col("_pos").isNotNull()).alias("valid"),
        F.count_if(first).alias("with_rows"),
        F.count_if(first & F.col("_any")).alias("with_valid"),
    )
    kind = F.when(F.col("_pos").isNull(), -1).otherwise(valid.cast("int"))
    flat.withColumn("valid", kind).drop("_pos", "_any").write.mode("append").partitionBy("valid", "day").parquet(target_path)
    sums = {k: v or 0 for k, v in obs.get.items()}
    shown = sums["valid"] > 0 or _any_valid(spark, target_path)
    written, told = (sums["valid"], sums["with_valid"]) if shown else (sums["rows"], sums["with_rows"])
    return RefreshCounts(sums["requests"], sums["rows"], sums["valid"], written, sums["requests"] - told)


def _any_valid(spark: SparkSession, target_path: str) -> bool:
    """Whether any stored row has a prediction (lists the ``valid=1`` partition, reads one row)."""
    part = T.StructType([T.StructField(KEY, T.StringType()), T.StructField("valid", T.IntegerType())])
    return bool(spark.read.schema(part).parquet(target_path).where("valid = 1").take(1))


def monitoring_table(
    spark: SparkSession, target_path: str, since: str | None = None, until: str | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """The monitoring table, optionally limited to ``[since, until)``: rows with a
    prediction, or all rows if none of the whole table has one.

    The time bounds are applied to the ``day`` partition column as well as to
    ``timestamp``, so only the folders of those days are listed and read
    (partition pruning).  ``schema`` reads a table that has no rows yet.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(target_path)
    df = df.where("valid = 1" if _any_valid(spark, target_path) else "valid = 0").drop("valid", KEY)
    if since is not None:
        df = df.filter((F.col("day") >= F.to_date(F.lit(since))) & (F.col("timestamp") >= F.lit(since).cast("timestamp")))
    if until is not None:
        df = df.filter((F.col("day") <= F.to_date(F.lit(until))) & (F.col("timestamp") < F.lit(until).cast("timestamp")))
    return df

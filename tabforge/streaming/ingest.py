"""Structured Streaming versions of the recurring jobs.

The batch operators are reused unchanged on streaming DataFrames:

* T1 request-log ingest: file stream → ``flatten_payload`` → parquet sink
  with a checkpoint; ``trigger(availableNow=True)`` is the scheduled run —
  it processes only files not yet committed, so a re-run adds nothing;
* T2 duplicate requests: watermark + ``dropDuplicatesWithinWatermark``;
* T3 30-minute profile: watermark + ``groupBy(window)`` in append mode
  (a window is emitted once the watermark passes its end) with quantile and distinct
  sketches in the state; open windows come from the state store, late rows are counted;
* T4 scoring: ``model.transform`` on the stream (stream-static joins for
  the dictionary).

Checkpoints and sinks live under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions.timefn import as_timestamp
from tabforge.operators import sketches
from tabforge.operators.payload import flatten_payload

REQUEST_LOG_SCHEMA = T.StructType(
    [
        T.StructField("databricks_request_id", T.StringType()),
        T.StructField("request_time", T.TimestampType()),
        T.StructField("execution_duration_ms", T.LongType()),
        T.StructField("request", T.StringType()),
        T.StructField("response", T.StringType()),
    ]
)

#: Name of the observation that a profile stream carries, and the table that keeps it.
SEEN = "profile_rows"
LEDGER = "batch long, rows long, untimed long, watermark string, at string"


def file_stream(spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet file stream with a fixed schema (no inference on a stream)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def run_available(df: DataFrame, sink: str, checkpoint: str, mode: str = "append", partition_by=None) -> None:
    """Run a stream over everything available now, then stop (the cron run)."""
    w = df.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
    w = w.outputMode(mode).trigger(availableNow=True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start()
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - surfaced to the caller
        raise RuntimeError(str(q.exception()))


def ingest_requests(stream: DataFrame, model_name: str, record_schema: T.StructType,
                    first_prediction_only: bool = True) -> DataFrame:
    """The request-log flattening applied to a stream."""
    return flatten_payload(stream, model_name, record_schema, first_prediction_only=first_prediction_only)


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB: on the executors' disks, not their
    heap, with change logs in the checkpoint, so it may hold far more keys than memory does.
    A checkpoint keeps the kind of state it began with."""
    prefix = "spark.sql.streaming.stateStore."
    wanted = {
        prefix + "providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        prefix + "rocksdb.changelogCheckpointing.enabled": "true",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def state_rows(spark: SparkSession, checkpoint: str) -> int:
    """Rows that the state of a stopped query holds (from its last committed batch)."""
    return spark.read.format("statestore").load(checkpoint).count()


def dedup_requests(stream: DataFrame, id_col: str = "databricks_request_id", ts_col: str = "request_time",
                   delay: str = "1 hour") -> DataFrame:
    """Drop repeated requests seen within the watermark delay.

    The ids of the delay's span are the state, no more: older ones expire, and a copy that comes
    later than that is late and dropped as such.  The state is in the checkpoint, so a copy
    that comes after a restart is dropped too."""
    return stream.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark([id_col])


def profile_state_stream(stream: DataFrame, ts: str, duration: str, keys: list[str], num_cols: list[str],
                         cat_cols: list[str] | None = None, delay: str = "1 hour") -> DataFrame:
    """Mergeable states (:mod:`tabforge.operators.sketches`) of tumbling windows with late
    data; append mode emits each window once, when the watermark passes its end.  State per
    open window is a bounded buffer: counts, moments, a quantile and a distinct sketch a column.

    The stream carries an observation (``SEEN``) of its rows and of those without a time,
    which no window takes; :func:`run_counted` keeps it."""
    timed = stream.withColumn(ts, as_timestamp(F.col(ts)))
    seen = timed.observe(SEEN, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(ts).isNull()).alias("untimed"))
    groups = seen.withWatermark(ts, delay).groupBy(F.window(ts, duration).alias("w"), *keys)
    out = groups.agg(*sketches.state_aggs(stream, num_cols, list(cat_cols or [])))
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *out.columns[1:])


def window_profile_stream(stream: DataFrame, ts: str, duration: str, keys: list[str], num_cols: list[str],
                          delay: str = "1 hour", cat_cols: list[str] | None = None, quantiles=(0.5,)) -> DataFrame:
    """T3 in readable form: nulls, extent, mean and sd (exact), quantiles and distinct counts from sketches."""
    return sketches.finish(profile_state_stream(stream, ts, duration, keys, num_cols, cat_cols, delay), quantiles)


def open_states(spark: SparkSession, checkpoint: str, keys: list[str], num_cols: list[str],
                cat_cols: list[str] | None = None) -> DataFrame:
    """The states of the windows that T3 has not emitted, read from the stopped query's own state
    store: exactly the rows it holds, late ones left out as it left them out.  The source is not
    read.  Emitted and open states together are all rows in time."""
    fields = ["n_rows: bigint", *[f"nulls_{i}: bigint" for i in range(len(dict.fromkeys([*num_cols, *(cat_cols or [])])))]]
    for i in range(len(num_cols)):  # the buffers of count, min, max, avg, var_pop and the sketch
        fields += [f"n_{i}: bigint, min_{i}: double, max_{i}: double, sum_{i}: double, of_{i}: bigint"]
        fields += [f"dev_n_{i}: double, dev_mean_{i}: double, m2_{i}: double, kll_{i}: binary"]
    fields += [f"hll_{i}: binary" for i in range(len(cat_cols or []))]
    held = spark.read.format("statestore").load(checkpoint)
    held = held.withColumn("v", F.col("value").cast("struct<" + ", ".join(fields) + ">"))
    cols = [F.col("key.window.start").alias("window_start"), F.col("key.window.end").alias("window_end")]
    cols += [F.col("key").getField(k).alias(k) for k in keys] + [F.col("v.n_rows")]
    cols += [F.col(f"v.nulls_{i}").alias(f"{c}_nulls") for i, c in enumerate(dict.fromkeys([*num_cols, *(cat_cols or [])]))]
    for i, c in enumerate(num_cols):
        mean = F.try_divide(F.col(f"v.sum_{i}"), F.col(f"v.of_{i}"))
        cols += [F.col(f"v.n_{i}").alias(f"{c}_n"), F.col(f"v.min_{i}").alias(f"{c}_min"), F.col(f"v.max_{i}").alias(f"{c}_max")]
        cols += [mean.alias(f"{c}_mean"), F.when(F.col(f"v.n_{i}") > 0, F.col(f"v.m2_{i}")).alias(f"{c}_m2"), F.col(f"v.kll_{i}").alias(f"{c}_kll")]
    cols += [F.col(f"v.hll_{i}").alias(f"{c}_hll") for i, c in enumerate(cat_cols or [])]
    return held.select(*cols)


def open_windows(spark: SparkSession, checkpoint: str, keys: list[str], num_cols: list[str],
                 cat_cols: list[str] | None = None, quantiles=(0.5,)) -> DataFrame:
    """:func:`open_states` in the form of :func:`window_profile_stream`."""
    return sketches.finish(open_states(spark, checkpoint, keys, num_cols, cat_cols), quantiles)


def run_counted(df: DataFrame, sink: str, checkpoint: str, ledger: str, partition_by=None) -> None:
    """:func:`run_available` that keeps each micro-batch's observed counts in the ``ledger``
    table: batch, rows, untimed, watermark.  A batch that is run again after a failure is there
    again; :func:`counted` takes its last entry."""
    w = df.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
    w = w.outputMode("append").trigger(availableNow=True)
    q = (w.partitionBy(*partition_by) if partition_by else w).start()
    told: dict[int, tuple] = {}
    try:
        done = False
        while not done:  # the query remembers its last 100 batches
            done = q.awaitTermination(1)
            for p in q.recentProgress:
                seen = (p["observedMetrics"] or {}).get(SEEN)
                if seen is not None:
                    told[p["batchId"]] = (p["batchId"], seen["rows"], seen["untimed"], p["eventTime"].get("watermark"), p["timestamp"])
    finally:
        if told:
            spark = df.sparkSession
            spark.createDataFrame(list(told.values()), LEDGER).coalesce(1).write.mode("append").parquet(ledger)


def counted(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger, one row per micro-batch."""
    rows = spark.read.schema(LEDGER).parquet(ledger)
    return rows.groupBy("batch").agg(F.max_by(F.struct("rows", "untimed", "watermark"), "at").alias("b")).select("batch", "b.*")


def account(spark: SparkSession, sink: str, checkpoint: str, ledger: str, keys: list[str], num_cols: list[str],
            cat_cols: list[str] | None = None) -> DataFrame:
    """Where the rows of a T3 stream are, as one row: input_rows, untimed_rows, emitted_rows (sink),
    open_rows (state) and late_rows, which the watermark dropped: all that is in none of the others.
    Late rows are NULL if the ledger misses a batch (a driver lost before it wrote)."""
    batches = counted(spark, ledger).agg(
        F.sum("rows").alias("input_rows"), F.sum("untimed").alias("untimed_rows"),
        (F.max("batch") + 1 == F.count(F.lit(1))).alias("whole"))
    emitted = spark.read.schema("n_rows long").parquet(sink).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n"))
    held = open_states(spark, checkpoint, keys, num_cols, cat_cols).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n"))
    out = batches.withColumns({"emitted_rows": emitted.scalar(), "open_rows": held.scalar()})
    late = F.when(F.col("whole"), F.col("input_rows") - F.col("untimed_rows") - F.col("emitted_rows") - F.col("open_rows"))
    return out.withColumn("late_rows", late).drop("whole")


def refresh_stream(stream: DataFrame, target_path: str, checkpoint: str, model_name: str,
                   record_schema: T.StructType, first_prediction_only: bool = True) -> None:
    """T1 through the batch refresh: each micro-batch of the request-log
    stream is handed to :func:`tabforge.plans.monitoring.refresh_monitoring`
    with ``foreachBatch``.  A micro-batch replayed after a failure is skipped
    request by request (table keys ∪ the ledger), so the effect is exactly
    once; which rows are shown is decided when the table is read, so the
    result does not depend on how files were grouped into micro-batches."""
    from tabforge.plans.monitoring import refresh_monitoring

    def run(batch: DataFrame, _epoch: int) -> None:
        refresh_monitoring(batch, target_path, model_name, record_schema, first_prediction_only=first_prediction_only)

    q = (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover
        raise RuntimeError(str(q.exception()))

"""Catalog: scans, sinks, versions, change feed, incremental loads.

Queries that exercise a sink write to a fresh folder under the shared
checkpoint folder (``spark.checkpoint.dir``) and read the result back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tabforge.operators import sampling
from tabforge.session import scratch_path
from tabforge.sources import tables, versions
from tabforge.plans.registry import ORACLES, register
from tabforge.sources.tables import load

CUT = "2024-01-16 00:00:00"


@register(
    "sql_scan",
    oracle="""
SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty,
       round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price,
       round(avg(l_discount), 6) AS avg_disc, count(*) AS count_order
FROM lineitem
GROUP BY l_returnflag, l_linestatus
""",
)
def q_sql_scan(spark, sf_dir):
    """SQL text over registered views: a whole-table scan under an aggregate."""
    tables.register_views(spark, sf_dir, ["lineitem"])
    return tables.sql_scan(
        spark,
        """
        SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty,
               round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price,
               round(avg(l_discount), 6) AS avg_disc, count(*) AS count_order
        FROM lineitem
        GROUP BY l_returnflag, l_linestatus
        """,
    )


@register(
    "csv_na_scan",
    oracle="""
SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN NULL
                       WHEN c_mktsegment = 'HOUSEHOLD' THEN 'none' ELSE c_mktsegment END AS c_mktsegment,
       c_acctbal, CAST(CASE WHEN c_nationkey = 3 THEN NULL ELSE c_nationkey END AS BIGINT) AS c_nationkey
FROM customer
""",
)
def q_csv_na_scan(spark, sf_dir):
    """CSV written with pandas-style missing tokens (``N/A``, ``null``,
    ``NA`` in a numeric column) and scanned back with inferred types; ``none``
    stays text."""
    c = load(spark, sf_dir, "customer")
    raw = c.select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        F.when(F.col("c_mktsegment") == "BUILDING", "N/A")
        .when(F.col("c_mktsegment") == "MACHINERY", "null")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "none")
        .otherwise(F.col("c_mktsegment"))
        .alias("c_mktsegment"),
        F.col("c_acctbal").cast("string").alias("c_acctbal"),
        F.when(F.col("c_nationkey") == 3, "NA").otherwise(F.col("c_nationkey").cast("string")).alias("c_nationkey"),
    )
    path = scratch_path(spark, f"csv/{uuid.uuid4().hex}")
    raw.write.option("header", True).csv(path)
    return tables.read_csv_na(spark, path)


def _cdf_versions(spark, sf_dir):
    """Two versions of the whole orders table, told apart by row attributes:
    pending (P) orders arrive in the new version, low-priority orders leave
    it, open (O) orders are repriced."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    old = o.filter(F.col("o_orderstatus") != "P").drop("o_orderpriority")
    new = o.filter(F.col("o_orderpriority") != "5-LOW").withColumn(
        "o_totalprice",
        F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
    ).drop("o_orderpriority")
    return old, new


@register(
    "change_feed",
    oracle="""
WITH old AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus != 'P'),
new AS (SELECT o_orderkey, o_orderstatus,
               CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
        FROM orders WHERE o_orderpriority != '5-LOW')
SELECT n.*, 'insert' AS _change_type FROM new n WHERE o_orderkey NOT IN (SELECT o_orderkey FROM old)
UNION ALL SELECT o.*, 'delete' FROM old o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new)
UNION ALL SELECT o.*, 'update_preimage' FROM old o JOIN new n USING (o_orderkey)
          WHERE o.o_totalprice IS DISTINCT FROM n.o_totalprice OR o.o_orderstatus IS DISTINCT FROM n.o_orderstatus
UNION ALL SELECT n.*, 'update_postimage' FROM old o JOIN new n USING (o_orderkey)
          WHERE o.o_totalprice IS DISTINCT FROM n.o_totalprice OR o.o_orderstatus IS DISTINCT FROM n.o_orderstatus
""",
)
def q_change_feed(spark, sf_dir):
    """Row-level changes between the two versions; every row of both
    versions is compared."""
    old, new = _cdf_versions(spark, sf_dir)
    return versions.change_feed(old, new, ["o_orderkey"])


def _versioned(spark, sf_dir):
    """Path of a table with three versions: write, append, overwrite."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = scratch_path(spark, f"versions/{uuid.uuid4().hex}")
    versions.write_version(o.filter(F.col("o_orderstatus") == "F"), path)
    versions.write_version(o.filter(F.col("o_orderstatus") == "O"), path, "APPEND", mode="append")
    versions.write_version(o, path)
    return path


@register(
    "table_history",
    oracle="""
SELECT CAST(0 AS BIGINT) AS version, 'WRITE' AS operation,
       count(*) FILTER (WHERE o_orderstatus = 'F') AS num_rows FROM orders
UNION ALL SELECT CAST(1 AS BIGINT), 'APPEND', count(*) FILTER (WHERE o_orderstatus IN ('F', 'O')) FROM orders
UNION ALL SELECT CAST(2 AS BIGINT), 'WRITE', count(*) FROM orders
""",
)
def q_table_history(spark, sf_dir):
    """Three versions (write, append, overwrite) and the history that the table itself gives."""
    return versions.history(spark, _versioned(spark, sf_dir)).select("version", "operation", "num_rows")


@register(
    "read_version",
    oracle="""
SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
WHERE o_orderstatus IN ('F', 'O') GROUP BY o_orderstatus
""",
)
def q_read_version(spark, sf_dir):
    """Time travel: read version 1 (after the append), not the latest."""
    v1 = versions.read_version(spark, _versioned(spark, sf_dir), 1)
    return v1.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@register(
    "read_by_lineage",
    oracle="""
WITH u AS (SELECT * FROM (VALUES ('run-a', 'training', 0), ('run-a', 'testing', 1), ('run-b', 'training', 1), ('run-c', 'training', 2)) t(run_id, context, v)),
j AS (SELECT * FROM u JOIN orders ON v = 2 OR (v = 1 AND o_orderstatus IN ('F', 'O')) OR (v = 0 AND o_orderstatus = 'F'))
SELECT run_id, context, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM j GROUP BY run_id, context
UNION ALL SELECT 'run-a', 'testing, alone', count(*), round(sum(o_totalprice), 2) FROM orders WHERE o_orderstatus IN ('F', 'O')
""",
)
def q_read_by_lineage(spark, sf_dir):
    """Three runs that used three versions of a table: the rows of every run by one join, and those of one run alone."""
    path = _versioned(spark, sf_dir)
    lineage = scratch_path(spark, f"lineage/{uuid.uuid4().hex}")
    for run, context, version in (("run-a", "training", 0), ("run-a", "testing", 1), ("run-b", "training", 1), ("run-c", "training", None)):
        versions.log_input(spark, lineage, run, context, path, version)
    every = versions.rows_by_lineage(spark.read.parquet(lineage), path)
    one = versions.read_by_lineage(spark, lineage, "run-a", "testing")
    one = one.withColumns({"run_id": F.lit("run-a"), "context": F.lit("testing, alone")})
    both = every.unionByName(one).groupBy("run_id", "context")
    return both.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


_CDF_SQL = ORACLES["change_feed"]


@register("change_feed_digest", oracle=_CDF_SQL)
def q_change_feed_digest(spark, sf_dir):
    """The change feed through range digests: only ranges of keys that differ are joined."""
    old, new = _cdf_versions(spark, sf_dir)
    return versions.change_feed_digest(old, new, ["o_orderkey"])


@register("change_feed_stored_digests", oracle=_CDF_SQL)
def q_change_feed_stored_digests(spark, sf_dir):
    """The same from digests stored with each version: unchanged ranges are found without reading either."""
    old, new = _cdf_versions(spark, sf_dir)
    stored = []
    for name, df in (("old", old), ("new", new)):
        path = scratch_path(spark, f"digests/{name}-{uuid.uuid4().hex}")
        versions.digests(df, ["o_orderkey"]).write.parquet(path)
        stored.append(spark.read.parquet(path))
    return versions.change_feed_digest(old, new, ["o_orderkey"], old_digests=stored[0], new_digests=stored[1])


@register(
    "incremental_load",
    oracle=f"SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '{CUT}'",
)
def q_incremental_load(spark, sf_dir):
    """New rows of the log relative to what the target already holds."""
    ev = load(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    target = ev.filter(F.col("ts") < F.lit(CUT).cast("timestamp_ntz"))
    return versions.new_rows(ev, target, ["event_id"]).select("event_id", "user_id")


@register(
    "incremental_load_rerun",
    oracle=f"""
SELECT count(*) FILTER (WHERE ts < TIMESTAMP '{CUT}') + 1 AS first_run,
       count(*) FILTER (WHERE ts >= TIMESTAMP '{CUT}') AS second_run,
       CAST(0 AS BIGINT) AS third_run, count(*) + 1 AS target_rows
FROM events
""",
)
def q_incremental_load_rerun(spark, sf_dir):
    """An empty first run, then three scheduled loads into a parquet target: the
    first half, the whole log (only the second half is new), the whole log again
    (nothing is new).  Every event comes twice and one has a NULL key; the target
    holds each exactly once."""
    ev = load(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    target = scratch_path(spark, f"incremental/{uuid.uuid4().hex}")
    versions.load_new(ev.limit(0), target, ["event_id"])  # an empty first run
    # every row twice, and one row whose key is NULL
    odd = ev.agg(F.lit(None).cast("long").alias("event_id"), F.min("user_id").alias("user_id"), F.min("ts").alias("ts"))
    ev = ev.unionAll(ev).unionAll(odd)
    first = versions.load_new(ev.filter(F.col("ts") < F.lit(CUT).cast("timestamp_ntz")), target, ["event_id"])
    second = versions.load_new(ev, target, ["event_id"])
    third = versions.load_new(ev, target, ["event_id"])
    total = spark.read.parquet(target).agg(F.count(F.lit(1)).alias("target_rows"))
    return total.select(
        F.lit(first).cast("long").alias("first_run"),
        F.lit(second).cast("long").alias("second_run"),
        F.lit(third).cast("long").alias("third_run"),
        "target_rows",
    )


@register("incremental_load_bucketed", oracle=ORACLES["incremental_load_rerun"])
def q_incremental_load_bucketed(spark, sf_dir):
    """The scheduled loads into a table bucketed by the key, whose side of the join is never shuffled."""
    ev = load(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    name = f"tabforge_events_{uuid.uuid4().hex}"
    place = scratch_path(spark, f"tables/{name}")
    load_into = lambda src: versions.load_new_bucketed(src, name, ["event_id"], 8, location=place)
    load_into(ev.limit(0))  # an empty first run
    odd = ev.agg(F.lit(None).cast("long").alias("event_id"), F.min("user_id").alias("user_id"), F.min("ts").alias("ts"))
    ev = ev.unionAll(ev).unionAll(odd)
    first = load_into(ev.filter(F.col("ts") < F.lit(CUT).cast("timestamp_ntz")))
    second, third = load_into(ev), load_into(ev)
    spark.sql(f"DROP TABLE {name}")  # its files stay
    total = spark.read.parquet(place).agg(F.count(F.lit(1)).alias("target_rows"))
    return total.select(
        F.lit(first).cast("long").alias("first_run"),
        F.lit(second).cast("long").alias("second_run"),
        F.lit(third).cast("long").alias("third_run"),
        "target_rows",
    )


@register(
    "partition_append",
    oracle="""
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids
FROM events GROUP BY 1, 2
""",
)
def q_partition_append(spark, sf_dir):
    """Append sink partitioned by day, in two appends; every day is read back."""
    ev = load(spark, sf_dir, "events").select("event_id", "event_type", "ts", F.to_date("ts").alias("day"))
    path = scratch_path(spark, f"by_day/{uuid.uuid4().hex}")
    first = F.col("event_type") == "click"
    tables.append(ev.where(first), path, partition_by=["day"])
    tables.append(ev.where(~first), path, partition_by=["day"])
    back = spark.read.parquet(path)
    days = back.groupBy(F.date_format("day", "yyyy-MM-dd").alias("day"), "event_type")
    return days.agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


_RELOADED = ("2024-01-03", "2024-01-20")


@register(
    "partition_overwrite",
    oracle=f"""
WITH d AS (SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, event_type, event_id FROM events)
SELECT day, event_type, CASE WHEN day IN {_RELOADED} THEN 'reload' ELSE 'first' END AS loaded,
       count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids
FROM d GROUP BY day, event_type
""",
)
def q_partition_overwrite(spark, sf_dir):
    """A table by day, of which two days are reloaded: first with half of their rows, then
    with all of them twice over, at last with no rows.  The reloaded days hold each row once,
    all other days are as first loaded."""
    ev = load(spark, sf_dir, "events").select("event_id", "event_type", "ts", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    path = scratch_path(spark, f"reload/{uuid.uuid4().hex}")
    tables.overwrite_partitions(ev.withColumn("loaded", F.lit("first")), path, ["day"])
    days = ev.where(F.col("day").isin(*_RELOADED)).withColumn("loaded", F.lit("reload"))
    for part in (days.where("event_id % 2 = 0"), days, days, days.limit(0)):
        tables.overwrite_partitions(part, path, ["day"])
    back = spark.read.schema(days.schema).parquet(path)
    return back.groupBy("day", "event_type", "loaded").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@register(
    "catalog_table_sinks",
    oracle="SELECT c_custkey, c_mktsegment, c_acctbal FROM customer",
)
def q_catalog_table_sinks(spark, sf_dir):
    """Overwrite and append sinks by table name: a first version is replaced by
    half of the customers, the other half is appended (its columns in another
    order), and the table is read back by name."""
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    name = f"tabforge_customers_{uuid.uuid4().hex}"
    place = scratch_path(spark, f"tables/{name}")
    half = F.col("c_custkey") % 2 == 0
    tables.write_snapshot(c.withColumn("c_acctbal", F.lit(0.0)), name, location=place)
    tables.write_snapshot(c.where(half), name, location=place)
    tables.append(c.where(~half).select("c_acctbal", "c_custkey", "c_mktsegment"), name)
    return tables.read_table(spark, name)


@register(
    "local_rows_roundtrip",
    oracle="""
SELECT l_orderkey, l_linenumber, l_extendedprice, CASE WHEN l_tax > 0.04 THEN l_tax END AS l_tax
FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 25
""",
)
def q_local_rows_roundtrip(spark, sf_dir):
    """The 25 dearest line items handed to local memory (a bounded preview) and back
    as a table; NaN that local memory uses for missing numbers is NULL again."""
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", F.when(F.col("l_tax") > 0.04, F.col("l_tax")).alias("l_tax")
    )
    top = sampling.top_n(li, 25, [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")])
    return tables.from_local(spark, tables.preview(top, 25), schema=top.schema)

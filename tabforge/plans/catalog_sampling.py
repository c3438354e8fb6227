"""Catalog: splitting and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.functions.hashing import hash52_sql, key_sql
from tabforge.operators import sampling
from tabforge.plans.registry import register
from tabforge.sources.tables import load

_H_ORDERS = hash52_sql(key_sql("o_orderkey", seed=42))


@register(
    "split_exact",
    oracle=f"""
WITH h AS (SELECT o_orderkey, {_H_ORDERS} AS h, CAST(o_orderkey AS VARCHAR) AS kt FROM orders),
r AS (SELECT o_orderkey, row_number() OVER (ORDER BY h, kt) AS rn FROM h)
SELECT o_orderkey, CASE WHEN rn <= ceil(0.2 * (SELECT count(*) FROM orders)) THEN 'test' ELSE 'train' END AS split
FROM r
""",
)
def q_split_exact(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey")
    return sampling.assign_split_exact(o, ["o_orderkey"], 0.2, 42)


@register(
    "split_exact_dup_keys",
    oracle="""
SELECT l_suppkey, split, count(*) AS n FROM (
  SELECT l_suppkey, CASE WHEN row_number() OVER (ORDER BY h, kt) <= ceil(0.2 * (SELECT count(*) FROM lineitem))
              THEN 'test' ELSE 'train' END AS split
  FROM (SELECT l_suppkey, """
    + hash52_sql(key_sql("l_suppkey", seed=7))
    + """ AS h, CAST(l_suppkey AS VARCHAR) AS kt FROM lineitem))
GROUP BY l_suppkey, split
""",
)
def q_split_exact_dup_keys(spark, sf_dir):
    """Split keyed by a heavily repeated key (supplier): identical keys
    straddle the cut and the exact count is still honoured.  Rows of one key
    are interchangeable, so each key's rows on either side are the whole result."""
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    lab = sampling.assign_split_exact(li, ["l_suppkey"], 0.2, 7)
    return lab.groupBy("l_suppkey", "split").agg(F.count(F.lit(1)).alias("n"))


@register(
    "split_hash",
    oracle=f"""
SELECT c_custkey,
       CASE WHEN {hash52_sql(key_sql("c_custkey", seed=42))} % 10000 < 2000 THEN 'test' ELSE 'train' END AS split
FROM customer
""",
)
def q_split_hash(spark, sf_dir):
    c = load(spark, sf_dir, "customer").select("c_custkey")
    return sampling.assign_split_hash(c, ["c_custkey"], 0.2, 42)


@register(
    "resample",
    oracle="""
WITH t AS (SELECT c_custkey, c_nationkey, c_acctbal, row_number() OVER (ORDER BY c_custkey) - 1 AS rn FROM customer),
d AS (SELECT rn AS draw_id, """
    + hash52_sql("concat_ws('|', CAST(rn AS VARCHAR), 'draw', '7')")
    + """ % (SELECT count(*) FROM customer) AS rn FROM t)
SELECT d.draw_id, t.c_custkey, t.c_nationkey, t.c_acctbal FROM d JOIN t ON d.rn = t.rn
""",
)
def q_resample(spark, sf_dir):
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return sampling.resample(c, "c_custkey", seed=7)


@register(
    "resample_string_key",
    oracle="""
WITH t AS (SELECT c_custkey, c_mktsegment, 'c-' || CAST(c_custkey % 97 AS VARCHAR) AS name FROM customer),
r AS (SELECT *, row_number() OVER (ORDER BY name) - 1 AS rn FROM t),
d AS (SELECT rn AS draw_id, """
    + hash52_sql("concat_ws('|', CAST(rn AS VARCHAR), 'draw', '9')")
    + """ % (SELECT count(*) FROM customer) AS pick FROM r)
SELECT d.draw_id, r.name FROM d JOIN r ON d.pick = r.rn
""",
)
def q_resample_string_key(spark, sf_dir):
    """Text order key with many ties: every draw finds exactly one row, and the
    drawn key is the one at that place of the order."""
    c = load(spark, sf_dir, "customer").select(
        "c_custkey", "c_mktsegment", F.concat(F.lit("c-"), (F.col("c_custkey") % 97).cast("string")).alias("name")
    )
    return sampling.resample(c, "name", seed=9).select("draw_id", "name")


@register(
    "top_n",
    oracle="""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
""",
)
def q_top_n(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return sampling.top_n(o, 10, [F.desc("o_totalprice"), F.asc("o_orderkey")])

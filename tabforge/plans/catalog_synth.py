"""Catalog: synthetic tables.

The oracle rebuilds every draw from the same md5 text, so Spark and DuckDB
agree row by row.  Row ids ``0..n-1`` in SQL come from
``row_number() OVER () - 1`` over the source (n = source size).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.functions.hashing import uniform_pair_sql, uniform_sql
from tabforge.operators import synth
from tabforge.plans.registry import register
from tabforge.sources.tables import load

SEED = 42


def _u(column: str, what: str) -> str:
    return uniform_sql(f"concat_ws('|', CAST(row_id AS VARCHAR), '{column}:{what}', '{SEED}')")


def _normal_sql(column: str, m: str, s: str) -> str:
    u1, u2 = uniform_pair_sql(f"concat_ws('|', CAST(row_id AS VARCHAR), '{column}:n', '{SEED}')")
    return f"({m} + {s} * sqrt(-2.0 * ln(1.0 - {u1})) * cos({2.0 * 3.141592653589793!r} * {u2}))"


def _intervals_sql(name: str, src: str, expr: str, total: str) -> str:
    return f"""iv_{name} AS (
  SELECT v, (sum(n) OVER (ORDER BY CAST(v AS VARCHAR) NULLS FIRST) - n) / {total} AS lo,
            sum(n) OVER (ORDER BY CAST(v AS VARCHAR) NULLS FIRST) / {total} AS hi
  FROM (SELECT {expr} AS v, count(*) AS n FROM {src} GROUP BY 1))"""


def _stats_sql(expr: str, table: str) -> tuple[str, str]:
    return f"(SELECT avg({expr}) FROM {table})", f"(SELECT stddev_samp({expr}) FROM {table})"


@register(
    "synthetic_numeric",
    oracle=f"""
WITH r AS (SELECT row_number() OVER () - 1 AS row_id FROM lineitem)
SELECT row_id,
  round(greatest(0.1, {_normal_sql('l_quantity', *_stats_sql('l_quantity', 'lineitem'))}), 6) AS l_quantity,
  round({_normal_sql('l_discount', *_stats_sql('l_discount', 'lineitem'))}, 6) AS l_discount,
  CAST(round({_normal_sql('l_linenumber', *_stats_sql('CAST(l_linenumber AS DOUBLE)', 'lineitem'))}) AS INTEGER) AS l_linenumber,
  round({_normal_sql('tiny', *_stats_sql('l_tax * 1e-9::DOUBLE', 'lineitem'))} * 1e9::DOUBLE, 6) AS tiny_nano,
  CAST(CAST({_normal_sql('price', *_stats_sql('CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE)', 'lineitem'))} AS DECIMAL(18,2)) AS DOUBLE) AS price
FROM r
""",
)
def q_synthetic_numeric(spark, sf_dir):
    """Numerics of several kinds from one aggregate: floored, plain, whole numbers,
    values of the order of 1e-9, and a decimal that stays one."""
    src = load(spark, sf_dir, "lineitem").select(
        "l_quantity",
        "l_discount",
        F.col("l_linenumber").cast("int").alias("l_linenumber"),
        (F.col("l_tax") * 1e-9).alias("tiny"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
    )
    spec = synth.SynthSpec(n=src.count(), seed=SEED, id_col=None, floor_cols={"l_quantity": 0.1})
    out = synth.synthesize(src, spec)
    return out.select(
        "row_id",
        F.round("l_quantity", 6).alias("l_quantity"),
        F.round("l_discount", 6).alias("l_discount"),
        "l_linenumber",
        F.round(F.col("tiny") * 1e9, 6).alias("tiny_nano"),
        F.col("price").cast("double").alias("price"),
    )


@register(
    "synthetic_categorical",
    oracle=f"""
WITH {_intervals_sql('p', 'orders', "nullif(o_orderpriority, '5-LOW')", '(SELECT count(*) FROM orders)')},
{_intervals_sql('s', 'orders', 'o_orderstatus', '(SELECT count(*) FROM orders)')},
r AS (SELECT row_number() OVER () - 1 AS row_id FROM orders),
d AS (SELECT row_id, {_u('o_orderpriority', 'u')} AS up, {_u('o_orderstatus', 'u')} AS us FROM r)
SELECT d.row_id, p.v AS o_orderpriority, s.v AS o_orderstatus
FROM d LEFT JOIN iv_p p ON d.up >= p.lo AND d.up < p.hi
       LEFT JOIN iv_s s ON d.us >= s.lo AND d.us < s.hi
""",
)
def q_synthetic_categorical(spark, sf_dir):
    """Categories drawn by frequency, weights aligned to their values, NULL
    a category of its own."""
    src = load(spark, sf_dir, "orders").select(
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"), "o_orderstatus"
    )
    return synth.synthesize(src, synth.SynthSpec(n=src.count(), seed=SEED, id_col=None))


@register(
    "synthetic_timestamp",
    oracle=f"""
WITH r AS (SELECT row_number() OVER () - 1 AS row_id FROM events)
SELECT row_id,
  (SELECT epoch_us(min(ts)) FROM events)
  + CAST(floor({_u('ts', 'u')} * ((SELECT epoch_us(max(ts)) FROM events) - (SELECT epoch_us(min(ts)) FROM events)))
         AS BIGINT) AS ts_us
FROM r
""",
)
def q_synthetic_timestamp(spark, sf_dir):
    src = load(spark, sf_dir, "events").select("ts")
    out = synth.synthesize(src, synth.SynthSpec(n=src.count(), seed=SEED, id_col=None))
    return out.select("row_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"))


def _table_sql(drift: bool) -> str:
    acct = _normal_sql("c_acctbal", *_stats_sql("c_acctbal", "customer"))
    acct = f"greatest(0.1, {acct})"
    if drift:
        acct = f"{acct} * 1.5"
        seg = f"CASE WHEN {_u('c_mktsegment', 'u')} < 0.7 THEN 'AUTOMOBILE' ELSE 'BUILDING' END"
    else:
        seg = "s.v"
    return f"""
WITH {_intervals_sql('n', 'customer', 'c_nationkey', '(SELECT count(*) FROM customer)')},
{_intervals_sql('s', 'customer', 'c_mktsegment', '(SELECT count(*) FROM customer)')},
r AS (SELECT row_number() OVER () - 1 AS row_id FROM customer),
d AS (SELECT row_id, {_u('c_nationkey', 'u')} AS un, {_u('c_mktsegment', 'u')} AS us FROM r)
SELECT d.row_id, round({acct}, 6) AS c_acctbal, n.v AS c_nationkey, {seg} AS c_mktsegment,
       CAST(1000000 + d.row_id AS VARCHAR) AS c_custkey
FROM d LEFT JOIN iv_n n ON d.un >= n.lo AND d.un < n.hi
       LEFT JOIN iv_s s ON d.us >= s.lo AND d.us < s.hi
"""


def _table(spark, sf_dir, drift: bool):
    src = load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")
    spec = synth.SynthSpec(
        n=src.count(),
        seed=SEED,
        id_col="c_custkey",
        id_base=1_000_000,
        floor_cols={"c_acctbal": 0.1},
        drift=drift,
        ints_as_normal=False,  # a nation key is a category
        digits=6,
        drift_scale={"c_acctbal": 1.5},
        drift_redraw={"c_mktsegment": [("AUTOMOBILE", 0.7), ("BUILDING", 0.3)]},
    )
    return synth.synthesize(src, spec)


@register("synthetic_table", oracle=_table_sql(False))
def q_synthetic_table(spark, sf_dir):
    """Whole-table generator: normal balance floored at 0.1, nation and
    segment by frequency, new ids ``1000000 + i`` as text."""
    return _table(spark, sf_dir, drift=False)


@register("synthetic_drift", oracle=_table_sql(True))
def q_synthetic_drift(spark, sf_dir):
    """Same with drift: balance ×1.5, segment redrawn 0.7 / 0.3."""
    return _table(spark, sf_dir, drift=True)


@register(
    "synthetic_bootstrap",
    oracle=f"""
WITH t AS (SELECT vec_id, embedding, row_number() OVER (ORDER BY vec_id) - 1 AS rn, count(*) OVER () AS n FROM embeddings),
d AS (SELECT rn AS row_id, CAST(floor({_u('embedding', 'u').replace('row_id', 'rn')} * n) AS BIGINT) AS pick FROM t)
SELECT d.row_id, CAST(len(s.embedding) AS BIGINT) AS dim, CAST(s.embedding[1] AS DOUBLE) AS first_value,
       CAST(s.embedding[len(s.embedding)] AS DOUBLE) AS last_value
FROM d JOIN t s ON s.rn = d.pick
""",
)
def q_synthetic_bootstrap(spark, sf_dir):
    """Array column (embeddings) bootstrapped: each synthetic row is a uniform
    draw of a source row, in the order of the source's ids."""
    src = load(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    out = synth.synthesize(src, synth.SynthSpec(n=src.count(), seed=SEED, id_col=None, bootstrap_order="vec_id"))
    return out.select(
        "row_id",
        F.size("embedding").cast("long").alias("dim"),
        F.element_at("embedding", 1).cast("double").alias("first_value"),
        F.element_at("embedding", -1).cast("double").alias("last_value"),
    )

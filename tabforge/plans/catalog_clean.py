"""Catalog: cleaning operators (P1-P24) and the cleaning chain.

Test tables hold no NULLs in these columns, so queries (and their oracles
alike) produce NULLs with ``nullif`` / ``CASE`` before the operator runs.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.functions.casts import try_cast_text
from tabforge.functions.timefn import epoch_ms
from tabforge.operators import clean
from tabforge.operators.payload import drop_null_or_keep
from tabforge.plans.registry import register
from tabforge.sources.tables import load, normalise_na


@register(
    "rename_project",
    oracle="""
SELECT p_size, p_retailprice, p_brand AS brand, p_type AS kind, p_partkey FROM part
""",
)
def q_rename_project(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    out = clean.rename(part, {"p_brand": "brand", "p_type": "kind", "absent_col": "ignored"})
    return clean.project(out, num=["p_size", "p_retailprice"], cat=["brand", "kind"], id_col="p_partkey")


@register(
    "fill_nulls",
    oracle="""
SELECT o_orderkey, coalesce(nullif(o_orderpriority, '5-LOW'), 'Unknown') AS o_orderpriority,
       coalesce(nullif(o_orderstatus, 'P'), 'Unknown') AS o_orderstatus
FROM orders
""",
)
def q_fill_nulls(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
        F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
    )
    return clean.fill(o, {"o_orderpriority": "Unknown", "o_orderstatus": "Unknown"})


@register(
    "presence_flag",
    oracle="""
SELECT c_custkey, CAST(nullif(c_mktsegment, 'BUILDING') IS NOT NULL AS INTEGER) AS has_segment
FROM customer
""",
)
def q_presence_flag(spark, sf_dir):
    c = load(spark, sf_dir, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment")
    )
    return clean.presence(c, "c_mktsegment", "has_segment").select("c_custkey", "has_segment")


@register(
    "keep_in",
    oracle="""
SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
""",
)
def q_keep_in(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return clean.keep_in(o, "o_orderpriority", ["1-URGENT", "2-HIGH"])


@register(
    "in_or_else",
    oracle="""
SELECT c_custkey,
       CASE WHEN coalesce(nullif(c_mktsegment, 'BUILDING'), 'Unknown') IN ('AUTOMOBILE', 'MACHINERY')
            THEN c_mktsegment ELSE 'Other' END AS c_mktsegment
FROM customer
""",
)
def q_in_or_else(spark, sf_dir):
    c = load(spark, sf_dir, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment")
    )
    c = clean.fill(c, {"c_mktsegment": "Unknown"})
    return clean.in_or_else(c, "c_mktsegment", ["AUTOMOBILE", "MACHINERY"], "Other")


@register(
    "replace_values",
    oracle="""
SELECT o_orderkey,
       CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' ELSE o_orderstatus END AS o_orderstatus
FROM orders
""",
)
def q_replace_values(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return clean.replace_values(o, "o_orderstatus", {"F": "Finished", "O": "Open"})


@register(
    "keyword_flag",
    oracle="""
SELECT p_partkey, p_name,
       CAST(contains(lower(p_name), 'red') OR contains(lower(p_name), 'blue') AS INTEGER) AS is_colour
FROM part
""",
)
def q_keyword_flag(spark, sf_dir):
    p = load(spark, sf_dir, "part").select("p_partkey", "p_name")
    return clean.keyword_flag(p, "p_name", ["RED", "Blue"], "is_colour")


PART_RULES = [
    (["bolt", "rod", "ring"], "Hardware"),
    (["gear", "widget", "gizmo"], "Mechanism"),
    (["red", "blue"], "Coloured"),
    (["plate", "anvil"], "Heavy"),
]


@register(
    "keyword_class",
    oracle="""
SELECT p_partkey,
       CASE WHEN contains(lower(p_name), 'bolt') OR contains(lower(p_name), 'rod') OR contains(lower(p_name), 'ring')
              THEN 'Hardware'
            WHEN contains(lower(p_name), 'gear') OR contains(lower(p_name), 'widget') OR contains(lower(p_name), 'gizmo')
              THEN 'Mechanism'
            WHEN contains(lower(p_name), 'red') OR contains(lower(p_name), 'blue') THEN 'Coloured'
            WHEN contains(lower(p_name), 'plate') OR contains(lower(p_name), 'anvil') THEN 'Heavy'
            ELSE 'Other' END AS p_class
FROM part
""",
)
def q_keyword_class(spark, sf_dir):
    p = load(spark, sf_dir, "part").select("p_partkey", "p_name")
    return clean.classify(p, "p_name", PART_RULES, "Other", into="p_class").select("p_partkey", "p_class")


@register(
    "collapse_rare",
    oracle="""
WITH src AS (SELECT p_partkey, coalesce(p_brand, 'Unknown') AS p_brand FROM part),
     c AS (SELECT p_brand, count(*) AS n FROM src GROUP BY p_brand)
SELECT s.p_partkey, CASE WHEN c.n >= 80 THEN s.p_brand ELSE 'Other' END AS p_brand
FROM src s JOIN c USING (p_brand)
""",
)
def q_collapse_rare(spark, sf_dir):
    p = load(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return clean.collapse_rare(p, "p_brand", min_count=80)


@register(
    "collapse_to_top",
    oracle="""
WITH src AS (SELECT doc_id, coalesce(CASE WHEN doc_id % 9 <> 0 THEN source END, 'Unknown') AS source FROM documents),
     c AS (SELECT source, row_number() OVER (ORDER BY count(*) DESC, source) AS place FROM src GROUP BY source)
SELECT s.doc_id, CASE WHEN c.place <= 4 THEN s.source ELSE 'Other' END AS source FROM src s JOIN c USING (source)
""",
)
def q_collapse_to_top(spark, sf_dir):
    """The four most frequent sources stay (missing ones are one of them), others are one value."""
    docs = load(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 9 != 0, F.col("source")).alias("source"))
    return clean.collapse_to_top(docs, "source", 4)


@register(
    "binarise_target",
    oracle="""
SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS o_orderstatus
FROM orders WHERE o_orderstatus IN ('F', 'O')
""",
)
def q_binarise_target(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return clean.binarise(o, "o_orderstatus", "F", "O")


@register(
    "cast_cols",
    oracle="""
SELECT l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber, CAST(l_suppkey AS DOUBLE) AS l_suppkey,
       TRY_CAST(l_returnflag AS INTEGER) AS l_returnflag
FROM lineitem
""",
)
def q_cast_cols(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag")
    return clean.cast_cols(li, {"l_linenumber": "string", "l_suppkey": "double", "l_returnflag": "int"})


@register(
    "drop_null_fallback",
    oracle="""
SELECT event_id, value FROM (
  SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value FROM events)
WHERE value IS NOT NULL
""",
)
def q_drop_null_fallback(spark, sf_dir):
    """Some rows NULL → they are dropped."""
    ev = load(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    )
    return drop_null_or_keep(ev, ["value"])


@register(
    "drop_null_keep_all",
    oracle="""
SELECT event_id, TRY_CAST(event_type AS INTEGER) AS prediction FROM events
""",
)
def q_drop_null_keep_all(spark, sf_dir):
    """Every prediction fails to parse → dropping would empty the table → keep all."""
    ev = load(spark, sf_dir, "events").select(
        "event_id", try_cast_text(F.col("event_type"), "int").alias("prediction")
    )
    return drop_null_or_keep(ev, ["prediction"])


@register(
    "epoch_ms",
    oracle="""
SELECT event_id, epoch_us(ts) // 1000000 * 1000 AS ts_ms, epoch_us(ts) // 1000 AS ts_ms_exact FROM events
""",
)
def q_epoch_ms(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    return ev.select(
        "event_id", epoch_ms(F.col("ts")).alias("ts_ms"), epoch_ms(F.col("ts"), exact=True).alias("ts_ms_exact")
    )


@register(
    "nan_to_null",
    oracle="""
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value FROM events
""",
)
def q_nan_to_null(spark, sf_dir):
    from tabforge.functions.nulls import nan_to_null

    ev = load(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
    )
    return nan_to_null(ev, ["value"])


@register(
    "na_tokens",
    oracle="""
SELECT c_custkey,
       CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'MACHINERY' THEN NULL WHEN 'HOUSEHOLD' THEN 'none'
            ELSE c_mktsegment END AS c_mktsegment
FROM customer
""",
)
def q_na_tokens(spark, sf_dir):
    """Missing-value tokens (``N/A``, ``null``) become NULL; lower-case
    ``none`` is not a token and stays text."""
    c = load(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("N/A"))
        .when(F.col("c_mktsegment") == "MACHINERY", F.lit("null"))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("none"))
        .otherwise(F.col("c_mktsegment"))
        .alias("c_mktsegment"),
    )
    return normalise_na(c, ["c_mktsegment"])


@register(
    "decode_label",
    oracle="""
SELECT doc_id, CASE WHEN quality = 1 THEN 'alive' ELSE 'dead' END AS label FROM labels
""",
)
def q_decode_label(spark, sf_dir):
    lab = load(spark, sf_dir, "labels").select("doc_id", "quality")
    return clean.decode(lab, "quality", {1: "alive"}, "dead", into="label").select("doc_id", "label")


PART_SPEC = clean.CleanSpec(
    rename={"p_brand": "brand", "p_type": "ptype", "p_name": "pname"},
    rare={"brand": 80},
    replace={"ptype": {"PROMO": "PROMOTION"}},
    allow={"ptype": ["MEDIUM", "STANDARD", "LARGE", "PROMOTION", "SMALL"]},
    in_or_else={"ptype": ["MEDIUM", "LARGE", "SMALL"]},
    flags=[("pname", ["red", "blue"], "coloured"), ("pname", ["hot"], "hot")],
    classify={"pname": PART_RULES},
    num=["p_size", "p_retailprice", "coloured", "hot"],
    cat=["brand", "ptype", "pname"],
    id_col="p_partkey",
    id_into="Id",
)


@register(
    "clean_chain",
    oracle="""
WITH c AS (SELECT coalesce(p_brand, 'Unknown') AS b, count(*) AS n FROM part GROUP BY 1),
     s AS (
  SELECT p.*, CASE WHEN c.n >= 80 THEN c.b ELSE 'Other' END AS brand,
         CASE WHEN p_type = 'PROMO' THEN 'PROMOTION' ELSE p_type END AS pt
  FROM part p JOIN c ON coalesce(p.p_brand, 'Unknown') = c.b)
SELECT p_size, p_retailprice,
       CAST(contains(lower(p_name), 'red') OR contains(lower(p_name), 'blue') AS INTEGER) AS coloured,
       CAST(contains(lower(p_name), 'hot') AS INTEGER) AS hot,
       brand,
       CASE WHEN pt IN ('MEDIUM', 'LARGE', 'SMALL') THEN pt ELSE 'Other' END AS ptype,
       CASE WHEN contains(lower(p_name), 'bolt') OR contains(lower(p_name), 'rod') OR contains(lower(p_name), 'ring')
              THEN 'Hardware'
            WHEN contains(lower(p_name), 'gear') OR contains(lower(p_name), 'widget') OR contains(lower(p_name), 'gizmo')
              THEN 'Mechanism'
            WHEN contains(lower(p_name), 'red') OR contains(lower(p_name), 'blue') THEN 'Coloured'
            WHEN contains(lower(p_name), 'plate') OR contains(lower(p_name), 'anvil') THEN 'Heavy'
            ELSE 'Other' END AS pname,
       CAST(p_partkey AS VARCHAR) AS Id
FROM s WHERE pt IN ('MEDIUM', 'STANDARD', 'LARGE', 'PROMOTION', 'SMALL')
""",
)
def q_clean_chain(spark, sf_dir):
    """The whole cleaning recipe on ``part``: rename → rare collapse →
    replace → allow-list → in-or-else → flags → classify → project."""
    return clean.clean(load(spark, sf_dir, "part"), PART_SPEC)


@register(
    "load_stamp",
    oracle="SELECT count(*) AS n_rows, CAST(1 AS BIGINT) AS n_stamps FROM orders",
)
def q_load_stamp(spark, sf_dir):
    """Load timestamp: one value for every row of a write."""
    out = clean.stamp(load(spark, sf_dir, "orders").select("o_orderkey"))
    return out.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("update_timestamp_utc").alias("n_stamps")
    )

"""Catalog: dictionaries, routing, contracts, training and scoring (M1-M9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.operators import boosting, experiment, features, model
from tabforge.operators.sampling import assign_split_hash
from tabforge.plans.registry import register
from tabforge.sources.tables import load

ENC_COLS = ["o_orderpriority", "o_orderstatus", "o_custkey"]

_FIT_SQL = """
WITH src AS (SELECT * FROM orders WHERE {where}),
l AS (SELECT DISTINCT column_name, value FROM (
        SELECT 'o_orderpriority' AS column_name, o_orderpriority AS value FROM src
        UNION ALL SELECT 'o_orderstatus', o_orderstatus FROM src
        UNION ALL SELECT 'o_custkey', CAST(o_custkey AS VARCHAR) FROM src) WHERE value IS NOT NULL),
d AS (SELECT column_name, value, dense_rank() OVER (PARTITION BY column_name ORDER BY value) - 1 AS code FROM l)
"""


_SEEN = "o_orderstatus IN ('F', 'O')"


def _fit(spark, sf_dir):
    return features.fit_codes(load(spark, sf_dir, "orders").filter(_SEEN), ENC_COLS)


@register("encode_fit", oracle=_FIT_SQL.format(where="true") + "SELECT column_name, value, code FROM d")
def q_encode_fit(spark, sf_dir):
    """Dictionary of three columns over all orders, one dense index per column."""
    return features.fit_codes(load(spark, sf_dir, "orders"), ENC_COLS)


@register(
    "encode_apply",
    oracle=_FIT_SQL.format(where=_SEEN)
    + """
SELECT o.o_orderkey,
       coalesce(a.code, -1) AS o_orderpriority_code,
       coalesce(b.code, -1) AS o_orderstatus_code,
       coalesce(c.code, -1) AS o_custkey_code
FROM orders o
LEFT JOIN d a ON a.column_name = 'o_orderpriority' AND a.value = nullif(o.o_orderpriority, '3-MEDIUM')
LEFT JOIN d b ON b.column_name = 'o_orderstatus' AND b.value = o.o_orderstatus
LEFT JOIN d c ON c.column_name = 'o_custkey' AND c.value = CAST(o.o_custkey AS VARCHAR)
""",
)
def q_encode_apply(spark, sf_dir):
    """Apply a dictionary fitted on the F/O orders to all orders: status P is
    unseen, a NULLed priority → -1."""
    o = load(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif("o_orderpriority", F.lit("3-MEDIUM")).alias("o_orderpriority"),
        "o_orderstatus",
        "o_custkey",
    )
    out = features.apply_codes(o, _fit(spark, sf_dir), ENC_COLS, suffix="_code")
    return out.select("o_orderkey", *[f"{c}_code" for c in ENC_COLS])


_ARM_SQL = "CASE WHEN ('0x' || substr(md5(CAST({c} AS VARCHAR)), 32, 1))::INTEGER % 2 = 1 THEN 'A' ELSE 'B' END"


@register("ab_route", oracle=f"SELECT c_custkey, {_ARM_SQL.format(c='c_custkey')} AS arm FROM customer")
def q_ab_route(spark, sf_dir):
    c = load(spark, sf_dir, "customer").select("c_custkey")
    return experiment.route(c, "c_custkey", ("A", "B"))


@register(
    "ab_summary",
    oracle=f"""
WITH r AS (SELECT {_ARM_SQL.format(c='o_custkey')} AS arm, o_totalprice, o_custkey FROM orders),
g AS (SELECT arm, count(*) AS n, count(DISTINCT o_custkey) AS users, avg(o_totalprice) AS m,
             stddev_samp(o_totalprice) AS sd FROM r GROUP BY arm)
SELECT arm, n, users, round(m, 6) AS mean, round(sd, 6) AS sd,
       round(m - (SELECT m FROM g WHERE arm = 'A'), 6) AS diff,
       round((m - (SELECT m FROM g WHERE arm = 'A'))
             / sqrt(sd * sd / n + (SELECT sd * sd / n FROM g WHERE arm = 'A')), 6) AS z
FROM g
""",
)
def q_ab_summary(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_custkey", "o_totalprice")
    routed = experiment.route(o, "o_custkey", ("A", "B"))
    return experiment.ab_summary(routed, "arm", "o_totalprice", user_col="o_custkey", control="A")


CONTRACT = {"event_id": "bigint", "value": "double", "event_type": "int", "props": "int", "session_id": "string"}


@register(
    "contract_violations",
    oracle="""
SELECT 'event_id' AS column_name, 'bigint' AS expected_type, true AS present,
       count(*) FILTER (WHERE event_id IS NOT NULL AND TRY_CAST(event_id AS BIGINT) IS NULL) AS n_violations
FROM events
UNION ALL SELECT 'value', 'double', true,
       count(*) FILTER (WHERE value IS NOT NULL AND TRY_CAST(value AS DOUBLE) IS NULL) FROM events
UNION ALL SELECT 'event_type', 'int', true,
       count(*) FILTER (WHERE event_type IS NOT NULL AND TRY_CAST(event_type AS INTEGER) IS NULL) FROM events
UNION ALL SELECT 'props', 'int', true,
       count(*) FILTER (WHERE props IS NOT NULL AND TRY_CAST(props AS INTEGER) IS NULL) FROM events
UNION ALL SELECT 'session_id', 'string', false, CAST(NULL AS BIGINT)
""",
)
def q_contract_violations(spark, sf_dir):
    return features.contract_violations(load(spark, sf_dir, "events"), CONTRACT)


def _doc_table(spark, sf_dir):
    lab = load(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("y"))
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return lab.join(docs, "doc_id")


def _checked(scored):
    """What SQL can say about scores: one row a document, a probability, and the class it implies."""
    p = F.col("probability")
    return scored.withColumns({"in_range": (p >= 0) & (p <= 1), "class_fits": (p > 0.5).cast("int") == F.col("prediction")})


@register("gbt_train_score", oracle="SELECT doc_id, true AS in_range, true AS class_fits FROM documents")
def q_gbt_train_score(spark, sf_dir):
    """Train boosted trees on the hash-split train rows of the labelled documents
    (nominal codes for lang/source, n_chars numeric), score every document."""
    t = assign_split_hash(_doc_table(spark, sf_dir), ["doc_id"], 0.3, 11)
    params = model.BoostParams(learning_rate=0.1, n_estimators=10, max_depth=3)
    m = model.train(t.filter(F.col("split") == "train"), ["lang", "source"], ["n_chars"], "y", params)
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return _checked(model.score(docs, m, keep=["doc_id"])).select("doc_id", "in_range", "class_fits")


@register("boosted_train_score", oracle="SELECT doc_id, true AS in_range, true AS class_fits FROM documents")
def q_boosted_train_score(spark, sf_dir):
    """Boosted trees that take missing values: lengths and languages are missing for some of the
    labelled documents, and for some of those that are scored."""
    t = assign_split_hash(_doc_table(spark, sf_dir), ["doc_id"], 0.3, 11).filter(F.col("split") == "train")

    def some(df):
        return df.withColumns({"n_chars": F.when(F.col("doc_id") % 7 != 0, F.col("n_chars")), "lang": F.when(F.col("doc_id") % 5 != 0, F.col("lang"))})

    m = boosting.train_boosted(some(t), ["n_chars"], ["lang", "source"], "y", boosting.TreeParams(n_trees=8, max_depth=3))
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return _checked(boosting.score_boosted(some(docs), m, keep=["doc_id"])).select("doc_id", "in_range", "class_fits")


_SPLIT_ROWS = """
WITH r AS (SELECT CASE WHEN l_orderkey % 7 <> 0 THEN l_quantity END AS l_quantity, l_linenumber::DOUBLE AS l_linenumber, l_discount,
                  CASE WHEN l_partkey % 3 <> 0 THEN l_returnflag END AS l_returnflag, l_linestatus,
                  (l_extendedprice > 30000 OR l_returnflag = 'R')::INT::DOUBLE AS y FROM lineitem),
b AS (SELECT avg(y) AS p FROM r),
v AS ({values}),
s AS (SELECT feature, kind, x, t, count(*) AS n, sum(p - y) AS g, sum(p * (1 - p)) AS h FROM v, b GROUP BY ALL),
tot AS (SELECT feature, sum(n) AS tn, sum(g) AS tg, sum(h) AS th, coalesce(sum(n) FILTER (x IS NULL AND t IS NULL), 0) AS mn,
               coalesce(sum(g) FILTER (x IS NULL AND t IS NULL), 0) AS mg, coalesce(sum(h) FILTER (x IS NULL AND t IS NULL), 0) AS mh FROM s GROUP BY feature),
o AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY CASE WHEN kind = 'cat' THEN g / (h + 10) ELSE x END, t) AS place
      FROM s WHERE x IS NOT NULL OR t IS NOT NULL),
c AS (SELECT feature, kind, place, x, list(t) OVER w AS ts, sum(n) OVER w AS n, sum(g) OVER w AS g, sum(h) OVER w AS h FROM o
      WINDOW w AS (PARTITION BY feature ORDER BY place ROWS UNBOUNDED PRECEDING)),
k AS (SELECT feature, kind, place, x, ts, m AS missing_left, CASE WHEN m THEN n + mn ELSE n END AS ln, CASE WHEN m THEN g + mg ELSE g END AS lg,
             CASE WHEN m THEN h + mh ELSE h END AS lh, tn, tg, th
      FROM (SELECT * FROM c JOIN tot USING (feature)
            UNION ALL BY NAME
            SELECT feature, CASE WHEN starts_with(feature, 'l_return') OR starts_with(feature, 'l_lines') THEN 'cat' ELSE 'num' END AS kind, 0 AS place,
                   NULL AS x, [] AS ts, 0 AS n, 0 AS g, 0 AS h, tn, tg, th, mn, mg, mh FROM tot),
           (VALUES (false), (true)) f(m) WHERE NOT m OR mn > 0),
q AS (SELECT *, lg * lg / (lh + 1) + (tg - lg) * (tg - lg) / (th - lh + 1) - tg * tg / (th + 1) AS gain FROM k WHERE ln >= 20 AND tn - ln >= 20),
w AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY round(gain, 5) DESC, missing_left, place) AS best FROM q)
SELECT feature, round(gain, 4) AS gain, ln::BIGINT AS n_left, missing_left, CASE WHEN kind = 'num' THEN x END AS up_to,
       CASE WHEN kind = 'cat' THEN list_aggregate(list_sort(list_filter(ts, lambda z: z IS NOT NULL)), 'string_agg', ',') END AS left_values
FROM w WHERE best = 1
"""
_SPLIT_SQL = _SPLIT_ROWS.format(
    values=" UNION ALL ".join(
        [f"SELECT '{c}' AS feature, 'num' AS kind, {c} AS x, CAST(NULL AS VARCHAR) AS t, y FROM r" for c in ("l_quantity", "l_linenumber", "l_discount")]
        + [f"SELECT '{c}', 'cat', CAST(NULL AS DOUBLE), {c}, y FROM r" for c in ("l_returnflag", "l_linestatus")]
    )
)


@register("boosted_first_split", oracle=_SPLIT_SQL)
def q_boosted_first_split(spark, sf_dir):
    """The best first split of every feature, found from binned gradient sums: cut or set of
    categories, the side of missing values, gain.  SQL tries every split."""
    li = load(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_orderkey") % 7 != 0, F.col("l_quantity")).alias("l_quantity"),
        "l_linenumber",
        "l_discount",
        F.when(F.col("l_partkey") % 3 != 0, F.col("l_returnflag")).alias("l_returnflag"),
        "l_linestatus",
        ((F.col("l_extendedprice") > 30000) | (F.col("l_returnflag") == "R")).cast("int").alias("y"),
    )
    found = boosting.split_report(li, ["l_quantity", "l_linenumber", "l_discount"], ["l_returnflag", "l_linestatus"], "y")
    rows = [(r["feature"], r["gain"], r["n_left"], r["missing_left"], r["up_to"], ",".join(r["values"]) if r["values"] else None) for r in found]
    out = spark.createDataFrame(rows, "feature string, gain double, n_left long, missing_left boolean, up_to double, left_values string")
    return out.withColumn("gain", F.round("gain", 4))


@register(
    "ab_score",
    oracle=f"""
SELECT doc_id, {_ARM_SQL.format(c='doc_id')} AS arm, {_ARM_SQL.format(c='doc_id')} AS model,
       true AS in_range, true AS class_fits
FROM documents
""",
)
def q_ab_score(spark, sf_dir):
    """Route each document to arm A or B and score it with that arm's model (two
    boosted-tree models with different features), in one pass over all documents;
    the columns that served scoring only are dropped."""
    t = _doc_table(spark, sf_dir)
    m_a = model.train(t, ["lang"], ["n_chars"], "y", model.BoostParams(0.1, 5, 2))
    m_b = model.train(t, ["lang", "source"], ["n_chars"], "y", model.BoostParams(0.1, 5, 3))
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    routed = experiment.route(docs, "doc_id", ("A", "B"))
    scored = experiment.score_routed(routed, "arm", {"A": m_a, "B": m_b}, drop=["lang", "source", "n_chars"])
    return _checked(scored).select("doc_id", "arm", "model", "in_range", "class_fits")

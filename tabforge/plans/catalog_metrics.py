"""Catalog: aggregates and classification metrics.

Scored stand-in: ``labels ⋈ documents`` — label ``quality``, score
``least(n_chars, 4000) / 4000`` (exact IEEE division on both engines, with
many ties at 1.0 and between equal lengths).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.operators import metrics, profile
from tabforge.plans.registry import register
from tabforge.sources.tables import load

SCORED_SQL = """
WITH s AS (
  SELECT l.doc_id, d.lang, CAST(l.quality AS INTEGER) AS y,
         CAST(least(d.n_chars, 4000) AS DOUBLE) / 4000.0 AS p,
         CAST(least(d.n_chars, 3000) AS DOUBLE) / 3000.0 AS p_old
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)
"""


def scored(spark, sf_dir):
    lab = load(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("int").alias("y"))
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    j = lab.join(docs, "doc_id")
    return j.select(
        "doc_id",
        "lang",
        "y",
        (F.least(F.col("n_chars"), F.lit(4000)).cast("double") / F.lit(4000.0)).alias("p"),
        (F.least(F.col("n_chars"), F.lit(3000)).cast("double") / F.lit(3000.0)).alias("p_old"),
    )


@register(
    "row_counts",
    oracle="""
SELECT count(*) AS n_rows,
       count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned,
       count(*) FILTER (WHERE l_linestatus = 'O') AS n_open,
       count(*) FILTER (WHERE l_discount > 0.05) AS n_discounted,
       11 AS n_cols
FROM lineitem
""",
)
def q_row_counts(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    out = metrics.step_counts(
        li,
        {
            "n_returned": F.col("l_returnflag") == "R",
            "n_open": F.col("l_linestatus") == "O",
            "n_discounted": F.col("l_discount") > 0.05,
        },
    )
    return out.withColumn("n_cols", F.lit(len(li.columns)))


@register(
    "value_counts",
    oracle="""
SELECT o_orderpriority, count(*) AS count, round(count(*) / (SELECT count(*) FROM orders)::DOUBLE, 6) AS share
FROM orders GROUP BY o_orderpriority
""",
)
def q_value_counts(spark, sf_dir):
    return metrics.value_counts(load(spark, sf_dir, "orders"), "o_orderpriority")


@register(
    "value_counts_top",
    oracle=r"""
WITH w AS (SELECT unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS word FROM documents)
SELECT word, count(*) AS count, round(count(*) / (SELECT count(*) FROM w)::DOUBLE, 6) AS share
FROM w GROUP BY word ORDER BY count(*) DESC, word LIMIT 20
""",
)
def q_value_counts_top(spark, sf_dir):
    """The 20 most frequent words of all documents; of the other words none is shuffled."""
    words = F.explode(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("word")
    return metrics.value_counts_top(load(spark, sf_dir, "documents").select(words), "word", 20)


@register(
    "column_moments",
    oracle="""
SELECT round(avg(l_quantity), 6) AS l_quantity_mean, round(stddev_samp(l_quantity), 6) AS l_quantity_sd,
       round(avg(l_discount), 6) AS l_discount_mean, round(stddev_samp(l_discount), 6) AS l_discount_sd FROM lineitem
""",
)
def q_column_moments(spark, sf_dir):
    """Mean and sample deviation of two columns."""
    return metrics.moments(load(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount"])


@register("column_extent", oracle="SELECT min(o_totalprice) AS o_totalprice_min, max(o_totalprice) AS o_totalprice_max FROM orders")
def q_column_extent(spark, sf_dir):
    """Smallest and largest value of a column."""
    return metrics.extent(load(spark, sf_dir, "orders"), "o_totalprice")


@register(
    "column_profile",
    oracle="""
SELECT (SELECT count(*) FROM events) AS n_rows, * FROM (
  SELECT 'event_id' AS column_name, 'bigint' AS data_type, count(*) FILTER (WHERE event_id IS NULL) AS n_nulls,
         count(DISTINCT event_id) AS n_distinct, CAST(min(event_id) AS VARCHAR) AS min_value,
         CAST(max(event_id) AS VARCHAR) AS max_value, round(avg(event_id), 6) AS mean,
         round(stddev_samp(event_id), 6) AS sd FROM events
  UNION ALL
  SELECT 'user_id', 'bigint', count(*) FILTER (WHERE user_id IS NULL), count(DISTINCT user_id),
         CAST(min(user_id) AS VARCHAR), CAST(max(user_id) AS VARCHAR), round(avg(user_id), 6),
         round(stddev_samp(user_id), 6) FROM events
  UNION ALL
  SELECT 'event_type', 'string', count(*) FILTER (WHERE event_type IS NULL), count(DISTINCT event_type),
         min(event_type), max(event_type), NULL, NULL FROM events
  UNION ALL
  SELECT 'value', 'double', count(*) FILTER (WHERE value IS NULL), count(DISTINCT value),
         CAST(min(value) AS VARCHAR), CAST(max(value) AS VARCHAR), round(avg(value), 6),
         round(stddev_samp(value), 6) FROM events
  UNION ALL
  SELECT 'props', 'string', count(*) FILTER (WHERE props IS NULL), count(DISTINCT props),
         min(props), max(props), NULL, NULL FROM events)
""",
)
def q_column_profile(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    return profile.column_profile(ev, ["event_id", "user_id", "event_type", "value", "props"])


@register(
    "distinct_values",
    oracle="SELECT DISTINCT nullif(event_type, 'error') AS event_type FROM events",
)
def q_distinct_values(spark, sf_dir):
    ev = load(spark, sf_dir, "events").select(F.nullif("event_type", F.lit("error")).alias("event_type"))
    return metrics.distinct_values(ev, "event_type")


CONF_SQL = """
count(*) FILTER (WHERE y = 0 AND NOT p > 0.5) AS tn,
count(*) FILTER (WHERE y = 0 AND p > 0.5) AS fp,
count(*) FILTER (WHERE y = 1 AND NOT p > 0.5) AS fn,
count(*) FILTER (WHERE y = 1 AND p > 0.5) AS tp,
count(*) AS example_count"""

RATES_SQL = """
round(CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn), 6) AS accuracy,
round(CAST(tp AS DOUBLE) / (tp + fp), 6) AS precision,
round(CAST(tp AS DOUBLE) / (tp + fn), 6) AS recall,
round(CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn), 6) AS f1"""

LOGLOSS_SQL = """round(avg(-(y * ln(least(greatest(p, 1e-15), 1 - 1e-15))
             + (1 - y) * ln(1 - least(greatest(p, 1e-15), 1 - 1e-15)))), 6)"""


@register("confusion_matrix", oracle=SCORED_SQL + f"SELECT {CONF_SQL} FROM s")
def q_confusion(spark, sf_dir):
    return metrics.confusion(scored(spark, sf_dir), "y", "p")


@register(
    "class_metrics",
    oracle=SCORED_SQL + f", c AS (SELECT {CONF_SQL} FROM s) SELECT *, {RATES_SQL} FROM c",
)
def q_class_metrics(spark, sf_dir):
    return metrics.class_metrics(scored(spark, sf_dir), "y", "p")


@register("log_loss", oracle=SCORED_SQL + f"SELECT {LOGLOSS_SQL} AS log_loss FROM s")
def q_log_loss(spark, sf_dir):
    return metrics.log_loss(scored(spark, sf_dir), "y", "p")


@register(
    "roc_auc",
    oracle=SCORED_SQL
    + """, g AS (SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY p),
c AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS below FROM g)
SELECT round(sum(pos * (below + neg * 0.5)) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)), 6) AS roc_auc
FROM c""",
)
def q_roc_auc(spark, sf_dir):
    return metrics.roc_auc(scored(spark, sf_dir), "y", "p")


@register(
    "pr_auc",
    oracle=SCORED_SQL
    + """, g AS (SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY p),
c AS (SELECT pos, sum(pos) OVER (ORDER BY p DESC) AS tp, sum(neg) OVER (ORDER BY p DESC) AS fp FROM g)
SELECT round(sum(pos * (CAST(tp AS DOUBLE) / (tp + fp))) / CAST(sum(pos) AS DOUBLE), 6) AS pr_auc FROM c""",
)
def q_pr_auc(spark, sf_dir):
    return metrics.pr_auc(scored(spark, sf_dir), "y", "p")


@register(
    "pr_auc_trapezoid",
    oracle=SCORED_SQL
    + """, g AS (SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY p),
c AS (SELECT pos, neg, sum(pos) OVER (ORDER BY p DESC) AS tp, sum(neg) OVER (ORDER BY p DESC) AS fp FROM g),
t AS (SELECT pos, CAST(tp AS DOUBLE) / (tp + fp) AS prec,
             CASE WHEN tp - pos + fp - neg > 0 THEN CAST(tp - pos AS DOUBLE) / (tp - pos + fp - neg) ELSE 1.0 END
               AS prev
      FROM c)
SELECT round(sum(pos * (prec + prev) / 2) / CAST(sum(pos) AS DOUBLE), 6) AS pr_auc FROM t""",
)
def q_pr_auc_trapezoid(spark, sf_dir):
    """Trapezoidal area under the precision-recall curve."""
    return metrics.pr_auc(scored(spark, sf_dir), "y", "p", method="trapezoid")


@register(
    "roc_auc_by_group",
    oracle=SCORED_SQL
    + """, g AS (SELECT lang, p, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY lang, p),
c AS (SELECT lang, pos, neg, coalesce(sum(neg) OVER (PARTITION BY lang ORDER BY p
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
SELECT lang, round(sum(pos * (below + neg * 0.5)) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)), 6)
       AS roc_auc
FROM c GROUP BY lang""",
)
def q_roc_auc_by_group(spark, sf_dir):
    return metrics.roc_auc(scored(spark, sf_dir), "y", "p", keys=["lang"])


@register(
    "metrics_by_group",
    oracle=SCORED_SQL
    + f", c AS (SELECT lang, {CONF_SQL}, {LOGLOSS_SQL} AS log_loss FROM s GROUP BY lang) SELECT *, {RATES_SQL} FROM c",
)
def q_metrics_by_group(spark, sf_dir):
    return metrics.metrics_by(scored(spark, sf_dir), ["lang"], "y", "p")


@register(
    "champion_gate",
    oracle=SCORED_SQL
    + """, l AS (SELECT 'challenger' AS model, y, p FROM s UNION ALL SELECT 'champion', y, p_old FROM s),
f AS (SELECT model, CAST(2 * count(*) FILTER (WHERE y = 1 AND p > 0.5) AS DOUBLE)
        / (2 * count(*) FILTER (WHERE y = 1 AND p > 0.5) + count(*) FILTER (WHERE y = 0 AND p > 0.5)
           + count(*) FILTER (WHERE y = 1 AND NOT p > 0.5)) AS f1 FROM l GROUP BY model)
SELECT 'f1' AS metric,
       round(max(f1) FILTER (WHERE model = 'challenger'), 6) AS challenger_metric,
       round(max(f1) FILTER (WHERE model = 'champion'), 6) AS champion_metric,
       coalesce(max(f1) FILTER (WHERE model = 'champion') IS NULL
         OR max(f1) FILTER (WHERE model = 'challenger') >= max(f1) FILTER (WHERE model = 'champion'), false)
         AS improved
FROM f""",
)
def q_champion_gate(spark, sf_dir):
    """Both models scored on the same rows in one DataFrame: one scan of the
    scored table, exploded to (model, y, score)."""
    s = scored(spark, sf_dir)
    long = s.select(
        "y",
        F.explode(
            F.array(
                F.struct(F.lit("challenger").alias("model"), F.col("p").alias("score")),
                F.struct(F.lit("champion").alias("model"), F.col("p_old").alias("score")),
            )
        ).alias("m"),
    ).select("y", "m.model", "m.score")
    gate = metrics.champion_gate(long, "model", "challenger", "champion", "y", "score")
    return gate.withColumns({c: F.round(c, 6) for c in ("challenger_metric", "champion_metric")})


@register(
    "roc_auc_null_group",
    oracle=SCORED_SQL
    + """, g AS (SELECT CASE WHEN doc_id % 3 = 0 THEN NULL ELSE doc_id % 3 END AS grp, y, p FROM s),
c AS (SELECT grp, p, sum(y) AS pos, sum(1 - y) AS neg FROM g GROUP BY 1, 2),
r AS (SELECT *, sum(neg) OVER (PARTITION BY grp ORDER BY p) - neg AS below FROM c)
SELECT grp, round(sum(pos * (below + neg * 0.5)) / (sum(pos) * sum(neg)), 6) AS roc_auc FROM r GROUP BY grp
""",
)
def q_roc_auc_null_group(spark, sf_dir):
    """ROC AUC per group where a third of the rows has no group: NULL is one."""
    s = scored(spark, sf_dir)
    g = s.withColumn("grp", F.when(F.col("doc_id") % 3 != 0, F.col("doc_id") % 3))
    return metrics.roc_auc(g, "y", "p", ["grp"])


@register(
    "column_profile_documents",
    oracle="""
SELECT * FROM (
  SELECT count(*) AS n_rows, 'doc_id' AS column_name, 'bigint' AS data_type, count(*) FILTER (WHERE doc_id IS NULL) AS n_nulls,
         count(DISTINCT doc_id) AS n_distinct, CAST(min(doc_id) AS VARCHAR) AS min_value, CAST(max(doc_id) AS VARCHAR) AS max_value,
         round(avg(doc_id), 6) AS mean, round(stddev_samp(doc_id), 6) AS sd FROM documents
  UNION ALL SELECT count(*), 'text', 'string', count(*) FILTER (WHERE text IS NULL), count(DISTINCT text), min(text), max(text), NULL, NULL FROM documents
  UNION ALL SELECT count(*), 'lang', 'string', count(*) FILTER (WHERE lang IS NULL), count(DISTINCT lang), min(lang), max(lang), NULL, NULL FROM documents
  UNION ALL SELECT count(*), 'source', 'string', count(*) FILTER (WHERE source IS NULL), count(DISTINCT source), min(source), max(source), NULL, NULL FROM documents
  UNION ALL SELECT count(*), 'n_chars', 'bigint', count(*) FILTER (WHERE n_chars IS NULL), count(DISTINCT n_chars),
         CAST(min(n_chars) AS VARCHAR), CAST(max(n_chars) AS VARCHAR), round(avg(n_chars), 6), round(stddev_samp(n_chars), 6) FROM documents)
""",
)
def q_column_profile_documents(spark, sf_dir):
    """Every column of the documents, long texts included: values travel as hashes."""
    return profile.column_profile(load(spark, sf_dir, "documents"))

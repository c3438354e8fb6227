"""Classification metrics and table aggregates as Spark aggregations
(A1-A13).

Counting metrics (confusion, accuracy, precision, recall, F1, log loss) are
one partial/final hash aggregate, optionally keyed.  Rank metrics (ROC AUC,
average precision) first aggregate by distinct score — the data shrinks to
one row per score — then take exact running sums with the bucketed
prefix-sum pattern of :mod:`tabforge.plans.prefix` (no one-task window).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.plans.prefix import running_sums

EPS = 1e-15


def _r(c: Column, digits: int | None) -> Column:
    return F.round(c, digits) if digits is not None else c


# ------------------------------------------------------------------ A1-A6


def step_counts(df: DataFrame, conditions: dict[str, Column] | None = None) -> DataFrame:
    """Several row counts in ONE pass (A1): ``n_rows`` and ``count_if`` per
    named condition.  Replaces a count action per step."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for name, cond in (conditions or {}).items():
        aggs.append(F.count_if(cond).alias(name))
    return df.agg(*aggs)


def shape(df: DataFrame) -> DataFrame:
    """``(n_rows, n_cols)`` (A3); the column count is schema metadata."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def value_counts(df: DataFrame, col: str, digits: int | None = 6, n: int | None = None) -> DataFrame:
    """``(value, count, share)`` most frequent first (A2); with ``n`` only the first ``n``,
    which needs no global sort.

    The aggregated counts are checkpointed once and the total is a scalar
    subquery over that checkpoint — no second pass over the input (Spark does
    not reuse an exchange between a query and its subqueries), no cross join.
    """
    from tabforge.plans.joins import materialise

    counts = materialise(df.groupBy(col).agg(F.count(F.lit(1)).alias("count")))
    total = counts.agg(F.sum("count")).scalar()
    out = counts.withColumn("share", _r(F.col("count") / total, digits)).orderBy(
        F.desc("count"), F.asc_nulls_first(col)
    )
    return out if n is None else out.limit(n)


#: Values that the top-k sketch tracks at first and at most; beyond, all values are counted.
TRACK, MOST_TRACKED = 1 << 10, 1 << 16


def unseen_at_most(rows: int, track: int) -> int:
    """How often a value can occur that a frequent-items sketch of ``track`` values does not give.

    Its map has the next power of two of track / 0.75 places and is off by 3.5 / places of the
    rows at most, however it was merged; a value beyond twice that is given."""
    places = 2 ** math.ceil(math.log2(math.ceil(track / 0.75)))
    return math.floor(2 * 3.5 / places * rows)


def top_candidates(df: DataFrame, value: Column, track: int) -> tuple[int, list[int]]:
    """(rows, 64-bit hashes of the frequent values) from one aggregate of mergeable sketches:
    each task sends at most ``track`` hashes and counts, whatever the values are."""
    prints = df.select(F.xxhash64(value).alias("h"))
    row = prints.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(h, {track}, {track})").alias("top")).first()
    return row["n"], [r["item"] for r in row["top"] or []]


def value_counts_top(df: DataFrame, col: str, n: int, digits: int | None = 6, track: int = TRACK) -> DataFrame:
    """The ``n`` most frequent values (A2) as ``(value, count, share)``, exact, without counting
    or shuffling all distinct values.

    A sketch names candidates, a second pass counts just those, and the sketch's bound proves
    that no other value can be among the first ``n``.  Where it can't (values about equally
    frequent, ties with the bound), a larger sketch is tried up to MOST_TRACKED values, and then
    every value is counted (:func:`value_counts`).  NULL is a value like any other; ties go to
    the smaller value, NULL first."""
    from tabforge.plans.joins import materialise

    spark, value = df.sparkSession, F.col(f"`{col}`")
    while track <= MOST_TRACKED:
        rows, hashes = top_candidates(df, value, track)
        table = F.broadcast(spark.createDataFrame([(h,) for h in hashes], "_h long"))  # at most ``track`` numbers
        some = df.select(value.alias(col)).join(table, F.xxhash64(F.col(f"`{col}`")) == F.col("_h"), "left_semi")
        counts = materialise(some.groupBy(f"`{col}`").agg(F.count(F.lit(1)).alias("count")))
        top = counts.orderBy(F.desc("count"), F.asc_nulls_first(f"`{col}`")).limit(n)
        least, many = top.agg(F.min("count"), F.count(F.lit(1))).first()
        whole = (counts.agg(F.sum("count")).first()[0] or 0) == rows  # the candidates are all there is
        if whole or (many == n and least > unseen_at_most(rows, track)):
            return top.withColumn("share", _r(F.try_divide(F.col("count"), F.lit(rows)), digits))
        track *= 8
    return value_counts(df, col, digits, n)


def moments(df: DataFrame, cols: list[str], digits: int | None = 6) -> DataFrame:
    """Mean and sample standard deviation per column, one pass (A4)."""
    aggs = []
    for c in cols:
        aggs += [_r(F.avg(c), digits).alias(f"{c}_mean"), _r(F.stddev_samp(c), digits).alias(f"{c}_sd")]
    return df.agg(*aggs)


def extent(df: DataFrame, col: str) -> DataFrame:
    """Min and max of a column (A5)."""
    return df.agg(F.min(col).alias(f"{col}_min"), F.max(col).alias(f"{col}_max"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values including NULL (A6); partial dedup before the shuffle."""
    return df.select(col).distinct()


# ------------------------------------------------------------------ A7-A9


def predicted(score: Column, threshold: float = 0.5) -> Column:
    """Class from a probability: 1 when ``score > threshold`` (argmax rule)."""
    return (score > F.lit(threshold)).cast("int")


def confusion_aggs(label: Column, pred: Column) -> list[Column]:
    y, p = label.cast("int"), pred.cast("int")
    # rows without a label or prediction are in no count: the four add up to example_count
    return [
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if(y.isin(0, 1) & p.isin(0, 1)).alias("example_count"),
    ]


def log_loss_agg(label: Column, score: Column, eps: float = EPS) -> Column:
    p = F.least(F.greatest(score.cast("double"), F.lit(eps)), F.lit(1 - eps))
    y = label.cast("double")
    return F.avg(-(y * F.ln(p) + (F.lit(1.0) - y) * F.ln(F.lit(1.0) - p)))


def with_rates(counts: DataFrame, digits: int | None = 6) -> DataFrame:
    """Accuracy, precision, recall, F1 from the four counts (A8).  Empty
    denominators give NULL (``try_divide``)."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    precision = F.try_divide(tp, tp + fp)
    recall = F.try_divide(tp, tp + fn)
    f1 = F.try_divide(2 * tp, 2 * tp + fp + fn)
    acc = F.try_divide(tp + tn, tp + tn + fp + fn)
    return counts.withColumns(
        {
            "accuracy": _r(acc, digits),
            "precision": _r(precision, digits),
            "recall": _r(recall, digits),
            "f1": _r(f1, digits),
        }
    )


def confusion(df: DataFrame, label: str, score: str | None = None, pred: str | None = None,
              threshold: float = 0.5, keys: list[str] | None = None) -> DataFrame:
    """TN/FP/FN/TP and example count (A7), optionally per key."""
    p = F.col(pred) if pred else predicted(F.col(score), threshold)
    aggs = confusion_aggs(F.col(label), p)
    return df.groupBy(*(keys or [])).agg(*aggs)


def class_metrics(df: DataFrame, label: str, score: str | None = None, pred: str | None = None,
                  threshold: float = 0.5, keys: list[str] | None = None, digits: int | None = 6) -> DataFrame:
    """Counts plus accuracy (= score), precision, recall, F1."""
    return with_rates(confusion(df, label, score, pred, threshold, keys), digits)


def log_loss(df: DataFrame, label: str, score: str, keys: list[str] | None = None,
             digits: int | None = 6) -> DataFrame:
    """Mean binary cross-entropy with p clipped to [1e-15, 1-1e-15]."""
    return df.groupBy(*(keys or [])).agg(_r(log_loss_agg(F.col(label), F.col(score)), digits).alias("log_loss"))


def metrics_by(df: DataFrame, keys: list[str], label: str, score: str, threshold: float = 0.5,
               digits: int | None = 6) -> DataFrame:
    """A7-A9 per group in one aggregation."""
    aggs = confusion_aggs(F.col(label), predicted(F.col(score), threshold))
    aggs.append(_r(log_loss_agg(F.col(label), F.col(score)), digits).alias("log_loss"))
    return with_rates(df.groupBy(*keys).agg(*aggs), digits)


# ------------------------------------------------------------------ A10-A11


def score_counts(df: DataFrame, label: str, score: str, keys: list[str] | None = None) -> DataFrame:
    """One row per (key, distinct score): positives and negatives."""
    y = F.col(label).cast("long")
    return df.groupBy(*(keys or []), F.col(score).cast("double").alias("_s")).agg(
        F.sum(y).alias("_pos"), F.sum(F.lit(1) - y).alias("_neg")
    )


def roc_auc(df: DataFrame, label: str, score: str, keys: list[str] | None = None,
            digits: int | None = 6) -> DataFrame:
    """Exact ROC AUC, ties counted half (A10):
    ``Σ_s pos(s)·(neg(<s) + neg(s)/2) / (P·N)``."""
    keys = list(keys or [])
    sc = score_counts(df, label, score, keys)
    cum = running_sums(sc, "_s", ["_neg"], keys)  # cum_ _neg = negatives with score <= s
    below = F.col("cum__neg") - F.col("_neg")
    return cum.groupBy(*keys).agg(
        _r(
            F.try_divide(
                F.sum(F.col("_pos") * (below + F.col("_neg") * 0.5)),
                F.sum("_pos").cast("double") * F.sum("_neg").cast("double"),
            ),
            digits,
        ).alias("roc_auc")
    )


def pr_auc(df: DataFrame, label: str, score: str, keys: list[str] | None = None,
           digits: int | None = 6, method: str = "ap") -> DataFrame:
    """Area under the precision-recall curve (A11), thresholds at distinct
    scores (descending).

    ``method="ap"`` — average precision: ``Σ_s pos(s)/P · prec(s)``;
    ``method="trapezoid"`` — trapezoidal area of the curve through
    ``(recall 0, precision 1)`` and every threshold's ``(recall,
    precision)``: ``Σ_s pos(s)/P · (prec(s) + prec(prev))/2``.  The previous
    point comes from the running sums minus the row's own counts, so no
    extra window is needed.
    """
    keys = list(keys or [])
    sc = score_counts(df, label, score, keys)
    cum = running_sums(sc, "_s", ["_pos", "_neg"], keys, descending=True)
    tp, fp = F.col("cum__pos"), F.col("cum__neg")
    prec = tp / (tp + fp)
    if method == "ap":
        term = F.col("_pos") * prec
    elif method == "trapezoid":
        tp0, fp0 = tp - F.col("_pos"), fp - F.col("_neg")
        prev = F.when(tp0 + fp0 > 0, tp0 / (tp0 + fp0)).otherwise(F.lit(1.0))
        term = F.col("_pos") * (prec + prev) / 2
    else:
        raise ValueError(f"unknown method {method!r}")
    return cum.groupBy(*keys).agg(
        _r(F.try_divide(F.sum(term), F.sum("_pos").cast("double")), digits).alias("pr_auc")
    )


# ------------------------------------------------------------------ A13


def champion_gate(scores_long: DataFrame, model_col: str, challenger: str, champion: str, label: str,
                  score: str, metric: str = "f1", threshold: float = 0.5) -> DataFrame:
    """Champion/challenger gate (A13): both models scored on the same rows
    in ONE DataFrame ``(model, label, score)``; one keyed aggregation; the
    challenger passes when its metric is >= the champion's (ties pass) or
    when there is no champion; a challenger without a metric does not pass a
    champion that has one.  Metrics are compared and returned unrounded.
    Returns one row."""
    per_model = class_metrics(
        scores_long.filter(F.col(model_col).isin(challenger, champion)), label, score,
        threshold=threshold, keys=[model_col], digits=None,
    )
    pick = per_model.agg(
        F.max(F.when(F.col(model_col) == challenger, F.col(metric))).alias("challenger_metric"),
        F.max(F.when(F.col(model_col) == champion, F.col(metric))).alias("champion_metric"),
    )
    return pick.select(
        F.lit(metric).alias("metric"),
        "challenger_metric",
        "champion_metric",
        F.coalesce(
            F.col("champion_metric").isNull() | (F.col("challenger_metric") >= F.col("champion_metric")), F.lit(False)
        ).alias("improved"),
    )

"""Drift between a baseline and a current table, and window over window
(W3-W5).

Both inputs are stacked into one long table ``(column_name, value, is_base)``
with a single ``stack`` per input (no job per column), then aggregated per
(column, value) — the shuffle carries partial counts, so a hot value costs
one counter per task.  Totals per column are a tiny aggregate broadcast
back; the KS statistic needs ordered running counts and uses the bucketed
prefix sums of :mod:`tabforge.plans.prefix`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabforge.operators.features import quoted
from tabforge.plans.prefix import running_sums


def _stack(df: DataFrame, cols: list[str], is_base: int, as_type: str) -> DataFrame:
    pairs = [a for c in cols for a in (F.lit(c), F.col(quoted(c)).cast(as_type))]
    long = df.select(F.stack(F.lit(len(cols)), *pairs).alias("column_name", "value"))
    return long.withColumn("is_base", F.lit(is_base))


def _value_counts(base: DataFrame, cur: DataFrame, cols: list[str], as_type: str) -> DataFrame:
    long = _stack(base, cols, 1, as_type).unionByName(_stack(cur, cols, 0, as_type))
    return long.filter(F.col("value").isNotNull()).groupBy("column_name", "value").agg(
        F.sum("is_base").alias("nb"), F.sum(F.lit(1) - F.col("is_base")).alias("nc")
    )


def _with_totals(counts: DataFrame) -> DataFrame:
    totals = counts.groupBy("column_name").agg(F.sum("nb").alias("tb"), F.sum("nc").alias("tc"))
    return counts.join(F.broadcast(totals), "column_name")


def drift_numeric(base: DataFrame, cur: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov D and mean shift per numeric column.

    ``D = max_v |F_base(v) - F_cur(v)|`` over the distinct values of both
    samples; NULLs are ignored.  Output: ``column_name, ks_d, base_mean,
    cur_mean, mean_shift``.
    """
    counts = _value_counts(base, cur, cols, "DOUBLE")
    cum = running_sums(counts, "value", ["nb", "nc"], ["column_name"])
    cum = _with_totals(cum)
    ks = cum.groupBy("column_name").agg(
        F.round(
            F.max(F.abs(F.try_divide(F.col("cum_nb"), F.col("tb")) - F.try_divide(F.col("cum_nc"), F.col("tc")))),
            digits,
        ).alias("ks_d"),
        F.try_divide(F.sum(F.col("value") * F.col("nb")), F.sum("nb")).alias("base_mean"),
        F.try_divide(F.sum(F.col("value") * F.col("nc")), F.sum("nc")).alias("cur_mean"),
    )
    return ks.select(
        "column_name",
        "ks_d",
        F.round("base_mean", digits).alias("base_mean"),
        F.round("cur_mean", digits).alias("cur_mean"),
        F.round(F.col("cur_mean") - F.col("base_mean"), digits).alias("mean_shift"),
    )


def drift_categorical(
    base: DataFrame, cur: DataFrame, cols: list[str], eps: float = 1e-4, digits: int = 6
) -> DataFrame:
    """PSI, Jensen-Shannon divergence and chi-square per categorical column.

    Shares ``p`` (base) and ``q`` (current) per value; PSI uses shares
    floored at ``eps``: ``Σ (q-p)·ln(q/p)``; JS (natural log):
    ``½Σ p·ln(p/m) + ½Σ q·ln(q/m)``, ``m=(p+q)/2``, zero shares add 0;
    chi-square of homogeneity on the 2×k table: ``Σ (O-E)²/E``.
    NULL is a category of its own (text ``<null>``).
    """
    b = base.select(*[F.coalesce(F.col(c).cast("string"), F.lit("<null>")).alias(c) for c in cols])
    c_ = cur.select(*[F.coalesce(F.col(c).cast("string"), F.lit("<null>")).alias(c) for c in cols])
    counts = _with_totals(_value_counts(b, c_, cols, "STRING"))
    p = F.try_divide(F.col("nb"), F.col("tb"))
    q = F.try_divide(F.col("nc"), F.col("tc"))
    pe, qe = F.greatest(p, F.lit(eps)), F.greatest(q, F.lit(eps))
    m = (p + q) / 2
    js_term = F.when(p > 0, p * F.ln(p / m)).otherwise(0.0) + F.when(q > 0, q * F.ln(q / m)).otherwise(0.0)
    n = F.col("tb") + F.col("tc")
    tot = F.col("nb") + F.col("nc")
    eb, ec = tot * F.col("tb") / n, tot * F.col("tc") / n
    chi = F.try_divide((F.col("nb") - eb) ** 2, eb) + F.try_divide((F.col("nc") - ec) ** 2, ec)
    # A side with no values makes every measure undefined (NULL), not an error.
    both = (F.max("tb") > 0) & (F.max("tc") > 0)
    return counts.groupBy("column_name").agg(
        F.round(F.when(both, F.sum((qe - pe) * F.ln(qe / pe))), digits).alias("psi"),
        F.round(F.when(both, F.sum(js_term) / 2), digits).alias("js"),
        F.round(F.when(both, F.sum(chi)), digits).alias("chi2"),
        (F.count(F.lit(1)) - 1).alias("dof"),
    )


def drift_consecutive(
    profile: DataFrame, keys: list[str], order_col: str, metrics: list[str], digits: int = 6
) -> DataFrame:
    """Each window against the previous one of the same key.

    Adds ``prev_<m>`` and ``delta_<m>`` per metric.  The input is a profile
    (one row per window and key), so each window partition holds one key's
    windows — bounded by the number of windows, not by the raw rows.
    """
    w = Window.partitionBy(*keys).orderBy(order_col)
    out = profile
    for m in metrics:
        out = out.withColumn(f"prev_{m}", F.lag(m).over(w)).withColumn(
            f"delta_{m}", F.round(F.col(m) - F.col(f"prev_{m}"), digits)
        )
    return out

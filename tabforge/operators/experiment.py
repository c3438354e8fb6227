"""Experiment routing and read-outs (M6-M8).

Routing is a pure function of the id's md5, evaluated per row inside
codegen; no shuffle, no state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.functions.hashing import hash52, md5_parity


def route(df: DataFrame, id_col: str, arms=("A", "B"), into: str = "arm") -> DataFrame:
    """Deterministic A/B(/n) routing by md5 of the id text (M6).

    Two arms: the md5 read as one integer is odd → first arm, even →
    second (parity = parity of the last hex digit).  More arms: the md5's
    leading 52 bits modulo the number of arms.
    """
    arms = list(arms)
    text = F.col(id_col).cast("string")
    if len(arms) == 2:
        arm = F.when(md5_parity(text) == 1, F.lit(arms[0])).otherwise(F.lit(arms[1]))
    else:
        r = hash52(text) % len(arms)
        arm = F.element_at(F.array(*[F.lit(a) for a in arms]), (r + 1).cast("int"))
    return df.withColumn(into, arm)


def score_routed(df: DataFrame, arm_col: str, models: dict, drop: list[str] | None = None,
                 prediction: str = "prediction", probability: str = "probability") -> DataFrame:
    """Score each row with the model of its arm; output ``(…, prediction, model)`` (M7).

    ``models`` maps arm → a fitted Transformer that adds ``prediction`` (and
    possibly ``probability``) to its input's columns.  One pass: the input is read
    once, every model scores it in the same plan and each row takes its arm's
    result.  Rows of other arms get no prediction and no model.  ``drop`` columns
    are not in the output.
    """
    out, made = df, (prediction, probability)
    for i, model in enumerate(models.values()):
        scored = model.transform(out)
        new = [c for c in scored.columns if c in made]
        out = scored.select(*out.columns, *[F.col(c).alias(f"_{c}_{i}") for c in new])

    def of_arm(pick) -> Column:
        col = None
        for i, arm in enumerate(models):
            hit = F.col(arm_col) == F.lit(arm)
            col = F.when(hit, pick(i, arm)) if col is None else col.when(hit, pick(i, arm))
        return col

    found = [c for c in made if all(f"_{c}_{i}" in out.columns for i in range(len(models)))]
    cols = [c for c in df.columns if c not in (drop or []) and c not in found]
    return out.select(
        *cols,
        *[of_arm(lambda i, _, c=c: F.col(f"_{c}_{i}")).alias(c) for c in found],
        of_arm(lambda _, arm: F.lit(arm)).alias("model"),
    )


def ab_summary(df: DataFrame, arm_col: str, outcome: str, user_col: str | None = None,
               control: str | None = None, digits: int = 6) -> DataFrame:
    """Per-arm rows, users, mean and sd of the outcome, difference to the
    control arm and Welch z (M8).  One keyed aggregate; the control's
    statistics come from a window over that arms-sized result."""
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.avg(outcome).alias("_mean"),
        F.stddev_samp(outcome).alias("_sd"),
    ]
    if user_col:
        aggs.append(F.count_distinct(user_col).alias("users"))
    per_arm = df.groupBy(arm_col).agg(*aggs)
    # The control's statistics via a window over the arms-sized result (one
    # partition of a handful of rows) — no second aggregation of the input.
    everything = Window.partitionBy()
    ctl_name = F.lit(control) if control is not None else F.min(arm_col).over(everything)
    is_ctl = F.col(arm_col) == ctl_name
    per_arm = per_arm.withColumns(
        {
            "_c_mean": F.max(F.when(is_ctl, F.col("_mean"))).over(everything),
            "_c_sd": F.max(F.when(is_ctl, F.col("_sd"))).over(everything),
            "_c_n": F.max(F.when(is_ctl, F.col("n"))).over(everything),
        }
    )
    c_mean, c_sd, c_n = F.col("_c_mean"), F.col("_c_sd"), F.col("_c_n")
    diff = F.col("_mean") - c_mean
    se = F.sqrt(F.col("_sd") ** 2 / F.col("n") + c_sd**2 / c_n)
    return per_arm.select(
        arm_col,
        "n",
        *(["users"] if user_col else []),
        F.round("_mean", digits).alias("mean"),
        F.round("_sd", digits).alias("sd"),
        F.round(diff, digits).alias("diff"),
        F.round(F.try_divide(diff, se), digits).alias("z"),
    )

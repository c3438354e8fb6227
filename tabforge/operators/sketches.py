"""Window profiles that can be merged (W1 at several granularities).

A stored profile holds, for each window and key, what merges without the rows: counts,
extent, mean and squared deviations (Chan's formula), a KLL sketch of every numeric column
and an HLL sketch of every categorical one.  30 minutes roll up to an hour, a day or any
multiple, and keys to fewer keys, from the stored table alone: the log is read once.

Counts, extents and moments of a roll-up are exact.  A quantile is off by about
1.65 / KLL_K of the rank at most (99 % of the time), a distinct count by about
1.04 / sqrt(2 ** LG_K) as one standard deviation, however often states are merged.
Both sketches are buffers of bounded size per group and task, so a hot group costs no more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.operators.features import quoted
from tabforge.operators.profile import comparable, tumbling
from tabforge.sources.tables import overwrite_partitions

#: Size of the quantile sketch (rank error about 1.65 / k) and log2 of the distinct sketch's buckets.
KLL_K, LG_K = 200, 12


def _print(df: DataFrame, col: str) -> Column:
    """64-bit hash with the equality of the values, for the distinct sketch; NULL stays NULL."""
    kind = df.schema[col].dataType
    c = F.col(quoted(col))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        c = F.when(c == 0, F.lit(0).cast(kind)).otherwise(c)  # -0.0 == 0.0
    return F.when(c.isNotNull(), F.xxhash64(comparable(c, kind)))


def state_aggs(df: DataFrame, num_cols: list[str], cat_cols: list[str], k: int = KLL_K, lg_k: int = LG_K) -> list[Column]:
    """Aggregates that make a mergeable state of the columns of ``df``."""
    out = [F.count(F.lit(1)).alias("n_rows")]
    out += [F.count_if(F.col(quoted(c)).isNull()).alias(f"{c}_nulls") for c in dict.fromkeys([*num_cols, *cat_cols])]
    for c in num_cols:
        x = F.col(quoted(c)).cast("double")
        out += [
            F.count(x).alias(f"{c}_n"),
            F.min(x).alias(f"{c}_min"),
            F.max(x).alias(f"{c}_max"),
            F.avg(x).alias(f"{c}_mean"),
            (F.var_pop(x) * F.count(x)).alias(f"{c}_m2"),
            F.kll_sketch_agg_double(x, k).alias(f"{c}_kll"),
        ]
    out += [F.hll_sketch_agg(_print(df, c), lg_k).alias(f"{c}_hll") for c in cat_cols]
    return out


def profile_state(
    df: DataFrame,
    ts: str,
    duration: str = "30 minutes",
    keys: list[str] | None = None,
    num_cols: list[str] | None = None,
    cat_cols: list[str] | None = None,
) -> DataFrame:
    """One mergeable state per window and key, from one aggregate over one scan:
    ``window_start, window_end, *keys, n_rows`` and the columns of :func:`state_aggs`.

    NULL keys are a group; rows with a NULL time form a window whose bounds are NULL."""
    keys = list(keys or [])
    groups = df.withColumn("_w", tumbling(ts, duration)).groupBy("_w", *keys)
    out = groups.agg(*state_aggs(df, list(num_cols or []), list(cat_cols or [])))
    return out.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *out.columns[1:])


def _measured(state: DataFrame) -> tuple[list[str], list[str], list[str]]:
    """Numeric, categorical and counted columns of a state, told by their names."""
    names = state.columns
    return ([c[:-4] for c in names if c.endswith("_kll")], [c[:-4] for c in names if c.endswith("_hll")],
            [c for c in names if c.endswith("_nulls")])


def merge_states(state: DataFrame, duration: str, keys: list[str] | None = None) -> DataFrame:
    """States of wider windows (``duration`` is a multiple of the stored one) and of ``keys``,
    some of the stored ones: the same columns again, so a roll-up rolls up further.

    The common mean of a group comes from its states first (a window over the stored states of
    that group, no log rows), then the squared deviations from it add up without cancellation."""
    keys = list(keys or [])
    nums, cats, nulls = _measured(state)
    wide = state.withColumn("_w", tumbling("window_start", duration))
    within = Window.partitionBy("_w", *keys)
    for c in nums:
        n, mean = F.col(quoted(f"{c}_n")), F.col(quoted(f"{c}_mean"))
        wide = wide.withColumn(f"_mean_{c}", F.try_divide(F.sum(n * mean).over(within), F.sum(n).over(within)))
    aggs = [F.sum("n_rows").alias("n_rows"), *[F.sum(quoted(c)).alias(c) for c in nulls]]
    for c in nums:
        n, mean, m2, whole = (F.col(quoted(x)) for x in (f"{c}_n", f"{c}_mean", f"{c}_m2", f"_mean_{c}"))
        aggs += [
            F.sum(n).alias(f"{c}_n"),
            F.min(quoted(f"{c}_min")).alias(f"{c}_min"),
            F.max(quoted(f"{c}_max")).alias(f"{c}_max"),
            F.max(whole).alias(f"{c}_mean"),
            F.sum(m2 + n * (mean - whole) * (mean - whole)).alias(f"{c}_m2"),
            F.kll_merge_agg_double(quoted(f"{c}_kll")).alias(f"{c}_kll"),
        ]
    aggs += [F.hll_union_agg(quoted(f"{c}_hll")).alias(f"{c}_hll") for c in cats]
    out = wide.groupBy("_w", *keys).agg(*aggs)
    return out.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *out.columns[1:])


def finish(state: DataFrame, quantiles=(0.5,), digits: int | None = 6) -> DataFrame:
    """A readable profile of states: nulls, min, max, mean, sd (exact), ``_pNN_approx`` and ``_distinct_approx``."""
    nums, cats, nulls = _measured(state)
    rounded = lambda c: F.round(c, digits) if digits is not None else c
    own = {f"{c}_{s}" for c in nums for s in ("nulls", "n", "min", "max", "mean", "m2", "kll")}
    own |= {f"{c}_{s}" for c in cats for s in ("nulls", "hll")}
    out: list[Column] = [F.col(quoted(c)) for c in state.columns if c not in own]
    for c in nums:
        n, m2, kll = F.col(quoted(f"{c}_n")), F.col(quoted(f"{c}_m2")), F.col(quoted(f"{c}_kll"))
        out += [F.col(quoted(f"{c}_{s}")) for s in ("nulls", "min", "max")]
        out += [rounded(F.col(quoted(f"{c}_mean"))).alias(f"{c}_mean"), rounded(F.when(n > 1, F.sqrt(m2 / (n - 1)))).alias(f"{c}_sd")]
        for q in quantiles:
            value = F.when(F.kll_sketch_get_n_double(kll) > 0, F.kll_sketch_get_quantile_double(kll, F.lit(float(q))))
            out.append(value.alias(f"{c}_p{int(round(q * 100)):02d}_approx"))
    for c in cats:
        out += [F.col(quoted(f"{c}_nulls"))] if c not in nums else []
        out.append(F.hll_sketch_estimate(quoted(f"{c}_hll")).alias(f"{c}_distinct_approx"))
    return state.select(*out)


def store(state: DataFrame, path: str) -> None:
    """Keep states as a table by day of their window's start: the days that ``state`` has are
    replaced, all others stay, so a day is profiled anew without reading the others."""
    day = F.date_format("window_start", "yyyy-MM-dd")
    overwrite_partitions(state.withColumn("day", day), path, ["day"])


def stored(spark: SparkSession, path: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """Stored states, of the days in [since, until) if given (only those are listed and read)."""
    df = spark.read.parquet(path)
    day = F.col("day").cast("string")
    if since is not None:
        df = df.where(day >= since)
    if until is not None:
        df = df.where(day < until)
    return df.drop("day")

"""Profiling: tumbling-window profiles and whole-table column profiles
(W1, W2, W6; A1-A6 live in :mod:`tabforge.operators.metrics`).

Every profile is ONE aggregation: all statistics of all columns go into a
single ``agg`` so the input is scanned once and the shuffle carries only
partial aggregates (hash partial → final).  Window quantiles are exact, from
running sums of value counts that spread a group of any size over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.functions.timefn import as_timestamp
from tabforge.operators.features import quoted
from tabforge.plans.prefix import running_sums


def _round(c: Column, digits: int | None) -> Column:
    return F.round(c, digits) if digits is not None else c


def numeric_stats(
    col: str,
    quantiles=(),
    digits: int | None = 6,
    accuracy: int = 10000,
) -> list[Column]:
    """Aggregate expressions: nulls, min, max, mean, sample sd, and quantiles as
    bounded sketches (``_pNN_approx``; exact ones: :func:`window_profile`)."""
    p = col
    c = F.col(quoted(col)).cast("double")
    out = [
        F.count_if(c.isNull()).alias(f"{p}_nulls"),
        F.min(c).alias(f"{p}_min"),
        F.max(c).alias(f"{p}_max"),
        _round(F.avg(c), digits).alias(f"{p}_mean"),
        _round(F.stddev_samp(c), digits).alias(f"{p}_sd"),
    ]
    for q in quantiles:
        out.append(F.percentile_approx(c, float(q), accuracy).alias(f"{p}_p{int(round(q * 100)):02d}_approx"))
    return out


def tumbling(ts: str, duration: str) -> Column:
    """``struct<start, end>`` of the tumbling window of ``ts``; both NULL for a NULL
    time, which is a window of its own (``F.window`` would drop those rows)."""
    micros = F.unix_micros(as_timestamp(F.col(ts)))
    width = F.unix_micros(F.lit("1970-01-01 00:00:00+00:00").cast("timestamp") + F.expr(f"interval {duration}"))
    start = micros - F.pmod(micros, width)
    return F.struct(F.timestamp_micros(start).alias("start"), F.timestamp_micros(start + width).alias("end"))


def _from_counts(src: DataFrame, groups: list[str], num_cols: list[str], cat_cols: list[str], quantiles, digits: int | None) -> DataFrame:
    """The whole profile from one scan: rows counted by (group, column, value), so a hot value is
    one row; running sums of the counts by value (:mod:`tabforge.plans.prefix`, which spreads a
    group of any size over all tasks) give quantiles and totals; one aggregate does the rest.

    A quantile is the smallest value with at least ``q`` of the group's non-null values at or
    below it; deviations are from the mean that the totals give."""
    kinds = {f.name: f.dataType for f in src.schema.fields}
    none = F.lit(None).cast("long")
    entries = []
    for i, c in enumerate(num_cols):
        entries += [F.lit(i), F.col(quoted(c)).cast("double"), none, none]
    for i, c in enumerate(cat_cols, len(num_cols)):
        key = F.when(F.col(quoted(c)).isNotNull(), _distinct_key(F.col(quoted(c)), kinds[c]))
        entries += [F.lit(i), F.lit(None).cast("double"), key["a"], key["b"]]
    long = src.select(*groups, F.stack(F.lit(len(entries) // 4), *entries).alias("_column", "_value", "_a", "_b"))
    counts = long.groupBy(*groups, "_column", "_value", "_a", "_b").agg(F.count(F.lit(1)).alias("_n"))
    there = F.col("_value").isNotNull()
    counts = counts.withColumns({"_m": F.when(there, F.col("_n")).otherwise(0), "_s": F.when(there, F.col("_n") * F.col("_value")).otherwise(0.0)})
    ranks = running_sums(counts, "_value", ["_m", "_s"], [*groups, "_column"], tiebreak=["_a", "_b"], with_totals=True)
    v, mean = F.col("_value"), F.try_divide(F.col("total__s"), F.col("total__m"))
    aggs = [F.sum(F.when(F.col("_column") == 0, F.col("_n"))).alias("n_rows")]
    for i, c in enumerate(num_cols):
        here = F.col("_column") == i
        total = F.max(F.when(here, F.col("total__m")))
        off = F.sum(F.when(here, F.col("_m") * (v - mean) * (v - mean)))
        aggs += [
            F.coalesce(F.sum(F.when(here & ~there, F.col("_n"))), F.lit(0)).alias(f"{c}_nulls"),
            F.min(F.when(here, v)).alias(f"{c}_min"),
            F.max(F.when(here, v)).alias(f"{c}_max"),
            _round(F.max(F.when(here, mean)), digits).alias(f"{c}_mean"),
            _round(F.when(total > 1, F.sqrt(off / (total - 1))), digits).alias(f"{c}_sd"),
        ]
        for q in quantiles:
            upto = here & (F.col("cum__m") >= F.ceil(F.col("total__m") * F.lit(float(q))))
            aggs.append(F.min(F.when(upto, v)).alias(f"{c}_p{int(round(q * 100)):02d}"))
    for i, c in enumerate(cat_cols, len(num_cols)):
        here, known = F.col("_column") == i, F.col("_a").isNotNull()
        nulls = F.coalesce(F.sum(F.when(here & ~known, F.col("_n"))), F.lit(0))
        aggs += [F.count_if(here & known).alias(f"{c}_distinct")] + ([nulls.alias(f"{c}_nulls")] if c not in num_cols else [])
    return ranks.groupBy(*groups).agg(*aggs)


def window_profile(
    df: DataFrame,
    ts: str,
    duration: str = "30 minutes",
    keys: list[str] | None = None,
    num_cols: list[str] | None = None,
    cat_cols: list[str] | None = None,
    quantiles=(0.5,),
    exact_distinct: bool = True,
    salt: int = 0,
    digits: int | None = 6,
) -> DataFrame:
    """Tumbling-window profile per key.

    Output: ``window_start, window_end, *keys, n_rows`` then per numeric
    column ``_nulls _min _max _mean _sd _pNN`` and per categorical column
    ``_nulls _distinct``.  Quantiles and (unless ``exact_distinct`` is off)
    distinct counts are exact for groups of any size.  NULL keys are a group, and
    rows with a NULL time form a window whose start and end are NULL.

    The input is read once.  With quantiles all statistics come from counts by value
    (:func:`_from_counts`); without, from one aggregate, unless several exact distinct counts
    are asked for, which Spark would expand every row for.

    ``salt > 0`` aggregates counts and moments in two stages — per (window, key,
    input partition mod ``salt``), then merged (means and squared deviations by
    Chan's formula) — for hot groups with many partial buffers, in a scan of their own.
    ``digits`` rounds mean and sd; None leaves them as computed.
    """
    keys, num_cols, cat_cols = list(keys or []), list(num_cols or []), list(cat_cols or [])
    src = df.withColumn("_w", tumbling(ts, duration))
    groups = ["_w", *keys]
    wanted = ["n_rows"]
    for c in num_cols:
        wanted += [f"{c}_{s}" for s in ("nulls", "min", "max", "mean", "sd")]
        wanted += [f"{c}_p{int(round(q * 100)):02d}" for q in quantiles]
    for c in cat_cols:
        wanted += [f"{c}_nulls"] * (c not in num_cols) + [f"{c}_distinct"]
    by_value = bool(num_cols and quantiles) or (exact_distinct and len(cat_cols) > 1)
    stats = [a for c in num_cols for a in numeric_stats(c, (), digits)]
    nulls = [F.count_if(F.col(quoted(c)).isNull()).alias(f"{c}_nulls") for c in cat_cols if c not in num_cols]
    count = F.count_distinct if exact_distinct else F.approx_count_distinct
    distinct = [count(F.col(quoted(c))).alias(f"{c}_distinct") for c in cat_cols]
    parts = []
    if salt > 0:
        parts.append(_salted_stats(src, groups, num_cols, salt, digits))
    if by_value:
        parts.append(_from_counts(src, groups, num_cols, cat_cols if exact_distinct else [], quantiles, digits))
        parts += [src.groupBy(*groups).agg(*nulls, *distinct)] if cat_cols and not exact_distinct else []
    elif salt > 0:
        parts += [src.groupBy(*groups).agg(*nulls, *distinct)] if cat_cols else []
    else:
        parts.append(src.groupBy(*groups).agg(F.count(F.lit(1)).alias("n_rows"), *stats, *nulls, *distinct))
    out = parts[0]
    for later in parts[1:]:  # a later part gives what the earlier ones lack
        more = [c for c in later.columns if c not in out.columns or c in groups]
        out = out.unionByName(later.select(*[F.col(quoted(c)) for c in more]), allowMissingColumns=True)
    if len(parts) > 1:
        out = out.groupBy(*groups).agg(*[F.max(quoted(c)).alias(c) for c in wanted])
    return out.select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *keys, *[F.col(quoted(c)) for c in wanted]
    )


def _salted_stats(src: DataFrame, groups: list[str], num_cols: list[str], salt: int, digits: int | None) -> DataFrame:
    """Counts and moments in two stages: per (group, input partition mod ``salt``), then merged."""
    first = [F.count(F.lit(1)).alias("n_rows")]
    for c in num_cols:
        x = F.col(quoted(c)).cast("double")
        first += [
            F.count_if(x.isNull()).alias(f"{c}_nulls"),
            F.count(x).alias(f"_{c}_n"),
            F.min(x).alias(f"{c}_min"),
            F.max(x).alias(f"{c}_max"),
            F.avg(x).alias(f"_{c}_mean"),
            (F.var_pop(x) * F.count(x)).alias(f"_{c}_m2"),
        ]
    stage = src.withColumn("_salt", F.spark_partition_id() % salt).groupBy(*groups, "_salt").agg(*first)
    within = Window.partitionBy(*groups)  # at most ``salt`` rows
    for c in num_cols:
        n = F.col(f"_{c}_n")
        whole = F.try_divide(F.sum(F.col(f"_{c}_mean") * n).over(within), F.sum(n).over(within))
        stage = stage.withColumn(f"_{c}_gmean", whole)
    second = [F.sum("n_rows").alias("n_rows")]
    for c in num_cols:
        n, mean, whole = F.col(f"_{c}_n"), F.col(f"_{c}_mean"), F.col(f"_{c}_gmean")
        m2 = F.sum(F.coalesce(F.col(f"_{c}_m2") + n * (mean - whole) * (mean - whole), F.lit(0.0)))
        second += [
            F.sum(f"{c}_nulls").alias(f"{c}_nulls"),
            F.min(f"{c}_min").alias(f"{c}_min"),
            F.max(f"{c}_max").alias(f"{c}_max"),
            _round(F.first(whole, ignorenulls=True), digits).alias(f"{c}_mean"),
            _round(F.when(F.sum(n) > 1, F.sqrt(m2 / (F.sum(n) - 1))), digits).alias(f"{c}_sd"),
        ]
    return stage.groupBy(*groups).agg(*second)


def window_classes(
    df: DataFrame,
    ts: str,
    pred: str,
    duration: str = "30 minutes",
    keys: list[str] | None = None,
    digits: int = 6,
) -> DataFrame:
    """Prediction-class distribution per window and key.

    Count per (window, key, class), then the class share within its
    window via a window sum partitioned by (window, key) — the partitions
    of that window function are the already-aggregated classes, so no group
    is larger than the number of classes.
    """
    keys = list(keys or [])
    counts = df.groupBy(tumbling(ts, duration).alias("w"), *keys, F.col(pred).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )
    part = Window.partitionBy("w", *keys)
    return counts.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        *keys,
        "prediction",
        "n",
        F.round(F.col("n") / F.sum("n").over(part), digits).alias("share"),
    )


def _distinct_key(c: Column, dt) -> Column:
    """128-bit key with the same equality as ``count(DISTINCT c)``: two 64-bit hashes,
    so that long texts never travel (values that agree in both are taken as one)."""
    from pyspark.sql import types as T

    if isinstance(dt, (T.DoubleType, T.FloatType)):
        c = F.when(c == 0, F.lit(0).cast(dt)).otherwise(c)  # -0.0 == 0.0
    c = comparable(c, dt)
    return F.struct(F.xxhash64(c).alias("a"), F.xxhash64(F.lit(1), c).alias("b"))


def comparable(c: Column, dt) -> Column:
    """Maps have no order or hash: their sorted entries stand for them."""
    from pyspark.sql import types as T

    if isinstance(dt, T.MapType):
        return F.array_sort(F.map_entries(c))
    if "map<" in dt.simpleString() or "variant" in dt.simpleString():
        return F.to_json(F.struct(c))
    return c


def column_profile(
    df: DataFrame, cols: list[str] | None = None, digits: int | None = 6, exact_distinct: bool = True
) -> DataFrame:
    """Profile of any table, one row per column.

    Output ``(n_rows, column_name, data_type, n_nulls, n_distinct,
    min_value, max_value, mean, sd)``; numeric statistics are NULL for
    non-numeric columns, min/max are text so all columns share one type (maps
    compare by their sorted entries).  Any column name and any type may occur.

    Plan: ONE global aggregate for every non-distinct statistic of every
    column (unpivoted with ``stack``); exact distinct counts come from ONE
    stacked ``(column, hash of value)`` aggregation (map-side de-duplication,
    16 bytes a value, then a count per column) joined on the column name —
    instead of Spark's multi-distinct rewrite, which expands every row once per
    column and carries all aggregate buffers through it.
    ``exact_distinct=False`` uses HLL++ sketches in the single aggregate.
    """
    from pyspark.sql import types as T

    fields = [f for f in df.schema.fields if cols is None or f.name in cols]
    numeric = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
    aggs: list[Column] = [F.count(F.lit(1)).alias("__rows")]
    stacked: list[Column] = []
    for i, f in enumerate(fields):
        raw = F.col(quoted(f.name))
        c = comparable(raw, f.dataType)
        is_num = isinstance(f.dataType, numeric)
        approx = F.approx_count_distinct(c) if not exact_distinct else F.lit(None).cast("long")
        aggs += [
            F.count_if(raw.isNull()).alias(f"n{i}"),
            approx.alias(f"d{i}"),
            F.min(c).cast("string").alias(f"lo{i}"),
            F.max(c).cast("string").alias(f"hi{i}"),
            (_round(F.avg(c.cast("double")), digits) if is_num else F.lit(None).cast("double")).alias(f"m{i}"),
            (_round(F.stddev_samp(c.cast("double")), digits) if is_num else F.lit(None).cast("double")).alias(f"s{i}"),
        ]
        stacked += [F.lit(f.name), F.lit(f.dataType.simpleString()), *[F.col(f"{k}{i}") for k in ("n", "d", "lo", "hi", "m", "s")]]
    names = ["column_name", "data_type", "n_nulls", "n_distinct", "min_value", "max_value", "mean", "sd"]
    prof = df.agg(*aggs).select(F.col("__rows").alias("n_rows"), F.stack(F.lit(len(fields)), *stacked).alias(*names))
    if not exact_distinct:
        return prof
    keyed = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(f.name).alias("column_name"),
                        F.when(F.col(quoted(f.name)).isNotNull(), _distinct_key(F.col(quoted(f.name)), f.dataType)).alias("v"),
                    )
                    for f in fields
                ]
            )
        ).alias("_kv")
    ).select("_kv.*")
    distinct = (
        keyed.filter(F.col("v").isNotNull())
        .distinct()
        .groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("_nd"))
    )
    out = prof.join(F.broadcast(distinct), "column_name", "left")  # ≤ one row per column
    return out.select(
        "n_rows",
        "column_name",
        "data_type",
        "n_nulls",
        F.coalesce(F.col("_nd"), F.lit(0)).alias("n_distinct"),
        "min_value",
        "max_value",
        "mean",
        "sd",
    )

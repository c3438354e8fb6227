"""Distribution-matched synthetic tables.

Rows come from ``spark.range(n)`` (generated in parallel on the executors).
Every draw is a hash-derived uniform of ``(row id, column, draw, seed)``,
so the output does not depend on partitioning and has a SQL oracle.

* numeric: normal(mean, sd) by Box-Muller; moments are ONE aggregate of the
  source, read back as scalar subqueries;
* categorical: value shares (a dictionary-sized table) → cumulative
  intervals ``[lo, hi)``; a draw ``u`` is matched by an *equi*-join on a
  coarse bucket ``floor(u·M)`` (each interval is listed under every bucket
  it overlaps) plus the exact ``lo <= u < hi`` filter — no nested-loop
  range join;
* timestamp: uniform in ``[min, max)`` microseconds;
* anything else (arrays, maps, ...): bootstrap from the column — a uniform
  row draw, i.e. a frequency-weighted draw over distinct values, through
  the same interval join.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions.hashing import key_text, uniform, uniform_pair
from tabforge.operators.clean import floor_at, scale
from tabforge.plans.joins import materialise
from tabforge.plans.prefix import dense_index, running_sums

PI = math.pi
BUCKETS = 1024


def draw(id_col: Column, column: str, what: str, seed: int) -> Column:
    """Uniform [0,1) for (row, column, draw name, seed)."""
    return uniform(key_text(id_col, salt=f"{column}:{what}", seed=seed))


def normal(id_col: Column, column: str, mean: Column, sd: Column, seed: int) -> Column:
    """Box-Muller normal from two uniforms taken from ONE md5 of
    (row, column, seed) (``1-u`` keeps ``ln`` finite)."""
    u1, u2 = uniform_pair(key_text(id_col, salt=f"{column}:n", seed=seed))
    z = F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - u1)) * F.cos(F.lit(2.0 * PI) * u2)
    return mean + sd * z


def category_intervals(src: DataFrame, col: str) -> DataFrame:
    """``(value, lo, hi)``: cumulative shares in value order (NULL first).

    Value counts are dictionary-sized; the running sum uses the bucketed
    prefix pattern, so even a high-cardinality column is not one task.
    """
    counts = src.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    # Order by the value's text (any fixed order works; text suits every type).
    counts = materialise(counts.withColumn("_vs", F.col("value").cast("string")))
    cum = running_sums(counts, "_vs", ["n"])
    total = counts.agg(F.sum("n")).scalar()  # over the checkpoint: no second pass over the source
    return cum.select(
        "value",
        ((F.col("cum_n") - F.col("n")) / total).alias("lo"),
        (F.col("cum_n") / total).alias("hi"),
    )


def weights_intervals(spark, weights: list[tuple[object, float]], value_type: str = "string") -> DataFrame:
    """Given ``[(value, weight), ...]`` in order → ``(value, lo, hi)``."""
    tot = float(sum(w for _, w in weights))
    rows, cum = [], 0.0
    for v, w in weights:
        rows.append((v, cum / tot, (cum + w) / tot))
        cum += w
    schema = T.StructType(
        [
            T.StructField("value", T._parse_datatype_string(value_type)),
            T.StructField("lo", T.DoubleType()),
            T.StructField("hi", T.DoubleType()),
        ]
    )
    return spark.createDataFrame(rows, schema)


def pick_category(rows: DataFrame, u_col: str, intervals: DataFrame, into: str,
                  known_small: bool = False) -> DataFrame:
    """Attach the interval containing ``u`` (bucketed equi-join + exact filter).

    The bucket count grows with the number of intervals (at least four
    buckets per interval), so a draw meets about one candidate interval even
    for millions of distinct values; heavy values span many buckets.
    """
    if known_small:
        iv, k = intervals, None
    else:
        iv = materialise(intervals)
        k = iv.count()
    buckets = max(BUCKETS, 4 * (k or 0))
    exploded = iv.select(
        F.col("value").alias(into),
        F.col("lo").alias("_lo"),
        F.col("hi").alias("_hi"),
        F.explode(
            F.sequence(
                F.floor(F.col("lo") * buckets).cast("long"),
                F.least(F.floor(F.col("hi") * buckets).cast("long"), F.lit(buckets - 1)),
            )
        ).alias("_b"),
    ).filter(F.col("_hi") > F.col("_lo"))
    # values may be long texts or arrays: only a given list of weights is broadcast by
    # hint, any other side only if its bytes, measured at run time, allow it
    side = F.broadcast(exploded) if known_small else exploded
    keyed = rows.withColumn("_b", F.floor(F.col(u_col) * buckets).cast("long"))
    cond = [keyed["_b"] == side["_b"], F.col(u_col) >= F.col("_lo"), F.col(u_col) < F.col("_hi")]
    out = keyed.join(side, cond, "left")
    return out.drop("_b", "_lo", "_hi")


@dataclass
class SynthSpec:
    """What to generate.  Column kinds default from the source types."""

    n: int
    seed: int = 42
    id_col: str | None = "Id"
    id_base: int = 0
    floor_cols: dict[str, float] = field(default_factory=dict)  # e.g. physical measures at 0.1
    ints_as_normal: bool = True  # as the source's other numerics; False: drawn by frequency
    drift: bool = False
    drift_scale: dict[str, float] = field(default_factory=dict)
    drift_redraw: dict[str, list] = field(default_factory=dict)
    digits: int | None = None  # decimals of drawn numerics; None: as drawn
    bootstrap_order: str | None = None  # bootstrap: draw rows in this column's order
    row_id: str | None = "row_id"  # None: output only the source's columns


def _kind(dt: T.DataType, ints_as_normal: bool) -> str:
    if isinstance(dt, (T.DoubleType, T.FloatType, T.DecimalType)):
        return "normal"
    if isinstance(dt, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return "normal" if ints_as_normal else "category"
    if isinstance(dt, (T.StringType, T.BooleanType)):
        return "category"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "timestamp"
    return "bootstrap"


def synthesize(src: DataFrame, spec: SynthSpec) -> DataFrame:
    """Generate ``spec.n`` rows matching the distribution of ``src``.

    Numerics (G1, floored per ``floor_cols``), categories by frequency with
    weights aligned to their values and NULL as a category (G2), timestamps
    uniform in ``[min, max)`` (G3), other types bootstrapped (G4), new ids
    ``id_base + i`` as text (G5), optional drift (G6).
    """
    spark = src.sparkSession
    cols = [f for f in src.schema.fields if f.name not in (spec.id_col, spec.bootstrap_order)]
    kinds = {f.name: _kind(f.dataType, spec.ints_as_normal) for f in cols}
    # One aggregate for every moment / extent the generators need.
    aggs = []
    for f in cols:
        c = F.col(f"`{f.name}`")
        if kinds[f.name] == "normal":
            aggs += [F.avg(c.cast("double")).alias(f"m_{f.name}"), F.stddev_samp(c.cast("double")).alias(f"s_{f.name}")]
        elif kinds[f.name] == "timestamp":
            micros = F.unix_micros(c.cast("timestamp"))
            aggs += [F.min(micros).alias(f"lo_{f.name}"), F.max(micros).alias(f"hi_{f.name}")]
    # ONE aggregate (one pass over the source) for every statistic; its single
    # row comes back as literals (Spark re-runs a subquery per reference).
    stats = src.agg(*aggs).first().asDict() if aggs else {}

    def stat(name: str) -> Column:
        if name.startswith(("lo_", "hi_")):
            return F.lit(stats[name]).cast("long")
        # 13 significant digits: the sums' last bits depend on the partitioning
        return F.lit(None if stats[name] is None else float(f"{stats[name]:.13g}")).cast("double")

    rows = spark.range(spec.n).withColumnRenamed("id", "_i")
    rid = F.col("_i")
    out_cols: list[Column | str] = []
    for f in cols:
        name = f.name
        kind = kinds[name]
        if kind == "normal":
            x = normal(rid, name, stat(f"m_{name}"), stat(f"s_{name}"), spec.seed)
            if name in spec.floor_cols:
                x = floor_at(x, spec.floor_cols[name])
            if spec.drift and name in spec.drift_scale:
                x = scale(x, spec.drift_scale[name])
            if spec.digits is not None:
                x = F.round(x, spec.digits)
            if isinstance(f.dataType, T.IntegralType):
                x = F.round(x)
            # a draw beyond the type's range is NULL, not an error
            rows = rows.withColumn(name, x.try_cast(f.dataType))
        elif kind == "timestamp":
            lo, hi = stat(f"lo_{name}"), stat(f"hi_{name}")
            u = draw(rid, name, "u", spec.seed)
            us = lo + F.floor(u * (hi - lo)).cast("long")
            rows = rows.withColumn(name, F.timestamp_micros(us).cast(f.dataType))
        elif kind == "bootstrap" and spec.bootstrap_order:
            if "_rows" not in stats:
                stats["_rows"] = src.count()
            pool = dense_index(src.select(F.col(spec.bootstrap_order).alias("_o"), F.col(name)), "_o", into="_n").drop("_o")
            rows = rows.withColumn("_n", F.floor(draw(rid, name, "u", spec.seed) * stats["_rows"]).cast("long"))
            rows = rows.join(pool, "_n", "left").drop("_n")
        else:
            u_name = f"_u_{name}"
            rows = rows.withColumn(u_name, draw(rid, name, "u", spec.seed))
            if spec.drift and name in spec.drift_redraw:
                iv = weights_intervals(spark, spec.drift_redraw[name], f.dataType.simpleString())
                rows = pick_category(rows, u_name, iv, name, known_small=True)
            else:
                # Categories and bootstrap (G4) alike: drawing a row uniformly
                # is drawing a distinct value with frequency weights.
                rows = pick_category(rows, u_name, category_intervals(src, name), name)
            rows = rows.drop(u_name)
        out_cols.append(name)
    if spec.id_col:
        rows = rows.withColumn(spec.id_col, (F.lit(spec.id_base) + rid).cast("string"))
        out_cols.append(spec.id_col)
    if spec.row_id is None:
        return rows.select(*out_cols)
    return rows.select("_i", *out_cols).withColumnRenamed("_i", spec.row_id)

"""Exact running sums and dense row numbers without a one-task window.

``Window.orderBy(x)`` with no partition moves every row to a single task, and a
window per group piles a hot group up in one.  Here, at every input size:

1. ``repartitionByRange`` on the group and order columns (bounds from Spark's own
   sample, any orderable type, NULL and NaN placed as Spark sorts them) makes
   partitions of about equal size in order; a checkpoint fixes them;
2. the totals per (group, partition) are a partial aggregate, and their exclusive
   running sums a window over that small table (at most one row a partition and
   group border);
3. each total joins its (group, partition) as one more row that sorts first, so
   one window partitioned by (group, partition) gives the running sums.  Window
   keys compare NULL-safely, so NULL groups need no special case.

Rows that are equal in all order columns share a partition: callers aggregate by
the order value first, or give a tiebreak.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.plans.joins import materialise

MAX_RANGES = 65_536


def default_ranges(df: DataFrame) -> int:
    """One range per shuffle partition, at most 65,536."""
    try:
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    except ValueError:
        n = 200
    return min(max(1, n), MAX_RANGES)


def row_print(df: DataFrame) -> Column:
    """Hash of a whole row, to put rows with equal keys in a fixed order."""
    return F.xxhash64(*[_hashable(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields])


def _hashable(c: Column, dt: T.DataType) -> Column:
    return F.to_json(F.struct(c)) if "map<" in dt.simpleString() or "variant" in dt.simpleString() else c


def ranged(df: DataFrame, order: list[Column], ranges: int | None = None) -> DataFrame:
    """``df`` cut into ordered ranges: adds ``_range``, fixed by a checkpoint."""
    parts = df.repartitionByRange(ranges or default_ranges(df), *order)
    return materialise(parts.withColumn("_range", F.spark_partition_id()))


def running_sums(
    df: DataFrame,
    order_col: str,
    sum_cols: list[str],
    groups: list[str] | None = None,
    descending: bool = False,
    buckets: int | None = None,
    prefix: str = "cum_",
    tiebreak: list[str] | None = None,
    by_row: bool = False,
    with_totals: bool = False,
) -> DataFrame:
    """Add inclusive running sums ``cum_<c>`` of ``sum_cols`` in the order of
    ``order_col`` and ``tiebreak``, restarting per ``groups`` (NULL is a group).

    Rows equal in all order columns are summed together (a RANGE frame); with
    ``by_row`` each row counts by itself (a ROWS frame).  ``with_totals`` adds each
    group's whole sum as ``total_<c>``.  ``buckets`` is the number of ranges
    (default: the session's shuffle partitions)."""
    groups = list(groups or [])
    keys = [order_col, *(tiebreak or [])]
    order = [F.col(c).desc() if descending else F.col(c).asc() for c in keys]
    rows = ranged(df, [*[F.col(g) for g in groups], *order], buckets)
    totals = rows.groupBy(*groups, "_range").agg(*[F.sum(c).alias(c) for c in sum_cols])
    before = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *groups,
        "_range",
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in sum_cols],
        *[F.sum(c).over(Window.partitionBy(*groups)).alias(f"total_{c}") for c in sum_cols if with_totals],
    )
    led = rows.withColumn("_row", F.lit(1)).unionByName(offsets.withColumn("_row", F.lit(0)), allowMissingColumns=True)
    along = Window.partitionBy(*groups, "_range").orderBy("_row", *order)
    along = (along.rowsBetween if by_row else along.rangeBetween)(Window.unboundedPreceding, Window.currentRow)
    out = led.withColumns({f"{prefix}{c}": F.sum(c).over(along) for c in sum_cols})
    if with_totals:  # held by the one row of each (group, range) that its total is
        within = Window.partitionBy(*groups, "_range")
        out = out.withColumns({f"total_{c}": F.max(f"total_{c}").over(within) for c in sum_cols})
    return out.where(F.col("_row") == 1).drop("_range", "_row")


def dense_index(
    df: DataFrame,
    order_col: str,
    groups: list[str] | None = None,
    buckets: int | None = None,
    into: str = "row_index",
    tiebreak: list[str] | None = None,
    total: str | None = None,
) -> DataFrame:
    """0-based row number per group in ``(order_col, *tiebreak)`` order; ``total`` names
    a further column with the group's number of rows.

    Every row gets its own number: rows that tie in all of these are put in the
    order of a hash of the whole row (rows equal in every column are
    interchangeable).  Copies are spread over the ranges by their place in their input
    partition: sorted there first, so that a task that is run again deals the same
    number of copies to each range."""
    keys = [*(groups or []), order_col, *(tiebreak or []), "_print"]
    src = df.withColumns({"_one": F.lit(1).cast("long"), "_print": row_print(df)})
    src = src.sortWithinPartitions(*keys).withColumn("_place", F.monotonically_increasing_id())
    out = running_sums(
        src,
        order_col,
        ["_one"],
        groups,
        buckets=buckets,
        prefix="_cum",
        tiebreak=[*(tiebreak or []), "_print", "_place"],
        by_row=True,
        with_totals=total is not None,
    )
    out = out.withColumn(into, F.col("_cum_one") - 1)
    if total is not None:
        out = out.withColumn(total, F.col("total__one"))
    return out.drop("_one", "_cum_one", "_print", "_place", "total__one")

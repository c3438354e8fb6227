"""Splitting and sampling.

Randomness is hash-derived (:mod:`tabforge.functions.hashing`), so every
result is independent of partitioning, retries and executor loss.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.functions.hashing import hash52, key_text
from tabforge.plans.joins import materialise
from tabforge.plans.prefix import dense_index

# The sort key is the first 13 hex digits (52 bits) of md5(key‖seed), kept
# as TEXT: fixed-width lowercase hex sorts exactly like the integer it
# spells, and skipping the hex→integer parse halves the per-row cost.
# Histogram levels refine 16 bits (4 hex digits) at a time: (start, length).
_LEVELS = [(1, 4), (5, 4), (9, 4), (13, 1)]
RESOLVE_MAX = 50_000


def _sort_key(df: DataFrame, keys: list[str], seed) -> DataFrame:
    h = F.substring(F.md5(key_text(*keys, seed=seed)), 1, 13)
    return df.withColumns({"_h": h, "_kt": key_text(*keys)})


def _histogram(df: DataFrame, prefix_filter, start: int, length: int) -> list[tuple[str, int]]:
    b = F.substring(F.col("_h"), start, length)
    return sorted(tuple(r) for r in df.filter(prefix_filter).groupBy(b.alias("b")).count().collect())


def _boundary(df: DataFrame, k: int, first_hist: list[tuple[int, int]]):
    """Find the k-th smallest ``(_h, _kt)`` (1-based) exactly.

    Histograms over successive 4-hex-digit slices of ``_h`` (each ≤ 65,536
    rows to the driver) narrow the search to one bucket; when that bucket is at
    most ``RESOLVE_MAX`` rows, its distinct ``(_h, _kt)`` with counts are
    fetched and ranked locally.  Returns ``(h, kt, take, group_count)``:
    everything strictly below ``(h, kt)`` is in, plus ``take`` of the
    ``group_count`` rows equal to it.
    """
    rest = k
    prefix_filter = F.lit(True)
    for level, (start, length) in enumerate(_LEVELS):
        hist = first_hist if level == 0 else _histogram(df, prefix_filter, start, length)
        cum, count = 0, 0
        for bucket, c in hist:
            if cum + c >= rest:
                rest -= cum
                count = c
                b = F.substring(F.col("_h"), start, length)
                prefix_filter = prefix_filter & (b == F.lit(bucket))
                break
            cum += c
        if count <= RESOLVE_MAX:
            break
    groups = sorted(
        tuple(r) for r in df.filter(prefix_filter).groupBy("_h", "_kt").count().collect()
    )
    cum = 0
    for h, kt, c in groups:
        if cum + c >= rest:
            return h, kt, rest - cum, c
        cum += c
    raise ValueError("boundary not found")  # pragma: no cover


def assign_split_exact(
    df: DataFrame, keys: list[str], test_size: float = 0.2, seed: int = 42, into: str = "split"
) -> DataFrame:
    """Label rows ``test`` / ``train`` with exactly ``ceil(test_size·n)``
    test rows: the rows with the smallest ``(md5(key‖seed), key)`` (D1).

    Equal to a global sort but without one: a few bounded histogram
    collects find the cut, then the split is a plain filter expression.
    When rows with an identical key straddle the cut, the required number
    of those copies is taken from a materialised copy of that group.
    """
    keyed = _sort_key(df, keys, seed)
    cols = df.columns
    # The level-1 histogram doubles as the row count (no separate count scan).
    first_hist = _histogram(keyed, F.lit(True), *_LEVELS[0])
    n = sum(c for _, c in first_hist)
    k = math.ceil(test_size * n) if isinstance(test_size, float) else int(test_size)
    if k <= 0:
        return keyed.select(*cols, F.lit("train").alias(into))
    if k >= n:
        return keyed.select(*cols, F.lit("test").alias(into))
    h, kt, take, group_count = _boundary(keyed, k, first_hist)
    below = (F.col("_h") < h) | ((F.col("_h") == h) & (F.col("_kt") < kt))
    at = (F.col("_h") == h) & (F.col("_kt") == kt)
    if take == group_count:
        lab = F.when(below | at, "test").otherwise("train")
        return keyed.select(*cols, lab.alias(into))
    # Identical keys straddle the cut: copies are interchangeable, so take
    # `take` of them by per-partition quotas on a materialised copy.
    # Partition id and row id are recorded as data when the tie group is
    # materialised, so they are stable for every later read (and unaffected
    # by the union below).  Row position in its partition = id - (pid << 33).
    tie = materialise(
        keyed.filter(at).select(
            *cols, F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid")
        )
    )
    per_part = sorted(tuple(r) for r in tie.groupBy("_pid").count().collect())  # ≤ #partitions rows
    quota, left = [], take
    for p, c in per_part:
        q = min(c, left)
        quota.append((int(p), int(q)))
        left -= q
    quotas = df.sparkSession.createDataFrame(quota, "_pid int, _quota long")
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    # pid → quota is one row per partition: a broadcast hash lookup, not a
    # per-row scan of a literal map.
    tie_labelled = tie.join(F.broadcast(quotas), "_pid").select(
        *cols, F.when(pos < F.col("_quota"), "test").otherwise("train").alias(into)
    )
    rest = keyed.filter(~at).select(*cols, F.when(below, "test").otherwise("train").alias(into))
    return rest.unionByName(tie_labelled)


def split_exact(df: DataFrame, keys: list[str], test_size: float = 0.2, seed: int = 42):
    """``(train, test)`` DataFrames of :func:`assign_split_exact`."""
    lab = materialise(assign_split_exact(df, keys, test_size, seed))
    return lab.filter(F.col("split") == "train").drop("split"), lab.filter(F.col("split") == "test").drop("split")


def assign_split_hash(
    df: DataFrame, keys: list[str], test_fraction: float = 0.2, seed: int = 42, into: str = "split"
) -> DataFrame:
    """Stable hash split (D2): ``hash52(key‖seed) % 10000 < fraction·10000``.
    Membership of a key never changes as rows arrive; no shuffle, no count."""
    bp = int(round(test_fraction * 10000))
    h = hash52(key_text(*keys, seed=seed))
    return df.withColumn(into, F.when(h % 10000 < bp, "test").otherwise("train"))


def resample(
    df: DataFrame,
    order_col: str,
    n: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """Exactly ``n`` rows drawn with replacement (default n = table size) (D3).

    Draw ``i`` picks row ``hash52(i‖'draw'‖seed) % N`` of the table in
    ``order_col`` order (any orderable type; ties in the order of a hash of the
    whole row).  Rows get a dense index without a one-task window
    (:func:`tabforge.plans.prefix.dense_index`); the draws are generated by
    ``spark.range`` and joined on the index, whose values are uniform.
    """
    spark = df.sparkSession
    total = df.count()
    n = total if n is None else n
    if total == 0 or n == 0:
        return df.limit(0).withColumn("draw_id", F.lit(0).cast("long"))
    indexed = dense_index(df, order_col, into="_rn")
    draws = spark.range(n).select(
        F.col("id").alias("draw_id"), (hash52(key_text(F.col("id"), seed=seed, salt="draw")) % total).alias("_rn")
    )
    return draws.join(indexed, "_rn").drop("_rn")


def top_n(df: DataFrame, n: int, order: list) -> DataFrame:
    """First ``n`` rows in a fixed order (D4) — TakeOrderedAndProject: each
    task keeps its own top n, the driver merges n per task."""
    return df.orderBy(*order).limit(n)

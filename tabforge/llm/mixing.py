"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

Targets: the words of all sources are shared out by weight; a source stops at
``max_repeat`` times its own words and the excess goes to the others by weight
until none is above (water filling).

Copies: a source whose target is r times its words takes every document
floor(r) times for certain.  The rest is a sample of unequal probabilities: a document's
weight is that of its length's class (LENGTH_WEIGHTS: below half of the source's mean
length, about it, above twice of it), inclusion probabilities are in proportion to the weights and add up
to the rest in words, and a class that would exceed one is taken for certain.  Pareto order
sampling ranks documents by the random odds u / (1 - u) divided by their inclusion odds
p / (1 - p), smallest first, and takes ranks until the rest is filled: a sample of fixed size
in words.  u is a hash of the id and the text, so reruns, retries and any partitioning agree.

The rank cut needs no sort of a source: sizes are summed over equal ranges of the
ranking variable, then over finer ranges of the one where the target is met, and only
the documents of the finer one are ordered.  Documents are then compared with their
source's cut, so a source with a third of all rows is never in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.functions.hashing import key_text, uniform
from tabforge.llm.common import WORD_PATTERN, free_name, settle

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: Times its words that a source or document may be taken, at most.
MAX_REPEAT = 3
#: Weights of short, middling and long documents within their source, ascending.
LENGTH_WEIGHTS = (1.0, 1.5, 2.0)
SEED = 29
#: Ranges of the ranking variable whose sizes are summed, in two steps of its square root.
RANGES = 1 << 16
#: Bytes of the table of sources up to which it is broadcast.
BROADCAST_BYTES = 32 << 20


def words_in(text: Column) -> Column:
    """Number of words; null text: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def _with_weights(sources: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """Weights by the rank of the source's name (code points, null last).  Ranks are
    counted within 4096 ranges of a name's first two bytes' order and added up, so
    even very many sources are never ordered in one task unless they share it."""
    lead = F.coalesce(F.conv(F.substring(F.hex(F.encode("source", "UTF-8")), 1, 4), 16, 10).cast("int"), F.lit(0))
    lead = F.when(F.col("source").isNull(), 1 << 20).otherwise(
        F.when(F.length(F.hex(F.encode("source", "UTF-8"))) == 2, lead * 256).otherwise(lead)
    )
    placed = sources.withColumn("_lead", lead)
    sums = placed.groupBy("_lead").agg(F.count(F.lit(1)).alias("_n"))
    before = sums.withColumn(
        "_before",
        F.coalesce(F.sum("_n").over(Window.orderBy("_lead").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    ).select("_lead", "_before")  # at most 65,537 rows, whatever the input
    inner = Window.partitionBy("_lead").orderBy(F.encode("source", "UTF-8"))
    ranked = placed.withColumn("_k", F.row_number().over(inner) - 1).join(before, "_lead")
    given = F.array(*[F.lit(float(w)) for w in weights])
    rank = (F.col("_k") + F.col("_before")) % len(weights)
    return ranked.select("source", "source_size", F.element_at(given, (rank + 1).cast("int")).alias("weight"))


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """(source, source_size, target) by water filling: the level that shares the
    words is the fixed point of "sources above their limit stay at it, the others
    share the rest by weight"; each round is one aggregate over the sources."""
    weighted = settle(_with_weights(sources, weights))
    limit = F.col("source_size") * F.lit(float(max_repeat))
    total, weight = weighted.agg(F.sum("source_size"), F.sum("weight")).first()
    level = (total or 0) / weight if weight else 0.0
    while True:
        full = limit <= F.col("weight") * F.lit(level)
        stuck, free = weighted.agg(F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("weight")))).first()
        if not free:
            break
        higher = (total - (stuck or 0.0)) / free
        if higher <= level:
            break
        level = higher
    share = F.col("weight") * F.lit(float(level))
    return weighted.select("source", "source_size", F.least(limit, share).alias("target"))


def _probabilities(words: DataFrame) -> DataFrame:
    """The plan of each source from its words by class: certain copies, inclusion probabilities
    _mix_p0 to _mix_p2 of the classes, and the words left to the sample.

    Probabilities are a common factor times the weights.  Long documents reach one first; they are
    then certain, and the factor of the others is found anew, and once more for middling ones."""
    g0, g1, g2 = (F.lit(float(g)) for g in LENGTH_WEIGHTS)
    z0, z1, z2, rest = (F.col(f"_mix_{c}") for c in ("z0", "z1", "z2", "all"))
    some = lambda c: F.when(c.isNull() | (c < 0), 0.0).otherwise(F.least(c, F.lit(1.0)))
    sure = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    out = words.withColumn("_mix_sure", sure)
    out = out.withColumn("_mix_all", F.greatest(F.col("target") - F.col("_mix_sure") * F.col("source_size"), F.lit(0.0)))
    every = F.try_divide(rest, z0 * g0 + z1 * g1 + z2 * g2)
    lower = F.when(every * g2 < 1, every).otherwise(F.try_divide(rest - z2, z0 * g0 + z1 * g1))
    least = F.when(lower * g1 < 1, lower).otherwise(F.try_divide(rest - z2 - z1, z0 * g0))
    out = out.withColumns({"_mix_p2": some(every * g2), "_mix_p1": some(lower * g1), "_mix_p0": some(least * g0)})
    certain = sum((F.when(F.col(f"_mix_p{c}") >= 1, F.col(f"_mix_z{c}")).otherwise(0.0) for c in range(3)), F.lit(0.0))
    return out.withColumn("_mix_rest", F.greatest(rest - certain, F.lit(0.0))).drop("_mix_z0", "_mix_z1", "_mix_z2", "_mix_all")


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    max_repeat: float = MAX_REPEAT,
    seed: int = SEED,
    ranges: int = RANGES,
) -> DataFrame:
    """``docs`` (doc_id, text, source) plus size, source_size, target, copies and taken.

    Null sources are one source of their own, last in order.  Null and empty texts
    have size 0.  A source without words has target 0.  Rows equal in id and text
    are taken together.  Other columns pass through; own columns named like the
    results are replaced.  No documents: no rows."""
    made = ["size", "source_size", "target", "copies", "taken"]
    docs = docs.drop(*made)
    own = docs.columns  # those named like helper columns are put aside
    aside = {c: free_name(docs, f"own{c}") for c in own if c.lower().startswith("_mix")}
    docs = docs.withColumnsRenamed(aside)
    sized = docs.withColumn("size", words_in(F.col("text")))
    text_print = F.coalesce(F.md5(F.col("text")), F.lit(""))
    u = uniform(key_text(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text_print, seed=seed, salt="mix"))
    lean = settle(sized.select("source", "doc_id", "size", u.alias("_mix_u"), F.xxhash64("text").alias("_mix_h")))
    per_source = settle(lean.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")))
    goal = settle(targets(per_source.select("source", "source_size"), weights, max_repeat))
    n_sources = goal.agg(F.count(F.lit(1)), F.sum(F.length("source"))).first()
    small = 96 * n_sources[0] + 2 * (n_sources[1] or 0) <= BROADCAST_BYTES

    def by_source(rows: DataFrame, table: DataFrame) -> DataFrame:
        on = rows["source"].eqNullSafe(table["_mix_source"])
        return rows.join(F.broadcast(table) if small else table, on)

    goal = goal.withColumnRenamed("source", "_mix_source")
    goal = settle(by_source(per_source.select("source", "n"), goal).select("_mix_source", "source_size", "target", (F.col("source_size") / F.col("n")).alias("_mix_mean")))
    of_class = F.when(F.col("size") * 2 < F.col("_mix_mean"), 0).when(F.col("size") > F.col("_mix_mean") * 2, 2).otherwise(1)
    words = by_source(lean, goal).withColumn("_mix_class", of_class).groupBy("_mix_source", "source_size", "target", "_mix_mean")
    words = words.agg(*[F.coalesce(F.sum(F.when(F.col("_mix_class") == c, F.col("size"))), F.lit(0)).cast("double").alias(f"_mix_z{c}") for c in range(3)])
    plan = settle(_probabilities(words))
    rank_p = F.when(F.col("_mix_class") == 0, F.col("_mix_p0")).when(F.col("_mix_class") == 2, F.col("_mix_p2")).otherwise(F.col("_mix_p1"))

    def with_rank(rows: DataFrame) -> DataFrame:
        # ranking variable: random odds over inclusion odds, brought to [0, 1) as q / (1 + q)
        rows = rows.withColumn("_mix_class", of_class).withColumn("_mix_p", rank_p)
        odds = (F.col("_mix_u") / (1 - F.col("_mix_u"))) * ((1 - F.col("_mix_p")) / F.col("_mix_p"))
        rows = rows.withColumn("_mix_q", F.when((F.col("_mix_p") > 0) & (F.col("_mix_p") < 1), odds / (1 + odds)))
        return rows.withColumn("_mix_range", F.floor(F.col("_mix_q") * ranges).cast("int"))

    ranked = with_rank(by_source(lean, plan)).where(F.col("_mix_q").isNotNull())
    ranked = ranked.select("_mix_source", "_mix_rest", "_mix_range", "_mix_q", "doc_id", "size", "_mix_h")
    step = max(1, math.isqrt(ranges))

    def border(rows: DataFrame, by: Column, before: Column) -> DataFrame:
        """(_s, _mix_r, _mix_before): the range of each source where its rest is met, and the
        words before it; the window sorts at most about the square root of ``ranges`` rows a source."""
        sums = rows.groupBy("_mix_source", "_mix_rest", before.alias("_b"), by.alias("_at")).agg(F.sum("size").alias("_size"))
        along = Window.partitionBy("_mix_source").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
        found = sums.withColumn("_upto", F.col("_b") + F.sum("_size").over(along))
        found = found.where((F.col("_upto") >= F.col("_mix_rest")) & (F.col("_upto") - F.col("_size") < F.col("_mix_rest")))
        found = found.groupBy("_mix_source").agg(F.min(F.struct("_at", (F.col("_upto") - F.col("_size")).alias("_before"))).alias("_m"))
        return found.select(F.col("_mix_source").alias("_s"), F.col("_m._at").alias("_mix_r"), F.col("_m._before").alias("_mix_before"))

    coarse = F.floor(F.col("_mix_range") / step)
    first = settle(border(ranked, coarse, F.lit(0).cast("long")))
    inner = ranked.join(F.broadcast(first) if small else first, ranked["_mix_source"].eqNullSafe(first["_s"]) & (coarse == first["_mix_r"]))
    met = settle(border(inner, F.col("_mix_range"), F.col("_mix_before")))
    near = ranked.join(F.broadcast(met) if small else met, ranked["_mix_source"].eqNullSafe(met["_s"]) & (ranked["_mix_range"] == met["_mix_r"]))
    near = near.groupBy("_mix_source", "_mix_rest", "_mix_before", "_mix_r", "_mix_q", "doc_id", "_mix_h").agg(F.sum("size").alias("_size"))
    order = Window.partitionBy("_mix_source").orderBy("_mix_q", "doc_id", "_mix_h").rowsBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("_upto", F.col("_mix_before") + F.sum("_size").over(order))
    # the document at the border is taken if that brings the words nearer to the target
    inside = F.col("_upto") - F.col("_size") / 2 <= F.col("_mix_rest")
    last = near.where(inside).groupBy("_mix_source").agg(F.max(F.struct("_mix_q", "doc_id", "_mix_h")).alias("_mix_last"))
    cut = settle(
        plan.join(met, plan["_mix_source"].eqNullSafe(met["_s"]), "left")
        .join(last.withColumnRenamed("_mix_source", "_s2"), F.col("_mix_source").eqNullSafe(F.col("_s2")), "left")
        .drop("_s", "_s2", "_mix_before")
    )
    out = with_rank(by_source(sized.withColumn("_mix_u", u).withColumn("_mix_h", F.xxhash64("text")), cut))
    at_cut = F.struct("_mix_q", "doc_id", "_mix_h") <= F.col("_mix_last")
    more = F.when(F.col("_mix_p") >= 1, True).when(F.col("_mix_p") <= 0, False).when(F.col("_mix_r").isNull(), F.col("_mix_rest") > 0)
    more = more.when(F.col("_mix_range") < F.col("_mix_r"), True).otherwise((F.col("_mix_range") == F.col("_mix_r")) & F.coalesce(at_cut, F.lit(False)))
    out = out.withColumn("copies", (F.col("_mix_sure") + F.coalesce(more, F.lit(False)).cast("int")).cast("long"))
    out = out.withColumn("taken", F.col("copies") * F.col("size"))
    return out.select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in own], *made)


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: each document as many times as it is taken, columns as given."""
    # no filter on the copies: it would work them out a second time below the explode
    turn = free_name(mixed, "_copy")
    rows = mixed.withColumn(turn, F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    return rows.select(*[F.col(f"`{c}`") for c in columns])

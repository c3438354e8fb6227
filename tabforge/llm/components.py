"""Connected components of an edge list as Spark jobs.

Alternating large-star and small-star passes (Kiveris et al., "Connected
Components in MapReduce and Beyond"): every pass is aggregations and
equi-joins, edges never outnumber the input by more than the nodes, and the
number of passes grows with the logarithm of the longest path.  The minimum of
a node's neighbours is a partial aggregate, so a node with very many
neighbours is no hot group; the join that hands it out is a plain shuffle
join, which adaptive execution splits where it is skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import settle


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One star pass over edges (a, b); ``small`` links lower neighbours, else higher ones."""
    a, b = F.col("a"), F.col("b")
    if small:
        around = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    else:
        around = edges.select(a.alias("u"), b.alias("v")).unionAll(edges.select(b.alias("u"), a.alias("v")))
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    met = around.join(least, "u")
    if small:
        out = met.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    else:
        out = met.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    return out.where(F.col("a") != F.col("b")).distinct()


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.xxhash64("b").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b: long): label is the
    smallest node id that links reach.  Nodes that only have loops, and rows
    with a null end, are left out.  No edges: an empty table."""
    now = settle(edges.select("a", "b").where("a is not null and b is not null and a <> b").distinct())
    seen = _print(now)
    while seen[0]:
        now = settle(_star(_star(now, small=False), small=True))
        mark = _print(now)
        if mark == seen:
            break
        seen = mark
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )

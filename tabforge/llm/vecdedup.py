"""Near-duplicate vectors: random-hyperplane sign tables, exact cosine, components.

Each of T tables cuts space with b random hyperplanes; vectors with the same
signs share a bucket.  b grows with the logarithm of the number of vectors so
that buckets stay small, and T is chosen so that a pair at the threshold meets
in some table with probability RECALL; closer pairs meet more surely.  Pairs
in a bucket are verified by their cosine in double precision.

Equal vectors are one row with a count from the start.  Buckets are dealt into
cells of bounded size, a vector's links are counted inside the cells (a pair
that meets in several tables counts in its first), and each cell gives a vector
one edge to the smallest it links to: neither pairs nor groups are ever gathered.  A vector
travels once per table, with its code there; codes of other tables follow from the seed.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import LocalSets, complete_runs, settle, split_buckets
from tabforge.llm.components import components

THRESHOLD = 0.9
#: Chance that a pair exactly at the threshold meets in some table.
RECALL = 0.995
#: Vectors that a bucket holds on average, if they are spread evenly.
BUCKET = 48
#: Rows of a comparison chunk.
CELL = 1024
SEED = 1234


def plan_tables(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """Bits and tables for n vectors."""
    bits = int(min(40, max(4, round(math.log2(max(2, n / BUCKET))))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - same))


def usable(col: str = "embedding"):
    """Vectors that take part: not null or empty, all components finite, not all zero."""
    v = F.col(col)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(fine, F.lit(False)) & F.exists(v, lambda x: x != 0)


def matrix(col: pa.Array) -> np.ndarray:
    """(rows, d) of an array column whose vectors have one length."""
    n = len(col)
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, -1).astype(np.float64) if n else np.zeros((0, 1))


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def hyperplanes(dim: int, bits: int, tables: int, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(dim, bits * tables))


def codes_of(unit: np.ndarray, planes: np.ndarray, bits: int) -> np.ndarray:
    """(rows, tables): the sign code of each unit row in each table of ``planes``."""
    place = 1 << np.arange(bits, dtype=np.int64)
    return ((unit @ planes > 0).reshape(len(unit), -1, bits) * place).sum(axis=2)


def sign_codes(vectors: DataFrame, dim: int, bits: int, tables: int, seed: int = SEED, narrow: bool = False) -> DataFrame:
    """(id, embedding, weight) -> plus table and code, one row per table; ``narrow``: table and code alone."""
    planes = hyperplanes(dim, bits, tables, seed)
    slices = max(1, min(2000, 60_000 // tables))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, slices):
                batch = whole.slice(a, slices)
                codes = codes_of(unit_rows(matrix(batch.column("embedding"))), planes, bits)
                made = [pa.array(np.tile(np.arange(tables, dtype=np.int32), len(codes))), pa.array(codes.ravel())]
                if narrow:
                    yield pa.RecordBatch.from_arrays(made, names=["tab", "code"])
                else:
                    out = batch.take(pa.array(np.repeat(np.arange(len(codes)), tables)))
                    yield pa.RecordBatch.from_arrays([*out.columns, *made], names=["id", "embedding", "weight", "tab", "code"])

    kind = vectors.schema["embedding"].dataType.simpleString()
    shape = "tab int, code long" if narrow else f"id long, embedding {kind}, weight long, tab int, code long"
    return vectors.select("id", "embedding", "weight").mapInArrow(run, shape)


def _links(batches: Iterable[pa.RecordBatch], threshold: float, planes: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """Links in the cells: a pair counts in the first table that it meets in, so only pairs that
    link have their codes in the tables before computed, once a cell."""
    keys = ["tab", "code", "cell_a", "cell_b"]

    def read(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        cols = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in [*keys, "id", "weight", "chunk"]}
        return cols | {"x": unit_rows(matrix(batch.column("embedding")))}

    for cols, bounds in complete_runs(batches, keys, read):
        out: list[list[np.ndarray]] = [[], [], []]
        for g in np.flatnonzero(np.diff(bounds) > 1):
            cut = slice(bounds[g], bounds[g + 1])
            x, w, ids, chunk = (cols[c][cut] for c in ("x", "weight", "id", "chunk"))
            a, b, tab = cols["cell_a"][bounds[g]], cols["cell_b"][bounds[g]], int(cols["tab"][bounds[g]])
            left, right = np.flatnonzero(chunk == a), np.flatnonzero(chunk == b)
            count, sets, codes = np.zeros(len(ids), dtype=np.int64), LocalSets(len(ids)), None
            for s in range(0, len(left), 512):
                rows = left[s : s + 512]
                i, j = np.nonzero(x[rows] @ x[right].T >= threshold - 1e-9)
                i, j = rows[i], right[j]
                keep = i < j if a == b else i != j
                i, j = i[keep], j[keep]
                if not len(i):
                    continue
                ok = np.ones(len(i), dtype=bool)
                for p in range(0, len(i), 1 << 16):  # the deciding cosine, by the same sum for every pair
                    q = slice(p, p + (1 << 16))
                    ok[q] = (x[i[q]] * x[j[q]]).sum(axis=1) >= threshold
                i, j = i[ok], j[ok]
                sets.link(i, j)
                if codes is None and tab:
                    codes = codes_of(x, planes[:, : tab * bits], bits)
                first = np.ones(len(i), dtype=bool)
                for t in range(tab):
                    first &= codes[i, t] != codes[j, t]
                count += np.bincount(i[first], w[j[first]], len(ids)).astype(np.int64)
                count += np.bincount(j[first], w[i[first]], len(ids)).astype(np.int64)
            label = sets.labels()
            told = np.flatnonzero((count > 0) | (label != np.arange(len(ids))))
            for o, v in zip(out, (ids[told], count[told], ids[label[told]])):
                o.append(v)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o)) for o in out], names=["id", "links", "to"])


def near_duplicates(rows: DataFrame, threshold: float = THRESHOLD, seed: int = SEED) -> DataFrame:
    """One row per row of ``rows`` (vec_id, embedding): vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold null or non-finite components link
    with nothing and are their own component.  Vectors of different lengths never
    link.  Equal vectors link with each other, repeated rows included; rows that
    share an id but not the vector keep their own rows.  component_id is the
    smallest non-null vec_id of the component.  No rows: no rows."""
    rows = rows.select("vec_id", "embedding")
    good = usable()
    twin = F.xxhash64(F.lit(1), "embedding")  # with the first hash 128 bits, so that rows find their own vector
    marked = settle(rows.select("vec_id", "embedding", F.when(good, F.xxhash64("embedding")).alias("_node"), twin.alias("_own")))
    classes = settle(
        marked.where("_node is not null")
        .groupBy("_node", "embedding")
        .agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least"), F.min("_own").alias("_twin"))
        .withColumnRenamed("_node", "id")
    )
    links = None
    sizes = classes.groupBy(F.size("embedding").alias("d")).count().orderBy("d").collect()  # the distinct vector lengths
    for d, n in sizes:
        bits, tables = plan_tables(n, threshold)
        own = classes.where(F.size("embedding") == d)
        cells = split_buckets(
            sign_codes(own, d, bits, tables, seed), ["tab", "code"], "id", CELL, sign_codes(own, d, bits, tables, seed, narrow=True)
        )
        keys = ["tab", "code", "cell_a", "cell_b"]
        dealt = cells.repartition(*keys).sortWithinPartitions(*keys, "id")
        planes = hyperplanes(d, bits, tables, seed)
        found = dealt.mapInArrow(lambda b, p=planes, k=bits: _links(b, threshold, p, k), "id long, links long, to long")
        links = found if links is None else links.unionAll(found)
    if links is None:
        alone = marked.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
        return alone.withColumn("kept", F.lit(True))
    links = settle(links)
    counts = links.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(links.select(F.col("id").alias("a"), F.col("to").alias("b"))).withColumnRenamed("node", "id")
    known = classes.select("id", "_twin", "weight", "least").join(counts, "id", "left").join(groups, "id", "left")
    known = known.withColumn("group", F.coalesce("label", "id"))
    heads = known.groupBy("group").agg(F.min("least").alias("component_id"))
    table = settle(known.join(heads, "group").select("id", "_twin", "weight", "links", "component_id"))
    rows = marked.select("vec_id", "_node", "_own")
    out = rows.join(table, (rows["_node"] == table["id"]) & (rows["_own"] == table["_twin"]), "left")
    n_links = F.when(F.col("_node").isNull(), 0).otherwise(F.col("weight") - 1 + F.coalesce("links", F.lit(0)))
    group = F.when(F.col("_node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    out = out.select("vec_id", n_links.cast("long").alias("n_links"), group.alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

"""Exact top-k search by inner product: a ball tree in every shard, branch and bound.

Vectors become integers (floor of 256 times each component), so scores are exact.  Equal
vectors have equal scores for every query: of each distinct vector only its k + 1 smallest
ids take part (one may be the query's own), which is all that can reach a top k.

Regions: a binary tree of far-pair splits, fitted on a bounded sample, gives every row a
region; a region's ball (centre, radius over all of its rows) bounds the inner product of
anything in it: <q, centre> + |q| radius.  A region's rows are dealt into shards of at most
about SHARD rows.

Waves: a query visits its regions in the order of their bounds, first the best, then some
more, then all whose bound still reaches its k-th score.  That score, over all shards visited
so far, travels with the query: every shard starts from it.

Shard: its rows are built into a ball tree; queries stream past it.  Level by level nodes
whose bound is below the query's k-th score are cut off, and the leaves left are scanned in
the order of their bounds until the next one can't reach it.  Bounds carry a margin for
rounding and ties are never cut off, so the result is exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.llm.common import settle

K = 5
SCALE = 256
#: Rows, and numbers in all, that regions are fitted on, at most (chosen by a hash of the row).
SAMPLE, SAMPLE_VALUES = 20_000, 2_000_000
#: Rows of a shard, and numbers in it, about; levels of the region tree, at most.
SHARD, SHARD_VALUES, LEVELS = 4096, 1 << 21, 11
#: Queries that one copy of a shard serves, about; queries that a shard looks at together.
ASKS, TOGETHER = 1 << 16, 512
#: Rows of a ball tree's leaf.
LEAF = 64
#: Regions that a query has visited after each wave but the last, which visits all it needs.
WAVES = (1, 8)
SEED = 7
LOWEST = np.iinfo(np.int64).min


def usable(col: str = "embedding") -> Column:
    """Vectors that take part: not null, all components there and finite (zero and empty ones do)."""
    fine = F.forall(F.col(col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(col).isNotNull() & F.coalesce(fine, F.lit(False))


def quantised(col: str = "embedding") -> Column:
    """floor(256 x) of each component; beyond the range of a long its end."""
    return F.transform(F.col(col), lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("long"))


def matrix(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(col), dim)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of integer rows, exact; beyond the range of a long its end."""
    if not q.size or not x.size:
        return np.zeros((len(q), len(x)), dtype=np.int64)
    most = q.shape[1] * max(int(q.max()), -int(q.min())) * max(int(x.max()), -int(x.min()))
    if most < 1 << 53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    if most < 1 << 63:
        return q @ x.T
    exact = q.astype(object) @ x.astype(object).T
    return np.clip(exact, -(1 << 63) + 1, (1 << 63) - 1).astype(np.int64)


def lengths(x: np.ndarray) -> np.ndarray:
    y = x.astype(np.float64)
    return np.sqrt((y * y).sum(axis=1))


def reach(q: np.ndarray, centres: np.ndarray, radii: np.ndarray, far: np.ndarray) -> np.ndarray:
    """(queries, balls): at least the largest inner product of the query with a row of the ball
    (``far``: the length of its longest row).  The margin covers rounding."""
    size = lengths(q)[:, None]
    bound = np.minimum(q.astype(np.float64) @ centres.T + size * radii, size * far)
    return bound + 1e-9 * size * (far + radii) + 0.5


# ---------------------------------------------------------------- splits


def far_pair(x: np.ndarray) -> np.ndarray:
    """Direction from one far row to another."""
    a = x[((x - x.mean(axis=0)) ** 2).sum(axis=1).argmax()]
    b = x[((x - a) ** 2).sum(axis=1).argmax()]
    return b - a


@dataclass
class Regions:
    """A complete binary tree of splits (heap order) and the centre of each region."""

    directions: np.ndarray
    cuts: np.ndarray
    centres: np.ndarray

    def of(self, x: np.ndarray) -> np.ndarray:
        """Region of each row."""
        node = np.zeros(len(x), dtype=np.int64)
        for _ in range(len(self.centres).bit_length() - 1):
            right = np.einsum("ij,ij->i", x, self.directions[node]) > self.cuts[node]
            node = 2 * node + 1 + right
        return node - (len(self.centres) - 1)


def fit_regions(sample: np.ndarray, n: int) -> Regions:
    """Regions of about SHARD rows each for ``n`` rows; a region has some sample rows at least."""
    dim = sample.shape[1]
    levels = math.ceil(math.log2(max(1, n / SHARD)))
    levels = max(0, min(levels, LEVELS, int(math.log2(max(1, len(sample) / 16))), int(math.log2(max(1, (4 << 20) / max(1, dim))))))
    directions, cuts = np.zeros((2**levels - 1, dim)), np.zeros(2**levels - 1)
    sets = [np.arange(len(sample))]
    for level in range(levels):
        after = []
        for i, rows in enumerate(sets):
            node = 2**level - 1 + i
            if len(rows):
                directions[node] = far_pair(sample[rows])
                along = sample[rows] @ directions[node]
                cuts[node] = np.median(along)
                after += [rows[along <= cuts[node]], rows[along > cuts[node]]]
            else:
                after += [rows, rows]
        sets = after
    return Regions(directions, cuts, np.array([sample[s].mean(axis=0) if len(s) else np.zeros(dim) for s in sets]))


class BallTree:
    """Balls over the rows of a shard: nodes by level, leaves of LEAF rows or fewer."""

    def __init__(self, x: np.ndarray, ids: np.ndarray):
        y = x.astype(np.float64)
        order: list[np.ndarray] = []
        levels: list[list[tuple[int, int]]] = []  # each node's parent in the level above, and leaf number or -1
        balls: list[list[tuple[np.ndarray, float, float]]] = []
        todo, leaves = [(np.arange(len(x)), 0)], 0
        while todo:
            nodes, made, after = [], [], []
            for rows, parent in todo:
                centre = y[rows].mean(axis=0)
                far = float(np.sqrt(((y[rows] - centre) ** 2).sum(axis=1)).max())
                made.append((centre, far, float(np.sqrt((y[rows] ** 2).sum(axis=1)).max())))
                if len(rows) <= LEAF or far == 0:
                    nodes.append((parent, leaves))
                    order.append(rows)
                    leaves += 1
                    continue
                along = y[rows] @ far_pair(y[rows])
                turn = np.argsort(along, kind="stable")
                after += [(rows[turn[: len(rows) // 2]], len(nodes)), (rows[turn[len(rows) // 2 :]], len(nodes))]
                nodes.append((parent, -1))
            levels.append(nodes)
            balls.append(made)
            todo = after
        self.levels = [np.array(n, dtype=np.int64).reshape(-1, 2) for n in levels]
        self.balls = [(np.array([b[0] for b in m]), np.array([b[1] for b in m]), np.array([b[2] for b in m])) for m in balls]
        self.x, self.ids, self.leaves = x, ids, order

    def leaf_bounds(self, q: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """(queries, leaves): bound of each leaf, -inf where it or a ball above can't reach ``floor``."""
        out = np.full((len(q), len(self.leaves)), -np.inf)
        above = np.full((len(q), 1), np.inf)
        for (parent, leaf), ball in zip((n.T for n in self.levels), self.balls):
            bound = above[:, parent]
            open_ = np.flatnonzero((bound > -np.inf).any(axis=0))
            bound[:, open_] = np.minimum(bound[:, open_], reach(q, *[b[open_] for b in ball]))
            bound[bound < floor[:, None]] = -np.inf
            ends = leaf >= 0
            out[:, leaf[ends]] = bound[:, ends]
            above = bound
        return out

    def search(self, q: np.ndarray, qids: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query row, row, score), best first: up to k rows for each query, none below ``floor``."""
        bounds = self.leaf_bounds(q, floor)
        turns = np.argsort(-bounds, axis=1, kind="stable")
        bounds = np.take_along_axis(bounds, turns, axis=1)
        best = np.full((len(q), k), LOWEST)
        least = floor.copy()
        hits: list[list[np.ndarray]] = [[np.zeros(0, dtype=np.int64)] for _ in range(3)]
        live = np.arange(len(q))
        for turn in range(turns.shape[1]):
            live = live[(bounds[live, turn] >= least[live]) & (bounds[live, turn] > -np.inf)]
            if not len(live):
                break
            by_leaf = live[np.argsort(turns[live, turn], kind="stable")]
            for group in np.split(by_leaf, np.flatnonzero(np.diff(turns[by_leaf, turn])) + 1):
                rows = self.leaves[turns[group[0], turn]]
                score = products(q[group], self.x[rows])
                own = self.ids[rows][None, :] == qids[group][:, None]
                score[own] = LOWEST
                i, j = np.nonzero((score >= least[group][:, None]) & ~own)
                if not len(i):
                    continue
                for hit, found in zip(hits, (group[i], rows[j], score[i, j])):
                    hit.append(found)
                some = np.unique(i)
                both = np.concatenate([best[group[some]], score[some]], axis=1)
                best[group[some]] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
                least[group[some]] = np.maximum(least[group[some]], best[group[some]].min(axis=1))
        asked, row, score = (np.concatenate(h) for h in hits)
        order = np.lexsort((self.ids[row], -score, asked))
        order = order[score[order] >= least[asked[order]]]
        asked, row, score = asked[order], row[order], score[order]
        first = np.searchsorted(asked, asked)  # where the query's hits begin
        stay = np.arange(len(asked)) - first < k
        return asked[stay], row[stay], score[stay]


# ---------------------------------------------------------------- Spark


def _shards(batches: Iterable[pa.RecordBatch], dim: int, k: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard, candidates before queries -> (query_id, mark, vec_id, times, score)."""
    names = ("region", "shard", "turn", "asks")
    key: tuple | None = None
    held: list[tuple] = []
    tree: BallTree | None = None
    times = np.zeros(0, dtype=np.int64)
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in names], axis=1)
        ids, marks, extra = (batch.column(c).to_numpy() for c in ("vec_id", "mark", "extra"))
        cut = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *cut], [*cut, len(keys)]):
            if a == b:
                continue
            if tuple(keys[a, :3]) != key:
                key, held, tree = tuple(keys[a, :3]), [], None
            for c in range(a, b, TOGETHER):
                part = slice(c, min(b, c + TOGETHER))
                x = matrix(batch.column("code").slice(c, part.stop - c), dim)
                if not keys[a, 3]:
                    held.append((x, ids[part].copy(), extra[part].copy()))
                    continue
                if held:
                    tree = BallTree(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
                    times, held = np.concatenate([h[2] for h in held]), []
                if tree is None:
                    continue
                asked, row, score = tree.search(x, ids[part], extra[part], k)
                cols = ids[part][asked], marks[part][asked], tree.ids[row], times[row], score
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in cols], names=["query_id", "mark", "vec_id", "times", "score"])


def _placed(rows: DataFrame, regions: Regions) -> DataFrame:
    """Candidates with their region, their distance from its centre and their length."""
    dim = regions.centres.shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("code"), dim).astype(np.float64)
            region = regions.of(x)
            gap = x - regions.centres[region]
            more = [region.astype(np.int32), np.sqrt((gap * gap).sum(axis=1)), lengths(x)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, more)], names=[*batch.schema.names, "region", "gap", "len"])

    return rows.mapInArrow(run, "vec_id long, code array<long>, times long, region int, gap double, len double")


def _visits(asks: DataFrame, balls: list[np.ndarray], named: np.ndarray, start: int, stop: int, narrow: bool) -> DataFrame:
    """Each query once for every region at places start to stop of its order whose bound reaches its floor."""
    dim = balls[0].shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, TOGETHER):
                batch = whole.slice(a, TOGETHER)
                bound = reach(matrix(batch.column("code"), dim), *balls)
                turns = np.argsort(-bound, axis=1, kind="stable")[:, start:stop]
                floor = batch.column("extra").to_numpy()
                i, j = np.nonzero(np.take_along_axis(bound, turns, axis=1) >= floor[:, None])
                region = pa.array(named[turns[i, j]].astype(np.int32))
                if narrow:
                    yield pa.RecordBatch.from_arrays([region], names=["region"])
                else:
                    yield pa.RecordBatch.from_arrays([*batch.take(pa.array(i)).columns, region], names=[*batch.schema.names, "region"])

    shape = "region int" if narrow else "vec_id long, mark long, code array<long>, extra long, region int"
    return asks.select("vec_id", "mark", "code", "extra").mapInArrow(run, shape)


def _best(found: DataFrame, k: int) -> DataFrame:
    """Rank of the k best of each query; a row that is there several times counts so often."""
    each = found.withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), F.least("times", F.lit(k)))))
    order = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search(rows: DataFrame, asks: DataFrame, dim: int, k: int) -> DataFrame | None:
    """Hits (query_id, mark, vec_id, times, score) among vectors of one length."""
    spark = rows.sparkSession
    n = rows.count()
    size = max(64, min(SHARD, SHARD_VALUES // max(1, dim)))
    want = max(64, min(SAMPLE, SAMPLE_VALUES // max(1, dim)))
    print_ = F.xxhash64(F.lit(SEED), "vec_id", "code")
    sample = rows.where(F.pmod(print_, F.lit(n)) < 2 * want).orderBy(print_, "vec_id").limit(want).select("code").collect()
    fitted = fit_regions(np.array([r[0] for r in sample], dtype=np.float64).reshape(len(sample), dim), n)
    placed = settle(_placed(rows, fitted))
    stats = placed.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.max("gap").alias("gap"), F.max("len").alias("len"))
    stats = sorted(stats.collect())  # at most 2 ** LEVELS rows
    named = np.array([r.region for r in stats])
    balls = [fitted.centres[named], np.array([r.gap for r in stats]), np.array([r["len"] for r in stats])]
    found = None
    stops = [w for w in WAVES if w < len(stats)] + [len(stats)]
    for start, stop in zip([0, *stops], stops):
        if found is not None:
            kth = _best(found, k).where(F.col("rank") == k).select(F.col("query_id").alias("_q"), F.col("mark").alias("_m"), F.col("score").alias("_kth"))
            told = asks.join(kth, (asks["vec_id"] == kth["_q"]) & (asks["mark"] == kth["_m"]), "left")
            asks = settle(told.select("vec_id", "mark", "code", F.coalesce("_kth", F.col("extra")).alias("extra")))
        asked = dict(_visits(asks, balls, named, start, stop, True).groupBy("region").count().collect())
        plan = [(r.region, -(-r.n // size), -(-asked[r.region] // ASKS)) for r in stats if asked.get(r.region)]
        if not plan:
            continue
        table = F.broadcast(spark.createDataFrame(plan, "region int, shards int, turns int"))
        part = lambda seed, of, *cols: F.pmod(F.xxhash64(F.lit(seed), *cols), F.col(of)).cast("int")
        each = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
        there = placed.join(table, "region").withColumns({"shard": part(1, "shards", "vec_id", "code"), "asks": F.lit(0), "mark": F.lit(0).cast("long")})
        there = there.withColumn("turn", each("turns")).withColumnRenamed("times", "extra")
        here = _visits(asks, balls, named, start, stop, False).join(table, "region")
        here = here.withColumns({"turn": part(2, "turns", "vec_id", "mark"), "asks": F.lit(1)}).withColumn("shard", each("shards"))
        keys = ["region", "shard", "turn"]
        both = there.select(*keys, "asks", "vec_id", "mark", "code", "extra").unionByName(here.select(*keys, "asks", "vec_id", "mark", "code", "extra"))
        dealt = both.repartition(*keys).sortWithinPartitions(*keys, "asks", "vec_id")
        hits = dealt.mapInArrow(lambda b: _shards(b, dim, k), "query_id long, mark long, vec_id long, times long, score long")
        hits = settle(hits)
        found = hits if found is None else found.unionAll(hits)
    return found


def search(rows: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """Each query's k rows of largest integer inner product: query_id, rank, vec_id, score.

    ``rows`` and ``queries`` have vec_id and embedding; other columns are ignored.  Rows without
    an id and vectors that are null or hold null or non-finite components take no part; vectors
    meet only those of their own length, zero and empty vectors too.  Rows with the query's own
    vec_id are not its candidates; repeated candidate rows count as rows, and repeated equal
    query rows are one query.  Ties go to the smaller vec_id.  A query with fewer candidates
    gets them all.  Components and scores beyond a long are its ends.  Empty tables: no rows."""
    coded = lambda df: df.where(usable() & F.col("vec_id").isNotNull()).select("vec_id", quantised().alias("code"))
    alike = Window.partitionBy("code").orderBy("vec_id")
    kept = coded(rows).groupBy("vec_id", "code").agg(F.count(F.lit(1)).alias("times"))
    kept = settle(kept.withColumn("_n", F.row_number().over(alike)).where(F.col("_n") <= k + 1).drop("_n"))
    asks = coded(queries).distinct().select("vec_id", F.xxhash64("code").alias("mark"), "code", F.lit(int(LOWEST)).alias("extra"))
    asks = settle(asks)
    result = None
    for (dim,) in kept.select(F.size("code")).distinct().orderBy(F.size("code")).collect():  # the distinct vector lengths
        own = [t.where(F.size("code") == dim) for t in (kept, asks)]
        found = _search(*own, dim, k)
        if found is not None:
            result = found if result is None else result.unionAll(found)
    if result is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return _best(result, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

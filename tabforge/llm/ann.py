"""Approximate nearest neighbours: inverted lists and an adaptive dimension scan.

Vectors are scaled to length one and turned by a random rotation; the nearest of
the centroids (fitted on a bounded sample, about the square root of the rows in number) names a
vector's list, every row is listed.  A query probes the lists of its nearest centroids, as many as
are calibrated: a bounded sample of the queries is compared with all rows, and the lists
that hold RECALL of their true neighbours are enough.  Within a probed list
candidates lie in column blocks of BLOCK_DIMS rotated dimensions and are scanned
block by block: after d of D dimensions the partial squared distance, scaled by
D/d, estimates the whole one, and a candidate is abandoned when the estimate
exceeds the query's current k-th distance by more than the hypothesis test at
EPSILON allows.  Survivors get the exact cosine of the original vectors.  The lists nearest to a
query come first; the k-th distance in them is where it starts in all others.

A list's rows are dealt into blocks of bounded size, and queries stream past them: a
candidate travels once for up to ASKS queries of its list, so a list with a third of all
rows is many blocks and no task holds more than one.  Each block returns k rows a query.

A query with fewer than k results after its probes (small lists, or few rows) is
run again over all lists without abandoning, so it gets all there is.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabforge.llm.common import settle
from tabforge.llm.vecdedup import matrix, unit_rows, usable

K = 5
#: Lists, at most; else the square root of the rows.
LISTS = 4096
#: Sample rows a list, and numbers in all, that centroids are fitted on, at most (chosen by a hash of the row).
SAMPLE_PER_LIST, SAMPLE_VALUES = 16, 4_000_000
#: Queries that the probes are calibrated on, at most, and the share of their neighbours to be found.
CALIBRATE, RECALL = 128, 0.98
BLOCK_DIMS = 16
#: Width of the hypothesis test, in units of 1 / sqrt(dimensions read).
EPSILON = 2.1
#: Rows of a block, queries that one copy of it serves, both about; queries looked at together, candidates scanned at once.
CANDIDATES, ASKS, TOGETHER, STEP = 4096, 1 << 16, 64, 1024
#: Lists of the first wave.
FIRST = 4
SEED = 99


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows by a power of two of their own, so that squares neither overflow nor vanish; cosines
    are the same to the last bit."""
    _, power = np.frexp(np.abs(x).max(axis=1, initial=0.0))
    return np.ldexp(x, -power[:, None])


@dataclass
class Index:
    centroids: np.ndarray
    rotation: np.ndarray

    def lists_of(self, unit: np.ndarray) -> np.ndarray:
        return (unit @ self.centroids.T).argmax(axis=1)

    def order(self, unit: np.ndarray) -> np.ndarray:
        """Lists of each row, nearest first."""
        return np.argsort(-(unit @ self.centroids.T), axis=1, kind="stable")


def fit_index(sample: np.ndarray, n: int, lists: int = LISTS, rounds: int = 8, seed: int = SEED) -> Index:
    """Centroids by spherical k-means on the sample, and a random rotation."""
    rng = np.random.default_rng(seed)
    unit = unit_rows(sample)
    k = int(max(1, min(lists, len(unit) // 8, round(math.sqrt(n)))))
    c = unit[rng.choice(len(unit), k, replace=False)]
    for _ in range(rounds):
        near = np.concatenate([(unit[a : a + 4096] @ c.T).argmax(axis=1) for a in range(0, len(unit), 4096)])
        total = np.zeros_like(c)
        np.add.at(total, near, unit)
        size = np.sqrt((total * total).sum(axis=1))
        c = np.where(size[:, None] > 1e-9, total / np.maximum(size, 1e-9)[:, None], c)
    d = unit.shape[1]
    q, r = np.linalg.qr(rng.normal(size=(d, d)))
    return Index(c, q * np.sign(np.diag(r)))


class Block:
    """Candidates in column blocks of rotated dimensions, ready for queries."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, rotation: np.ndarray):
        self.x, self.ids, self.rotation = scaled(x), ids, rotation
        self.norm = np.sqrt((self.x * self.x).sum(axis=1))
        self.dim = x.shape[1]
        self.cuts = list(range(0, self.dim, BLOCK_DIMS)) + [self.dim]
        turned = (self.x / self.norm[:, None]) @ rotation
        self.columns = [np.ascontiguousarray(turned[:, a:b]) for a, b in zip(self.cuts[:-1], self.cuts[1:])]
        self.test = [(b / self.dim) * (1 + EPSILON / math.sqrt(b)) ** 2 if b < self.dim else 1.0 for b in self.cuts[1:]]

    def scan(
        self, q: np.ndarray, qids: np.ndarray, k: int, adaptive: bool = True, bound: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query row, id, cosine): up to k candidates for each query of ``q``, best first.  ``bound``:
        squared distances (of unit vectors) beyond which a query wants none."""
        q = scaled(q)
        norm_q = np.sqrt((q * q).sum(axis=1))
        turned = (q / norm_q[:, None]) @ self.rotation
        worst = np.full(len(q), np.inf) if bound is None else bound.copy()
        best = np.full((len(q), k), np.inf)
        hits: list[list[np.ndarray]] = [[np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], [np.zeros(0)]]
        lead, width = self.columns[0], self.cuts[1]
        lead_size, q_size = (lead * lead).sum(axis=1), (turned[:, :width] ** 2).sum(axis=1)
        a = 0
        while a < len(self.x):
            b = min(len(self.x), a + (STEP if np.isfinite(worst).all() else 32))
            part = q_size[:, None] + lead_size[None, a:b] - 2 * (turned[:, :width] @ lead[a:b].T)
            part[self.ids[a:b][None, :] == qids[:, None]] = np.inf
            limit = worst * self.test[0] + 1e-9 if adaptive else np.full(len(q), np.inf)
            i, j = np.nonzero((part <= limit[:, None]) & np.isfinite(part))
            d, j = part[i, j], j + a
            for column, lo, hi, factor in zip(self.columns[1:], self.cuts[1:-1], self.cuts[2:], self.test[1:]):
                gap = column[j] - turned[i, lo:hi]
                d = d + np.einsum("ij,ij->i", gap, gap)
                if adaptive:
                    stay = d <= worst[i] * factor + 1e-9
                    i, j, d = i[stay], j[stay], d[stay]
            for hit, found in zip(hits, (i, j, d)):
                hit.append(found)
            order = np.lexsort((d, i))
            place = np.arange(len(i)) - np.searchsorted(i[order], i[order])
            few = place < k
            new = np.full((len(q), k), np.inf)
            new[i[order][few], place[few]] = d[order][few]
            best = np.sort(np.concatenate([best, new], axis=1), axis=1)[:, :k]
            worst = np.minimum(worst, best[:, k - 1])
            a = b
        i, j, d = (np.concatenate(h) for h in hits)
        stay = d <= worst[i] + 1e-9  # ties stay until the exact cosine decides
        i, j = i[stay], j[stay]
        cos = np.empty(len(i))
        for a in range(0, len(i), 1 << 15):
            part = slice(a, a + (1 << 15))
            cos[part] = (self.x[j[part]] * q[i[part]]).sum(axis=1) / (self.norm[j[part]] * norm_q[i[part]])
        order = np.lexsort((self.ids[j], -cos, i))
        i, j, cos = i[order], j[order], cos[order]
        few = np.arange(len(i)) - np.searchsorted(i, i) < k
        return i[few], self.ids[j[few]], cos[few]


def _blocks(batches: Iterable[pa.RecordBatch], rotation: np.ndarray, k: int, adaptive: bool) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block, candidates before queries -> (query_id, mark, vec_id, score)."""
    key: tuple | None = None
    held: list[tuple[np.ndarray, np.ndarray]] = []
    block: Block | None = None
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in ("list", "block", "turn", "asks")], axis=1)
        ids, marks, bounds = (batch.column(c).to_numpy() for c in ("vec_id", "mark", "bound"))
        cut = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *cut], [*cut, len(keys)]):
            if a == b:
                continue
            if tuple(keys[a, :3]) != key:
                key, held, block = tuple(keys[a, :3]), [], None
            for c in range(a, b, TOGETHER):
                part = slice(c, min(b, c + TOGETHER))
                x = matrix(batch.column("embedding").slice(c, part.stop - c))
                if not keys[a, 3]:
                    held.append((x, ids[part].copy()))
                    continue
                if held:
                    block, held = Block(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), rotation), []
                if block is not None:
                    row, near, cos = block.scan(x, ids[part], k, adaptive, bounds[part])
                    cols = ids[part][row], marks[part][row], near, cos
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in cols], names=["query_id", "mark", "vec_id", "score"])


def _listed(vectors: DataFrame, index: Index, role: int, start: int = 0, stop: int = 1) -> DataFrame:
    """Rows with their list (role 0), or once for each list at places start to stop of their order (role 1)."""
    step = max(1, min(2000, (4 << 20) // len(index.centroids)))
    cols = ["vec_id", "mark", "embedding", "bound"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, step):
                batch = whole.slice(a, step)
                unit = unit_rows(matrix(batch.column("embedding")))
                lists = index.order(unit)[:, start:stop] if role else index.lists_of(unit)[:, None]
                out = batch.take(pa.array(np.repeat(np.arange(batch.num_rows), lists.shape[1])))
                made = [pa.array(lists.ravel().astype(np.int32)), pa.array(np.full(out.num_rows, role, dtype=np.int32))]
                yield pa.RecordBatch.from_arrays([*out.columns, *made], names=[*cols, "list", "asks"])

    kind = vectors.schema["embedding"].dataType.simpleString()
    return vectors.select(*cols).mapInArrow(run, f"vec_id long, mark long, embedding {kind}, bound double, list int, asks int")


def calibrate(vectors: DataFrame, queries: DataFrame, index: Index, k: int, share: float = RECALL) -> int:
    """Lists to probe: up to CALIBRATE queries are compared with all rows, each task keeping k rows a
    query; as many lists as hold ``share`` of their true neighbours."""
    few = queries.orderBy(F.xxhash64(F.lit(SEED), "vec_id", "mark"), "vec_id", "mark").limit(CALIBRATE).select("vec_id", "embedding").collect()
    if not few:
        return 1
    asked, qids = unit_rows(np.array([r.embedding for r in few], dtype=np.float64)), np.array([r.vec_id for r in few])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score, where = np.full((len(asked), k), -2.0), np.full((len(asked), k), -1)
        for whole in batches:
            for a in range(0, whole.num_rows, 2000):
                batch = whole.slice(a, 2000)
                unit = unit_rows(matrix(batch.column("embedding")))
                lists = index.lists_of(unit)
                cos = asked @ unit.T
                cos[qids[:, None] == batch.column("vec_id").to_numpy()[None, :]] = -2.0
                score = np.concatenate([score, cos], axis=1)
                where = np.concatenate([where, np.broadcast_to(lists, cos.shape)], axis=1)
                best = np.argpartition(-score, k - 1, axis=1)[:, :k]
                score, where = np.take_along_axis(score, best, 1), np.take_along_axis(where, best, 1)
        at = np.repeat(np.arange(len(asked)), k)
        keep = where.ravel() >= 0
        cols = [at[keep].astype(np.int32), score.ravel()[keep], where.ravel()[keep].astype(np.int32)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["q", "score", "list"])

    best = Window.partitionBy("q").orderBy(F.desc("score"))
    near = vectors.select("vec_id", "embedding").mapInArrow(run, "q int, score double, list int")
    near = near.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k).select("q", "list").collect()  # CALIBRATE * k rows
    place = np.argsort(index.order(asked), axis=1)
    ranks = np.sort([place[r.q, r.list] for r in near]) if near else np.zeros(1, dtype=np.int64)
    return int(ranks[min(len(ranks) - 1, math.ceil(share * len(ranks)) - 1)]) + 1


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _wave(vectors: DataFrame, queries: DataFrame, index: Index, start: int, stop: int, k: int, adaptive: bool) -> DataFrame:
    """Hits (query_id, mark, vec_id, score) in the lists at places start to stop of each query's order."""
    spark = vectors.sparkSession
    rows, asks = _listed(vectors, index, 0), _listed(queries, index, 1, start, stop)
    sizes = dict(rows.groupBy("list").count().collect())  # at most LISTS rows
    asked = dict(asks.groupBy("list").count().collect())
    plan = [(i, -(-sizes[i] // CANDIDATES), -(-asked[i] // ASKS)) for i in sizes if asked.get(i)]
    table = F.broadcast(spark.createDataFrame(plan, "list int, blocks int, turns int"))
    spread = lambda seed, of: F.pmod(F.xxhash64(F.lit(seed), "vec_id", "mark"), F.col(of)).cast("int")
    each = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    rows = rows.join(table, "list").withColumn("block", spread(1, "blocks")).withColumn("turn", each("turns"))
    asks = asks.join(table, "list").withColumn("turn", spread(2, "turns")).withColumn("block", each("blocks"))
    keys = ["list", "block", "turn"]
    cols = [*keys, "asks", "vec_id", "mark", "bound", "embedding"]
    dealt = rows.select(*cols).unionByName(asks.select(*cols)).repartition(*keys).sortWithinPartitions(*keys, "asks", "vec_id")
    return dealt.mapInArrow(
        lambda b: _blocks(b, index.rotation, k, adaptive), "query_id long, mark long, vec_id long, score double"
    )


def _search(vectors: DataFrame, queries: DataFrame, index: Index, probes: int, k: int, adaptive: bool) -> DataFrame:
    """The nearest lists first; their k-th distance is the bound in the others."""
    first = min(FIRST, probes) if adaptive else probes
    found = _wave(vectors, queries, index, 0, first, k, adaptive)
    if first < probes:
        found = settle(found)
        kth = _best(found, k).where(F.col("rank") == k).select(F.col("query_id").alias("_q"), F.col("mark").alias("_m"), F.col("score").alias("_s"))
        met = queries.join(kth, (queries["vec_id"] == kth["_q"]) & (queries["mark"] == kth["_m"]), "left")
        # squared distance of unit vectors, with room for rounding
        bound = F.coalesce(2 - 2 * F.col("_s") + F.lit(1e-9), F.col("bound"))
        asks = settle(met.select("vec_id", "mark", "embedding", bound.alias("bound")))
        found = found.unionAll(_wave(vectors, asks, index, first, probes, k, adaptive))
    return _best(found, k)


def search(rows: DataFrame, queries: DataFrame, k: int = K, recall: float = RECALL) -> DataFrame:
    """Each query's k nearest rows by cosine: query_id, rank, vec_id, score.

    ``rows`` and ``queries`` have vec_id and embedding.  Rows without an id and
    vectors that are null, empty, zero or hold null or non-finite components take
    no part; vectors meet only those of their own length.  Rows with the query's
    own vec_id are not its candidates; repeated candidate rows count as rows, and
    repeated equal query rows are one query.  Empty tables: no rows."""
    fine = usable() & F.col("vec_id").isNotNull()
    mark = F.xxhash64("embedding")
    open_ = F.lit(float("inf")).alias("bound")
    vectors = settle(rows.where(fine).select("vec_id", mark.alias("mark"), "embedding", open_))
    asked = settle(queries.where(fine).select("vec_id", mark.alias("mark"), "embedding", open_).dropDuplicates(["vec_id", "mark"]))
    result = None
    for d, n in vectors.groupBy(F.size("embedding")).count().orderBy(F.size("embedding")).collect():
        own = vectors.where(F.size("embedding") == d)
        own_asks = asked.where(F.size("embedding") == d)
        if not own_asks.take(1):
            continue
        want = max(1, min(SAMPLE_PER_LIST * round(math.sqrt(n)) + 64, SAMPLE_PER_LIST * LISTS, SAMPLE_VALUES // d))
        turn = F.xxhash64(F.lit(SEED), "vec_id", "mark")
        drawn = own.where(F.pmod(turn, F.lit(n)) < 2 * want + 64).orderBy(turn, "vec_id", "mark").limit(want).select("embedding").collect()
        if not drawn:  # copies of few rows may all miss the draw
            drawn = own.limit(want).select("embedding").collect()
        index = fit_index(np.array([r[0] for r in drawn], dtype=np.float64), n)
        probes = calibrate(own, own_asks, index, k, recall)
        found = settle(_search(own, own_asks, index, probes, k, True))
        counts = found.groupBy("query_id", "mark").agg(F.count(F.lit(1)).alias("n"))
        short = own_asks.join(
            counts.where(F.col("n") >= k), (F.col("vec_id") == F.col("query_id")) & (own_asks["mark"] == counts["mark"]), "left_anti"
        )
        short = settle(short)
        if short.take(1):
            again = _search(own, short, index, len(index.centroids), k, False)
            full = found.join(short.select(F.col("vec_id").alias("query_id"), "mark"), ["query_id", "mark"], "left_anti")
            found = full.select(found.columns).unionByName(again.select(found.columns))
        result = found if result is None else result.unionByName(found)
    if result is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return result.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

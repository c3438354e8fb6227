"""Exact search against all inner products."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.llm import topk

VEC = "vec_id long, embedding array<float>, label int"


def slow(rows, queries, k=5) -> list[tuple]:
    """Python integers, sorted; one query per distinct (id, vector)."""

    def code(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        ends = lambda x: max(-(2**63), min(2**63 - 1, x))
        return tuple(ends(math.floor(256 * float(np.float32(x)))) for x in v)

    own = [(i, code(v)) for i, v in rows if i is not None and code(v) is not None]
    out = []
    for qid, q in {(i, code(v)) for i, v in queries if i is not None and code(v) is not None}:
        scores = [(-max(-(2**63) + 1, min(2**63 - 1, sum(a * b for a, b in zip(q, c)))), i) for i, c in own if i != qid and len(c) == len(q)]
        out += [(qid, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def fast(x: np.ndarray, ids: np.ndarray, asked: np.ndarray, k=5) -> list[tuple]:
    c = np.floor(256 * x.astype(np.float64)).astype(np.int64)
    out = []
    for j in asked:
        s = c @ c[j]
        order = np.lexsort((ids, -s))
        order = order[ids[order] != ids[j]][:k]
        out += [(int(ids[j]), n + 1, int(ids[i]), int(s[i])) for n, i in enumerate(order)]
    return sorted(out)


@pytest.mark.parametrize("d,n,m", [(8, 3000, 40), (64, 2000, 300), (0, 5, 3), (3, 1, 2), (16, 300, 30)])
def test_tree_finds_what_reaches_the_floor(d, n, m):
    rng = np.random.default_rng(n)
    x, ids = rng.integers(-60, 60, (n, d)), rng.permutation(2 * n)[:n]
    q, qids = x[rng.integers(0, n, m)], rng.integers(0, 2 * n, m)
    tree = topk.BallTree(x, ids)
    for floor in (np.full(m, topk.LOWEST), rng.integers(0, 4000, m)):
        asked, row, score = tree.search(q, qids, floor, 5)
        s = q @ x.T
        for i in range(m):
            want = sorted((-s[i, j], ids[j]) for j in range(n) if ids[j] != qids[i] and s[i, j] >= floor[i])[:5]
            assert [(-a, ids[b]) for a, b in zip(score[asked == i], row[asked == i])] == want


def test_bounds_cut_leaves_off():
    """Clustered rows: most leaves are never scanned, whose bound can't reach the k-th score."""
    rng = np.random.default_rng(1)
    x = (np.repeat(rng.normal(size=(32, 16)) * 100, 128, axis=0) + rng.normal(size=(4096, 16))).astype(np.int64)
    tree = topk.BallTree(x, np.arange(4096))
    floor = np.sort(x[:8] @ x.T, axis=1)[:, -5]
    open_ = tree.leaf_bounds(x[:8], floor) > -np.inf
    assert open_.any(axis=1).all() and open_.mean() < 0.2


def test_products_are_exact():
    for most in (1 << 20, 1 << 28, 1 << 62):
        x = np.random.default_rng(2).integers(-most, most, (5, 7))
        want = x.astype(object) @ x.astype(object).T
        assert (topk.products(x, x) == np.clip(want, -(2**63) + 1, 2**63 - 1)).all()


def test_search_over_many_regions(spark):
    """A third of the rows are copies of one vector, a third is one tight cluster; several waves and shards."""
    rng = np.random.default_rng(3)
    n = 30_000
    x = rng.normal(size=(n, 8)).astype(np.float32)
    x[: n // 3] = x[0]
    x[n // 3 : 2 * n // 3] = x[n // 3] + 0.01 * rng.normal(size=(n // 3, 8))
    ids = rng.permutation(n)
    table = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(ids, x)], VEC).repartition(6)
    got = topk.search(table, table.where("vec_id % 100 = 0")).collect()
    assert sorted(map(tuple, got)) == fast(x, ids, np.flatnonzero(ids % 100 == 0))


def test_search_edges(spark):
    """Nulls, non-finite components, zero and empty vectors, several lengths, repeated rows and ids, ties, huge values."""
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, [1.0, 2.0]), (50, [1.0, 2.0]), (50, [-1.0, 0.5]), (1, [0.0, 0.0]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]),
            (5, [inf, 1.0]), (None, [1.0, 2.0]), (6, []), (100, []), (7, [1.0]), (150, [3e38, -3e38]), (8, [3e38, 1.0]), (9, [2.0, 1.0]), (9, [2.0, 1.0]),
            (10, [1.0, 2.0]), (11, [1.0, 2.0]), (200, [5.0, 5.0, 5.0])]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], VEC)
    for c in ("code", "times", "region", "mark", "rank", "_n"):
        table = table.withColumn(c, F.lit("mine"))
    asked = table.where("vec_id % 50 = 0")
    queries = [r for r in rows if r[0] is not None and r[0] % 50 == 0]
    for k in (1, 5):
        got = topk.search(table, asked, k)
        assert got.columns == ["query_id", "rank", "vec_id", "score"]
        assert sorted(map(tuple, got.collect())) == slow(rows, queries, k)
    assert topk.search(table.limit(0), asked).count() == 0 and topk.search(table, asked.limit(0)).count() == 0
    few = table.where("vec_id in (0, 50)")
    assert topk.search(few, few).count() == 3 + 2 * 1


def test_search_on_the_given_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").collect()
    table = spark.createDataFrame([(r.vec_id, r.embedding) for r in rows], "vec_id long, embedding array<float>")
    x, ids = np.array([r.embedding for r in rows], dtype=np.float32), np.array([r.vec_id for r in rows])
    got = topk.search(table, table.where("vec_id % 10 = 0"), 20).collect()
    assert sorted(map(tuple, got)) == fast(x, ids, np.flatnonzero(ids % 10 == 0), 20)

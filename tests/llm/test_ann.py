"""Nearest neighbours: recall on the given table, lists that grow with the rows, vectors of any size."""

from __future__ import annotations

import numpy as np
import pytest

from tabforge.llm import ann


def brute(x: np.ndarray, q: int, k: int) -> list[int]:
    y = ann.scaled(x.astype(float))
    y /= np.sqrt((y * y).sum(axis=1))[:, None]
    cos = y @ y[q]
    cos[q] = -2
    return np.lexsort((np.arange(len(y)), -np.round(cos, 12)))[:k].tolist()


def test_recall_on_the_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    rows = sorted(table.collect())
    x, ids = np.array([r.embedding for r in rows]), [r.vec_id for r in rows]
    got: dict = {}
    for r in ann.search(table, table.where("vec_id % 10 = 0")).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    y = x.astype(np.float64)
    norm = np.sqrt((y * y).sum(axis=1))
    hits = total = 0
    for n, q in enumerate(ids):
        if q % 10:
            continue
        found = sorted(got[q])
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        at = [ids.index(v) for _, v, _ in found]
        assert all(abs(s - (y[i] * y[n]).sum() / (norm[i] * norm[n])) < 1e-12 for i, (_, _, s) in zip(at, found))
        hits += len(set(at) & set(brute(x, n, 5)))
        total += 5
    assert total >= 1000 and hits >= 0.95 * total


def test_clustered_rows_need_few_lists(spark):
    """Lists grow with the square root of the rows, and calibration probes few of them where rows cluster."""
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(60, 16))
    x = (np.repeat(centres, 100, axis=0) + 0.15 * rng.normal(size=(6000, 16))).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    vectors = table.selectExpr("vec_id", "xxhash64(embedding) AS mark", "embedding", "double('inf') AS bound")
    index = ann.fit_index(x[::5].astype(float), len(x))
    assert len(index.centroids) == round(6000**0.5)
    probes = ann.calibrate(vectors, vectors.where("vec_id % 50 = 0"), index, 5)
    assert 1 <= probes <= len(index.centroids) // 4
    got: dict = {}
    for r in ann.search(table, table.where("vec_id % 50 = 0")).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len(got[q] & set(brute(x, q, 5))) for q in range(0, 6000, 50))
    assert hits >= 0.93 * 5 * 120


def test_candidates_travel_once(spark):
    """A block is not copied for chunks of queries: it travels once for up to ASKS of them."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 8))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    vectors = table.selectExpr("vec_id", "xxhash64(embedding) AS mark", "embedding", "double('inf') AS bound")
    index = ann.fit_index(x[::3], len(x))
    probes = len(index.centroids)
    plan = ann._search(vectors, vectors, index, probes, 5, True)  # every row is a query of every list
    text = plan._jdf.queryExecution().toString()
    assert "MapInArrow" in text
    listed = ann._listed(vectors, index, 0)
    assert listed.count() == 3000 and ann._listed(vectors, index, 1, 0, probes).count() == 3000 * probes
    assert -(-3000 // ann.ASKS) == 1  # so each candidate has one turn


@pytest.mark.parametrize("size", [1e200, 1e-200, 1.0])
def test_vectors_of_any_size(spark, size):
    x = np.random.default_rng(2).normal(size=(80, 6)) * size
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got: dict = {}
    for r in ann.search(table, table.where("vec_id % 20 = 0")).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for q in range(0, 80, 20):
        found = sorted(got[q])
        assert [v for _, v, _ in found] == brute(x, q, 5) and all(-1.0001 < s <= 1.0001 for _, _, s in found)


def test_scaling_keeps_cosines_to_the_last_bit():
    x = np.random.default_rng(3).normal(size=(50, 9)).astype(np.float32).astype(np.float64) * 37.0
    s = ann.scaled(x)
    cos = lambda m: (m * m[0]).sum(axis=1) / (np.sqrt((m * m).sum(axis=1)) * np.sqrt((m[0] * m[0]).sum()))
    assert (cos(x) == cos(s)).all() and (np.abs(s).max(axis=1) < 1).all()


def test_scan_finds_the_nearest_within_the_bound():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 40))
    x[100:300] = x[100]  # ties
    ids = rng.permutation(2000)[:900]
    index = ann.fit_index(x, len(x))
    block = ann.Block(x, ids, index.rotation)
    q, qids = x[:20].copy(), ids[:20].copy()
    q[3], qids[3] = x[100], ids[100]
    y = x / np.sqrt((x * x).sum(axis=1))[:, None]
    for adaptive in (False, True):
        for limit in (np.inf, 1.2):
            row, near, cos = block.scan(q, qids, 5, adaptive, np.full(20, limit))
            for j in range(20):
                unit = q[j] / np.sqrt((q[j] * q[j]).sum())
                own = np.round(y @ unit, 12)
                order = [i for i in np.lexsort((ids, -own)) if ids[i] != qids[j] and 2 - 2 * own[i] <= limit + 1e-9][:5]
                got = near[row == j].tolist()
                if adaptive:
                    assert len(set(got) & set(ids[order])) >= len(order) - 1
                else:
                    assert got[: len(order)] == ids[order].tolist()

"""The manifest against trees built level by level in plain Python."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.llm import merkle

DOC = "doc_id long, source string, lang string, n_chars long, text string"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOW = str.maketrans(UPPER, LOWER)


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row: tuple) -> str:
    doc_id, source, lang, n_chars, text = row
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def levels(nodes: list[str]) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def sides(tree: list[list[str]], i: int) -> list[tuple[str, str]]:
    out = []
    for level in tree[:-1]:
        start = i // 16 * 16
        out.append(("".join(level[start:i]), "".join(level[i + 1 : start + 16])))
        i //= 16
    return out


def slow(rows: list[tuple]) -> list[tuple]:
    by: dict = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    keys = sorted(by, key=lambda k: (k is not None, (k or "").encode()))
    trees = {}
    for k in keys:
        by[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[k] = levels([leaf(r) for r in by[k]])
    top = levels([trees[k][-1][0] for k in keys])
    out = []
    for n, k in enumerate(keys):
        for i, r in enumerate(by[k]):
            path = sides(trees[k], i) + sides(top, n)
            seen = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                seen = (*r[:4], r[4].translate(LOW))
            folded = leaf(seen)
            for a, b in path:
                folded = h(a + folded + b)
            root = top[-1][0]
            out.append((r[0], leaf(r), trees[k][-1][0], root, h("".join(a + b for a, b in path)), folded, folded == root))
    return out


def made(df, **more):
    low = F.translate("text", UPPER, LOWER)
    return merkle.manifest(df, tampered={"text": low}, tampered_where=F.crc32(F.col("doc_id").cast("string")) % 5 == 0, **more)


def ordered(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=lambda t: tuple(map(str, t)))


def test_places_are_a_van_emde_boas_order():
    for n in range(1, 5):
        at = merkle.places(n)
        assert [len(a) for a in at] == [16**d for d in range(n)]
        assert sorted(np.concatenate(at).tolist()) == list(range((16**n - 1) // 15))
    at = merkle.places(4)  # two upper levels first, then 256 subtrees of 1 + 16 nodes, each in one piece
    assert at[0][0] == 0 and at[1].tolist() == list(range(1, 17))
    for i in (0, 1, 100, 255):
        assert at[2][i] == 17 + 17 * i
        assert at[3][16 * i : 16 * i + 16].tolist() == list(range(at[2][i] + 1, at[2][i] + 17))


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 4095, 4096])
@pytest.mark.parametrize("whole", [True, False])
def test_a_block_holds_the_tree_of_its_leaves(n, whole):
    leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    height, nodes = merkle.plant(leaves, whole)
    want = levels([x.hex() for x in leaves])
    while not whole and len(want) < merkle.HEIGHT + 1:
        want.append([h(want[-1][0])])
    assert height == len(want) - 1 and nodes[:32].hex() == want[-1][0]
    climber = merkle.Climber(n, height, nodes)
    for i in {0, n // 2, n - 1}:
        assert climber.path(i) == sides(want, i)
        assert merkle.fold(leaves[i].hex(), climber.path(i)) == want[-1][0]


def test_manifest_matches_plain_trees(spark):
    """A source of three blocks and over 4,096 sources (two rounds of either tree), nulls, repeated rows and ids."""
    rows = [
        (i if i % 1000 else None, "hot" if i < 9000 else f"s{i}", "en" if i % 3 == 0 else None, i % 7 or None,
         None if i % 11 == 0 else "" if i % 13 == 0 else f"Text É {i} İ")
        for i in range(13_200)
    ]
    rows += rows[:40] + [(1, None, "x", 1, "A"), (1, "", "x", 1, "A"), (2, None, "x", 1, "Long " * 100_000)]
    found = made(spark.createDataFrame(rows, DOC).repartition(5))
    assert ordered(merkle.prove(found).collect()) == ordered(slow(rows))
    table = found.table().groupBy("part", "round").agg(F.count("*").alias("n"), F.sum("n").alias("leaves")).collect()
    sizes = {(r.part, r["round"]): (r.n, r.leaves) for r in table}
    n_keys = len({r[1] for r in rows})
    assert sizes == {("key", 0): (3 + n_keys - 1, len(rows)), ("key", 1): (1, 3), ("top", 0): (2, n_keys), ("top", 1): (1, 2)}


@pytest.mark.parametrize("n", [0, 1, 2, 17])
def test_small_datasets(spark, n):
    rows = [(i, "a" if i else None, None, None, f"T{i}") for i in range(n)]
    got = merkle.prove(made(spark.createDataFrame(rows, DOC)))
    assert ordered(got.collect()) == (ordered(slow(rows)) if n else [])
    assert got.columns == ["doc_id", *merkle.RESULTS]


def test_own_columns_and_paths(spark):
    """Own columns named like helpers or results: kept ones come back, but results win."""
    rows = [(i, "a", None, None, "Tt") for i in range(20)]
    df = spark.createDataFrame(rows, DOC)
    for c in ("key", "idx", "digest", "leaf", "own", "block", "_one", "_range", "id", "root", "tree"):
        df = df.withColumn(c, F.lit(f"my {c}"))
    out = merkle.prove(made(df, keep=("key", "idx", "leaf", "own", "_range", "id")), with_paths=True)
    assert out.columns == ["doc_id", "key", "idx", "own", "_range", "id", *merkle.RESULTS, "path"]
    for r in out.collect():
        path = [(s["left"], s["right"]) for s in r.path]
        assert (r.key, r.idx, r.own, r["_range"], r.id) == ("my key", "my idx", "my own", "my _range", "my id")
        assert merkle.fold(r.leaf, path) == r.root and h("".join(a + b for a, b in path)) == r.proof_sha256
    assert ordered(out.select("doc_id", *merkle.RESULTS).collect()) == ordered(slow(rows))


def test_any_partitioning_gives_the_same_root(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert len({made(docs.repartition(n)).root for n in (1, 3, 9)}) == 1

"""Merkle manifest of a dataset, its subtrees stored in a van Emde Boas layout.

Each row is a leaf; the leaves of a key (a source) are numbered by id, every ARITY
consecutive nodes of a level have one parent, and the keys' roots, in the order of the
keys, are the leaves of the top tree.

A key's tree is stored as aligned subtrees ("blocks") of HEIGHT levels of hashing: block b
holds the leaves b * SPAN to (b + 1) * SPAN - 1 and all above them, as one string of
32-byte digests.  In it the digests lie in the van Emde Boas order: the tree is cut at half
its height, first the upper half, then the lower subtrees from left to right, each laid out
the same way.  ``places`` is that address arithmetic; it serves the construction and the
retrieval of siblings.  The roots of a key's blocks are the leaves of the next round, until
one block is left.  The top tree over the keys is built the same way.

A key with a third of all rows is many blocks, each one group of a task with at most SPAN
rows.  Only digests, ids and keys are shuffled; texts are hashed where they are read.
Nothing but the one root comes to the driver.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.llm.common import settle
from tabforge.plans.prefix import dense_index

#: Children of a node, and levels of hashing in a stored block.
ARITY, HEIGHT = 16, 3
#: Leaves of a block.
SPAN = ARITY**HEIGHT
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
RESULTS = ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
PATH = "array<struct<left: string, right: string>>"


def _size(levels: int) -> int:
    return (ARITY**levels - 1) // (ARITY - 1)


@lru_cache(maxsize=16)
def places(levels: int) -> tuple[np.ndarray, ...]:
    """By depth, the address of each node of a complete tree with that many levels of nodes."""
    if levels == 1:
        return (np.zeros(1, dtype=np.int64),)
    half = levels // 2
    upper, lower = places(half), places(levels - half)
    starts = _size(half) + _size(levels - half) * np.arange(ARITY**half, dtype=np.int64)
    return upper + tuple((starts[:, None] + at).ravel() for at in lower)


def widths(n: int, height: int) -> list[int]:
    """Nodes at each depth of a block with ``n`` leaves, root first."""
    out = [n]
    for _ in range(height):
        out.append(-(-out[-1] // ARITY))
    return out[::-1]


def plant(leaves: list[bytes], whole: bool) -> tuple[int, bytes]:
    """(height, digests in van Emde Boas order) of a block.  A block that is its key's only one
    ends where one node remains; any other has all HEIGHT levels, however few its leaves."""
    height = HEIGHT
    while whole and height and ARITY ** (height - 1) >= len(leaves):
        height -= 1
    at, n = places(height + 1), widths(len(leaves), height)
    nodes = np.zeros((max(int(a[:k].max()) for a, k in zip(at, n)) + 1, 32), dtype=np.uint8)
    nodes[at[height][: n[height]]] = np.frombuffer(b"".join(leaves), dtype=np.uint8).reshape(-1, 32)
    for depth in range(height, 0, -1):
        for i in range(n[depth - 1]):
            kids = nodes[at[depth][ARITY * i : min(ARITY * (i + 1), n[depth])]]
            parent = hashlib.sha256(kids.tobytes().hex().encode()).digest()
            nodes[at[depth - 1][i]] = np.frombuffer(parent, dtype=np.uint8)
    return height, nodes.tobytes()


class Climber:
    """Siblings on the way from a leaf of a stored block to its root."""

    def __init__(self, n: int, height: int, tree: bytes):
        self.at, self.n, self.height, self.hex = places(height + 1), widths(n, height), height, tree.hex()
        self.known: dict[tuple[int, int], tuple[str, str]] = {}

    def _digests(self, depth: int, first: int, last: int) -> str:
        return "".join([self.hex[64 * a : 64 * a + 64] for a in self.at[depth][first:last].tolist()])

    def step(self, depth: int, i: int) -> tuple[str, str]:
        """Digests to the left and to the right of node i in its run, joined."""
        if (depth, i) not in self.known:
            start = i - i % ARITY
            stop = min(start + ARITY, self.n[depth])
            self.known[depth, i] = self._digests(depth, start, i), self._digests(depth, i + 1, stop)
        return self.known[depth, i]

    def path(self, slot: int) -> list[tuple[str, str]]:
        return [self.step(d, slot // ARITY ** (self.height - d)) for d in range(self.height, 0, -1)]


def fold(leaf: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings give."""
    for left, right in path:
        leaf = hashlib.sha256((left + leaf + right).encode()).hexdigest()
    return leaf


def leaf_digest(values: list[Column]) -> Column:
    """Hex sha256 of the values: ``-`` if null, else UTF-8 byte count, ``:``, value."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def _blocks_of(level: DataFrame, round_no: int) -> DataFrame:
    """(key, idx, total, digest) -> one row per block: key, round, block, total, n, height, tree."""
    kind = level.schema["key"].dataType
    schema = T.StructType([T.StructField("key", kind), *T.StructType.fromDDL(
        "round int, block long, total long, n int, height int, tree binary").fields])

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("idx")
        total = rows.column("total")[0].as_py()
        height, tree = plant(rows.column("digest").to_pylist(), total <= SPAN)
        first = rows.slice(0, 1)
        return pa.table(
            {
                "key": first.column("key"),
                "round": pa.array([round_no], pa.int32()),
                "block": first.column("block"),
                "total": first.column("total"),
                "n": pa.array([rows.num_rows], pa.int32()),
                "height": pa.array([height], pa.int32()),
                "tree": pa.array([tree], pa.binary()),
            }
        )

    cut = level.select("key", "idx", "total", "digest", F.floor(F.col("idx") / SPAN).alias("block"))
    return cut.groupBy("key", "block").applyInArrow(run, schema)


def _root(tree: str = "tree") -> Column:
    return F.substring(F.col(tree), 1, 32)


def grow(level: DataFrame) -> list[DataFrame]:
    """The blocks of each round over the leaves (key, idx, total, digest), lowest round first."""
    rounds: list[DataFrame] = []
    while True:
        rounds.append(settle(_blocks_of(level, len(rounds))))
        more = rounds[-1].where(F.col("total") > SPAN)
        if not more.take(1):
            return rounds
        level = more.select("key", F.col("block").alias("idx"), F.ceil(F.col("total") / SPAN).alias("total"), _root().alias("digest"))


def _roots(rounds: list[DataFrame]) -> DataFrame:
    """(key, digest): the root of each key."""
    out = None
    for blocks in rounds:
        own = blocks.where(F.col("total") <= SPAN).select("key", _root().alias("digest"))
        out = own if out is None else out.unionAll(own)
    return out


def _child_paths(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """Path from each leaf of the blocks to the root: key, idx, path; ``paths`` has those of the blocks."""
    schema = T.StructType([blocks.schema["key"], *T.StructType.fromDDL(f"idx long, path {PATH}").fields])
    onto = paths.select(F.col("key").alias("_key"), F.col("idx").alias("_idx"), "path")
    met = blocks.join(onto, blocks["key"].eqNullSafe(onto["_key"]) & (blocks["block"] == onto["_idx"]))

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                one = batch.slice(r, 1)
                n, block = one.column("n")[0].as_py(), one.column("block")[0].as_py()
                climber = Climber(n, one.column("height")[0].as_py(), one.column("tree")[0].as_py())
                above = [(s["left"], s["right"]) for s in one.column("path")[0].as_py()]
                for a in range(0, n, 256):  # few paths at once
                    slots = range(a, min(a + 256, n))
                    found = [[dict(zip(("left", "right"), s)) for s in climber.path(i) + above] for i in slots]
                    yield pa.RecordBatch.from_arrays(
                        [one.column("key").take(pa.array([0] * len(found))), pa.array([block * SPAN + i for i in slots]), pa.array(found, _PATH_TYPE)],
                        names=["key", "idx", "path"],
                    )

    return met.select("key", "block", "n", "height", "tree", "path").mapInArrow(run, schema)


_PATH_TYPE = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


@dataclass
class Manifest:
    """Leaves and stored blocks of a dataset.

    ``leaves``: key, idx, total, id, leaf, changed (the tampered leaf or null), own (kept columns);
    ``rounds`` and ``top``: blocks of the keys' trees and of the tree over the keys, by round;
    ``subroots``: key, idx, digest; ``root``: hex digest, None for an empty dataset."""

    leaves: DataFrame
    rounds: list[DataFrame]
    top: list[DataFrame]
    subroots: DataFrame | None
    root: str | None

    def table(self) -> DataFrame:
        """All stored blocks as one table: part (``key`` or ``top``), key as text, round, block, total, n, height, tree."""
        out = None
        for part, rounds in (("key", self.rounds), ("top", self.top)):
            for blocks in rounds:
                key = F.col("key").cast("string") if part == "key" else F.lit(None).cast("string")
                named = blocks.select(F.lit(part).alias("part"), key.alias("key"), "round", "block", "total", "n", "height", "tree")
                out = named if out is None else out.unionAll(named)
        return out


def manifest(
    docs: DataFrame,
    columns: tuple[str, ...] = COLUMNS,
    id_col: str = "doc_id",
    key_col: str = "source",
    tampered: dict[str, Column] | None = None,
    tampered_where: Column | None = None,
    keep: tuple[str, ...] = (),
) -> Manifest:
    """The manifest of ``docs`` over ``columns``.

    Leaves of a key ascend by id (null first); rows that share an id follow in the order of
    their leaf digests, and equal rows are leaves of their own.  The null key is a key, before
    all others.  ``tampered`` gives other values of some columns, for rows where
    ``tampered_where`` holds; they never enter the manifest.  Columns not named take no part."""
    leaf = leaf_digest([F.col(c) for c in columns])
    other = leaf_digest([(tampered or {}).get(c, F.col(c)) for c in columns])
    where = F.lit(False) if tampered_where is None else F.coalesce(tampered_where, F.lit(False))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(key_col).alias("key"),
        F.unhex(leaf).alias("digest"),
        F.when(where, F.unhex(other)).alias("changed"),
        F.struct(F.lit(None).cast("int").alias("_"), *[F.col(c) for c in keep]).alias("own"),
    )
    leaves = settle(dense_index(rows, "id", ["key"], into="idx", tiebreak=["digest"], total="total"))
    rounds = grow(leaves)
    subroots = settle(dense_index(_roots(rounds), "key", into="idx", total="total"))
    if not subroots.take(1):
        return Manifest(leaves, rounds, [], None, None)
    top = grow(subroots.select(F.lit(0).alias("key"), "idx", "total", "digest"))
    root = _roots(top).select(F.lower(F.hex("digest"))).first()[0]
    return Manifest(leaves, rounds, top, subroots, root)


def _leaf_paths(made: Manifest) -> DataFrame:
    """The lowest blocks with the path of their roots: key, block, n, height, tree, path, subroot."""
    level = made.subroots.sparkSession.createDataFrame([(0, 0, [])], f"key int, idx long, path {PATH}")
    for blocks in reversed(made.top):
        level = _child_paths(blocks, level)
    onto = level.select(F.col("idx").alias("_at"), "path")
    tops = settle(made.subroots.join(onto, F.col("idx") == F.col("_at")).select("key", "path", F.lower(F.hex("digest")).alias("subroot")))
    paths = None
    for r in range(len(made.rounds) - 1, -1, -1):
        blocks = made.rounds[r]
        whole = blocks.where(F.col("total") <= SPAN).select(F.col("key").alias("_key"))
        own = tops.join(whole, tops["key"].eqNullSafe(F.col("_key"))).select("key", F.lit(0).cast("long").alias("idx"), "path")
        paths = own if paths is None else paths.unionAll(own)
        if r:
            paths = settle(_child_paths(blocks, paths))
    lowest = made.rounds[0]
    onto = paths.select(F.col("key").alias("_key"), F.col("idx").alias("_idx"), "path")
    met = lowest.join(onto, lowest["key"].eqNullSafe(onto["_key"]) & (lowest["block"] == onto["_idx"])).drop("_key", "_idx")
    named = tops.select(F.col("key").alias("_key"), "subroot")
    return met.join(named, met["key"].eqNullSafe(named["_key"])).select("key", "block", "n", "height", "tree", "path", "subroot")


def prove(made: Manifest, id_col: str = "doc_id", with_paths: bool = False) -> DataFrame:
    """Each leaf's proof and its check: the id, kept columns, leaf, subroot, root, proof_sha256,
    folded_root, verified, and with ``with_paths`` the siblings themselves (``path``, from the
    leaf up).  A tampered leaf is folded in place of its own.  An empty dataset: no rows."""
    own = [f.name for f in made.leaves.schema["own"].dataType.fields][1:]
    own = [c for c in own if c not in RESULTS and c not in (id_col, "path")]
    more = "leaf string, subroot string, proof_sha256 string, folded_root string" + f", path {PATH}" * with_paths
    carried = ["id", "own"]
    schema = T.StructType([*[made.leaves.schema[c] for c in carried], *T.StructType.fromDDL(more).fields])
    root = F.lit(made.root).cast("string")

    if made.root is None:
        empty = made.leaves.where(F.lit(False)).select(*carried, *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields[2:]])
        found = empty
    else:

        def run(rows: pa.Table, block: pa.Table) -> pa.Table:
            rows = rows.combine_chunks()
            above = [(s["left"], s["right"]) for s in block.column("path")[0].as_py()]
            climber = Climber(*[block.column(c)[0].as_py() for c in ("n", "height", "tree")])
            leaf, proof, folded, paths = [], [], [], []
            for i, digest, changed in zip(*[rows.column(c).to_pylist() for c in ("idx", "digest", "changed")]):
                path = climber.path(i % SPAN) + above
                leaf.append(digest.hex())
                proof.append(hashlib.sha256("".join([a + b for a, b in path]).encode()).hexdigest())
                folded.append(fold((changed or digest).hex(), path))
                if with_paths:
                    paths.append([{"left": a, "right": b} for a, b in path])
            subroot = [block.column("subroot")[0].as_py()] * len(leaf)
            cols = {c: rows.column(c) for c in carried}
            cols |= {"leaf": leaf, "subroot": subroot, "proof_sha256": proof, "folded_root": folded}
            cols |= {"path": pa.array(paths, _PATH_TYPE)} if with_paths else {}
            return pa.table(cols)

        leaves = made.leaves.withColumn("block", F.floor(F.col("idx") / SPAN))
        leaves = leaves.select("key", "block", "idx", "digest", "changed", *carried)
        blocks = _leaf_paths(made)
        found = leaves.groupBy("key", "block").cogroup(blocks.groupBy("key", "block")).applyInArrow(run, schema)
    return found.select(
        F.col("id").alias(id_col),
        *[F.col(f"own.`{c}`") for c in own],
        "leaf",
        "subroot",
        root.alias("root"),
        "proof_sha256",
        "folded_root",
        F.col("folded_root").eqNullSafe(root).alias("verified"),
        *(["path"] if with_paths else []),
    )

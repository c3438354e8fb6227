"""Boosted trees that take missing values and categories as they are (M3, M4, M5).

Features are binned once: bin 0 is "missing" (NULL, NaN, a category not seen in training),
numbers get bins between quantile cuts, categories one bin each.  Each split sends a set of
bins to the left, so missing rows go to the side where they gain more, and categories split
by sets in the order of their gradients; nothing is imputed and there is no sentinel.

One level of a tree is one job: every task adds up the gradients of its rows by (node,
feature, bin), an aggregate adds the tasks' sums, and the driver, which sees nodes x features
x bins numbers and no rows, picks the splits.  Rows carry their bins, label and margin; the margin
is brought up to date by a checkpoint every few trees, so a lost executor replays at most those.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.operators.features import quoted
from tabforge.operators.metrics import value_counts_top
from tabforge.plans.joins import materialise

#: Bins of a feature that a node's table has room for; bin 0 is "missing".
ROOM = 256


@dataclass
class TreeParams:
    """Learning rate, rounds, depth; ``max_bins`` values a feature (the rest of a category column
    counts as missing); regularisation, and the least rows and hessian of a side."""

    learning_rate: float = 0.1
    n_trees: int = 50
    max_depth: int = 6
    max_bins: int = 64
    l2: float = 1.0
    cat_smooth: float = 10.0
    min_rows: int = 20
    min_hessian: float = 1e-3
    min_gain: float = 1e-6
    checkpoint_every: int = 10


@dataclass
class Binning:
    """Cuts of the numeric columns (bin i + 1 holds values up to cut i) and values of the categories."""

    num: list[str]
    cat: list[str]
    cuts: dict[str, np.ndarray]
    values: dict[str, list[str]]

    @property
    def names(self) -> list[str]:
        return [*self.num, *self.cat]

    def columns(self) -> list:
        """The features of a table: numbers as double, categories as text, in order."""
        nums = [F.col(quoted(c)).cast("double").alias(f"_x{i}") for i, c in enumerate(self.num)]
        return nums + [F.col(quoted(c)).cast("string").alias(f"_x{len(self.num) + i}") for i, c in enumerate(self.cat)]

    def bins(self, batch: pa.RecordBatch) -> np.ndarray:
        """(rows, features) of bin numbers."""
        out = np.zeros((batch.num_rows, len(self.names)), dtype=np.uint8)
        for j, name in enumerate(self.names):
            col = batch.column(f"_x{j}")
            if name in self.cuts and j < len(self.num):
                x = col.to_numpy(zero_copy_only=False).astype(np.float64)  # NULL is NaN
                out[:, j] = np.where(np.isnan(x), 0, np.searchsorted(self.cuts[name], x, side="left") + 1)
            elif self.values[name]:
                at = pc.index_in(col, pa.array(self.values[name], col.type))
                out[:, j] = pc.fill_null(at, -1).to_numpy(zero_copy_only=False) + 1
        return out


def fit_binning(df: DataFrame, num: list[str], cat: list[str], max_bins: int = 64) -> Binning:
    """Cuts and categories: columns with up to ``max_bins`` distinct numbers are cut at each of
    them, others at quantiles (one aggregate of sketches); the ``max_bins`` most frequent values of a category."""
    max_bins = min(max_bins, ROOM - 2)
    cuts: dict[str, np.ndarray] = {}
    if num:
        at = F.array(*[F.lit((i + 1) / max_bins) for i in range(max_bins)])
        x = {c: F.nanvl(F.col(quoted(c)).cast("double"), F.lit(None).cast("double")) for c in num}
        aggs = [a for i, c in enumerate(num) for a in (F.approx_count_distinct(x[c]).alias(f"n{i}"), F.percentile_approx(x[c], at, 10_000).alias(f"q{i}"))]
        row = df.agg(*aggs).first()
        for i, c in enumerate(num):
            found = row[f"q{i}"] or []
            if row[f"n{i}"] <= max_bins:
                few = df.select(x[c].alias("x")).where("x is not null").distinct().limit(2 * max_bins).collect()
                found = [r.x for r in few] if len(few) <= max_bins else found
            cuts[c] = np.unique(np.array(found, dtype=np.float64))[:-1]  # everything is up to the last
    values = {}
    for c in cat:
        text = df.select(F.col(quoted(c)).cast("string").alias("v")).where("v is not null")
        values[c] = [r.v for r in value_counts_top(text, "v", max_bins).collect()]
    return Binning(list(num), list(cat), cuts, values)


@dataclass
class Tree:
    """Nodes in heap order: the feature that splits a node (-1: a leaf), the bins that go left, the leaf's value."""

    feature: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @staticmethod
    def empty(depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return Tree(np.full(n, -1), np.zeros((n, ROOM), dtype=bool), np.zeros(n), np.zeros(n))

    def node_of(self, bins: np.ndarray) -> np.ndarray:
        """Leaf (so far) of each row."""
        node, rows = np.zeros(len(bins), dtype=np.int64), np.arange(len(bins))
        for _ in range(int(math.log2(len(self.feature) + 1))):
            feature = self.feature[node]
            goes = self.left[node, bins[rows, np.maximum(feature, 0)]]
            node = np.where(feature >= 0, 2 * node + 2 - goes, node)
        return node


@dataclass
class BoostedModel:
    binning: Binning
    base: float
    trees: list[Tree] = field(default_factory=list)

    def margin(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.base)
        for tree in self.trees:
            out += tree.value[tree.node_of(bins)]
        return out

    def nodes(self) -> list[dict]:
        """Every split in readable form: tree, node, feature, what goes left, missing_left, gain."""
        out = []
        for t, tree in enumerate(self.trees):
            for node in np.flatnonzero(tree.feature >= 0):
                name = self.binning.names[tree.feature[node]]
                bins = np.flatnonzero(tree.left[node])
                told = describe(self.binning, int(tree.feature[node]), bins)
                out.append({"tree": t, "node": int(node), "feature": name, **told, "gain": float(tree.gain[node])})
        return out


def describe(binning: Binning, feature: int, bins: np.ndarray) -> dict:
    """A set of bins as ``up_to`` (numbers) or ``values`` (categories), and whether missing is in it."""
    name, inside = binning.names[feature], [int(b) for b in bins if b > 0]
    told: dict = {"missing_left": 0 in bins, "up_to": None, "values": None}
    if feature < len(binning.num):
        if inside:
            last = max(inside)
            told["up_to"] = float(binning.cuts[name][last - 1]) if last <= len(binning.cuts[name]) else math.inf
    else:
        told["values"] = sorted(binning.values[name][b - 1] for b in inside)
    return told


# ---------------------------------------------------------------- splits


def best_split(n: np.ndarray, g: np.ndarray, h: np.ndarray, numeric: bool, p: TreeParams) -> tuple[float, np.ndarray] | None:
    """(gain, bins that go left) of one feature in one node from its sums by bin; None without
    a split that both sides allow.  Of equal gains the first counts: missing right before
    left, then fewer bins left."""
    there = np.flatnonzero(n[1:] > 0) + 1
    if not numeric:
        there = there[np.argsort(g[there] / (h[there] + p.cat_smooth), kind="stable")]
    total_g, total_h, total_n = g.sum(), h.sum(), n.sum()
    whole = total_g**2 / (total_h + p.l2)
    best: tuple[float, np.ndarray] | None = None
    for missing in (False, True) if n[0] else (False,):
        order = np.concatenate([[0], there]) if missing else there
        left_n, left_g, left_h = np.cumsum(n[order]), np.cumsum(g[order]), np.cumsum(h[order])
        right_n, right_g, right_h = total_n - left_n, total_g - left_g, total_h - left_h
        gain = left_g**2 / (left_h + p.l2) + right_g**2 / (np.maximum(right_h, 0) + p.l2) - whole
        fits = (left_n >= p.min_rows) & (right_n >= p.min_rows) & (left_h >= p.min_hessian) & (right_h >= p.min_hessian) & (right_n > 0)
        gain = np.where(fits, gain, -np.inf)
        if len(gain) and gain.max() > -np.inf:
            at = int(np.argmax(gain >= gain.max() - 1e-9 * abs(gain.max())))
            if best is None or gain[at] > best[0] + 1e-9 * abs(best[0]):
                best = float(gain[at]), order[: at + 1]
    if best is not None and numeric and best[1].max() > 0:  # numbers that no row here has go by the cut
        upto = np.arange(1, best[1].max() + 1)
        best = best[0], np.concatenate([[0], upto]) if best[1][0] == 0 else upto
    return best


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1)
    return bins, batch.column("label").to_numpy(), batch.column("margin").to_numpy()


def _sums(data: DataFrame, pending: list[Tree], tree: Tree, nodes: list[int], width: int) -> np.ndarray:
    """(node, feature, bin, 3): rows, gradients and hessians of each bin in each of ``nodes``."""
    slot = np.full(len(tree.feature), -1)
    slot[nodes] = np.arange(len(nodes))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, len(nodes) * width * ROOM))
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, label, margin = _rows(batch)
            margin = margin.copy()
            for done in pending:
                margin += done.value[done.node_of(bins)]
            p = _sigmoid(margin)
            at = slot[tree.node_of(bins)]
            here = at >= 0
            bins, at, p, label = bins[here], at[here], p[here], label[here]
            cell = ((at[:, None] * width + np.arange(width)) * ROOM + bins).ravel()
            for k, w in enumerate((np.ones(len(p)), p - label, p * (1 - p))):
                total[k] += np.bincount(cell, np.repeat(w, width), minlength=total.shape[1])
        found = np.flatnonzero(total[0])
        cols = [pa.array(found), *[pa.array(total[k][found]) for k in range(3)]]
        yield pa.RecordBatch.from_arrays(cols, names=["cell", "n", "g", "h"])

    parts = data.mapInArrow(run, "cell long, n double, g double, h double")
    sums = parts.groupBy("cell").agg(F.sum("n"), F.sum("g"), F.sum("h")).collect()  # nodes x features x bins at most
    out = np.zeros((len(nodes) * width * ROOM, 3))
    if sums:
        out[[r[0] for r in sums]] = [r[1:] for r in sums]
    return out.reshape(len(nodes), width, ROOM, 3)


def _grow(data: DataFrame, pending: list[Tree], binning: Binning, p: TreeParams) -> Tree:
    """One tree, a level at a time."""
    tree, nodes = Tree.empty(p.max_depth), [0]
    for depth in range(p.max_depth):
        sums = _sums(data, pending, tree, nodes, len(binning.names))
        after = []
        for node, cells in zip(nodes, sums):
            best, at = None, -1
            for j in range(len(binning.names)):
                found = best_split(*cells[j].T, j < len(binning.num), p)
                if found and (best is None or found[0] > best[0] + 1e-9 * abs(best[0])):
                    best, at = found, j
            n, g, h = cells[0].sum(axis=0)
            if not depth:
                tree.value[0] = -p.learning_rate * g / (h + p.l2)
            if best is None or best[0] <= p.min_gain:
                continue
            tree.feature[node], tree.gain[node] = at, best[0]
            tree.left[node, best[1]] = True
            left = cells[at][best[1]].sum(axis=0)
            for child, (m, a, b) in ((2 * node + 1, left), (2 * node + 2, (n, g, h) - left)):
                tree.value[child] = -p.learning_rate * a / (b + p.l2)
                if m >= 2 * p.min_rows:
                    after.append(child)
        nodes = after
        if not nodes:
            break
    return tree


def binned(df: DataFrame, binning: Binning, label: str, base: float) -> DataFrame:
    """(bins, label, margin) of the rows with a label: one byte a feature."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r.tobytes() for r in binning.bins(batch)]
            margin = np.full(batch.num_rows, base)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), batch.column("_y"), pa.array(margin)], names=["bins", "label", "margin"])

    rows = df.where(F.col(quoted(label)).isNotNull()).select(*binning.columns(), F.col(quoted(label)).cast("double").alias("_y"))
    return rows.mapInArrow(run, "bins binary, label double, margin double")


def _advanced(data: DataFrame, trees: list[Tree]) -> DataFrame:
    """The rows with the margins that ``trees`` add."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bins, _, margin = _rows(batch)
                margin = margin + sum(t.value[t.node_of(bins)] for t in trees)
                yield pa.RecordBatch.from_arrays([batch.column("bins"), batch.column("label"), pa.array(margin)], names=["bins", "label", "margin"])

    return data.mapInArrow(run, data.schema)


def train_boosted(df: DataFrame, num: list[str], cat: list[str], label: str, params: TreeParams | None = None) -> BoostedModel:
    """Boosted trees for a 0/1 ``label`` by second-order gradients of the log loss (M4).

    Rows without a label take no part.  Numbers may be NULL or NaN, categories NULL.  A
    column without any value, or a table of one class or none, gives the base rate."""
    p = params or TreeParams()
    if len(set([*num, *cat])) != len(num) + len(cat) or not num and not cat:
        raise ValueError("features must be named, and each once")
    seen = df.where(F.col(quoted(label)).isNotNull())
    rate = seen.agg(F.avg(F.col(quoted(label)).cast("double"))).first()[0]
    rate = min(max(rate if rate is not None else 0.5, 1e-6), 1 - 1e-6)
    model = BoostedModel(fit_binning(seen, num, cat, p.max_bins), math.log(rate / (1 - rate)))
    data, pending = materialise(binned(df, model.binning, label, model.base)), []
    for t in range(p.n_trees):
        tree = _grow(data, pending, model.binning, p)
        if tree.feature[0] < 0:  # no split gains any more
            break
        model.trees.append(tree)
        pending.append(tree)
        if len(pending) >= p.checkpoint_every and t + 1 < p.n_trees:
            data, pending = materialise(_advanced(data, pending)), []
    return model


def split_report(df: DataFrame, num: list[str], cat: list[str], label: str, params: TreeParams | None = None) -> list[dict]:
    """The best first split of every feature: feature, gain, n_left, missing_left, up_to or values."""
    p = params or TreeParams()
    seen = df.where(F.col(quoted(label)).isNotNull())
    rate = seen.agg(F.avg(F.col(quoted(label)).cast("double"))).first()[0]
    binning = fit_binning(seen, num, cat, p.max_bins)
    data = binned(df, binning, label, math.log(rate / (1 - rate)))
    (sums,) = _sums(data, [], Tree.empty(1), [0], len(binning.names))
    out = []
    for j, name in enumerate(binning.names):
        found = best_split(*sums[j].T, j < len(num), p)
        if found:
            told = describe(binning, j, found[1])
            out.append({"feature": name, "gain": found[0], "n_left": int(sums[j][found[1], 0].sum()), **told})
    return out


def score_boosted(df: DataFrame, model: BoostedModel, keep: list[str] | None = None) -> DataFrame:
    """``probability`` of class 1 and ``prediction`` for every row (M5); a narrow map, also over a stream.

    ``keep`` names the columns that stay (default: all); own columns named like the results are replaced."""
    own = [c for c in (keep if keep is not None else df.columns) if c not in ("probability", "prediction")]
    rows = df.select(F.struct(F.lit(0).alias("_"), *[F.col(quoted(c)) for c in own]).alias("own"), *model.binning.columns())
    schema = T.StructType([rows.schema["own"], T.StructField("probability", T.DoubleType()), T.StructField("prediction", T.IntegerType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _sigmoid(model.margin(model.binning.bins(batch)))
            cols = [batch.column("own"), pa.array(p), pa.array((p > 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, names=["own", "probability", "prediction"])

    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col(f"own.`{c}`") for c in own], "probability", "prediction")

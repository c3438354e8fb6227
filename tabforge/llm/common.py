"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabforge.session import ensure_checkpoint_dir

#: White space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"
#: Text bytes that a task works on at once (Python side memory stays near a small multiple of it).
CHUNK_BYTES = 2 << 20


def settle(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fold_of(id_col: Column) -> Column:
    """crc32 of the id written as text, mod 5; a null id has no fold."""
    return F.crc32(id_col.cast("string")) % 5


def held_out(id_col: Column) -> Column:
    """True where the fold is 0; null ids are never held out."""
    return F.coalesce(fold_of(id_col) == 0, F.lit(False))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or one with underscores after it that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about ``limit`` bytes (one longer text is a slice of its own)."""
    if batch.num_rows == 0:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    part = (np.cumsum(sizes) - sizes) // limit
    starts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [batch.num_rows]])
    for a, b in zip(starts[:-1], starts[1:]):
        yield batch.slice(int(a), int(b - a))


def plus(schema: StructType, **types: str) -> StructType:
    """A schema with further columns, by name and type."""
    more = StructType.fromDDL(", ".join(f"`{k}` {v}" for k, v in types.items()))
    return StructType([*schema.fields, *more.fields])


def map_texts(df: DataFrame, fn, schema: StructType | str, column: str = "text") -> DataFrame:
    """``fn(record batch) -> record batch`` over bounded slices of each partition."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_chunks(batch, column):
                yield fn(part)

    return df.mapInArrow(run, schema)


def complete_runs(
    batches: Iterable[pa.RecordBatch], keys: list[str], read
) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
    """Blocks of whole groups from a partition sorted by ``keys``.

    ``read(batch)`` gives one numpy array per column.  Yields (arrays, bounds)
    with group g at rows bounds[g]:bounds[g+1]; a group that goes on in the
    next batch is held back, so no group is ever cut."""
    held: dict[str, np.ndarray] | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        cols = read(batch)
        if held is not None:
            cols = {k: np.concatenate([held[k], v]) for k, v in cols.items()}
        n = len(cols[keys[0]])
        change = np.zeros(n, dtype=bool)
        change[0] = True
        for k in keys:
            change[1:] |= cols[k][1:] != cols[k][:-1]
        starts = np.flatnonzero(change)
        last = starts[-1]
        if last > 0:
            yield {k: v[:last] for k, v in cols.items()}, starts
        held = {k: v[last:] for k, v in cols.items()}
    if held is not None:
        yield held, np.array([0, len(held[keys[0]])])


def split_buckets(df: DataFrame, keys: list[str], row_id: str, limit: int, keyed: DataFrame | None = None) -> DataFrame:
    """Deal the rows of each bucket (equal ``keys``) into comparison cells.

    A bucket of at most ``limit`` rows is one cell.  A larger one is cut by a
    hash of ``row_id`` into chunks of about ``limit`` rows and every pair of
    chunks becomes a cell, so any two rows of a bucket meet in a cell while no
    cell holds more than about two chunks.  Adds ``chunk`` (the row's own),
    ``cell_a`` and ``cell_b`` (the cell's two chunks).  ``keyed`` has the keys of all rows, if they
    are cheaper to count than ``df``."""
    hot = settle((df if keyed is None else keyed).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit))
    if not hot.take(1):
        zero = F.lit(0)
        return df.select("*", zero.alias("chunk"), zero.alias("cell_a"), zero.alias("cell_b"))
    parts = F.coalesce(F.ceil(F.col("_n") / F.lit(limit)).cast("int"), F.lit(1))
    dealt = (
        df.join(hot, keys, "left")
        .withColumn("_parts", parts)
        .withColumn("chunk", F.pmod(F.xxhash64(F.lit(17), F.col(row_id)), F.col("_parts")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    )
    return dealt.select(
        *df.columns,
        "chunk",
        F.least("chunk", "_other").alias("cell_a"),
        F.greatest("chunk", "_other").alias("cell_b"),
    )


class LocalSets:
    """Union-find over the rows of one cell."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join the sets of a[i] and b[i], by minimum labels until nothing moves."""
        up = self.up
        while True:
            x, y = up[a], up[b]
            low = np.minimum(x, y)
            if (x == y).all():
                return
            np.minimum.at(up, x, low)
            np.minimum.at(up, y, low)
            while True:
                jumped = up[up]
                if (jumped == up).all():
                    break
                up[:] = jumped

    def labels(self) -> np.ndarray:
        return self.up

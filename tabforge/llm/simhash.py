"""SimHash near-duplicates through Golay-code fuzzy hashing.

A text's fingerprint has bit b set if more than half of its word shingles'
XXH64 values have it.  Fingerprints at MAX_BITS or fewer differing bits link;
each link's component is a group of near-duplicates.

Candidates: a fingerprint is cut into segments of 23, 23 and 18 bits.  With at
most two differing bits in all, one segment at least is equal (pigeonhole) and
each other one differs in at most two.  The binary Golay code of length 23 is
perfect: every word lies within three bits of exactly one codeword.  The
codeword indices of all words within one bit of a segment (one or six of
them) are its keys; two segments within two bits have a word within one bit of
both, hence a common key.  So a fingerprint's keys are (which segment is equal,
its bits, a codeword index of the next segment) and any linked pair shares one.

Equal fingerprints are one row from the start (partial aggregation), so a group
of copies of any size costs one row.  Fingerprints that share a key are compared
bit by bit in cells of bounded size; a cell gives each fingerprint one edge to
the smallest one its links reach there, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import LocalSets, complete_runs, free_name, map_texts, plus, settle, split_buckets
from tabforge.llm.components import components
from tabforge.plans.prefix import row_print

#: Words of a shingle, seed of its hash, differing bits that still link.
SHINGLE, SEED, MAX_BITS = 3, 42, 2
#: Generator polynomial of the [23, 12, 7] Golay code, x^11+x^10+x^6+x^5+x^4+x^2+1.
GOLAY = 0b110001110101
#: (shift, bits) of the fingerprint's segments.
SEGMENTS = ((41, 23), (18, 23), (0, 18))
#: Fingerprints of a comparison chunk.
CELL = 4096
#: Shingle hashes that are counted at once.
_COUNT_STEP = 1 << 16


def fingerprint(text: str | None, k: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of a text; 0 without words."""
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes).tolist()
    ends = ends.tolist()
    hashed = xxhash.xxh64_intdigest
    if len(words) < k:
        return hashed(joined, seed)
    n = len(words) - k + 1
    ones = np.zeros(64, dtype=np.int64)
    for a in range(0, n, _COUNT_STEP):
        b = min(n, a + _COUNT_STEP)
        h = [hashed(joined[s:e], seed) for s, e in zip(starts[a:b], ends[a + k - 1 : b + k - 1])]
        bits = np.unpackbits(np.array(h, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def with_fingerprint(docs: DataFrame, k: int = SHINGLE, seed: int = SEED, name: str = "_fp") -> DataFrame:
    """``docs`` plus the fingerprint of ``text`` as a signed long."""
    docs = docs.drop(name)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, k, seed) for t in batch.column("text").to_pylist()], dtype=np.uint64)
        cols = [*batch.columns, pa.array(fps.view(np.int64), pa.int64())]
        return pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names, name])

    return map_texts(docs, run, plus(docs.schema, **{name: "bigint"}))


@lru_cache(maxsize=1)
def golay_index() -> np.ndarray:
    """Index (data bits) of the codeword nearest to each 23-bit word."""
    syndrome = np.arange(1 << 23, dtype=np.uint32)
    for bit in range(22, 10, -1):
        syndrome = np.where(syndrome >> np.uint32(bit) & 1, syndrome ^ np.uint32(GOLAY << (bit - 11)), syndrome)
    bits = np.uint32(1) << np.arange(23, dtype=np.uint32)
    errors = [0, *bits.tolist()]
    errors += [int(bits[i] | bits[j]) for i in range(23) for j in range(i)]
    errors += [int(bits[i] | bits[j] | bits[m]) for i in range(23) for j in range(i) for m in range(j)]
    leader = np.zeros(2048, dtype=np.uint32)
    errors = np.array(errors, dtype=np.uint32)
    leader[syndrome[errors]] = errors
    words = np.arange(1 << 23, dtype=np.uint32)
    return ((words ^ leader[syndrome]) >> np.uint32(11)).astype(np.uint16)


def golay_keys(segment: np.ndarray) -> np.ndarray:
    """(n, 24) codeword indices of all words within one bit of each segment."""
    near = np.concatenate([[0], 1 << np.arange(23)]).astype(np.uint32)
    return golay_index()[segment.astype(np.uint32)[:, None] ^ near[None, :]]


def candidate_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of fingerprints: (row, key) without repeats."""
    u = fps.view(np.uint64)
    parts = [(u >> np.uint64(s)) & np.uint64((1 << w) - 1) for s, w in SEGMENTS]
    rows, keys = [], []
    for i in range(3):
        index = np.sort(golay_keys(parts[(i + 1) % 3]), axis=1)
        fresh = np.ones(index.shape, dtype=bool)
        fresh[:, 1:] = index[:, 1:] != index[:, :-1]
        r, c = np.nonzero(fresh)
        rows.append(r)
        keys.append((np.uint64(i) << np.uint64(40)) | (parts[i][r] << np.uint64(12)) | index[r, c].astype(np.uint64))
    return np.concatenate(rows), np.concatenate(keys).view(np.int64)


def _keyed(fps: DataFrame) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_fps = batch.column(0).to_numpy(zero_copy_only=False)
            for a in range(0, len(all_fps), 20_000):
                part = all_fps[a : a + 20_000]
                rows, keys = candidate_keys(part)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[rows])], names=["key", "fp"])

    return fps.select("fp").mapInArrow(run, "key long, fp long")


def _compare(batches: Iterable[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    names = ["key", "cell_a", "cell_b"]

    def read(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        return {c: batch.column(c).to_numpy(zero_copy_only=False) for c in [*names, "fp", "chunk"]}

    for cols, bounds in complete_runs(batches, names, read):
        out_a, out_b = [], []
        for g in np.flatnonzero(np.diff(bounds) > 1):
            cut = slice(bounds[g], bounds[g + 1])
            fp, chunk = cols["fp"][cut].view(np.uint64), cols["chunk"][cut]
            sets = LocalSets(len(fp))
            left = np.flatnonzero(chunk == cols["cell_a"][bounds[g]])
            right = np.flatnonzero(chunk == cols["cell_b"][bounds[g]])
            for a in range(0, len(left), 512):
                rows = left[a : a + 512]
                i, j = np.nonzero(np.bitwise_count(fp[rows][:, None] ^ fp[right][None, :]) <= max_bits)
                i, j = rows[i], right[j]
                sets.link(i[i != j], j[i != j])
            label = sets.labels()
            moved = np.flatnonzero(label != np.arange(len(fp)))
            out_a.append(fp[moved].view(np.int64))
            out_b.append(fp[label[moved]].view(np.int64))
        if out_a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs within ``max_bits``;
    ``fps`` has distinct ``fp``."""
    if max_bits > 2:
        raise ValueError("the keys are complete up to two differing bits")
    cells = split_buckets(settle(_keyed(fps)), ["key"], "fp", CELL)
    dealt = cells.repartition("key", "cell_a", "cell_b").sortWithinPartitions("key", "cell_a", "cell_b", "fp")
    return dealt.mapInArrow(lambda batches: _compare(batches, max_bits), "a long, b long")


def near_duplicates(docs: DataFrame, k: int = SHINGLE, seed: int = SEED, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id and
    ``group_key`` (long, the same within a component).

    Null and empty texts have fingerprint zero and link like any other.  Rows that
    repeat an id keep their own rows.  component_id is the smallest non-null id of
    the component (null if it has none).  No documents: no rows."""
    prints = settle(with_fingerprint(docs.select("doc_id", "text"), k, seed, "fp").select("doc_id", "fp"))
    classes = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(fingerprint_links(classes, max_bits)).withColumnRenamed("node", "fp")
    labelled = classes.join(found, "fp", "left").withColumn("group_key", F.coalesce("label", "fp"))
    heads = labelled.groupBy("group_key").agg(F.min("least").alias("component_id"))
    merged = settle(labelled.join(heads, "group_key").select("fp", "group_key", "component_id"))
    return prints.join(merged, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "group_key"
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id (of
    rows that share it, the one with the smallest text hash; of equal rows, one).
    Groups without any id keep one row."""
    # helper columns are named apart from those of the documents
    own, group, fp = (free_name(docs, c) for c in ("_id", "_group", "_fp"))
    groups = settle(near_duplicates(docs))
    heads = (
        groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy(F.col("doc_id").alias(own), F.col("group_key").alias(group))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    heads = settle(heads)
    single = heads.groupBy(own).agg(F.sum("_rows").alias("_n")).where((F.col("_n") == 1) & F.col(own).isNotNull()).select(own)
    kept = docs.join(single, docs["doc_id"] == single[own], "left_semi")
    if not heads.where((F.col("_rows") > 1) | F.col(own).isNull()).take(1) and not heads.groupBy(own).count().where("count > 1").take(1):
        return kept
    # ids that several rows share: take the fingerprint again and one row of each group
    rest = heads.join(single, own, "left_anti").select(own).distinct()
    members = with_fingerprint(docs.join(rest, docs["doc_id"].eqNullSafe(rest[own]), "left_semi"), name=fp)
    print_ = free_name(members, "_print")
    key = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("doc_id").alias(own), F.conv("fingerprint", 16, -10).cast("long").alias(print_), F.col("group_key").alias(group)
    )
    key = key.distinct()
    met = members.join(key, members["doc_id"].eqNullSafe(key[own]) & (members[fp] == key[print_]))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = met.groupBy(group).agg(F.min_by(whole, F.struct(F.xxhash64("text"), row_print(docs))).alias("_row"))
    return kept.unionByName(one.select(*[F.col("_row")[c].alias(c) for c in docs.columns]))

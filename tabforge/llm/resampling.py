"""Importance resampling towards a target distribution, weighed by bit-sliced aggregation.

A text's features are its runs of 1 to MAX_RUN consecutive words, hashed by crc32 into
BUCKETS buckets.  A bucket's gain is the scaled log of how much likelier it is among the
target's features than among all documents' (smoothed by one), as an integer.

Exact weights come from bit planes: a document's bucket counts are cut into planes of
BUCKETS bits (plane j holds bit j of every count), the gains into planes of their two's
complement.  The sum of count x gain over the buckets is then the sum over plane pairs of
2^(j + k) times the bits that both have set, the gains' top plane counting negative: an AND
and a popcount per pair, no multiplication.

crc32 is linear over GF(2), so the hash of a run follows from the hashes of its words: shift
one by the other's length (tables) and add.  Words are hashed byte by byte, all words of a
block of texts at once.

The sample adds Gumbel noise from a hash of the id to each weight and takes the highest
scores.  Scores are counted in RANGES equal ranges first; only documents from the range of
the cut upwards are numbered, over all tasks (``prefix.dense_index``).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.llm.common import settle, text_chunks
from tabforge.plans.prefix import dense_index

BUCKETS = 10_000
MAX_RUN = 3
#: Documents with fewer words are weighed but never drawn.
MIN_WORDS = 20
#: Share of the documents long enough that is drawn, in hundredths.
PERCENT = 5
SCALE = 1000
SEED = 42
#: Score ranges that are counted to find the cut.
RANGES = 4096
#: Bytes of one text that are worked on at once; texts whose bit planes are summed at once.
PIECE, TOGETHER = 2 << 20, 64
#: Words up to so many bytes are hashed together; lengths up to so many have a shift table.
SHORT = 64
RESULTS = ("n_features", "weight", "score", "rank")


# ---------------------------------------------------------------- crc32 of many strings


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """crc32 of one byte; shifts by 0 to SHORT + 1 bytes; shifts by 2^k bytes.  A shift is four
    tables, one for each byte of a crc, whose entries are added (xor)."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, np.uint32(0xEDB88320) ^ (step >> 1), step >> 1).astype(np.uint32)
    none = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * b) for b in range(4)])
    shifts = [none]
    for _ in range(SHORT + 1):
        shifts.append(step[shifts[-1] & 255] ^ (shifts[-1] >> np.uint32(8)))
    doubled = [shifts[1]]
    for _ in range(40):
        last = doubled[-1]
        doubled.append(_look_up(last, last))
    return step, np.stack(shifts), np.stack(doubled)


def _look_up(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 255] ^ table[1][(crc >> np.uint32(8)) & 255] ^ table[2][(crc >> np.uint32(16)) & 255] ^ table[3][crc >> np.uint32(24)]


def shifted(crc: np.ndarray, by: np.ndarray) -> np.ndarray:
    """What each crc32 adds to that of a string that goes on for ``by`` more bytes."""
    _, shifts, doubled = _tables()
    flat = shifts.reshape(-1)
    near = by <= SHORT + 1
    at = np.where(near, by, 0) * 1024
    out = flat[at + (crc & 255)] ^ flat[at + 256 + ((crc >> np.uint32(8)) & 255)]
    out ^= flat[at + 512 + ((crc >> np.uint32(16)) & 255)] ^ flat[at + 768 + (crc >> np.uint32(24))]
    if not near.all():
        far = np.flatnonzero(~near)
        value, left = crc[far], by[far]
        for k in range(int(left.max()).bit_length()):
            odd = (left >> k) & 1 == 1
            value[odd] = _look_up(doubled[k], value[odd])
        out[far] = value
    return out


def word_crcs(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 of the byte strings data[start : start + size]."""
    step = _tables()[0]
    crc = np.full(len(start), 0xFFFFFFFF, dtype=np.uint32)
    live = np.flatnonzero(size <= SHORT)
    live = live[np.argsort(-size[live], kind="stable")]  # longest first: those that go on are a prefix
    at, ends, c = start[live], -size[live], crc[live]
    for k in range(-int(ends[0]) if len(ends) else 0):
        n = int(np.searchsorted(ends, -k))  # words longer than k bytes
        head = c[:n]
        c[:n] = step[(head ^ data[at[:n] + k]) & 255] ^ (head >> np.uint32(8))
    crc[live] = ~c
    for i in np.flatnonzero(size > SHORT):
        crc[i] = zlib.crc32(data[start[i] : start[i] + size[i]])
    return crc


# ---------------------------------------------------------------- features


@lru_cache(maxsize=1)
def _bytes() -> tuple[np.ndarray, np.ndarray]:
    """A-Z lower-cased; bytes of words: digits, a-z and all of non-ASCII characters."""
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    word = np.zeros(256, dtype=bool)
    word[48:58] = word[97:123] = word[128:] = True
    return low, word


def _runs(crc: np.ndarray, size: np.ndarray, text: np.ndarray, first: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of each run of words that ends at word ``first`` or later."""
    blank = np.uint32(zlib.crc32(b" "))
    texts, found = [text[first:]], [crc[first:] % np.uint32(buckets)]
    led = shifted(np.full(len(crc), blank, dtype=np.uint32), size) ^ crc  # of the word with a blank before it
    run = crc
    for n in range(1, MAX_RUN):
        if len(crc) <= n:
            break
        run = shifted(run[:-1], size[n:] + 1) ^ led[n:]  # run[i]: words i to i + n
        ends = np.arange(n, len(crc))
        whole = (text[n:] == text[:-n]) & (ends >= first)
        texts.append(text[n:][whole])
        found.append(run[whole] % np.uint32(buckets))
    return np.concatenate(texts), np.concatenate(found).astype(np.int64)


def _words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the words in lower-cased bytes; none crosses one of the texts' ``bounds``."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = _bytes()[1][data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[bounds] = True
    opens = inside[1:] & (~inside[:-1] | cut)
    closes = inside[:-1] & (~inside[1:] | cut)
    start = np.flatnonzero(opens)
    return start, np.flatnonzero(closes) - start


def features(texts: pa.Array, buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of (text, bucket) of all features, and the words of each text in the block.

    Null texts have none.  A text beyond PIECE bytes comes in several blocks, cut between words;
    the last words of one lead the runs of the next."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    raw = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    low, inside = _bytes()
    a, base = int(offsets[0]), offsets - offsets[0]
    if len(texts) > 1 or base[-1] <= PIECE:
        data = low[raw[a : a + int(base[-1])]]
        start, size = _words(data, base)
        text = np.searchsorted(base, start, side="right") - 1
        yield *_runs(word_crcs(data, start, size), size, text, 0, buckets), np.bincount(text, minlength=len(texts))
        return
    crc, size = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
    end = int(offsets[-1])
    while a < end:
        stop = min(end, a + PIECE)
        while stop < end and inside[low[raw[stop - 1]]]:  # up to the next byte that is in no word
            ahead = np.flatnonzero(~inside[low[raw[stop : stop + PIECE]]])
            stop = stop + int(ahead[0]) + 1 if len(ahead) else min(end, stop + PIECE)
        data = low[raw[a:stop]]
        at, n = _words(data, np.array([0, len(data)]))
        led = len(crc)
        crc, size = np.concatenate([crc, word_crcs(data, at, n)]), np.concatenate([size, n])
        yield *_runs(crc, size, np.zeros(len(crc), dtype=np.int64), led, buckets), np.array([len(n)])
        crc, size = crc[-(MAX_RUN - 1) :], size[-(MAX_RUN - 1) :]
        a = stop


# ---------------------------------------------------------------- bit planes


def planes(values: np.ndarray, bits: int) -> np.ndarray:
    """(rows, buckets) of integers -> (rows, bits, words of 64 bits): plane j holds bit j of each."""
    rows, n = values.shape
    out = np.zeros((rows, bits, -(-n // 64) * 8), dtype=np.uint8)
    for j in range(bits):
        out[:, j, : -(-n // 8)] = np.packbits((values >> j) & 1 != 0, axis=1)
    return out.view(np.uint64)


def gain_planes(gains: np.ndarray) -> np.ndarray:
    """Planes of the gains' two's complement; the last has the sign."""
    bits = max(int(gains.max()).bit_length(), int(~gains.min()).bit_length() if gains.min() < 0 else 0) + 1
    return planes(gains[None, :], bits)[0]


def weigh(counts: np.ndarray, gains: np.ndarray) -> np.ndarray:
    """Sum of count x gain of each row of ``counts``, with ``gains`` in planes."""
    most = int(counts.max()) if counts.size else 0
    narrow = np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.int64
    sliced = planes(counts.astype(narrow), most.bit_length())
    total = np.zeros(len(counts), dtype=np.int64)
    for k, gain in enumerate(gains):
        part = np.zeros(len(counts), dtype=np.int64)
        for j in range(sliced.shape[1]):
            part += np.bitwise_count(sliced[:, j] & gain).sum(axis=1, dtype=np.int64) << j
        total += -(part << k) if k == len(gains) - 1 else part << k
    return total


# ---------------------------------------------------------------- Spark


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts in each bucket; every task sends one row a bucket at most."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for part in text_chunks(batch, "text"):
                for _, found, _ in features(part.column("text"), buckets):
                    total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    parts = texts.select(F.col(text_col).alias("text")).mapInArrow(run, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Gain of each bucket; the counts are ``buckets`` rows, whatever the input."""
    spark = docs.sparkSession
    have = bucket_counts(docs, text_col, buckets).withColumnRenamed("n", "s")
    want = bucket_counts(target, text_col, buckets).withColumnRenamed("n", "t")
    both = spark.range(buckets).withColumnRenamed("id", "bucket").join(have, "bucket", "left").join(want, "bucket", "left").fillna(0)
    both = settle(both)
    s_all, t_all = both.agg(F.sum("s"), F.sum("t")).first()
    up = (F.col("t") + 1).cast("double") * F.lit(float(s_all + buckets))
    down = (F.col("s") + 1).cast("double") * F.lit(float(t_all + buckets))
    gains = both.select("bucket", F.floor(SCALE * F.log(up / down)).cast("long").alias("gain")).orderBy("bucket").collect()
    return np.array([r.gain for r in gains], dtype=np.int64)


def _weighed(rows: DataFrame, gains: np.ndarray) -> DataFrame:
    """(text, own, id) -> own, id, words, n_features, weight."""
    buckets, sliced = len(gains), gain_planes(gains)

    def block(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words, n, weight = (np.zeros(len(texts), dtype=np.int64) for _ in range(3))
        counts = np.zeros((len(texts), buckets), dtype=np.int64)
        for text, found, own in features(texts, buckets):
            counts += np.bincount(text * buckets + found, minlength=counts.size).reshape(counts.shape)
            words += own
        n = counts.sum(axis=1)
        weight = weigh(counts, sliced)
        return words, n, weight

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_chunks(batch, "text"):
                for a in range(0, part.num_rows, TOGETHER):
                    some = part.slice(a, TOGETHER)
                    made = [pa.array(x) for x in block(some.column("text"))]
                    yield pa.RecordBatch.from_arrays([some.column("own"), some.column("id"), *made], names=["own", "id", "words", "n_features", "weight"])

    schema = T.StructType([rows.schema["own"], rows.schema["id"], *T.StructType.fromDDL("words long, n_features long, weight long").fields])
    return rows.select("text", "own", "id").mapInArrow(run, schema)


def noise(id_col: Column, seed: int = SEED) -> Column:
    """Gumbel noise, scaled and floored, from a hash of the seed and the id (null: as an empty text)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-float(SCALE)) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
    with_text: bool = False,
) -> DataFrame:
    """``docs`` without their text (with it on request) plus n_features, weight, score and rank.

    ``target`` has texts of the wanted kind in a column of the same name.  Of the documents with
    ``min_words`` words or more, ``percent`` in a hundred (rounded down) have a rank: the highest
    scores, ties to smaller ids (null ids last; rows that tie in both in a fixed order).  Null and
    empty texts weigh 0.  Repeated rows count and are drawn by themselves.  Own columns
    pass through; those named like the results are replaced.  No documents: no rows."""
    own = [c for c in docs.columns if c not in RESULTS and c != id_col and (with_text or c != text_col)]
    rows = docs.select(
        F.col(text_col).alias("text"),
        F.struct(F.lit(None).cast("int").alias("_"), *[F.col(f"`{c}`") for c in own]).alias("own"),
        F.col(id_col).alias("id"),
    )
    gains = bucket_gains(docs, target, text_col, buckets)
    scored = settle(_weighed(rows, gains).withColumn("score", F.col("weight") + noise(F.col("id"), seed)))
    fit = F.col("words") >= min_words
    n, least, most = scored.where(fit).agg(F.count(F.lit(1)), F.min("score"), F.max("score")).first()
    draw = percent * n // 100
    border = None
    if draw:
        width = (most - least) // RANGES + 1
        at = F.floor((F.col("score") - F.lit(least)) / F.lit(width)).cast("int")
        met, border = 0, RANGES
        for r in sorted(scored.where(fit).groupBy(at.alias("at")).count().collect(), key=lambda r: -r["at"]):  # RANGES rows at most
            met, border = met + r["count"], r["at"]
            if met >= draw:
                break
        border = least + border * width
    high = fit & (F.col("score") >= F.lit(border)) if draw else F.lit(False)
    ordered = scored.where(high).withColumns({"down": -F.col("score"), "no_id": F.col("id").isNull()})
    ranked = dense_index(ordered, "down", into="at", tiebreak=["no_id", "id"])
    place = F.when(F.col("at") < draw, F.col("at") + 1).cast("long")
    ranked = ranked.select(*scored.columns, place.alias("rank"))
    others = scored.where(~high).select(*scored.columns, F.lit(None).cast("long").alias("rank"))
    return ranked.unionAll(others).select(F.col("id").alias(id_col), *[F.col(f"own.`{c}`") for c in own], *RESULTS)

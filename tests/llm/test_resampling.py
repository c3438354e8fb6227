"""Features, bit planes and the draw against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabforge.llm import resampling as R

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOC = "doc_id long, text string"


def hashed(text: str | None) -> tuple[list[int], int]:
    w = WORD.findall((text or "").translate(LOW))
    return sorted(zlib.crc32(" ".join(w[i : i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(w) - n + 1)), len(w)


def slow(rows, target) -> list[tuple]:
    s, t = np.zeros(10_000, dtype=int), np.zeros(10_000, dtype=int)
    for _, text in rows:
        np.add.at(s, hashed(text)[0], 1)
    for text in target:
        np.add.at(t, hashed(text)[0], 1)
    gains = [
        math.floor(1000 * math.log((b + 1.0) * (s.sum() + 10_000.0) / ((a + 1.0) * (t.sum() + 10_000.0))))
        for a, b in zip(s.tolist(), t.tolist())
    ]
    out = []
    for doc_id, text in rows:
        found, words = hashed(text)
        weight = sum(gains[b] for b in found)
        x = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((x + 0.5) / 4294967296))), None, words])
    fit = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(fit[: 5 * len(fit) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def texts_of(rng: random.Random, n: int) -> list[str]:
    words = ["foo", "Bar", "ü", "日本", "a1", "zz" * 40, "x" * 70]
    return [rng.choice([" ", "-", "\n"]).join(rng.choice(words) for _ in range(rng.randrange(0, 60))) for _ in range(n)]


def test_features_are_those_of_the_words():
    some = [None, "", "a", "A b", "Éa  ½x1 日本 Zz-9", "x" * 300 + " y " + "é" * 70 + " z", *texts_of(random.Random(1), 60)]
    for part in (pa.array(some), pa.array(some).slice(3, 9), pa.array(some, pa.large_string())):
        ((text, bucket, words),) = R.features(part)
        for i, x in enumerate(part.to_pylist()):
            assert (sorted(bucket[text == i].tolist()), words[i]) == hashed(x)
    assert [len(b) for _, b, _ in R.features(pa.array([], pa.string()))] == [0]


def test_a_long_text_is_read_in_pieces(monkeypatch):
    rng = random.Random(2)
    monkeypatch.setattr(R, "PIECE", 500)
    text = "".join("a" * rng.randrange(1, 100) + rng.choice(["é", "B", "."]) for _ in range(3000)) + "k" * 5000
    parts = list(R.features(pa.array([text])))
    assert len(parts) > 100
    assert (sorted(np.concatenate([b for _, b, _ in parts]).tolist()), sum(int(w[0]) for *_, w in parts)) == hashed(text)


def test_bit_sliced_weights_are_the_sums():
    rng = np.random.default_rng(0)
    counts = rng.poisson(0.1, (70, 10_000))
    counts[3, 5] = 70_000
    for gains in (rng.integers(-9000, 7000, 10_000), np.zeros(10_000, int), np.full(10_000, -1), np.full(10_000, 5), np.full(10_000, -8)):
        assert (R.weigh(counts, R.gain_planes(gains)) == counts @ gains).all()
        assert (R.weigh(counts[:0], R.gain_planes(gains)) == 0).all()
        assert (R.weigh(counts * 0, R.gain_planes(gains)) == 0).all()


@pytest.mark.parametrize("n", [0, 3, 900])
def test_resample_matches_plain_python(spark, n):
    rng = random.Random(n)
    rows = [(i if i % 50 else None, t) for i, t in enumerate(texts_of(rng, n))]
    rows += [(7, None), (8, "")] + [(5, "one two three " * 9)] * 40 if n else []
    target = ["foo bar foo", None, "", "日本 a1 one two"]
    df = spark.createDataFrame(rows, DOC).withColumn("weight", F.lit("old")).withColumn("own", F.lit(3)).withColumn("down", F.lit(4))
    out = R.resample(df.repartition(4), spark.createDataFrame([(t,) for t in target], "text string"))
    assert out.columns == ["doc_id", "own", "down", *R.RESULTS]
    got = out.collect()
    assert {(r.own, r.down) for r in got} <= {(3, 4)}
    assert sorted((tuple(r[c] for c in ("doc_id", *R.RESULTS)) for r in got), key=str) == slow(rows, target)


def test_no_target_and_texts_on_request(spark):
    df = spark.createDataFrame([(i, f"w{i} " * 30) for i in range(40)], DOC)
    out = R.resample(df, df.limit(0).select("text"), percent=50, with_text=True).collect()
    assert sorted(r["rank"] for r in out if r["rank"]) == list(range(1, 21)) and all(r.text.startswith(f"w{r.doc_id} ") for r in out)


def test_drawn_documents_are_like_the_target(spark):
    rows = [(i, ("red green blue " if i % 20 == 0 else "one two three ") * 20) for i in range(2000)]
    out = R.resample(spark.createDataFrame(rows, DOC), spark.createDataFrame([("blue red green",)] * 50, "text string"))
    drawn = [r.doc_id for r in out.where("rank is not null").collect()]
    assert len(drawn) == 100 and sum(i % 20 == 0 for i in drawn) == 100

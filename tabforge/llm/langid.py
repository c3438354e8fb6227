"""Language identification with a byte convolutional network.

Bytes are embedded, filters of several widths slide over fixed-length windows,
each filter keeps its largest response in the window, and a softmax over
those gives the window's languages.  The network is trained in numpy on a
bounded sample of labelled texts.  To apply it, embedding and filters are
folded into one response table per pair of bytes, so a window costs two table
look-ups per byte instead of matrix products.  Every text is read whole, in
consecutive windows; its languages are the windows' mean weighted by length.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabforge.llm.common import fold_of, held_out, map_texts, plus

#: Labelled texts per language that the network is fitted on, at most.
TRAIN_PER_LANG = 400
#: Labelled texts in all, at most: with many languages each has fewer, with more languages than
#: that the most frequent have one.
TRAIN_DOCS = 80_000
#: Bytes of one window.
WINDOW = 256
#: Windows drawn from each training text, at most.
WINDOWS_PER_TEXT = 4
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
#: A letter by its Unicode category, as in the filter of the training texts.
_LETTER = regex.compile(r"\p{L}")


@dataclass
class ByteCNN:
    """Trained network: embedding (256, e), one filter bank per width, dense layer."""

    langs: list[str]
    embed: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Responses of all filters to the byte pair at offset 0 and to the one at offset 2."""
        first = np.zeros((65536, FILTERS * len(WIDTHS)), dtype=np.float32)
        second = np.zeros_like(first)
        hi, lo = np.arange(65536) >> 8, np.arange(65536) & 255
        for k, w in enumerate(WIDTHS):
            cut = slice(k * FILTERS, (k + 1) * FILTERS)
            part = [self.embed @ self.filters[k][o] for o in range(w)]
            first[:, cut] = part[0][hi] + part[1][lo]
            if w > 2:
                second[:, cut] = part[2][hi]
            if w > 3:
                second[:, cut] += part[3][lo]
        return first, second[:, FILTERS:].copy()


def windows_of(raw: bytes) -> np.ndarray:
    """(windows, WINDOW + 3) bytes of a text: consecutive windows, each with the
    three bytes that follow it so that no filter position is lost at a border."""
    n = max(1, -(-len(raw) // WINDOW))
    padded = np.zeros(n * WINDOW + 3, dtype=np.uint8)
    padded[: len(raw)] = np.frombuffer(raw, dtype=np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW + 3)[::WINDOW]


def responses(windows: np.ndarray, first: np.ndarray, second: np.ndarray, step: int = 8) -> np.ndarray:
    """Largest response of each filter in each window, before bias and rectifier."""
    out = np.empty((len(windows), first.shape[1]), dtype=np.float32)
    for a in range(0, len(windows), step):
        x = windows[a : a + step].astype(np.int32)
        pair = (x[:, :-1] << 8) | x[:, 1:]
        r = first.take(pair[:, :WINDOW], axis=0)
        r[:, :, FILTERS:] += second.take(pair[:, 2:], axis=0)
        r.max(axis=1, out=out[a : a + step])
    return out


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def fit(windows: np.ndarray, langs: list[str], seed: int = 7, epochs: int = 4, batch: int = 64) -> ByteCNN:
    """Adam on the cross entropy of labelled windows; deterministic for a seed."""
    rng = np.random.default_rng(seed)
    names = sorted(set(langs))
    at = {lang: i for i, lang in enumerate(names)}
    x, y = windows, np.array([at[lang] for lang in langs])
    # languages count alike, however many windows each has
    share = np.bincount(y, minlength=len(names))[y]
    weight = ((len(y) / len(names)) / share).astype(np.float32)
    n_out = FILTERS * len(WIDTHS)
    p = {
        "embed": rng.normal(0, 0.5, (256, EMBED)),
        "bias": np.zeros(n_out),
        "dense": rng.normal(0, 0.1, (n_out, len(names))),
        "dense_bias": np.zeros(len(names)),
    } | {f"f{k}": rng.normal(0, 0.3, (w, EMBED, FILTERS)) for k, w in enumerate(WIDTHS)}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    mean = {k: np.zeros_like(v) for k, v in p.items()}
    power = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for a in range(0, len(order), batch):
            pick = order[a : a + batch]
            xb, yb, wb = x[pick], y[pick], weight[pick]
            e = p["embed"][xb]
            pooled, where = [], []
            for k, w in enumerate(WIDTHS):
                r = sum(e[:, o : o + WINDOW] @ p[f"f{k}"][o] for o in range(w))
                at = r.argmax(axis=1)
                where.append(at)
                pooled.append(np.take_along_axis(r, at[:, None], axis=1)[:, 0])
            pre = np.concatenate(pooled, axis=1) + p["bias"]
            h = np.maximum(pre, 0)
            q = softmax(h @ p["dense"] + p["dense_bias"])
            d = q.copy()
            d[np.arange(len(yb)), yb] -= 1
            d *= (wb / len(yb))[:, None]
            g = {k: np.zeros_like(v) for k, v in p.items()}
            g["dense"], g["dense_bias"] = h.T @ d, d.sum(0)
            dh = (d @ p["dense"].T) * (pre > 0)
            g["bias"] = dh.sum(0)
            lane = np.arange(len(yb))[:, None]
            for k, w in enumerate(WIDTHS):
                dk = dh[:, k * FILTERS : (k + 1) * FILTERS]
                for o in range(w):
                    byte = xb[lane, where[k] + o]
                    vec = p["embed"][byte]
                    g[f"f{k}"][o] = np.einsum("nfe,nf->ef", vec, dk)
                    back = (dk[:, :, None] * p[f"f{k}"][o].T[None]).reshape(-1, EMBED)
                    for c in range(EMBED):
                        g["embed"][:, c] += np.bincount(byte.ravel(), back[:, c], 256)
            step += 1
            for k in p:
                grad = g[k] + 1e-4 * p[k]
                mean[k] = 0.9 * mean[k] + 0.1 * grad
                power[k] = 0.99 * power[k] + 0.01 * grad * grad
                p[k] -= 0.01 * (mean[k] / (1 - 0.9**step)) / (np.sqrt(power[k] / (1 - 0.99**step)) + 1e-8)
    f32 = {k: v.astype(np.float32) for k, v in p.items()}
    return ByteCNN(names, f32["embed"], [f32[f"f{k}"] for k in range(len(WIDTHS))], f32["bias"], f32["dense"], f32["dense_bias"])


def draw_windows(text: str) -> list[bytes]:
    """Up to WINDOWS_PER_TEXT windows from anywhere in a text, the same for equal texts."""
    raw = text.encode("utf-8", "replace")
    found = windows_of(raw)
    pick = np.random.default_rng(zlib.crc32(raw)).permutation(len(found))[:WINDOWS_PER_TEXT]
    return [found[i].tobytes() for i in pick]


def training_sample(docs: DataFrame, per_lang: int = TRAIN_PER_LANG) -> tuple[np.ndarray, list[str]]:
    """Windows and languages of up to ``per_lang`` documents a language outside the
    held-out fold, chosen by a hash of the id; TRAIN_DOCS documents in all at most, so with
    more than TRAIN_DOCS / per_lang languages each has fewer.  The
    windows are drawn where the texts are: about 1 kB a document reaches the driver.

    Languages are counted first, and only ids whose hash lies in the lowest share
    that gives about twice ``per_lang`` of their language are ranked: the ranking
    of a language with most of the rows is as small as any other's."""
    usable = docs.where(F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull() & (fold_of(F.col("doc_id")) != 0))
    keys = usable.select("doc_id", "lang", F.xxhash64(F.lit(11), "doc_id").alias("_h")).distinct()
    counts = keys.groupBy("lang").agg(F.count(F.lit(1)).alias("_n"))
    per_lang = max(1, min(per_lang, TRAIN_DOCS // max(1, counts.count())))
    common = counts.orderBy(F.desc("_n"), "lang").limit(TRAIN_DOCS)
    place = F.col("_h") / F.lit(2.0**64) + 0.5  # uniform in [0, 1)
    near = keys.join(F.broadcast(common), "lang").where(place <= F.lit(2.0 * per_lang + 50) / F.col("_n"))
    turn = Window.partitionBy("lang").orderBy("_h", "doc_id")
    chosen = near.withColumn("_r", F.row_number().over(turn)).where(F.col("_r") <= per_lang).select("doc_id", "lang")
    rows = (
        usable.select("doc_id", "lang", "text")
        .join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi")
        .groupBy("doc_id", "lang")
        .agg(F.min("text").alias("text"))
    )

    def draw(batch: pa.RecordBatch) -> pa.RecordBatch:
        drawn = [draw_windows(t) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(drawn, pa.list_(pa.binary()))], names=["lang", "windows"])

    found = sorted((r.lang, bytes(w)) for r in map_texts(rows, draw, "lang string, windows array<binary>").collect() for w in r.windows)
    size = WINDOW + 3
    return np.frombuffer(b"".join(w for _, w in found), dtype=np.uint8).reshape(-1, size), [lang for lang, _ in found]


def predict_texts(texts: list[str | None], net: ByteCNN | None, tables=None) -> tuple[list[str], list[float]]:
    """Language and its probability of each text; ``und`` with 0.0 for texts without a letter."""
    first, second = tables if tables is not None else net.tables() if net else (None, None)
    langs, scores = ["und"] * len(texts), [0.0] * len(texts)
    use = [i for i, t in enumerate(texts) if net is not None and t and _LETTER.search(t)]
    if not use:
        return langs, scores
    raws = [texts[i].encode("utf-8", "replace") for i in use]
    parts = [windows_of(r) for r in raws]
    counts = np.array([len(p) for p in parts])
    hidden = np.maximum(responses(np.concatenate(parts), first, second) + net.bias, 0)
    prob = softmax((hidden @ net.dense + net.dense_bias).astype(np.float64))
    last = np.cumsum(counts) - 1
    size = np.full(len(prob), float(WINDOW))
    size[last] = [max(1, len(r) - (c - 1) * WINDOW) for r, c in zip(raws, counts)]
    total = np.add.reduceat(prob * size[:, None], last - counts + 1, axis=0)
    total /= total.sum(axis=1, keepdims=True)
    best = total.argmax(axis=1)
    for j, i in enumerate(use):
        langs[i], scores[i] = net.langs[best[j]], float(min(1.0, total[j, best[j]]))
    return langs, scores


def identify(docs: DataFrame, net: ByteCNN | None) -> DataFrame:
    """``docs`` (with ``text``) plus ``lang_pred`` and ``score``.

    Null and empty texts, texts without a letter, and all texts when there was
    nothing to learn from (``net`` is None) are ``und`` with score 0.0.  Other
    columns pass through, whatever their names; own columns named like the
    results are replaced."""
    docs = docs.drop("lang_pred", "score")
    tables = net.tables() if net else None
    schema = plus(docs.schema, lang_pred="string", score="double")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, scores = predict_texts(batch.column("text").to_pylist(), net, tables)
        cols = [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
        return pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names, "lang_pred", "score"])

    return map_texts(docs, run, schema)


def train(docs: DataFrame) -> ByteCNN | None:
    """Network fitted on the sample of ``docs``; None if no document can be learned from."""
    windows, langs = training_sample(docs)
    return fit(windows, langs) if langs else None


def predictions(docs: DataFrame) -> DataFrame:
    """Contract rows: doc_id, held_out, lang_pred, score for every document."""
    net = train(docs)
    out = identify(docs.select("doc_id", "text"), net)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")

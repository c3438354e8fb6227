"""Toxic spans and document scores with a linear-chain conditional random field.

Tokens are tagged inside or outside a toxic span.  The token labels that the
field is trained on come from document labels: a word, or a word's first
letters, that is tied to toxic documents far beyond chance (likelihood
ratio test, and odds of at least MIN_LIFT) marks its tokens inside toxic
documents; all other tokens are outside.  The field has weights for the
word, its beginnings and its ending, and transition weights.  Training
is full-batch Adam on the exact conditional likelihood by forward-backward.

A document's score is a logistic function of its marginals (the largest one,
and the expected number of toxic tokens among those of FLOOR or more), fitted on the sample's document
labels.  Texts are read whole, in any length: the recursions run over chunks
of tokens at once, linked by the exact two-by-two products of each chunk.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import fold_of, held_out, map_texts, plus

#: Labelled documents that the model is fitted on, at most, by label.
TRAIN_TOXIC, TRAIN_CLEAN = 800, 1600
#: Characters of a text that the model is fitted on, at most: of longer ones, as many stretches
#: evenly spread over the text (all texts are scored, whole).
TRAIN_CHARS, TRAIN_STRETCHES = 50_000, 10
#: Of these, how many toxic and clean ones the field's weights are trained on, at most.
CHAIN_TOXIC, CHAIN_CLEAN = 300, 1200
#: Test statistic and odds ratio that tie a feature to toxic documents, and the
#: statistic that does so even if other features explain the same documents.
MIN_G2, MIN_LIFT, STRONG_G2 = 16.0, 8.0, 45.0
#: Marginals below this do not count towards a document's toxic tokens, so that
#: very long clean texts do not add up to a toxic one.
FLOOR = 0.2
#: Lengths of the word beginnings that are features.
BEGINNINGS = (3, 4, 5, 6, 7, 8)
#: Tokens of one chunk of the recursions.
CHUNK = 64
#: Words whose scores a task keeps, at most, before it starts anew.
CACHE = 300_000
_TOKEN = re.compile(r"\w+")


def features(word: str) -> list[str]:
    """Feature names of a lower-cased token."""
    out = ["w" + word, "e" + word[-3:]]
    out += [f"{k}" + word[:k] for k in BEGINNINGS if len(word) > k]
    return out


def tokens(text: str | None) -> list[str]:
    """Lower-cased words.  Lower case is as long as the text but where a dotted capital I is in
    it; there each word is lower-cased by itself, so that offsets are always the text's own."""
    if not text:
        return []
    return _TOKEN.findall(text.lower()) if "\u0130" not in text else [w.lower() for w in _TOKEN.findall(text)]


class Lattice:
    """Emissions of a batch of documents laid out in chunks of CHUNK tokens."""

    def __init__(self, sizes: np.ndarray):
        self.sizes = sizes
        self.per_doc = -(-sizes // CHUNK)
        self.lanes = int(self.per_doc.sum())
        self.lane0 = np.cumsum(self.per_doc) - self.per_doc
        first = np.cumsum(sizes) - sizes
        self.spot = np.arange(int(sizes.sum())) + np.repeat(self.lane0 * CHUNK - first, sizes)
        self.real = np.zeros(self.lanes * CHUNK, dtype=bool)
        self.real[self.spot] = True
        self.real = np.ascontiguousarray(self.real.reshape(self.lanes, CHUNK).T)

    def lay(self, values: np.ndarray) -> np.ndarray:
        out = np.ones(self.lanes * CHUNK)
        out[self.spot] = values
        return np.ascontiguousarray(out.reshape(self.lanes, CHUNK).T)

    def lift(self, grid: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(grid.T).reshape(-1)[self.spot]

    def messages(self, x: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward odds before each token and backward odds after it, on the grid.

        ``x``: exp(emission) of the inside state on the grid; ``t``: exp(transitions).
        The text starts after a virtual outside token."""
        (a00, a01), (a10, a11) = t
        lanes = self.lanes
        # product of each chunk's step matrices, scaled
        p00, p01, p10, p11 = np.ones(lanes), np.zeros(lanes), np.zeros(lanes), np.ones(lanes)
        for k in range(CHUNK):
            q00, q01 = p00 * a00 + p01 * a10, (p00 * a01 + p01 * a11) * x[k]
            q10, q11 = p10 * a00 + p11 * a10, (p10 * a01 + p11 * a11) * x[k]
            scale = 1.0 / (q00 + q01 + q10 + q11)
            on = self.real[k]
            if on.all():
                p00, p01, p10, p11 = q00 * scale, q01 * scale, q10 * scale, q11 * scale
            else:
                p00, p01 = np.where(on, q00 * scale, p00), np.where(on, q01 * scale, p01)
                p10, p11 = np.where(on, q10 * scale, p10), np.where(on, q11 * scale, p11)
        enter, leave = np.zeros(lanes), np.ones(lanes)
        by_size = np.argsort(-self.per_doc, kind="stable")
        counts = self.per_doc[by_size]
        longest = int(counts[0]) if len(counts) else 0
        for c in range(longest):
            here = self.lane0[by_size[: np.searchsorted(-counts, -c, side="left")]] + c  # documents with a chunk c
            nxt = here[self.per_doc[by_size[: len(here)]] > c + 1]
            cur = nxt
            enter[cur + 1] = (p01[cur] + enter[cur] * p11[cur]) / (p00[cur] + enter[cur] * p10[cur])
        for c in range(longest - 1, 0, -1):
            cur = self.lane0[by_size[: np.searchsorted(-counts, -c, side="left")]] + c
            leave[cur - 1] = (p10[cur] + leave[cur] * p11[cur]) / (p00[cur] + leave[cur] * p01[cur])
        before, after = np.empty_like(x), np.empty_like(x)
        r = enter
        for k in range(CHUNK):
            before[k] = r
            r = np.where(self.real[k], x[k] * (a01 + a11 * r) / (a00 + a10 * r), r)
        b = leave
        for k in range(CHUNK - 1, -1, -1):
            after[k] = b
            xb = x[k] * b
            b = np.where(self.real[k], (a10 + a11 * xb) / (a00 + a01 * xb), b)
        return before, after

    def marginals(self, emission: np.ndarray, trans: np.ndarray) -> np.ndarray:
        """Probability of the inside state at every token."""
        if not len(self.spot):
            return np.zeros(0)
        t = np.exp(trans)
        x = self.lay(np.exp(np.clip(emission, -30, 30)))
        before, after = self.messages(x, t)
        odds = x * (t[0, 1] + t[1, 1] * before) / (t[0, 0] + t[1, 0] * before) * after
        return self.lift(odds / (1 + odds))

    def pair_counts(self, emission: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Marginals and the expected number of each transition over all tokens."""
        t = np.exp(trans)
        x = self.lay(np.exp(np.clip(emission, -30, 30)))
        before, after = self.messages(x, t)
        w01, w10, w11 = t[0, 1] * x * after, t[1, 0] * before, t[1, 1] * before * x * after
        total = t[0, 0] + w01 + w10 + w11
        share = [[np.full_like(x, t[0, 0]), w01], [w10, w11]]
        pairs = np.array([[self.lift(v / total).sum() for v in row] for row in share])
        return self.lift((w01 + w11) / total), pairs


@dataclass
class ToxicField:
    """Trained weights: feature -> weight of the inside state, transitions, score."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -3.0
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    score: tuple[float, float, float] = (-3.0, 0.0, 0.0)
    by: dict[str, dict[str, float]] = field(default_factory=dict, repr=False)  # weights by kind of feature

    def emissions(self, words: list[str], cache: dict[str, float]) -> np.ndarray:
        """Weight of the inside state for each word: bias plus its features' weights."""
        if not self.by:
            for f, v in self.weights.items():
                self.by.setdefault(f[0], {})[f[1:]] = v
        w, e = self.by.get("w", {}).get, self.by.get("e", {}).get
        starts = [(k, self.by[str(k)].get) for k in BEGINNINGS if str(k) in self.by]
        for x in set(words).difference(cache):
            v, n = self.bias + w(x, 0.0) + e(x[-3:], 0.0), len(x)
            for k, start in starts:
                if n <= k:
                    break
                v += start(x[:k], 0.0)
            cache[x] = v
        return np.array([cache[x] for x in words])

    def read(self, token_lists: list[list[str]], cache: dict[str, float] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Marginals of all tokens in a row, and each document's largest one and their sum."""
        cache = {} if cache is None else cache
        sizes = np.array([len(t) for t in token_lists], dtype=np.int64)
        e = self.emissions([w for t in token_lists for w in t], cache)
        p = Lattice(sizes).marginals(e, self.trans)
        top, mass = np.zeros(len(sizes)), np.zeros(len(sizes))
        some = np.flatnonzero(sizes)
        if len(some):
            starts = (np.cumsum(sizes) - sizes)[some]
            top[some], mass[some] = np.maximum.reduceat(p, starts), np.add.reduceat(np.where(p >= FLOOR, p, 0.0), starts)
        return p, top, mass

    def doc_score(self, top: np.ndarray, mass: np.ndarray) -> np.ndarray:
        a, b, c = self.score
        return 1 / (1 + np.exp(-(a + b * top + c * np.log1p(mass))))


def unlike(docs: list[list[str]], hashes: int = 4) -> list[int]:
    """Indices of documents without near copies of earlier ones: of documents
    that share a smallest five-word shingle hash, the first stays."""
    seen: list[set[int]] = [set() for _ in range(hashes)]
    keep = []
    for i, words in enumerate(docs):
        grams = {" ".join(words[k : k + 5]).encode() for k in range(max(1, len(words) - 4))}
        h = np.fromiter((xxhash.xxh64_intdigest(g) for g in grams), dtype=np.uint64, count=len(grams))
        least = [int((h * np.uint64(2 * k + 1) ^ (h >> np.uint64(7 * k + 3))).min()) for k in range(hashes)]
        if not any(m in s for m, s in zip(least, seen)):
            keep.append(i)
        for m, s in zip(least, seen):
            s.add(m)
    return keep


def _g2(a: int, n: int, b: int, m: int) -> float:
    """Likelihood ratio statistic of a hits in n against b in m, 0 unless the first rate is MIN_LIFT times the second."""
    if a < 3 or ((a + 0.5) / (n + 1)) / ((b + 0.5) / (m + 1)) < MIN_LIFT:
        return 0.0
    ea, eb = (a + b) * n / (n + m), (a + b) * m / (n + m)
    return 2 * (a * math.log(a / ea) + (b * math.log(b / eb) if b else 0.0))


def seeds(toxic: list[list[str]], clean: list[list[str]]) -> set[str]:
    """Features tied to toxic documents by their document frequencies.

    Words and beginnings of four letters or more with STRONG_G2 are taken; further
    ones one after the other, the strongest first, judged on the toxic documents
    that none taken so far explains.  Near copies must have been left out."""

    def marks(words: list[str]) -> set[str]:
        return {f for w in set(words) for f in features(w) if f[0] not in "e3"}

    often = Counter(f for words in toxic for f in marks(words))
    often = {f for f, k in often.items() if k > 2}  # rarer ones can't pass; only these are kept in memory
    miss = Counter(f for words in clean for f in marks(words) & often)
    m = max(1, len(clean))
    where: dict[str, set[int]] = {}
    for i, words in enumerate(toxic):
        for f in marks(words) & often:
            where.setdefault(f, set()).add(i)
    n = len(toxic)
    where = {f: d for f, d in where.items() if _g2(len(d), n, miss.get(f, 0), m) >= MIN_G2}
    out = {f for f, d in where.items() if _g2(len(d), n, miss.get(f, 0), m) >= STRONG_G2}
    left = set(range(n)).difference(*(where[f] for f in out))
    where = {f: d & left for f, d in where.items() if f not in out}
    while where:
        best = max(where, key=lambda f: (_g2(len(where[f]), len(left), miss.get(f, 0), m), f))
        if _g2(len(where[best]), len(left), miss.get(best, 0), m) < MIN_G2:
            break
        out.add(best)
        gone = where.pop(best)
        left -= gone
        where = {f: d - gone for f, d in where.items() if len(d) > 2}
    return out


def fit(texts: list[str], labels: list[int], rounds: int = 30) -> ToxicField:
    """Field, and document score, from labelled documents; deterministic."""
    docs = [tokens(t) for t in texts]
    y = np.array(labels)
    single = np.array(unlike(docs))
    marked = seeds([docs[i] for i in single if y[i]], [docs[i] for i in single if not y[i]])
    model = ToxicField()
    if not marked:
        return model
    pick = [i for t, most in ((1, CHAIN_TOXIC), (0, CHAIN_CLEAN)) for i in single[y[single] == t][:most]]
    words = [w for i in pick for w in docs[i]]
    spot: dict[str, int] = {}
    word_of = np.fromiter((spot.setdefault(w, len(spot)) for w in words), dtype=np.int64, count=len(words))
    vocab = list(spot)
    names: dict[str, int] = {}
    inside = np.array([any(f in marked for f in features(w)) for w in vocab])
    # weights exist for features of tokens labelled inside; the rest shares the bias
    use = {f for w, i in zip(vocab, inside) if i for f in features(w)}
    pair_word, pair_feat = [], []
    for i, w in enumerate(vocab):
        for f in features(w):
            if f in use:
                pair_word.append(i)
                pair_feat.append(names.setdefault(f, len(names)))
    pair_word, pair_feat = np.array(pair_word), np.array(pair_feat)
    sizes = np.array([len(docs[i]) for i in pick])
    lattice = Lattice(sizes)
    toxic_doc = np.repeat(y[pick] == 1, sizes)
    gold = (inside[word_of] & toxic_doc).astype(float)
    prev = np.concatenate([[0.0], gold[:-1]])
    prev[(np.cumsum(sizes) - sizes)[sizes > 0]] = 0.0
    seen = np.array([[((1 - prev) * (1 - gold)).sum(), ((1 - prev) * gold).sum()], [(prev * (1 - gold)).sum(), (prev * gold).sum()]])
    theta = np.zeros(len(names) + 5)  # weights, bias, transitions
    theta[len(names)] = -3.0
    mean, power = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        w, bias, trans = theta[: len(names)], theta[len(names)], theta[-4:].reshape(2, 2)
        by_word = bias + np.bincount(pair_word, w[pair_feat], len(vocab))
        p, pairs = lattice.pair_counts(by_word[word_of], trans)
        gap = np.bincount(word_of, gold - p, len(vocab))
        grad = np.concatenate([np.bincount(pair_feat, gap[pair_word], len(names)), [gap.sum()], (seen - pairs).ravel()])
        grad = -grad + 0.05 * theta
        mean, power = 0.8 * mean + 0.2 * grad, 0.95 * power + 0.05 * grad * grad
        theta -= 0.4 * (mean / (1 - 0.8**step)) / (np.sqrt(power / (1 - 0.95**step)) + 1e-8)
    model.weights = {f: float(theta[i]) for f, i in names.items()}
    model.bias, model.trans = float(theta[len(names)]), theta[-4:].reshape(2, 2).copy()
    del words, word_of, gold, prev, lattice
    parts = [model.read(docs[a : a + 200])[1:] for a in range(0, len(docs), 200)]
    top, mass = (np.concatenate(x) for x in zip(*parts))
    x = np.column_stack([np.ones(len(y)), top, np.log1p(mass)])
    beta = np.array([-2.0, 3.0, 0.5])
    for _ in range(25):  # Newton steps of a ridge logistic regression
        q = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (q * (1 - q))[:, None]).T @ x + 1e-1 * np.eye(3)
        beta = beta + np.linalg.solve(h, x.T @ (y - q) - 1e-1 * beta)
    model.score = tuple(float(b) for b in beta)
    return model


def stretches(text: Column) -> Column:
    """A text of up to TRAIN_CHARS characters; of a longer one, whole words of TRAIN_STRETCHES
    stretches evenly spread from its start to its end."""
    size, k = TRAIN_CHARS // TRAIN_STRETCHES, TRAIN_STRETCHES - 1
    starts = [F.floor((F.length(text) - size) * F.lit(i) / F.lit(k)).cast("int") + 1 for i in range(TRAIN_STRETCHES)]
    parts = [F.regexp_replace(F.substring(text, at, F.lit(size)), r"^\w+\W|\W\w+$", "") for at in starts]
    return F.when(F.length(text) > TRAIN_CHARS, F.concat_ws("\n", *parts)).otherwise(text)


def training_sample(docs: DataFrame, labels: DataFrame) -> tuple[list[str], list[int]]:
    """Texts and labels of at most TRAIN_TOXIC and TRAIN_CLEAN labelled documents
    outside the held-out fold, chosen and ordered by a hash of the id, so that the
    first few of them are a sample too.  Ids with both labels are not used; of
    documents that share an id the smallest text is used."""
    key = F.xxhash64(F.lit(5), F.col("doc_id"))
    ids = (
        labels.where(F.col("toxic").isin(0, 1) & (fold_of(F.col("doc_id")) != 0))
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("_y"), F.max("toxic").alias("_z"))
        .where(F.col("_y") == F.col("_z"))
        .join(docs.select("doc_id"), "doc_id", "left_semi")
    )
    order = [key, F.col("doc_id")]
    chosen = None
    for label, most in ((1, TRAIN_TOXIC), (0, TRAIN_CLEAN)):
        part = ids.where(F.col("_y") == label).orderBy(*order).limit(most).select("doc_id", "_y")
        chosen = part if chosen is None else chosen.unionAll(part)
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")  # at most TRAIN_TOXIC + TRAIN_CLEAN ids
        .withColumn("text", stretches(F.col("text")))
        .groupBy("doc_id", "_y")
        .agg(F.min("text").alias("text"))
        .withColumn("_h", key)
        .collect()
    )
    rows.sort(key=lambda r: (-r["_y"], r["_h"], r["doc_id"]))
    return [r["text"] or "" for r in rows], [r["_y"] for r in rows]


def train(docs: DataFrame, labels: DataFrame) -> ToxicField:
    """Field fitted on the sample; without toxic labels, one that rejects nothing."""
    texts, y = training_sample(docs, labels)
    return fit(texts, y) if any(y) and not all(y) else ToxicField()


def spans_of(text: str, p: np.ndarray) -> list[dict]:
    """Offending stretches of a text: start and end offsets (code points of the
    text) and the largest marginal, for runs of tokens at 0.5 or more."""
    out: list[dict] = []
    run = -2
    for k, m in enumerate(_TOKEN.finditer(text.lower() if "\u0130" not in text else text)):
        if p[k] < 0.5:
            continue
        if run == k - 1:
            out[-1]["end"], out[-1]["p"] = m.end(), max(out[-1]["p"], float(p[k]))
        else:
            out.append({"start": m.start(), "end": m.end(), "p": float(p[k])})
        run = k
    return out


def score_docs(docs: DataFrame, model: ToxicField, with_spans: bool = False) -> DataFrame:
    """``docs`` (with ``text``) plus ``score`` and, if asked for, ``spans``.

    Null and empty texts have no tokens and get the score of none.  Other
    columns pass through; own columns named like the results are replaced."""
    docs = docs.drop("score", "spans")
    schema = plus(docs.schema, score="double")
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
    if with_spans:
        schema = plus(schema, spans="array<struct<start:int,end:int,p:double>>")
    cache: dict[str, float] = {}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if len(cache) > CACHE:
            cache.clear()
        texts = batch.column("text").to_pylist()
        lists = [tokens(t) for t in texts]
        p, top, mass = model.read(lists, cache)
        cols = [*batch.columns, pa.array(model.doc_score(top, mass), pa.float64())]
        names = [*batch.schema.names, "score"]
        if with_spans:
            ends = np.cumsum([len(x) for x in lists])
            found = [spans_of(t, p[b - len(w) : b]) if top[i] >= 0.5 else [] for i, (t, w, b) in enumerate(zip(texts, lists, ends))]
            cols.append(pa.array(found, kind))
            names.append("spans")
        return pa.RecordBatch.from_arrays(cols, names=names)

    return map_texts(docs, run, schema)


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Contract rows: doc_id, held_out, score, predicted for every document, and the spans."""
    out = score_docs(docs.select("doc_id", "text"), train(docs, labels), with_spans=True)
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans"
    )

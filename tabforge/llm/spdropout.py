"""Piece encoding with seeded merge dropout, and lossless decoding.

The vocabulary is a public piece model with byte fallback; its path is a
parameter.  A text gets a space in front, spaces become the piece space mark,
and each stretch "marks + following characters" is segmented on its own (no
piece has a mark after another character).  Segmentation is the usual agenda:
of all neighbouring pairs whose concatenation is a piece, merge the one with
the best score, the leftmost on ties, until none is left.  With dropout each
candidate (a span and its split point) carries a keyed hash of the seed, the
document (its id and text), the stretch's number in the document and the offsets;
candidates whose hash falls below the rate are skipped.  So every occurrence of a
word has draws of its own, and the same seed always gives the same segmentation.

What occurrences share is work, never draws: the agenda's next candidate depends
only on the stretch and on which candidates were skipped so far, so each stretch
has a tree of these decisions, grown as occurrences need it.  An occurrence walks
down by its own hashes; where the tree ends, the agenda runs for it.
Characters outside the vocabulary, and the space mark itself where a text
holds it literally, are written as byte pieces, so decoding gives back the
exact text.

The agenda runs on many stretches at once in numpy, one candidate each a
round; stretches of over LONG characters use a heap, once an occurrence.
"""

from __future__ import annotations

import heapq
import os
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import free_name, map_texts, plus

#: Default place of the public piece model; pass another path to the functions.
MODEL_PATH = os.environ.get("TABFORGE_PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
MARK = "▁"
#: Stretches up to this length are merged in numpy, longer ones with a heap.
LONG = 48
#: Distinct stretches, and decisions in their trees, that a task keeps at most before it starts anew.
CACHE, NODES = 60_000, 600_000
#: Occurrences without a result yet from which one of each tree end runs first.
MANY = 16_384
_STRETCH = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_LINE_STRETCH = re.compile(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+")


class Pieces:
    """Piece table, pair table and scores read from a piece model."""

    def __init__(self, path: str = MODEL_PATH):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.unk = model.unk_id()
        self.text: list[str | None] = [None] * n
        self.raw: list[bytes] = [b""] * n
        self.byte_id = np.full(256, self.unk, dtype=np.int32)
        ids: dict[str, int] = {}
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value], self.raw[i] = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.text[i], self.raw[i] = piece, piece.replace(MARK, " ").encode()
                ids[piece] = i
        self.ids = ids
        score = np.array([model.get_score(i) for i in range(n)])
        self.order = np.unique(score, return_inverse=True)[1].astype(np.int64)  # higher is merged sooner
        self.char_id = np.full(0x110000, -1, dtype=np.int32)
        self.char_id[:128] = -2 - np.arange(128)
        for piece, i in ids.items():
            if len(piece) == 1:
                self.char_id[ord(piece)] = i
        self.line_free = not any("\n" in piece for piece in ids)  # then a line feed is a stretch of its own
        pairs = [
            (ids[p[:k]] << 32 | ids[p[k:]], i)
            for p, i in ids.items()
            for k in range(1, len(p))
            if p[:k] in ids and p[k:] in ids
        ]
        pairs.sort()
        # open addressing: a few vectorised probes find any pair
        size = 1 << (len(pairs) * 4).bit_length()
        self.mask = size - 1
        self.slot_key = np.full(size, -1, dtype=np.int64)
        self.slot_id = np.full(size, -1, dtype=np.int32)
        keys = np.array([k for k, _ in pairs], dtype=np.int64)
        merged = np.array([i for _, i in pairs], dtype=np.int32)
        home = self._home(keys)
        left = np.arange(len(keys))
        self.probes = 0
        while len(left):
            at = (home[left] + self.probes) & self.mask
            free = self.slot_key[at] < 0
            at_free, who = np.unique(at[free], return_index=True)
            put = left[free][who]
            self.slot_key[at_free], self.slot_id[at_free] = keys[put], merged[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            self.probes += 1

    def of_chars(self, text: str) -> np.ndarray:
        """Id of each character's own piece; without one, -2 - c for an ASCII
        character c (it becomes its byte piece in the end) and -1 for others."""
        return self.char_id[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]

    def _home(self, keys: np.ndarray) -> np.ndarray:
        h = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((h >> np.uint64(29)) & np.uint64(self.mask)).astype(np.int64)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Id of the piece that a and b make together, -1 where there is none."""
        key = a.astype(np.int64) << 32 | b.astype(np.int64)
        out = np.full(len(key), -1, dtype=np.int32)
        todo = np.flatnonzero((a >= 0) & (b >= 0))
        home = self._home(key[todo])
        for k in range(self.probes):
            at = (home + k) & self.mask
            found = self.slot_key[at]
            hit = found == key[todo]
            out[todo[hit]] = self.slot_id[at[hit]]
            on = ~hit & (found >= 0)
            todo, home = todo[on], home[on]
            if not len(todo):
                break
        return out


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def skipped(keys: np.ndarray, start: np.ndarray, mid: np.ndarray, end: np.ndarray, rate: float) -> np.ndarray:
    """Whether the candidate merge of [start, mid) and [mid, end) is dropped, by keyed hash."""
    if rate <= 0:
        return np.zeros(len(keys), dtype=bool)
    with np.errstate(over="ignore"):
        spot = (start.astype(np.uint64) << np.uint64(42)) ^ (mid.astype(np.uint64) << np.uint64(21)) ^ end.astype(np.uint64)
        h = _mix(keys ^ _mix(spot + np.uint64(0x9E3779B97F4A7C15)))
    return (h >> np.uint64(11)).astype(np.float64) / 2.0**53 < rate


def place_keys(doc_keys: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Key of each occurrence from its document's key and its number in the document."""
    with np.errstate(over="ignore"):
        return _mix(doc_keys ^ _mix((places.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)))


def stretch_key(stretch: str, seed: int, variant: int) -> int:
    return xxhash.xxh64_intdigest(stretch.encode("utf-8", "surrogatepass"), seed * 1_000_003 + variant)


class Segmenter:
    """Ids of stretches under one seed and rate; keeps decision trees of up to CACHE stretches.

    A node is a candidate (``spot``, its offsets packed) or a result (-1 - its slot);
    ``edge`` 2 n and 2 n + 1 lead on from node n where the candidate is merged and
    skipped, 0 where nothing is known yet.  A stretch starts at edge 2 n of a node of its own.
    With ``shared``, a document's key is a small number and occurrences of a stretch in
    documents of equal number share one key."""

    def __init__(self, pieces: Pieces, rate: float, seed: int, shared: bool = False):
        self.pieces, self.rate, self.seed, self.shared = pieces, rate, seed, shared
        self.cut = (_LINE_STRETCH if pieces.line_free else _STRETCH).findall
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.edge, self.spot, self.nodes = np.zeros(1 << 13, dtype=np.int32), np.zeros(1 << 12, dtype=np.int32), 1
        self.flat, self.bounds = np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)

    def grow(self, n: int) -> np.ndarray:
        """``n`` new nodes."""
        at = np.arange(self.nodes, self.nodes + n)
        self.nodes += n
        while self.nodes > len(self.spot):
            self.edge = np.concatenate([self.edge, np.zeros_like(self.edge)])
            self.spot = np.concatenate([self.spot, np.zeros_like(self.spot)])
        return at

    def symbols(self, stretch: str) -> list[int]:
        return self.pieces.of_chars(stretch).tolist()

    def by_heap(self, stretch: str, key: int) -> list[tuple[int, int, int]]:
        """Agenda with a heap: (start, end, id or -1) of the final symbols."""
        p = self.pieces
        sym = self.symbols(stretch)
        n = len(sym)
        ends, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), [*range(1, n), -1]
        alive = [True] * n
        agenda: list[tuple[float, int, int, int, int]] = []

        def propose(lefts: list[int]) -> None:
            lefts = [i for i in lefts if i >= 0 and after[i] >= 0]
            if not lefts:
                return
            rights = [after[i] for i in lefts]
            got = p.merged(np.array([sym[i] for i in lefts]), np.array([sym[i] for i in rights]))
            drop = skipped(
                np.full(len(lefts), key, dtype=np.uint64), np.array(lefts), np.array(rights), np.array([ends[i] for i in rights]), self.rate
            )
            for i, j, m, d in zip(lefts, rights, got, drop):
                if m >= 0 and not d:
                    heapq.heappush(agenda, (-int(p.order[m]), i, j, ends[j], int(m)))

        propose(list(range(n)))
        while agenda:
            _, i, j, end, m = heapq.heappop(agenda)
            if not (alive[i] and alive[j]) or after[i] != j or ends[j] != end:
                continue
            sym[i], ends[i], alive[j] = m, end, False
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            propose([before[i], i])
        return [(i, ends[i], sym[i]) for i in range(n) if alive[i]]

    def in_rows(self, stretches: list[str], keys: np.ndarray, trace: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Agenda on many stretches at once: (symbols, start offsets, bounds of each stretch).
        ``trace`` takes each round's stretches, packed candidates and whether they were skipped.

        All symbols lie in one flat array linked to their neighbours.  Each round
        takes every stretch's best candidate (order of score, then leftmost, in
        one integer), merges it and looks up the two new neighbours, or skips it."""
        p = self.pieces
        sizes = np.array([len(s) for s in stretches])
        first = np.cumsum(sizes) - sizes
        n = int(sizes.sum())
        sym = p.of_chars("".join(stretches))
        word = np.repeat(np.arange(len(stretches)), sizes)
        offset = np.arange(n) - first[word]
        end = offset + 1
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[first + sizes - 1], before[first] = -1, -1
        merged = np.full(n, -1, dtype=np.int32)
        order = np.full(n, -1, dtype=np.int64)
        alive = np.ones(n, dtype=bool)

        def look(at: np.ndarray) -> None:
            right = after[at]
            m = p.merged(sym[at], sym[right])
            merged[at] = m
            order[at] = np.where(m >= 0, p.order[m] * (LONG + 1) + (LONG - offset[at]), -1)

        look(np.flatnonzero(after >= 0))
        live = np.arange(len(stretches))
        while len(live):
            if len(live) == len(stretches):
                best = np.maximum.reduceat(order, first)
            else:
                size = sizes[live]
                ends = np.cumsum(size)
                span = np.arange(ends[-1]) + np.repeat(first[live] - (ends - size), size)
                best = np.maximum.reduceat(order[span], ends - size)
            live, best = live[best >= 0], best[best >= 0]
            if not len(live):
                break
            at = first[live] + LONG - best % (LONG + 1)
            gone = after[at]
            drop = skipped(keys[live], offset[at], offset[gone], end[gone], self.rate)
            if trace is not None:
                trace.append((live, offset[at] << 12 | offset[gone] << 6 | end[gone], drop))
            order[at[drop]] = -1  # a candidate does not come again
            at, gone = at[~drop], gone[~drop]
            sym[at], end[at] = merged[at], end[gone]
            alive[gone], order[gone], order[at] = False, -1, -1
            then = after[gone]
            after[at] = then
            has = then >= 0
            before[then[has]] = at[has]
            left = before[at]
            look(np.concatenate([at[has], left[left >= 0]]))
        bounds = np.concatenate([[0], np.cumsum(np.add.reduceat(alive.astype(np.int64), first))])
        sym = sym[alive]
        single = sym < -1
        sym[single] = p.byte_id[-2 - sym[single]]
        return sym, offset[alive], bounds

    def bytes_of(self, chars: str) -> list[int]:
        return [int(self.pieces.byte_id[b]) for b in chars.encode()]

    def run(self, stretches: list[str], keys: np.ndarray, trace: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of short stretches, and how many each has."""
        sym, offset, bounds = self.in_rows(stretches, keys, trace)
        sizes = np.diff(bounds)
        odd = np.flatnonzero(np.logical_or.reduceat(sym < 0, bounds[:-1]))
        if not len(odd):
            return sym, sizes
        parts, at = [], 0
        for i in odd:
            a, b = bounds[i], bounds[i + 1]
            cuts = offset[a:b].tolist()
            spelled = self._spell(stretches[i], zip(cuts, [*cuts[1:], len(stretches[i])], sym[a:b]))
            parts += [sym[at:a], np.array(spelled, dtype=np.int32)]
            at, sizes[i] = b, len(spelled)
        return np.concatenate([*parts, sym[at:]]), sizes

    def learn(self, stretches: list[str], keys: np.ndarray, edges: np.ndarray, depths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Run the agenda for occurrences that came to open ``edges`` after ``depths`` decisions;
        the first to come to an edge adds its further decisions to the tree."""
        ids, sizes = [], []
        for a in range(0, len(stretches), 8192):
            part = slice(a, a + 8192)
            trace: list = []
            got, size = self.run(stretches[part], keys[part], trace)
            ids.append(got)
            sizes.append(size)
            link, depth = edges[part].copy(), depths[part]
            first = np.zeros(len(link), dtype=bool)
            first[np.unique(link, return_index=True)[1]] = True
            first &= self.edge[link] == 0
            for t, (live, spot, drop) in enumerate(trace):
                on = first[live] & (depth[live] <= t)
                who = live[on]
                at = self.grow(len(who))
                self.edge[link[who]], self.spot[at] = at, spot[on]
                link[who] = 2 * at + drop[on]
            who = np.flatnonzero(first)
            at = self.grow(len(who))
            self.edge[link[who]] = at
            self.spot[at] = -1 - (len(self.bounds) - 1 + np.arange(len(who)))
            starts = np.cumsum(size) - size
            self.add(got[_ranges(starts[who], size[who])], size[who])
        return np.concatenate(ids), np.concatenate(sizes)

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.flat = np.concatenate([self.flat, ids])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(sizes)])

    def _spell(self, stretch: str, symbols) -> list[int]:
        out: list[int] = []
        for a, b, i in symbols:
            if i >= 0:
                out.append(int(i))
            elif i < -1:
                out.append(int(self.pieces.byte_id[-2 - i]))
            else:
                out.extend(self.bytes_of(stretch[a:b]))
        return out

    def encode(self, texts: list[str | None], doc_keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts and the bounds of each text's part."""
        if len(self.known) > CACHE or self.nodes > NODES:
            self.clear()
        words, counts = [], []
        for text in texts:
            before = len(words)
            if text:
                head, *more = text.split(MARK) if MARK in text else (text,)
                words += self.cut((" " + head).replace(" ", MARK))
                for part in more:  # a literal mark is the stretch "", spelled in bytes
                    words.append("")
                    words += self.cut(part.replace(" ", MARK))
            counts.append(len(words) - before)
        starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        keys = self.keys_of(words, doc_keys, starts)
        known = self.known
        fresh = [w for w in dict.fromkeys(words) if w not in known]
        short = [w for w in fresh if 0 < len(w) <= LONG]
        known.update(zip(short, (2 * self.grow(len(short))).tolist()))
        edges = np.array([known.get(w, -1) for w in words], dtype=np.int64)
        slots = np.zeros(len(words), dtype=np.int64)
        own_ids, own_sizes, own = [], [], 0  # results of single occurrences: slots -1, -2, ...

        def single(who: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
            nonlocal own
            slots[who] = -1 - np.arange(own, own + len(who))
            own += len(who)
            own_ids.append(ids)
            own_sizes.append(sizes)

        for i in np.flatnonzero(edges < 0):
            w = words[i]
            ids = self._spell(w, self.by_heap(w, int(keys[i]))) if w else [int(self.pieces.byte_id[b]) for b in MARK.encode()]
            single(np.array([i]), np.array(ids, dtype=np.int32), np.array([len(ids)]))
        depths = np.zeros(len(words), dtype=np.int64)
        todo = np.flatnonzero(edges >= 0)
        while len(todo):
            stuck = self.walk(todo, edges, depths, keys, slots)
            todo = stuck
            if not len(stuck):
                break
            if len(stuck) > MANY:  # one of each end first, the others walk on
                stuck = stuck[np.unique(edges[stuck], return_index=True)[1]]
                self.learn([words[i] for i in stuck], keys[stuck], edges[stuck], depths[stuck])
            else:
                single(stuck, *self.learn([words[i] for i in stuck], keys[stuck], edges[stuck], depths[stuck]))
                break
        total = self.bounds[-1]
        flat = np.concatenate([self.flat, *own_ids])
        own_bounds = total + np.cumsum(np.concatenate([np.zeros(1, dtype=np.int64), *own_sizes]))
        low = np.concatenate([self.bounds[:-1], own_bounds[:-1][::-1]])  # slot -1 is the last
        high = np.concatenate([self.bounds[1:], own_bounds[1:][::-1]])
        first, size = low[slots], (high - low)[slots]
        ids = flat[_ranges(first, size)]
        return ids, np.concatenate([[0], np.cumsum(size)])[starts].astype(np.int64)

    def keys_of(self, words: list[str], doc_keys: list[int], starts: np.ndarray) -> np.ndarray:
        if self.shared:
            of_doc = np.repeat(np.asarray(doc_keys, dtype=np.int64), np.diff(starts)).tolist()
            return np.array([stretch_key(w, self.seed, v) for w, v in zip(words, of_doc)], dtype=np.uint64)
        counts = np.diff(starts)
        place = np.arange(len(words)) - np.repeat(starts[:-1], counts)
        return place_keys(np.repeat(np.asarray(doc_keys, dtype=np.int64).view(np.uint64), counts), place)

    def walk(self, who: np.ndarray, edges: np.ndarray, depths: np.ndarray, keys: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Lead occurrences down their trees; those that come to an open end."""
        stuck = []
        while len(who):
            node = self.edge[edges[who]]
            met = node > 0
            stuck.append(who[~met])
            who, node = who[met], node[met]
            spot = self.spot[node]
            done = spot < 0
            slots[who[done]] = -1 - spot[done].astype(np.int64)
            who, node, spot = who[~done], node[~done], spot[~done]
            drop = skipped(keys[who], spot >> 12, spot >> 6 & 63, spot & 63, self.rate)
            edges[who] = 2 * node.astype(np.int64) + drop
            depths[who] += 1
        return np.concatenate(stuck) if stuck else who


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All indexes first, first + 1, ... of each of the ranges."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - (ends - size), size)


def decode(ids: list[int], pieces: Pieces) -> str:
    """Text of the ids: piece texts and bytes in order, without the space put in front."""
    raw = b"".join([pieces.raw[i] for i in ids])
    return raw.decode("utf-8")[1:] if raw else ""


_LOADED: dict[str, Pieces] = {}


def load(path: str = MODEL_PATH) -> Pieces:
    """The model's tables, read once a process."""
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def encode_docs(
    docs: DataFrame,
    path: str = MODEL_PATH,
    rate: float = 0.1,
    seed: int = 13,
    variants: int | None = None,
    id_col: str = "doc_id",
    copy_col: str | None = None,
) -> DataFrame:
    """``docs`` (with ``text`` and an id) plus ``pieces`` (array of ids), ``n_pieces``
    and ``lossless`` (whether decoding gave the text back).

    Null texts: null pieces, 0 and true.  Empty texts: no pieces.  Every occurrence of
    a word is segmented by draws of its own.  Rows of equal id and text get equal
    results, unless ``copy_col`` (not returned) tells them apart.  With ``variants``,
    only that many segmentations of a stretch are made, shared by all documents.
    Columns of ``docs`` named like the results are replaced; others pass through."""
    names = ["pieces", "n_pieces", "lossless"]
    docs = docs.drop(*names)
    if variants is None:
        told_apart = [F.col(id_col), F.col("text"), *([F.col(copy_col)] if copy_col else [])]
        key = F.xxhash64(F.lit(seed), *told_apart)
    else:
        key = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(variants))
    own_key = free_name(docs, "_doc_key")
    given = docs.withColumn(own_key, key).drop(*([copy_col] if copy_col else []))
    kept = [c for c in given.columns if c != own_key]
    schema = plus(given.drop(own_key).schema, pieces="array<int>", n_pieces="bigint", lossless="boolean")
    state: dict[str, Segmenter] = {}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if "s" not in state:
            state["s"] = Segmenter(load(path), rate, seed, shared=variants is not None)
        seg = state["s"]
        texts = batch.column("text").to_pylist()
        ids, bounds = seg.encode(texts, batch.column(own_key).to_pylist())
        same = []
        raw = seg.pieces.raw
        for t, a, b in zip(texts, bounds[:-1], bounds[1:]):
            back = b"".join([raw[i] for i in ids[a:b].tolist()])
            same.append(t is None or back == ((" " + t).encode() if t else b""))
        null = np.array([t is None for t in texts])
        offsets = pa.array(bounds.astype(np.int32), mask=np.append(null, False)) if null.any() else pa.array(bounds.astype(np.int32))
        lists = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))
        cols = [batch.column(c) for c in kept]
        cols += [lists, pa.array(np.diff(bounds), pa.int64()), pa.array(same, pa.bool_())]
        return pa.RecordBatch.from_arrays(cols, names=[*kept, *names])

    return map_texts(given, run, schema)


def decode_docs(encoded: DataFrame, path: str = MODEL_PATH) -> DataFrame:
    """``encoded`` plus ``decoded``: the text of ``pieces`` (null where they are null)."""
    encoded = encoded.drop("decoded")

    def run(batches):
        pieces = load(path)
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                texts = [None if x is None else decode(x, pieces) for x in part.column("pieces").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "decoded"])

    return encoded.mapInArrow(run, plus(encoded.schema, decoded="string"))

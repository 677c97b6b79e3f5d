"""Sampled SentencePiece segmentations, and lossless decoding.

All ways to cut a text into pieces of a vocabulary form a lattice. Forward
filtering sums, for each place, the weights of all ways to reach it; backward
sampling then draws the last piece by its share, the one before it, and so on:
an exact draw from all segmentations, each as likely as the product of its
pieces' weights. The draws are hashes of the row's key and the place in the
text, so a row's segmentation is the same wherever and whenever it is made.

No piece crosses the start of a run of spaces, so the lattice falls apart into
segments; a segment seen before is not filtered again, and all occurrences of a
slice of texts are sampled together, piece by piece, on arrays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annalist.llm.arrays import SpanHashes, distinct_spans, joined_points, mix, slices, spans_equal, string_texts

#: How the vocabulary writes a space; the character itself is encoded by its bytes.
SPACE = 0x2581
_LITERAL = 0x110000


class Vocabulary:
    """The pieces of a model file, their weights, and the bytes they stand for.

    ``alpha`` scales log weights: 0 makes all segmentations equally likely,
    large values prefer the best. A BPE file scores a piece by minus its rank,
    which is read as the weight ``1 / (2 + rank)``; scores of a unigram file are
    log probabilities already.
    """

    def __init__(self, path: str, alpha: float = 1.0):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        scores = np.array([model.get_score(i) for i in range(size)])
        normal = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        ranked = len(normal) > 1 and np.all(scores[normal] == np.round(scores[normal]))
        weights = -np.log(2 + np.minimum(-scores, size)) if ranked else scores
        self.byte_ids = np.zeros(256, dtype=np.int32)
        for i in range(size):
            if model.is_byte(i):
                self.byte_ids[int(names[i][1:-1], 16)] = i
        self.byte_weight = alpha * float(min(weights[normal]))
        if any(chr(SPACE) in names[i].lstrip(chr(SPACE)) for i in normal):
            raise ValueError("a piece holds a space inside; segments would depend on each other")
        codes, starts = joined_points([names[i] for i in normal])
        hashes = SpanHashes(codes).get(starts[:-1], starts[1:] - 1)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], np.array(normal, dtype=np.int32)[order]
        if np.any(self.hashes[1:] == self.hashes[:-1]):
            raise ValueError("two pieces share a hash")
        self.piece_codes, self.piece_starts = codes, starts[order]
        self.weights = alpha * weights[self.ids]
        # Most spans are no piece: one look tells nearly always.
        self.maybe = np.zeros(1 << 21, dtype=bool)
        self.maybe[self.hashes >> np.uint64(43)] = True
        self.longest = max(len(names[i]) for i in normal)
        self.single = np.zeros(_LITERAL + 1, dtype=bool)
        self.single[[ord(names[i]) for i in normal if len(names[i]) == 1]] = True
        # Characters that are part of no longer piece stand alone.
        self.joins = np.zeros(_LITERAL + 1, dtype=bool)
        self.joins[[ord(c) for c in set("".join(names[i] for i in normal if len(names[i]) > 1))]] = True
        self.single[_LITERAL] = self.joins[_LITERAL] = False
        texts = [b""] * size
        for i in normal:
            texts[i] = names[i].replace(chr(SPACE), " ").encode()
        for value, i in enumerate(self.byte_ids.tolist()):
            texts[i] = bytes([value])
        self.text_sizes = np.fromiter(map(len, texts), np.int64, size)
        self.text_starts = np.cumsum(self.text_sizes) - self.text_sizes
        self.text_bytes = np.frombuffer(b"".join(texts), dtype=np.uint8)

    def edges(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
        """Pieces in segments that lie in ``codes`` one after the other: from, size, weight, id (-1: its bytes)."""
        segment_end = np.repeat(end, end - start)
        at = np.arange(len(codes))
        hashes = SpanHashes(codes)
        parts = []
        for size in range(1, self.longest + 1):
            at = at[at + size <= segment_end[at]]
            if not len(at):
                break
            wanted = hashes.get(at, at + size)
            likely = np.flatnonzero(self.maybe[wanted >> np.uint64(43)])
            place = np.minimum(np.searchsorted(self.hashes, wanted[likely]), len(self.hashes) - 1)
            known = self.hashes[place] == wanted[likely]
            place, start_at = place[known], at[likely[known]]
            # A hash only names the piece a span could be.
            same = spans_equal(codes, start_at, np.full(len(place), size), self.piece_codes, self.piece_starts[place])
            place, start_at = place[same], start_at[same]
            parts.append((start_at, np.full(len(place), size), self.weights[place], self.ids[place]))
        alone = np.flatnonzero(~self.single[codes])
        points = np.where(codes[alone] == _LITERAL, SPACE, codes[alone])
        sizes = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        parts.append((alone, np.ones(len(alone), np.int64), self.byte_weight * sizes, np.full(len(alone), -1, np.int32)))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


_vocabularies: dict[tuple[str, float], Vocabulary] = {}
#: Texts worked on at once, in bytes.
_SLICE = 1 << 19


def vocabulary(path: str, alpha: float) -> Vocabulary:
    """The vocabulary of this process for a file."""
    if (path, alpha) not in _vocabularies:
        _vocabularies[path, alpha] = Vocabulary(path, alpha)
    return _vocabularies[path, alpha]


def _filtered(words: Vocabulary, codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Lattices of segments that lie in ``codes`` one after the other.

    A segment has a node before each character and one behind the last. Returns
    the first edge of each node, and of each edge, which stand together by the
    node they reach: the cumulative share, the id and the number of characters.
    """
    end = np.cumsum(sizes)
    start = end - sizes
    source, length, weight, ids = words.edges(codes, start, end)
    segment = np.repeat(np.arange(len(sizes)), sizes)[source]
    target, step = source + segment + length, source - start[segment] + length
    nodes = len(codes) + len(sizes)
    order = np.argsort(step * nodes + target, kind="stable")
    target, step, length, weight, ids = target[order], step[order], length[order], weight[order], ids[order]
    source = target - length
    reach = np.full(nodes, -np.inf)
    reach[start + np.arange(len(sizes))] = 0.0
    first = np.flatnonzero(np.diff(target, prepend=-1) != 0)
    last = np.append(first, len(target))
    shares = np.empty(len(target))
    bounds = np.searchsorted(step[first], np.arange(1, (step[-1] if len(step) else 0) + 2))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        # All segments at once, one more character each time.
        lo, hi = last[a], last[b]
        if lo == hi:
            continue
        heads = first[a:b] - lo
        counts = np.diff(np.append(heads, hi - lo))
        ways = reach[source[lo:hi]] + weight[lo:hi]
        top = np.maximum.reduceat(ways, heads)
        parts = np.exp(ways - np.repeat(top, counts))
        sums = np.add.reduceat(parts, heads)
        reach[target[first[a:b]]] = top + np.log(sums)
        shares[lo:hi] = parts / np.repeat(sums, counts)
    cumulated = np.cumsum(shares)
    cumulated -= np.repeat(cumulated[first] - shares[first], np.diff(last))
    cumulated[last[1:] - 1] = 1.0
    edge = np.zeros(nodes, dtype=np.int64)
    edge[target[first]] = first
    return edge, cumulated.astype(np.float32), ids, length.astype(np.uint8)


class Lattices:
    """Filtered lattices of segments seen before, by content, of at most ``most`` segments and characters of some ten each."""

    def __init__(self, words: Vocabulary, most: int = 150_000):
        self.words, self.most = words, most
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.base = np.zeros(0, np.int64)
        self.edge = np.zeros(0, np.int64)
        self.share, self.ids, self.length = np.zeros(0, np.float32), np.zeros(0, np.int32), np.zeros(0, np.uint8)

    def get(self, codes: np.ndarray, start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The first node of each of some distinct segments; those not yet known are filtered now."""
        blob, width = codes.tobytes(), codes.itemsize
        contents = [blob[a:b] for a, b in zip((start * width).tolist(), ((start + sizes) * width).tolist(), strict=True)]
        if len(self.slots) + len(contents) > self.most or len(self.edge) > 12 * self.most:
            self._forget()
        slots = [self.slots.get(c, -1) for c in contents]
        new = np.array([i for i, slot in enumerate(slots) if slot < 0], dtype=np.int64)
        if len(new):
            own = sizes[new]
            inside = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
            edge, share, ids, length = _filtered(self.words, codes[np.repeat(start[new], own) + inside], own)
            known = len(self.base)
            self.base = np.concatenate([self.base, len(self.edge) + np.cumsum(own + 1) - own - 1])
            self.edge = np.concatenate([self.edge, edge + len(self.share)])
            self.share = np.concatenate([self.share, share])
            self.ids, self.length = np.concatenate([self.ids, ids]), np.concatenate([self.length, length])
            for place, i in enumerate(new.tolist()):
                slots[i] = self.slots[contents[i]] = known + place
        return self.base[np.array(slots, dtype=np.int64)]

    def draw(self, node: np.ndarray, draw: np.ndarray) -> np.ndarray:
        """The edge into each node whose share of the unit interval holds the draw."""
        edge = self.edge[node]
        open_ = np.flatnonzero(self.share[edge] <= draw)
        while len(open_):
            edge[open_] += 1
            open_ = open_[self.share[edge[open_]] <= draw[open_]]
        return edge


def _segments(words: Vocabulary, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of segments that no piece crosses; the code behind each text belongs to none."""
    cut = np.zeros(len(codes) + 1, dtype=bool)
    cut[starts] = True
    cut[starts[1:] - 1] = True
    space = codes == SPACE
    cut[1:-1] |= space[1:] & ~space[:-1]
    alone = ~words.joins[codes]
    cut[:-1] |= alone
    cut[1:] |= alone
    place = np.flatnonzero(cut)
    start, end = place[:-1], place[1:]
    real = ~np.isin(start, starts[1:] - 1, assume_unique=True)
    return start[real], end[real]


def sample(lattices: Lattices, texts: list[str], keys: np.ndarray) -> list[np.ndarray]:
    """The ids of one segmentation of each text, drawn by its key (unsigned 64 bit)."""
    words = lattices.words
    points, starts = joined_points(texts)
    codes = np.where(points == 32, SPACE, np.where(points == SPACE, _LITERAL, points)).astype(np.uint32)
    start, end = _segments(words, codes, starts)
    if not len(start):
        return [np.zeros(0, np.int32) for _ in texts]
    example, which = distinct_spans(codes, start, end)
    base = lattices.get(codes, start[example], (end - start)[example])[which]
    owner = np.searchsorted(starts, start, side="right") - 1
    chosen = np.full(len(codes), -2, dtype=np.int32)
    left, at, salt, offset = end - start, end, keys[owner], starts[owner]
    while len(left):
        # 24 bits of a hash of key and place: a uniform draw below 1.
        draw = (mix(salt + (at - offset).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.float32) * np.float32(2.0**-24)
        edge = lattices.draw(base + left, draw)
        chosen[at - 1] = lattices.ids[edge]
        length = lattices.length[edge]
        left, at = left - length, at - length
        more = left > 0
        left, at, base, salt, offset = left[more], at[more], base[more], salt[more], offset[more]
    place = np.flatnonzero(chosen > -2)
    ids = chosen[place]
    odd = np.flatnonzero(ids < 0)
    if len(odd):
        spelled = [chr(p).encode("utf-8", "surrogatepass") for p in points[place[odd]].tolist()]
        counts = np.ones(len(ids), dtype=np.int64)
        counts[odd] = [len(b) for b in spelled]
        ids, place = np.repeat(ids, counts), np.repeat(place, counts)
        ids[ids < 0] = words.byte_ids[np.frombuffer(b"".join(spelled), dtype=np.uint8)]
    bounds = np.searchsorted(place, starts)
    return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def decode(words: Vocabulary, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
    """Texts of lists of ids that lie one after the other."""
    lengths = words.text_sizes[ids]
    ends = np.concatenate(([0], np.cumsum(lengths)))
    blob = words.text_bytes[np.repeat(words.text_starts[ids] - ends[:-1], lengths) + np.arange(ends[-1])].tobytes()
    bounds = ends[np.concatenate(([0], np.cumsum(sizes)))]
    return [blob[a:b].decode("utf-8", "replace") for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def encoded(documents: DataFrame, path: str, id_column: str = "doc_id", text: str = "text", seed: int = 0, alpha: float = 1.0) -> DataFrame:
    """``row, ids``: the columns as they came and one sampled segmentation of each whole text.

    Rows of one id draw alike: equal texts then get equal ids. A null text gives
    no ids, as an empty one does. Any character can be encoded: those outside the
    vocabulary by their bytes.
    """
    place = documents.columns.index(text)
    schema = T.StructType([T.StructField("row", documents.schema), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches):
        lattices = Lattices(vocabulary(path, alpha))
        for batch in batches:
            rows, keys = batch.column(0), np.array(batch.column(1)).view(np.uint64)
            for start, stop, texts in string_texts(rows.field(place), _SLICE):
                lists = sample(lattices, texts, keys[start:stop])
                ends = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32)
                ids = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(lists).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([rows.slice(start, stop - start), ids], names=["row", "ids"])

    return documents.select(F.struct("*").alias("row"), F.xxhash64(F.lit(seed), F.col(id_column)).alias("key")).mapInArrow(run, schema)


def decoded(rows: DataFrame, ids: Column, path: str) -> DataFrame:
    """``row, text``: the columns as they came and the text that a list of ids stands for; a null list is empty."""
    schema = T.StructType([T.StructField("row", rows.schema), T.StructField("text", T.StringType())])

    def run(batches):
        words = vocabulary(path, 1.0)
        for batch in batches:
            lists = batch.column(1)
            sizes = np.array(pc.fill_null(pc.list_value_length(lists), 0), dtype=np.int64)
            for start, stop in slices(sizes, _SLICE // 2):
                ids = np.array(lists.slice(start, stop - start).flatten(), dtype=np.int64)
                texts = pa.array(decode(words, ids, sizes[start:stop]), pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), texts], names=["row", "text"])

    return rows.select(F.struct("*").alias("row"), ids.alias("ids")).mapInArrow(run, schema)

"""Alignment of two tokenizers over the same bytes.

Both cut one byte string, so each is a rising list of end offsets. Offsets in
both lists cut the tokens into groups that stand for the same bytes. They are
found by galloping: each end of the shorter list goes by exponential steps, then
by halving, to its place among the ends of the longer one. Places where the ends
are equal slice the groups, and differences of neighbouring places are the ranges
of tokens of the longer list that a token of the shorter one overlaps.

A link is a pair of tokens that end together. Counts of links over a corpus say
which token of one vocabulary stands for one of the other; as the bytes of one
token of a link end with those of the other, the number of different links is
bounded by the vocabularies, not by the corpus.
"""

from __future__ import annotations

import json
from collections import Counter

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annalist.llm.frames import stage, with_results
from annalist.llm.tokens import Encoder, byte_letters

#: How pieces write a space.
SPACE = "▁"
#: Tables of links with at most this many rows (24 bytes each) are broadcast.
BROADCAST_LINKS = 2_000_000
_INTS = T.ArrayType(T.IntegerType())
#: Texts worked on at once, in bytes, and words whose ids are kept.
SLICE = 1 << 18
WORDS = 250_000
#: What :func:`aligned` can give for each text.
RESULTS = {
    "n_a": T.LongType(),
    "n_b": T.LongType(),
    "n_groups": T.LongType(),
    "n_overlaps": T.LongType(),
    "a_ids": _INTS,
    "b_ids": _INTS,
    "a_cuts": _INTS,
    "b_cuts": _INTS,
    "links": T.ArrayType(T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])),
    "groups": T.StringType(),
}


def byte_level_tokens(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level BPE file."""
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    bytes_of = {letter: byte for byte, letter in byte_letters().items()}
    names = {**data["model"]["vocab"], **{t["content"]: t["id"] for t in data["added_tokens"]}}
    out = [b""] * (max(names.values()) + 1)
    for name, i in names.items():
        out[i] = bytes(bytes_of[c] for c in name) if all(c in bytes_of for c in name) else name.encode()
    return out


def piece_tokens(path: str) -> list[bytes]:
    """The bytes of each id of a piece model."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return [bytes([int(n[3:-1], 16)]) if model.is_byte(i) else n.replace(SPACE, " ").encode() for i, n in enumerate(names)]


class Spelling:
    """The bytes of the ids of a vocabulary, in one array."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.codes = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def spells(self, ids: list[np.ndarray], wanted: list[bytes]) -> np.ndarray:
        """Whether each list of ids, joined, gives the bytes wanted."""
        flat = np.concatenate([*ids, np.zeros(0, np.int64)]).astype(np.int64)
        own = self.sizes[flat]
        ends = np.concatenate(([0], np.cumsum(own)))
        first = np.concatenate(([0], np.cumsum([len(x) for x in ids])))
        sizes = np.fromiter(map(len, wanted), np.int64, len(wanted))
        good = ends[first[1:]] - ends[first[:-1]] == sizes
        spelled = self.codes[np.repeat(self.starts[flat] - ends[:-1], own) + np.arange(ends[-1])].tobytes()
        bounds = ends[first].tolist()
        return np.array([ok and spelled[a:b] == w for ok, a, b, w in zip(good.tolist(), bounds[:-1], bounds[1:], wanted, strict=True)], dtype=bool)


def galloped(short: np.ndarray, long: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """The first place in ``long`` that is not less than each value of ``short``, from a guess of it.

    Both rise, and no value of ``short`` is above the last of ``long``. Steps
    double away from the guess until the place lies between two of them, then the
    stretch is halved; all values go through these rounds together.
    """
    size = len(long)
    at = np.clip(guess, 0, max(size - 1, 0))
    # long[low] < value <= long[high]; -1 is below all.
    low, high = at.copy(), at.copy()
    active, step = np.flatnonzero(long[at] < short), 1
    while len(active):
        high[active] = np.minimum(low[active] + step, size - 1)
        less = long[high[active]] < short[active]
        active, step = active[less], step * 2
        low[active] = high[active]
    back, step = np.flatnonzero(long[at] >= short), 1
    while len(back):
        low[back] = np.maximum(high[back] - step, -1)
        more = (low[back] >= 0) & (long[low[back]] >= short[back])
        back, step = back[more], step * 2
        high[back] = low[back]
    open_ = np.flatnonzero(high - low > 1)
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        less = long[middle] < short[open_]
        low[open_[less]] = middle[less]
        high[open_[~less]] = middle[~less]
        open_ = open_[high[open_] - low[open_] > 1]
    return high


def common_ends(short: np.ndarray, long: np.ndarray, short_bounds: np.ndarray, long_bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of equal ends in both lists, and how many tokens of ``long`` each of ``short`` overlaps.

    The lists hold the ends in some texts, one after the other; the bounds are the
    first places of each text, one more at the end.
    """
    if not len(short):
        none = np.zeros(0, np.int64)
        return none, none, none
    sizes, others = np.diff(short_bounds), np.diff(long_bounds)
    inside = np.arange(len(short)) - np.repeat(short_bounds[:-1], sizes)
    guess = np.repeat(long_bounds[:-1], sizes) + inside * np.repeat(others, sizes) // np.repeat(np.maximum(sizes, 1), sizes)
    place = galloped(short, long, guess)
    hit = long[place] == short
    # A token reaches from behind the end before it: in the same token of long, or the next if both ended there.
    first = np.concatenate(([0], place[:-1] + hit[:-1]))
    return np.flatnonzero(hit), place[hit], place - first + 1


class Pair:
    """Both tokenizers of this process, and the strings that write ids in groups."""

    def __init__(self, path_a: str, path_b: str):
        self.coder = Encoder(path_a, WORDS, specials=False)
        self.model = sentencepiece.SentencePieceProcessor(model_file=path_b)
        tokens_a, tokens_b = byte_level_tokens(path_a), piece_tokens(path_b)
        self.a, self.b = Spelling(tokens_a), Spelling(tokens_b)
        self.most = max(len(tokens_a), len(tokens_b))
        self.written = np.array([f"{i}{gap}" for gap in ",|;" for i in range(self.most)], dtype=object)

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of each text by both; none if either does not spell a space and the text."""
        none = np.zeros(0, np.int64)
        spaced = [f" {t}" if t else "" for t in texts]
        ids_a = self.coder.encode(spaced)
        ids_b = [np.array(x, dtype=np.int64) for x in self.model.encode(texts, out_type=int, num_threads=1)]
        wanted = [t.encode() for t in spaced]
        good = (self.a.spells(ids_a, wanted) & self.b.spells(ids_b, wanted)).tolist()
        return [x if ok else none for x, ok in zip(ids_a, good, strict=True)], [x if ok else none for x, ok in zip(ids_b, good, strict=True)]


_pairs: dict[tuple[str, str], Pair] = {}


def _pair(path_a: str, path_b: str) -> Pair:
    if (path_a, path_b) not in _pairs:
        _pairs[path_a, path_b] = Pair(path_a, path_b)
    return _pairs[path_a, path_b]


def _lists(values: np.ndarray | pa.Array, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), values if isinstance(values, pa.Array) else pa.array(values.astype(np.int32)))


def _per_slice(texts: list[str], work: tuple[str, str, list[str]]):
    path_a, path_b, names = work
    pair = _pair(path_a, path_b)
    lists_a, lists_b = pair.encode(texts)
    bounds_a, bounds_b = (np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int64) for ids in (lists_a, lists_b))
    a, b = (np.concatenate([*ids, np.zeros(0, np.int64)]).astype(np.int64) for ids in (lists_a, lists_b))
    # Both spell the same bytes, so the ends of both go on alike from text to text.
    ends_a, ends_b = np.cumsum(pair.a.sizes[a]), np.cumsum(pair.b.sizes[b])
    drives = np.diff(bounds_a) <= np.diff(bounds_b)
    at_a, at_b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    overlaps = np.zeros(len(texts), dtype=np.int64)
    for chosen, short, long in ((drives, (ends_a, bounds_a), (ends_b, bounds_b)), (~drives, (ends_b, bounds_b), (ends_a, bounds_a))):
        # The texts in which one list is the shorter.
        own = [np.flatnonzero(np.repeat(chosen, np.diff(bounds))) for _, bounds in (short, long)]
        inner = [np.concatenate(([0], np.cumsum(np.diff(bounds)[chosen]))) for _, bounds in (short, long)]
        first, second, ranges = common_ends(short[0][own[0]], long[0][own[1]], *inner)
        overlaps[chosen] = np.diff(np.concatenate(([0], np.cumsum(ranges)))[inner[0]])
        first, second = own[0][first], own[1][second]
        at_a, at_b = np.concatenate([at_a, first if short[0] is ends_a else second]), np.concatenate([at_b, second if short[0] is ends_a else first])
    at_a, at_b = np.sort(at_a), np.sort(at_b)
    cuts = np.searchsorted(at_a, bounds_a)
    found = {
        "n_a": lambda: np.diff(bounds_a),
        "n_b": lambda: np.diff(bounds_b),
        "n_groups": lambda: np.diff(cuts),
        "n_overlaps": lambda: overlaps,
        "a_ids": lambda: _lists(a, bounds_a),
        "b_ids": lambda: _lists(b, bounds_b),
        "a_cuts": lambda: _lists(at_a + 1 - np.repeat(bounds_a[:-1], np.diff(cuts)), cuts),
        "b_cuts": lambda: _lists(at_b + 1 - np.repeat(bounds_b[:-1], np.diff(cuts)), cuts),
        "links": lambda: _lists(pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in (a[at_a], b[at_b])], ["a", "b"]), cuts),
        "groups": lambda: _written(pair, a, b, at_a, at_b, bounds_a + bounds_b),
    }
    return [found[name]() for name in names]


def _written(pair: Pair, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, bounds: np.ndarray) -> list[str]:
    """The groups of each text: ``a1,a2|b1;a3|b2,b3``."""
    group_a, group_b = (np.searchsorted(at, np.arange(len(ids)), side="left") for at, ids in ((at_a, a), (at_b, b)))
    # The tokens of a group stand behind those of both lists in all groups before.
    place_a = np.arange(len(a)) + np.concatenate(([0], at_b + 1))[group_a]
    place_b = np.arange(len(b)) + (at_a + 1)[group_b]
    which = np.empty(len(a) + len(b), dtype=np.int64)
    which[place_a], which[place_b] = a, b
    which[place_a[at_a]] += pair.most
    which[place_b[at_b]] += 2 * pair.most
    words = pair.written[which].tolist()
    return ["".join(words[i:j])[:-1] for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def aligned(documents: DataFrame, path_a: str, path_b: str, names: list[str] | None = None, text: str = "text") -> DataFrame:
    """``row`` and the results in ``names`` (all of RESULTS by default) for each whole text.

    ``path_a`` is a byte-level BPE file and encodes a space and the text;
    ``path_b`` a piece model, which adds the space itself. ``a_cuts`` and ``b_cuts``
    count the tokens up to each end that both share; ``links`` are the tokens that
    end there; ``groups`` writes the ids of each group. A null or empty text, and
    one that a tokenizer does not give back byte by byte, has no tokens.
    """
    names = list(names or RESULTS)
    results = T.StructType([T.StructField(name, RESULTS[name]) for name in names])
    return with_results(documents, text, results, (path_a, path_b, names), _per_slice, SLICE)


def most_links(path_a: str, path_b: str) -> int:
    """A bound of the number of different links: the shorter token of a link ends the longer one."""
    a, b = byte_level_tokens(path_a), piece_tokens(path_b)
    twins_a, twins_b = max(Counter(a).values()), max(Counter(b).values())
    return sum(map(len, a)) * twins_b + sum(map(len, b)) * twins_a


def link_counts(alignments: DataFrame, column: str = "links") -> DataFrame:
    """``a, b, count, best``: how often ids are linked, and whether no id is linked to ``b`` more often.

    Links are counted in each task before they travel, so no id is hot.
    """
    counts = alignments.select(F.explode(column).alias("link")).groupBy("link.a", "link.b").agg(F.count("*").alias("count"))
    return counts.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("b")))


def scored(alignments: DataFrame, path_a: str, path_b: str, column: str = "links") -> DataFrame:
    """The rows with ``n_links, n_best, count_sum`` in place of their links.

    ``alignments`` is written once, as counting and scoring both read it. The
    table of counts is broadcast if the vocabularies bound it; larger ones are joined.
    """
    kept = stage(alignments.withColumn("_key", F.monotonically_increasing_id()), "alignments", row_group_mb=16)
    table = stage(link_counts(kept, column), "link-counts")
    if most_links(path_a, path_b) <= BROADCAST_LINKS:
        table = F.broadcast(table)
    links = kept.select("_key", F.explode(column).alias("link")).select("_key", "link.a", "link.b")
    sums = links.join(table, ["a", "b"]).groupBy("_key").agg(F.count_if("best").alias("n_best"), F.sum("count").alias("count_sum"))
    none = F.lit(0).cast("long")
    rest = [F.col(f"`{c}`") for c in alignments.columns if c != column]
    found = kept.withColumn("n_links", F.greatest(F.size(column), F.lit(0)).cast("long")).join(sums, "_key", "left")
    return found.select(*rest, "n_links", F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"))

"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its potential is the sum of weights of binned measures
(case, symbols, repeated words, lengths and the like) of the line itself, the line
before and the line behind; a further weight belongs to each pair of neighbouring
labels. Forward-backward gives each line the probability of being good; weighted
by length these make the quality of the document, and two more numbers turn the
quality into the probability of a good label.

Labels name documents, yet bad documents hold good lines too. So lines are
labelled in rounds: those of good documents are good; those of bad ones are bad
where the field of the round before finds them bad, but at least the worst one.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annalist.llm.arrays import distinct_spans, joined_points, runs, string_texts
from annalist.llm.frames import id_hash, stage, with_results

_OTHER, _UPPER, _LOWER, _DIGIT, _BLANK, _STOP, _MARK, _SYMBOL, _BAR = range(9)
#: Edges of the bins of a share.
SHARES = np.array([1e-9, 0.01, 0.03, 0.06, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9, 0.999])
#: Edges of the bins of a length.
SIZES = np.array([1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144, 233, 377, 610, 987, 1597, 2584])
#: The measures of a line and how many bins each has.
MEASURES = {
    "length": len(SIZES) + 1,
    "words": len(SIZES) + 1,
    "word_length": len(SIZES) + 1,
    "upper": len(SHARES) + 1,
    "digits": len(SHARES) + 1,
    "symbols": len(SHARES) + 1,
    "marks": len(SHARES) + 1,
    "bars": len(SHARES) + 1,
    "stops": len(SHARES) + 1,
    "others": len(SHARES) + 1,
    "stutter": len(SHARES) + 1,
    "distinct": len(SHARES) + 1,
    "symbol_ends": len(SHARES) + 1,
    "first": 9,
    "last": 9,
    "repeated": 2,
}
_OFFSETS = np.concatenate(([0], np.cumsum(list(MEASURES.values()))))
FEATURES = int(_OFFSETS[-1])
RESULTS = T.StructType(
    [
        T.StructField("score", T.DoubleType()),
        T.StructField("quality", T.DoubleType()),
        T.StructField(
            "lines",
            T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("good", T.DoubleType())])),
        ),
    ]
)
_tables: list[np.ndarray] = []


def _kinds() -> np.ndarray:
    """The kind of each code point."""
    if not _tables:
        table = np.full(0x110000, _OTHER, dtype=np.uint8)
        for code in range(0x110000):
            kind = unicodedata.category(chr(code))
            if kind[0] in "LNSZP":
                table[code] = _UPPER if kind in ("Lu", "Lt") else {"L": _LOWER, "N": _DIGIT, "S": _SYMBOL, "Z": _BLANK, "P": _STOP}[kind[0]]
        for chars, kind in (("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85", _BLANK), ("#%&*/@\\_<>{}[]~^=+", _SYMBOL), ("!¡¿?", _MARK), ("|", _BAR)):
            table[[ord(c) for c in chars]] = kind
        _tables.append(table)
    return _tables[0]


@dataclass
class Lines:
    """The lines with a word of a slice of texts: text, place in the slice, size, and features (one per measure)."""

    text: np.ndarray
    start: np.ndarray
    size: np.ndarray
    features: np.ndarray


def measured(texts: list[str]) -> Lines:
    codes, starts = joined_points(texts)
    kind = _kinds()[codes]
    start, end = runs(codes != 10)
    words, word_ends = runs(kind != _BLANK)
    # Lines with a word only; words do not cross lines, as a line feed is blank.
    first, behind = np.searchsorted(words, start), np.searchsorted(words, end)
    real = behind > first
    start, end, first, behind = start[real], end[real], first[real], behind[real]
    if not len(start):
        none = np.zeros(0, np.int64)
        return Lines(none, none, none, np.zeros((0, len(MEASURES)), np.int64))
    text = np.searchsorted(starts, start, side="right") - 1
    n_words = behind - first

    def count(mask: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask)))
        return total[b] - total[a]

    seen = {k: count(kind == k, start, end) for k in (_OTHER, _UPPER, _LOWER, _DIGIT, _STOP, _MARK, _SYMBOL, _BAR)}
    solid = np.maximum(sum(seen.values()), 1)
    _, word_ids = distinct_spans(codes, words, word_ends)
    line_of = np.repeat(np.arange(len(start)), n_words)
    inside = word_ids[np.repeat(first, n_words) + np.arange(len(line_of)) - np.repeat(np.cumsum(n_words) - n_words, n_words)]
    again = np.concatenate(([False], (inside[1:] == inside[:-1]) & (line_of[1:] == line_of[:-1])))
    different = np.bincount(np.unique(line_of * np.int64(len(words)) + inside) // len(words), minlength=len(start))
    ends_odd = np.isin(kind[word_ends - 1], (_SYMBOL, _MARK, _BAR))
    _, line_ids = distinct_spans(codes, start, end)
    _, earliest = np.unique(text * np.int64(len(line_ids)) + line_ids, return_index=True)
    repeated = np.ones(len(start), dtype=np.int64)
    repeated[earliest] = 0
    size = lambda x: np.searchsorted(SIZES, x, side="right")
    share = lambda x, of: np.searchsorted(SHARES, x / of, side="right")
    bins = [
        size(end - start),
        size(n_words),
        size(solid / n_words),
        share(seen[_UPPER], np.maximum(seen[_UPPER] + seen[_LOWER], 1)),
        share(seen[_DIGIT], solid),
        share(seen[_SYMBOL], solid),
        share(seen[_MARK], solid),
        share(seen[_BAR], n_words),
        share(seen[_STOP], solid),
        share(seen[_OTHER], solid),
        share(np.bincount(line_of, again, minlength=len(start)), n_words),
        share(different, n_words),
        share(count(ends_odd, first, behind), n_words),
        kind[words[first]].astype(np.int64),
        kind[word_ends[behind - 1] - 1].astype(np.int64),
        repeated,
    ]
    return Lines(text, start - starts[text], end - start, np.stack(bins, axis=1) + _OFFSETS[:-1])


@dataclass
class Model:
    """Weights for "bad" of the features of a line, the one before, the one behind; of label pairs; and the last step.

    ``pairs[i, j]`` belongs to label ``i`` followed by ``j`` (0 good, 1 bad).
    ``score = sigmoid(slope * logit(quality) + shift)``; ``empty`` is the score of
    a text without a line.
    """

    own: np.ndarray
    before: np.ndarray
    behind: np.ndarray
    bias: float
    pairs: np.ndarray
    slope: float
    shift: float
    empty: float


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


class Chains:
    """Lines of some texts, walked text by text: the n-th lines of all texts together."""

    def __init__(self, text: np.ndarray, features: np.ndarray):
        self.features = features
        self.first = np.flatnonzero(np.diff(text, prepend=-1) != 0)
        self.text = text[self.first]
        self.length = np.diff(np.append(self.first, len(text)))
        # Lines with a line before them.
        self.inner = np.ones(len(text), dtype=bool)
        self.inner[self.first] = False
        order = np.argsort(-self.length, kind="stable")
        lengths = self.length[order]
        counts = np.searchsorted(-lengths, -np.arange(1, (lengths[0] if len(lengths) else 0) + 1), side="right")
        # Texts with at least n + 1 lines, longest first: their n-th lines.
        self.steps = [self.first[order[:n]] + i for i, n in enumerate(counts.tolist())]

    def potentials(self, model: Model) -> np.ndarray:
        z = model.bias + model.own[self.features].sum(axis=1)
        at = np.flatnonzero(self.inner)
        z[at] += model.before[self.features[at - 1]].sum(axis=1)
        z[at - 1] += model.behind[self.features[at]].sum(axis=1)
        return z

    def marginals(self, z: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of "bad" per line, and of label pairs per line and the one before (rows of inner lines only)."""
        bad = _sigmoid(z)
        local = np.stack([1 - bad, bad], axis=1) + 1e-300
        step = np.exp(pairs - pairs.max())
        forward, backward = np.empty_like(local), np.ones_like(local)
        for i, at in enumerate(self.steps):
            now = local[at] if i == 0 else local[at] * (forward[at - 1] @ step)
            forward[at] = now / now.sum(axis=1, keepdims=True)
        for at in reversed(self.steps[1:]):
            now = (local[at] * backward[at]) @ step.T
            backward[at - 1] = now / now.sum(axis=1, keepdims=True)
        both = forward * backward
        both /= both.sum(axis=1, keepdims=True)
        at = np.flatnonzero(self.inner)
        joint = forward[at - 1][:, :, None] * step * (local[at] * backward[at])[:, None, :]
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        return both[:, 1], joint


def _trained(chains: Chains, bad: np.ndarray, weight: np.ndarray, model: Model, steps: int, rate: float, ridge: float, chained: bool) -> Model:
    """The model after some steps of Adam on the likelihood of line labels; ``weight`` is per line."""
    at = np.flatnonzero(chains.inner)
    flat, before, behind = chains.features.ravel(), chains.features[at - 1].ravel(), chains.features[at].ravel()
    width = chains.features.shape[1]
    seen = np.zeros((len(at), 2, 2))
    seen[np.arange(len(at)), bad[at - 1], bad[at]] = 1
    values = np.concatenate([model.own, model.before, model.behind, [model.bias], model.pairs.ravel()])
    first, second = np.zeros_like(values), np.zeros_like(values)
    total = weight.sum()
    for n in range(1, steps + 1):
        now = _model(values, model)
        p, joint = chains.marginals(chains.potentials(now), now.pairs)
        pull = (p - bad) * weight
        parts = [
            np.bincount(flat, np.repeat(pull, width), FEATURES),
            np.bincount(before, np.repeat(pull[at], width), FEATURES),
            np.bincount(behind, np.repeat(pull[at - 1], width), FEATURES),
            [pull.sum()],
            ((joint - seen) * weight[at][:, None, None]).sum(axis=0).ravel() if chained else np.zeros(4),
        ]
        gradient = np.concatenate(parts) / total + ridge * values
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        values -= rate * (1 - n / (steps + 1)) * (first / (1 - 0.9**n)) / (np.sqrt(second / (1 - 0.999**n)) + 1e-9)
    return _model(values, model)


def _model(values: np.ndarray, old: Model) -> Model:
    own, before, behind = values[: 3 * FEATURES].reshape(3, FEATURES)
    return Model(own, before, behind, float(values[3 * FEATURES]), values[3 * FEATURES + 1 :].reshape(2, 2), old.slope, old.shift, old.empty)


def _quality(chains: Chains, bad: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Share of good, weighted by line length, of each text of the chains."""
    if not len(bad):
        return np.zeros(0)
    return np.add.reduceat((1 - bad) * size, chains.first) / np.add.reduceat(size, chains.first)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _calibrated(quality: np.ndarray, good: np.ndarray, weight: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope (not negative) and shift of a logistic regression on one number, by Newton's method with a small ridge."""
    x = np.stack([_logit(quality), np.ones(len(quality))], axis=1)
    values, target = np.array([1.0, 0.0]), np.array([1.0, 0.0])
    for _ in range(steps):
        p = _sigmoid(x @ values)
        gradient = x.T @ ((p - good) * weight) / weight.sum() + 1e-3 * (values - target)
        curve = (x * (p * (1 - p) * weight)[:, None]).T @ x / weight.sum() + 1e-3 * np.eye(2)
        values = values - np.clip(np.linalg.solve(curve, gradient), -1, 1)
        values[0] = max(values[0], 0.05)
    return float(values[0]), float(values[1])


def held_out(id_column: str = "doc_id") -> Column:
    """Rows that training never sees; a null id is never held out, nor trained on."""
    return F.coalesce(id_hash(id_column) % 4 == 2, F.lit(False))


def _sampled(batches):
    for batch in batches:
        labels, order = batch.column("label"), batch.column("order")
        for start, stop, texts in string_texts(batch.column("text")):
            lines = measured(texts)
            bounds = np.searchsorted(lines.text, np.arange(len(texts) + 1)).astype(np.int32)
            flat = pa.array((lines.features - _OFFSETS[:-1]).astype(np.uint8).tobytes()[i * len(MEASURES) : (i + 1) * len(MEASURES)] for i in range(len(lines.text)))
            yield pa.RecordBatch.from_arrays(
                [
                    labels.slice(start, stop - start),
                    order.slice(start, stop - start),
                    pa.ListArray.from_arrays(pa.array(bounds), flat.cast(pa.binary())),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(lines.size.astype(np.int64))),
                ],
                names=["label", "order", "features", "sizes"],
            )


def fit(documents: DataFrame, labels: DataFrame, most_documents: int = 8000, most_lines: int = 400_000, rounds: int = 2) -> Model:
    """A model of ``labels.quality`` learned from a bounded sample of labelled rows.

    Of each label the ``most_documents / 2`` rows of the smallest id hashes, and of
    these, in order of the hash, whole documents up to ``most_lines / 2`` lines, none
    of which has over ``most_lines / 100``; both bounds hold for what reaches the
    driver (24 bytes a line). All other texts are scored, but not learned from. The
    two labels weigh as they do in the table. Rows with a null id, a null label or a
    held-out id are not used; an id labelled twice is good only if all labels say
    so. Without a good and a bad row every text gets the label there is, or 0.5.
    """
    usable = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("label"))
        .withColumn("order", F.xxhash64("doc_id"))
    )
    share = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.count("*").alias("n")).collect()}
    half = most_documents // 2
    picked = [usable.where(F.col("label") == label).orderBy("order", "doc_id").limit(half) for label in (0, 1)]
    # At most most_documents ids: small enough to send to every task.
    chosen = F.broadcast(picked[0].unionAll(picked[1]))
    rows = documents.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).join(chosen, "doc_id").select("label", "order", "text")
    schema = "label int, order long, features array<binary>, sizes array<long>"
    sample = stage(rows.mapInArrow(_sampled, schema), "quality-sample")
    # Of a few thousand rows the running counts, without their lines; two numbers reach the driver.
    counted = sample.select("label", "order", F.size("sizes").alias("n")).where(F.col("n") <= most_lines // 100)
    so_far = F.sum("n").over(Window.partitionBy("label").orderBy("order"))
    last = {r["label"]: r["last"] for r in counted.withColumn("so_far", so_far).where(F.col("so_far") <= most_lines // 2).groupBy("label").agg(F.max("order").alias("last")).collect()}
    inside = [(F.col("label") == label) & (F.col("order") <= order) for label, order in last.items()]
    kept = sample.where(F.size("sizes").between(1, most_lines // 100) & reduce(or_, inside, F.lit(False)))
    seen = kept.orderBy("order", "label", F.size("sizes"), F.xxhash64("features")).select("label", "features", "sizes").collect()
    good = np.array([r["label"] for r in seen], dtype=np.int64)
    zero = np.zeros(FEATURES)
    nothing = Model(zero, zero, zero, 0.0, np.zeros((2, 2)), 1.0, 0.0, 0.5)
    if not len(good) or good.min() == good.max():
        only = 0.5 if not len(good) else float(good[0])
        return Model(zero, zero, zero, 0.0, np.zeros((2, 2)), 1.0, float(_logit(np.array(only))), only)
    sizes = np.concatenate([np.array(r["sizes"], dtype=np.int64) for r in seen])
    features = np.frombuffer(b"".join(x for r in seen for x in r["features"]), dtype=np.uint8).reshape(-1, len(MEASURES)).astype(np.int64) + _OFFSETS[:-1]
    counts = np.array([len(r["sizes"]) for r in seen])
    text = np.repeat(np.arange(len(seen)), counts)
    chains = Chains(text, features)
    of_label = np.bincount(good, minlength=2)
    weight = np.array([share.get(0, 0) / of_label[0], share.get(1, 0) / of_label[1]])[good]
    bad = np.repeat(1 - good, counts)
    model = _trained(chains, bad, weight[text], nothing, 150, 0.1, 1e-4, chained=False)
    for _ in range(rounds):
        p, _ = chains.marginals(chains.potentials(model), model.pairs)
        worst = np.maximum.reduceat(p, chains.first)
        bad = (np.repeat(1 - good, counts) * ((p >= 0.5) | (p == np.repeat(worst, counts)))).astype(np.int64)
        model = _trained(chains, bad, weight[text], model, 150, 0.05, 1e-4, chained=True)
    p, _ = chains.marginals(chains.potentials(model), model.pairs)
    model.slope, model.shift = _calibrated(_quality(chains, p, sizes), good, weight)
    model.empty = share.get(1, 0) / sum(share.values())
    return model


def _scores(texts: list[str], model: Model):
    lines = measured(texts)
    chains = Chains(lines.text, lines.features)
    bad, _ = chains.marginals(chains.potentials(model), model.pairs)
    quality = np.full(len(texts), np.nan)
    quality[chains.text] = _quality(chains, bad, lines.size)
    score = np.where(np.isnan(quality), model.empty, _sigmoid(model.slope * _logit(np.nan_to_num(quality, nan=0.5)) + model.shift))
    bounds = np.searchsorted(lines.text, np.arange(len(texts) + 1)).astype(np.int32)
    spans = pa.StructArray.from_arrays([pa.array(lines.start), pa.array(lines.size), pa.array(1 - bad)], ["start", "length", "good"])
    return score, pa.array(quality, pa.float64(), from_pandas=True), pa.ListArray.from_arrays(pa.array(bounds), spans)


def score(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``row, score, quality, lines``: the columns as they came, the probability of a good label, the quality, the lines.

    Lines are what lies between line feeds and holds a word; their spans count code
    points and ``good`` is the marginal. Texts without such a line (null, empty,
    blank) have no quality; their score is the share of good labels. Rows stay
    where they are: no shuffle, whole texts, any number of rows.
    """
    return with_results(documents, text, RESULTS, model, _scores)


def without_bad(documents: DataFrame, model: Model, text: str = "text", limit: float = 0.7) -> DataFrame:
    """The rows that score ``limit`` or more, unchanged."""
    return score(documents, model, text).where(F.col("score") >= limit).select("row.*")

"""Toxicity by multiple-instance learning.

Labels name documents, yet only some sentences offend. A sentence offends with
probability sigmoid(bias + weights of its features), and a document is toxic if
any sentence is: noisy-or, ``1 - prod(1 - p)``. Training on document labels thus
learns which sentences carry them, and scoring names those sentences.

Features are lower-case words and their beginnings of 4 to 6 letters, so that an
inflected form unseen in training is known by its stem. The candidates are the
features that go with the label most clearly; weights are never negative.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annalist.llm.arrays import SpanHashes, joined_points, letters, mix, runs, string_texts
from annalist.llm.frames import id_hash, stage, with_results

#: Characters that end a sentence.
SENTENCE_ENDS = ".!?\n…。！？"
STEMS = (4, 5, 6)
_STEM = np.uint64(0x5851F42D4C957F2D)

RESULTS = T.StructType(
    [
        T.StructField("score", T.DoubleType()),
        T.StructField(
            "offending",
            T.ArrayType(
                T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("score", T.DoubleType())])
            ),
        ),
    ]
)


@dataclass
class Model:
    """Sorted feature hashes, their weights, and the bias of a sentence."""

    features: np.ndarray
    weights: np.ndarray
    bias: float


@dataclass
class Words:
    """The words of a slice of texts, in order of place."""

    start: np.ndarray
    end: np.ndarray
    document: np.ndarray
    sentence: np.ndarray
    hashes: SpanHashes
    codes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def features(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the word, feature) of the words in ``which``."""
        start, end = self.start[which], self.end[which]
        words, found = [which], [self.hashes.get(start, end)]
        for size in STEMS:
            longer = end - start >= size
            words.append(which[longer])
            found.append(self.hashes.get(start[longer], start[longer] + size) ^ _STEM)
        return np.concatenate(words), np.concatenate(found)


def _words(texts: list[str]) -> Words:
    codes, starts = joined_points(texts)
    ends = np.isin(codes, np.array([ord(c) for c in SENTENCE_ENDS], dtype=np.uint32))
    lower = letters()[codes]
    start, end = runs(lower > 0)
    return Words(start, end, np.searchsorted(starts, start, side="right") - 1, np.cumsum(ends)[start] if len(start) else start, SpanHashes(lower), codes, starts, ends)


def _sentence_counts(words: Words, documents: int) -> np.ndarray:
    first = np.diff(words.sentence, prepend=-1) != 0
    return np.bincount(words.document[first], minlength=documents)


def _active(words: Words, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, sentence, index of feature), each once, of the known features."""
    none = np.zeros(0, np.int64)
    if not len(features) or not len(words.start):
        return none, none, none
    word, found = words.features(np.arange(len(words.start)))
    place = np.minimum(np.searchsorted(features, found), len(features) - 1)
    known = features[place] == found
    word, place = word[known], place[known]
    pairs = np.unique(np.stack([words.document[word], words.sentence[word], place]), axis=1)
    return pairs[0], pairs[1], pairs[2]


def _counts(batches):
    """Documents and toxic documents of each feature, summed over the task."""
    total = pd.DataFrame({"feature": np.zeros(0, np.int64), "docs": np.zeros(0, np.int64), "toxic": np.zeros(0, np.int64)})
    for batch in batches:
        label = np.array(batch.column(1), dtype=np.int64)
        for start, stop, texts in string_texts(batch.column(0)):
            words = _words(texts)
            word, found = words.features(np.arange(len(words.start)))
            document = words.document[word]
            _, once = np.unique(mix(found + document.astype(np.uint64) * _STEM), return_index=True)
            part = pd.DataFrame({"feature": found[once].view(np.int64), "docs": 1, "toxic": label[start:stop][document[once]]})
            total = pd.concat([total, part]).groupby("feature", as_index=False).sum()
    yield pa.RecordBatch.from_pandas(total, preserve_index=False)


def _instances(features: np.ndarray):
    """Per document: label, number of sentences, and the features of each sentence that has any."""

    def run(batches):
        for batch in batches:
            label = batch.column(1).to_pylist()
            for start, _, texts in string_texts(batch.column(0)):
                words = _words(texts)
                sentences = _sentence_counts(words, len(texts))
                lists: list[dict[int, list[int]]] = [{} for _ in texts]
                for document, sentence, feature in zip(*(x.tolist() for x in _active(words, features)), strict=True):
                    lists[document].setdefault(sentence, []).append(feature)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(label[start : start + len(texts)], pa.int64()),
                        pa.array(sentences, pa.int64()),
                        pa.array([list(x.values()) for x in lists], pa.list_(pa.list_(pa.int64()))),
                    ],
                    names=["label", "sentences", "active"],
                )

    return run


def _descend(label, sentences, document, bag, feature, size, steps=1200, rate=0.1, ridge=1e-5):
    """Weights and bias of least noisy-or loss (Adam on the whole sample).

    ``document`` holds the document of each active sentence; ``bag`` the active
    sentence of each entry of ``feature``. Sentences without features share one
    probability, so a count of them stands for all.
    """
    documents, active = len(label), len(document)
    plain = sentences - np.bincount(document, minlength=documents)
    values = np.concatenate([np.zeros(size), [-6.0]])
    first, second = np.zeros_like(values), np.zeros_like(values)
    for step in range(1, steps + 1):
        z = values[-1] + np.bincount(bag, values[feature], minlength=active)
        p, bare = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-values[-1]))
        clean = np.bincount(document, np.logaddexp(0, z), minlength=documents) + plain * np.logaddexp(0, values[-1])
        # Of the loss by the sum of log(1 - p): clean documents push down, toxic ones up.
        pull = np.where(label == 1, -1 / np.expm1(np.maximum(clean, 1e-9)), 1.0)
        push = pull[document] * p
        gradient = np.concatenate([np.bincount(feature, push[bag], minlength=size), [push.sum() + (pull * plain).sum() * bare]]) / documents
        gradient[:-1] += ridge * values[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        values -= rate * (1 - step / (steps + 1)) * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
        values[:-1] = np.maximum(values[:-1], 0)
    return values[:-1], float(values[-1])


def held_out(id_column: str = "doc_id") -> Column:
    """Rows that training never sees; a null id is never held out, nor trained on."""
    return F.coalesce(id_hash(id_column) % 5 == 0, F.lit(False))


def fit(documents: DataFrame, labels: DataFrame, most_documents: int = 8000, most_features: int = 4096, least_documents: int = 3, clear: float = 3.0) -> Model:
    """A model of ``labels.toxic`` learned from a sample of at most ``most_documents`` labelled rows.

    The sample (smallest id hashes; one row per text) bounds what is gathered:
    counts of its features are summed by Spark, and of its texts only the known
    features per sentence reach the driver. Rows with a null id, a null label or
    a held-out id are not used; an id labelled twice counts as toxic if any label
    says so. Without a toxic and a clean row every score is close to 0.
    """
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("long").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most_documents)
    )
    # At most most_documents ids: small enough to send to every task.
    rows = documents.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    sample = stage(rows.groupBy(F.sha2("text", 256).alias("key")).agg(F.first("text").alias("text"), F.max("label").alias("label")).drop("key"), "toxicity-sample")
    all_docs, all_toxic = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    nothing = Model(np.zeros(0, np.uint64), np.zeros(0), -20.0)
    if not all_toxic or all_toxic == all_docs:
        return nothing
    counts = sample.mapInArrow(_counts, "feature long, docs long, toxic long").groupBy("feature").agg(F.sum("docs").alias("docs"), F.sum("toxic").alias("toxic"))
    a, b = F.col("toxic"), F.col("docs") - F.col("toxic")
    odds = F.log((a + 0.5) / (all_toxic - a + 0.5)) - F.log((b + 0.5) / (all_docs - all_toxic - b + 0.5))
    spread = F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5) + 1 / (all_toxic - a + 0.5) + 1 / (all_docs - all_toxic - b + 0.5))
    picked = counts.where((F.col("docs") >= least_documents) & (odds / spread >= clear)).orderBy((odds / spread).desc(), "feature").limit(most_features)
    features = np.sort(np.array([r["feature"] for r in picked.select("feature").collect()], dtype=np.int64).view(np.uint64))
    seen = sample.mapInArrow(_instances(features), "label long, sentences long, active array<array<long>>").collect()
    bags = [(i, bag) for i, row in enumerate(seen) for bag in row["active"]]
    weights, bias = _descend(
        np.array([r["label"] for r in seen]),
        np.array([r["sentences"] for r in seen]),
        np.array([i for i, _ in bags], dtype=np.int64),
        np.repeat(np.arange(len(bags)), [len(bag) for _, bag in bags]),
        np.array([f for _, bag in bags for f in bag], dtype=np.int64),
        len(features),
    )
    useful = weights > 1e-3
    return Model(features[useful], weights[useful], bias)


def _scores(texts: list[str], model: Model):
    words = _words(texts)
    document, sentence, feature = _active(words, model.features)
    counts = _sentence_counts(words, len(texts))
    # Active sentences stand together, as the triples come sorted.
    first = np.flatnonzero(np.diff(sentence, prepend=-1) != 0)
    z = model.bias + (np.add.reduceat(model.weights[feature], first) if len(first) else np.zeros(0))
    owner, which = document[first], sentence[first]
    plain = counts - np.bincount(owner, minlength=len(texts))
    clean = np.bincount(owner, np.logaddexp(0, z), minlength=len(texts)) + plain * np.logaddexp(0, model.bias)
    p = 1 / (1 + np.exp(-z))
    spans: list[list[dict]] = [[] for _ in texts]
    bounds = np.flatnonzero(words.ends)
    for i in np.flatnonzero(p >= 0.5):
        at, text = int(owner[i]), words.starts[owner[i]]
        # From behind the end before it to its own end; cut to its document.
        start = max(int(bounds[which[i] - 1]) + 1 if which[i] else 0, int(text))
        end = min(int(bounds[which[i]]) + 1, int(words.starts[at + 1]) - 1)
        spans[at].append({"start": start - int(text), "length": end - start, "score": float(p[i])})
    return -np.expm1(-clean), spans


def score(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``row, score, offending``: the columns as they came, the toxicity, the sentences with p >= 0.5.

    Spans count code points. Null and empty texts have no sentence and score 0.
    Rows stay where they are: no shuffle, whole texts, any number of rows.
    """
    return with_results(documents, text, RESULTS, model, _scores)


def without_toxic(documents: DataFrame, model: Model, text: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows that score below ``limit``, unchanged."""
    return score(documents, model, text).where(F.col("score") < limit).select("row.*")

"""Language identification by Kneser-Ney character language models.

One interpolated Kneser-Ney model of character four-grams per language. The
models of all languages share one sorted array of n-gram hashes per order; next
to it lie the finished log probabilities, one column per language, so that one
binary search scores a character in every language. A text goes to the language
of the lowest cross-entropy per character. It is marked as rejected where that
entropy is above what nearly all training texts of that language reach.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annalist.llm.arrays import distinct, joined_points, letters, mix, string_texts
from annalist.llm.frames import id_hash, with_results

ORDER = 4
DISCOUNT = 0.75
UNKNOWN = "und"
_BLANK = 32

RESULTS = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("entropy", T.DoubleType()),
        T.StructField("rejected", T.BooleanType()),
    ]
)


def _characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters, any run of others as one blank, and the start of each text.

    Every text with a letter begins with as many blanks as a full context has, so
    that no n-gram reaches into its neighbour, and ends with one; a text without
    a letter is empty.
    """
    codes, starts = joined_points(texts)
    lower = letters()[codes]
    owner = np.repeat(np.arange(len(texts)), np.diff(starts))
    kept = lower > 0
    # One blank behind each run of letters; the joining code is no letter.
    after = np.flatnonzero(kept[:-1] & ~kept[1:]) + 1 if len(kept) else np.zeros(0, np.int64)
    kept[after] = True
    values = np.where(lower == 0, _BLANK, lower)[kept].astype(np.uint64)
    bounds = np.searchsorted(owner[kept], np.arange(len(texts) + 1))
    filled = np.diff(bounds) > 0
    pad = ORDER - 1
    out = np.insert(values, np.repeat(bounds[:-1][filled], pad), _BLANK)
    return out, bounds + np.concatenate(([0], np.cumsum(filled) * pad))


def _packed(values: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
    """The hash of the ``order`` characters that end at each of the places."""
    if 2 * len(at) > len(values):
        # Most places are wanted: all are hashed, by whole columns.
        size = len(values) - order + 1
        out = np.zeros(size, dtype=np.uint64)
        for step in range(order):
            out *= np.uint64(0x100000001B3)
            out += values[step : step + size]
            out += np.uint64(1)
        return mix(out[at - (order - 1)] + np.uint64(order))
    out = np.zeros(len(at), dtype=np.uint64)
    for back in range(order - 1, -1, -1):
        out = out * np.uint64(0x100000001B3) + values[at - back] + np.uint64(1)
    return mix(out + np.uint64(order))


def _places(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places of all characters but the blanks put in front of each text."""
    inside = np.ones(len(values), dtype=bool)
    firsts = starts[:-1][np.diff(starts) > 0]
    for step in range(ORDER - 1):
        inside[firsts + step] = False
    return np.flatnonzero(inside)


#: Rows of counts a task holds before it hands them on (some 30 bytes each).
HELD_COUNTS = 2_000_000


def _summed(parts: list[pd.DataFrame]) -> pd.DataFrame:
    names = [*(f"c{i}" for i in range(ORDER)), "lang"]
    return pd.concat(parts).groupby(names, as_index=False, sort=False).sum()


def _owners(starts: np.ndarray) -> np.ndarray:
    """The text each of the places is in."""
    sizes = np.diff(starts)
    return np.repeat(np.arange(len(sizes)), np.where(sizes > 0, sizes - (ORDER - 1), 0))


def _counted(langs: list[str]):
    """Four-gram counts per language over a task: the characters, the language and the count."""

    place_of = {name: i for i, name in enumerate(langs)}
    types = {**{f"c{i}": "int32" for i in range(ORDER)}, "lang": "int32", "n": "int64"}

    def run(batches):
        parts: list[pd.DataFrame] = []
        for batch in batches:
            lang = np.array([place_of[x] for x in batch.column(1).to_pylist()], dtype=np.int32)
            for start, stop, texts in string_texts(batch.column(0)):
                values, starts = _characters(texts)
                at = _places(values, starts)
                owner = _owners(starts)
                key = mix(_packed(values, at, ORDER) + lang[start:stop][owner].astype(np.uint64))
                found, first, which = distinct(key)
                place = at[first]
                grams = pd.DataFrame({f"c{i}": values[place - ORDER + 1 + i].astype(np.int32) for i in range(ORDER)})
                grams["lang"], grams["n"] = lang[start:stop][owner[first]], np.bincount(which, minlength=len(found))
                parts.append(grams)
                if len(parts) > 16:
                    parts = [_summed(parts)]
                    if len(parts[0]) > HELD_COUNTS:
                        yield pa.RecordBatch.from_pandas(parts.pop().astype(types), preserve_index=False)
        if parts:
            yield pa.RecordBatch.from_pandas(_summed(parts).astype(types), preserve_index=False)

    return run


@dataclass
class Models:
    """``tables[n - 1]``: sorted hashes of n-grams, their log probabilities, and the log weight their continuations back off with."""

    langs: list[str]
    tables: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    unseen: np.ndarray
    limits: np.ndarray


def _gram_hash(grams: np.ndarray) -> np.ndarray:
    """Hashes of rows of characters, as :func:`_packed` gives them."""
    out = np.zeros(len(grams), dtype=np.uint64)
    for column in range(grams.shape[1]):
        out = out * np.uint64(0x100000001B3) + grams[:, column].astype(np.uint64) + np.uint64(1)
    return mix(out + np.uint64(grams.shape[1]))


def _estimate(counts: pd.DataFrame, langs: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray]], np.ndarray]:
    """Interpolated Kneser-Ney tables of orders 1 to ORDER from four-gram counts, and log probabilities of unknown letters.

    Below the highest order an n-gram counts as often as characters precede it.
    """
    size = len(langs)
    names = [f"c{i}" for i in range(ORDER)]
    per_order = {ORDER: counts.rename(columns={"n": "count"})}
    for order in range(ORDER - 1, 0, -1):
        above = per_order[order + 1]
        kept = names[ORDER - order :]
        # Each distinct longer n-gram is one character that came before.
        per_order[order] = above.groupby([*kept, "lang"], as_index=False).size().rename(columns={"size": "count"})
    tables: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for order in range(1, ORDER + 1):
        own = per_order[order]
        columns = names[ORDER - order :]
        grams = own[columns].drop_duplicates().to_numpy()
        hashes, first, _ = distinct(_gram_hash(grams))
        grams = grams[first]
        row = np.searchsorted(hashes, _gram_hash(own[columns].to_numpy()))
        lang, count = own["lang"].to_numpy(), own["count"].to_numpy().astype(np.float64)
        dense = np.zeros((len(hashes), size))
        dense[row, lang] = count
        if order == 1:
            total = dense.sum(axis=0)
            distinct_letters = len(hashes) + 1
            lower = np.full((len(hashes), size), 1.0 / distinct_letters)
            share = DISCOUNT * (dense > 0).sum(axis=0) / np.maximum(total, 1)
            share[total == 0] = 1
            p = np.maximum(dense - DISCOUNT, 0) / np.maximum(total, 1) + share * lower
            unseen = np.log(share / distinct_letters)
            tables.append((hashes, np.log(p).astype(np.float32), np.zeros((len(hashes), size), dtype=np.float32)))
            continue
        # Weights of the context: what follows it, and how many kinds.
        context = _gram_hash(grams[:, :-1])
        contexts, _, which = distinct(context)
        total = np.zeros((len(contexts), size))
        kinds = np.zeros((len(contexts), size))
        np.add.at(total, which, dense)
        np.add.at(kinds, which, dense > 0)
        weight = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
        below_hashes, below_p, below_weight = tables[-1]
        shorter = np.searchsorted(below_hashes, _gram_hash(grams[:, 1:]))
        p = np.maximum(dense - DISCOUNT, 0) / np.maximum(total[which], 1) + weight[which] * np.exp(below_p[shorter])
        # The context is an n-gram of the order below, where its back-off weight is kept.
        place = np.searchsorted(below_hashes, contexts)
        known = place < len(below_hashes)
        known[known] &= below_hashes[place[known]] == contexts[known]
        below_weight[place[known]] = np.log(weight[known])
        tables.append((hashes, np.log(p).astype(np.float32), np.zeros((len(hashes), size), dtype=np.float32)))
    return tables, unseen


_directories: dict[int, tuple[np.ndarray, np.ndarray, np.uint64]] = {}


def _directory(table: np.ndarray) -> tuple[np.ndarray, np.uint64]:
    """Where the hashes with the same first bits begin, two such ranges per hash, and the shift that leaves these bits."""
    known = _directories.get(id(table))
    if known is None or known[0] is not table:
        bits = max(1, (2 * len(table)).bit_length())
        shift = np.uint64(64 - bits)
        starts = np.searchsorted(table, np.arange(1 << bits, dtype=np.uint64) << shift)
        if len(_directories) >= 4 * ORDER:
            _directories.clear()
        known = _directories[id(table)] = (table, starts, shift)
    return known[1], known[2]


def _find(table: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted hash, or -1. Hashes are spread evenly, so few steps from the start of its range lead to each."""
    if not len(table):
        return np.full(len(wanted), -1)
    starts, shift = _directory(table)
    last = len(table) - 1
    place = np.minimum(starts.take(wanted >> shift), last)
    found = table.take(place)
    at = np.flatnonzero(found != wanted)
    out = place.copy()
    out[at] = -1
    at = at[found[at] < wanted[at]]
    place = place[at] + 1
    while len(at):
        inside = place <= last
        at, place = at[inside], place[inside]
        found, own = table[place], wanted[at]
        equal = found == own
        out[at[equal]] = place[equal]
        further = found < own
        at, place = at[further], place[further] + 1
    return out


def _log_probabilities(values: np.ndarray, at: np.ndarray, tables, unseen: np.ndarray) -> np.ndarray:
    """Log probability of the character at each place after up to three before it, per language."""
    out = np.zeros((len(at), len(unseen)), dtype=np.float64)
    pending, place = np.arange(len(at)), at
    for order in range(ORDER, 0, -1):
        hashes, p, _ = tables[order - 1]
        found = _find(hashes, _packed(values, place, order))
        missed = np.flatnonzero(found < 0)
        if order == ORDER and len(hashes):
            out = p.take(found, axis=0, mode="clip").astype(np.float64)
            out[missed] = 0
        elif len(missed) < len(found):
            seen = found >= 0
            out[pending[seen]] += p[found[seen]]
        pending, place = pending[missed], place[missed]
        if not len(pending):
            return out
        if order > 1:
            lower, _, weights = tables[order - 2]
            context = _find(lower, _packed(values, place - 1, order - 1))
            known = context >= 0
            out[pending[known]] += weights[context[known]]
    out[pending] += unseen
    return out


def entropies(texts: list[str], models: Models) -> tuple[np.ndarray, np.ndarray]:
    """Cross-entropy per character of each text in each language, and its number of characters scored."""
    values, starts = _characters(texts)
    at = _places(values, starts)
    total = np.zeros((len(texts), len(models.langs)))
    counts = np.zeros(len(texts), dtype=np.int64)
    if len(at):
        logs = _log_probabilities(values, at, models.tables, models.unseen)
        owner = _owners(starts)
        first = np.flatnonzero(np.diff(owner, prepend=-1) != 0)
        total[owner[first]] = -np.add.reduceat(logs, first, axis=0)
        counts = np.bincount(owner, minlength=len(texts))
    return total / np.maximum(counts, 1)[:, None], counts


def learned(id_column: str = "doc_id") -> Column:
    """Rows that training may use; a null id is not used."""
    return F.coalesce(id_hash(id_column) % 4 != 2, F.lit(False))


def held_out(id_column: str = "doc_id") -> Column:
    return F.coalesce(id_hash(id_column) % 4 == 2, F.lit(False))


def fit(documents: DataFrame, kept: float = 0.995, most_languages: int = 500) -> Models:
    """Models of the languages in ``lang``, from all their texts, taken whole.

    Rows with a null language or id and held-out ids are not used. Spark counts the
    n-grams of every other row; what the driver gathers are the counts of distinct
    n-grams per language, from which the tables are made. ``kept`` is the share of a
    language's training texts, all of them scored, that its rejection limit lets pass.
    More than ``most_languages`` languages are an error: texts of one without a model
    would all be given a wrong language.
    """
    known = documents.where(learned() & F.col("lang").isNotNull()).select("text", "lang")
    langs = sorted(r["lang"] for r in known.select("lang").distinct().limit(most_languages + 1).collect())
    if len(langs) > most_languages:
        raise ValueError(f"more than most_languages={most_languages} languages to learn")
    if not langs:
        return Models([], [], np.zeros(0), np.zeros(0))
    schema = ", ".join([*(f"c{i} int" for i in range(ORDER)), "lang int", "n long"])
    grams = known.mapInArrow(_counted(langs), schema).groupBy(*[f"c{i}" for i in range(ORDER)], "lang").agg(F.sum("n").alias("n"))
    tables, unseen = _estimate(grams.toArrow().to_pandas(), langs)
    models = Models(langs, tables, unseen, np.full(len(langs), np.inf))
    own = known.mapInArrow(_entropy_of(models), "lang long, entropy double")
    limits = own.groupBy("lang").agg(F.percentile_approx("entropy", kept, 10000).alias("limit")).collect()
    for row in limits:
        # Room above the training texts: the others were not seen.
        models.limits[row["lang"]] = 1.1 * row["limit"]
    return models


def _entropy_of(models: Models):
    place_of = {name: i for i, name in enumerate(models.langs)}

    def run(batches):
        for batch in batches:
            lang = np.array([place_of[x] for x in batch.column(1).to_pylist()], dtype=np.int64)
            for start, stop, texts in string_texts(batch.column(0)):
                found, counts = entropies(texts, models)
                own = lang[start:stop]
                has = counts > 0
                yield pa.RecordBatch.from_arrays([pa.array(own[has]), pa.array(found[np.arange(len(own)), own][has])], names=["lang", "entropy"])

    return run


def _predicted(texts: list[str], models: Models):
    if not models.langs:
        return [[UNKNOWN] * len(texts), [0.0] * len(texts), [None] * len(texts), [True] * len(texts)]
    found, counts = entropies(texts, models)
    has = counts > 0
    best = found.argmin(axis=1)
    lowest = found[np.arange(len(texts)), best]
    # Posterior of equal priors; the length counts up to a hundred characters, beyond which characters are no longer independent news.
    odds = np.exp(-(found - lowest[:, None]) * np.minimum(counts, 100)[:, None])
    score = np.where(has, 1 / odds.sum(axis=1), 0.0)
    rejected = ~has | (lowest > models.limits[best])
    return [
        [models.langs[b] if h else UNKNOWN for b, h in zip(best.tolist(), has.tolist(), strict=True)],
        score,
        pa.array(lowest, mask=~has),
        rejected,
    ]


def predicted(documents: DataFrame, models: Models, text: str = "text") -> DataFrame:
    """``row, lang_pred, score, entropy, rejected``: the columns as they came and the language of each whole text.

    Null texts and texts without a letter are ``und`` with score 0. Ties go to
    the first language by name. Rejected rows keep their best language; the flag
    says that it explains the text worse than its own training texts. Without any
    learned language every row is ``und``.
    """
    return with_results(documents, text, RESULTS, models, _predicted)

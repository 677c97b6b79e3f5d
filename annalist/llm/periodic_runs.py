"""Periodic runs: passages that repeat themselves without a break.

A run is a stretch of consecutive words with smallest period ``q`` that no
neighbouring word extends, at least ``least`` words and ``repeats`` periods long.

Seed and extend on diagonals: a run of period ``q`` matches itself at lag ``q``
over ``length - q`` words, so some k-gram of the guaranteed overlap stands both at
its start and ``q`` words on. Lags below the least overlap of all runs use k-grams
of that size; each doubling of the k-gram serves the next octave of lags. In every
octave ``k`` is at least ``q``, and a k-gram that long recurs inside a run exactly
every ``q`` words: pairs of neighbouring occurrences meet every run, and their
number is that of the words, however often a phrase is repeated. A seed is extended
both ways along its lag unless the furthest place covered at that lag lies beyond.

k-grams are compared by content: ranks of (first half, second half), exact at
every size. A text is one row and is handled where it lies; nothing is shuffled.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from annalist.llm.frames import with_results

RUN = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType())])
RESULTS = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])


def least_overlap(least: int, repeats: int) -> int:
    """Words over which any run matches itself at its own period."""
    return min(max(least - q, (repeats - 1) * q) for q in range(1, max(least, 1) + 1))


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key its rank among the distinct ones, and whether another key equals it."""
    _, rank, count = np.unique(keys, return_inverse=True, return_counts=True)
    return rank, count[rank] > 1


def _longer(at: np.ndarray, rank: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and ranks of repeated grams made of a gram and the one ``step`` words on.

    ``rank`` covers all words, -1 where a gram is not repeated in its text: what
    holds such a gram is not repeated either.
    """
    at = at[at + step < len(rank)]
    at = at[rank[at + step] >= 0]
    found, again = _ranked(rank[at] * len(rank) + rank[at + step])
    grown = np.full(len(rank), -1, dtype=np.int64)
    grown[at[again]] = found[again]
    return at[again], grown


def _matching(codes: np.ndarray, at: int, lag: int, step: int) -> int:
    """The place where the match at ``lag`` ends, going from ``at`` by ``step`` (1 or -1)."""
    width = 32
    while True:
        stop = min(at + width, len(codes) - lag) if step > 0 else max(at - width, -1)
        if at == stop:
            return at
        if step > 0:
            wrong = np.flatnonzero(codes[at:stop] != codes[at + lag : stop + lag])
        else:
            wrong = np.flatnonzero(codes[stop + 1 : at + 1][::-1] != codes[stop + 1 + lag : at + 1 + lag][::-1])
        if len(wrong):
            return at + step * int(wrong[0])
        at, width = stop, width * 2


def _extended(codes: np.ndarray, at: np.ndarray, lags: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """(start, end, lag) of the stretches around seeds: grams of ``size`` words, each repeated ``lag`` words on."""
    order = np.lexsort((at, lags))
    at, lags = at[order], lags[order]
    # Seeds side by side at one lag lie in one stretch.
    new = np.ones(len(at), dtype=bool)
    new[1:] = (lags[1:] != lags[:-1]) | (at[1:] != at[:-1] + 1)
    stretches, covered = [], {}
    for place, lag in zip(at[new].tolist(), lags[new].tolist(), strict=True):
        if place < covered.get(lag, 0):
            continue
        first = _matching(codes, place - 1, lag, -1) + 1
        covered[lag] = _matching(codes, place + size, lag, 1)
        stretches.append((first, covered[lag] + lag, lag))
    return stretches


def find_runs(codes: np.ndarray, least: int, repeats: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period.

    ``codes`` holds the words of some texts; no code stands in two texts.
    """
    rank, again = _ranked(codes)
    rank = np.where(again, rank, -1).astype(np.int64)
    at = np.flatnonzero(again)
    size, wanted, shortest = 1, least_overlap(least, repeats), 1
    found = []
    while len(at):
        if size < wanted:
            step = min(size, wanted - size)
            at, rank = _longer(at, rank, step)
            size += step
            continue
        order = np.argsort(rank[at], kind="stable")
        near = at[order]
        lags = near[1:] - near[:-1]
        seed = (rank[near[1:]] == rank[near[:-1]]) & (lags >= shortest) & (lags < wanted)
        found += _extended(codes, near[:-1][seed], lags[seed], size)
        shortest, wanted = wanted, wanted * 2
    runs = [(start, end - start, lag) for start, end, lag in found if end - start >= max(least, repeats * lag)]
    return sorted(runs, key=lambda run: (run[0], run[2]))


def _per_slice(texts: list[str], limits: tuple[int, int]):
    words = [text.encode().split() for text in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate(([0], np.cumsum(sizes)))
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for ws in words for w in ws), np.int64, int(starts[-1]))
    owner = np.repeat(np.arange(len(words)), sizes)
    runs: list[list[dict]] = [[] for _ in texts]
    edges = np.zeros(len(ids) + 1, dtype=np.int64)
    for start, length, period in find_runs(owner * max(len(known), 1) + ids, *limits):
        text = int(owner[start])
        runs[text].append({"start": start - int(starts[text]), "length": length, "period": period})
        edges[start + period] += 1
        edges[start + length] -= 1
    dropped = np.cumsum(edges) > 0
    for i, found in enumerate(runs):
        if found:
            words[i] = [w for w, out in zip(words[i], dropped[starts[i] : starts[i + 1]].tolist(), strict=True) if not out]
    return sizes, runs, [b" ".join(ws).decode() for ws in words]


def periodic_runs(documents: DataFrame, text: str = "text", least: int = 24, repeats: int = 3) -> DataFrame:
    """``row, n_words, runs, collapsed``: the columns as they came, the runs of each text, the text without repeats.

    Words are what lies between ASCII blanks, numbered from 0. ``runs`` is in order
    of start and period. ``collapsed`` holds the words, joined by one space, that no
    run contains after its first ``period`` words. Null and empty texts have no
    word, no run and an empty ``collapsed``. ``repeats`` is at least 3: with fewer,
    k-grams of the guaranteed overlap could be shorter than the period.
    """
    if repeats < 3 or least < 1:
        raise ValueError("repeats must be at least 3 and least at least 1")
    return with_results(documents, text, RESULTS, (least, repeats), _per_slice)

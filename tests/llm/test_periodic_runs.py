"""Periodic runs against comparing all words at all lags."""

import hashlib
import re
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from annalist.llm import periodic_runs
from annalist.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def all_lags(words, least=24, repeats=3):
    """(start, length, period) of all runs, by start and period."""
    found = []
    for q in range(1, len(words) // repeats + 1):
        at = 0
        while at + q < len(words):
            end = at
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            length = end + q - at
            inside = words[at : end + q]
            if end > at and length >= max(least, repeats * q) and not any(inside[d:] == inside[:-d] for d in range(1, q)):
                found.append((at, length, q))
            at = max(end, at + 1)
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words, runs):
    out = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in out)


words_of = lambda text: re.findall(r"[^\x20\x09-\x0D]+", text or "")


@st.composite
def repetitive(draw):
    """Few letters, blocks repeated, a wrong word here and there."""
    out = []
    for _ in range(draw(st.integers(1, 4))):
        block = draw(st.lists(st.integers(0, 3), min_size=1, max_size=40))
        out += block * draw(st.integers(1, 30 // len(block) + 4))
        if draw(st.booleans()):
            out.append(9)
    return out[:260]


@settings(max_examples=400, deadline=None)
@given(repetitive(), st.sampled_from([24, 24, 1, 7, 31]), st.sampled_from([3, 3, 4]))
def test_all_runs_are_found(words, least, repeats):
    assert periodic_runs.find_runs(np.array(words, dtype=np.int64), least, repeats) == all_lags(words, least, repeats)


def test_work_grows_with_the_words():
    """Half a million equal words, and a phrase of 1,000 words 500 times: one run each, at once."""
    assert periodic_runs.find_runs(np.zeros(500_000, dtype=np.int64), 24, 3) == [(0, 500_000, 1)]
    assert periodic_runs.find_runs(np.arange(500_000) % 1000, 24, 3) == [(0, 500_000, 1000)]


def test_edges(spark):
    long = " ".join(f"w{i % 9000}" for i in range(30_000))
    # Joined, neighbours would repeat across the border of two texts.
    texts = [(1, None), (2, ""), (3, " \n"), (4, "a " * 24), (5, "a " * 23), (5, "a " * 23), (None, "é x\x0b" * 40), (6, long), (7, "日本 語 " * 20 + "ende")]
    docs = spark.createDataFrame([(i, t, 1, "x", None) for i, t in texts], "doc_id long, text string, n_words int, runs string, `a b` string")
    found = periodic_runs.periodic_runs(docs)
    assert found.columns == ["row", "n_words", "runs", "collapsed"] and found.schema["row"].dataType == docs.schema
    rows = found.collect()
    assert sorted((r.row.doc_id or 0, r.row.text or "") for r in rows) == sorted((i or 0, t or "") for i, t in texts)
    for r in rows:
        words = words_of(r.row.text)
        runs = [(x.start, x.length, x.period) for x in r.runs]
        assert r.n_words == len(words)
        assert runs == ([(0, 30_000, 9000)] if r.row.doc_id == 6 else all_lags(words))
        assert r.collapsed == collapsed(words, runs)
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="repeats"):
        periodic_runs.periodic_runs(docs, repeats=2)


def test_query_equals_brute_force(spark):
    given = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    wanted = {}
    for key, text in given:
        words = words_of(text)
        n, h = len(words), zlib.crc32(str(key).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = all_lags(words) if n < 1500 else [(int(s), int(c), int(q)) for s, c, q in periodic_runs.find_runs(np.unique(words, return_inverse=True)[1], 24, 3)]
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
        lines = "".join(f"{s},{c},{q}\n" for s, c, q in runs)
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed(words, runs))]
        wanted[key] = (key, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *digest, n)
    found = QUERIES["op11_periodic_runs"](spark, FOLDER).collect()
    assert len(found) == len(given) == len(wanted)
    assert {r.doc_id: tuple(r) for r in found} == wanted
    assert sum(r.n_runs for r in found) > 10

"""Registered queries next to their SQL, or to a brute-force version."""

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from annalist.llm.oracles import SQL
from annalist.llm.queries import QUERIES
from checks import compare as checks_compare
from checks.compare import compare, database

FOLDER = "/root/testdata/sf0.001"
PYTHON = re.compile(r"Python|Pandas|Arrow")
CROSS = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def connection():
    return database(FOLDER)


def given(columns: str, name: str = "documents"):
    return duckdb.sql(f"SELECT {columns} FROM '{FOLDER}/{name}.parquet'").fetchall()


def rows(spark, name):
    return QUERIES[name](spark, FOLDER).collect()


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, connection, name, monkeypatch):
    if name == "pipeline":
        pytest.skip("not in this table")
    monkeypatch.setattr(checks_compare, "SQL", SQL)
    df = QUERIES[name](spark, FOLDER)
    assert not CROSS.search(df._jdf.queryExecution().executedPlan().toString())
    same, note = compare(df, connection, name)
    assert same, note


@pytest.mark.parametrize("name", ["op4_chat_formatting", "op6_line_dedup", "op8_quality_rules"])
def test_native_operators_run_no_python(spark, name):
    assert not PYTHON.search(QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString())


def test_all_operators_are_registered():
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES if n != "corpus_flags"} == set(range(1, 14))


def test_jaccard_join_equals_all_pairs(spark):
    sets = {}
    for key, text in given("doc_id, coalesce(text, '')"):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        sets[key] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    links, root = Counter(), {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                p, q = sorted((find(a), find(b)))
                root[q] = p
    found = rows(spark, "op5_jaccard_join")
    assert {r.doc_id: (r.n_links, r.class_id) for r in found} == {k: (links[k], find(k)) for k in keys}
    assert len(found) == len(keys)


def test_packing_places_every_token(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = {}
    for key, text in given("doc_id, coalesce(text, '')"):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], dtype="<u4")
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        for piece, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            expected[key, piece] = (a, b - a, zlib.crc32(ids[a:b].tobytes()))
    found = rows(spark, "op10_best_fit_packing")
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in found} == expected
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    bound = -(-sum(r.length for r in found) // 1024)
    assert len(sequences) <= 1.02 * bound + 1


def test_sharding_is_a_partition(spark):
    found = rows(spark, "op7_sharding")
    expected = sorted((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in given("doc_id, text"))
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in found) == expected
    by_shard = defaultdict(list)
    for r in found:
        by_shard[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert set(by_shard) == set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert max(map(len, by_shard.values())) - min(map(len, by_shard.values())) <= 1


def test_sampled_pieces_decode_to_the_text(spark):
    found = rows(spark, "op2_piece_sampling")
    assert len(found) == len(given("doc_id")) and all(r.lossless for r in found)


def test_toxicity_rows(spark):
    found = rows(spark, "op3_toxicity")
    assert sorted(r.doc_id for r in found) == sorted(k for (k,) in given("doc_id"))
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_languages_held_out(spark):
    found = {r.doc_id: r for r in rows(spark, "op9_language_id")}
    held = [(found[k].lang_pred, lang) for k, lang in given("doc_id, lang") if zlib.crc32(str(k).encode()) % 4 == 2]
    assert len(found) == len(given("doc_id"))
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found.values())

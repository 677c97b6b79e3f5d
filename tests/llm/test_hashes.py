"""Texts made so that sums modulo 2^64 cannot tell them apart."""

import subprocess
import sys
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from annalist.llm import jaccard_join, packing, piece_sampling
from annalist.llm.arrays import PrimeHashes, SpanHashes, distinct_spans, joined_points

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SWAP = str.maketrans("ab", "ba")


def thue_morse(size: int) -> str:
    word = "a"
    while len(word) < size:
        word += word.translate(SWAP)
    return word


ONE = thue_morse(2048)
TEXTS = [ONE, ONE.translate(SWAP), f"{ONE} {ONE.translate(SWAP)}", f"{ONE.translate(SWAP)} {ONE}"]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").coalesce(1).cache()


def test_contents_are_told_apart():
    codes, starts = joined_points(TEXTS[:2])
    start, end = starts[:-1], starts[1:] - 1
    assert len(set(SpanHashes(codes).get(start, end).tolist())) == 1
    assert len(set(PrimeHashes(codes).get(start, end).tolist())) == 2
    example, which = distinct_spans(codes, start, end)
    assert example.tolist() == [0, 1] and which.tolist() == [0, 1]


def test_prime_hashes_follow_the_content():
    codes = np.array([5, 6, 7, 5, 6, 7, 6], dtype=np.uint32)
    at = np.arange(5)
    found = PrimeHashes(codes).get(at, at + 2).tolist()
    assert found[0] == found[3] and found[1] == found[4] and len(set(found)) == 3
    long = np.arange(3_000_000, dtype=np.uint32) % 1000
    first, second = PrimeHashes(long).get(np.array([0, 2_999_000]), np.array([1000, 3_000_000])).tolist()
    assert first == second


def test_pieces_stay_lossless(documents):
    rows = piece_sampling.decoded(piece_sampling.encoded(documents, PIECES), F.col("ids"), PIECES).collect()
    assert [r.text for r in sorted(rows, key=lambda r: r.row.row.doc_id)] == TEXTS


def test_ids_are_those_of_the_library(documents):
    library = Tokenizer.from_file(BPE)
    rows = packing.packed(documents, BPE, capacity=4096, with_ids=True).collect()
    assert {r.id: r.ids for r in rows} == {i: [*library.encode(t, add_special_tokens=False).ids, 2] for i, t in enumerate(TEXTS)}


def test_texts_without_a_common_shingle_are_no_class(documents):
    rows = jaccard_join.similar(documents).collect()
    assert len({r.class_id for r in rows}) == len(TEXTS)
    assert jaccard_join.without_similar(documents).count() == len(TEXTS)


def test_shingles_of_a_batch_hold_little_memory():
    """In a fresh process, as powers stay with a worker: a batch of 4 MB is hashed in small slices."""
    code = """
import tracemalloc
import pyarrow as pa
from annalist.llm import jaccard_join as j
texts = [" ".join(f"w{i * k}" for k in range(3000)) for i in range(1, 201)]
batch = pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array(texts)], names=["id", "text"])
tracemalloc.start()
assert sum(b.num_rows for b in j._features(1)([batch])) == 200
print(tracemalloc.get_traced_memory()[1] >> 20)
"""
    peak = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=Path(__file__).parents[2])
    assert int(peak.stdout) < 60

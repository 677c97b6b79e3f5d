"""Alignment of two tokenizers against sets of ends."""

import hashlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from annalist.llm import alignment
from annalist.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1]), alignment.byte_level_tokens(PATHS[0]), alignment.piece_tokens(PATHS[1])


def by_library(library, text):
    """Ids and byte ends of both, or none."""
    a, b, *spelled = library
    ids = a.encode(f" {text}", add_special_tokens=False).ids if text else [], b.encode(text or "")
    joined = [b"".join(t[i] for i in x) for t, x in zip(spelled, ids, strict=True)]
    if not text or joined[0] != f" {text}".encode() or joined[1] != joined[0]:
        return [], [], [], []
    return *ids, *(np.cumsum([len(t[i]) for i in x]).tolist() for t, x in zip(spelled, ids, strict=True))


def by_sets(a, b, ends_a, ends_b):
    """Number of overlapping pairs, links, and the groups as written."""
    spans = [list(zip([0, *ends], ends)) for ends in (ends_a, ends_b)]
    overlaps = sum(s < y and x < e for s, e in spans[0] for x, y in spans[1]) if len(a) < 800 else None
    common = sorted(set(ends_a) & set(ends_b))
    links = [(a[ends_a.index(end)], b[ends_b.index(end)]) for end in common]
    groups = []
    for start, end in zip([0, *common], common):
        sides = [",".join(str(i) for i, e in zip(ids, ends, strict=True) if start < e <= end) for ids, ends in ((a, ends_a), (b, ends_b))]
        groups.append("|".join(sides))
    return overlaps, links, ";".join(groups)


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 200), min_size=1), st.sets(st.integers(0, 200)), st.randoms())
def test_galloping_finds_places(long, short, random):
    long = np.array(sorted(long), dtype=np.int64)
    short = np.array([x for x in sorted(short) if x <= long[-1]], dtype=np.int64)
    guess = np.array([random.randrange(-3, 210) for _ in short], dtype=np.int64)
    assert alignment.galloped(short, long, guess).tolist() == np.searchsorted(long, short).tolist()


def test_edges(spark, library):
    texts = [
        (1, None), (2, ""), (3, " "), (4, "  two  spaces\n\nand lines "), (5, "</s>[INST] <|endoftext|> <0x41> <unk>"),
        (6, "日本語 🙂 é é \x00 \x1c"), (7, "a ▁ that is no space"), (None, "no id"), (8, "same"), (8, "same"), (9, "x" * 3000), (10, "ﬁ ½ ＡＢ"),
    ]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in texts], "doc_id long, text string, n_a int, links string")
    found = alignment.aligned(docs, *PATHS)
    assert found.columns == ["row", *alignment.RESULTS] and found.schema["row"].dataType == docs.schema
    rows = found.collect()
    assert len(rows) == len(texts)
    for r in rows:
        a, b, ends_a, ends_b = by_library(library, r.row.text)
        overlaps, links, groups = by_sets(a, b, ends_a, ends_b)
        assert (r.a_ids, r.b_ids, r.n_a, r.n_b) == (a, b, len(a), len(b)), r.row.text
        assert [(x.a, x.b) for x in r.links] == links and r.groups == groups and r.n_groups == len(links)
        assert overlaps is None or r.n_overlaps == overlaps
        for cuts, ends in ((r.a_cuts, ends_a), (r.b_cuts, ends_b)):
            assert [ends[c - 1] for c in cuts] == sorted(set(ends_a) & set(ends_b))
    assert next(r for r in rows if r.row.doc_id == 7).n_a == 0
    assert alignment.aligned(docs.limit(0), *PATHS).count() == 0
    # Extra columns keep their names through the scores; repeated rows stay apart.
    rest = found.selectExpr("row.doc_id AS doc_id", "n_a", "links", "groups AS `a b`")
    scored = alignment.scored(rest, *PATHS)
    assert scored.columns == ["doc_id", "n_a", "a b", "n_links", "n_best", "count_sum"]
    assert Counter(r.doc_id for r in scored.collect()) == Counter(i for i, _ in texts)
    assert alignment.scored(rest.limit(0), *PATHS).count() == 0


def test_query_equals_brute_force(spark, library):
    given = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    parts, counts = {}, Counter()
    for key, text in given:
        a, b, ends_a, ends_b = by_library(library, text)
        common = set(ends_a) & set(ends_b)
        links = list(zip([i for i, e in zip(a, ends_a, strict=True) if e in common], [i for i, e in zip(b, ends_b, strict=True) if e in common], strict=True))
        groups, last_a, last_b = [], 0, 0
        for at_a, at_b in zip([n for n, e in enumerate(ends_a, 1) if e in common], [n for n, e in enumerate(ends_b, 1) if e in common], strict=True):
            groups.append(f"{','.join(map(str, a[last_a:at_a]))}|{','.join(map(str, b[last_b:at_b]))}")
            last_a, last_b = at_a, at_b
        counts.update(links)
        parts[key] = (len(a), len(b), len(links), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if links else "")
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    wanted = {
        key: (key, n_a, n_b, n, n, sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), digest, n_a + n_b - n)
        for key, (n_a, n_b, n, links, digest) in parts.items()
    }
    found = QUERIES["op12_token_alignment"](spark, FOLDER).collect()
    assert len(found) == len(given) and {r.doc_id: tuple(r) for r in found} == wanted
    assert len(counts) <= alignment.most_links(*PATHS)

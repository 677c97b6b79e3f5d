"""The field over lines against summing over all labellings, and its accuracy on labels it did not see."""

import itertools
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from annalist.llm import line_quality
from annalist.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def some_model(seed=3):
    rng = np.random.default_rng(seed)
    own, before, behind = rng.normal(size=(3, line_quality.FEATURES))
    return line_quality.Model(own, before / 3, behind / 3, 0.2, rng.normal(size=(2, 2)), 1.7, -0.4, 0.6)


def by_enumeration(features, model):
    """Probability of "bad" of each line: the sum over all labellings of a text."""
    n = len(features)
    z = []
    for i in range(n):
        z.append(model.bias + sum(model.own[f] for f in features[i]))
        z[i] += sum(model.before[f] for f in features[i - 1]) if i else 0
        z[i] += sum(model.behind[f] for f in features[i + 1]) if i + 1 < n else 0
    total, bad = 0.0, np.zeros(n)
    for labels in itertools.product((0, 1), repeat=n):
        weight = np.exp(sum(z[i] for i in range(n) if labels[i]) + sum(model.pairs[a, b] for a, b in itertools.pairwise(labels)))
        total += weight
        bad += weight * np.array(labels)
    return bad / total


TEXTS = [
    "One line only.", "A good line of words.\n\nBUY!! NOW!!\nword word word word\n  \nend | of | it", "", " \n\t\n", None, "\n\nx\n", "1 2 3\n1 2 3\n1 2 3\n$$$ ###\né É ß 日本",
]


def test_scores_equal_summing_over_all_labellings(spark):
    model = some_model()
    docs = spark.createDataFrame([(i, t, 0.5, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, score double, lines string")
    found = line_quality.score(docs, model)
    assert found.columns == ["row", "score", "quality", "lines"] and found.schema["row"].dataType == docs.schema
    rows = found.collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        text = r.row.text or ""
        lines = [line for line in text.split("\n") if line.strip()]
        assert [text[x.start : x.start + x.length] for x in r.lines] == lines
        if not lines:
            assert r.quality is None and r.score == pytest.approx(model.empty)
            continue
        bad = by_enumeration(line_quality.measured([text]).features, model)
        assert [x.good for x in r.lines] == pytest.approx((1 - bad).tolist(), abs=1e-9)
        quality = sum((1 - p) * len(line) for p, line in zip(bad, lines, strict=True)) / sum(map(len, lines))
        assert r.quality == pytest.approx(quality)
        assert r.score == pytest.approx(1 / (1 + np.exp(-(1.7 * np.log(quality / (1 - quality)) - 0.4))))
    assert line_quality.score(docs.limit(0), model).count() == 0


def test_pairs_equal_summing_over_all_labellings():
    """Joint probabilities of neighbours, on which training rests."""
    model = some_model(5)
    lines = line_quality.measured(["a b\nc d e\nF!! G!!", "x", "p | q\nr r r r r\nend.\n2 3"])
    chains = line_quality.Chains(lines.text, lines.features)
    bad, joint = chains.marginals(chains.potentials(model), model.pairs)
    at = np.flatnonzero(chains.inner)
    assert joint.sum(axis=(1, 2)) == pytest.approx(1)
    assert joint[:, 1, :].sum(axis=1) == pytest.approx(bad[at - 1]) and joint[:, :, 1].sum(axis=1) == pytest.approx(bad[at])


def test_measures_of_a_line():
    """Which bins a line falls in."""
    lines = line_quality.measured(["The end.\nTHE END\nw w w w\nThe end.", "The end."])
    names = list(line_quality.MEASURES)
    bins = {name: (lines.features[:, i] - line_quality._OFFSETS[i]).tolist() for i, name in enumerate(names)}
    assert bins["repeated"] == [0, 0, 0, 1, 0]
    assert bins["words"] == [2, 2, 3, 2, 2]
    assert bins["upper"][1] == len(line_quality.SHARES) and bins["upper"][2] == 0
    assert bins["stutter"] == [0, 0, np.searchsorted(line_quality.SHARES, 0.75, side="right"), 0, 0]


def test_slices_and_long_texts_score_alike():
    model = some_model(8)
    texts = ["\n".join(f"line {i} of {i % 7} ${i}" for i in range(5000)), *(t or "" for t in TEXTS)]
    together, one = line_quality._scores(texts, model), [line_quality._scores([t], model) for t in texts]
    assert together[0].tolist() == pytest.approx([x[0][0] for x in one])


def test_odd_tables(spark):
    docs = spark.createDataFrame([(i, f"good words in line {i}.\nand more" if i % 3 else "BAD!! BAD!!\nok line.", 1) for i in range(90)] + [(None, "no id", 1), (5, None, 1)], "doc_id long, text string, label int")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(90)] + [(4, None), (None, 0), (7, 1), (200, 0)], "doc_id long, quality int")
    model = line_quality.fit(docs, labels)
    rows = line_quality.score(docs, model).collect()
    assert len(rows) == 92
    assert all((r.score >= 0.7) == (r.row.doc_id % 3 > 0) for r in rows if r.row.doc_id is not None and r.row.text)
    marked = next(r for r in rows if r.row.doc_id == 3)
    assert marked.lines[0].good < 0.5
    kept = line_quality.without_bad(docs, model)
    assert kept.columns == docs.columns
    # One label only, or none.
    assert {r.score for r in line_quality.score(docs, line_quality.fit(docs, labels.where("quality = 1"))).select(F.round("score", 3).alias("score")).collect()} == {1.0}
    assert {r.score for r in line_quality.score(docs, line_quality.fit(docs, labels.limit(0))).collect()} == {0.5}
    assert line_quality.score(docs, line_quality.fit(docs.limit(0), labels)).count() == 92


@pytest.fixture(scope="module")
def found(spark):
    return QUERIES["op13_line_quality"](spark, FOLDER).collect()


def test_query_on_unseen_labels(found):
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{FOLDER}/labels.parquet'").fetchall())
    ids = [r[0] for r in duckdb.sql(f"SELECT doc_id FROM '{FOLDER}/documents.parquet'").fetchall()]
    assert sorted(r.doc_id for r in found) == sorted(ids)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    unseen = [r for r in found if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in unseen) >= 0.95 * len(unseen)


def test_unseen_labels_change_nothing(spark, found):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    turned = labels.withColumn("quality", F.when(line_quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.row.doc_id: r.score for r in line_quality.score(docs, line_quality.fit(docs, turned)).collect()}
    assert again == pytest.approx({r.doc_id: r.score for r in found})

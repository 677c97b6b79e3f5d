import hashlib
import math
from collections import Counter

import pytest

from annalist.operators import curation
from checks.curation_queries import languages
from checks.registry import Tables


def test_every_text_has_a_perplexity_row(spark):
    docs = spark.createDataFrame([(1, "abcd"), (2, "ab"), (3, ""), (4, None), (5, "a\nb")], "doc_id long, text string")
    places = curation.trigrams(docs)
    model = curation.trigram_model(curation.trigram_counts(curation.trigrams(docs.filter("doc_id IN (1, 4)"))))
    for small in (0, 500_000):
        found = {r["doc_id"]: r["perplexity"] for r in curation.trigram_perplexity(places, model, small=small).collect()}
        assert set(found) == {1, 2, 3, 4, 5}
        assert {k for k in found if found[k] is None} == {2, 3, 4}
        # Each pair has one known letter of two: (1 + 1) / (1 + 2 + 1).
        assert round(found[1], 9) == 2.0


def test_trigrams_are_of_whole_characters(spark):
    docs = spark.createDataFrame([(1, "A\U0001f600\néx")], "doc_id long, text string")
    assert [r["trigram"] for r in curation.trigrams(docs).collect()] == ["a\U0001f600\n", "\U0001f600\né", "\néx"]


def grams(text):
    return Counter(text.lower()[i : i + 3] for i in range(len(text) - 2))


def kept_back(key):
    return hashlib.md5(str(key).encode()).hexdigest()[0] in "012"


@pytest.mark.parametrize("small", [0, 500_000])
def test_language_scores_equal_brute_force(spark, small):
    texts = {"en": "the cat and the dog", "de": "der Hund und die Katze", None: "the und"}
    rows = [(i, lang, f"{text} {i}") for i, (lang, text) in enumerate(list(texts.items()) * 20)]
    rows += [(100, "en", None), (101, "de", ""), (102, None, "ab"), (103, "fr", None)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    counts = {"de": Counter(), "en": Counter()}
    for key, lang, text in rows:
        if lang in counts and text and not kept_back(key):
            counts[lang] += grams(text)
    known = len(set().union(*counts.values()))
    profiles = curation.language_profiles(curation.profile_counts(docs))
    assert profiles.languages == ["de", "en"]
    found = {r["doc_id"]: r["scores"] for r in curation.language_scores(docs, profiles, small=small).collect()}
    assert set(found) == {key for key, _, _ in rows}
    for key, _, text in rows:
        here = grams(text or "")
        if not here:
            assert found[key] is None
            continue
        for lang, score in zip(profiles.languages, found[key], strict=True):
            size = sum(counts[lang].values()) + known
            expected = sum(n * math.log((counts[lang][g] + 1) / size) for g, n in here.items()) / sum(here.values())
            assert math.isclose(score, expected, rel_tol=1e-9)


def test_odd_labels(spark):
    def answers(rows):
        docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
        profiles = curation.language_profiles(curation.profile_counts(docs))
        scores = curation.language_scores(docs, profiles)
        profiles = curation.calibrated(profiles, scores, docs)
        found = scores.select("doc_id", curation.profiled_language(scores["scores"], profiles).alias("x"))
        return {r["doc_id"]: tuple(r["x"]) for r in found.collect()}

    assert answers([(1, None, "some text"), (2, "en", None)]) == {1: (None, None), 2: (None, None)}
    assert answers([]) == {}
    # One language leaves no choice; it needs a document that teaches.
    learning = [key for key in range(40) if not kept_back(key)][:2]
    assert answers([(learning[0], "en", "some text"), (learning[1], None, "xyz")]) == {k: ("en", 1.0) for k in learning}
    # Equal profiles share evenly, and the first name wins.
    one, two = learning
    assert answers([(one, "en", "same"), (two, "de", "same")]) == {k: ("de", 0.5) for k in learning}
    counts = curation.profile_counts(spark.createDataFrame([(one, "en", "same"), (two, "de", "same")], "doc_id long, lang string, text string"))
    with pytest.raises(ValueError, match="more than 1 languages"):
        curation.language_profiles(counts, most_languages=1)


def test_languages_of_documents_held_back(spark):
    t = Tables(spark, "/root/testdata/sf0.01")
    labels = {r["doc_id"]: r["lang"] for r in t.documents.select("doc_id", "lang").collect()}
    held = [r for r in languages(t).collect() if kept_back(r["doc_id"]) and labels[r["doc_id"]]]
    right = [r["lang"] == labels[r["doc_id"]] for r in held]
    assert len(held) > 100 and sum(right) / len(right) >= 0.98
    # What a confidence claims is how often it is right.
    assert abs(sum(r["confidence"] for r in held) / len(held) - sum(right) / len(right)) < 0.03
    sure = [r["lang"] == labels[r["doc_id"]] for r in held if r["confidence"] >= curation.MIN_CONFIDENCE]
    assert len(sure) >= 0.95 * len(held) and sum(sure) >= 0.99 * len(sure)
    print(len(held), sum(right) / len(right), sum(r["confidence"] for r in held) / len(held), len(sure))


def test_trigrams_leave_tasks_as_counts_and_sums(spark):
    """No row per place of a text: counts and means are those of the exploded places, copies of a key and odd texts included."""
    texts = ["A\U0001f600\néx", "", None, "ab", "abc", "İstanbul ßtraße", "the cat " * 300, "\x00\x00\x00"]
    rows = [(i % 7 if i % 5 else None, "en" if i % 2 else None, text) for i, text in enumerate(texts * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    places = curation.trigrams(docs)
    counted = curation.good_counts(docs)
    assert sorted(counted.collect()) == sorted(curation.trigram_counts(places).collect())
    model = curation.trigram_model(curation.trigram_counts(curation.trigrams(docs.filter("lang = 'en'")))).localCheckpoint()
    found = {r["doc_id"]: r["perplexity"] for r in curation.perplexities(docs, model).collect()}
    expected = {r["doc_id"]: r["perplexity"] for r in curation.trigram_perplexity(places, model).collect()}
    assert found.keys() == expected.keys()
    assert all(found[k] is None if x is None else math.isclose(found[k], x, rel_tol=1e-9) for k, x in expected.items())
    assert curation.perplexities(docs, model.limit(0)).filter("perplexity IS NOT NULL").count() == 0
    plan = curation.language_scores(docs, curation.language_profiles(counted.selectExpr("'en' AS lang", "*")))._jdf.queryExecution().toString()
    assert "Generate" not in plan and "Generate" not in counted._jdf.queryExecution().toString()

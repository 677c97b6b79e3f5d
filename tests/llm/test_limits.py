import numpy as np
import pytest

from annalist.llm import language_id


def test_more_languages_than_models_are_an_error(spark):
    rows = [(i, f"some words in language {i % 3}", f"l{i % 3}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="most_languages=2"):
        language_id.fit(docs, most_languages=2)
    assert language_id.fit(docs, most_languages=3).langs == ["l0", "l1", "l2"]


def test_every_labelled_text_is_learned(spark):
    """Each text has a letter of its own: the models of 2,000 texts of a language know those of all that may be learned from."""
    rows = [(i, f"some words {chr(0x4E00 + i)}", "en") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = {0x4E00 + r["doc_id"] for r in docs.where(language_id.learned()).select("doc_id").collect()}
    assert len(learned) > 1400
    hashes = language_id.fit(docs).tables[0][0]
    letters = language_id._gram_hash(np.array([[x] for x in range(0x4E00, 0x4E00 + 2000)]))
    assert {0x4E00 + i for i, h in enumerate(letters) if language_id._find(hashes, np.array([h]))[0] >= 0} == learned

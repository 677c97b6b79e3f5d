import re

from annalist.llm import corpus_flags
from annalist.operators import curation
from checks.curation_queries import quality_flags, scores
from checks.registry import Tables

FOLDER = "/root/testdata/sf0.001"


def near_copies(texts, least):
    """Ids that links of all similar pairs connect with a smaller id."""
    sets, label = {}, {key: key for key in texts}
    for key, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        sets[key] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {key: new if group == old else group for key, group in label.items()}
    return {key for key, group in label.items() if group < key}


def test_flags_are_the_union_of_all_reasons(spark):
    t = Tables(spark, FOLDER)
    found = {r["doc_id"]: set(filter(None, r["quality_flag"].split(","))) for r in corpus_flags.run(spark, FOLDER).collect()}
    texts = {r["doc_id"]: r["text"] for r in t.documents.select("doc_id", "text").collect()}
    odd = {r["doc_id"] for r in scores(t).filter(f"perplexity > {curation.MAX_PERPLEXITY}").collect()}
    near = near_copies(texts, curation.NEAR_SIMILARITY)
    assert odd and near
    rest = {r["doc_id"]: set(filter(None, r["quality_flag"].split(","))) for r in quality_flags(t).collect()}
    assert found == {k: rest[k] | ({"perplexity"} if k in odd else set()) | ({"near_duplicate"} if k in near else set()) for k in texts}


def test_reasons_from_frames(spark):
    text = "The house of the man is not on the hill and that was it for the day at which they had come from the sea."
    docs = spark.createDataFrame([(1, "a", text), (2, "a", text + " Or so"), (3, "a", None)], "doc_id long, source string, text string")
    scored = spark.createDataFrame([(1, 21.0), (2, 20.0)], "doc_id long, perplexity double")
    flags = curation.quality_flags(docs, ["source"], scores=scored, near=spark.createDataFrame([(2,)], "doc_id long"))
    found = {r["doc_id"]: r["quality_flag"] for r in flags.collect()}
    assert "perplexity" in found[1] and "near_duplicate" not in found[1]
    assert "near_duplicate" in found[2] and "perplexity" not in found[2]
    assert not {"perplexity", "near_duplicate"} & set(found[3])

"""The pipeline against a row-by-row model of its stages."""

import re
import duckdb
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from annalist.llm import toxicity
from annalist.llm.frames import table
from annalist.llm.oracles import QUALITY_KEPT, quality_counts

FOLDER = "/root/testdata/sf0.001"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_pipeline_equals_a_model(spark):
    texts = dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{FOLDER}/documents.parquet'").fetchall())
    documents = table(spark, FOLDER, "documents")
    model = toxicity.fit(documents, table(spark, FOLDER, "labels"))
    clean = {r.row.doc_id for r in toxicity.score(documents, model).collect() if r.score < 0.5}
    good = duckdb.sql(
        f"WITH d AS (SELECT doc_id AS row_key, text FROM '{FOLDER}/documents.parquet') SELECT row_key FROM ({quality_counts('d')}) WHERE {QUALITY_KEPT}"
    ).fetchall()
    left = sorted(clean & {k for (k,) in good})
    firsts = {}
    for key in sorted(left, key=lambda k: (-len(texts[k]), k)):
        firsts.setdefault(re.sub(r"[\x20\x09-\x0D]", "", texts[key]), key)
    left = sorted(firsts.values())
    sets, root = {k: shingles(texts[k]) for k in left}, {k: k for k in left}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(left):
        for b in left[i + 1 :]:
            if sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    expected = [k for k in left if find(k) == k]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {k: [*tokenizer.encode(texts[k], add_special_tokens=False).ids, 2] for k in expected}
    found, sequences = {}, {}
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    for r in rows:
        found.setdefault(r.doc_id, {})[r.start] = r.input_ids
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert len(r.input_ids) == r.length
    assert {k: [x for _, part in sorted(parts.items()) for x in part] for k, parts in found.items()} == ids
    for places in sequences.values():
        places.sort()
        assert [at for at, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
        assert sum(n for _, n in places) <= 1024
    assert len(sequences) <= 1.02 * -(-sum(map(len, ids.values())) // 1024) + 1


def test_odd_tables_pass_all_stages(spark):
    """Nulls, empty and repeated rows, and an empty table."""
    schema = table(spark, FOLDER, "documents").schema
    odd = spark.createDataFrame([(None, None, None, None, None), (None, None, None, None, None), (1, "", "en", "s", 0), (2, "A text.", None, None, 7), (2, "A text.", None, None, 7)], schema)
    for docs in (odd, odd.limit(0)):
        for _, function in corpus_pipeline.STAGES:
            docs = function(spark, docs, FOLDER)
        assert docs.count() == 0
    assert corpus_pipeline.drop_copies(spark, odd, FOLDER).count() == 2


def test_stages_keep_the_columns(spark):
    docs = table(spark, FOLDER, "documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "quality rules", "exact dedup", "n-gram Jaccard join", "best-fit packing"]
    for name, function in corpus_pipeline.STAGES[:-1]:
        assert function(spark, docs.limit(20), FOLDER).columns == docs.columns, name

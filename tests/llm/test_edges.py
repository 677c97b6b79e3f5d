"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing names: each has a defined result."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from annalist.llm import chat, exact_dedup, jaccard_join, language_id, line_dedup, packing, piece_sampling, quality_rules, sharding, toxicity
from annalist.llm.components import components
from annalist.llm.tokens import Encoder

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
#: Columns with the names that operators use themselves.
CLASH = "row string, id string, key long, k string, score double, kept string, lines string, bucket int, _row int, _bucket int, sketch string, host string, label int, `a b` string, `x.y` int"
SCHEMA = f"doc_id long, text string, lang string, {CLASH}"
TEXTS = [
    (1, "One two three four five six seven"),
    (1, "One two three four five six seven"),
    (2, "One two  three four five six\nseven"),
    (2, "Another text of the same id with words"),
    (None, "A row without an id but with words"),
    (None, "A row without an id but with words"),
    (3, None),
    (4, ""),
    (5, " \n\t \x0b"),
    (6, LONG),
    (7, "x" * 60_000),
    (8, "日本語 🙂 ▁ </s> <|endoftext|> \x00 é"),
    (9, "short"),
]


@pytest.fixture(scope="module")
def odd(spark):
    names = 15
    return spark.createDataFrame([(i, t, "en", *[None] * names) for i, t in TEXTS], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def bare(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_exact_dedup(odd):
    found = exact_dedup.duplicates(odd).collect()
    groups = Counter(bare(t) for _, t in TEXTS)
    assert Counter((r.id, r.group_size, r.sha256) for r in found) == Counter(
        (i, groups[bare(t)], hashlib.sha256(bare(t).encode()).hexdigest()) for i, t in TEXTS
    )
    assert sum(r.kept for r in found) == len(groups)
    one = next(r for r in found if r.kept and r.group_size == 3 and r.points == 34)
    assert one.id == 2 and all(r.keep_id == 2 for r in found if r.sha256 == one.sha256)
    kept = exact_dedup.without_duplicates(odd)
    assert kept.columns == odd.columns and kept.count() == len(groups)


@pytest.mark.parametrize("bits", [1, 4])
def test_exact_dedup_when_fingerprints_collide(odd, bits):
    """Different chunks of one fingerprint are told apart by their bytes."""
    assert exact_dedup.clashing_chunks(odd, bits=bits)
    few = Counter((r.id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.duplicates(odd, bits=bits).collect())
    assert few == Counter((r.id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.duplicates(odd).collect())


def test_recipes_share_chunks(spark):
    """A passage moved to another place keeps its chunks."""
    text = " ".join(hashlib.md5(str(i).encode()).hexdigest() for i in range(2000))
    a, b = (r.recipe for r in exact_dedup.recipes(spark.createDataFrame([(1, text), (2, "something else first " + text)], "doc_id long, text string")).orderBy("id").collect())
    assert len(a) > 20 and len(set(a) & set(b)) >= 0.9 * len(a)


def test_toxicity(odd, none, spark):
    ends = ("", "ness", "st", "ment", "ous", "ty", "dom", "hood")
    bad = [sentence.replace(" ", f" vile{end} ", 1) for end in ends for sentence in ("The garden is green.", "We walk to the river.", "Rain falls on the roof.")]
    good = ["The garden is green.", "We walk to the river.", "Rain falls on the roof.", "Bread is baked daily."]
    rng = random.Random(5)
    texts = [" ".join(rng.sample(good, 3) + ([rng.choice(bad)] if i % 4 == 0 else [])) + f" Number word{i}." for i in range(400)]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(3, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(documents, labels)
    held = [r for r in toxicity.score(documents, model).collect()]
    assert all((r.score >= 0.5) == (r.row.doc_id % 4 == 0) for r in held)
    for r in held:
        spans = [r.row.text[s.start : s.start + s.length] for s in r.offending]
        assert all("vile" in s for s in spans) and len(spans) == (r.row.doc_id % 4 == 0)
    # Known stems, unseen word.
    unseen = spark.createDataFrame([(1, "Oh no.\nThe vilegry of all! Indeed.")], "doc_id long, text string")
    assert toxicity.score(unseen, model).first().score >= 0.5
    scores = {r.row.text: r.score for r in toxicity.score(odd, model).collect()}
    assert len(scores) == len({t for _, t in TEXTS}) and scores[None] == scores[""] == 0
    assert toxicity.score(none, model).count() == 0
    assert toxicity.without_toxic(odd, model).columns == odd.columns
    nothing = toxicity.fit(odd, labels.limit(0))
    assert {r.score for r in toxicity.score(odd, nothing).select(F.round("score", 3).alias("score")).collect()} == {0.0}


def events(*rows):
    return [(1, m, s, k, "assistant", t) for m, s, k, t in rows]


def test_chat_folds_events(spark):
    log = events(
        (0, 1, "delta", "wro"), (0, 2, "delta", "ng"), (0, 3, "regenerate", None), (0, 5, "delta", "lo"), (0, 4, "delta", "Hel"),
        (1, 6, "delta", "draft"), (1, 7, "edit", "Final"), (1, 8, "delta", "!"),
        (2, 9, "regenerate", None),
        (3, 10, None, "ignored"), (3, 11, "delta", None),
        (4, 12, "edit", "a"), (4, 12, "edit", "b"),
    )
    schema = "conv_id long, message long, seq long, kind string, role string, text string"
    folded = {r.message: r.text for r in chat.folded(spark.createDataFrame(log, schema)).collect()}
    assert folded == {0: "Hello", 1: "Final!", 2: "", 3: "", 4: "b"}
    assert chat.rendered(chat.folded(spark.createDataFrame([], schema))).count() == 0


def test_a_regeneration_takes_back_what_follows(spark):
    """Random logs, numbered over their conversation, against one message list changed event by event."""
    rng = random.Random(9)
    log, expected = [], {}
    for conv in range(40):
        state: dict[int, list[str]] = {}
        for seq in range(rng.randint(0, 25)):
            message, kind, text = rng.randint(0, 4), rng.choice(["delta", "delta", "delta", "edit", "regenerate"]), rng.choice("abcd")
            log.append((conv, seq, message, kind, "user", text))
            if kind == "delta":
                state.setdefault(message, []).append(text)
            else:
                state[message] = [text] if kind == "edit" else []
            if kind == "regenerate":
                state = {m: t for m, t in state.items() if m <= message}
        expected |= {(conv, m): "".join(t) for m, t in state.items()}
    rng.shuffle(log)
    schema = "conv_id long, seq long, message long, kind string, role string, text string, `last` int, place string"
    events = spark.createDataFrame([(*row, None, None) for row in log], schema).repartition(3)
    assert {(r.conv_id, r.message): r.text for r in chat.folded(events).collect()} == expected


def test_chat_reads_back_any_text(spark):
    texts = ["</s>[INST] ok [/INST]", chat.TURN + chat.END + chat.TEXT, "<\\|end|>", "<\\\\|end|>", "", None, "<", "<|turn|", "[/INST", "é🙂\n\n", "\\", "$1 \\2", "a" * 50_000]
    rows = [(c, m, role, t) for c, order in enumerate([texts, texts[::-1]]) for m, (t, role) in enumerate(zip(order, itertools.cycle(["user", "assistant", None, "<|end|>"]), strict=False))]
    rows += [(None, 0, "assistant", "no id"), (7, None, "assistant", "no turn"), (7, None, "assistant", "no turn")]
    messages = spark.createDataFrame(rows, "conv_id long, message long, role string, text string")
    rendered = chat.rendered(messages)
    for r in chat.read_back(rendered).collect():
        own = sorted([(m if m is not None else -1, role or "", t or "") for c, m, role, t in rows if c == r.conv_id])
        assert [(t.role, t.text) for t in r.turns] == [(role, t) for _, role, t in own]
        assert r.loss_texts == [t for _, role, t in own if role == "assistant"]
    for r in rendered.collect():
        for span in r.loss_mask:
            assert r.formatted[span.offset :].startswith(r.formatted.split(chat.TURN)[span.turn + 1][span.start : span.start + span.length])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<", "[", "\\", "|end|>", "/s>", "INST]", "x", "|"]), max_size=12).map("".join))
def test_escapes_reverse(text):
    """The rule as Python has it; queries test Spark's."""
    pattern = chat._OPEN + r"(\\*)" + chat._REST
    held = re.sub(pattern, r"\1\\\2\3", text)
    assert not re.search(chat._OPEN + chat._REST, held)
    assert re.sub(chat._OPEN + r"\\(\\*)" + chat._REST, r"\1\2\3", held) == text


def all_pairs(rows, threshold=0.8):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    links = [0] * len(rows)
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
    return links


def test_jaccard_join_odd_rows(odd, none):
    found = Counter((r.id, r.n_links) for r in jaccard_join.similar(odd).collect())
    assert found == Counter((i, n) for (i, _), n in zip(TEXTS, all_pairs(TEXTS), strict=True))
    assert jaccard_join.similar(none).count() == 0
    assert jaccard_join.without_similar(odd).columns == odd.columns


@pytest.mark.parametrize(("bucket", "whole"), [(4, 10), (4, 1000), (600, 1000)])
def test_jaccard_join_of_large_groups(spark, bucket, whole):
    """Near copies, and texts that only share a passage; buckets of 4 force splitting (by shuffles or in tasks), blocks and dense groups."""
    rng = random.Random(1)
    base, passage = [f"b{i}" for i in range(150)], [f"p{i}" for i in range(30)]
    rows = []
    for i in range(60):
        words = list(base)
        words[rng.randrange(150)] = f"e{i}"
        rows.append((i, " ".join(words)))
    for i in range(60, 120):
        rows.append((i, " ".join([*passage, *(f"r{rng.randrange(10**9)}" for _ in range(100))])))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard_join.similar(documents, bucket=bucket, whole=whole).collect()
    assert [r.n_links for r in sorted(found)] == all_pairs(rows)
    assert {r.class_id for r in found if r.id < 60} == {0}


def test_one_of_each_group_stays(spark):
    words = [f"b{i}" for i in range(60)]
    rows = [(5, " ".join(words)), (3, " ".join([*words, "x"])), (9, "quite another text of seven words"), (8, None), (7, "")]
    kept = jaccard_join.without_similar(spark.createDataFrame([*rows, rows[2]], "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in kept) == [3, 7, 8, 9]


def test_needed_runs_reach_the_target():
    miss = 1 - math.prod(1 - math.exp(-p * 0.8) for p in jaccard_join.PICKS)
    assert miss ** jaccard_join.needed_runs() <= 1 - jaccard_join.TARGET_RECALL


def test_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 102), (101, 102), (7, 7), (200, 200), (101, 100)]
    found = {r.a: r.b for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_line_dedup(spark):
    def page(*lines):
        return "<html><head><title>T</title><style>x</style></head><body>" + "".join(f"<p>{x}</p>" for x in lines) + "<!-- c --></body></html>"

    rows = [(i, "http://A.example.com/x", page("Menu", f"own {i}", "Menu", "a &lt; b" if i < 3 else "rare")) for i in range(10)]
    rows += [(20, "http://b.example.com", page("Menu")), (None, None, None), (None, None, "plain"), (9, "http://A.example.com/x", page("Menu", "again"))]
    schema = "page_id long, url string, html string, host string, lines string, line string, key string, `x.y` int"
    found = line_dedup.without_boilerplate(spark.createDataFrame([(*r, *[None] * 5) for r in rows], schema)).collect()
    assert len(found) == len(rows)
    by = {(r.row.page_id, len(r.lines)): r for r in found}
    # On 11 pages of the site; "a < b" is on 3, fewer than the share asks for.
    assert by[0, 5].kept == ["own 0", "a < b"] and by[9, 3].kept == ["again"] and by[20, 2].kept == ["T", "Menu"]
    assert by[5, 5].kept == ["own 5"] and by[None, 0].kept == [] and by[None, 1].kept == ["plain"]
    assert line_dedup.without_boilerplate(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize("size", [sharding.BUCKET_BYTES, 2000])
def test_sharding(odd, none, size):
    found = sharding.shuffled(odd, shards=3, bucket_bytes=size)
    rows = found.collect()
    assert Counter((r.row.doc_id, r.row.text) for r in rows) == Counter(TEXTS)
    assert sorted((r.slot, r.shard) for r in rows) == [(i // 3, i % 3) for i in range(len(TEXTS))]
    assert found.schema["row"].dataType.names == odd.columns
    assert sharding.shuffled(none).count() == 0


def test_sharding_of_one_id(spark):
    """A third of the rows repeat one id: their bucket is cut, and every row stays."""
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("doc_id"), F.lit("the same text").alias("text")).repartition(8)
    found = sharding.shuffled(rows, bucket_bytes=2000)
    assert found.count() == 3000 and found.select("shard", "slot").distinct().count() == 3000
    sizes = sharding.scattered(rows, "doc_id", "text", 0, 2000).groupBy("_bucket", "_part").count().agg(F.max("count")).first()[0]
    assert sizes < 600


def test_quality_rules(odd, none):
    found = {(r.row.doc_id, r.row.text): r for r in quality_rules.judged(odd).collect()}
    assert len(found) == len(set(TEXTS))
    for (_, text), r in found.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        m = r.measures
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        often = {w for w, n in Counter(windows).items() if n > 1}
        places = {i + j for i, w in enumerate(windows) if w in often for j in range(3)}
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (m.n_words, m.word_chars, m.n_repeat_words, m.n_dup_lines) == (len(words), sum(map(len, words)), len(places), len(lines) - len(set(lines)))
        assert m.n_symbols == len(re.findall(r"[#*$%&|<>]", text or "")) and r.kept == (not r.failed)
    assert quality_rules.judged(none).count() == 0
    assert quality_rules.without_low_quality(odd).columns == odd.columns


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text("ab \n\t", max_size=40), min_size=1, max_size=6))
def test_repeated_words_equal_a_model(spark, texts):
    found = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").select("doc_id", quality_rules.measures(F.col("text")).alias("m")).collect()
    for r in found:
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id])
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        places = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
        assert r.m.n_repeat_words == len(places)


def test_language_id(odd, none, spark):
    rng = random.Random(2)
    words = {"aa": ["the", "house", "with", "water", "thing"], "bb": ["das", "haus", "mit", "wasser", "ding"]}
    rows = [(i, " ".join(rng.choices(words[lang], k=20)), lang) for i, lang in enumerate(["aa", "bb"] * 100)]
    rows += [(1000, "null lang", None), (None, "null id", "aa"), (1001, None, "aa")]
    models = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    probe = [(1, "water with the house thing the water house thing"), (2, "wasser mit haus das ding wasser haus mit"), (3, None), (4, "123 !?"), (5, "ж"), (6, "a"), (7, "the " * 50_000)]
    found = {r.row.doc_id: r for r in language_id.predicted(spark.createDataFrame(probe, "doc_id long, text string"), models).collect()}
    assert [found[i].lang_pred for i in (1, 2, 3, 4, 7)] == ["aa", "bb", "und", "und", "aa"]
    assert found[5].lang_pred in {"aa", "bb"} and found[5].rejected and not found[1].rejected
    assert all(0 <= r.score <= 1 for r in found.values()) and found[3].score == 0
    assert language_id.predicted(odd, models).count() == len(TEXTS)
    assert {r.lang_pred for r in language_id.predicted(odd, language_id.fit(none)).collect()} == {"und"}


def test_language_models_sum_to_one():
    """What follows a context, unknown letters included, has probability one, in seen and unseen contexts."""
    import pandas as pd

    values, starts = language_id._characters(["abab baab abba", "aabb", "bbb a"])
    at = language_id._places(values, starts)
    grams = Counter(tuple(int(values[i - 3 + j]) for j in range(4)) for i in at)
    counts = pd.DataFrame([(*g, 0, n) for g, n in grams.items()], columns=["c0", "c1", "c2", "c3", "lang", "n"])
    tables, unseen = language_id._estimate(counts, ["x"])
    letters = sorted({g[3] for g in grams})
    for context in ([97, 98, 97], [98, 98, 97], [122, 98, 97], [122, 122, 122]):
        total = 0.0
        for letter in [*letters, 999]:
            text = np.array([*context, letter], dtype=np.uint64)
            total += float(np.exp(language_id._log_probabilities(text, np.array([3]), tables, unseen))[0, 0])
        assert abs(total - 1) < 1e-5


def test_samples_do_not_depend_on_neighbours():
    words = piece_sampling.vocabulary(PIECES, 1.0)
    texts, keys = ["ab cd", "the other text", ""], np.array([5, 6, 7], dtype=np.uint64)
    joint = piece_sampling.sample(piece_sampling.Lattices(words), texts, keys)
    for i, t in enumerate(texts):
        assert piece_sampling.sample(piece_sampling.Lattices(words), [t], keys[i : i + 1])[0].tolist() == joint[i].tolist()


def test_packing(odd, none):
    placed = packing.packed(odd, BPE, capacity=64, with_ids=True).cache()
    rows = placed.collect()
    tokenizer = Tokenizer.from_file(BPE)
    wanted = Counter()
    for i, t in TEXTS:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        cuts = [0, *range(len(ids) % 64 or 64, len(ids) + 1, 64)]
        wanted.update((i, p, a, tuple(ids[a:b])) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)))
    assert Counter((r.id, r.piece, r.start, tuple(r.ids)) for r in rows) == wanted
    joined = packing.sequences(placed).collect()
    assert sum(len(r.input_ids) for r in joined) == sum(r.length for r in rows) and max(len(r.input_ids) for r in joined) <= 64
    assert packing.packed(none, BPE).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 40), max_size=12))
def test_plan_holds_every_piece(counts):
    used = Counter()
    sequences = 0
    for pattern, times in packing.plan(counts, 30):
        assert sum(pattern) <= 30
        sequences += times
        for length in pattern:
            used[length] += times
    assert used == Counter(counts)
    # Never worse than filling every bin over half.
    assert sequences <= max(1, 2 * math.ceil(sum(k * n for k, n in counts.items()) / 30))


def test_plan_replaces_the_smallest_by_two():
    """Greedy leaves 6 + 3 of 10; 6 + 2 + 2 fills it."""
    assert packing.plan({6: 1, 3: 1, 2: 2}, 10)[0] == ([6, 2, 2], 1)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("ab1 \n\t'sdmtrevl!é²\xa0　🙂́")), max_size=16), max_size=6))
def test_ids_equal_the_tokenizer(texts):
    tokenizer, encoder = _coders()
    assert [x.tolist() for x in encoder.encode(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def _coders(made=[]):  # noqa: B006
    if not made:
        made += [Tokenizer.from_file(BPE), Encoder(BPE, most=50)]
    return made


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=5), st.integers(0, 2**63))
def test_pieces_decode_to_any_text(texts, key):
    words = piece_sampling.vocabulary(PIECES, 0.3)
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    found = piece_sampling.sample(piece_sampling.Lattices(words, most=20), texts, np.full(len(texts), key, dtype=np.uint64))
    assert piece_sampling.decode(words, np.concatenate(found), np.array([len(x) for x in found])) == texts


def test_samples_follow_the_weights():
    """Frequencies of all segmentations of a word against their exact shares."""
    words = piece_sampling.vocabulary(PIECES, 1.0)
    weight = dict(zip(words.ids.tolist(), words.weights.tolist(), strict=True))
    text_of = {i: words.text_bytes[words.text_starts[i] : words.text_starts[i] + words.text_sizes[i]].tobytes().decode() for i in weight}
    by_text = {t: i for i, t in text_of.items()}

    def ways(rest):
        if not rest:
            yield ()
        for size in range(1, len(rest) + 1):
            if rest[:size] in by_text:
                for more in ways(rest[size:]):
                    yield (by_text[rest[:size]], *more)

    exact = {w: math.exp(sum(weight[i] for i in w)) for w in ways(" where")}
    total, draws = sum(exact.values()), 60_000
    keys = np.random.default_rng(1).integers(0, 2**63, draws, dtype=np.uint64)
    found = Counter(tuple(x.tolist()) for x in piece_sampling.sample(piece_sampling.Lattices(words), [" where"] * draws, keys))
    assert set(found) <= set(exact)
    assert all(abs(found[w] / draws - p / total) < 5 * math.sqrt(p / total / draws) + 1e-4 for w, p in exact.items())


def test_piece_sampling(odd, none):
    encoded = piece_sampling.encoded(odd, PIECES)
    found = piece_sampling.decoded(encoded, F.col("ids"), PIECES).collect()
    assert Counter((r.row.row.doc_id, r.text) for r in found) == Counter((i, t or "") for i, t in TEXTS)
    assert piece_sampling.encoded(none, PIECES).count() == 0
    again = {(r.row.doc_id, r.row.text): r.ids for r in piece_sampling.encoded(odd.coalesce(1), PIECES).collect()}
    assert all(again[r.row.row.doc_id, r.row.row.text] == r.row.ids for r in found)

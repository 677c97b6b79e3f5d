"""Curation filters: reasons to keep a document out of a training corpus.

Filters mark rows and delete none. Measures of a text are taken in its row;
statistics over the corpus are counted on narrow rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.functions.text import text_length
from annalist.operators import trigrams as grams

# Limits of the filters.
MIN_CHARS, MAX_CHARS = 100, 1_000_000
MAX_LINE_REPETITION, MAX_WORD_REPETITION = 0.2, 0.3
MIN_CONFIDENCE = 0.85
# The reference's 500 belongs to a word model. Under the trigram model below, the labelled good texts of sf0.001 and sf0.01 stay below 12.2.
MAX_PERPLEXITY = 20.0
NEAR_SIMILARITY = 0.95
IQR_FACTOR = 1.5

# Most trigrams of a model that is sent to all tasks, and most numbers in it (8 bytes each).
BROADCAST_TRIGRAMS, MOST_NUMBERS = 500_000, 8_000_000
# Lists of ids up to this length (8 bytes each) go to the texts, longer ones meet them in a shuffle.
BROADCAST_IDS = 5_000_000

# Each language is a column of the profiles.
MOST_LANGUAGES = 200
# Factors on mean log probabilities that calibration chooses from.
SHARPNESS = (1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0)

# Frequent words by language, for texts without labels to learn from.
PROFILES = {
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach".split(),
    "en": "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec son aux".split(),
}


def length_in_range(text: Column, least: int = MIN_CHARS, most: int = MAX_CHARS) -> Column:
    """Whether the text has between ``least`` and ``most`` code points; null has none."""
    return text_length(text).between(least, most)


def _repetition(parts: Column) -> Column:
    share = 1 - F.size(F.array_distinct(parts)) / F.size(parts)
    return F.when(F.size(parts) > 0, share).otherwise(0.0)


def line_repetition(text: Column) -> Column:
    """Share of lines with text that repeat an earlier one; 0 without lines."""
    return _repetition(F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.btrim(x) != ""))


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[ \t\n\x0B\f\r]+"), "")


def word_repetition(text: Column) -> Column:
    """Share of words, case ignored, that repeat an earlier one; 0 without words."""
    return _repetition(_words(text))


def language(text: Column, profiles: Mapping[str, Sequence[str]] = PROFILES) -> Column:
    """A struct ``lang, confidence``: the profile with most words in the whole text, and its share of all hits.

    Ties go to the first name; without a hit both are null.
    """

    def hit(words: Column, lang: str) -> Column:
        known = list(profiles[lang])
        return F.struct(F.size(F.filter(words, lambda w: w.isin(known))).alias("n"), F.lit(lang).alias("lang"))

    # A one-element array gives its value a name, so that words are split once.
    hits = F.transform(F.array(_words(text)), lambda words: F.array(*[hit(words, lang) for lang in sorted(profiles)])).getItem(0)

    def best(found: Column) -> Column:
        total = F.aggregate(found, F.lit(0), lambda s, x: s + x["n"])
        most = F.array_max(F.transform(found, lambda x: x["n"]))
        first = F.filter(found, lambda x: x["n"] == most).getItem(0)
        return F.struct(
            F.when(total > 0, first["lang"]).alias("lang"), F.when(total > 0, most / total).alias("confidence")
        )

    return F.transform(F.array(hits), best).getItem(0)


def held_back(key: Column) -> Column:
    """Whether a document calibrates the language profiles and so takes no part in learning them: 3 of 16, by a hash of its key."""
    return F.substring(F.md5(key.cast("string").cast("binary")), 1, 1).isin("0", "1", "2")


@dataclass(frozen=True)
class LanguageProfiles:
    """Character trigrams of each language: ``trigram`` and a column of log probabilities per language, in the order of ``languages``.

    ``unseen`` are the log probabilities of a trigram no profile holds,
    ``sharpness`` turns mean log probabilities into calibrated ones.
    """

    languages: list[str]
    table: DataFrame
    unseen: list[float]
    sharpness: float = 1.0

    def columns(self) -> list[str]:
        return [f"_p{i}" for i in range(len(self.languages))]


def profile_counts(documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, trigram, n`` over the whole texts that are labelled and not held back."""
    learned = documents.filter(F.col(lang).isNotNull() & ~held_back(F.col(key)))
    return grams.counts(learned, text, lang).select(F.col("by").alias("lang"), "trigram", "n")


def language_profiles(counts: DataFrame, most_languages: int = MOST_LANGUAGES) -> LanguageProfiles:
    """Add-one smoothed profiles from :func:`profile_counts`, which are read several times: write them first.

    More than ``most_languages`` languages are an error, as each is a column.
    """
    totals = sorted(counts.groupBy("lang").agg(F.sum("n").alias("n")).limit(most_languages + 1).collect())
    if len(totals) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    if not totals:
        return LanguageProfiles([], counts.select("trigram"), [])
    trigrams_known = counts.select(F.count_distinct("trigram")).first()[0]
    sizes = [r["n"] + trigrams_known for r in totals]
    profiles = LanguageProfiles([r["lang"] for r in totals], counts, [-math.log(size) for size in sizes])
    seen = [F.coalesce(F.sum(F.when(F.col("lang") == name, F.col("n"))), F.lit(0)) for name in profiles.languages]
    log_p = [F.log((n + 1) / size).alias(c) for n, size, c in zip(seen, sizes, profiles.columns(), strict=True)]
    return replace(profiles, table=counts.groupBy("trigram").agg(*log_p))


def _fits(table: DataFrame, small: int) -> bool:
    """Whether a table of trigrams may go to every task: few rows, and few numbers in all."""
    most = min(small, MOST_NUMBERS // (len(table.columns) - 1))
    return table.limit(most + 1).count() <= most


def language_scores(documents: DataFrame, profiles: LanguageProfiles, key: str = "doc_id", text: str = "text", small: int = BROADCAST_TRIGRAMS) -> DataFrame:
    """``key, scores``: the mean log probability of the whole text's trigrams under each profile.

    Null for a text without a trigram and without profiles. As with perplexities,
    profiles of bounded size go to the texts; larger ones meet their places in a join.
    """
    if not profiles.languages:
        return documents.select(key, F.lit(None).cast("array<double>").alias("scores"))
    if _fits(profiles.table, small):
        return grams.means(documents, key, text, profiles.table, profiles.columns(), profiles.unseen).withColumnRenamed("means", "scores")
    joined = trigrams(documents, key, text).join(profiles.table, "trigram", "left")
    means = [
        F.avg(F.when(F.col("trigram").isNotNull(), F.coalesce(F.col(c), F.lit(low)))).alias(c)
        for c, low in zip(profiles.columns(), profiles.unseen, strict=True)
    ]
    found = joined.groupBy(key).agg(*means)
    first = F.col(profiles.columns()[0])
    return found.select(key, F.when(first.isNotNull(), F.array(*profiles.columns())).alias("scores"))


def _shares(scores: Column, sharpness: float) -> Column:
    """Log shares of the languages: a softmax of the scores, sharpened."""
    apart = F.transform(scores, lambda x: (x - F.array_max(scores)) * sharpness)
    total = F.log(F.aggregate(F.transform(apart, F.exp), F.lit(0.0), lambda a, x: a + x))
    return F.transform(apart, lambda x: x - total)


def calibrated(profiles: LanguageProfiles, scores: DataFrame, labelled: DataFrame, key: str = "doc_id", lang: str = "lang") -> LanguageProfiles:
    """The profiles with the sharpness that best predicts the labels of documents held back.

    Least log loss over SHARPNESS, with targets drawn in by 1 / (documents + 2), so that
    few or only easy documents do not make every answer certain; the first of equal losses.
    """
    count = len(profiles.languages)
    if count < 2:
        return profiles
    names = F.array(*[F.lit(name) for name in profiles.languages])
    truth = labelled.filter(held_back(F.col(key))).select(key, F.array_position(names, F.col(lang)).cast("int").alias("_true"))
    rows = scores.join(truth.filter(F.col("_true") > 0), key).filter(F.col("scores").isNotNull())
    aside = 1.0 / (rows.count() + 2)

    def loss(sharpness: float) -> Column:
        shares = _shares(F.col("scores"), sharpness)
        own, all_ = F.get(shares, F.col("_true") - 1), F.aggregate(shares, F.lit(0.0), lambda a, x: a + x)
        return F.sum(-(1 - aside) * own - aside / (count - 1) * (all_ - own))

    losses = rows.agg(*[loss(x).alias(f"_{i}") for i, x in enumerate(SHARPNESS)]).first()
    if losses[0] is None:
        return profiles
    return replace(profiles, sharpness=SHARPNESS[min(range(len(SHARPNESS)), key=lambda i: losses[i])])


def profiled_language(scores: Column, profiles: LanguageProfiles) -> Column:
    """A struct ``lang, confidence`` from :func:`language_scores`; ties go to the first name, without scores both are null."""
    names = F.array(*[F.lit(name) for name in profiles.languages]).cast("array<string>")
    best = F.array_position(scores, F.array_max(scores)).cast("int")
    share = F.exp(F.array_max(_shares(scores, profiles.sharpness)))
    return F.struct(F.get(names, best - 1).alias("lang"), F.when(scores.isNotNull(), share).alias("confidence"))


def exact_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, text_hash, copies, duplicate_of`` per row; the least key of equal texts is the original.

    ``duplicate_of`` is null for the original and for rows without a text. Texts
    are hashed where they are read and never shuffled; copies collapse in
    partial aggregates, and AQE splits the rows of a hash held by many.
    """
    hashed = documents.select(key, F.sha2(F.col(text).cast("binary"), 256).alias("text_hash"))
    groups = hashed.filter(F.col("text_hash").isNotNull()).groupBy("text_hash").agg(F.min(key).alias("_first"), F.count(F.lit(1)).alias("copies"))
    return hashed.join(groups, "text_hash", "left").select(
        key, "text_hash", F.coalesce("copies", F.lit(1).cast("long")).alias("copies"), F.when(F.col(key) > F.col("_first"), F.col("_first")).alias("duplicate_of")
    )


def length_fences(documents: DataFrame, by: Sequence[str], column: str = "n_chars", factor: float = IQR_FACTOR) -> DataFrame:
    """``by, low, high``: quartiles widened by ``factor`` times their distance.

    Quartiles are exact, over counts per distinct length.
    """
    counts = documents.filter(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count(F.lit(1)).alias("_n"))
    quartiles = counts.groupBy(*by).agg(F.percentile(column, F.array(F.lit(0.25), F.lit(0.75)), F.col("_n")).alias("_q"))
    low, high = F.col("_q")[0], F.col("_q")[1]
    return quartiles.select(*by, (low - factor * (high - low)).alias("low"), (high + factor * (high - low)).alias("high"))


def outliers(documents: DataFrame, by: Sequence[str], column: str = "n_chars", factor: float = IQR_FACTOR) -> DataFrame:
    """Add ``outlier``: the length lies outside the fences of its group; false for null lengths."""
    fences = length_fences(documents, by, column, factor)
    outside = (F.col(column) < F.col("low")) | (F.col(column) > F.col("high"))
    return documents.join(fences, list(by), "left").withColumn("outlier", F.coalesce(outside, F.lit(False))).drop("low", "high")


def quality_flags(
    documents: DataFrame,
    by: Sequence[str],
    key: str = "doc_id",
    text: str = "text",
    scores: DataFrame | None = None,
    near: DataFrame | None = None,
    languages: DataFrame | None = None,
) -> DataFrame:
    """``key, quality_flag``: names of the filters a document fails, in a fixed order; empty where all pass.

    Two reasons come from frames computed beside this one, and are looked for
    only if these are given: ``perplexity`` from ``scores`` (``key, perplexity``)
    and ``near_duplicate`` from ``near``, the keys of documents to leave out as such.
    ``languages`` (``key, confidence``) takes the place of the word lists.
    """
    found = F.col(text)
    measured = documents.select(
        key,
        *by,
        text_length(found).cast("long").alias("n_chars"),
        length_in_range(found).alias("_length"),
        (line_repetition(found) <= MAX_LINE_REPETITION).alias("_lines"),
        (word_repetition(found) <= MAX_WORD_REPETITION).alias("_words"),
        *([] if languages is not None else [language(found)["confidence"].alias("_confidence")]),
        F.sha2(found.cast("binary"), 256).alias("text_hash"),
    )
    firsts = measured.filter(F.col("text_hash").isNotNull()).groupBy("text_hash").agg(F.min(key).alias("_first"))
    joined = outliers(measured, by).join(firsts, "text_hash", "left")
    if languages is not None:
        joined = joined.join(languages.select(key, F.col("confidence").alias("_confidence")), key, "left")
    reasons = [
        ("length", ~F.col("_length")),
        ("line_repetition", ~F.col("_lines")),
        ("word_repetition", ~F.col("_words")),
        ("language", F.coalesce("_confidence", F.lit(0.0)) < MIN_CONFIDENCE),
    ]
    if scores is not None:
        joined = joined.join(scores.select(key, F.col("perplexity").alias("_perplexity")), key, "left")
        reasons.append(("perplexity", ~perplexity_in_range(F.col("_perplexity"))))
    reasons.append(("duplicate", F.coalesce(F.col(key) > F.col("_first"), F.lit(False))))
    if near is not None:
        joined = joined.join(near.select(key).distinct().withColumn("_near", F.lit(True)), key, "left")
        reasons.append(("near_duplicate", F.col("_near")))
    reasons.append(("outlier", F.col("outlier")))
    return joined.select(key, F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in reasons])).alias("quality_flag"))


def of_ids(texts: DataFrame, ids: DataFrame, key: str, small: int = BROADCAST_IDS) -> DataFrame:
    """The rows whose ``key`` is listed in ``ids``. Texts stay where they are unless the list is too long to send."""
    listed = ids.filter(F.col(key).isNotNull()).distinct()
    return texts.join(F.broadcast(listed) if listed.limit(small + 1).count() <= small else listed, key, "left_semi")


def perplexity_in_range(perplexity: Column, most: float = MAX_PERPLEXITY) -> Column:
    """Whether a perplexity is at most ``most``; a text without one, as it has no trigram, passes."""
    return F.coalesce(perplexity <= most, F.lit(True))


def trigrams(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, trigram``: a row for each place of each whole text in lower case where three characters begin.

    A text without such a place, as one that is null or of two characters, has one row with a null.
    """
    # One pass over the text; every place is matched, as only its first character is consumed.
    parts = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(r"(?s)(?=(...))."), F.lit(1))
    return documents.select(key, F.explode_outer(parts).alias("trigram"))


def trigram_counts(places: DataFrame) -> DataFrame:
    """``trigram, n`` over all texts."""
    return places.filter(F.col("trigram").isNotNull()).groupBy("trigram").agg(F.count(F.lit(1)).alias("n"))


def trigram_model(counts: DataFrame) -> DataFrame:
    """``trigram, log_p`` of a character after the two before it, add-one smoothed, from counts of good texts.

    The counts are read several times: write them first.
    """
    total = counts.withColumn("pair", F.substring("trigram", 1, 2))
    pairs = total.groupBy("pair").agg(F.sum("n").alias("of"))
    letters = total.agg(F.count_distinct(F.substring("trigram", 3, 1))).scalar()
    return total.join(pairs, "pair").select("trigram", F.log((F.col("n") + 1) / (F.col("of") + letters + 1)).alias("log_p"))


def trigram_perplexity(places: DataFrame, model: DataFrame, key: str = "doc_id", small: int = BROADCAST_TRIGRAMS) -> DataFrame:
    """``key, perplexity`` of each text under a model; a trigram unknown to it is as unlikely as its rarest.

    Every key has a row; the perplexity of a text without a trigram is null.
    A model of up to ``small`` trigrams goes to every task, so that no place is
    shuffled; a larger one is joined as AQE sees fit, with the same result.
    """
    known = F.broadcast(model) if model.limit(small + 1).count() <= small else model
    log_p = F.when(F.col("trigram").isNotNull(), F.coalesce(F.col("log_p"), model.agg(F.min("log_p")).scalar()))
    return places.join(known, "trigram", "left").groupBy(key).agg(F.exp(-F.avg(log_p)).alias("perplexity"))


def perplexities(documents: DataFrame, model: DataFrame, key: str = "doc_id", text: str = "text", small: int = BROADCAST_TRIGRAMS) -> DataFrame:
    """``key, perplexity`` as :func:`trigram_perplexity` gives them, without a row per place where the model fits.

    The model is read several times: write it first.
    """
    rarest = model.agg(F.min("log_p")).first()[0]
    if rarest is None or not _fits(model, small):
        return trigram_perplexity(trigrams(documents, key, text), model, key, small)
    found = grams.means(documents, key, text, model, ["log_p"], [rarest])
    return found.select(key, F.exp(-F.get("means", F.lit(0))).alias("perplexity"))


def good_counts(documents: DataFrame, text: str = "text") -> DataFrame:
    """``trigram, n`` over the whole texts."""
    return grams.counts(documents, text).select("trigram", "n")

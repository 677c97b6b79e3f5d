"""Queries of the curation filters."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.operators import curation
from annalist.operators.chains import written
from checks.registry import SQL, Tables, query

_WORDS = r"list_filter(string_split_regex(lower(coalesce(text, '')), '[ \t\n\x0B\f\r]+'), lambda w: w <> '')"
_LINES = "list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, ' ') <> '')"


def _share(parts: str) -> str:
    return f"CASE WHEN len({parts}) > 0 THEN 1 - len(list_distinct({parts})) / len({parts}) ELSE 0.0 END"


_MEASURED = f"""
SELECT doc_id, source, length(coalesce(text, '')) AS n_chars, {_share(_LINES)} AS line_share, {_share(_WORDS)} AS word_share, sha256(text) AS text_hash
FROM documents
"""
_HELD_BACK = "substr(md5(d.doc_id::VARCHAR), 1, 1) IN ('0', '1', '2')"
_LANGUAGE = f"""
WITH c AS (
  SELECT doc_id, substr(t, i::INTEGER, 3) AS trigram, count(*) AS n
  FROM (SELECT doc_id, t, unnest(range(1, length(t) - 1)) AS i FROM (SELECT doc_id, lower(coalesce(text, '')) AS t FROM documents))
  GROUP BY ALL
), known AS (
  SELECT lang, trigram, sum(n) AS n FROM c JOIN documents d ON d.doc_id = c.doc_id WHERE lang IS NOT NULL AND NOT {_HELD_BACK} GROUP BY ALL
), sizes AS (SELECT lang, sum(n) + (SELECT count(DISTINCT trigram) FROM known) AS size FROM known GROUP BY lang
), score AS (
  SELECT c.doc_id, s.lang, sum(c.n * ln((coalesce(k.n, 0) + 1)::DOUBLE / size)) / sum(c.n) AS d
  FROM c CROSS JOIN sizes s LEFT JOIN known k ON k.lang = s.lang AND k.trigram = c.trigram GROUP BY ALL
), apart AS (SELECT *, d - max(d) OVER (PARTITION BY doc_id) AS away, row_number() OVER (PARTITION BY doc_id ORDER BY d DESC, lang) AS place FROM score
), shares AS (
  SELECT *, sharp * away - ln(sum(exp(sharp * away)) OVER (PARTITION BY doc_id, sharp)) AS share
  FROM apart CROSS JOIN (VALUES {', '.join(f'({x}::DOUBLE)' for x in curation.SHARPNESS)}) AS grid(sharp)
), answers AS (
  SELECT h.doc_id, h.sharp, sum(share) FILTER (h.lang = d.lang) AS own, sum(share) AS everything
  FROM shares h JOIN documents d ON d.doc_id = h.doc_id WHERE {_HELD_BACK} AND d.lang IN (SELECT lang FROM sizes) GROUP BY ALL
), numbers AS (SELECT 1.0::DOUBLE / (count(DISTINCT doc_id) + 2) AS aside, (SELECT count(*) FROM sizes) AS languages FROM answers
), chosen AS (
  SELECT sharp FROM answers, numbers WHERE languages > 1 GROUP BY sharp
  ORDER BY sum(-(1 - aside) * own - aside / (languages - 1) * (everything - own)), sharp LIMIT 1
)
SELECT d.doc_id, h.lang AS lang_found, exp(h.share) AS confidence
FROM documents d LEFT JOIN (SELECT * FROM shares WHERE place = 1 AND sharp = coalesce((SELECT sharp FROM chosen), 1)) h ON h.doc_id = d.doc_id
"""
_FENCES = """
SELECT source, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high
FROM (SELECT source, quantile_cont(length(coalesce(text, '')), 0.25) AS q1, quantile_cont(length(coalesce(text, '')), 0.75) AS q3 FROM documents GROUP BY source)
"""


@query("length_filter", "SELECT doc_id, length(coalesce(text, '')) BETWEEN 100 AND 1000000 AS kept FROM documents")
def length_filter(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", curation.length_in_range(F.col("text")).alias("kept"))


@query(
    "repetition_filter",
    f"SELECT doc_id, round(line_share, 6) AS line_share, round(word_share, 6) AS word_share, line_share <= 0.2 AND word_share <= 0.3 AS kept FROM ({_MEASURED})",
)
def repetition_filter(t: Tables) -> DataFrame:
    lines, words = curation.line_repetition(F.col("text")), curation.word_repetition(F.col("text"))
    found = t.texts.select("doc_id", lines.alias("line_share"), words.alias("word_share"))
    kept = (F.col("line_share") <= curation.MAX_LINE_REPETITION) & (F.col("word_share") <= curation.MAX_WORD_REPETITION)
    return found.select("doc_id", F.round("line_share", 6).alias("line_share"), F.round("word_share", 6).alias("word_share"), kept.alias("kept"))


@query("lang_id", f"SELECT doc_id, lang_found, round(confidence, 6) AS confidence FROM ({_LANGUAGE})")
def lang_id(t: Tables) -> DataFrame:
    return languages(t).select("doc_id", F.col("lang").alias("lang_found"), F.round("confidence", 6).alias("confidence"))


def languages(t: Tables) -> DataFrame:
    """``doc_id, lang, confidence`` by profiles of the labelled texts, a row for every document."""
    texts = t.texts.select("doc_id", "lang", "text")
    profiles = curation.language_profiles(written(curation.profile_counts(texts), "profile-counts"))
    profiles = replace(profiles, table=written(profiles.table, "profiles"))
    scored = written(curation.language_scores(texts, profiles), "language-scores")
    profiles = curation.calibrated(profiles, scored, t.documents.select("doc_id", "lang"))
    return scored.select("doc_id", curation.profiled_language(F.col("scores"), profiles).alias("_found")).select("doc_id", "_found.*")


@query(
    "exact_duplicates",
    """
    SELECT doc_id, sha256(text) AS text_hash, count(*) OVER (PARTITION BY text) AS copies,
      nullif(min(doc_id) OVER (PARTITION BY text), doc_id) AS duplicate_of
    FROM documents
    """,
)
def exact_duplicates(t: Tables) -> DataFrame:
    return curation.exact_duplicates(t.documents)


@query(
    "outliers",
    f"SELECT d.doc_id, length(coalesce(text, '')) < low OR length(coalesce(text, '')) > high AS outlier FROM documents d JOIN ({_FENCES}) f ON d.source = f.source",
)
def outliers(t: Tables) -> DataFrame:
    lengths = t.documents.select("doc_id", "source", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"))
    return curation.outliers(lengths, ["source"]).select("doc_id", "outlier")


@query(
    "quality_flags",
    f"""
    SELECT m.doc_id, concat_ws(',', CASE WHEN m.n_chars NOT BETWEEN 100 AND 1000000 THEN 'length' END,
      CASE WHEN line_share > 0.2 THEN 'line_repetition' END, CASE WHEN word_share > 0.3 THEN 'word_repetition' END,
      CASE WHEN coalesce(confidence, 0) < 0.85 THEN 'language' END,
      CASE WHEN m.doc_id > min(m.doc_id) OVER (PARTITION BY text_hash) THEN 'duplicate' END,
      CASE WHEN m.n_chars < low OR m.n_chars > high THEN 'outlier' END) AS quality_flag
    FROM ({_MEASURED}) m JOIN ({_LANGUAGE}) l ON l.doc_id = m.doc_id JOIN ({_FENCES}) f ON f.source = m.source
    """,
)
def quality_flags(t: Tables) -> DataFrame:
    flags = curation.quality_flags(t.texts, ["source"], languages=languages(t))
    return flags.select("doc_id", F.concat_ws(",", "quality_flag").alias("quality_flag"))


@query(
    "trigram_perplexity",
    """
    WITH c AS (
      SELECT doc_id, substr(t, i::INTEGER, 3) AS trigram, count(*) AS n
      FROM (SELECT doc_id, t, unnest(range(1, length(t) - 1)) AS i FROM (SELECT doc_id, lower(coalesce(text, '')) AS t FROM documents))
      GROUP BY ALL
    ), total AS (
      SELECT trigram, sum(n) AS n FROM c JOIN labels l ON l.doc_id = c.doc_id AND l.quality = 1 GROUP BY trigram
    ), pairs AS (SELECT substr(trigram, 1, 2) AS pair, sum(n) AS of_pair FROM total GROUP BY 1
    ), model AS (
      SELECT trigram, ln((n + 1)::DOUBLE / (of_pair + (SELECT count(DISTINCT substr(trigram, 3, 1)) FROM total) + 1)) AS log_p
      FROM total JOIN pairs ON pair = substr(trigram, 1, 2)
    )
    SELECT d.doc_id, p.perplexity FROM documents d LEFT JOIN (
      SELECT doc_id, round(exp(-sum(n * coalesce(log_p, (SELECT min(log_p) FROM model))) / sum(n)), 4) AS perplexity
      FROM c LEFT JOIN model USING (trigram) GROUP BY doc_id
    ) AS p ON p.doc_id = d.doc_id
    """,
)
def trigram_perplexity(t: Tables) -> DataFrame:
    """A row for every document; null where there is no trigram."""
    return scores(t).select("doc_id", F.round("perplexity", 4).alias("perplexity"))


def scores(t: Tables) -> DataFrame:
    """Perplexities under a model of the labelled good texts."""
    good = curation.of_ids(t.texts.select("doc_id", "text"), t.labels.filter("quality = 1").select("doc_id"), "doc_id")
    model = curation.trigram_model(written(curation.good_counts(good), "trigrams"))
    return curation.perplexities(t.texts, written(model, "trigram-model"))


@query(
    "perplexity_filter",
    f"""SELECT d.doc_id, p.perplexity, coalesce(p.perplexity <= {curation.MAX_PERPLEXITY}, true) AS kept
    FROM documents d LEFT JOIN ({SQL['trigram_perplexity']}) p ON p.doc_id = d.doc_id""",
)
def perplexity_filter(t: Tables) -> DataFrame:
    """A row for every document, also for those without a trigram."""
    found = scores(t).select("doc_id", F.round("perplexity", 4).alias("perplexity"))
    return found.select("*", curation.perplexity_in_range(F.col("perplexity")).alias("kept"))

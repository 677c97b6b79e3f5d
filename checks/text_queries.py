"""Column functions, canonical records and the worklist."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.functions import text as T
from annalist.functions import values as V
from annalist.functions.paths import document_paths
from annalist.operators import history, intake
from annalist.sources import landing, markdown
from checks import feed
from checks.feed import TIME_2, sql_clean, sql_day, sql_hash, sql_ids, sql_words, with_feed
from checks.registry import Tables, once, query


def joined(column: str):
    return F.array_join(F.col(column).cast("array<string>"), "|").alias(column)


@query("clean_text", f"SELECT doc_id, {sql_clean('text')} AS cleaned FROM documents")
def clean_text(t: Tables) -> DataFrame:
    return t.texts.select("doc_id", T.clean_text(F.col("text")).alias("cleaned"))


@query(
    "clean_pages",
    f"SELECT page_id, length({sql_clean('html')}) AS cleaned_chars, sha256({sql_clean('html')}) AS cleaned_hash FROM pages",
)
def clean_pages(t: Tables) -> DataFrame:
    cleaned = T.clean_text(F.col("html"))
    return t.pages.select(
        "page_id", F.length(cleaned).cast("long").alias("cleaned_chars"), F.sha2(cleaned, 256).alias("cleaned_hash")
    )


@query(
    "text_metrics",
    f"SELECT doc_id, source, cast(length(text) AS INTEGER) AS text_length, {sql_words('text')} AS word_count FROM documents",
)
def text_metrics(t: Tables) -> DataFrame:
    text = F.col("text")
    return t.texts.select(
        "doc_id", "source", T.text_length(text).alias("text_length"), T.word_count(text).alias("word_count")
    )


@query(
    "content_hash",
    with_feed(f"SELECT source, dokid, {sql_hash('nazva', 'status', 'poddat')} AS content_hash FROM list1"),
)
def content_hash(t: Tables) -> DataFrame:
    return feed.listing(t, 1).select(
        "source", "dokid", V.content_hash(F.col("nazva"), F.col("status"), F.col("poddat")).alias("content_hash")
    )


@query(
    "parse_dates",
    with_feed(
        f"""SELECT source, dokid, {sql_day('orgdat')} AS doc_date, {sql_day('poddat')} AS revision_date,
        coalesce(length(cast(nullif(orgdat, 0) AS VARCHAR)) = 8
          AND try_strptime(cast(orgdat AS VARCHAR), '%Y%m%d') IS NULL, false) AS impossible
        FROM list1"""
    ),
)
def parse_dates(t: Tables) -> DataFrame:
    return feed.listing(t, 1).select(
        "source",
        "dokid",
        V.parse_day(F.col("orgdat")).alias("doc_date"),
        V.parse_day(F.col("poddat")).alias("revision_date"),
        V.is_impossible_day(F.col("orgdat")).alias("impossible"),
    )


@query(
    "parse_iso_dates",
    """SELECT event_id, cast(ts AS DATE) AS from_date, cast(ts AS DATE) AS from_time, cast(NULL AS DATE) AS from_other
    FROM events""",
)
def parse_iso_dates(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        V.parse_iso_day(F.date_format("ts", "yyyy-MM-dd")).alias("from_date"),
        V.parse_iso_day(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("from_time"),
        V.parse_iso_day(F.col("event_type")).alias("from_other"),
    )


@query(
    "parse_types",
    with_feed(
        f"""SELECT source, dokid, array_to_string({sql_ids('types')}, '|') AS type_ids,
        cast(len({sql_ids('types')}) AS INTEGER) AS type_count FROM list2"""
    ),
)
def parse_types(t: Tables) -> DataFrame:
    ids = feed.listing(t, 2).select("source", "dokid", V.parse_ids(F.col("types")).alias("type_ids"))
    return ids.select("source", "dokid", joined("type_ids"), F.size("type_ids").alias("type_count"))


CANONICAL = "source source_id source_reg title status_id org_id doc_date listed_date revision_date collection_date".split()


@query(
    "canonical_records",
    with_feed(
        f"""SELECT {', '.join(CANONICAL)}, array_to_string(type_ids, '|') AS type_ids,
        array_to_string(org_ids, '|') AS org_ids, reject_reason FROM canon1"""
    ),
)
def canonical_records(t: Tables) -> DataFrame:
    return feed.canonical(t, 1).select(*CANONICAL, joined("type_ids"), joined("org_ids"), "reject_reason")


@query(
    "rejected_records",
    with_feed("SELECT source, reject_reason, count(*) AS records FROM canon2 WHERE reject_reason IS NOT NULL GROUP BY 1, 2"),
)
def rejected_records(t: Tables) -> DataFrame:
    return (
        intake.rejected(feed.canonical(t, 2))
        .groupBy("source", "reject_reason")
        .agg(F.count(F.lit(1)).alias("records"))
    )


@query(
    "raw_metadata",
    with_feed(
        """SELECT source, cast(dokid AS VARCHAR) AS source_id, dokid, nreg, nazva, cast(status AS BIGINT) AS status,
        types, orgid, org, orgdat, poddat FROM list1"""
    ),
)
def raw_metadata(t: Tables) -> DataFrame:
    """The verbatim record survives as JSON with its nulls and non-ASCII text."""
    raw = F.from_json("raw_metadata", "dokid BIGINT, nreg STRING, nazva STRING, status BIGINT, types STRING, orgid STRING, org STRING, orgdat BIGINT, poddat BIGINT")
    return feed.canonical(t, 1).select("source", "source_id", raw.alias("r")).select("source", "source_id", "r.*")


_HEADER_SQL = """
'---' || chr(10) || concat_ws(chr(10),
  'source: "' || source || '"', 'dokid: ' || source_id, 'nreg: "' || source_reg || '"',
  'title: "' || replace(replace(title, '\\', '\\\\'), '"', '\\"') || '"',
  'doc_date: ' || cast(doc_date AS VARCHAR), 'revision_date: ' || cast(listed_revision AS VARCHAR),
  'status: ' || cast(status_id AS VARCHAR),
  CASE WHEN len(type_ids) > 0 THEN 'types: [' || array_to_string(type_ids, ', ') || ']' END,
  'org: ' || array_to_string(org_ids, '|'), '---') || chr(10)
"""


@query(
    "frontmatter",
    with_feed(
        f"""SELECT source, source_id, text IS NOT NULL AS rendered,
        CASE WHEN text IS NOT NULL THEN {_HEADER_SQL} || {sql_clean('text')} END AS markdown
        FROM canon1 WHERE reject_reason IS NULL"""
    ),
)
def frontmatter(t: Tables) -> DataFrame:
    rendered = intake.render(feed.documents(t, 1))
    return rendered.select("source", "source_id", (F.col("outcome") == "success").alias("rendered"), "markdown")


@query(
    "markdown_reader",
    with_feed(
        f"""SELECT source, source_id, source AS head_source, source_id AS head_id, source_reg AS head_reg, title AS head_title,
        doc_date AS head_doc_date, listed_revision AS head_revision_date, status_id AS head_status,
        array_to_string(type_ids, '|') AS head_types, array_to_string(org_ids, '|') AS head_org, {sql_clean('text')} AS body
        FROM canon1 WHERE reject_reason IS NULL AND text IS NOT NULL"""
    ),
)
def markdown_reader(t: Tables) -> DataFrame:
    rendered = intake.render(feed.documents(t, 1)).filter(F.col("markdown").isNotNull())
    parsed = markdown.parse_markdown(rendered.select("source", "source_id", "markdown")).drop("markdown")
    return parsed.withColumn("head_types", F.array_join(F.col("head_types").cast("array<string>"), "|"))


_PATHS = "raw_path_revision raw_path_collection meta_path_revision meta_path_collection processed_path_revision processed_path_collection".split()
_REVISION_SQL = (
    "'by_revision/source=' || source || '/year=' || year(revision_date) || '/month=' || "
    "strftime(revision_date, '%m') || '/day=' || strftime(revision_date, '%d') || '/' || source_id"
)
_COLLECTION_SQL = "'by_collection/date=' || cast(collection_date AS VARCHAR) || '/source=' || source || '/' || source_id"


@query(
    "path_derivation",
    with_feed(
        "SELECT source, source_id, "
        + ", ".join(
            f"{_REVISION_SQL if 'revision' in name else _COLLECTION_SQL} || '{suffix}' AS {name}"
            for name, suffix in zip(_PATHS, [".txt", ".txt", ".meta.json", ".meta.json", ".md", ".md"], strict=True)
        )
        + " FROM canon2 WHERE reject_reason IS NULL"
    ),
)
def path_derivation(t: Tables) -> DataFrame:
    paths = document_paths(F.col("source"), F.col("source_id"), F.col("revision_date"), F.col("collection_date"))
    return intake.accepted(feed.canonical(t, 2)).select(
        "source", "source_id", *[column.alias(name) for name, column in paths.items()]
    )


@query(
    "list_title_preferred",
    """SELECT source, cast(doc_id AS VARCHAR) AS source_id, split_part(text, chr(10), 1) AS title FROM documents""",
)
def list_title_preferred(t: Tables) -> DataFrame:
    base = t.texts.select("source", F.col("doc_id").cast("string").alias("source_id"), "text")
    cards = base.withColumn("title", T.decode_cp1251(F.encode(F.col("text"), "utf-8"))).drop("text")
    listing = base.withColumn("title", F.split_part("text", F.lit("\n"), F.lit(1)))
    return intake.prefer_list_title(cards, listing)


@query(
    "document_limit",
    with_feed("SELECT source, dokid, nreg FROM list1 ORDER BY seq, source LIMIT 100"),
)
def document_limit(t: Tables) -> DataFrame:
    listing = feed.listing(t, 1).withColumn("_place", F.struct("seq", "source"))
    return intake.first_documents(listing, "100", "_place").select("source", "dokid", "nreg")


# --- list pages -------------------------------------------------------------

# Pages hold 100 ids each; a listing announces its records that are not German,
# so it counts as full early. A record's page grows with its id.
_PAGES = """
SELECT d.source, cast(d.page AS INT) AS page, count(*) AS records, max(a.announced) AS announced, false AS broken
FROM (SELECT source, CAST(floor(doc_id / 100) AS BIGINT) + 1 AS page FROM {documents}) AS d
JOIN (SELECT source, count(*) AS announced FROM {documents} WHERE lang <> 'de' GROUP BY source) AS a ON a.source = d.source
GROUP BY d.source, d.page
"""


@query(
    "page_completeness",
    f"""
    WITH pages AS ({_PAGES.format(documents='documents')}),
    marked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY page) <> page AS bad,
        sum(records) OVER (PARTITION BY source ORDER BY page) >= announced AS is_full FROM pages)
    SELECT source, page FROM marked m WHERE NOT bad
      AND NOT EXISTS (SELECT 1 FROM marked e WHERE e.source = m.source AND e.page < m.page AND (e.bad OR e.is_full))
    """,
)
def page_completeness(t: Tables) -> DataFrame:
    pages = t.spark.sql(_PAGES, documents=t.documents)
    return landing.complete_pages(pages, max_pages=None)


# --- worklist ---------------------------------------------------------------

_CLASSIFIED = """
SELECT c.source, c.source_id, c.listed_date, h.revision_date AS stored_date,
  CASE WHEN h.source_id IS NULL THEN 'new' WHEN c.listed_date = h.revision_date THEN 'unchanged' ELSE 'changed' END AS change
FROM canon2 c LEFT JOIN hist1 h ON c.source = h.source AND c.source_id = h.source_id
WHERE c.reject_reason IS NULL
"""


@once
def classified(t: Tables, skip_existing: bool = True) -> DataFrame:
    listed = intake.accepted(feed.canonical(t, 2)).drop("text")
    return intake.classify(listed, history.current_state(feed.history_1(t)), skip_existing)


@query("worklist", with_feed(f"SELECT source, source_id, listed_date, change FROM ({_CLASSIFIED}) AS c"))
def worklist(t: Tables) -> DataFrame:
    return classified(t).select("source", "source_id", "listed_date", "change")


@query(
    "worklist_metrics",
    with_feed(
        f"""SELECT source, total, new, changed, unchanged, unchanged AS skipped, true AS filter_enabled,
          round(unchanged / total * 100, 2) AS saved_percent
        FROM (SELECT source, count(*) AS total, count_if(change = 'new')::BIGINT AS new,
          count_if(change = 'changed')::BIGINT AS changed, count_if(change = 'unchanged')::BIGINT AS unchanged
          FROM ({_CLASSIFIED}) AS c GROUP BY source) AS m"""
    ),
)
def worklist_metrics(t: Tables) -> DataFrame:
    return intake.saved_share(intake.worklist_metrics(classified(t), ["source"]))


@query(
    "worklist_unfiltered",
    with_feed(
        """SELECT source, count(*) AS total, 0::BIGINT AS new, 0::BIGINT AS changed, 0::BIGINT AS unchanged,
        0::BIGINT AS skipped, false AS filter_enabled FROM canon2 WHERE reject_reason IS NULL GROUP BY source"""
    ),
)
def worklist_unfiltered(t: Tables) -> DataFrame:
    return intake.worklist_metrics(classified(t, False), ["source"])


@query(
    "filter_report",
    with_feed(f"SELECT source, source_id, change FROM ({_CLASSIFIED}) AS c WHERE change <> 'unchanged'"),
)
def filter_report(t: Tables) -> DataFrame:
    from annalist.sinks.artefacts import filter_report as report

    return report(classified(t))


@query(
    "filter_summary",
    with_feed(
        f"""SELECT 'run-2' AS run_id, source, '{TIME_2}' AS timestamp, total, fetched, saved_percent, true AS filter_enabled, CAST(NULL AS VARCHAR) AS error
        FROM (SELECT source, count(*) AS total, count_if(change <> 'unchanged')::BIGINT AS fetched,
          round(count_if(change = 'unchanged') / count(*) * 100, 2) AS saved_percent FROM ({_CLASSIFIED}) AS c GROUP BY source) AS m"""
    ),
)
def filter_summary(t: Tables) -> DataFrame:
    from annalist.sinks.artefacts import filter_summary as summary

    metrics = intake.saved_share(intake.worklist_metrics(classified(t), ["source"]))
    fetched = (F.col("metrics.new") + F.col("metrics.changed")).alias("fetched")
    return summary(metrics, "run-2", TIME_2).select(
        "run_id", "source", "timestamp", "metrics.total", fetched, "metrics.saved_percent", "metrics.filter_enabled", "metrics.error"
    )


@query(
    "not_stored",
    with_feed(
        """SELECT source, source_id, source_reg FROM canon2 c WHERE reject_reason IS NULL
        AND NOT EXISTS (SELECT 1 FROM hist1 h WHERE h.source = c.source AND h.source_id = c.source_id)"""
    ),
)
def not_stored(t: Tables) -> DataFrame:
    listed = intake.accepted(feed.canonical(t, 2)).select("source", "source_id", "source_reg")
    return intake.not_stored(listed, history.current_state(feed.history_1(t)))


def fetched(t: Tables) -> DataFrame:
    """The whole of list 2 with its texts landed separately."""
    texts = feed.listing(t, 2).select("source", F.col("dokid").cast("string").alias("source_id"), "text")
    return intake.attach_texts(intake.accepted(feed.canonical(t, 2)).drop("text"), texts)


@query(
    "text_lookup",
    with_feed("SELECT source, source_id, text, CASE WHEN text IS NULL THEN 'No text' END AS error FROM canon2 WHERE reject_reason IS NULL"),
)
def text_lookup(t: Tables) -> DataFrame:
    return fetched(t).select("source", "source_id", "text", "error")


@query(
    "fetch_metrics",
    with_feed(
        """SELECT source, count(*) AS total, count(text) AS success, count(*) - count(text) AS failed
        FROM canon2 WHERE reject_reason IS NULL GROUP BY source"""
    ),
)
def fetch_metrics(t: Tables) -> DataFrame:
    return intake.fetch_metrics(fetched(t), ["source"])


@query(
    "failed_documents",
    with_feed(
        "SELECT source, source_id, source_reg, 'No text' AS error FROM canon2 WHERE reject_reason IS NULL AND text IS NULL"
    ),
)
def failed_documents(t: Tables) -> DataFrame:
    return intake.failures(fetched(t)).drop("seq")


@query(
    "first_failures",
    with_feed(
        """SELECT source, source_id, source_reg, 'No text' AS error FROM canon2 WHERE reject_reason IS NULL AND text IS NULL
        ORDER BY source, seq LIMIT 10"""
    ),
)
def first_failures(t: Tables) -> DataFrame:
    return intake.first_failures(intake.failures(fetched(t))).drop("seq")


@query(
    "render_metrics",
    with_feed(
        """SELECT source, count(*) AS total, count(text) AS success, count(*) - count(text) AS skipped, 0::BIGINT AS failed
        FROM canon1 WHERE reject_reason IS NULL GROUP BY source"""
    ),
)
def render_metrics(t: Tables) -> DataFrame:
    return intake.render_metrics(intake.render(feed.documents(t, 1)), ["source"])

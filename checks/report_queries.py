"""Checks, statistics, ledger, snapshots, retention."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist import schemas
from annalist.operators import doctypes, history, intake, ledger, quality, retention, snapshots, stats
from annalist.session import work_dir
from annalist.sinks import artefacts, layout
from checks import feed
from checks.feed import DAY_1, DAY_2, TIME_1, TIME_2, with_feed
from checks.history_queries import _TYPES_1, types_1
from checks.registry import Tables, once, query
from checks.text_queries import _CLASSIFIED, classified

_COUNTS = """SELECT source, count(*) AS total_documents, count_if(empty_title)::BIGINT AS empty_title,
  count_if(missing_text)::BIGINT AS missing_text, count_if(invalid_status)::BIGINT AS invalid_status,
  count_if(short_text)::BIGINT AS short_text FROM flagged GROUP BY source"""
_SCORE = "round(cast(total_documents - empty_title - invalid_status AS DOUBLE) / total_documents * 100, 2) AS quality_score"


@once
def live_1(t: Tables) -> DataFrame:
    return history.current_rows(feed.history_1(t))


@query(
    "quality_checks",
    with_feed("SELECT source, source_id, empty_title, missing_text, invalid_status, short_text FROM flagged"),
)
def quality_checks(t: Tables) -> DataFrame:
    return feed.flagged(t).select("source", "source_id", *quality.CHECKS)


@query("quality_score", with_feed(f"SELECT *, {_SCORE} FROM ({_COUNTS}) AS c"))
def quality_score(t: Tables) -> DataFrame:
    return quality.quality_score(quality.check_counts(feed.flagged(t), ["source"]))


@query(
    "check_pass_rates",
    with_feed(
        """SELECT source, check_name, total_documents - failed AS passed, failed,
          round(cast(total_documents - failed AS DOUBLE) / total_documents * 100, 2) AS pass_rate FROM (
          SELECT source, total_documents, 'empty_title' AS check_name, empty_title AS failed FROM counted
          UNION ALL SELECT source, total_documents, 'missing_text', missing_text FROM counted
          UNION ALL SELECT source, total_documents, 'invalid_status', invalid_status FROM counted
          UNION ALL SELECT source, total_documents, 'short_text', short_text FROM counted) AS u""",
        counted=_COUNTS,
    ),
)
def check_pass_rates(t: Tables) -> DataFrame:
    return quality.pass_rates(quality.check_counts(feed.flagged(t), ["source"]), ["source"])


@query("invalid_status_rows", with_feed("SELECT source, source_id, status_id FROM flagged WHERE invalid_status"))
def invalid_status_rows(t: Tables) -> DataFrame:
    statuses = quality.valid_statuses(feed.status_dictionary(t))
    return quality.invalid_status_rows(live_1(t), statuses).select("source", "source_id", "status_id")


@query(
    "quality_alerts",
    with_feed(
        """
        SELECT s.source, quality_score, saved_percent, 'low quality score' AS alert
        FROM scored s LEFT JOIN saved m ON s.source = m.source WHERE quality_score < 95
        UNION ALL
        SELECT s.source, quality_score, saved_percent, 'few fetches saved'
        FROM scored s LEFT JOIN saved m ON s.source = m.source WHERE saved_percent < 70
        """,
        scored=f"SELECT *, {_SCORE} FROM ({_COUNTS}) AS q",
        saved="SELECT source, round(count_if(change = 'unchanged') / count(*) * 100, 2) AS saved_percent "
        f"FROM ({_CLASSIFIED}) AS c GROUP BY source",
    ),
)
def quality_alerts(t: Tables) -> DataFrame:
    scores = quality.quality_score(quality.check_counts(feed.flagged(t), ["source"]))
    return quality.alerts(scores, intake.saved_share(intake.worklist_metrics(classified(t), ["source"])))


# --- statistics -------------------------------------------------------------

_STATISTICS = """count(*) AS total_documents, count_if(has_text)::BIGINT AS documents_with_text,
  coalesce(sum(text_length), 0)::BIGINT AS total_text_length, coalesce(sum(word_count), 0)::BIGINT AS total_word_count,
  count_if(NOT has_text)::BIGINT AS documents_without_text,
  round(coalesce(sum(text_length)::DOUBLE / nullif(count_if(has_text), 0), 0), 2) AS avg_text_length,
  round(coalesce(sum(word_count)::DOUBLE / nullif(count_if(has_text), 0), 0), 2) AS avg_word_count"""


@query("corpus_stats", with_feed(f"SELECT source, {_STATISTICS} FROM hist2 WHERE is_current GROUP BY source"))
def corpus_stats(t: Tables) -> DataFrame:
    return stats.corpus_statistics(history.current_rows(feed.history_2(t)), ["source"])


@query("corpus_stats_total", with_feed(f"SELECT {_STATISTICS} FROM hist1"))
def corpus_stats_total(t: Tables) -> DataFrame:
    return stats.corpus_statistics(live_1(t))


@query(
    "status_distribution",
    with_feed(
        """SELECT h.source, h.status_id, h.documents, h.percent, s.entry_name AS status_name FROM (
          SELECT source, status_id, count(*) AS documents,
            round(count(*) / sum(count(*)) OVER (PARTITION BY source) * 100, 2) AS percent FROM hist1 GROUP BY source, status_id) AS h
        LEFT JOIN status s ON s.source = h.source AND s.entry_id = h.status_id"""
    ),
)
def status_distribution(t: Tables) -> DataFrame:
    return stats.status_distribution(live_1(t), feed.status_dictionary(t))


_TYPE_ROWS = f"""SELECT h.source, h.source_id, t.type_id FROM ({_TYPES_1}) AS t
  JOIN (SELECT *, sha256(source || '|' || source_id || '|' || cast(valid_from AS VARCHAR)) AS version_id FROM hist1) AS h
  ON h.version_id = t.version_id"""


@query(
    "type_distribution",
    with_feed(
        f"""SELECT d.source, d.type_id, d.documents, n.n_name AS type_name FROM (
          SELECT source, type_id, count(*) AS documents FROM ({_TYPE_ROWS}) AS r GROUP BY source, type_id) AS d
        LEFT JOIN nation n ON n.n_nationkey = d.type_id"""
    ),
)
def type_distribution(t: Tables) -> DataFrame:
    counts = stats.type_distribution(doctypes.current_types(types_1(t), feed.history_1(t)))
    # Names for the nation numbers only: higher types stay unnamed.
    sources = t.spark.sql(
        "SELECT s.source, 'type' AS dict_type, n.n_nationkey AS entry_id, n.n_name AS entry_name, true AS is_current "
        "FROM (SELECT DISTINCT source, type_id FROM {counts}) AS s JOIN {nation} AS n ON n.n_nationkey = s.type_id",
        counts=counts,
        nation=t.nation,
    )
    return doctypes.name_types(counts, sources)


@query(
    "date_range",
    with_feed(
        """SELECT source, min(doc_date) AS oldest, max(doc_date) AS newest,
        cast(max(doc_date) - min(doc_date) AS INTEGER) AS span_days FROM hist1 GROUP BY source"""
    ),
)
def date_range(t: Tables) -> DataFrame:
    return stats.date_range(live_1(t), "doc_date", ["source"])


@query(
    "length_stats",
    with_feed(
        """SELECT source, count(*) AS documents, min(text_length)::BIGINT AS shortest, max(text_length)::BIGINT AS longest,
        round(avg(text_length), 2) AS mean, quantile_cont(text_length, 0.5)::DOUBLE AS median,
        round(stddev_samp(text_length), 2) AS stddev FROM hist1 WHERE has_text GROUP BY source"""
    ),
)
def length_stats(t: Tables) -> DataFrame:
    return stats.length_statistics(live_1(t), "text_length", ["source"])


@query(
    "length_buckets",
    with_feed(
        """SELECT source, bucket, count(*) AS documents, round(count(*) / sum(count(*)) OVER (PARTITION BY source) * 100, 2) AS percent
        FROM (SELECT source, CASE WHEN text_length < 1000 THEN '<1000' WHEN text_length <= 10000 THEN '1000-10000' ELSE '>10000' END AS bucket
          FROM hist1 WHERE has_text) AS b GROUP BY source, bucket"""
    ),
)
def length_buckets(t: Tables) -> DataFrame:
    return stats.length_buckets(live_1(t), by=["source"])


@query("count_by_source", with_feed("SELECT source, count(*) AS rows FROM hist2 WHERE is_current GROUP BY source"))
def count_by_source(t: Tables) -> DataFrame:
    return stats.count_by(history.current_rows(feed.history_2(t)), "source")


@query(
    "dictionary_counts",
    with_feed("SELECT source, dict_type, count(*) AS entries FROM dicthist WHERE is_current GROUP BY source, dict_type"),
)
def dictionary_counts(t: Tables) -> DataFrame:
    return snapshots.entries_per_type(feed.dictionary_2(t))


@query(
    "table_counts",
    with_feed(
        f"""SELECT 'documents (current)' AS metric, count(*) AS rows FROM hist2 WHERE is_current
        UNION ALL SELECT 'documents (total)', count(*) FROM hist2
        UNION ALL SELECT 'dictionaries', count(*) FROM dicthist WHERE is_current
        UNION ALL SELECT 'document types', count(*) FROM ({_TYPES_1}) AS t
        UNION ALL SELECT 'collection runs', count(*) FROM (SELECT DISTINCT user_id, cast(ts AS DATE) FROM events) AS r"""
    ),
)
def table_counts(t: Tables) -> DataFrame:
    documents, dictionaries = feed.history_2(t), feed.dictionary_2(t)
    return stats.table_counts(
        {
            "documents (current)": documents.filter("is_current"),
            "documents (total)": documents,
            "dictionaries": dictionaries.filter("is_current"),
            "document types": types_1(t),
            "collection runs": event_runs(t),
        }
    )


@query(
    "storage_footprint",
    with_feed(
        """SELECT area, count(*) AS files, sum(strlen(text))::BIGINT AS bytes
        FROM canon1, (SELECT unnest(['by_revision', 'by_collection']) AS area) WHERE reject_reason IS NULL AND text IS NOT NULL GROUP BY area"""
    ),
)
def storage_footprint(t: Tables) -> DataFrame:
    """Every document with a text in both layouts, by the sizes the sink keeps."""
    root = work_dir(t.spark, "footprint")
    rows = feed.documents(t, 1).select(*layout.RAW_COLUMNS)
    path = work_dir(t.spark, "fetched")
    rows.write.parquet(path)
    layout.save_raw(t.spark.read.parquet(path), root)
    return stats.storage_footprint(layout.inventory(t.spark, root))


# --- ledger -----------------------------------------------------------------


@once
def run_1(t: Tables) -> DataFrame:
    stored = feed.empty(t, schemas.DOCUMENTS)
    actions = history.merge_actions(stored, feed.batch(t, 1), history.DOCUMENT)
    listed = feed.canonical(t, 1)
    return ledger.run_rows(listed, actions, intake.rejected(listed), live_1(t), "first", TIME_1, "2024-02-01 00:10:00")


@once
def run_2(t: Tables) -> DataFrame:
    actions = history.merge_actions(feed.history_1(t), feed.batch(t, 2), history.DOCUMENT)
    listed = feed.canonical(t, 2)
    live = history.current_rows(feed.history_2(t))
    return ledger.run_rows(listed, actions, intake.rejected(listed), live, "second", TIME_2, "2025-03-01 00:10:00")


def _run_sql(number: int, run_id: str, started: str, completed: str, actions: str, live: str) -> str:
    return f"""
    SELECT '{run_id}_' || f.source AS run_id, f.source, TIMESTAMP '{started}' AS started_at, TIMESTAMP '{completed}' AS completed_at,
      documents_found, documents_new, documents_updated, documents_unchanged, documents_failed,
      documents_with_text, total_text_length, total_word_count, cast(NULL AS VARCHAR) AS error_message,
      CASE WHEN documents_failed = 0 THEN 'success' ELSE 'partial' END AS status
    FROM (SELECT source, count(*) AS documents_found, count_if(reject_reason IS NOT NULL)::BIGINT AS documents_failed FROM canon{number} GROUP BY source) AS f
    JOIN ({actions}) AS a ON a.source = f.source
    JOIN (SELECT source, count_if(has_text)::BIGINT AS documents_with_text, sum(text_length)::BIGINT AS total_text_length,
      sum(word_count)::BIGINT AS total_word_count FROM {live} GROUP BY source) AS d ON d.source = f.source
    """


_RUN_1 = _run_sql(
    1, "first", TIME_1, "2024-02-01 00:10:00",
    "SELECT source, count(*) AS documents_new, 0::BIGINT AS documents_updated, 0::BIGINT AS documents_unchanged FROM batch1 GROUP BY source",
    "hist1",
)
_RUN_2 = _run_sql(
    2, "second", TIME_2, "2025-03-01 00:10:00",
    """SELECT b.source, count_if(h.source IS NULL)::BIGINT AS documents_new,
      count(*) FILTER (h.content_hash <> b.content_hash) AS documents_updated, count(*) FILTER (h.content_hash = b.content_hash) AS documents_unchanged
    FROM batch2 b LEFT JOIN hist1 h ON h.source = b.source AND h.source_id = b.source_id GROUP BY b.source""",
    "hist2 WHERE is_current",
)


@query("run_ledger", with_feed(f"SELECT * FROM ({_RUN_1}) AS r1 UNION ALL SELECT * FROM ({_RUN_2}) AS r2"))
def run_ledger(t: Tables) -> DataFrame:
    """Two runs; the first is stored twice, as after a retry, and counts once."""
    first = run_1(t)
    stored = ledger.upsert(feed.empty(t, schemas.RUNS).select(*first.columns), first, ["run_id"])
    return ledger.upsert(ledger.upsert(stored, first, ["run_id"]), run_2(t), ["run_id"])


@query(
    "collection_report",
    with_feed(
        f"""SELECT r.run_id, r.source, r.documents_found, r.documents_failed, s.total_documents, s.avg_text_length
        FROM ({_RUN_1}) AS r JOIN (SELECT source, {_STATISTICS} FROM hist1 GROUP BY source) AS s ON s.source = r.source"""
    ),
)
def collection_report(t: Tables) -> DataFrame:
    """The nested report, read back from its JSON."""
    report = artefacts.collection_report(run_1(t), stats.corpus_statistics(live_1(t), ["source"]), TIME_1)
    parsed = F.from_json(
        "report",
        "collection STRUCT<documents_found: BIGINT, documents_failed: BIGINT>, "
        "statistics STRUCT<total_documents: BIGINT, avg_text_length: DOUBLE>",
    )
    return (
        artefacts.as_json(report)
        .select("run_id", "source", parsed.alias("r"))
        .select("run_id", "source", "r.collection.*", "r.statistics.*")
    )


# A ledger with many runs: one per user and day of the events, where errors
# are failed documents.
_EVENT_RUNS = """
SELECT 'u' || cast(user_id AS STRING) || '-' || cast(cast(ts AS DATE) AS STRING) AS run_id, 'u' || cast(user_id AS STRING) AS source,
  min(ts) AS started_at, max(ts) AS completed_at, count(*) AS documents_found,
  count(CASE WHEN event_type = 'signup' THEN 1 END) AS documents_new,
  count(CASE WHEN event_type = 'purchase' THEN 1 END) AS documents_updated,
  count(CASE WHEN event_type IN ('view', 'click') THEN 1 END) AS documents_unchanged,
  count(CASE WHEN event_type = 'error' THEN 1 END) AS documents_failed,
  CASE WHEN count(CASE WHEN event_type = 'error' THEN 1 END) = 0 THEN 'success' ELSE 'partial' END AS status
FROM {events} GROUP BY user_id, cast(ts AS DATE)
"""
_RUNS = _EVENT_RUNS.format(events="events")


def event_runs(t: Tables) -> DataFrame:
    return t.spark.sql(_EVENT_RUNS, events=t.events)


@query("latest_run", f"SELECT * FROM ({_RUNS}) AS r ORDER BY started_at DESC, run_id DESC LIMIT 1")
def latest_run(t: Tables) -> DataFrame:
    return ledger.latest_run(event_runs(t))


@query(
    "latest_run_per_source",
    f"SELECT * FROM ({_RUNS}) AS r QUALIFY row_number() OVER (PARTITION BY source ORDER BY started_at DESC, run_id DESC) = 1",
)
def latest_run_per_source(t: Tables) -> DataFrame:
    return ledger.latest_run_per_source(event_runs(t))


@query(
    "daily_summary",
    f"""SELECT cast(started_at AS DATE) AS day, count_if(status = 'success')::BIGINT AS runs_successful,
      count_if(status <> 'success')::BIGINT AS runs_not_successful, {', '.join(f'sum({c})::BIGINT AS {c}' for c in ledger.COUNTS)}
    FROM ({_RUNS}) AS r GROUP BY 1""",
)
def daily_summary(t: Tables) -> DataFrame:
    return ledger.daily_summary(event_runs(t))


@query(
    "success_rate",
    f"""SELECT source, day, runs, success_percent FROM (
      SELECT source, cast(started_at AS DATE) AS day, count(*) OVER w AS runs,
        round(count_if(status = 'success') OVER w / count(*) OVER w * 100, 2) AS success_percent FROM ({_RUNS}) AS r
      WINDOW w AS (PARTITION BY source ORDER BY cast(started_at AS DATE) RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)) AS s
    GROUP BY ALL""",
)
def success_rate(t: Tables) -> DataFrame:
    return ledger.success_rate(event_runs(t))


@query(
    "duplicate_runs_check",
    "SELECT user_id, cast(ts AS DATE) AS day, count(*) AS rows FROM events GROUP BY 1, 2 HAVING count(*) > 1",
)
def duplicate_runs_check(t: Tables) -> DataFrame:
    runs = t.events.select("user_id", F.to_date("ts").alias("day"))
    return history.repeated_keys(runs, ["user_id", "day"])


# --- snapshots and retention ------------------------------------------------


@query(
    "snapshot_dictionary",
    with_feed(
        f"""SELECT source, DATE '{DAY_2}' AS date, dict_type, entry_id, entry_name,
        strftime(valid_from, '%Y-%m-%dT%H:%M:%S') AS valid_from FROM dicthist WHERE is_current"""
    ),
)
def snapshot_dictionary(t: Tables) -> DataFrame:
    return snapshots.snapshot_rows(feed.dictionary_2(t), DAY_2)


@query(
    "snapshot_register",
    with_feed(
        f"""SELECT source, DATE '{DAY_1}' AS snapshot_date, 'snapshots/source=' || source || '/date={DAY_1}/' AS snapshot_path,
          string_agg(DISTINCT dict_type, '|' ORDER BY dict_type) AS dict_types, cast(count(*) AS INTEGER) AS entry_count FROM dict1 GROUP BY source
        UNION ALL
        SELECT source, DATE '{DAY_2}', 'snapshots/source=' || source || '/date={DAY_2}/',
          string_agg(DISTINCT dict_type, '|' ORDER BY dict_type), cast(count(*) AS INTEGER) FROM dicthist WHERE is_current GROUP BY source"""
    ),
)
def snapshot_register(t: Tables) -> DataFrame:
    first = snapshots.snapshot_rows(feed.dictionary_1(t), DAY_1)
    second = snapshots.snapshot_rows(feed.dictionary_2(t), DAY_2)
    stored = snapshots.register(snapshots.register(feed.empty(t, schemas.SNAPSHOTS), first), second)
    return stored.withColumn("dict_types", F.array_join("dict_types", "|"))


_OBJECTS = """
SELECT CASE event_type WHEN 'error' THEN 'date=' || cast(user_id AS STRING) || '-13-40'
         WHEN 'signup' THEN 'other' ELSE 'date=' || cast(cast(ts AS DATE) AS STRING) END
       || '/run_id=r' || cast(user_id AS STRING) || '/task_report/' || cast(event_id AS STRING) || '.json' AS path
FROM {events}
"""


@query(
    "expired_artefacts",
    f"""SELECT path, cast(substr(path, 6, 10) AS DATE) AS partition_date FROM ({_OBJECTS.format(events='events')}) AS o
    WHERE regexp_matches(path, '^date=2024') AND cast(substr(path, 6, 10) AS DATE) < DATE '2024-01-20' - 7""",
)
def expired_artefacts(t: Tables) -> DataFrame:
    return retention.expired(t.spark.sql(_OBJECTS, events=t.events), "2024-01-20")


@query(
    "cold_revisions",
    with_feed(
        """SELECT source, source_id, cast(year(revision_date) AS VARCHAR) AS year FROM hist1 WHERE year(revision_date) < 2026 - 2"""
    ),
)
def cold_revisions(t: Tables) -> DataFrame:
    processed = live_1(t).select("source", "source_id", F.year("revision_date").cast("string").alias("year"))
    return retention.cold(processed, 2026)

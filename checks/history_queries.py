"""Merges and point-in-time queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist import schemas
from annalist.operators import asof, chains, doctypes, history
from checks import feed
from checks.feed import TIME_1, TIME_2, with_feed
from checks.registry import Tables, once, query

DOCUMENT_COLUMNS = [c.split()[0] for c in schemas.DOCUMENTS.split(", ") if c.split()[0] not in {"collected_at", "transformed_at"}]
DICTIONARY_COLUMNS = [c.split()[0] for c in schemas.DICTIONARIES.split(", ")]
MOMENT = "2024-06-01 00:00:00"


@query("scd2_documents", with_feed(f"SELECT {', '.join(DOCUMENT_COLUMNS)} FROM hist2"))
def scd2_documents(t: Tables) -> DataFrame:
    return feed.history_2(t).select(*DOCUMENT_COLUMNS)


@query("scd2_dictionary", with_feed(f"SELECT {', '.join(DICTIONARY_COLUMNS)} FROM dicthist"))
def scd2_dictionary(t: Tables) -> DataFrame:
    return feed.dictionary_2(t).select(*DICTIONARY_COLUMNS)


@query(
    "scd2_actions",
    with_feed(
        """SELECT b.source, count_if(h.source IS NULL)::BIGINT AS inserted,
          count(*) FILTER (h.content_hash <> b.content_hash) AS updated, count(*) FILTER (h.content_hash = b.content_hash) AS unchanged
        FROM batch2 b LEFT JOIN hist1 h ON h.source = b.source AND h.source_id = b.source_id GROUP BY b.source"""
    ),
)
def scd2_actions(t: Tables) -> DataFrame:
    actions = history.merge_actions(feed.history_1(t), feed.batch(t, 2), history.DOCUMENT)
    return history.action_counts(actions, ["source"])


@query(
    "scd2_rerun",
    with_feed("SELECT source, 0::BIGINT AS inserted, 0::BIGINT AS updated, count(*) AS unchanged FROM batch1 GROUP BY source"),
)
def scd2_rerun(t: Tables) -> DataFrame:
    """The same list again changes nothing."""
    actions = history.merge_actions(feed.history_1(t), feed.batch(t, 1), history.DOCUMENT)
    return history.action_counts(actions, ["source"])


USER_STATE = history.HistorySpec(["user_id"], ["event_type"])


@query(
    "scd2_repeated_keys",
    f"""
    WITH ordered AS (SELECT user_id, event_id, event_type, value,
        coalesce(lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) <> event_type, true) AS changed FROM events),
    heads AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM ordered WHERE changed)
    SELECT user_id, event_type, value, sha256(event_type) AS content_hash,
      TIMESTAMP '{TIME_1}' + to_microseconds(n - 1) AS valid_from,
      CASE WHEN lead(n) OVER w IS NOT NULL THEN TIMESTAMP '{TIME_1}' + to_microseconds(n) END AS valid_to,
      lead(n) OVER w IS NULL AS is_current
    FROM heads WINDOW w AS (PARTITION BY user_id ORDER BY n)
    """,
)
def scd2_repeated_keys(t: Tables) -> DataFrame:
    """One batch that names each key many times and returns to earlier values."""
    batch = t.events.select("user_id", "event_type", "value", F.col("event_id").alias("seq"))
    stored = feed.empty(
        t,
        "user_id BIGINT, event_type STRING, value DOUBLE, content_hash STRING, valid_from TIMESTAMP_NTZ, "
        "valid_to TIMESTAMP_NTZ, is_current BOOLEAN, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ",
    )
    return history.merge(stored, batch, USER_STATE, TIME_1).drop("created_at", "updated_at")


@once
def types_1(t: Tables) -> DataFrame:
    return doctypes.merge_types(
        feed.empty(t, schemas.DOCUMENT_TYPES), doctypes.listed_types(feed.history_1(t)), TIME_1
    )


@once
def types_2(t: Tables) -> DataFrame:
    return doctypes.merge_types(types_1(t), doctypes.listed_types(feed.history_2(t)), TIME_2)


_TYPES_1 = f"""
SELECT DISTINCT sha256(source || '|' || source_id || '|' || cast(valid_from AS VARCHAR)) AS version_id, unnest(type_ids) AS type_id FROM hist1
"""
_LISTED_2 = "SELECT version_id, type_ids FROM hist2 WHERE len(type_ids) > 0"
_TYPES_2 = f"""
SELECT o.version_id, o.type_id, TIMESTAMP '{TIME_1}' AS valid_from,
  CASE WHEN n.version_id IS NOT NULL AND NOT list_contains(n.type_ids, o.type_id) THEN TIMESTAMP '{TIME_2}' END AS valid_to,
  TIMESTAMP '{TIME_1}' AS created_at
FROM ({_TYPES_1}) AS o LEFT JOIN ({_LISTED_2}) AS n ON o.version_id = n.version_id
UNION ALL
SELECT n.version_id, n.type_id, TIMESTAMP '{TIME_2}', NULL, TIMESTAMP '{TIME_2}'
FROM (SELECT DISTINCT version_id, unnest(type_ids) AS type_id FROM ({_LISTED_2}) AS l) AS n
LEFT JOIN ({_TYPES_1}) AS o ON o.version_id = n.version_id AND o.type_id = n.type_id WHERE o.version_id IS NULL
"""


@query(
    "scd2_document_types",
    with_feed(f"SELECT *, valid_to IS NULL AS is_current FROM ({_TYPES_2}) AS t"),
)
def scd2_document_types(t: Tables) -> DataFrame:
    return types_2(t)


@query(
    "type_delta",
    with_feed(
        f"""SELECT version_id, type_id, CASE WHEN valid_to IS NULL THEN 'open' ELSE 'close' END AS change
        FROM ({_TYPES_2}) AS t WHERE valid_from = TIMESTAMP '{TIME_2}' OR valid_to IS NOT NULL"""
    ),
)
def type_delta(t: Tables) -> DataFrame:
    return doctypes.type_delta(types_1(t), doctypes.listed_types(feed.history_2(t)))


@query(
    "current_types",
    with_feed(
        f"""SELECT t.version_id, t.type_id, h.source, h.source_id, t.valid_from FROM ({_TYPES_2}) AS t
        JOIN hist2 h ON h.version_id = t.version_id WHERE h.is_current AND t.valid_to IS NULL"""
    ),
)
def current_types(t: Tables) -> DataFrame:
    live = doctypes.current_types(types_2(t), feed.history_2(t))
    return live.select("version_id", "type_id", "source", "source_id", "valid_from")


@query(
    "as_of_state",
    with_feed(
        f"""SELECT source, source_id, title, status_id, revision_date, valid_from, valid_to FROM hist2
        WHERE valid_from <= TIMESTAMP '{MOMENT}' AND (valid_to IS NULL OR valid_to > TIMESTAMP '{MOMENT}')"""
    ),
)
def as_of_state(t: Tables) -> DataFrame:
    rows = history.as_of(feed.history_2(t), MOMENT)
    return rows.select("source", "source_id", "title", "status_id", "revision_date", "valid_from", "valid_to")


@query("current_state", with_feed("SELECT source, source_id, revision_date, content_hash FROM hist2 WHERE is_current"))
def current_state(t: Tables) -> DataFrame:
    return history.current_state(feed.history_2(t))


@query(
    "version_counts",
    with_feed("SELECT source, source_id, count(*) AS versions FROM hist2 GROUP BY source, source_id HAVING count(*) > 1"),
)
def version_counts(t: Tables) -> DataFrame:
    return history.version_counts(feed.history_2(t), ["source", "source_id"])


_HISTORY = "source, source_id, title, status_id, is_current, valid_from, valid_to"


@query("document_history", with_feed(f"SELECT {_HISTORY} FROM hist2"))
def document_history(t: Tables) -> DataFrame:
    return history.key_history(feed.history_2(t)).select(*_HISTORY.split(", "))


@query("source_history", with_feed(f"SELECT {_HISTORY} FROM hist2 WHERE source = 'src3'"))
def source_history(t: Tables) -> DataFrame:
    """The lookup by key, here on its first part."""
    return history.key_history(feed.history_2(t), source="src3").select(*_HISTORY.split(", "))


@query("document_lookup", with_feed(f"SELECT {_HISTORY} FROM hist2 WHERE source = 'src3' AND source_id = '3'"))
def document_lookup(t: Tables) -> DataFrame:
    """All versions of one document."""
    return history.key_history(feed.history_2(t), source="src3", source_id="3").select(*_HISTORY.split(", "))


@query(
    "recent_updates",
    with_feed(
        "SELECT source, source_id, title, valid_from, valid_to FROM hist2 "
        "WHERE valid_from > TIMESTAMP '2025-03-04 00:00:00' - INTERVAL 7 DAY"
    ),
)
def recent_updates(t: Tables) -> DataFrame:
    rows = history.recent_updates(feed.history_2(t), "2025-03-04 00:00:00")
    return rows.select("source", "source_id", "title", "valid_from", "valid_to")


@query(
    "current_unique_check",
    with_feed("SELECT source, source_id, count(*) AS rows FROM hist2 WHERE is_current GROUP BY 1, 2 HAVING count(*) > 1"),
)
def current_unique_check(t: Tables) -> DataFrame:
    return history.repeated_current_keys(feed.history_2(t), ["source", "source_id"])


@query(
    "repeated_keys_check",
    "SELECT source, text, count(*) AS rows FROM documents GROUP BY source, text HAVING count(*) > 1",
)
def repeated_keys_check(t: Tables) -> DataFrame:
    return history.repeated_keys(t.documents, ["source", "text"])


# Versions of a user's state begin at each event and, wrongly, last a day: some
# periods reach into the next.
@query(
    "overlap_check",
    """SELECT user_id, event_id, valid_from, valid_to FROM (
      SELECT user_id, event_id, ts AS valid_from, ts + INTERVAL 1 DAY AS valid_to,
        lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS follows FROM events) AS p
    WHERE follows IS NOT NULL AND valid_to > follows""",
)
def overlap_check(t: Tables) -> DataFrame:
    periods = t.events.select(
        "user_id", "event_id", F.col("ts").alias("valid_from"), (F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("valid_to")
    )
    return history.overlapping_periods(periods, ["user_id"])


@query(
    "overlap_check_documents",
    with_feed(
        """SELECT source, source_id, valid_from FROM (SELECT *, lead(valid_from) OVER (PARTITION BY source, source_id
        ORDER BY valid_from) AS follows FROM hist2) AS h WHERE follows IS NOT NULL AND (valid_to IS NULL OR valid_to > follows)"""
    ),
)
def overlap_check_documents(t: Tables) -> DataFrame:
    rows = history.overlapping_periods(feed.history_2(t), ["source", "source_id"])
    return rows.select("source", "source_id", "valid_from")


@query(
    "as_of_join",
    """
    WITH purchases AS (SELECT user_id, event_id AS purchase_id, value AS amount, ts AS valid_from,
      lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to FROM events WHERE event_type = 'purchase')
    SELECT e.event_id, e.user_id, e.ts, p.purchase_id, p.amount FROM events e LEFT JOIN purchases p
      ON p.user_id = e.user_id AND p.valid_from <= e.ts AND (p.valid_to IS NULL OR p.valid_to > e.ts)
    """,
)
def as_of_join(t: Tables) -> DataFrame:
    """Each event with the user's purchase in force at its time."""
    purchases = t.events.filter("event_type = 'purchase'").select(
        "user_id",
        F.col("event_id").alias("purchase_id"),
        F.col("value").alias("amount"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("at"),
        F.col("ts").alias("valid_from"),
    )
    hot = chains.find_hot_keys(purchases, ["user_id"])
    periods = chains.with_next(purchases, ["user_id"], "at", hot).withColumn(
        "valid_to", F.timestamp_micros("_next").cast("timestamp_ntz")
    )
    facts = t.events.select("event_id", "user_id", "ts")
    return asof.point_in_time(facts, periods, ["user_id"], "ts", ["purchase_id", "amount"])

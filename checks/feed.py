"""Two document lists and two dictionary deliveries, derived from the given tables.

List 1 holds all documents and pages. List 2 holds all documents, some with a
changed status, revision date or organisation, and the benchmark items: so
pages are missing in it and benchmark items are new. The same SQL feeds Spark
and DuckDB; what is computed from the lists is written twice.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist import schemas
from annalist.functions.text import strip_text
from annalist.operators import history, intake, quality
from checks.registry import Tables, once

TIME_1 = "2024-02-01 00:00:00"
TIME_2 = "2025-03-01 00:00:00"
DAY_1, DAY_2 = TIME_1[:10], TIME_2[:10]

_RECORD = """
  id AS dokid, source, id AS seq,
  cast(id AS STRING) || '-' || lang AS nreg,
  CASE WHEN id % 37 = 0 THEN '' WHEN id % 41 = 0 THEN '   ' ELSE title END AS nazva,
  cast(CASE WHEN id % 29 = 0 THEN 99 WHEN id % 31 = 0 THEN NULL ELSE (id + <<status>>) % 8 END AS INT) AS status,
  CASE WHEN id % 23 = 0 THEN NULL WHEN id % 3 = 0 THEN cast(id % 7 AS STRING)
       ELSE cast(id % 7 AS STRING) || '|' || cast(id % 11 + <<types>> AS STRING) END AS types,
  CASE WHEN id % 17 = 0 THEN '0' WHEN id % 19 = 0 THEN '471|164'
       ELSE cast(id % 50 + <<org>> AS STRING) END AS orgid,
  cast(id % 50 + 1 AS STRING) AS org,
  CASE WHEN id % 43 = 0 THEN 0 WHEN id % 97 = 5 THEN 20261341
       ELSE (2020 + id % 5) * 10000 + (id % 12 + 1) * 100 + id % 28 + 1 END AS orgdat,
  CASE WHEN id % 13 = 0 THEN 0 ELSE 20240000 + <<shift>> + (id % 12 + 1) * 100 + id % 28 + 1 END AS poddat,
  CASE WHEN id % 11 = 0 THEN NULL ELSE text END AS text
"""


def _record(status: str, types: str, org: str, shift: str) -> str:
    text = _RECORD
    for name, value in (("status", status), ("types", types), ("org", org), ("shift", shift)):
        text = text.replace(f"<<{name}>>", value)
    return text


_DOCUMENTS = "SELECT doc_id AS id, source, lang, split_part(text, chr(10), 1) AS title, text FROM {documents}"
LIST_1 = (
    f"SELECT {_record('0', '20', '1', '0')} FROM ({_DOCUMENTS} UNION ALL "
    "SELECT page_id, 'pages', 'html', url, html FROM {pages}) AS listed"
)
LIST_2 = "SELECT " + _record(
    "CASE WHEN id % 10 = 7 THEN 1 ELSE 0 END",
    "CASE WHEN id % 10 = 4 THEN 21 ELSE 20 END",
    "CASE WHEN id % 10 = 1 THEN 2 ELSE 1 END",
    "CASE WHEN id % 10 = 3 THEN 10000 ELSE 0 END",
) + (
    f" FROM ({_DOCUMENTS} UNION ALL "
    "SELECT item_id, 'benchmark', 'item', split_part(text, chr(10), 1), text FROM {benchmark}) AS listed"
)
DICT_1 = """
SELECT 'catalogue' AS source, 'part' AS dict_type, cast(p_partkey AS INT) AS entry_id, p_name AS entry_name, p_partkey AS seq FROM {part}
UNION ALL SELECT 'catalogue', 'supplier', cast(s_suppkey AS INT), s_name, s_suppkey FROM {supplier}
UNION ALL SELECT 'geography', 'nation', n_nationkey, n_name, n_nationkey FROM {nation}
UNION ALL SELECT 'geography', 'region', r_regionkey, r_name, r_regionkey FROM {region}
"""
DICT_2 = """
SELECT 'catalogue' AS source, 'part' AS dict_type, cast(p_partkey AS INT) AS entry_id,
       CASE WHEN p_size > 25 THEN p_name || ' (' || p_brand || ')' ELSE p_name END AS entry_name, p_partkey AS seq FROM {part}
UNION ALL SELECT 'catalogue', 'supplier', cast(s_suppkey AS INT), s_name, s_suppkey FROM {supplier}
UNION ALL SELECT 'geography', 'nation', n_nationkey, n_name, n_nationkey FROM {nation}
UNION ALL SELECT 'sales', 'customer', cast(c_custkey AS INT), c_name, c_custkey FROM {customer}
"""
# Status names come from the nations; 99 names none and stays unknown.
STATUS_DICT = """
SELECT DISTINCT l.source, 'status' AS dict_type, n.n_nationkey AS entry_id, n.n_name AS entry_name, true AS is_current
FROM ({listing}) AS l JOIN {nation} AS n ON l.status = n.n_nationkey
"""

_TABLES = ["documents", "pages", "benchmark", "part", "supplier", "nation", "region", "customer"]


# --- Spark side -------------------------------------------------------------


def _sql(t: Tables, text: str) -> DataFrame:
    used = [name for name in _TABLES if "{" + name + "}" in text]
    return t.spark.sql(text, **{name: t.texts if name == "documents" else getattr(t, name) for name in used})


@once
def listing(t: Tables, number: int) -> DataFrame:
    return _sql(t, LIST_1 if number == 1 else LIST_2)


@once
def dictionary_batch(t: Tables, number: int) -> DataFrame:
    return _sql(t, DICT_1 if number == 1 else DICT_2)


@once
def status_dictionary(t: Tables) -> DataFrame:
    return _sql(t, STATUS_DICT.replace("{listing}", LIST_1))


@once
def canonical(t: Tables, number: int) -> DataFrame:
    return intake.canonicalise(listing(t, number), DAY_1 if number == 1 else DAY_2)


@once
def documents(t: Tables, number: int) -> DataFrame:
    """Accepted documents with their stripped text."""
    text = F.nullif(strip_text(F.col("text")), F.lit(""))
    return intake.accepted(canonical(t, number)).withColumn("text", text)


@once
def batch(t: Tables, number: int) -> DataFrame:
    return intake.history_batch(intake.measure(documents(t, number)), TIME_1 if number == 1 else TIME_2)


@once
def empty(t: Tables, schema: str) -> DataFrame:
    return t.spark.createDataFrame([], schema)


@once
def history_1(t: Tables) -> DataFrame:
    return history.merge(empty(t, schemas.DOCUMENTS), batch(t, 1), history.DOCUMENT, TIME_1)


@once
def history_2(t: Tables) -> DataFrame:
    return history.merge(history_1(t), batch(t, 2), history.DOCUMENT, TIME_2)


@once
def dictionary_1(t: Tables) -> DataFrame:
    return history.merge(empty(t, schemas.DICTIONARIES), dictionary_batch(t, 1), history.DICTIONARY, TIME_1)


@once
def dictionary_2(t: Tables) -> DataFrame:
    return history.merge(dictionary_1(t), dictionary_batch(t, 2), history.DICTIONARY, TIME_2)


@once
def flagged(t: Tables) -> DataFrame:
    live = history.current_rows(history_1(t))
    return quality.flag_documents(live, quality.valid_statuses(status_dictionary(t)))


# --- DuckDB side ------------------------------------------------------------

BLANKS = (
    r"\t\x0b\x0c\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def _plain(text: str) -> str:
    for name in _TABLES:
        text = text.replace("{" + name + "}", name)
    return text


def sql_strip(x: str) -> str:
    return rf"regexp_replace({x}, '\A[\n{BLANKS}]+|[\n{BLANKS}]+\z', '', 'g')"


def sql_clean(x: str) -> str:
    tails = rf"regexp_replace({x}, '[{BLANKS}]+(\n|\z)', '\1', 'g')"
    return sql_strip(rf"regexp_replace({tails}, '\n{{3,}}', chr(10) || chr(10), 'g')") + " || chr(10)"


def sql_words(x: str) -> str:
    return rf"cast(coalesce(len(list_filter(string_split_regex({x}, '[\n{BLANKS}]+'), lambda w: w <> '')), 0) AS INTEGER)"


def sql_day(x: str) -> str:
    return (
        f"CASE WHEN length(cast(nullif({x}, 0) AS VARCHAR)) = 8 "
        f"THEN cast(try_strptime(cast({x} AS VARCHAR), '%Y%m%d') AS DATE) END"
    )


def sql_ids(x: str) -> str:
    return (
        f"coalesce(list_transform(list_filter(string_split({x}, '|'), lambda p: trim(p) <> ''), "
        "lambda p: try_cast(trim(p) AS INTEGER)), [])"
    )


def sql_hash(*columns: str) -> str:
    return "sha256(" + " || '|' || ".join(f"coalesce(cast({c} AS VARCHAR), '')" for c in columns) + ")"


def _sql_canonical(number: int) -> str:
    day = DAY_1 if number == 1 else DAY_2
    org = "coalesce(nullif(nullif(orgid, '0'), ''), org)"
    return f"""
    SELECT source, cast(dokid AS VARCHAR) AS source_id, nreg AS source_reg, coalesce(nazva, '') AS title,
      status AS status_id, {sql_ids('types')} AS type_ids, {sql_ids(org)}[1] AS org_id, {sql_ids(org)} AS org_ids,
      {sql_day('orgdat')} AS doc_date,
      {sql_day('coalesce(nullif(poddat, 0), orgdat)')} AS listed_date,
      {sql_day('poddat')} AS listed_revision,
      coalesce({sql_day('poddat')}, {sql_day('orgdat')}, DATE '{day}') AS revision_date,
      DATE '{day}' AS collection_date,
      CASE WHEN dokid IS NULL THEN 'missing id'
           WHEN (length(cast(nullif(poddat, 0) AS VARCHAR)) = 8 AND try_strptime(cast(poddat AS VARCHAR), '%Y%m%d') IS NULL)
             OR (length(cast(nullif(orgdat, 0) AS VARCHAR)) = 8 AND try_strptime(cast(orgdat AS VARCHAR), '%Y%m%d') IS NULL)
           THEN 'impossible date' END AS reject_reason,
      seq, nullif({sql_strip('text')}, '') AS text
    FROM list{number}
    """


def _sql_batch(number: int) -> str:
    revision = (
        "'by_revision/source=' || source || '/year=' || year(revision_date) || '/month=' || "
        "strftime(revision_date, '%m') || '/day=' || strftime(revision_date, '%d') || '/' || source_id"
    )
    collection = "'by_collection/date=' || cast(collection_date AS VARCHAR) || '/source=' || source || '/' || source_id"
    return f"""
    SELECT source, source_id, source_reg, title, status_id, org_id, doc_date, revision_date,
      {revision} || '.txt' AS raw_path_revision, {collection} || '.txt' AS raw_path_collection,
      {revision} || '.md' AS processed_path_revision, {collection} || '.md' AS processed_path_collection,
      type_ids, text IS NOT NULL AS has_text, cast(coalesce(length(text), 0) AS INTEGER) AS text_length,
      {sql_words('text')} AS word_count, seq, {sql_hash('title', 'status_id', 'revision_date')} AS content_hash
    FROM canon{number} WHERE reject_reason IS NULL
    """


_KEPT = "source_reg title status_id org_id doc_date revision_date has_text text_length word_count content_hash".split()
_PATHS = "raw_path_revision raw_path_collection processed_path_revision processed_path_collection type_ids".split()


def _sql_merge_documents() -> str:
    """Keys are unique per list, so a full join states the merge directly."""
    old = ", ".join(f"h.{c}" for c in _KEPT)
    new = ", ".join(f"b.{c}" for c in _KEPT)
    return f"""
    SELECT h.source, h.source_id, {old},
      {', '.join(f'CASE WHEN b.content_hash = h.content_hash THEN b.{c} ELSE h.{c} END AS {c}' for c in _PATHS[:4])},
      CASE WHEN b.content_hash = h.content_hash THEN b.type_ids END AS type_ids,
      h.valid_from, CASE WHEN b.content_hash <> h.content_hash THEN TIMESTAMP '{TIME_2}' END AS valid_to,
      h.created_at, CASE WHEN b.source IS NOT NULL THEN TIMESTAMP '{TIME_2}' ELSE h.updated_at END AS updated_at
    FROM hist1 h LEFT JOIN batch2 b ON h.source = b.source AND h.source_id = b.source_id
    UNION ALL
    SELECT b.source, b.source_id, {new}, {', '.join(f'b.{c}' for c in _PATHS)},
      TIMESTAMP '{TIME_2}', NULL, TIMESTAMP '{TIME_2}', TIMESTAMP '{TIME_2}'
    FROM batch2 b LEFT JOIN hist1 h ON h.source = b.source AND h.source_id = b.source_id
    WHERE h.source IS NULL OR h.content_hash <> b.content_hash
    """


def _sql_dictionary_2() -> str:
    return f"""
    SELECT o.source, o.dict_type, o.entry_id, o.entry_name, sha256(o.entry_name) AS content_hash,
      TIMESTAMP '{TIME_1}' AS valid_from,
      CASE WHEN n.entry_name <> o.entry_name THEN TIMESTAMP '{TIME_2}' END AS valid_to,
      TIMESTAMP '{TIME_1}' AS created_at,
      CASE WHEN n.entry_name <> o.entry_name THEN TIMESTAMP '{TIME_2}' ELSE TIMESTAMP '{TIME_1}' END AS updated_at
    FROM dict1 o LEFT JOIN dict2 n USING (source, dict_type, entry_id)
    UNION ALL
    SELECT n.source, n.dict_type, n.entry_id, n.entry_name, sha256(n.entry_name),
      TIMESTAMP '{TIME_2}', NULL, TIMESTAMP '{TIME_2}', TIMESTAMP '{TIME_2}'
    FROM dict2 n LEFT JOIN dict1 o USING (source, dict_type, entry_id)
    WHERE o.entry_name IS NULL OR o.entry_name <> n.entry_name
    """


def _ctes() -> dict[str, str]:
    return {
        "list1": _plain(LIST_1),
        "list2": _plain(LIST_2),
        "canon1": _sql_canonical(1),
        "canon2": _sql_canonical(2),
        "batch1": _sql_batch(1),
        "batch2": _sql_batch(2),
        "hist1": f"SELECT *, TIMESTAMP '{TIME_1}' AS valid_from, TIMESTAMP '{TIME_1}' AS created_at, "
        f"TIMESTAMP '{TIME_1}' AS updated_at FROM batch1",
        "hist2": "SELECT *, valid_to IS NULL AS is_current, "
        f"{sql_hash('source', 'source_id', 'valid_from')} AS version_id FROM ({_sql_merge_documents()}) AS m",
        "status": _plain(STATUS_DICT.replace("({listing})", "list1")),
        "dict1": _plain(DICT_1),
        "dict2": _plain(DICT_2),
        "dicthist": f"SELECT *, valid_to IS NULL AS is_current FROM ({_sql_dictionary_2()}) AS m",
        "flagged": rf"""
            SELECT h.*, NOT regexp_matches(title, '[^\n{BLANKS}]') AS empty_title, NOT has_text AS missing_text,
              status_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM status s WHERE s.source = h.source AND s.entry_id = h.status_id) AS invalid_status,
              text_length > 0 AND text_length < 50 AS short_text
            FROM hist1 h""",
    }


def with_feed(body: str, **named: str) -> str:
    """Put the named inputs the body mentions (and those they mention) in front of it."""
    ctes = {**_ctes(), **named}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, definition in ctes.items():
            if name not in needed and _mentions(text, name):
                visit(definition)
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    inputs = ",\n".join(f"{name} AS ({ctes[name]})" for name in needed)
    return f"WITH {inputs}\n{body}"


def _mentions(text: str, name: str) -> bool:
    return re.search(rf"\b(FROM|JOIN) {name}\b", text) is not None

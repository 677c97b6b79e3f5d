"""Queries that write areas or tables to the shared folder and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist import schemas
from annalist.functions.paths import document_paths
from annalist.operators import history, intake, snapshots
from annalist.session import work_dir
from annalist.sinks import artefacts, layout
from annalist.sinks.files import put_files
from annalist.sinks.tables import HistoryTable
from annalist.sources import landing
from checks import feed
from checks.feed import DAY_2, TIME_1, TIME_2, sql_clean, with_feed
from checks.history_queries import DOCUMENT_COLUMNS
from checks.registry import Tables, query


def stored(t: Tables, df: DataFrame, name: str) -> DataFrame:
    path = work_dir(t.spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return t.spark.read.parquet(path)


_PARTS = "cast(year(revision_date) AS VARCHAR) AS year, strftime(revision_date, '%m') AS month, strftime(revision_date, '%d') AS day"


@query(
    "raw_dual_write",
    with_feed(
        f"""SELECT 'by_revision' AS layout, source, source_id, {_PARTS}, cast(NULL AS VARCHAR) AS date, sha256(text) AS text_hash
          FROM canon1 WHERE reject_reason IS NULL AND text IS NOT NULL
        UNION ALL
        SELECT 'by_collection', source, source_id, NULL, NULL, NULL, cast(collection_date AS VARCHAR), sha256(text)
          FROM canon1 WHERE reject_reason IS NULL AND text IS NOT NULL"""
    ),
)
def raw_dual_write(t: Tables) -> DataFrame:
    root = work_dir(t.spark, "raw")
    rows = stored(t, feed.documents(t, 1).select(*layout.RAW_COLUMNS), "fetched")
    layout.save_raw(rows, root)
    revision = layout.read_area(layout.by_revision(rows), f"{root}/by_revision", layout.REVISION_PARTS)
    collection = layout.read_area(layout.by_collection(rows), f"{root}/by_collection", layout.COLLECTION_PARTS)
    text_hash = F.sha2("text", 256).alias("text_hash")
    return revision.select(
        F.lit("by_revision").alias("layout"), "source", "source_id", "year", "month", "day",
        F.lit(None).cast("string").alias("date"), text_hash,
    ).unionByName(
        collection.select(F.lit("by_collection").alias("layout"), "source", "source_id", "date", text_hash),
        allowMissingColumns=True,
    )


@query(
    "same_key_overwrite",
    with_feed(
        f"""SELECT source, source_id, {_PARTS}, collection_date, {sql_clean('text')} AS body FROM (
          SELECT * FROM canon1 UNION ALL SELECT * FROM canon2) AS both_lists
        WHERE reject_reason IS NULL AND text IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY source, source_id, revision_date ORDER BY collection_date DESC) = 1"""
    ),
)
def same_key_overwrite(t: Tables) -> DataFrame:
    """Two batches into the processed area: same revision replaces, another is added."""
    root = work_dir(t.spark, "processed")
    for number in (1, 2):
        rendered = intake.render(feed.documents(t, number))
        rows = stored(t, rendered.select(*layout.PROCESSED_COLUMNS, "outcome"), f"rendered{number}")
        layout.save_processed(rows, root)
    area = layout.read_area(
        layout.by_revision(rows.select(*layout.PROCESSED_COLUMNS)), f"{root}/by_revision", layout.REVISION_PARTS
    )
    body = F.regexp_extract("markdown", r"(?s)\A---\n.*?\n---\n(.*)\z", 1)
    return area.select("source", "source_id", "year", "month", "day", "collection_date", body.alias("body"))


@query(
    "revision_range",
    with_feed(
        f"""SELECT source, source_id, revision_date, {_PARTS} FROM canon1 WHERE reject_reason IS NULL AND text IS NOT NULL
        AND revision_date BETWEEN DATE '2024-01-15' AND DATE '2024-06-10'"""
    ),
)
def revision_range(t: Tables) -> DataFrame:
    root = work_dir(t.spark, "raw")
    rows = stored(t, feed.documents(t, 1).select(*layout.RAW_COLUMNS), "fetched")
    layout.save_raw(rows, root)
    area = layout.read_area(layout.by_revision(rows), f"{root}/by_revision", layout.REVISION_PARTS)
    found = layout.read_revisions(area, "2024-01-15", "2024-06-10")
    return found.select("source", "source_id", "revision_date", "year", "month", "day")


@query("history_table", with_feed(f"SELECT {', '.join(DOCUMENT_COLUMNS)} FROM hist2"))
def history_table(t: Tables) -> DataFrame:
    """Two merges through the stored table; the second reads the rows in force only."""
    table = HistoryTable(t.spark, work_dir(t.spark, "documents"), schemas.DOCUMENTS)
    for number, time in ((1, TIME_1), (2, TIME_2)):
        batch = feed.batch(t, number)
        table.commit(history.merge(table.current_for(batch), batch, history.DOCUMENT, time))
    return table.read().select(*DOCUMENT_COLUMNS)


@query(
    "snapshot_files",
    with_feed(
        f"""SELECT source, '{DAY_2}' AS date, dict_type, cast(entry_id AS BIGINT) AS entry_id, entry_name,
        strftime(valid_from, '%Y-%m-%dT%H:%M:%S') AS valid_from FROM dicthist WHERE is_current"""
    ),
)
def snapshot_files(t: Tables) -> DataFrame:
    root = work_dir(t.spark, "dictionaries")
    path = artefacts.write_snapshot(snapshots.snapshot_rows(feed.dictionary_2(t), DAY_2), root)
    schema = "entry_id BIGINT, entry_name STRING, valid_from STRING, source STRING, date STRING, dict_type STRING"
    return t.spark.read.schema(schema).json(path)


# Names written in Cyrillic letters, so that the encoding matters.
_LATIN, _CYRILLIC = "abcdefghijklmnopqrstuvwxyz", "абцдефгхийклмнопярстувшхыз"


@query(
    "dictionary_reader",
    f"""SELECT 'part' AS dict_type, cast(p_partkey AS INTEGER) AS entry_id, translate(p_name, '{_LATIN}', '{_CYRILLIC}') AS entry_name FROM part
    UNION ALL SELECT 'supplier', cast(s_suppkey AS INTEGER), translate(s_name, '{_LATIN}', '{_CYRILLIC}') FROM supplier""",
)
def dictionary_reader(t: Tables) -> DataFrame:
    """Tables written as windows-1251 dictionary files with noise lines, then read."""
    path = work_dir(t.spark, "dictionary-files")
    upper = bytes(range(0x80, 0x100))
    names = t.part.select(F.lit("part").alias("dict_type"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    names = names.unionByName(
        t.supplier.select(F.lit("supplier").alias("dict_type"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    )
    name = F.translate("name", _LATIN, _CYRILLIC)
    line = F.concat_ws("\n", F.concat(F.col("id").cast("string"), F.lit("\t"), name, F.lit(" \textra\r")), F.lit("x\tbad\n\n7"))
    # One byte per letter: the code page's letters are moved to the code points
    # of their bytes, and the latin-1 bytes are written as they are.
    coded = F.translate(line, upper.decode("cp1251", errors="replace"), upper.decode("latin-1"))
    (
        names.select("dict_type", F.encode(coded, "iso-8859-1").cast("string").alias("value"))
        .write.partitionBy("dict_type")
        .text(path)
    )
    entries = landing.dictionary_lines(landing.read_dictionary_lines(t.spark, path))
    return entries.select(
        F.regexp_extract("file", r"dict_type=([^/]+)/", 1).alias("dict_type"), "entry_id", "entry_name"
    )


@query(
    "object_exists",
    with_feed(
        """SELECT 'by_revision' AS kind, source_id AS id, text IS NOT NULL AS exists FROM canon1 WHERE reject_reason IS NULL
        UNION ALL SELECT 'by_collection', source_id, text IS NOT NULL FROM canon1 WHERE reject_reason IS NULL
        UNION ALL SELECT 'page', cast(page_id AS VARCHAR), false FROM pages"""
    ),
)
def object_exists(t: Tables) -> DataFrame:
    """Every listed document is asked for in both layouts of the raw area, which holds those with a text; and each page, which it never holds."""
    root = work_dir(t.spark, "raw")
    documents = feed.documents(t, 1)
    layout.save_raw(stored(t, documents.select(*layout.RAW_COLUMNS), "fetched"), root)
    paths = document_paths(F.col("source"), F.col("source_id"), F.col("revision_date"), F.col("collection_date"))
    asked = [documents.select(F.lit(f"by_{k}").alias("kind"), F.col("source_id").alias("id"), paths[f"raw_path_{k}"].alias("object")) for k in ("revision", "collection")]
    pages = t.pages.select(F.lit("page").alias("kind"), F.col("page_id").cast("string").alias("id"), F.concat(F.lit("pages/"), "page_id", F.lit(".txt")).alias("object"))
    everything = asked[0].unionByName(asked[1]).unionByName(pages)
    return landing.object_exists(everything, layout.inventory(t.spark, root), "object").select("kind", "id", "exists")


@query("export_csv", with_feed("SELECT source, dict_type, cast(entry_id AS VARCHAR) AS entry_id, entry_name FROM dicthist WHERE is_current"))
def export_csv(t: Tables) -> DataFrame:
    path = work_dir(t.spark, "export")
    rows = feed.dictionary_2(t).filter("is_current").select("source", "dict_type", "entry_id", "entry_name")
    artefacts.export_csv(rows, path)
    return t.spark.read.option("header", True).csv(path)


# --- landed list pages ------------------------------------------------------

# Pages of 100 ids each. Days come as numbers, as digits in a text and as ISO
# dates, statuses as numbers or text, one in 53 unreadable; every record has a
# field the schema does not know, and page 2 of one source is cut off.
_LANDED = """
SELECT source, cast(floor(doc_id / 100) + 1 AS INT) AS page, doc_id, source = 'src3' AND floor(doc_id / 100) = 1 AS cut,
  concat('{{"dokid": ', doc_id, ', "nreg": "', doc_id, '-', lang, '", "nazva": "T", "extra": {{"n":', n_chars, '}}, "status": ',
    CASE WHEN doc_id % 53 = 0 THEN '"odd"' WHEN doc_id % 2 = 0 THEN concat('"', doc_id % 8, '"') ELSE concat('', doc_id % 8) END,
    ', "poddat": ', CASE WHEN doc_id % 5 = 0 THEN '"2024-01-02"' WHEN doc_id % 5 = 1 THEN '"20240103"'
      WHEN doc_id % 5 = 2 THEN '"soon"' WHEN doc_id % 5 = 3 THEN 'null' ELSE '20240104' END, '}}') AS record
FROM {documents}
"""


@query(
    "list_reader",
    f"""
    WITH landed AS ({_LANDED.format(documents='documents')})
    SELECT source, doc_id AS dokid, doc_id || '-' || lang AS nreg, record, n_chars AS extra,
      CASE WHEN doc_id % 53 <> 0 THEN cast(doc_id % 8 AS INTEGER) END AS status,
      CASE WHEN doc_id % 5 = 0 THEN 20240102 WHEN doc_id % 5 = 1 THEN 20240103 WHEN doc_id % 5 = 4 THEN 20240104 END::BIGINT AS poddat,
      CASE WHEN doc_id % 53 = 0 THEN 'bad number in status' END AS record_error,
      row_number() OVER (PARTITION BY source ORDER BY page, doc_id) - 1 AS seq
    FROM landed JOIN documents USING (doc_id, source)
    WHERE source <> 'src3' OR page < 2
    """,
)
def list_reader(t: Tables) -> DataFrame:
    """Pages written to the landing zone and read back, record by record."""
    records = t.spark.sql(_LANDED, documents=t.documents)
    # A page is little data and much work, a file: without a number AQE would leave it all to a task or two.
    tasks = max(4 * t.spark.sparkContext.defaultParallelism, t.documents.rdd.getNumPartitions())
    records = records.repartition(tasks, "source", "page")
    lists = records.groupBy("source", "page").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("doc_id", "record"))), lambda r: r["record"]), ",").alias("list"),
        F.bool_or("cut").alias("cut"),
    )
    whole = F.concat(F.lit('{"max": 1000000000, "list": ['), "list", F.when(F.col("cut"), '], "').otherwise("]}"))
    # Null and empty sources share a folder; a page without a number has none in its name.
    name = F.concat(F.lit("page"), F.coalesce(F.col("page").cast("string"), F.lit("")), F.when(F.col("source") == "", ".empty").otherwise(""), F.lit(".json"))
    path = work_dir(t.spark, "pages")
    put_files(lists.select("source", name.alias("name"), whole.alias("value")), "source", path)
    pages = landing.read_pages(t.spark, path).withColumn("source", F.regexp_extract("file", "source=([^/]+)/", 1))
    read = landing.listed_records(pages)
    extra = F.get_json_object("record", "$.extra.n").cast("long")
    return read.select("source", "dokid", "nreg", "record", extra.alias("extra"), "status", "poddat", "record_error", "seq")

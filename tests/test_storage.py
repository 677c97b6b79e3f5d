import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from annalist import schemas
from annalist.operators import history, intake, retention
from annalist.plans.daily import Store, clean_temp, run_day
from annalist.sinks import artefacts, files, layout
from annalist.sinks.tables import HistoryTable
from annalist.sources import get_source, landing
from annalist.sources.markdown import parse_markdown
from annalist.streaming.ingest import ingest_documents


def put_file(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())


def page(records, announced):
    return json.dumps({"cnt": len(records), "from": 1, "max": announced, "list": records}, ensure_ascii=False)


def record(number, **fields):
    return {"dokid": number, "nreg": f"{number}-x", "nazva": f"Title {number}", "status": 5, "types": 95, "orgid": 7, "poddat": 20260130, **fields}


@pytest.mark.parametrize(
    ("sizes", "announced", "expected"),
    [
        ([2, 2, 1], [5, 5, 5], [1, 2, 3]),
        ([2, 0, 1], [5, 5, 5], [1]),
        ([2, 2, 1], [4, 4, 4], [1, 2]),
        ([2, None, 1], [9, 9, 9], [1]),
        ([2, "broken", 1], [9, 9, 9], [1]),
        ([0], [0], []),
    ],
)
def test_pages(spark, tmp_path, sizes, announced, expected):
    number = 0
    for i, (size, total) in enumerate(zip(sizes, announced, strict=True), 1):
        if size == "broken":
            put_file(tmp_path / f"page{i}.json", '{"cnt": 2, "list": [{"dokid"')
        elif size is not None:
            put_file(tmp_path / f"page{i}.json", page([record(number + j) for j in range(size)], total))
            number += size
    pages = landing.read_pages(spark, str(tmp_path)).withColumn("source", F.lit("s"))
    sizes = pages.select("source", "page", F.size("list").alias("records"), "announced", "broken")
    assert sorted(r["page"] for r in landing.complete_pages(sizes).collect()) == expected
    records = landing.listed_records(pages)
    assert records.select("page").distinct().count() == len(expected) if "page" in records.columns else True
    seqs = sorted(r["seq"] for r in records.collect())
    assert seqs == list(range(len(seqs)))
    assert not expected or sorted(set(r["types"] for r in records.collect())) == ["95"]


def test_odd_records_stay_in_their_page(spark, tmp_path):
    """A mistyped value costs its field, an unreadable one its record, never the page."""
    rows = [record(1, poddat="2024-01-02", more={"a": [1]}), record(2, status="x"), record(3, types="6|168", num="q"), "no object", record("n4"), record(5, status="3", poddat="20240105")]
    put_file(tmp_path / "page1.json", page(rows, "6"))
    pages = landing.read_pages(spark, str(tmp_path)).withColumn("source", F.lit("s"))
    got = landing.listed_records(pages).orderBy("seq").collect()
    assert [r["record_error"] for r in got] == [None, "bad number in status", None, "unreadable record", "bad number in dokid", None]
    assert [r["seq"] for r in got] == list(range(6))
    assert (got[0]["poddat"], got[5]["poddat"], got[5]["status"], got[2]["types"]) == (20240102, 20240105, 3, "6|168")
    assert json.loads(got[0]["record"]) == rows[0]
    canonical = intake.canonicalise(landing.listed_records(pages), "2026-02-02").orderBy("seq").collect()
    assert json.loads(canonical[0]["raw_metadata"]) == rows[0] and canonical[0]["revision_date"] == dt.date(2024, 1, 2)
    assert [r["reject_reason"] for r in canonical if r["reject_reason"]] == ["bad number in status", "unreadable record", "bad number in dokid"]


def test_pages_left_out(spark):
    rows = [("s", 1, 2, 9, False), ("s", 2, 2, 9, False), ("s", 3, None, None, True), ("s", 4, 2, 9, False)]
    pages = spark.createDataFrame(rows, "source STRING, page INT, records INT, announced INT, broken BOOLEAN")
    assert {r["page"]: r["reason"] for r in landing.pages_left_out(pages).collect()} == {3: "unreadable", 4: "after the end"}
    assert {r["page"]: r["reason"] for r in landing.pages_left_out(pages, 1).collect()} == {2: "over the page limit", 3: "over the page limit", 4: "over the page limit"}


def test_max_pages(spark):
    pages = spark.createDataFrame([("s", p, 1, 99, False) for p in range(1, 6)], "source STRING, page INT, records INT, announced INT, broken BOOLEAN")
    assert landing.complete_pages(pages, max_pages=3).count() == 3


def test_dictionaries(spark, tmp_path):
    lines = "0\tНевизначено\textra\r\n 7 \tX \r\nx\tbad\r\n\r\n6\r\n1\tЧинний ї"
    put_file(tmp_path / "dictionaries/stan.txt", lines.encode("cp1251"))
    put_file(tmp_path / "manifests/status.json", json.dumps({"id": "1", "item": [{"link": "http://x/data/stan.txt"}]}))
    put_file(tmp_path / "manifests/theme.json", json.dumps({"id": "2", "item": []}))
    put_file(tmp_path / "manifests/org.json", json.dumps({"id": "3", "item": [{"link": "http://x/data/org.txt"}]}))
    reader = get_source("landing_zone", "s", path=str(tmp_path))
    got = reader.dictionaries(spark).orderBy("seq").collect()
    assert [(r["source"], r["dict_type"], r["entry_id"], r["entry_name"]) for r in got] == [
        ("s", "status", 0, "Невизначено"), ("s", "status", 7, "X"), ("s", "status", 1, "Чинний ї"),
    ]
    missing = landing.missing_dictionaries(
        landing.read_manifests(spark, f"{tmp_path}/manifests"), landing.read_dictionary_lines(spark, f"{tmp_path}/dictionaries")
    )
    assert sorted(r["dict_type"] for r in missing.collect()) == ["org", "theme"]


def test_a_dictionary_file_is_read_by_many_tasks(spark, tmp_path):
    names = {i: f"Назва №{i} ї" * (1 + i % 7) for i in range(400)}
    lines = "\r\n".join(["", " ", *(line for i, name in names.items() for line in (f"{i}\t{name}\tmore", "", "x\tno", str(i)))])
    put_file(tmp_path / "dictionaries/big.txt", lines.encode("cp1251") + b"\n400\t\x98")
    put_file(tmp_path / "dictionaries/small.txt", "2\tБ\n1\tА".encode("cp1251"))
    put_file(tmp_path / "dictionaries/broken.txt.gz", b"1\tno archive\n")
    put_file(tmp_path / "dictionaries/empty.txt", b"")
    for name, file in {"big": "big.txt", "small": "small.txt", "broken": "broken.txt.gz", "empty": "empty.txt"}.items():
        put_file(tmp_path / f"manifests/{name}.json", json.dumps({"id": name, "item": [{"link": f"http://x/{file}"}]}))
    before = {key: spark.conf.get(key) for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000b")
        spark.conf.set("spark.sql.files.openCostInBytes", "10b")
        read = landing.read_dictionary_lines(spark, f"{tmp_path}/dictionaries")
        assert read.filter("file LIKE '%big.txt'").select(F.spark_partition_id()).distinct().count() > 1
        tasks = spark.read.option("lineSep", "\n").text(f"{tmp_path}/dictionaries/big.txt").rdd.getNumPartitions()
        rows = get_source("landing_zone", "s", path=str(tmp_path)).dictionaries(spark).collect()
        missing = landing.missing_dictionaries(landing.read_manifests(spark, f"{tmp_path}/manifests"), read).collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert tasks > 5
    found = {d: [(r["entry_id"], r["entry_name"]) for r in sorted(rows, key=lambda r: r["seq"]) if r["dict_type"] == d] for d in ("big", "small")}
    assert found["big"] == [*names.items(), (400, "\ufffd")]
    assert found["small"] == [(2, "Б"), (1, "А")]
    assert len({(r["dict_type"], r["seq"]) for r in rows}) == len(rows) == 403
    assert sorted(r["dict_type"] for r in missing) == ["broken", "empty"]


def test_object_listing(spark, tmp_path):
    put_file(tmp_path / "area/date=2026-01-01/a.txt", "a\n\nc")
    put_file(tmp_path / "area/b.v2.txt", "é")
    objects = landing.list_objects(spark, f"{tmp_path}/area")
    assert sorted(map(tuple, objects.collect())) == [("b.v2.txt", 2), ("date=2026-01-01/a.txt", 4)]
    asked = spark.createDataFrame([("b.v2.txt",), ("c.txt",)], "path STRING")
    assert {r["path"]: r["exists"] for r in landing.object_exists(asked, objects, "path").collect()} == {"b.v2.txt": True, "c.txt": False}
    texts = landing.read_texts(spark, f"{tmp_path}/area")
    assert sorted(map(tuple, texts.collect())) == [("a", "a\n\nc"), ("b.v2", "é")]


def raw_rows(spark, *rows):
    return spark.createDataFrame(
        [("s", i, dt.date.fromisoformat(r), dt.date.fromisoformat(c), t, "{}", n) for n, (i, r, c, t) in enumerate(rows)],
        "source STRING, source_id STRING, revision_date DATE, collection_date DATE, text STRING, raw_metadata STRING, seq LONG",
    )


def test_layout_overwrites_by_key(spark, tmp_path):
    root = str(tmp_path)
    first = raw_rows(spark, ("1", "2026-01-05", "2026-02-01", "old"), ("2", "2026-01-05", "2026-02-01", "two"), ("3", "2025-01-01", "2026-02-01", "three"), ("2", "2026-01-05", "2026-02-01", "two again"))
    second = raw_rows(spark, ("1", "2026-01-05", "2026-02-02", "new"), ("3", "2026-01-09", "2026-02-02", "moved"), ("4", "2026-01-05", "2026-02-02", None))
    layout.save_raw(first, root)
    layout.save_raw(second, root)
    area = layout.read_area(layout.by_revision(first), f"{root}/by_revision", layout.REVISION_PARTS)
    got = sorted((r["source_id"], r["year"], r["month"], r["day"], r["text"]) for r in area.collect())
    assert got == [
        ("1", "2026", "01", "05", "new"), ("2", "2026", "01", "05", "two again"), ("3", "2025", "01", "01", "three"), ("3", "2026", "01", "09", "moved"),
    ]
    daily = layout.read_area(layout.by_collection(first), f"{root}/by_collection", layout.COLLECTION_PARTS)
    assert sorted((r["date"], r["source_id"]) for r in daily.collect()) == [
        ("2026-02-01", "1"), ("2026-02-01", "2"), ("2026-02-01", "3"), ("2026-02-02", "1"), ("2026-02-02", "3"),
    ]
    assert files.exists(spark, f"{root}/by_revision/source=s/year=2026/month=01/day=05")
    found = layout.read_revisions(area, "2026-01-06", "2026-12-31")
    assert [r["text"] for r in found.collect()] == ["moved"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_history_table_commits(spark, tmp_path):
    table = HistoryTable(spark, f"{tmp_path}/t", schemas.DICTIONARIES)
    assert table.read().isEmpty() and table.current().isEmpty()

    def batch(name):
        return spark.createDataFrame([("s", "status", 1, name, 0), ("s", "status", 2, "same", 1)], "source STRING, dict_type STRING, entry_id INT, entry_name STRING, seq LONG")

    for number, name in enumerate(["a", "b", "c"], 1):
        table.commit(history.merge(table.current(), batch(name), history.DICTIONARY, f"2026-01-0{number} 00:00:00"))
    assert table.read().count() == 4 and table.current().count() == 2
    assert sorted(r["entry_name"] for r in table.read(upto=2).filter("is_current").collect()) == ["b", "same"]
    plan = table.current()._jdf.queryExecution().executedPlan().toString()
    assert "is_current" in plan.split("PartitionFilters")[1].split("]")[0]

    # A folder without its marker is a job that died: it is not read, and not reused.
    table.current().withColumn("entry_name", F.lit("lost")).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy("is_current").parquet(f"{tmp_path}/t/commit=4")
    assert table.commits() == [1, 2, 3]
    assert table.read().filter("entry_name = 'lost'").isEmpty()
    assert table.commit(history.merge(table.current(), batch("d"), history.DICTIONARY, "2026-01-05 00:00:00")) == 5
    assert sorted(r["entry_name"] for r in table.current().collect()) == ["d", "same"]


def test_a_commit_writes_the_parts_it_touches(spark, tmp_path):
    """1 % of the keys, sharing parts: under 5 % of the rows are written, and replaced parts can go."""
    table = HistoryTable(spark, f"{tmp_path}/t", schemas.DICTIONARIES, parts=64)
    entries = spark.range(5000).select(F.lit("s").alias("source"), F.lit("org").alias("dict_type"), F.col("id").cast("int").alias("entry_id"), F.lit("a").alias("entry_name"), F.col("id").alias("seq"))
    table.commit(history.merge(table.current(), entries, history.DICTIONARY, "2026-01-01 00:00:00"))
    few = entries.filter(table.part_of() == 7).filter("entry_id % 2 = 0").withColumn("entry_name", F.lit("b")).cache()
    assert 25 <= few.count() <= 60
    # Opened with another number of parts, the table keeps its own.
    table = HistoryTable(spark, f"{tmp_path}/t", schemas.DICTIONARIES)
    before = table.current_for(few)
    assert before.count() < 150
    table.commit(history.merge(before, few, history.DICTIONARY, "2026-01-02 00:00:00"))
    written = spark.read.parquet(f"{tmp_path}/t/commit=2/is_current=true").count()
    assert written == before.count() < 250
    assert table.current().count() == 5000 and table.current().filter("entry_name = 'b'").count() == few.count()
    assert table.read().count() == 5000 + few.count()
    assert table.read(upto=1).filter("is_current AND entry_name = 'a'").count() == 5000
    listed = table.remove_replaced()
    assert [p.rsplit("/", 3)[1:] for p in listed] == [["commit=1", "is_current=true", "part=7"]] and table.read(upto=1).count() == 5000
    table.remove_replaced(dry_run=False)
    assert table.remove_replaced() == [] and table.current().count() == 5000 and table.read().count() == 5000 + few.count()


def test_a_job_stopped_before_the_marker_changes_nothing(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/raw"
    first = raw_rows(spark, ("1", "2026-01-05", "2026-02-01", "old"), ("2", "2026-01-05", "2026-02-01", "two"))
    second = raw_rows(spark, ("1", "2026-01-05", "2026-02-02", "new"))
    layout.put(layout.by_revision(first), root, layout.REVISION_PARTS, ["source", "source_id", "year", "month", "day"])

    def texts():
        area = layout.read_area(layout.by_revision(first), root, layout.REVISION_PARTS)
        return sorted((r["source_id"], r["text"]) for r in area.collect())

    class Stopped(Exception):
        pass

    def stop(self, *args):
        raise Stopped

    put = lambda: layout.put(layout.by_revision(second), root, layout.REVISION_PARTS, ["source", "source_id", "year", "month", "day"])
    with monkeypatch.context() as patch, pytest.raises(Stopped):
        # The rows are written; the manifest is not.
        patch.setattr(type(spark.range(1)), "coalesce", stop)
        put()
    assert len(list((tmp_path / "raw").rglob("commit=2/part-*"))) == 1
    assert texts() == [("1", "old"), ("2", "two")]
    put()
    assert texts() == [("1", "new"), ("2", "two")]


def land(path, records, texts):
    put_file(path / "dictionaries/stan.txt", "5\tЧинний\r\n".encode("cp1251"))
    put_file(path / "manifests/status.json", json.dumps({"item": [{"link": "stan.txt"}]}))
    half = (len(records) + 1) // 2
    put_file(path / "list/page1.json", page(records[:half], len(records)))
    put_file(path / "list/page2.json", page(records[half:], len(records)))
    for number, text in texts.items():
        put_file(path / f"texts/{number}.txt", text)


def test_two_days(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/store")
    land(
        tmp_path / "day1",
        [record(1), record(2), record(3, status=9), record(4), record(5, poddat=20261341)],
        {1: " one  \n\n\n\nmore ", 2: "two", 3: "three"},
    )
    first = run_day(get_source("landing_zone", "s", path=f"{tmp_path}/day1"), store, "run1", "2026-02-01 00:00:00", "2026-02-01 00:10:00", min_text_length=4)
    assert first.worklist.first().asDict() == {"source": "s", "total": 4, "new": 4, "changed": 0, "unchanged": 0, "skipped": 0, "filter_enabled": True, "saved_percent": 0.0, "error": None}
    assert tuple(first.fetch.first()) == ("s", 4, 3, 1)
    assert tuple(first.transform.first()) == ("s", 4, 3, 1, 0)
    assert [r["source_id"] for r in first.first_failures.collect()] == ["4"]
    scored = first.quality.first()
    assert (scored["missing_text"], scored["invalid_status"], scored["short_text"], scored["quality_score"]) == (1, 1, 1, 75.0)

    land(
        tmp_path / "day2",
        [record(1, poddat=20260201, types="95|6"), record(2, status=5, nazva="New title"), record(4), record(6)],
        {1: "one, again", 2: "never read", 4: "late text", 6: "six"},
    )
    second = run_day(get_source("landing_zone", "s", path=f"{tmp_path}/day2"), store, "run2", "2026-02-02 00:00:00", "2026-02-02 00:10:00")
    assert second.worklist.first()["saved_percent"] == 50.0
    assert tuple(second.actions.first()) == ("s", 1, 2, 1)

    live = {r["source_id"]: r for r in store.table("documents", "s").current().collect()}
    assert sorted(live) == ["1", "2", "3", "4", "6"]
    assert (live["2"]["title"], live["2"]["text_length"]) == ("New title", 3)
    assert live["1"]["raw_path_revision"] == "by_revision/source=s/year=2026/month=02/day=01/1.txt"
    assert live["1"]["text_length"] == len("one, again")
    # An unchanged document keeps its measures; only its paths follow the run.
    assert (live["4"]["has_text"], live["4"]["raw_path_collection"]) == (False, "by_collection/date=2026-02-02/source=s/4.txt")
    everything = store.read("documents")
    assert everything.count() == 7
    assert history.overlapping_periods(everything, ["source", "source_id"]).isEmpty()
    types = store.read("document_types").join(store.table("documents", "s").current().select("version_id", "source_id"), "version_id")
    assert sorted((r["source_id"], r["type_id"]) for r in types.collect() if r["is_current"]) == [("1", 6), ("1", 95), ("2", 95), ("3", 95), ("4", 95), ("6", 95)]

    runs = {r["run_id"]: r for r in store.runs().collect()}
    assert (runs["run1_s"]["documents_found"], runs["run1_s"]["documents_failed"], runs["run1_s"]["status"]) == (5, 1, "partial")
    assert (runs["run2_s"]["documents_new"], runs["run2_s"]["documents_updated"], runs["run2_s"]["documents_unchanged"], runs["run2_s"]["status"]) == (1, 2, 1, "success")
    assert store.snapshot_register().count() == 2

    like = spark.createDataFrame([], "source STRING, source_id STRING, revision_date DATE, collection_date DATE, markdown STRING, seq LONG, year STRING, month STRING, day STRING")
    processed = layout.read_area(like, f"{store.processed}/by_revision", layout.REVISION_PARTS).filter("source_id = '1'")
    parsed = {r["body"]: r for r in parse_markdown(processed).collect()}
    assert sorted(parsed) == ["one\n\nmore\n", "one, again\n"]
    assert parsed["one, again\n"]["head_types"] == [95, 6]

    # Retention: the first day's artefacts only, and only when asked to.
    assert clean_temp(store, "2026-02-09") > 0
    assert files.exists(spark, f"{store.temp}/date=2026-02-01")
    clean_temp(store, "2026-02-09", dry_run=False)
    assert files.child_names(spark, store.temp) == ["date=2026-02-02"]


def test_rerun_of_a_day(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/store")
    land(tmp_path / "day", [record(1), record(2)], {1: "one", 2: "two"})
    reader = get_source("landing_zone", "s", path=f"{tmp_path}/day")
    for _ in range(2):
        result = run_day(reader, store, "run", "2026-02-01 00:00:00", "2026-02-01 00:10:00")
    assert tuple(result.actions.first()) == ("s", 0, 0, 2)
    assert store.read("documents").count() == 2 and store.runs().count() == 1
    # The ledger tells what the run brought when it first finished.
    row = store.runs().first()
    assert (row["status"], row["documents_found"], row["documents_new"], row["documents_unchanged"]) == ("success", 2, 2, 0)


def test_ledger_of_odd_runs(spark, tmp_path):
    """An empty list has a row, and a run that broke off is seen as running."""
    store = Store(spark, f"{tmp_path}/store")
    land(tmp_path / "day", [], {99: "of no record"})
    run_day(get_source("landing_zone", "s", path=f"{tmp_path}/day"), store, "empty", "2026-02-01 00:00:00", "2026-02-01 00:10:00")
    row = store.runs().first()
    assert (row["run_id"], row["status"], row["documents_found"]) == ("empty_s", "success", 0)
    with pytest.raises(Exception):  # noqa: B017  whatever Spark makes of a missing folder
        run_day(get_source("landing_zone", "s", path=f"{tmp_path}/nowhere"), store, "lost", "2026-02-02 00:00:00", "2026-02-02 00:10:00")
    assert {r["run_id"]: r["status"] for r in store.runs().collect()} == {"empty_s": "success", "lost_s": "running"}


def test_a_commit_number_is_claimed_once(spark, tmp_path):
    assert files.claim(spark, f"{tmp_path}/t/_claims/1")
    assert not files.claim(spark, f"{tmp_path}/t/_claims/1")
    table = HistoryTable(spark, f"{tmp_path}/t", "source STRING, is_current BOOLEAN")
    rows = spark.createDataFrame([("s", True)], "source STRING, is_current BOOLEAN")
    # A number claimed by a job that died is passed over.
    assert table.commit(rows) == 2 and table.commits() == [2] and table.current().count() == 1


def test_a_day_costs_its_change(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/store")
    land(tmp_path / "day1", [record(1), record(2), record(3)], {1: "one", 2: "two", 3: "three"})
    land(tmp_path / "day3", [record(1, poddat=20260201), record(2, nazva="New title"), record(3)], {1: "one, again"})
    results = []
    for day, landed in ((1, 1), (2, 1), (3, 3)):
        reader = get_source("landing_zone", "s", path=f"{tmp_path}/day{landed}")
        results.append(run_day(reader, store, f"run{day}", f"2026-02-0{day} 00:00:00", f"2026-02-0{day} 00:10:00"))
    # Nothing changed on the second day: no text is rendered or written, and all documents are still counted.
    assert [tuple(r.actions.first()) for r in results] == [("s", 3, 0, 0), ("s", 0, 0, 3), ("s", 0, 2, 1)]
    assert [tuple(r.transform.first()) for r in results] == [("s", 3, 3, 0, 0)] * 3

    def texts(number, area):
        """The rows a commit wrote into an area."""
        found = [str(p) for p in (tmp_path / "store" / area).rglob(f"commit={number}/part-*") if "_manifest" not in p.parts]
        return spark.read.schema("source_id STRING, text STRING, markdown STRING").parquet(*found).collect() if found else []

    assert texts(2, "raw/by_revision") == texts(2, "processed/by_revision") == texts(2, "processed/by_collection") == []
    # A title that moved is seen, and its text rendered from the raw area.
    assert sorted((r["source_id"], "New title" in r["markdown"]) for r in texts(3, "processed/by_collection")) == [("1", False), ("2", True)]
    live = {r["source_id"]: (r["title"], r["text_length"], r["word_count"]) for r in store.read("documents").filter("is_current").collect()}
    assert live == {"1": ("Title 1", 10, 2), "2": ("New title", 3, 1), "3": ("Title 3", 5, 1)}


def filter_reports(spark, store, day, run):
    return spark.read.json(f"{store.temp}/date={day}/run_id={run}/task_filter_report").collect()


def test_a_history_that_fails_once_takes_the_whole_list(spark, tmp_path, monkeypatch):
    store = Store(spark, f"{tmp_path}/store")
    land(tmp_path / "day", [record(1), record(2)], {1: "one", 2: "two"})
    reader = get_source("landing_zone", "s", path=f"{tmp_path}/day")
    run_day(reader, store, "run1", "2026-02-01 00:00:00", "2026-02-01 00:10:00")
    read, failed = HistoryTable.current, []

    def once(table, only=None):
        if table.path.endswith("documents/source=s") and not failed:
            failed.append(table.path)
            return spark.read.schema(table.schema).parquet(f"{tmp_path}/nowhere")
        return read(table, only)

    monkeypatch.setattr(HistoryTable, "current", once)
    result = run_day(reader, store, "run2", "2026-02-02 00:00:00", "2026-02-02 00:10:00")
    metrics = result.worklist.first()
    assert failed and (metrics["total"], metrics["unchanged"], metrics["filter_enabled"]) == (2, 0, False)
    assert "nowhere" in metrics["error"] and "nowhere" in result.report.first()["filtering"]["error"]
    noted = filter_reports(spark, store, "2026-02-02", "run2")
    assert [(r["run_id"], r["source"], r["metrics"]["error"]) for r in noted] == [("run2", "s", metrics["error"])]
    assert tuple(result.fetch.first()) == ("s", 2, 2, 0)
    # Both were fetched again and found equal: the history goes on as if nothing had happened.
    assert tuple(result.actions.first()) == ("s", 0, 0, 2)
    assert store.read("documents").count() == 2


def test_a_damaged_commit_takes_the_whole_list(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/store")
    land(tmp_path / "day1", [record(1), record(2)], {1: "one", 2: "two"})
    land(tmp_path / "day2", [record(1), record(2), record(3)], {1: "one", 2: "two", 3: "three"})
    run_day(get_source("landing_zone", "s", path=f"{tmp_path}/day1"), store, "run1", "2026-02-01 00:00:00", "2026-02-01 00:10:00")
    table = store.table("documents", "s")
    for path in (tmp_path / "store/tables/documents/source=s/commit=1/is_current=true").rglob("*.parquet"):
        path.write_bytes(b"no table")
        path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    # The merge needs what is lost, so the run fails there; what it fetched and why it took all is kept.
    with pytest.raises(Exception, match="(?i)parquet"):
        run_day(get_source("landing_zone", "s", path=f"{tmp_path}/day2"), store, "run2", "2026-02-02 00:00:00", "2026-02-02 00:10:00")
    assert table.commits() == [1]
    noted = filter_reports(spark, store, "2026-02-02", "run2")[0]["metrics"]
    assert (noted["total"], noted["filter_enabled"]) == (3, False) and noted["error"]
    kept = spark.read.json(f"{store.temp}/date=2026-02-02/run_id=run2/task_filter_documents").collect()
    assert sorted(r["source_id"] for r in kept) == ["1", "2", "3"]
    assert sorted(r["source_id"] for r in spark.read.parquet(f"{store.root}/staging/run_id=run2/rendered").collect()) == ["1", "2", "3"]


def test_stream_ingest(spark, tmp_path):
    schema = f"source STRING, seq LONG, {schemas.LIST_RECORD}, text STRING, landed_at TIMESTAMP_NTZ"
    table = HistoryTable(spark, f"{tmp_path}/table", schemas.DOCUMENTS)

    def land_rows(*rows):
        names = schemas.LIST_RECORD_FIELDS
        data = [("s", i, *[r.get(n) for n in names], "text", dt.datetime.fromisoformat(at)) for i, (r, at) in enumerate(rows)]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/landing")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/landing")
        ingest_documents(stream, table, f"{tmp_path}/checkpoint").awaitTermination()

    fields = {"orgid": "7", "types": "95"}
    # Two lists in one batch: the later landing time rules, whatever its place.
    land_rows((record(1, **fields, status=2), "2026-01-02"), (record(1, **fields, status=1), "2026-01-01"))
    assert [(r["status_id"], r["is_current"]) for r in table.read().orderBy("valid_from").collect()] == [(1, False), (2, True)]
    # A revision date that goes backwards is a change as well.
    land_rows((record(1, **fields, status=2, poddat=20250101), "2026-01-03"))
    assert table.read().count() == 3 and table.current().first()["revision_date"] == dt.date(2025, 1, 1)
    # Nothing new has landed: nothing is merged.
    commits = table.commits()
    ingest_documents(spark.readStream.schema(schema).parquet(f"{tmp_path}/landing"), table, f"{tmp_path}/checkpoint").awaitTermination()
    assert table.commits() == commits
    with pytest.raises(ValueError, match="already stored"):
        table.commit(table.current(), commits[-1])


def test_artefacts(spark, tmp_path):
    df = spark.createDataFrame([("a", None, [1])], "x STRING, y STRING, z ARRAY<INT>")
    path = artefacts.write_artefact(df, str(tmp_path), "2026-02-01", "r1", "report")
    assert path.endswith("/date=2026-02-01/run_id=r1/task_report")
    assert spark.read.text(path).first()[0] == '{"x":"a","y":null,"z":[1]}'
    artefacts.export_csv(df, f"{tmp_path}/csv")
    assert tuple(spark.read.option("header", True).csv(f"{tmp_path}/csv").first()) == ("a", None, "[1]")
    assert retention.RETENTION_DAYS == 7


def test_the_inventory_names_every_object(spark, tmp_path):
    rows = raw_rows(spark, ("1", "2026-01-05", "2026-02-01", "é"), ("2", "2025-01-05", "2026-02-01", ""), ("3", "2026-01-05", "2026-02-01", None))
    assert layout.inventory(spark, str(tmp_path)).isEmpty()
    layout.save_raw(rows, str(tmp_path))
    layout.save_raw(raw_rows(spark, ("1", "2026-01-05", "2026-02-01", "longer")), str(tmp_path))
    assert sorted(map(tuple, layout.inventory(spark, str(tmp_path)).collect())) == [
        ("by_collection/date=2026-02-01/source=s/1.txt", 6),
        ("by_collection/date=2026-02-01/source=s/2.txt", 0),
        ("by_revision/source=s/year=2025/month=01/day=05/2.txt", 0),
        ("by_revision/source=s/year=2026/month=01/day=05/1.txt", 6),
    ]


def test_put_moves_no_text_to_tell_keys_apart(spark, tmp_path, monkeypatch):
    """Where no key repeats in a batch, its rows are only dealt to partitions; copies of a key still leave the newest."""
    asked = []
    newest = layout.newest_per_key
    monkeypatch.setattr(layout, "newest_per_key", lambda *a: asked.append(a) or newest(*a))
    schema = "source string, source_id string, text string, seq long, day string"
    keys = ["source", "source_id", "day"]

    def put(*rows):
        layout.put(spark.createDataFrame(list(rows), schema), str(tmp_path), ["source", "day"], keys)

    def held():
        area = layout.read_area(spark.createDataFrame([], schema), str(tmp_path), ["source", "day"])
        return sorted((r["source_id"] or "", r["text"], r["day"]) for r in area.collect())

    put(("a", "1", "old", 1, "01"), ("a", "2", "stays", 2, "01"), ("a", "1", "apart", 3, "02"), ("a", None, "none", 4, "01"))
    put(("a", "1", "new", 1, "01"), ("a", None, "more", 2, "01"))
    assert not asked
    assert held() == [("", "more", "01"), ("", "none", "01"), ("1", "apart", "02"), ("1", "new", "01"), ("2", "stays", "01")]
    monkeypatch.setattr(layout, "BROADCAST_STAY", 0)
    put(("a", "1", "first", 1, "01"), ("a", "1", "last", 2, "01"))
    assert len(asked) == 1
    assert held() == [("", "more", "01"), ("", "none", "01"), ("1", "apart", "02"), ("1", "last", "01"), ("2", "stays", "01")]

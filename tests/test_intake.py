import datetime as dt

import pytest
from pyspark.sql import functions as F

from annalist import schemas
from annalist.operators import intake, ledger, quality, retention, snapshots, stats
from annalist.sources import get_source, register_source, union_listings
from annalist.sources.registry import SourceReader

DAY = "2026-02-02"


def listing(spark, *records):
    """Records as dicts; absent fields are null."""
    names = schemas.LIST_RECORD_FIELDS
    rows = [(r.get("source", "s"), i, *[r.get(n) for n in names]) for i, r in enumerate(records)]
    return spark.createDataFrame(rows, f"source STRING, seq LONG, {schemas.LIST_RECORD}")


def test_canonical(spark):
    got = intake.canonicalise(
        listing(
            spark,
            {"dokid": 1, "nreg": "a", "nazva": "T", "status": 5, "types": "6|168", "orgid": "471|164", "org": "1", "orgdat": 20200101, "poddat": 20260130},
            {"dokid": 2, "orgid": "0", "org": "9", "orgdat": 20200101, "poddat": 0},
            {"dokid": 3, "orgdat": 0},
            {"dokid": 4, "poddat": 20261341},
            {"dokid": 5, "types": "6|x"},
            {"nazva": "no id"},
            {"dokid": 7, "poddat": 123, "orgdat": 20200101},
        ),
        DAY,
    ).orderBy("seq").collect()
    day = dt.date
    assert [r["reject_reason"] for r in got] == [None, None, None, "impossible date", "bad type id", "missing id", None]
    first = got[0]
    assert (first["source_id"], first["type_ids"], first["org_id"], first["org_ids"]) == ("1", [6, 168], 471, [471, 164])
    assert (first["doc_date"], first["revision_date"], first["listed_date"]) == (day(2020, 1, 1), day(2026, 1, 30), day(2026, 1, 30))
    assert '"nazva":"T"' in first["raw_metadata"] and '"minjust":null' in first["raw_metadata"]
    assert (got[1]["org_id"], got[1]["revision_date"], got[1]["listed_date"]) == (9, day(2020, 1, 1), day(2020, 1, 1))
    assert (got[2]["title"], got[2]["revision_date"], got[2]["listed_date"]) == ("", day(2026, 2, 2), None)
    assert (got[6]["revision_date"], got[6]["listed_date"]) == (day(2020, 1, 1), None)


def test_worklist(spark):
    documents = intake.accepted(
        intake.canonicalise(
            listing(
                spark,
                {"dokid": 1, "poddat": 20260101},
                {"dokid": 2, "poddat": 20260101},
                {"dokid": 3, "poddat": 20250101},
                {"dokid": 4},
                {"dokid": 5, "poddat": 20260101},
                {"dokid": 6, "orgdat": 20260101},
            ),
            DAY,
        )
    )
    day = dt.date(2026, 1, 1)
    current = spark.createDataFrame(
        [("s", "2", day, "h"), ("s", "3", day, "h"), ("s", "4", day, "h"), ("s", "5", None, "h"), ("s", "6", day, "h"), ("t", "1", day, "h")],
        "source STRING, source_id STRING, revision_date DATE, content_hash STRING",
    )
    got = intake.classify(documents, current)
    assert {r["source_id"]: r["change"] for r in got.collect()} == {
        "1": "new", "2": "unchanged", "3": "changed", "4": "changed", "5": "changed", "6": "unchanged",
    }
    metrics = intake.saved_share(intake.worklist_metrics(got)).first().asDict()
    assert metrics == {
        "total": 6, "new": 1, "changed": 3, "unchanged": 2, "skipped": 2, "filter_enabled": True, "saved_percent": 33.33,
    }
    assert intake.worklist(got).count() == 4
    off = intake.classify(documents, current, skip_existing=False)
    assert intake.worklist(off).count() == 6 and not intake.worklist_metrics(off).first()["filter_enabled"]
    assert intake.worklist(intake.classify(documents, None)).count() == 6
    assert [r["source_id"] for r in intake.not_stored(documents, current).collect()] == ["1"]


def test_limit(spark):
    records = listing(spark, *[{"dokid": i} for i in range(5)])
    assert [r["dokid"] for r in intake.first_documents(records, "2").collect()] == [0, 1]
    assert intake.first_documents(records, 0).count() == 5


def test_texts_and_render(spark):
    documents = intake.accepted(intake.canonicalise(listing(spark, *[{"dokid": i, "nazva": f'"{i}"'} for i in range(4)]), DAY))
    texts = spark.createDataFrame([("s", "0", " a b\n\n\n\nc "), ("s", "1", "  "), ("t", "2", "x")], "source STRING, source_id STRING, text STRING")
    fetched = intake.attach_texts(documents, texts)
    assert tuple(intake.fetch_metrics(fetched).first()) == (4, 1, 3)
    failed = intake.failures(fetched)
    assert [(r["source_id"], r["error"]) for r in intake.first_failures(failed, 2).collect()] == [("1", "No text"), ("2", "No text")]
    rendered = intake.render(fetched).orderBy("seq").collect()
    assert rendered[0]["markdown"].endswith('title: "\\"0\\""\ntypes: []\n---\na b\n\nc\n'.replace("types: []\n", ""))
    assert (rendered[0]["text_length"], rendered[0]["word_count"], rendered[0]["has_text"]) == (8, 3, True)
    assert (rendered[1]["outcome"], rendered[1]["text_length"], rendered[1]["has_text"]) == ("skipped", 0, False)


def test_list_title_wins(spark):
    cards = spark.createDataFrame([("s", "1", "bad"), ("s", "2", "card")], "source STRING, source_id STRING, title STRING")
    listed = spark.createDataFrame([("s", "1", "good")], "source STRING, source_id STRING, title STRING")
    assert {r["source_id"]: r["title"] for r in intake.prefer_list_title(cards, listed).collect()} == {"1": "good", "2": "card"}


@pytest.fixture(scope="module")
def checked(spark):
    documents = spark.createDataFrame(
        [
            ("s", "1", "T", 5, True, 100, 10),
            ("s", "2", "  ", 99, True, 49, 5),
            ("s", "3", "U", None, False, 0, 0),
            ("s", "4", "V", 1, True, 50, 6),
        ],
        "source STRING, source_id STRING, title STRING, status_id INT, has_text BOOLEAN, text_length INT, word_count INT",
    )
    dictionary = spark.createDataFrame(
        [("s", "status", 5, "Active", True), ("s", "status", 1, "Lost force", True), ("s", "status", 99, "Old", False), ("t", "status", 99, "X", True)],
        "source STRING, dict_type STRING, entry_id INT, entry_name STRING, is_current BOOLEAN",
    )
    return documents, dictionary, quality.flag_documents(documents, quality.valid_statuses(dictionary))


def test_quality(checked):
    documents, dictionary, flagged = checked
    scored = quality.quality_score(quality.check_counts(flagged)).first().asDict()
    # The untitled document with the unknown status is taken off twice.
    assert scored == {
        "total_documents": 4, "empty_title": 1, "missing_text": 1, "invalid_status": 1, "short_text": 1, "quality_score": 50.0,
    }
    bad = quality.invalid_status_rows(documents, quality.valid_statuses(dictionary))
    assert [r["source_id"] for r in bad.collect()] == ["2"]
    rates = quality.pass_rates(quality.check_counts(flagged)).collect()
    assert {r["check_name"]: (r["passed"], r["pass_rate"]) for r in rates} == {c: (3, 75.0) for c in quality.CHECKS}
    empty = quality.quality_score(quality.check_counts(flagged.filter("false"))).first()
    assert (empty["total_documents"], empty["quality_score"]) == (0, 0.0)


def test_alerts(spark):
    scores = spark.createDataFrame([("a", 94.9), ("b", 95.0), ("c", 99.0)], "source STRING, quality_score DOUBLE")
    saved = spark.createDataFrame([("a", 69.0), ("b", 70.0)], "source STRING, saved_percent DOUBLE")
    got = quality.alerts(scores, saved).select("source", "alert").collect()
    assert sorted(map(tuple, got)) == [("a", "few fetches saved"), ("a", "low quality score")]


def test_statistics(checked):
    documents, dictionary, _ = checked
    assert stats.corpus_statistics(documents).first().asDict() == {
        "total_documents": 4, "documents_with_text": 3, "total_text_length": 199, "total_word_count": 21,
        "documents_without_text": 1, "avg_text_length": 66.33, "avg_word_count": 7.0,
    }
    assert stats.corpus_statistics(documents.filter("false")).first()["avg_text_length"] == 0.0
    lengths = stats.length_statistics(documents).first()
    assert (lengths["shortest"], lengths["longest"], lengths["median"], lengths["stddev"]) == (49, 100, 50.0, 29.16)
    shares = {r["status_id"]: (r["percent"], r["status_name"]) for r in stats.status_distribution(documents, dictionary).collect()}
    assert shares == {5: (25.0, "Active"), 1: (25.0, "Lost force"), 99: (25.0, None), None: (25.0, None)}
    assert {r["bucket"]: r["percent"] for r in stats.length_buckets(documents).collect()} == {"<1000": 100.0}


def run(spark, *rows):
    schema = "run_id STRING, source STRING, started_at TIMESTAMP_NTZ, status STRING, " + ", ".join(f"{c} LONG" for c in ledger.COUNTS)
    return spark.createDataFrame([(r, s, dt.datetime.fromisoformat(t), st, 1, 1, 0, 0, 0) for r, s, t, st in rows], schema)


def test_ledger(spark):
    runs = run(
        spark,
        ("r1", "s", "2026-01-01 01:00:00", "success"),
        ("r2", "s", "2026-01-05 01:00:00", "partial"),
        ("r3", "t", "2026-01-09 01:00:00", "success"),
        ("r4", "s", "2026-01-09 00:00:00", "success"),
    )
    assert ledger.latest_run(runs).first()["run_id"] == "r3"
    assert {r["source"]: r["run_id"] for r in ledger.latest_run_per_source(runs).collect()} == {"s": "r4", "t": "r3"}
    rates = {(r["source"], str(r["day"])): (r["runs"], r["success_percent"]) for r in ledger.success_rate(runs).collect()}
    assert rates == {
        ("s", "2026-01-01"): (1, 100.0), ("s", "2026-01-05"): (2, 50.0), ("s", "2026-01-09"): (2, 50.0), ("t", "2026-01-09"): (1, 100.0),
    }
    retried = ledger.upsert(runs, run(spark, ("r2", "s", "2026-01-05 02:00:00", "success")), ["run_id"])
    assert retried.count() == 4 and retried.filter("run_id = 'r2'").first()["status"] == "success"
    states = spark.createDataFrame([(0, "x"), (1, "x"), (0, None)], "failed LONG, done STRING")
    assert [r[0] for r in states.select(ledger.run_status(F.col("failed"), F.col("done"))).collect()] == ["success", "partial", "running"]


def test_snapshot_register(spark):
    dictionary = spark.createDataFrame(
        [("s", "status", 1, "a", True, dt.datetime(2026, 1, 1)), ("s", "theme", 1, "b", True, dt.datetime(2026, 1, 1)), ("s", "status", 2, "c", False, dt.datetime(2026, 1, 1))],
        "source STRING, dict_type STRING, entry_id INT, entry_name STRING, is_current BOOLEAN, valid_from TIMESTAMP_NTZ",
    )
    snapshot = snapshots.snapshot_rows(dictionary, DAY)
    stored = snapshots.register(spark.createDataFrame([], schemas.SNAPSHOTS), snapshot)
    row = snapshots.register(stored, snapshot).collect()
    assert [(r["dict_types"], r["entry_count"], r["snapshot_path"]) for r in row] == [
        (["status", "theme"], 2, f"snapshots/source=s/date={DAY}/")
    ]


def test_retention_selection(spark):
    objects = spark.createDataFrame([("date=2026-02-02/a",), ("date=2026-02-03/a",), ("date=bad/a",), ("x/y",)], "path STRING")
    assert [r["path"] for r in retention.expired(objects, "2026-02-10").collect()] == ["date=2026-02-02/a"]
    processed = spark.createDataFrame([("2023",), ("2024",), ("2026",)], "year STRING")
    assert [r["year"] for r in retention.cold(processed, 2026).collect()] == ["2023"]


def test_registry(spark):
    @register_source("made_up")
    class MadeUp(SourceReader):
        def dictionaries(self, spark):
            return spark.createDataFrame([], "source STRING")

        def listing(self, spark):
            return listing(spark, {"dokid": self.config["first"], "source": self.name})

        def texts(self, spark):
            return spark.createDataFrame([], "source STRING")

    both = union_listings([get_source("made_up", "a", first=1).listing(spark), get_source("made_up", first=2).listing(spark)])
    assert sorted((r["source"], r["dokid"]) for r in both.collect()) == [("a", 1), ("made_up", 2)]
    with pytest.raises(KeyError, match="landing_zone, made_up"):
        get_source("nowhere")

import json

from annalist.plans.daily import Store, run_day
from annalist.sources import get_source
from tests.test_storage import land, page, put_file, record


def test_a_run_reports_the_pages_it_leaves_out(spark, tmp_path):
    land(tmp_path / "day", [record(1), record(2)], {1: "one", 2: "two"})
    list_of = tmp_path / "day/list"
    put_file(list_of / "page1.json", page([record(1), record(2)], 9))
    put_file(list_of / "page2.json", "{")
    put_file(list_of / "page3.json", page([record(3), record(4), record(5)], 9))
    store = Store(spark, f"{tmp_path}/store")
    result = run_day(get_source("landing_zone", "s", path=f"{tmp_path}/day"), store, "run", "2026-02-01 00:00:00", "2026-02-01 00:10:00")
    assert result.report.select("left_out.*").first().asDict() == {"pages": 2, "records": 3, "unreadable_pages": 1}
    rows = [json.loads(line) for f in (tmp_path / "store/temp").rglob("task_pages_left_out/part-*.json") for line in f.read_text().splitlines()]
    assert sorted((r["source"], r["page"], r["records"], r["reason"]) for r in rows) == [("s", 2, None, "unreadable"), ("s", 3, 3, "after the end")]


def test_a_whole_list_leaves_out_nothing(spark, tmp_path):
    land(tmp_path / "day", [record(1), record(2)], {1: "one", 2: "two"})
    result = run_day(get_source("landing_zone", "s", path=f"{tmp_path}/day"), Store(spark, f"{tmp_path}/store"), "run", "2026-02-01 00:00:00", "2026-02-01 00:10:00")
    assert result.report.select("left_out.*").first().asDict() == {"pages": 0, "records": 0, "unreadable_pages": 0}

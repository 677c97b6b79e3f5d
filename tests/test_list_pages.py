from pathlib import Path

from pyspark.sql import functions as F

from annalist.session import shared_folder
from annalist.sinks.files import put_files
from annalist.sources import landing
from checks.catalog import QUERIES
from tests.test_storage import page, put_file, record


def _page_folders(root):
    return Path(root).glob("annalist/pages-*")


def test_page_files_are_opened_once(spark, tmp_path):
    for number in (1, 2):
        put_file(tmp_path / f"page{number}.json", page([record(10 * number), record(10 * number + 1)], 9))
    pages = landing.read_pages(spark, str(tmp_path)).withColumn("source", F.lit("s"))
    records = landing.listed_records(pages)
    for number in (1, 2):
        put_file(tmp_path / f"page{number}.json", page([record(99)], 9))
    assert [(r["seq"], r["dokid"]) for r in records.orderBy("seq").collect()] == [(0, 10), (1, 11), (2, 20), (3, 21)]


def test_list_reader_lands_a_file_a_page(spark, tmp_path):
    rows = [(i, s, "uk", 10 * i) for s in ("a", "src3", "x/y") for i in (250, 3, 101, 2)]
    spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    root = shared_folder(spark).removeprefix("file://")
    before = set(_page_folders(root))
    got = QUERIES["list_reader"](spark, str(tmp_path))
    assert sorted((r["source"], r["seq"], r["dokid"], r["extra"]) for r in got.collect()) == sorted(
        (s, seq, i, 10 * i)
        for s, ids in (("a", (2, 3, 101, 250)), ("src3", (2, 3)), ("x%252Fy", (2, 3, 101, 250)))
        for seq, i in enumerate(ids)
    )
    (landed,) = set(_page_folders(root)) - before
    files = sorted(str(f.relative_to(landed)) for f in landed.rglob("*") if f.is_file())
    assert files == [f"source={s}/page{n}.json" for s in ("a", "src3", "x%2Fy") for n in (1, 2, 3)]


def test_put_files_names_folders_as_partition_by_does(spark, tmp_path):
    sources = ["a b", "a/b", "x=y", "50%", "Рада", 'q"t', "?:*#", "[b]{c}^", "\\back", "tab\tx", "\x7f", "", None, "~t`|<>$@!,;()'"]
    rows = spark.createDataFrame([(s, f"n{i}.json", f"текст {i}") for i, s in enumerate(sources)], "source string, name string, value string")
    put_files(rows, "source", f"{tmp_path}/mine")
    rows.select("source", "value").write.partitionBy("source").text(f"{tmp_path}/spark")
    folders = [{f.name for f in (tmp_path / side).iterdir() if f.is_dir()} for side in ("mine", "spark")]
    assert folders[0] == folders[1] and len(folders[0]) == len(sources) - 1
    assert {f.name: f.read_text() for f in (tmp_path / "mine").rglob("*.json")} == {f"n{i}.json": f"текст {i}" for i in range(len(sources))}


def test_put_files_of_no_rows_leaves_a_folder(spark, tmp_path):
    put_files(spark.createDataFrame([], "source string, name string, value string"), "source", f"{tmp_path}/none")
    assert landing.read_pages(spark, f"{tmp_path}/none").collect() == []

import re

import pytest

from checks import curation_queries, history_queries, report_queries, storage_queries, stream_queries, text_queries
from checks.catalog import QUERIES, SQL
from checks.compare import compare, database

FOLDER = "/root/testdata/sf0.001"
WRITES = {name for name, build in QUERIES.items() if build.args[0].__module__ in {storage_queries.__name__, stream_queries.__name__}}
UNWANTED = re.compile(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroups|CartesianProduct|BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def connection():
    return database(FOLDER)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    """Same rows as the SQL, no Python workers, no join without an equality."""
    df = QUERIES[name](spark, FOLDER)
    if name not in WRITES:
        found = UNWANTED.search(plan(df))
        assert found is None, found
    same, note = compare(df, connection, name)
    assert same, note


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_merge_shuffles_once(spark):
    from checks.feed import history_1
    from checks.registry import Tables

    text = plan(history_1(Tables(spark, FOLDER)))
    # One exchange for the merge; the other spreads the one-file test input.
    assert text.count("Exchange hashpartitioning(source") == 1
    assert text.count("Exchange") <= 2


def test_scan_reads_needed_columns(spark):
    from annalist.operators import history
    from checks.registry import Tables

    t = Tables(spark, FOLDER)
    text = plan(history.repeated_keys(t.documents, ["source"]))
    assert "ReadSchema: struct<source:string>" in text


def test_modules_are_registered():
    assert {build.args[0].__module__ for build in QUERIES.values()} == {
        m.__name__ for m in (curation_queries, history_queries, report_queries, storage_queries, stream_queries, text_queries)
    }

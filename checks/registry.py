"""Collects each query with the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, partial, wraps

from pyspark.sql import DataFrame, SparkSession

from annalist.session import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The given tables of one scale, opened once each."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        # Called for names not yet set; the table is kept under its name.
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)
        return table

    @cached_property
    def texts(self) -> DataFrame:
        """The documents, spread over the cores for work on their texts."""
        return spread(self.documents, "doc_id")


def once(build: Callable) -> Callable:
    """Build a shared input once per query, however often the query refers to it."""

    @wraps(build)
    def get(t: Tables, *arguments) -> DataFrame:
        key = f"{build.__module__}.{build.__name__}{arguments}"
        if key not in t.__dict__:
            t.__dict__[key] = build(t, *arguments)
        return t.__dict__[key]

    return get


def _run(build: Callable[[Tables], DataFrame], spark: SparkSession, folder: str) -> DataFrame:
    return build(Tables(spark, folder))


def query(name: str, sql: str | None = None):
    def add(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = partial(_run, build)
        if sql is not None:
            SQL[name] = sql
        return build

    return add

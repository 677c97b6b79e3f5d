"""Named sources. Each offers dictionaries, a listing and texts as DataFrames."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.sources import landing

_SOURCES: dict[str, type[SourceReader]] = {}


class SourceReader(ABC):
    def __init__(self, name: str, **config):
        self.name = name
        self.config = config

    @abstractmethod
    def dictionaries(self, spark: SparkSession) -> DataFrame:
        """source, dict_type, entry_id, entry_name, seq"""

    @abstractmethod
    def listing(self, spark: SparkSession) -> DataFrame:
        """Listed records with source and seq."""

    def pages_left_out(self, spark: SparkSession) -> DataFrame:
        """source, page, records, reason of the pages ``listing`` leaves out; none where a source has no pages."""
        return spark.createDataFrame([], landing.LEFT_OUT)

    @abstractmethod
    def texts(self, spark: SparkSession) -> DataFrame:
        """source, source_id, text"""


def register_source(name: str) -> Callable[[type[SourceReader]], type[SourceReader]]:
    def add(reader: type[SourceReader]) -> type[SourceReader]:
        _SOURCES[name] = reader
        return reader

    return add


def get_source(name: str, source: str | None = None, **config) -> SourceReader:
    if name not in _SOURCES:
        raise KeyError(f"unknown source {name!r}, known: {', '.join(sorted(_SOURCES))}")
    return _SOURCES[name](source or name, **config)


def union_listings(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


@register_source("landing_zone")
class LandingZone(SourceReader):
    """Files below ``path``: list/, texts/, manifests/ and dictionaries/."""

    def dictionaries(self, spark: SparkSession) -> DataFrame:
        path = self.config["path"]
        lines = landing.read_dictionary_lines(spark, f"{path}/dictionaries")
        manifest = landing.read_manifests(spark, f"{path}/manifests")
        return landing.dictionary_entries(manifest, lines).withColumn("source", F.lit(self.name))

    def _pages(self, spark: SparkSession) -> DataFrame:
        return landing.read_pages(spark, f"{self.config['path']}/list").withColumn("source", F.lit(self.name))

    def listing(self, spark: SparkSession) -> DataFrame:
        return landing.listed_records(self._pages(spark), self.config.get("max_pages"))

    def pages_left_out(self, spark: SparkSession) -> DataFrame:
        return landing.pages_left_out(landing.page_sizes(self._pages(spark)), self.config.get("max_pages"))

    def texts(self, spark: SparkSession) -> DataFrame:
        return landing.read_texts(spark, f"{self.config['path']}/texts").withColumn("source", F.lit(self.name))

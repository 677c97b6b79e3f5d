"""Dates, id lists, hashes and JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_number(value: Column) -> Column:
    """A YYYYMMDD number with 0 read as absent."""
    return F.nullif(value, F.lit(0))


def parse_day(value: Column) -> Column:
    """YYYYMMDD number to date; 0, other lengths and impossible days give null."""
    digits = day_number(value).cast("string")
    return F.when(F.length(digits) == 8, F.try_to_date(digits, "yyyyMMdd"))


def is_impossible_day(value: Column) -> Column:
    """True for eight digits that name no day, such as 20261341."""
    digits = day_number(value).cast("string")
    return F.coalesce((F.length(digits) == 8) & F.try_to_date(digits, "yyyyMMdd").isNull(), F.lit(False))


def parse_iso_day(value: Column) -> Column:
    """ISO date or timestamp text to date; anything else gives null."""
    shaped = value.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}.*)?$")
    return F.when(shaped, F.try_to_date(F.substring(value, 1, 10), "yyyy-MM-dd"))


def _id_parts(value: Column) -> Column:
    return F.filter(F.split(value, r"\|"), lambda part: F.trim(part) != "")


def parse_ids(value: Column) -> Column:
    """Text such as "6|168" to ARRAY<INT>; null gives an empty array."""
    ids = F.transform(_id_parts(value), lambda part: F.trim(part).try_cast("int"))
    return F.coalesce(ids, F.array().cast("array<int>"))


def has_bad_id(value: Column) -> Column:
    """True if a part of an id list is not a whole number."""
    return F.coalesce(
        F.exists(_id_parts(value), lambda part: F.trim(part).try_cast("int").isNull()), F.lit(False)
    )


def first_truthy(value: Column, fallback: Column) -> Column:
    """``value`` unless it is null, empty or "0"; then ``fallback``."""
    return F.coalesce(F.nullif(F.nullif(value, F.lit("0")), F.lit("")), fallback)


def content_hash(*values: Column) -> Column:
    """SHA-256 over the values joined by "|", null counting as empty text."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(v.cast("string"), F.lit("")) for v in values]), 256)


def version_key(*values: Column) -> Column:
    """Stable id of one stored version, from its key and start time."""
    return content_hash(*values)


def to_json_text(*columns: Column) -> Column:
    """JSON object with null fields kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def partition_day(path: Column) -> Column:
    """Date of a leading ``date=YYYY-MM-DD`` path part; null if absent or malformed."""
    part = F.regexp_extract(path, r"^date=([0-9]{4}-[0-9]{2}-[0-9]{2})(?:/|$)", 1)
    return F.try_to_date(F.nullif(part, F.lit("")), "yyyy-MM-dd")

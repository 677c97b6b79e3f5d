"""Keyed history with half-open validity periods, merged as whole sets."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.functions.values import content_hash, version_key
from annalist.operators.chains import HOT_KEY_ROWS, find_hot_keys, number_changes, with_next

# Key columns of the history tables.
KEY_COLUMNS = ("source", "source_id", "dict_type", "entry_id", "version_id")


@dataclass(frozen=True)
class HistorySpec:
    """What identifies a row, what makes a new version, what is only refreshed.

    ``tracked`` columns feed the content hash. ``refreshed`` columns follow the
    last row of a version; everything else keeps the values of its first row.
    """

    keys: list[str]
    tracked: list[str]
    refreshed: list[str] = field(default_factory=list)
    versioned: bool = False  # add version_id


DICTIONARY = HistorySpec(["source", "dict_type", "entry_id"], ["entry_name"])
DOCUMENT = HistorySpec(
    ["source", "source_id"],
    ["title", "status_id", "revision_date"],
    ["raw_path_revision", "raw_path_collection", "processed_path_revision", "processed_path_collection", "type_ids"],
    versioned=True,
)


def at(time: str | Column) -> Column:
    """A literal time without zone."""
    return F.lit(time).cast("timestamp_ntz") if isinstance(time, str) else time


def _stack(current: DataFrame, batch: DataFrame, spec: HistorySpec, order: str) -> DataFrame:
    """Current rows first (order -1), then the batch in input order."""
    hashed = batch.withColumn("content_hash", content_hash(*[F.col(c) for c in spec.tracked]))
    payload = [c for c in batch.columns if c not in {order, *spec.keys}]
    old = current.filter("is_current").select(
        *spec.keys,
        *[c for c in payload if c in current.columns],
        "content_hash",
        F.lit(-1).cast("long").alias("_order"),
        F.col("valid_from").alias("_old_from"),
        F.col("created_at").alias("_old_created"),
        F.col("updated_at").alias("_old_updated"),
    )
    new = hashed.select(*spec.keys, *payload, "content_hash", F.col(order).cast("long").alias("_order"))
    return old.unionByName(new, allowMissingColumns=True)


def _numbered(current: DataFrame, batch: DataFrame, spec: HistorySpec, order: str, limit: int) -> DataFrame:
    """Old and new rows with their version number: 0 for a stored row, then 1, 2, ..."""
    hot = find_hot_keys(batch, spec.keys, limit)
    rows = _stack(current, batch, spec, order)
    return number_changes(rows, spec.keys, "_order", "content_hash", F.col("_order") >= 0, hot)


def merge(
    current: DataFrame,
    batch: DataFrame,
    spec: HistorySpec,
    run_time: str | Column,
    order: str = "seq",
    hot_limit: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Versions in force before or after the batch.

    A key that is new gets a version; one whose hash differs closes the version
    in force and opens another; an equal hash only refreshes. A batch may name a
    key many times, also returning to an earlier hash. Keys absent from the
    batch stay open. Versions closed earlier are not read and not returned.

    The k-th version a batch opens for a key starts k-1 microseconds after
    ``run_time``, so every period is non-empty and reruns give equal rows.
    """
    now = at(run_time)
    rows = _numbered(current, batch, spec, order, hot_limit)
    kept = [c for c in batch.columns if c not in {order, *spec.keys, *spec.refreshed}]
    is_old = F.col("_order") < 0
    head = is_old | F.col("_changed")
    opened = now + F.make_dt_interval(secs=(F.col("_version") - 1).cast("decimal(18,6)") / F.lit(1_000_000))

    # A changed row opens its own version and ends the one before it. Sending
    # both facts to the same aggregate avoids a second ordered pass.
    own = F.struct(F.col("_version").alias("n"), F.lit(True).alias("own"))
    ended = F.struct((F.col("_version") - 1).alias("n"), F.lit(False).alias("own"))
    parts = rows.select("*", F.explode(F.when(F.col("_changed"), F.array(own, ended)).otherwise(F.array(own))).alias("_to"))
    parts = parts.select(
        *spec.keys,
        *kept,
        *spec.refreshed,
        "content_hash",
        F.col("_to.n").alias("_n"),
        F.when(F.col("_to.own"), F.col("_order")).alias("_own_order"),
        (F.col("_to.own") & head).alias("_head"),
        (F.col("_to.own") & ~head).alias("_again"),
        F.when(~F.col("_to.own"), opened).alias("_ended"),
        F.when(is_old, F.col("_old_from")).otherwise(opened).alias("valid_from"),
        F.when(is_old, F.col("_old_created")).otherwise(now).alias("created_at"),
        F.when(is_old, F.col("_old_updated")).otherwise(now).alias("updated_at"),
    )
    # A version has one head. Each column is aggregated on its own, so that
    # columns nobody asks for are pruned down to the scan.
    versions = (
        parts.groupBy(*spec.keys, "_n")
        .agg(
            F.max("_head").alias("_opened"),
            F.max("_ended").alias("valid_to"),
            F.max("_again").alias("_seen_again"),
            *[
                F.any_value(F.when(F.col("_head"), F.col(c)), ignoreNulls=True).alias(c)
                for c in [*kept, "content_hash", "valid_from", "created_at", "updated_at"]
            ],
            *[F.max_by(c, "_own_order").alias(c) for c in spec.refreshed],
        )
        # A brand-new key has no version before its first.
        .filter("_opened")
    )
    touched = F.col("valid_to").isNotNull()
    if spec.refreshed:
        touched = touched | F.col("_seen_again")
    columns = [
        *[F.col(c) for c in [*spec.keys, *kept, *spec.refreshed, "content_hash", "valid_from", "valid_to"]],
        F.col("valid_to").isNull().alias("is_current"),
        F.col("created_at"),
        F.when(touched, now).otherwise(F.col("updated_at")).alias("updated_at"),
    ]
    merged = versions.select(*columns)
    if spec.versioned:
        merged = merged.withColumn("version_id", version_id(spec))
    return merged


def version_id(spec: HistorySpec) -> Column:
    return version_key(*[F.col(k) for k in spec.keys], F.col("valid_from"))


def merge_actions(
    current: DataFrame, batch: DataFrame, spec: HistorySpec, order: str = "seq", hot_limit: int = HOT_KEY_ROWS
) -> DataFrame:
    """What the merge does with each batch row: insert, update or unchanged."""
    action = (
        F.when(~F.col("_changed"), "unchanged").when(F.col("_first"), "insert").otherwise("update").alias("action")
    )
    return (
        _numbered(current, batch, spec, order, hot_limit)
        .filter(F.col("_order") >= 0)
        .select(*spec.keys, F.col("_order").alias(order), action)
    )


def action_counts(actions: DataFrame, by: list[str] | None = None) -> DataFrame:
    return actions.groupBy(*(by or [])).agg(
        F.count_if(F.col("action") == "insert").alias("inserted"),
        F.count_if(F.col("action") == "update").alias("updated"),
        F.count_if(F.col("action") == "unchanged").alias("unchanged"),
    )


# --- queries over a history -------------------------------------------------


def current_rows(history: DataFrame, source: str | None = None) -> DataFrame:
    rows = history.filter("is_current")
    return rows if source is None else rows.filter(F.col("source") == source)


def current_state(history: DataFrame) -> DataFrame:
    """The narrow lookup the worklist needs."""
    return current_rows(history).select("source", "source_id", "revision_date", "content_hash")


def valid_at(time: Column | str) -> Column:
    moment = at(time)
    return (F.col("valid_from") <= moment) & (F.col("valid_to").isNull() | (F.col("valid_to") > moment))


def as_of(history: DataFrame, time: Column | str) -> DataFrame:
    """The rows that were in force at one moment."""
    return history.filter(valid_at(time))


def version_counts(history: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one version, most versions first."""
    return (
        history.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("versions"))
        .filter(F.col("versions") > 1)
        .orderBy(F.desc("versions"), *keys)
    )


def key_history(history: DataFrame, **key: str) -> DataFrame:
    """All versions of one key, newest first; without a key, of every key."""
    for name, value in key.items():
        history = history.filter(F.col(name) == value)
    return _newest_first(history)


def _newest_first(history: DataFrame) -> DataFrame:
    """By start, then by key: versions of one run share their start, and a sort splits a tie only by more columns."""
    return history.orderBy(F.desc("valid_from"), *[c for c in KEY_COLUMNS if c in history.columns])


def recent_updates(history: DataFrame, as_of_time: Column | str, days: int = 7) -> DataFrame:
    """Versions that began within the last days, newest first."""
    since = at(as_of_time) - F.make_dt_interval(days=F.lit(days))
    return _newest_first(history.filter(F.col("valid_from") > since))


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once; empty if ``keys`` are unique."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def repeated_current_keys(history: DataFrame, keys: list[str]) -> DataFrame:
    return repeated_keys(history.filter("is_current"), keys)


def overlapping_periods(history: DataFrame, keys: list[str], hot_limit: int = HOT_KEY_ROWS) -> DataFrame:
    """Versions whose period reaches into the next one of the same key."""
    rows = history.withColumn("_at", F.unix_micros(F.col("valid_from").cast("timestamp")))
    hot = find_hot_keys(history, keys, hot_limit)
    ends = F.unix_micros(F.col("valid_to").cast("timestamp"))
    return (
        with_next(rows, keys, "_at", hot)
        .filter(F.col("_next").isNotNull() & (ends.isNull() | (ends > F.col("_next"))))
        .drop("_at", "_next")
    )

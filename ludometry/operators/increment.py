"""Incremental loading: which rows are new, and key-wise replacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Most keys, and characters of them, that are sent to every executor.
BROADCAST_KEYS, BROADCAST_CHARS = 500_000, 64_000_000


def fits(keys: DataFrame, column: str, most: int | None = None) -> bool:
    """Whether keys may be sent to every executor: by their counted number and length.

    Keys come from unvalidated text, so a few of them may be long.
    """
    found = keys.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length(column)), F.lit(0)).alias("chars")).first()
    return found.n <= (BROADCAST_KEYS if most is None else most) and found.chars <= BROADCAST_CHARS


def without(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is none of some stored, distinct ``key``; null ones stay.

    The keys are sent to the rows if they fit; otherwise Spark chooses the join.
    """
    gone = keys.select(F.col("key").alias(column))
    return rows.join(F.broadcast(gone) if fits(gone, column) else gone, column, "left_anti")


def new_rows(
    batch: DataFrame, stored_keys: DataFrame | None, key: str, batch_rows: int | None = None
) -> DataFrame:
    """Rows of the batch whose key is not stored; without a store, all of them.

    ``batch_rows``, where the caller has counted them, picks the plan. A small
    batch is broadcast to the store, which is then scanned and never shuffled;
    otherwise both sides are shuffled, the store reduced to distinct keys first
    so that many copies of a key weigh nothing. Either way many copies in the
    batch can be split by the adaptive skew join.

    Null keys never match and so always survive; give keyless rows a
    ``content_key`` first. Copies within the batch are kept.
    """
    if stored_keys is None:
        return batch
    known = stored_keys
    if batch_rows is not None and batch_rows <= BROADCAST_KEYS:
        known = known.join(F.broadcast(batch.select(key).distinct()), key, "left_semi")
    return batch.join(known.distinct(), key, "left_anti")


def unprocessed_keys(keys: DataFrame, done_keys: DataFrame, key: str) -> DataFrame:
    """Distinct rows of ``keys`` whose key is not done yet; rows without a key never are."""
    return keys.filter(F.col(key).isNotNull()).distinct().join(done_keys, key, "left_anti")


def upsert(stored: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows without those the delta replaces, plus the delta."""
    return stored.join(delta.select(*keys), list(keys), "left_anti").unionByName(delta)


def watermark(stored: DataFrame, column: str) -> DataFrame:
    """One row with the largest stored value, 0 for an empty store."""
    return stored.agg(F.coalesce(F.max(column), F.lit(0)).alias("watermark"))


def in_dates(rows: DataFrame, dates: Sequence, column: str = "event_date") -> DataFrame:
    """Rows of the given days, null among them; prunes the partitions to read."""
    days = [day for day in dates if day is not None]
    wanted = F.col(column).isin(days)
    if len(days) < len(dates):
        wanted = wanted | F.col(column).isNull()
    return rows.filter(wanted)

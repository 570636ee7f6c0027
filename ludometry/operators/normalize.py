"""Flattening, renaming and cleaning of raw records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludometry.functions import epoch_date, epoch_timestamp, lower_trim, upper_trim
from ludometry.schemas import CORRUPT

# How each cleaned column is cleaned; the rest passes as it is.
CLEANED = {
    "event_type": lower_trim,
    "country": upper_trim,
    "device_os": lower_trim,
    "username": lambda name: F.trim(F.col(name)),
    "session_state": lower_trim,
}


def with_event_time(events: DataFrame) -> DataFrame:
    """Instant and UTC day of the epoch seconds in ``timestamp``."""
    return events.withColumns(
        {
            "event_timestamp": epoch_timestamp("timestamp"),
            "event_date": epoch_date("timestamp"),
        }
    )


def flatten_events(bronze: DataFrame, *kept: str) -> DataFrame:
    """One flat row per event; a null ``event_data`` gives null fields.

    ``kept`` names further columns that pass as they are.
    """
    renamed = {"session_state": "state"}
    nested = [
        F.col(f"event_data.{renamed.get(name, name)}").alias(name)
        for name in (
            "country",
            "device_os",
            "username",
            "session_state",
            "map_id",
            "opponent_id",
            "outcome",
        )
    ]
    return bronze.select(
        F.col("id").alias("event_id"), "timestamp", "event_type", "user_id", *nested, CORRUPT, *kept
    )


def flatten_profiles(raw: DataFrame) -> DataFrame:
    """The flat table of producers that nest the profile under ``user``."""
    return raw.select(
        "id", "timestamp", "event_type", "user_id", "user.country", "user.device_os", "user.username"
    )


def flatten_top_level_map(raw: DataFrame) -> DataFrame:
    """The early shape with ``map_id`` beside the profile struct."""
    return raw.select(
        F.col("id").alias("event_id"),
        "timestamp",
        "event_type",
        "user_id",
        "map_id",
        "event_data.country",
        "event_data.device_os",
        "event_data.username",
        CORRUPT,
    )


def clean_events(flat: DataFrame) -> DataFrame:
    """Trim and fold the case of the text columns that ``flat`` has."""
    present = {name: clean(name) for name, clean in CLEANED.items() if name in flat.columns}
    return flat.withColumns(present)


def rename_maps(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        F.col("id").alias("map_id"), F.trim("name").alias("map_name"), CORRUPT
    )


def stamped(rows: DataFrame, at: Column | None = None) -> DataFrame:
    """Processing time; tests pass a fixed one."""
    return rows.withColumn("processed_at", F.current_timestamp() if at is None else at)

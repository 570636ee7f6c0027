"""The flat variant: profile events in one table, cleaned and reported on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ludometry.operators.normalize import (
    clean_events,
    flatten_profiles,
    flatten_top_level_map,
    stamped,
    with_event_time,
)
from ludometry.operators.quality import event_rules, validate
from ludometry.schemas import FLAT_EVENT, RAW_PROFILE_EVENT, RAW_TOP_LEVEL_MAP_EVENT
from ludometry.sinks.tables import append, overwrite
from ludometry.sources.jsonlines import read_flat_events, read_json_lines

REQUIRED = ["event_id", "user_id", "event_type"]


def load_flat(spark: SparkSession, raw_path: str, table: str) -> DataFrame:
    """Append every object of the file; loading a file twice stores it twice."""
    append(read_flat_events(spark, raw_path), table)
    return spark.read.schema(FLAT_EVENT).parquet(table)


def clean_flat(flat: DataFrame) -> DataFrame:
    """Cleaned rows with all required fields, whole-row duplicates collapsed."""
    named = flat.withColumnRenamed("id", "event_id").na.drop(subset=REQUIRED)
    return clean_events(named).distinct()


def rebuild_clean_flat(flat: DataFrame, table: str) -> DataFrame:
    """Drop the table and build it anew from a query."""
    cleaned = clean_flat(flat)
    overwrite(cleaned, table)
    return flat.sparkSession.read.schema(cleaned.schema).parquet(table)


def load_top_level_maps(spark: SparkSession, raw_path: str, table: str) -> DataFrame:
    """Append events of the early shape, bad lines with them, as they are."""
    append(read_json_lines(spark, raw_path, RAW_TOP_LEVEL_MAP_EVENT), table)
    return spark.read.schema(RAW_TOP_LEVEL_MAP_EVENT).parquet(table)


def refine_top_level_maps(stored: DataFrame, at: Column | None = None) -> DataFrame:
    """Flat, clean and validated events of the early shape, good and bad together."""
    cleaned = clean_events(flatten_top_level_map(stored))
    timed = with_event_time(cleaned).drop("event_date")
    return stamped(validate(timed, event_rules()), at)


def scan_profiles(spark: SparkSession, raw_path: str) -> DataFrame:
    """Profile events as they are, without those that lack a required field.

    No cleaning, no corrupt column: a bad line is an all-null row and is
    dropped with the others.
    """
    raw = read_json_lines(spark, raw_path, RAW_PROFILE_EVENT, corrupt_column=None)
    return (
        flatten_profiles(raw)
        .withColumnRenamed("id", "event_id")
        .filter(
            F.col("event_id").isNotNull()
            & F.col("user_id").isNotNull()
            & F.col("event_type").isNotNull()
        )
    )

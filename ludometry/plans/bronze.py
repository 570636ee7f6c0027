"""Raw JSON Lines to Bronze."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludometry.functions import content_key
from ludometry.operators.increment import in_dates, new_rows, without
from ludometry.operators.normalize import with_event_time
from ludometry.plans.lake import Lake
from ludometry.schemas import BRONZE_EVENT, RAW_PAYLOAD
from ludometry.sinks.keys import add_keys, changing, known_among, outdate, stored_keys
from ludometry.sinks.tables import append_partitioned, landed, overwrite
from ludometry.sources.jsonlines import read_events, read_maps
from ludometry.sources.tables import read_table


def _stored_keys(stored: DataFrame) -> DataFrame:
    """Record keys of Bronze.

    Rows with an id need that one column only. Rows without are found by the
    null counts in the Parquet footers, and just those are read whole.
    """
    key = content_key("id", RAW_PAYLOAD).alias("key")
    with_id = stored.filter(F.col("id").isNotNull()).select(
        F.concat(F.lit("k"), "id").alias("key")
    )
    return with_id.unionByName(stored.filter(F.col("id").isNull()).select(key))


def append_new_events(
    spark: SparkSession, batch: DataFrame, lake: Lake, dates: Sequence | None = None
) -> int:
    """Append the rows of a raw batch that Bronze does not hold yet.

    The keys of the batch are looked up in the key table of Bronze; the wide rows
    of the batch meet only those that were found there. What is stored is not
    shuffled, and read by its keys alone.

    ``dates`` limits the batch and the look into Bronze alike to those days; None
    among them stands for rows without a day. What the batch holds of other days
    is left for another call. An event that comes again with another timestamp
    is found only if both days are given.
    """
    batch = with_event_time(batch)
    if dates is not None:
        batch = in_dates(batch, dates)
    stored = read_table(spark, lake.bronze_events, BRONZE_EVENT)
    if stored is None:
        return append_partitioned(batch, lake.bronze_events, "event_date")
    # Parsed once and with all fields; the corrupt flags depend on it.
    with landed(batch.withColumn("key", content_key("id", RAW_PAYLOAD)), "bronze-landing") as rows:
        if dates is not None:
            outdate(spark, lake.bronze_keys)
            fresh = new_rows(rows, _stored_keys(in_dates(stored, dates)), "key", rows.count())
            return append_partitioned(fresh.drop("key"), lake.bronze_events, "event_date")
        history = stored_keys(spark, lake.bronze_keys, lambda: _stored_keys(stored))
        with landed(known_among(rows, history), "bronze-known") as known:
            with changing(spark, lake.bronze_keys):
                fresh = without(rows, known, "key").drop("key")
                added = append_partitioned(fresh, lake.bronze_events, "event_date")
                if added:
                    add_keys(without(rows.select("key").distinct(), known, "key"), lake.bronze_keys)
            return added


def refresh_maps(spark: SparkSession, path: str, lake: Lake) -> int:
    return overwrite(read_maps(spark, path), lake.bronze_maps)


def run_bronze(
    spark: SparkSession,
    lake: Lake,
    raw_events: str | None = None,
    raw_maps: str | None = None,
    dates: Sequence | None = None,
) -> dict[str, int]:
    batch = read_events(spark, raw_events or lake.raw_events)
    return {
        "new_events": append_new_events(spark, batch, lake, dates),
        "maps": refresh_maps(spark, raw_maps or lake.raw_maps, lake),
    }

"""Bronze to Silver, quarantine and the enriched events."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import ExitStack

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ludometry.functions import record_digest
from ludometry.operators.enrich import with_map_names
from ludometry.operators.increment import (
    BROADCAST_KEYS,
    fits,
    in_dates,
    unprocessed_keys,
    without,
)
from ludometry.operators.normalize import (
    clean_events,
    flatten_events,
    rename_maps,
    stamped,
    with_event_time,
)
from ludometry.operators.quality import event_rules, map_rules, one_per_key, split, validate
from ludometry.plans.lake import Lake
from ludometry.schemas import (
    BRONZE_EVENT,
    BRONZE_MAP,
    ENRICHED_EVENT,
    QUARANTINED_EVENT,
    RAW_PAYLOAD,
    RECORD_KEY,
    SILVER_EVENT,
    SILVER_MAP,
)
from ludometry.session import ensure_checkpoints
from ludometry.sinks.keys import add_keys, changing, known_among, outdate, stored_keys
from ludometry.sinks.tables import append_partitioned, landed, overwrite, overwrite_partitions
from ludometry.sources.tables import read_or_empty, read_table, settle

# Most days that are worth listing in a filter; more are read as all days.
MOST_DAYS = 5_000

# A total order over copies of an event, so that the survivor is always the same.
EVENT_COPIES = [
    "timestamp",
    "event_type",
    "user_id",
    "country",
    "device_os",
    "username",
    "session_state",
    "map_id",
    "opponent_id",
    "outcome",
]


def refine_events(bronze: DataFrame, at: Column | None = None) -> DataFrame:
    """Flat, clean and validated events, good and bad together."""
    return refine_records(bronze, at).drop(RECORD_KEY)


def refine_records(bronze: DataFrame, at: Column | None = None) -> DataFrame:
    """The same, each event with the digest of its raw record, which bad ones keep."""
    named = bronze.withColumn(RECORD_KEY, record_digest(RAW_PAYLOAD))
    timed = with_event_time(clean_events(flatten_events(named, RECORD_KEY)))
    checked = stamped(validate(timed, event_rules()), at)
    return checked.select(*QUARANTINED_EVENT.fieldNames())


def refine_maps(bronze: DataFrame, at: Column | None = None) -> DataFrame:
    checked = stamped(validate(rename_maps(bronze), map_rules()), at)
    return checked.select(*SILVER_MAP.fieldNames())


def accepted_events(refined: DataFrame) -> DataFrame:
    # Valid rows have an id; saying so prunes the scan of rows without one.
    with_id = refined.filter(F.col("event_id").isNotNull()).drop(RECORD_KEY)
    return one_per_key(split(with_id)[0], "event_id", EVENT_COPIES)


def accepted_maps(refined: DataFrame) -> DataFrame:
    return one_per_key(split(refined)[0], "map_id", ["map_name"])


def not_yet_quarantined(rejected: DataFrame, quarantined: DataFrame | None) -> DataFrame:
    """Bad rows whose raw record is not quarantined.

    Bronze takes all copies of a record from one delivery, so a record is
    quarantined with all its copies or not at all. Records that are spelled
    differently and clean to the same row are two records.
    """
    if quarantined is None:
        return rejected
    return rejected.join(quarantined.select(RECORD_KEY).distinct(), RECORD_KEY, "left_anti")


def new_events(
    spark: SparkSession, lake: Lake, dates: Sequence | None = None, at: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected events of Bronze that Silver and quarantine do not hold.

    Rows without an id are found by their records. Usually the two hold
    nearly all of Bronze: then only the ids are compared, and the few new ones
    are sent to the wide rows. When there are too many to send, the rows are
    joined with Silver's ids, the accepted ones after their copies are gone. Either
    way bad rows of an id that Silver holds are not looked at.
    """
    bronze = read_or_empty(spark, lake.bronze_events, BRONZE_EVENT)
    silver = read_table(spark, lake.silver_events, SILVER_EVENT)
    quarantined = read_table(spark, lake.quarantined_events, QUARANTINED_EVENT)
    if dates is not None:
        bronze = in_dates(bronze, dates)
        silver = None if silver is None else in_dates(silver, dates)
        quarantined = None if quarantined is None else in_dates(quarantined, dates)
    if silver is None:
        refined = refine_records(bronze, at)
        return accepted_events(refined), not_yet_quarantined(split(refined)[1], quarantined)

    done = silver.select("event_id")
    fresh = fresh_ids(bronze, done, quarantined)
    if fits(fresh, "event_id", BROADCAST_KEYS):
        refined = refine_records(rows_of(bronze, fresh), at)
        return accepted_events(refined), not_yet_quarantined(split(refined)[1], quarantined)
    refined = refine_records(bronze, at)
    return (
        accepted_events(refined).join(done, "event_id", "left_anti"),
        not_yet_quarantined(split(refined)[1].join(done, "event_id", "left_anti"), quarantined),
    )


def fresh_ids(
    bronze: DataFrame, done: DataFrame, quarantined: DataFrame | None = None
) -> DataFrame:
    """Ids, and the days they lie in, that are still to be looked at; narrow everywhere.

    An id that Silver does not hold is done with on a day when quarantine holds
    all its rows of that day. Some of them do not settle it: quarantine is
    written first, and a job that dies then leaves good rows of the id behind.

    Rows are counted before the lookup, so a crowded id is one row per input
    partition. Both writes use the result; pinned, it is found once.
    """
    ensure_checkpoints(bronze.sparkSession)
    every = _rows_per_id(bronze.withColumnRenamed("id", "event_id"), "_rows")
    fresh = unprocessed_keys(every, done, "event_id")
    if quarantined is not None:
        held = _rows_per_id(quarantined, "_held").withColumnsRenamed(
            {"event_id": "_id", "event_date": "_day"}
        )
        settled = (
            (F.col("event_id") == F.col("_id"))
            & F.col("event_date").eqNullSafe(F.col("_day"))
            & (F.col("_rows") <= F.col("_held"))
        )
        fresh = fresh.join(held, settled, "left_anti")
    return fresh.select("event_id", "event_date").checkpoint()


def _rows_per_id(events: DataFrame, name: str) -> DataFrame:
    with_id = events.filter(F.col("event_id").isNotNull())
    return with_id.groupBy("event_id", "event_date").agg(F.count(F.lit(1)).alias(name))


def rows_of(bronze: DataFrame, fresh: DataFrame) -> DataFrame:
    """Bronze rows with one of the fresh ids, or with none.

    Only the days of fresh ids are read. Rows without an id are found by the
    null counts in the Parquet footers.
    """
    days = [row.event_date for row in fresh.select("event_date").distinct().take(MOST_DAYS + 1)]
    near = in_dates(bronze, days) if len(days) <= MOST_DAYS else bronze
    sent = F.broadcast(fresh.select(F.col("event_id").alias("id")).distinct())
    return near.join(sent, "id", "left_semi").unionByName(bronze.filter(F.col("id").isNull()))


def append_refined(
    spark: SparkSession, rows: DataFrame, lake: Lake, at: Column | None = None
) -> dict[str, int]:
    """Refine some rows of Bronze and append what Silver and quarantine do not hold.

    Their ids and records are looked up in the key tables of Silver and
    quarantine, which are not shuffled; nothing else that is stored is read. As
    in ``new_events``, bad rows of an id that Silver holds are not looked at,
    and bad events are written first. All copies of an event come with one call.
    """
    silver = read_table(spark, lake.silver_events, SILVER_EVENT)
    quarantined = read_table(spark, lake.quarantined_events, QUARANTINED_EVENT)
    with ExitStack() as scratch:
        # Refined once; the look-ups and both writes read what they need of it.
        refined = scratch.enter_context(landed(refine_records(rows, at), "refined"))
        if silver is not None:
            history = stored_keys(spark, lake.silver_keys, lambda: _keys(silver, "event_id"))
            done = scratch.enter_context(landed(known_among(_keys(refined, "event_id"), history), "done"))
            refined = without(refined, done, "event_id")
        rejected = split(refined)[1]
        if quarantined is not None:
            history = stored_keys(spark, lake.quarantine_keys, lambda: _keys(quarantined, RECORD_KEY))
            held = scratch.enter_context(landed(known_among(_keys(rejected, RECORD_KEY), history), "held"))
            rejected = without(rejected, held, RECORD_KEY)
        valid = split(refined)[0]
        return {
            "quarantined_events": _append_keyed(
                rejected, _keys(rejected, RECORD_KEY), lake.quarantined_events, lake.quarantine_keys, quarantined is None
            ),
            "valid_events": _append_keyed(
                accepted_events(refined), _keys(valid, "event_id"), lake.silver_events, lake.silver_keys, silver is None
            ),
        }


def _keys(rows: DataFrame, column: str) -> DataFrame:
    return rows.filter(F.col(column).isNotNull()).select(F.col(column).alias("key"))


def _append_keyed(rows: DataFrame, keys: DataFrame, path: str, keys_path: str, first: bool) -> int:
    """Append to a table and its keys; those of a first write are made when they are asked for."""
    spark = rows.sparkSession
    if first:
        outdate(spark, keys_path)
        return append_partitioned(rows, path, "event_date")
    with changing(spark, keys_path):
        added = append_partitioned(rows, path, "event_date")
        if added:
            add_keys(keys.distinct(), keys_path)
    return added


def refresh_maps(spark: SparkSession, lake: Lake, at: Column | None = None) -> dict[str, int]:
    """Silver and quarantined maps anew from Bronze."""
    maps = refine_maps(read_or_empty(spark, lake.bronze_maps, BRONZE_MAP), at)
    return {
        "valid_maps": overwrite(accepted_maps(maps), lake.silver_maps),
        "quarantined_maps": overwrite(split(maps)[1], lake.quarantined_maps),
    }


def run_silver(
    spark: SparkSession, lake: Lake, dates: Sequence | None = None, at: Column | None = None
) -> dict[str, int]:
    """One incremental pass over all of Bronze, or some days of it; returns the rows written.

    ``streaming.refine.refine_new_files`` does the same from the new files of
    Bronze alone. Bad events are written first. Should the job die in between,
    the next run still finds the good ones, whose ids Silver does not hold yet.
    """
    accepted, rejected = new_events(spark, lake, dates, at)
    outdate(spark, lake.quarantine_keys)
    outdate(spark, lake.silver_keys)
    return {
        "quarantined_events": append_partitioned(rejected, lake.quarantined_events, "event_date"),
        "valid_events": append_partitioned(accepted, lake.silver_events, "event_date"),
        **refresh_maps(spark, lake, at),
    }


def write_enriched(spark: SparkSession, lake: Lake, dates: Sequence | None = None) -> None:
    """Refresh the enriched events: all of them, or only the given days.

    Days suffice while no map changed its name. The statistics do not wait for
    this table; they need no map name on events.
    """
    events = read_or_empty(spark, lake.silver_events, SILVER_EVENT)
    maps = read_or_empty(spark, lake.silver_maps, SILVER_MAP)
    if dates is not None:
        events = in_dates(events, dates)
    enriched = with_map_names(events, maps)
    overwrite_partitions(
        enriched, lake.enriched_events, "event_date", only_present=dates is not None
    )


def read_enriched(spark: SparkSession, lake: Lake) -> DataFrame:
    """The enriched events in their declared column order."""
    settle(spark, lake.enriched_events)
    return spark.read.schema(ENRICHED_EVENT).parquet(lake.enriched_events).select(
        "map_id", *[name for name in SILVER_EVENT.fieldNames() if name != "map_id"], "map_name"
    )

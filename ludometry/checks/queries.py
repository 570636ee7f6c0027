"""Every operator and job as a query over the driver's tables.

Dates are shown as text and instants as epoch seconds, so that results compare
across engines whatever their time zones.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludometry.checks.fixtures import (
    event_lines,
    game_events,
    game_maps,
    map_lines,
    profile_lines,
    top_level_map_lines,
)
from ludometry.operators import checks, enrich, matches, profile, quality, sessions, stats
from ludometry.operators.mart import player_stats
from ludometry.operators.normalize import with_event_time
from ludometry.plans import bronze, carried, flat, gold, ledger, silver
from ludometry.plans.lake import Lake
from ludometry.plans.views import register_views
from ludometry.schemas import (
    BRONZE_EVENT,
    BRONZE_MAP,
    CORRUPT,
    MATCH,
    SILVER_EVENT,
    SILVER_MAP,
)
from ludometry.session import scratch_path
from ludometry.sinks.versions import read_current
from ludometry.sources.jsonlines import read_events, read_lines
from ludometry.sources.tables import read_or_empty, stage_events, stage_maps
from ludometry.streaming.ingest import ingest_new_files
from ludometry.streaming.refine import run_silver_of_new_files

Query = Callable[[SparkSession, str], DataFrame]

# Second of the cut between a first and a second delivery: 2024-01-20.
CUT = 1_705_708_800

# The week before 2024-01-15, whose events come with the second delivery.
LATE_FROM, LATE_TO = 1_704_672_000, 1_705_276_800

# Low enough that the busiest players take the sliced plan at every scale: rows
# of all their events, and of those that make up matches.
CROWDED_EVENTS = 80
CROWDED_PLAYS = 44


@dataclass(frozen=True)
class _Delivery:
    """A fresh lake whose raw files Spark derives from the given tables."""

    spark: SparkSession
    sf_dir: str
    lake: Lake

    @classmethod
    def start(cls, spark: SparkSession, sf_dir: str) -> _Delivery:
        return cls(spark, sf_dir, Lake(scratch_path(spark, "lake")))

    def deliver(self, name: str = "all", before: int | None = None) -> str:
        """Write the raw event lines, or those before a second; returns the path."""
        lines = event_lines(self.spark, self.sf_dir)
        if before is not None:
            lines = lines.filter(F.col("_at") < before)
        path = f"{self.lake.root}/raw/events/{name}"
        lines.select("value").write.text(path)
        return path

    def deliver_maps(self) -> str:
        map_lines(self.spark, self.sf_dir).write.text(self.lake.raw_maps)
        return self.lake.raw_maps

    def ingest(self, path: str) -> int:
        return bronze.append_new_events(self.spark, read_events(self.spark, path), self.lake)

    def bronze(self) -> DataFrame:
        return read_or_empty(self.spark, self.lake.bronze_events, BRONZE_EVENT)


def _show_date(rows: DataFrame, column: str) -> DataFrame:
    return rows.withColumn(column, F.col(column).cast("string"))


def _show_bronze(rows: DataFrame) -> DataFrame:
    return rows.select(
        "id",
        "timestamp",
        "event_type",
        "user_id",
        "event_data.country",
        "event_data.device_os",
        "event_data.username",
        "event_data.state",
        "event_data.map_id",
        "event_data.opponent_id",
        "event_data.outcome",
        F.col(CORRUPT).isNotNull().cast("int").alias("malformed"),
        F.unix_seconds("event_timestamp").alias("event_second"),
        F.col("event_date").cast("string").alias("event_date"),
    )


def _show_silver(rows: DataFrame) -> DataFrame:
    return rows.select(
        "event_id",
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
        "validation_error",
        F.col("is_valid").cast("int").alias("is_valid"),
        F.unix_seconds("event_timestamp").alias("event_second"),
        F.col("event_date").cast("string").alias("event_date"),
    )


def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    delivery = _Delivery.start(spark, sf_dir)
    delivery.ingest(delivery.deliver())
    return _show_bronze(delivery.bronze())


def bronze_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first delivery, then everything, then everything again."""
    delivery = _Delivery.start(spark, sf_dir)
    delivery.ingest(delivery.deliver("first", before=CUT))
    everything = delivery.deliver()
    delivery.ingest(everything)
    delivery.ingest(everything)
    return _show_bronze(delivery.bronze())


def bronze_incremental_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first delivery, then everything day by day, each day and the undated rows twice."""
    delivery = _Delivery.start(spark, sf_dir)
    delivery.ingest(delivery.deliver("first", before=CUT))
    batch = read_events(spark, delivery.deliver())
    days = [row.day for row in with_event_time(batch).select(F.col("event_date").alias("day")).distinct().collect()]
    first, rest = days[: len(days) // 2], days[len(days) // 2 :]  # a calendar, not data
    for chosen in (first, first, rest, [None], days[:1]):
        bronze.append_new_events(spark, batch, delivery.lake, chosen)
    return _show_bronze(delivery.bronze())


def bronze_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files picked up as they arrive; the second call sees only new ones."""
    delivery = _Delivery.start(spark, sf_dir)
    progress = scratch_path(spark, "progress")
    folder = f"{delivery.lake.root}/raw/events/*"
    delivery.deliver("first", before=CUT)
    ingest_new_files(spark, folder, delivery.lake, progress)
    delivery.deliver("all")
    ingest_new_files(spark, folder, delivery.lake, progress)
    return _show_bronze(delivery.bronze())


def _refined(spark: SparkSession, sf_dir: str) -> DataFrame:
    delivery = _Delivery.start(spark, sf_dir)
    delivery.ingest(delivery.deliver())
    return silver.refine_events(delivery.bronze())


def silver_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show_silver(silver.accepted_events(_refined(spark, sf_dir)))


def silver_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show_silver(quality.split(_refined(spark, sf_dir))[1])


def silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two Bronze deliveries with Silver after each, and once more at the end."""
    return _silver_twice(spark, sf_dir, run_silver_of_new_files)


def silver_incremental_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by comparing all ids of Bronze with those that are done."""
    return _silver_twice(spark, sf_dir, silver.run_silver)


def _silver_twice(
    spark: SparkSession, sf_dir: str, refine: Callable[[SparkSession, Lake], dict[str, int]]
) -> DataFrame:
    delivery = _Delivery.start(spark, sf_dir)
    delivery.ingest(delivery.deliver("first", before=CUT))
    refine(spark, delivery.lake)
    delivery.ingest(delivery.deliver())
    refine(spark, delivery.lake)
    refine(spark, delivery.lake)
    good = read_or_empty(spark, delivery.lake.silver_events, SILVER_EVENT)
    bad = read_or_empty(spark, delivery.lake.quarantined_events, SILVER_EVENT)
    return _show_silver(good.unionByName(bad))


def maps_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    delivery = _Delivery.start(spark, sf_dir)
    bronze.refresh_maps(spark, delivery.deliver_maps(), delivery.lake)
    refined = silver.refine_maps(read_or_empty(spark, delivery.lake.bronze_maps, BRONZE_MAP))
    accepted = silver.accepted_maps(refined)
    return accepted.unionByName(quality.split(refined)[1]).select(
        "map_id", "map_name", "validation_error", F.col("is_valid").cast("int").alias("is_valid")
    )


def _flat(spark: SparkSession, sf_dir: str, times: int = 1) -> tuple[Lake, DataFrame]:
    lake = Lake(scratch_path(spark, "flat"))
    raw = f"{lake.root}/raw"
    profile_lines(spark, sf_dir).select("value").write.text(raw)
    for _ in range(times):
        table = flat.load_flat(spark, raw, f"{lake.root}/bronze")
    return lake, table


def flat_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat table after loading its file once."""
    return _flat(spark, sf_dir)[1]


def flat_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rebuilt clean table; loading twice changes nothing."""
    lake, table = _flat(spark, sf_dir, times=2)
    return flat.rebuild_clean_flat(table, f"{lake.root}/silver")


def profile_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile events with all required fields, uncleaned."""
    raw = scratch_path(spark, "profiles")
    profile_lines(spark, sf_dir).select("value").write.text(raw)
    return flat.scan_profiles(spark, raw)


def top_level_map_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the early shape, cleaned and validated, good and bad."""
    folder = scratch_path(spark, "early")
    raw = f"{folder}/raw"
    top_level_map_lines(spark, sf_dir).select("value").write.text(raw)
    stored = flat.load_top_level_maps(spark, raw, f"{folder}/bronze")
    return flat.refine_top_level_maps(stored).select(
        "event_id",
        "timestamp",
        "event_type",
        "user_id",
        "map_id",
        "country",
        "device_os",
        "username",
        "validation_error",
        F.col("is_valid").cast("int").alias("is_valid"),
        F.unix_seconds("event_timestamp").alias("event_second"),
    )


def events_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = game_events(spark, sf_dir).drop("event_timestamp")
    return enrich.with_map_names(events, game_maps(spark, sf_dir))


def events_enriched_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched table after a full refresh and a refresh of new days only."""
    delivery = _Delivery.start(spark, sf_dir)
    bronze.refresh_maps(spark, delivery.deliver_maps(), delivery.lake)
    delivery.ingest(delivery.deliver("first", before=CUT))
    silver.run_silver(spark, delivery.lake)
    silver.write_enriched(spark, delivery.lake)
    delivery.ingest(delivery.deliver())
    silver.run_silver(spark, delivery.lake)
    events = read_or_empty(spark, delivery.lake.silver_events, SILVER_EVENT)
    late = events.filter(F.col("timestamp") >= CUT).select("event_date").distinct()
    days = [row.event_date for row in late.collect()]  # a calendar, not data
    silver.write_enriched(spark, delivery.lake, days)
    return silver.read_enriched(spark, delivery.lake).select(
        "map_id", "event_id", "timestamp", "event_type", "user_id", "map_name"
    )


def unknown_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.unknown_maps(game_events(spark, sf_dir), game_maps(spark, sf_dir))


def map_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.map_names(game_maps(spark, sf_dir))


def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.event_sessions(game_events(spark, sf_dir)).drop("event_timestamp")


def event_sessions_crowded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same numbers with busy players cut into slices."""
    events = game_events(spark, sf_dir)
    return sessions.event_sessions(events, hot_rows=CROWDED_EVENTS).drop("event_timestamp")


def match_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches.match_starts(game_events(spark, sf_dir))


def match_finishes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches.match_finishes(game_events(spark, sf_dir))


def completed_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches.matches(game_events(spark, sf_dir))


def completed_matches_crowded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same matches with busy players cut into slices."""
    return matches.matches(game_events(spark, sf_dir), hot_rows=CROWDED_PLAYS)


def _first_delivery(events: DataFrame) -> DataFrame:
    """Events before the cut, less those of the week that is delivered late."""
    late = F.col("timestamp").between(LATE_FROM, LATE_TO - 1)
    return events.filter((F.col("timestamp") < CUT) & ~late)


def matches_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The match table after a first delivery and a watermark update.

    Finishes of the late week lie before the watermark and are not added.
    """
    events = game_events(spark, sf_dir)
    table = scratch_path(spark, "matches")
    gold.update_matches(_first_delivery(events), table)
    return gold.update_matches(events, table, mode="watermark")


def matches_followed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from the events of the second delivery alone, on the counters carried from the first."""
    events = game_events(spark, sf_dir)
    lake = Lake(scratch_path(spark, "lake"))
    first = _first_delivery(events)
    carried.apply_batch(spark, lake, first, 0, lambda: first)
    second = events.join(first.select("event_id"), "event_id", "left_anti").select(events.columns)
    carried.apply_batch(spark, lake, second, 1, lambda: events)
    return read_current(spark, lake.matches, MATCH)


def matches_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The match table after a first delivery and a full rebuild."""
    events = game_events(spark, sf_dir)
    table = scratch_path(spark, "matches")
    gold.update_matches(_first_delivery(events), table)
    return gold.update_matches(events, table, mode="full")


def matches_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key-wise replacement: matches of the first delivery, one map's played anew.

    Matches of the other maps stay as they were stored.
    """
    events = game_events(spark, sf_dir)
    table = scratch_path(spark, "matches")
    gold.update_matches(_first_delivery(events), table)
    one_map = matches.matches(events).filter(F.col("map_id") == "3")
    return gold.merge_matches(one_map, table)


def registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show_date(stats.registrations(game_events(spark, sf_dir)), "registration_date")


def registrations_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show_date(stats.registrations_first(game_events(spark, sf_dir)), "registration_date")


def user_map_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.user_map_stats(completed_matches(spark, sf_dir))


def user_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.user_totals(completed_matches(spark, sf_dir))


def favorite_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.favorite_maps(user_map_stats(spark, sf_dir), game_maps(spark, sf_dir))


def player_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.player_rollup(completed_matches(spark, sf_dir), game_maps(spark, sf_dir))


def mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, maps = game_events(spark, sf_dir), game_maps(spark, sf_dir)
    return _show_date(player_stats(events, maps), "registration_date")


def lake_player_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw damaged lines through Bronze, Silver and Gold tables to the mart."""
    delivery = _Delivery.start(spark, sf_dir)
    bronze.run_bronze(spark, delivery.lake, delivery.deliver(), delivery.deliver_maps())
    silver.run_silver(spark, delivery.lake)
    return _show_date(gold.run_gold(spark, delivery.lake), "registration_date")


def lake_player_stats_followed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart after two deliveries, each layer of which read only what the one before it gained."""
    delivery = _Delivery.start(spark, sf_dir)
    inbox, progress = f"{delivery.lake.root}/raw/events/*", scratch_path(spark, "progress")
    bronze.refresh_maps(spark, delivery.deliver_maps(), delivery.lake)
    for name, before in (("first", CUT), ("all", None)):
        delivery.deliver(name, before)
        ingest_new_files(spark, inbox, delivery.lake, progress)
        run_silver_of_new_files(spark, delivery.lake)
        mart = carried.run_gold_of_new_files(spark, delivery.lake)
    return _show_date(mart, "registration_date")


def mart_by_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's own SQL over the registered views of a finished lake."""
    delivery = _Delivery.start(spark, sf_dir)
    bronze.run_bronze(spark, delivery.lake, delivery.deliver(), delivery.deliver_maps())
    silver.run_silver(spark, delivery.lake)
    gold.run_gold(spark, delivery.lake)
    register_views(
        spark, delivery.lake, names=["mart_player_stats", "int_user_totals", "int_match_starts"]
    )
    return spark.sql(
        """
        SELECT m.user_id, m.fav_map, m.total_playtime, t.total_sessions, count(*) AS starts,
               max(s.session_number) AS last_session
        FROM mart_player_stats m
        JOIN int_user_totals t ON m.user_id = t.user_id
        JOIN int_match_starts s ON m.user_id = s.user_id
        GROUP BY ALL
        """
    )


def freq_event_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.frequency(game_events(spark, sf_dir), "event_type")


def freq_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.frequency(game_events(spark, sf_dir), "country")


def freq_device_os(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.frequency(game_events(spark, sf_dir), "device_os")


def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_values(
        game_events(spark, sf_dir), ["username", "country", "device_os"]
    )


def first_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty earliest events, the look at the data that the report prints."""
    events = game_events(spark, sf_dir).drop("event_timestamp")
    return profile.first_rows(events, 20, ["timestamp", "event_id"])


def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    delivery = _Delivery.start(spark, sf_dir)
    raw, maps = delivery.deliver(), delivery.deliver_maps()
    bronze.run_bronze(spark, delivery.lake, raw, maps)
    silver.run_silver(spark, delivery.lake)
    lake = delivery.lake
    return profile.row_counts(
        {
            "raw_events": read_lines(spark, raw),
            "bronze_events": delivery.bronze(),
            "silver_events": read_or_empty(spark, lake.silver_events, SILVER_EVENT),
            "quarantined_events": read_or_empty(spark, lake.quarantined_events, SILVER_EVENT),
            "silver_maps": read_or_empty(spark, lake.silver_maps, SILVER_MAP),
            "quarantined_maps": read_or_empty(spark, lake.quarantined_maps, SILVER_MAP),
        }
    )


def layer_counts_noted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of every layer as two deliveries' jobs noted them, no layer counted again."""
    delivery = _Delivery.start(spark, sf_dir)
    lake, maps = delivery.lake, delivery.deliver_maps()
    for raw in (delivery.deliver("first", before=CUT), delivery.deliver()):
        ledger.record(spark, lake, "bronze", bronze.run_bronze(spark, lake, raw, maps))
        ledger.record(spark, lake, "silver", run_silver_of_new_files(spark, lake))
    return ledger.layer_totals(spark, lake)


def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, maps = game_events(spark, sf_dir), game_maps(spark, sf_dir)
    return quality.mart_checks(player_stats(events, maps)).withColumn(
        "passed", F.col("passed").cast("int")
    )


def _damaged_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart with null, repeated, out-of-range and negative rows."""
    mart = player_stats(game_events(spark, sf_dir), game_maps(spark, sf_dir))
    idle = F.col("total_playtime").isNull()
    countryless = F.col("country").isNull()
    return mart.unionByName(mart.filter(countryless)).withColumns(
        {
            "user_id": F.when(~idle | countryless, F.col("user_id")),
            "username": F.when(~idle | (F.col("country") > "NATION_2"), F.col("username")),
            "registration_date": F.when(
                F.col("registration_date") >= "2024-01-05", F.col("registration_date")
            ),
            "fav_map_win_ratio": F.col("fav_map_win_ratio") * 1.5,
            "total_win_ratio": F.col("total_win_ratio") - 0.25,
            "total_playtime": F.when(
                countryless, F.col("total_playtime") - 1_000_000
            ).otherwise(F.col("total_playtime")),
        }
    )


def _shown(counts: DataFrame) -> DataFrame:
    return counts.withColumn("passed", F.col("passed").cast("int"))


def quality_checks_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks on a damaged mart."""
    return _shown(quality.mart_checks(_damaged_mart(spark, sf_dir)))


def quality_violations_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a damaged mart that break a check, and which they break."""
    found = checks.violating(_damaged_mart(spark, sf_dir), checks.MART_CHECKS)
    return found.select(
        "user_id", "username", F.col("registration_date").cast("string").alias("registration_date"),
        "total_playtime", F.array_join("broken", ",").alias("broken"),
    )


def quality_checks_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of another table: matches with repeated keys, null maps, odd outcomes and negative durations."""
    played = completed_matches(spark, sf_dir)
    damaged = played.unionByName(played.filter("map_id = '2'")).withColumns(
        {
            "map_id": F.when(F.col("duration") % 5 != 0, F.col("map_id")),
            "duration": F.col("duration") - 3_600,
            "is_win": F.col("is_win") + F.when(F.col("opponent_id") == "1", 1).otherwise(0),
            "outcome": F.when(F.col("match_number") > 1, F.col("outcome") * 2),
        }
    )
    return _shown(checks.violations(damaged, checks.MATCH_CHECKS))


def staged_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged events with the staged name of their map, read from Silver."""
    delivery = _Delivery.start(spark, sf_dir)
    bronze.run_bronze(spark, delivery.lake, delivery.deliver(), delivery.deliver_maps())
    silver.run_silver(spark, delivery.lake)
    events = stage_events(read_or_empty(spark, delivery.lake.silver_events, SILVER_EVENT))
    maps = stage_maps(read_or_empty(spark, delivery.lake.silver_maps, SILVER_MAP))
    return enrich.with_map_names(events.drop("event_timestamp"), maps)


def raw_field_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = scratch_path(spark, "lines")
    event_lines(spark, sf_dir).select("value").write.text(raw)
    return profile.raw_field_profile(read_lines(spark, raw))


def raw_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schema that covers all lines, as text."""
    raw = scratch_path(spark, "lines")
    event_lines(spark, sf_dir).select("value").write.text(raw)
    return profile.merged_raw_schema(read_lines(spark, raw))


def table_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schemas of some tables as rows."""
    described = [
        profile.schema_profile(spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        .withColumn("table_name", F.lit(name))
        .withColumn("nullable", F.col("nullable").cast("int"))
        .withColumn("position", F.col("position").cast("long"))
        for name in ("events", "customer", "orders", "lineitem")
    ]
    out = described[0]
    for rows in described[1:]:
        out = out.unionByName(rows)
    return out


QUERIES: dict[str, Query] = {
    "bronze_ingest": bronze_ingest,
    "bronze_incremental": bronze_incremental,
    "bronze_incremental_by_date": bronze_incremental_by_date,
    "bronze_new_files": bronze_new_files,
    "table_schemas": table_schemas,
    "flat_load": flat_load,
    "flat_clean": flat_clean,
    "profile_scan": profile_scan,
    "top_level_map_validate": top_level_map_validate,
    "silver_validate": silver_validate,
    "silver_quarantine": silver_quarantine,
    "silver_incremental": silver_incremental,
    "silver_incremental_by_id": silver_incremental_by_id,
    "maps_validate": maps_validate,
    "staged_tables": staged_tables,
    "events_enriched": events_enriched,
    "events_enriched_by_date": events_enriched_by_date,
    "unknown_maps": unknown_maps,
    "map_names": map_names,
    "event_sessions": event_sessions,
    "event_sessions_crowded": event_sessions_crowded,
    "match_starts": match_starts,
    "match_finishes": match_finishes,
    "matches": completed_matches,
    "matches_crowded": completed_matches_crowded,
    "matches_incremental": matches_incremental,
    "matches_followed": matches_followed,
    "matches_rebuilt": matches_rebuilt,
    "matches_upsert": matches_upsert,
    "registrations": registrations,
    "registrations_first": registrations_first,
    "user_map_stats": user_map_stats,
    "user_totals": user_totals,
    "favorite_maps": favorite_maps,
    "player_rollup": player_rollup,
    "player_stats": mart,
    "lake_player_stats": lake_player_stats,
    "lake_player_stats_followed": lake_player_stats_followed,
    "mart_by_sql": mart_by_sql,
    "freq_event_type": freq_event_type,
    "freq_country": freq_country,
    "freq_device_os": freq_device_os,
    "distinct_values": distinct_values,
    "first_events": first_events,
    "layer_counts": layer_counts,
    "layer_counts_noted": layer_counts_noted,
    "quality_checks": quality_checks,
    "quality_checks_damaged": quality_checks_damaged,
    "quality_violations_damaged": quality_violations_damaged,
    "quality_checks_matches": quality_checks_matches,
    "raw_field_profile": raw_field_profile,
    "raw_schema": raw_schema,
}

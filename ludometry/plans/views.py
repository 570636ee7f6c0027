"""The tables and views of a lake under their SQL names."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ludometry.operators.matches import match_finishes, match_starts
from ludometry.operators.running import HOT_ROWS
from ludometry.operators.sessions import event_sessions
from ludometry.plans.gold import crowded_players
from ludometry.plans.lake import Lake
from ludometry.plans.silver import read_enriched
from ludometry.schemas import (
    BRONZE_EVENT,
    BRONZE_MAP,
    MATCH,
    PLAYER_STATS,
    SILVER_EVENT,
    SILVER_MAP,
    USER_MAP_STATS,
    USER_TOTALS,
)
from ludometry.sinks.versions import read_current
from ludometry.sources.tables import read_or_empty, stage_events, stage_maps, stored_path


def lake_tables(
    spark: SparkSession, lake: Lake, hot_rows: int = HOT_ROWS
) -> dict[str, Callable[[], DataFrame]]:
    """Everything in the lake by name, each made when it is called for.

    Making a stored table reads no row. The numbered views take the crowded players
    that Gold noted; before that they count the events of each player, to choose
    their plan. The plan for crowded players pins its slices in a job. Statistics
    tables are listed once Gold has written them.
    """
    silver_events = read_or_empty(spark, lake.silver_events, SILVER_EVENT)
    silver_maps = read_or_empty(spark, lake.silver_maps, SILVER_MAP)
    events = stage_events(silver_events)
    hot = crowded_players(spark, lake, hot_rows)
    tables: dict[str, Callable[[], DataFrame]] = {
        "bronze_events": lambda: read_or_empty(spark, lake.bronze_events, BRONZE_EVENT),
        "bronze_maps": lambda: read_or_empty(spark, lake.bronze_maps, BRONZE_MAP),
        "silver_events": lambda: silver_events,
        "silver_maps": lambda: silver_maps,
        "quarantine_events": lambda: read_or_empty(spark, lake.quarantined_events, SILVER_EVENT),
        "quarantine_maps": lambda: read_or_empty(spark, lake.quarantined_maps, SILVER_MAP),
        "stg_events": lambda: events,
        "stg_maps": lambda: stage_maps(silver_maps),
        "int_events_sessions": lambda: event_sessions(events, hot_rows, hot),
        "int_match_starts": lambda: match_starts(events, hot_rows, hot),
        "int_match_finishes": lambda: match_finishes(events, hot_rows, hot),
    }
    matches = read_current(spark, lake.matches, MATCH)
    if matches is not None:
        tables["int_matches"] = lambda: matches
    if stored_path(spark, lake.enriched_events) is not None:
        tables["events_enriched"] = lambda: read_enriched(spark, lake)
    # With their declared schemas, as reading them from the files would be a job.
    for name, path, schema in (
        ("int_user_map_stats", lake.user_map_stats, USER_MAP_STATS),
        ("int_user_totals", lake.user_totals, USER_TOTALS),
        ("mart_player_stats", lake.player_stats, PLAYER_STATS),
    ):
        if stored_path(spark, path) is not None:
            tables[name] = partial(spark.read.schema(schema).parquet, path)
    return tables


def register_views(
    spark: SparkSession,
    lake: Lake,
    hot_rows: int = HOT_ROWS,
    names: Sequence[str] | None = None,
) -> list[str]:
    """Make the lake's tables temporary views for ``spark.sql``; returns their names.

    ``names`` chooses some. After Gold has run, and while no player is crowded,
    registration runs no job at all.
    """
    tables = lake_tables(spark, lake, hot_rows)
    chosen = list(tables) if names is None else list(names)
    for name in chosen:
        tables[name]().createOrReplaceTempView(name)
    return chosen

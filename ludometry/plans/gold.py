"""Silver to the match table, the statistics and the player mart."""

from __future__ import annotations

import json
from collections.abc import Callable
from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludometry.operators.increment import BROADCAST_KEYS, fits, upsert, watermark
from ludometry.operators.mart import mart_rows, most_played_first
from ludometry.operators.matches import matches
from ludometry.operators.running import HOT_ROWS, hot_keys
from ludometry.operators.sessions import MATCH_FINISH
from ludometry.operators.stats import favorite_maps, registrations
from ludometry.plans import sums
from ludometry.plans.lake import Lake
from ludometry.schemas import MATCH, MATCH_KEY, SILVER_EVENT, SILVER_MAP
from ludometry.sinks.tables import landed, overwrite
from ludometry.sinks.versions import (
    bucket_count,
    bucket_name,
    change_count,
    extend,
    prune,
    publish,
    read_current,
    replace_buckets,
)
from ludometry.sources.tables import read_or_empty, read_text, stage_events, stage_maps, write_text


def match_delta(events: DataFrame, stored: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Matches that finish after the last stored one.

    Ordinals count over the whole history of a player, but only players with a
    finish beyond the watermark can add a match. While those are few enough to
    send around, only their history is shuffled.
    """
    last = watermark(stored, "finish_timestamp").first().watermark
    active = (
        events.filter((F.col("event_type") == MATCH_FINISH) & (F.col("timestamp") > last))
        .select("user_id")
        .distinct()
    )
    history = events
    if fits(active, "user_id", BROADCAST_KEYS):
        history = events.join(F.broadcast(active), "user_id", "left_semi")
    return matches(history, hot_rows).filter(F.col("finish_timestamp") > last)


# Changes of a match table after which a watermark update writes it anew as one version.
MOST_CHANGES = 64


def update_matches(
    events: DataFrame,
    path: str,
    mode: str = "full",
    hot_rows: int = HOT_ROWS,
    buckets: int | None = None,
    changed: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """Bring the match table up to date and return it.

    ``full`` rebuilds it. ``watermark`` adds what finished after the last
    stored match and replaces rows of equal key; a finish that comes late, at
    or before the watermark, is not added until the next full rebuild.

    The table lies in buckets of its players, by default as many as the session
    has shuffle partitions when it is rebuilt. An update, but no rebuild, tells
    ``changed`` the matches that came (``sign`` 1) and those they replaced (-1).
    """
    if mode not in ("full", "watermark"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = events.sparkSession
    stored = read_current(spark, path, MATCH)
    if mode == "full" or stored is None:
        _publish_matches(matches(events, hot_rows), path, buckets)
    else:
        _merge(match_delta(events, stored, hot_rows), stored, path, changed)
    return read_current(spark, path, MATCH)


def merge_matches(delta: DataFrame, path: str) -> DataFrame:
    """Add matches to a stored table, replacing rows of equal key, and return it."""
    spark = delta.sparkSession
    _merge(delta, read_current(spark, path, MATCH), path)
    return read_current(spark, path, MATCH)


def _publish_matches(rows: DataFrame, path: str, buckets: int | None = None) -> None:
    spark = rows.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    publish(rows, path, by="user_id", count=count)
    prune(spark, path)


def _merge(
    delta: DataFrame, stored: DataFrame, path: str, changed: Callable[[DataFrame], None] | None = None
) -> None:
    """Add a delta to the match table, replacing rows of equal key.

    Only the buckets that the delta lies in are looked into. Of those the ones
    with rows to replace are written anew, and the rest of the delta is added beside them.
    """
    spark = delta.sparkSession
    with ExitStack() as scratch:
        rows = scratch.enter_context(landed(delta, "match-delta"))
        count = bucket_count(spark, path)
        near, bucket = stored, None
        if count:  # neither an empty table nor one of an older layout
            bucket = bucket_name("user_id", count)
            touched = [row.bucket for row in rows.select(bucket.alias("bucket")).distinct().collect()]  # buckets, not data
            near = read_current(spark, path, MATCH, touched)
        gone = scratch.enter_context(landed(near.join(rows.select(*MATCH_KEY), MATCH_KEY, "left_semi"), "match-gone"))
        if count is None:
            _publish_matches(upsert(stored, rows, MATCH_KEY), path)
        elif gone.isEmpty():
            extend(rows, path, by="user_id")
        else:
            collided = [row.bucket for row in gone.select(bucket.alias("bucket")).distinct().collect()]
            again = bucket.isin(collided)
            old = read_current(spark, path, MATCH, collided)
            replace_buckets(upsert(old, rows.filter(again), MATCH_KEY), rows.filter(~again), path, by="user_id")
        if changed is not None:
            changed(rows.withColumn("sign", F.lit(1)).unionByName(gone.withColumn("sign", F.lit(-1))))
    if change_count(spark, path) >= MOST_CHANGES:
        _publish_matches(read_current(spark, path, MATCH), path, count)


def run_gold(
    spark: SparkSession, lake: Lake, mode: str = "full", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Bring the match table up to date, write every statistics table and return the mart.

    In ``watermark`` mode the statistics follow the update of the match table by
    sums and do not read it, see ``plans.sums``.
    """
    events = stage_events(read_or_empty(spark, lake.silver_events, SILVER_EVENT))
    note_crowded_players(spark, lake, events, hot_rows)

    def update(changed: Callable[[DataFrame], None] | None) -> DataFrame:
        return update_matches(events, lake.matches, mode, hot_rows, changed=changed)

    return write_statistics(spark, lake, update, rebuilt=mode == "full")


def note_crowded_players(spark: SparkSession, lake: Lake, events: DataFrame, hot_rows: int) -> None:
    """Note the players with over ``hot_rows`` events, so that views need not count them.

    They are at most events / ``hot_rows``; they choose plans and not results, so the
    note may be older than the events.
    """
    found = hot_keys(events, ["user_id"], hot_rows)
    write_text(spark, lake.crowded_players, json.dumps({"hot_rows": hot_rows, "players": found}))


def crowded_players(spark: SparkSession, lake: Lake, hot_rows: int) -> list[tuple] | None:
    """The players noted, without a job; None if none were noted for this ``hot_rows``."""
    text = read_text(spark, lake.crowded_players)
    noted = json.loads(text) if text else {}
    return [tuple(own) for own in noted["players"]] if noted.get("hot_rows") == hot_rows else None


def write_statistics(
    spark: SparkSession,
    lake: Lake,
    update: Callable[[Callable[[DataFrame], None] | None], DataFrame],
    rebuilt: bool = False,
) -> DataFrame:
    """Write the statistics of the matches that ``update`` returns, and return the mart.

    ``update`` takes what is to be told of changed matches, null if the sums are
    made anew in any case.
    """
    follow = not rebuilt and sums.are_current(spark, lake)
    played = update((lambda signed: sums.add(lake, signed)) if follow else None)
    if follow:
        sums.note_state(spark, lake)
    else:
        sums.rebuild(spark, lake, played)
    overwrite(sums.user_map_stats(spark, lake), lake.user_map_stats)
    overwrite(sums.user_totals(spark, lake), lake.user_totals)
    events = stage_events(read_or_empty(spark, lake.silver_events, SILVER_EVENT))
    maps = stage_maps(read_or_empty(spark, lake.silver_maps, SILVER_MAP))
    favorites = favorite_maps(spark.read.parquet(lake.user_map_stats), maps)
    totals = spark.read.parquet(lake.user_totals)
    overwrite(mart_rows(registrations(events), totals, favorites), lake.player_stats)
    return most_played_first(spark.read.parquet(lake.player_stats))

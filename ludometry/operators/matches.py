"""Matches: the n-th start of a (player, map, opponent) with its n-th finish."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludometry.operators.running import HOT_ROWS, RunningTotal, per_key
from ludometry.operators.sessions import (
    EVENT_ORDER,
    MATCH_FINISH,
    MATCH_START,
    opens_session,
)
from ludometry.schemas import MATCH, MATCH_KEY

GROUP = ["user_id", "map_id", "opponent_id"]


def _with_session(rows: DataFrame, total: RunningTotal) -> DataFrame:
    return total(rows, ["user_id"], EVENT_ORDER, F.col("new_session"), "session_number")


def _with_ordinal(rows: DataFrame, keys: list[str], total: RunningTotal) -> DataFrame:
    return total(rows, keys, EVENT_ORDER, F.lit(1), "match_number")


def match_starts(
    events: DataFrame, hot_rows: int = HOT_ROWS, hot: list[tuple] | None = None
) -> DataFrame:
    """Starts with session number and ordinal.

    Only session openings move the session number, so the window needs those
    and the starts themselves; all other events are filtered out at the scan.
    """
    is_start = F.col("event_type") == MATCH_START
    needed = (
        events.withColumn("new_session", opens_session())
        .filter(is_start | (F.col("new_session") == 1))
        .select(*GROUP, *EVENT_ORDER, "event_type", "new_session")
    )

    def number(rows: DataFrame, total: RunningTotal) -> DataFrame:
        return _with_ordinal(_with_session(rows, total).filter(is_start), GROUP, total)

    return per_key(needed, ["user_id"], number, hot_rows, hot).select(
        *GROUP, "session_number", F.col("timestamp").alias("start_timestamp"), "match_number"
    )


def match_finishes(
    events: DataFrame, hot_rows: int = HOT_ROWS, hot: list[tuple] | None = None
) -> DataFrame:
    """Finishes with outcome and ordinal."""
    needed = events.filter(F.col("event_type") == MATCH_FINISH).select(
        *GROUP, *EVENT_ORDER, "outcome"
    )
    return per_key(
        needed, ["user_id"], lambda rows, total: _with_ordinal(rows, GROUP, total), hot_rows, hot
    ).select(*GROUP, "outcome", F.col("timestamp").alias("finish_timestamp"), "match_number")


def matches(events: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Completed matches.

    Starts and finishes travel together: one shuffle by player serves the
    session window, the ordinals and the pairing, which is a grouping on the
    ordinal instead of a join of two separately shuffled sides. A pair that
    would end before it starts is dropped, not paired anew.
    """
    is_start = F.col("event_type") == MATCH_START
    is_finish = F.col("event_type") == MATCH_FINISH
    needed = (
        events.withColumn("new_session", opens_session())
        .filter(is_start | is_finish | (F.col("new_session") == 1))
        .select(*GROUP, *EVENT_ORDER, "event_type", "outcome", "new_session")
    )

    def pair(rows: DataFrame, total: RunningTotal) -> DataFrame:
        sides = _with_session(rows, total).filter(
            (is_start | is_finish) & F.col("map_id").isNotNull() & F.col("opponent_id").isNotNull()
        )
        return (
            _with_ordinal(sides, [*GROUP, "event_type"], total)
            .groupBy(*MATCH_KEY)
            .agg(
                F.max(F.when(is_start, F.col("session_number"))).alias("session_number"),
                F.max(F.when(is_start, F.col("timestamp"))).alias("start_timestamp"),
                F.max(F.when(is_finish, F.col("timestamp"))).alias("finish_timestamp"),
                F.max(F.when(is_finish, F.col("outcome"))).alias("outcome"),
            )
        )

    duration = F.col("finish_timestamp") - F.col("start_timestamp")
    return (
        per_key(needed, ["user_id"], pair, hot_rows)
        .withColumn("duration", duration)
        .filter(F.col("duration") >= 0)
        .withColumn("is_win", F.when(F.col("outcome") == 1, 1).otherwise(0))
        .select(*MATCH.fieldNames())
    )

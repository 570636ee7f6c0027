"""Statistics that follow the match table without reading it again.

Two tables hold sums of the matches, per (player, map) and per (player, session). A
change of the match table adds sums of its own: of the rows it brought, and, with
the opposite sign, of those it replaced. Statistics add the sums up, which are far
fewer than the matches.

Which state of the match table the sums belong to is noted beside them, after they
are written. If a job dies in between, the note does not fit, and the sums are
made anew from the matches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ludometry.operators.stats import added_up, map_sums, session_sums, user_map_stats_of, user_totals_of
from ludometry.plans.lake import Lake
from ludometry.schemas import MAP_SUMS, SESSION_SUMS
from ludometry.sinks.versions import change_count, extend, prune, publish, read_current, state
from ludometry.sources.tables import discard, folder_names, touch

NOTE = "_of="
# Changes of the sums after which they are added up in one version.
MOST_CHANGES = 64

_MAP_KEYS, _SESSION_KEYS = ["user_id", "map_id"], ["user_id", "session_number"]


def _noted(spark: SparkSession, lake: Lake) -> list[str]:
    names = folder_names(spark, lake.session_sums) or []
    return [name[len(NOTE) :] for name in names if name.startswith(NOTE)]


def are_current(spark: SparkSession, lake: Lake) -> bool:
    """Whether the sums are those of the match table as it is."""
    now = state(spark, lake.matches)
    return now is not None and _noted(spark, lake) == [now]


def note_state(spark: SparkSession, lake: Lake) -> None:
    """Note that the sums are those of the match table as it is."""
    for name in _noted(spark, lake):
        discard(spark, f"{lake.session_sums}/{NOTE}{name}")
    touch(spark, f"{lake.session_sums}/{NOTE}{state(spark, lake.matches)}")


def rebuild(spark: SparkSession, lake: Lake, matches: DataFrame) -> None:
    """The sums of all matches, as new versions."""
    publish(map_sums(matches), lake.map_sums)
    publish(session_sums(matches), lake.session_sums)
    for path in (lake.map_sums, lake.session_sums):
        prune(spark, path)
    note_state(spark, lake)


def add(lake: Lake, signed: DataFrame) -> None:
    """Add the sums of matches with a ``sign``: 1 for those that came, -1 for those that went."""
    spark = signed.sparkSession
    extend(map_sums(signed, "sign"), lake.map_sums)
    extend(session_sums(signed, "sign"), lake.session_sums)
    if change_count(spark, lake.session_sums) >= MOST_CHANGES:
        publish(_map_sums(spark, lake), lake.map_sums)
        publish(_session_sums(spark, lake), lake.session_sums)
        for path in (lake.map_sums, lake.session_sums):
            prune(spark, path)


def _map_sums(spark: SparkSession, lake: Lake) -> DataFrame:
    return added_up(read_current(spark, lake.map_sums, MAP_SUMS), _MAP_KEYS, "map_matches")


def _session_sums(spark: SparkSession, lake: Lake) -> DataFrame:
    return added_up(read_current(spark, lake.session_sums, SESSION_SUMS), _SESSION_KEYS, "matches")


def user_map_stats(spark: SparkSession, lake: Lake) -> DataFrame:
    return user_map_stats_of(_map_sums(spark, lake))


def user_totals(spark: SparkSession, lake: Lake) -> DataFrame:
    return user_totals_of(_session_sums(spark, lake))

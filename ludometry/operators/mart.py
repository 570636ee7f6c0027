"""The player mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludometry.functions import round_half
from ludometry.operators.matches import matches
from ludometry.operators.running import HOT_ROWS
from ludometry.operators.stats import player_rollup, registrations


def country_status() -> Column:
    return F.when(F.col("country").isNull(), "missing_country").otherwise("valid")


def mart_columns(joined: DataFrame) -> DataFrame:
    """Final columns and rounding of the mart."""
    return joined.select(
        "user_id",
        "username",
        "country",
        "fav_map",
        round_half(F.col("fav_map_win_ratio"), 3).alias("fav_map_win_ratio"),
        "total_playtime",
        round_half(F.col("total_win_ratio"), 3).alias("total_win_ratio"),
        round_half(F.col("avg_matches_per_session"), 2).alias("avg_matches_per_session"),
        "registration_date",
        country_status().alias("data_quality_status"),
    )


def most_played_first(mart: DataFrame) -> DataFrame:
    """The order of the mart. A table keeps none, so it is asked for where the mart is read."""
    return mart.orderBy(F.desc_nulls_last("total_playtime"))


def mart_rows(registered: DataFrame, totals: DataFrame, favorites: DataFrame) -> DataFrame:
    """Registered players in no order, with statistics where they completed a match."""
    return mart_columns(
        registered.join(totals, "user_id", "left").join(favorites, "user_id", "left")
    )


def mart_player_stats(
    registered: DataFrame, totals: DataFrame, favorites: DataFrame
) -> DataFrame:
    """The same in the order of the mart."""
    return most_played_first(mart_rows(registered, totals, favorites))


def player_stats(events: DataFrame, maps: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The mart straight from staged events, with the matches computed once."""
    rollup = player_rollup(matches(events, hot_rows), maps)
    return most_played_first(mart_columns(registrations(events).join(rollup, "user_id", "left")))

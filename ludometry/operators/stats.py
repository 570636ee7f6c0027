"""Per-player and per-map statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ludometry.functions import epoch_date, ratio
from ludometry.operators.sessions import REGISTRATION


def registrations(events: DataFrame) -> DataFrame:
    """One profile per registered player: largest name and country, first day."""
    return (
        events.filter(F.col("event_type") == REGISTRATION)
        .groupBy("user_id")
        .agg(
            F.max("username").alias("username"),
            F.max("country").alias("country"),
            F.min("timestamp").alias("_first"),
        )
        .select("user_id", "username", "country", epoch_date("_first").alias("registration_date"))
    )


def registrations_first(events: DataFrame) -> DataFrame:
    """As :func:`registrations`, with the earliest non-null name and country."""

    def earliest(name: str) -> Column:
        seen = F.struct("timestamp", "event_id", name)
        return F.min(F.when(F.col(name).isNotNull(), seen))[name].alias(name)

    return (
        events.filter(F.col("event_type") == REGISTRATION)
        .groupBy("user_id")
        .agg(earliest("username"), earliest("country"), F.min("timestamp").alias("_first"))
        .select("user_id", "username", "country", epoch_date("_first").alias("registration_date"))
    )


def user_map_stats(matches: DataFrame) -> DataFrame:
    return (
        matches.groupBy("user_id", "map_id")
        .agg(F.count(F.lit(1)).alias("map_matches"), F.sum("is_win").alias("map_wins"))
        .withColumn("map_win_ratio", ratio(F.col("map_wins"), F.col("map_matches")))
    )


# Sums that add up over any parts of the matches; a part that goes counts with sign -1.


def map_sums(matches: DataFrame, sign: str = "1") -> DataFrame:
    """user_id, map_id, map_matches, map_wins."""
    weight = F.expr(sign)
    return matches.groupBy("user_id", "map_id").agg(
        F.sum(weight.cast("long")).alias("map_matches"), F.sum((weight * F.col("is_win")).cast("long")).alias("map_wins")
    )


def session_sums(matches: DataFrame, sign: str = "1") -> DataFrame:
    """user_id, session_number, playtime, wins, matches: the fold that also tells sessions apart."""
    weight = F.expr(sign)
    return matches.groupBy("user_id", "session_number").agg(
        F.sum(weight * F.col("duration")).alias("playtime"),
        F.sum((weight * F.col("is_win")).cast("long")).alias("wins"),
        F.sum(weight.cast("long")).alias("matches"),
    )


def added_up(parts: DataFrame, keys: Sequence[str], count: str) -> DataFrame:
    """The sums of parts, without keys of which no match is left."""
    sums = [F.sum(name).alias(name) for name in parts.columns if name not in keys]
    return parts.groupBy(*keys).agg(*sums).filter(F.col(count) > 0)


def user_map_stats_of(sums: DataFrame) -> DataFrame:
    """``user_map_stats`` from added ``map_sums``."""
    return sums.withColumn("map_win_ratio", ratio(F.col("map_wins"), F.col("map_matches")))


def user_totals_of(sums: DataFrame) -> DataFrame:
    """``user_totals`` from added ``session_sums``."""
    return _totals_from_sessions(
        sums.withColumnsRenamed({"playtime": "_playtime", "wins": "_wins", "matches": "_matches"})
    )


def user_totals(matches: DataFrame) -> DataFrame:
    """Totals per player; sessions are counted exactly.

    Rows are first folded per (player, session), so neither the distinct count
    nor a very active player brings raw matches into one task.
    """
    return _totals_from_sessions(
        matches.groupBy("user_id", "session_number").agg(
            F.sum("duration").alias("_playtime"),
            F.sum("is_win").alias("_wins"),
            F.count(F.lit(1)).alias("_matches"),
        )
    )


def _totals_from_sessions(per_session: DataFrame) -> DataFrame:
    totals = per_session.groupBy("user_id").agg(
        F.sum("_playtime").alias("total_playtime"),
        F.sum("_wins").alias("total_wins"),
        F.sum("_matches").alias("total_matches"),
        F.count("session_number").alias("total_sessions"),
    )
    return with_total_ratios(totals)


def with_total_ratios(totals: DataFrame) -> DataFrame:
    return totals.withColumn(
        "total_win_ratio", ratio(F.col("total_wins"), F.col("total_matches"))
    ).withColumn(
        "avg_matches_per_session", ratio(F.col("total_matches"), F.col("total_sessions"))
    )


def top_k_per_group(
    rows: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1
) -> DataFrame:
    """First ``k`` rows per key; Spark trims each partition before the shuffle."""
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return (
        rows.withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") <= k)
        .drop("_rank")
    )


def favorite_maps(map_stats: DataFrame, maps: DataFrame) -> DataFrame:
    """Best map per player: win ratio, then matches, then name; unknown maps last."""
    named = map_stats.join(maps.select("map_id", "map_name"), "map_id", "left")
    best = [
        F.desc("map_win_ratio"),
        F.desc("map_matches"),
        F.asc_nulls_last("map_name"),
        F.asc("map_id"),
    ]
    return top_k_per_group(named, ["user_id"], best).select(
        "user_id",
        F.col("map_name").alias("fav_map"),
        F.col("map_win_ratio").alias("fav_map_win_ratio"),
    )


def player_rollup(matches: DataFrame, maps: DataFrame) -> DataFrame:
    """Totals and favourite map of each player from a single pass over the matches.

    Equal to joining :func:`user_totals` with :func:`favorite_maps`, which would
    compute a lazy ``matches`` twice. Two grouping sets share one combined
    shuffle; the per-player fold then sees sessions and maps, never matches.
    """
    folded = matches.groupingSets(
        [["user_id", "session_number"], ["user_id", "map_id"]],
        "user_id",
        "session_number",
        "map_id",
    ).agg(
        F.grouping("map_id").alias("_by_session"),
        F.sum("duration").alias("_playtime"),
        F.sum("is_win").alias("_wins"),
        F.count(F.lit(1)).alias("_matches"),
    )
    named = folded.join(maps.select("map_id", "map_name"), "map_id", "left")
    win_ratio = ratio(F.col("_wins"), F.col("_matches"))
    # Sorts like favorite_maps: the smallest struct is the favourite.
    standing = F.struct(
        (-win_ratio).alias("by_ratio"),
        (-F.col("_matches")).alias("by_matches"),
        F.col("map_name").isNull().alias("by_unknown"),
        F.col("map_name").alias("fav_map"),
        F.col("map_id").alias("map_id"),
        win_ratio.alias("fav_map_win_ratio"),
    )
    by_session = F.col("_by_session") == 1
    per_player = named.groupBy("user_id").agg(
        F.sum(F.when(by_session, F.col("_playtime"))).alias("total_playtime"),
        F.sum(F.when(by_session, F.col("_wins"))).alias("total_wins"),
        F.sum(F.when(by_session, F.col("_matches"))).alias("total_matches"),
        F.count(F.when(by_session, F.lit(1))).alias("total_sessions"),
        F.min(F.when(~by_session, standing)).alias("_best"),
    )
    return with_total_ratios(per_player).select(
        "user_id",
        "total_playtime",
        "total_wins",
        "total_matches",
        "total_sessions",
        "total_win_ratio",
        "avg_matches_per_session",
        "_best.fav_map",
        "_best.fav_map_win_ratio",
    )

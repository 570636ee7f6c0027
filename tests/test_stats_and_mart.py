import datetime

import pytest
from pyspark.sql import functions as F
from rows import as_dicts, as_set, event, finish, maps, ping, staged, start

from ludometry.functions import ratio, round_half
from ludometry.operators import quality, stats
from ludometry.operators.mart import mart_player_stats, player_stats
from ludometry.operators.matches import matches
from ludometry.schemas import MATCH


def registration(event_id, timestamp, user_id, **more):
    return event(event_id, timestamp, "registration", user_id, **more)


def match(user, map_id, number, session=1, duration=10, win=1):
    return (user, map_id, "o", session, number, 100, 100 + duration, duration, float(win), win)


def test_rounding_follows_scale_and_round(spark):
    values = spark.createDataFrame([(201 / 400, 41 / 40), (1 / 3, 2 / 3), (None, None)], "a double, b double")
    got = values.select(round_half(F.col("a"), 3), round_half(F.col("b"), 2)).collect()
    # 0.5025 * 1000 is just below 502.5 in binary, and 1.025 * 100 just below 102.5.
    assert [tuple(row) for row in got] == [(0.502, 1.02), (0.333, 0.67), (None, None)]


def test_ratio_guards_zero_and_is_a_double(spark):
    frame = spark.createDataFrame([(1, 4), (1, 0), (None, 3)], "n bigint, d bigint")
    got = frame.select(ratio(F.col("n"), F.col("d")).alias("r"))
    assert dict(got.dtypes) == {"r": "double"}
    assert [row.r for row in got.collect()] == [0.25, None, None]


def test_registrations_take_the_largest_or_the_earliest(spark):
    frame = staged(
        spark,
        [
            registration("a", 200_000, "u", username="ann", country=None),
            registration("b", 100_000, "u", username=None, country="DE"),
            registration("c", 300_000, "u", username="bob", country="AT"),
            event("d", 1, "other", "u", username="zoe", country="ZZ"),
        ],
    )
    day = datetime.date(1970, 1, 2)
    assert as_set(stats.registrations(frame), "user_id", "username", "country", "registration_date") == {
        ("u", "bob", "DE", day)
    }
    first = stats.registrations_first(frame)
    assert as_set(first, "user_id", "username", "country", "registration_date") == {
        ("u", "ann", "DE", day)
    }


def test_totals_count_distinct_sessions_with_session_zero(spark):
    played = spark.createDataFrame(
        [match("u", "a", 1, 0, 5), match("u", "a", 2, 0, 7, 0), match("u", "b", 1, 3, 9)], MATCH
    )
    [row] = as_dicts(stats.user_totals(played))
    assert row == {
        "user_id": "u",
        "total_playtime": 21,
        "total_wins": 2,
        "total_matches": 3,
        "total_sessions": 2,
        "total_win_ratio": 2 / 3,
        "avg_matches_per_session": 1.5,
    }


@pytest.mark.parametrize(
    "played, favorite",
    [
        ([("a", 1), ("b", 0)], "Alpha"),  # higher ratio
        ([("a", 1), ("b", 1), ("b", 1)], "Beta"),  # same ratio, more matches
        ([("b", 1), ("a", 1)], "Alpha"),  # same again, name
        ([("x", 1), ("b", 1)], "Beta"),  # an unknown map comes last
        ([("x", 1), ("b", 0)], None),  # unless it is the best
    ],
)
def test_favorite_map(spark, played, favorite):
    rows = [match("u", map_id, i, win=win) for i, (map_id, win) in enumerate(played)]
    frame = spark.createDataFrame(rows, MATCH)
    names = maps(spark, {"a": "Alpha", "b": "Beta"})
    [row] = stats.favorite_maps(stats.user_map_stats(frame), names).collect()
    assert row.fav_map == favorite
    [rolled] = stats.player_rollup(frame, names).collect()
    assert (rolled.fav_map, rolled.fav_map_win_ratio) == (row.fav_map, row.fav_map_win_ratio)


def mart_events():
    return [
        registration("r1", 86_400, "u", username="ann", country="DE"),
        registration("r2", 86_400, "idle", username="idle", country=None),
        ping("p", 90_000),
        start("s", 90_010, map_id="a"),
        finish("f", 90_050, map_id="a"),
        start("s2", 90_010, "ghost", map_id="a"),
        finish("f2", 90_050, "ghost", map_id="a"),
    ]


def test_mart_keeps_idle_players_and_drops_unregistered_ones(spark):
    events, names = staged(spark, mart_events()), maps(spark, {"a": "Alpha"})
    mart = player_stats(events, names)
    assert mart.columns == [
        "user_id", "username", "country", "fav_map", "fav_map_win_ratio", "total_playtime",
        "total_win_ratio", "avg_matches_per_session", "registration_date", "data_quality_status",
    ]
    day = datetime.date(1970, 1, 2)
    assert [tuple(row) for row in mart.collect()] == [
        ("u", "ann", "DE", "Alpha", 1.0, 40, 1.0, 1.0, day, "valid"),
        ("idle", "idle", None, None, None, None, None, None, day, "missing_country"),
    ]
    played = matches(events)
    joined = mart_player_stats(
        stats.registrations(events),
        stats.user_totals(played),
        stats.favorite_maps(stats.user_map_stats(played), names),
    )
    assert joined.collect() == mart.collect()


def test_checks_find_each_violation(spark):
    schema = (
        "user_id string, username string, registration_date date, total_playtime bigint, "
        "total_win_ratio double, fav_map_win_ratio double"
    )
    day = datetime.date(2024, 1, 1)
    mart = spark.createDataFrame(
        [
            ("a", "x", day, 1, 0.5, 0.5),
            ("a", None, day, -1, 1.5, None),
            ("b", "x", None, None, None, -0.1),
            (None, "x", day, 1, 1.0, 0.0),
            (None, "x", day, 1, 1.0, 0.0),
        ],
        schema,
    )
    got = {name: (count, passed) for name, count, passed in quality.mart_checks(mart).collect()}
    assert got == {
        "user_id_not_null": (2, False),
        "user_id_unique": (1, False),
        "username_not_null": (1, False),
        "registration_date_not_null": (1, False),
        "fav_map_win_ratio_in_range": (1, False),
        "total_win_ratio_in_range": (1, False),
        "total_playtime_not_negative": (1, False),
    }
    assert quality.null_violations(mart, "username").count() == 1
    assert as_set(quality.duplicate_violations(mart, "user_id"), "user_id", "copies") == {("a", 2)}
    assert quality.ratio_violations(mart, "total_win_ratio").count() == 1
    assert quality.negative_violations(mart, "total_playtime").count() == 1


def test_checks_pass_on_an_empty_mart(spark):
    empty = player_stats(staged(spark, []), maps(spark, {}))
    assert empty.count() == 0
    assert all(row.violations == 0 and row.passed for row in quality.mart_checks(empty).collect())


def test_mart_does_not_depend_on_the_layout_of_the_input(spark):
    events, names = staged(spark, mart_events()), maps(spark, {"a": "Alpha"})
    results = [
        player_stats(events.orderBy(F.rand(seed)).repartition(parts), names).collect()
        for seed, parts in ((1, 1), (2, 8))
    ]
    assert results[0] == results[1]

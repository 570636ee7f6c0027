"""Statistics that follow updates of the match table, against a rebuild."""

import pytest
from rows import as_set, raw_line, write_lines

from ludometry.operators.stats import user_map_stats, user_totals
from ludometry.plans import bronze, gold, silver, sums
from ludometry.plans.lake import Lake
from ludometry.schemas import MATCH
from ludometry.sinks import versions
from ludometry.sinks.versions import read_current
from ludometry.sources.jsonlines import read_events

PLACE = dict(map_id="a", opponent_id="o")
TABLES = {
    "user_map_stats": ("user_id", "map_id", "map_matches", "map_wins", "map_win_ratio"),
    "user_totals": (
        "user_id", "total_playtime", "total_wins", "total_matches", "total_sessions", "total_win_ratio", "avg_matches_per_session",
    ),
    "player_stats": ("user_id", "fav_map", "total_playtime", "total_win_ratio", "avg_matches_per_session"),
}


def plays(player, first, *pairs, place=PLACE):
    """A session opening, and matches of a player as (start, finish, outcome)."""
    lines = [raw_line(f"{player}-s{first}", first, "session_ping", player, state="started")]
    for start, finish, outcome in pairs:
        lines.append(raw_line(f"{player}-a{start}", start, "match_start", player, **place))
        lines.append(raw_line(f"{player}-b{finish}", finish, "match_finish", player, outcome=outcome, **place))
    return lines


DELIVERIES = [
    [raw_line("r1", 1, "registration", "u", username="ann"), raw_line("r2", 1, "registration", "v", username="bob"),
     *plays("u", 10, (11, 20, 1), (21, 30, 0)), *plays("v", 10, (12, 25, 1), place=dict(map_id="b", opponent_id="o"))],
    # A late start of v shifts its ordinals, so a stored match is replaced; u plays on.
    [*plays("u", 40, (41, 50, 1)), raw_line("late", 11, "match_start", "v", map_id="b", opponent_id="o"),
     raw_line("f", 60, "match_finish", "v", outcome=1, map_id="b", opponent_id="o")],
    [*plays("w", 70, (71, 80, 1)), raw_line("r3", 70, "registration", "w", username="cat"), *plays("u", 90, (91, 95, 1), place=dict(map_id="c", opponent_id="o"))],
]


def deliver(spark, lake, lines, name):
    path = write_lines(f"{lake.root}/raw/{name}.jsonl", lines)
    bronze.append_new_events(spark, read_events(spark, path), lake)
    silver.run_silver(spark, lake)


def statistics(spark, lake):
    return {name: as_set(spark.read.parquet(getattr(lake, name)), *columns) for name, columns in TABLES.items()}


def test_three_deliveries_equal_a_rebuild(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path / "lake"))
    rebuilt = []
    rebuild = sums.rebuild
    monkeypatch.setattr(sums, "rebuild", lambda *a: (rebuilt.append(1), rebuild(*a)))
    for k, lines in enumerate(DELIVERIES):
        deliver(spark, lake, lines, str(k))
        gold.run_gold(spark, lake, mode="watermark")
        played = read_current(spark, lake.matches, MATCH)
        found = statistics(spark, lake)
        assert found["user_map_stats"] == as_set(user_map_stats(played), *TABLES["user_map_stats"])
        assert found["user_totals"] == as_set(user_totals(played), *TABLES["user_totals"])
    assert len(rebuilt) == 1  # the first time only
    found = statistics(spark, lake)
    sums.rebuild(spark, lake, played)
    gold.run_gold(spark, lake, mode="watermark")
    assert statistics(spark, lake) == found


def test_replaced_matches_are_taken_out(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))

    def row(number, session, duration, win):
        return ("u", "m", "o", session, number, 0, duration, duration, float(win), win)

    first = spark.createDataFrame([row(1, 1, 10, 1), row(2, 2, 20, 1)], MATCH)
    versions.publish(first, lake.matches, by="user_id", count=2)
    sums.rebuild(spark, lake, first)
    delta = spark.createDataFrame([row(2, 1, 25, 0), row(3, 3, 5, 1)], MATCH)
    assert sums.are_current(spark, lake)
    gold._merge(delta, read_current(spark, lake.matches, MATCH), lake.matches, lambda signed: sums.add(lake, signed))
    assert not sums.are_current(spark, lake)
    sums.note_state(spark, lake)
    played = read_current(spark, lake.matches, MATCH)
    assert played.count() == 3
    assert as_set(sums.user_map_stats(spark, lake), "map_matches", "map_wins") == {(3, 2)}
    assert as_set(sums.user_totals(spark, lake), "total_playtime", "total_sessions") == {(40, 2)}  # session 2 is gone


def test_sums_that_fell_behind_are_made_anew(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path / "lake"))
    deliver(spark, lake, DELIVERIES[0], "0")
    gold.run_gold(spark, lake)
    deliver(spark, lake, DELIVERIES[1], "1")

    def die(*_):
        raise RuntimeError

    with monkeypatch.context() as half:
        half.setattr(sums, "add", die)
        with pytest.raises(RuntimeError):
            gold.run_gold(spark, lake, mode="watermark")
    assert not sums.are_current(spark, lake)
    deliver(spark, lake, DELIVERIES[2], "2")
    gold.run_gold(spark, lake, mode="watermark")
    assert sums.are_current(spark, lake)
    played = read_current(spark, lake.matches, MATCH)
    assert statistics(spark, lake)["user_totals"] == as_set(user_totals(played), *TABLES["user_totals"])


def test_many_changes_are_added_up(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sums, "MOST_CHANGES", 2)
    lake = Lake(str(tmp_path / "lake"))
    rows = [("u", "m", "o", k, k, 0, k, k, 1.0, 1) for k in range(1, 6)]
    for k, one in enumerate(rows):
        delta = spark.createDataFrame([one], MATCH)
        if not k:
            versions.publish(delta, lake.matches, by="user_id", count=2)
            sums.rebuild(spark, lake, delta)
        else:
            gold._merge(delta, read_current(spark, lake.matches, MATCH), lake.matches, lambda signed: sums.add(lake, signed))
    assert as_set(sums.user_totals(spark, lake), "total_matches", "total_playtime", "total_sessions") == {(5, 15, 5)}
    assert versions.change_count(spark, lake.map_sums) < 2

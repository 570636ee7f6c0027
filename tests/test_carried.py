"""Match updates on carried counters against updates on whole histories."""

import random

import pytest
from rows import as_set, raw_line, write_lines
from test_keys import jobs_of

from ludometry.plans import bronze, carried, gold, silver
from ludometry.plans.lake import Lake
from ludometry.schemas import CARRIED, MATCH
from ludometry.sinks.versions import change_count, read_current
from ludometry.sources.jsonlines import read_events

SCHEMA = (
    "event_id string, timestamp long, event_type string, user_id string, "
    "session_state string, map_id string, opponent_id string, outcome double"
)
COLUMNS = MATCH.fieldNames()


def some_events(draw, low, high, n, players="uvwxyz"):
    """Random events of a span of seconds; ids are random, so ties in time fall either way."""
    rows = []
    for _ in range(n):
        kind = draw.choice(["session_ping", "match_start", "match_start", "match_finish", "match_finish", "other"])
        place = (draw.choice("ab"), draw.choice(["o", "o", None])) if kind.startswith("match") else (None, None)
        rows.append((
            f"{draw.randrange(10**9):09d}", draw.randrange(low, high), kind, draw.choice(players),
            draw.choice(["started", "started", "in_progress"]) if kind == "session_ping" else None,
            *place, float(draw.random() < 0.5) if kind == "match_finish" else None,
        ))
    return rows


def matches_of(frame):
    return as_set(frame, *COLUMNS)


@pytest.mark.parametrize("seed, late, hot_rows", [(1, False, 10**9), (2, True, 10**9), (3, True, 12)])
def test_batches_equal_updates_on_the_history(spark, tmp_path, seed, late, hot_rows):
    draw, lake, other = random.Random(seed), Lake(str(tmp_path / "lake")), str(tmp_path / "other")
    seen, asked = [], []
    for step in range(4):
        batch = some_events(draw, 100 * step, 100 * step + 100, 90)
        if late and step:
            batch += some_events(draw, 0, 100 * step, 8, "uv")
        seen += batch
        every = spark.createDataFrame(seen, SCHEMA)
        carried.apply_batch(
            spark, lake, spark.createDataFrame(batch, SCHEMA), step, lambda all_=every, k=step: (asked.append(k), all_)[1], hot_rows
        )
        gold.update_matches(every, other, mode="watermark", hot_rows=hot_rows)
        assert matches_of(read_current(spark, lake.matches, MATCH)) == matches_of(read_current(spark, other, MATCH))
    assert asked == ([0, 1, 2, 3] if late else [0])
    # The counters are those of the whole history.
    found = carried.added_up(read_current(spark, lake.carried, CARRIED))
    assert as_set(found, *CARRIED.fieldNames()) == as_set(carried._since_the_beginning(every, hot_rows), *CARRIED.fieldNames())


def play(k, player="u"):
    return [
        (f"{k}s", 10 * k, "match_start", player, None, "m", "o", None),
        (f"{k}z", 10 * k + 5, "match_finish", player, None, "m", "o", 1.0),
    ]


def test_a_start_waits_for_its_finish(spark, tmp_path):
    lake, seen = Lake(str(tmp_path)), []

    def apply(number, rows):
        seen.extend(rows)
        every = spark.createDataFrame(seen, SCHEMA)
        carried.apply_batch(spark, lake, spark.createDataFrame(rows, SCHEMA), number, lambda: every if not number else pytest.fail("history"))
        return as_set(read_current(spark, lake.matches, MATCH), "match_number", "session_number", "start_timestamp", "finish_timestamp")

    ping = ("p", 25, "session_ping", "u", "started", None, None, None)
    assert apply(0, play(1)) == {(1, 0, 10, 15)}
    assert apply(1, [play(2)[0], ping]) == {(1, 0, 10, 15)}
    assert carried.pending_starts(read_current(spark, lake.carried, CARRIED)).count() == 1
    assert apply(2, [play(3)[0]]) == {(1, 0, 10, 15)}
    assert apply(3, [play(3)[1]]) == {(1, 0, 10, 15), (2, 0, 20, 35)}
    assert apply(4, [play(4)[1]]) == {(1, 0, 10, 15), (2, 0, 20, 35), (3, 1, 30, 45)}
    assert carried.pending_starts(read_current(spark, lake.carried, CARRIED)).count() == 0


def test_a_replayed_batch_and_one_that_died(spark, tmp_path, monkeypatch):
    lake, seen = Lake(str(tmp_path)), play(1)
    first = spark.createDataFrame(seen, SCHEMA)
    carried.apply_batch(spark, lake, first, 0, lambda: first)
    seen = seen + play(2)
    batch, every = spark.createDataFrame(play(2), SCHEMA), spark.createDataFrame(seen, SCHEMA)

    def die(*_):
        raise RuntimeError

    with monkeypatch.context() as half:
        half.setattr(carried, "extend", die)  # the matches are written, the counters are not
        with pytest.raises(RuntimeError):
            carried.apply_batch(spark, lake, batch, 1, lambda: every)
    assert read_current(spark, lake.matches, MATCH).count() == 2
    for _ in range(2):
        carried.apply_batch(spark, lake, batch, 1, lambda: every)
        assert read_current(spark, lake.matches, MATCH).count() == 2
    third = spark.createDataFrame(play(3), SCHEMA)
    carried.apply_batch(spark, lake, third, 2, pytest.fail)
    assert read_current(spark, lake.matches, MATCH).count() == 3


def test_many_changes_are_added_up(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(carried, "MOST_CHANGES", 2)
    lake = Lake(str(tmp_path))
    first = spark.createDataFrame(play(1), SCHEMA)
    carried.apply_batch(spark, lake, first, 0, lambda: first)
    for k in range(2, 6):
        carried.apply_batch(spark, lake, spark.createDataFrame(play(k), SCHEMA), k, pytest.fail)
    assert change_count(spark, lake.carried) < 2
    assert read_current(spark, lake.carried, CARRIED).count() <= 6
    assert as_set(read_current(spark, lake.matches, MATCH), "match_number") == {(k,) for k in range(1, 6)}


def test_new_silver_files_are_followed(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    assert carried.follow_matches(spark, lake).count() == 0
    place = dict(map_id="a", opponent_id="o")

    def deliver(name, *lines):
        path = write_lines(f"{lake.root}/raw/{name}.jsonl", list(lines))
        bronze.append_new_events(spark, read_events(spark, path), lake)
        silver.run_silver(spark, lake)

    deliver("a", raw_line("1", 10, "match_start", **place), raw_line("2", 20, "match_finish", outcome=1, **place))
    assert carried.follow_matches(spark, lake).count() == 1
    assert jobs_of(spark, lambda: carried.follow_matches(spark, lake)) == 0
    deliver("b", raw_line("3", 30, "match_start", **place), raw_line("4", 40, "match_finish", outcome=0, **place))
    found = carried.follow_matches(spark, lake)
    assert as_set(found, "match_number", "finish_timestamp", "is_win") == {(1, 20, 1), (2, 40, 0)}


def test_the_mart_follows_new_files(spark, tmp_path):
    """Three deliveries through new-file jobs, the statistics equal to a rebuild after each."""
    from test_sums import DELIVERIES, TABLES, statistics

    from ludometry.operators.stats import user_map_stats, user_totals

    lake = Lake(str(tmp_path / "lake"))
    for k, lines in enumerate(DELIVERIES):
        path = write_lines(f"{lake.root}/raw/{k}.jsonl", lines)
        bronze.append_new_events(spark, read_events(spark, path), lake)
        silver.run_silver(spark, lake)
        assert carried.run_gold_of_new_files(spark, lake).count() == (2 if k < 2 else 3)
        played, found = read_current(spark, lake.matches, MATCH), statistics(spark, lake)
        assert found["user_map_stats"] == as_set(user_map_stats(played), *TABLES["user_map_stats"])
        assert found["user_totals"] == as_set(user_totals(played), *TABLES["user_totals"])

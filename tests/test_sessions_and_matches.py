import random
from collections import defaultdict

import pytest
from rows import as_set, event, finish, ping, staged, start

from ludometry.operators.matches import match_finishes, match_starts, matches
from ludometry.operators.running import hot_keys
from ludometry.operators.sessions import event_sessions
from ludometry.schemas import MATCH


def sessions_by_hand(events):
    """Session number of each event id, counted one event at a time."""
    numbers, open_session = {}, defaultdict(int)
    for e in sorted(events, key=lambda e: (e["timestamp"], e["event_id"])):
        if e["event_type"] == "session_ping" and e.get("session_state") == "started":
            open_session[e["user_id"]] += 1
        numbers[e["event_id"]] = open_session[e["user_id"]]
    return numbers


def matches_by_hand(events):
    sessions = sessions_by_hand(events)
    sides = defaultdict(lambda: ([], []))
    for e in sorted(events, key=lambda e: (e["timestamp"], e["event_id"])):
        if e["event_type"] in ("match_start", "match_finish"):
            if e.get("map_id") is None or e.get("opponent_id") is None:
                continue
            side = 0 if e["event_type"] == "match_start" else 1
            sides[e["user_id"], e["map_id"], e["opponent_id"]][side].append(e)
    found = set()
    for group, (starts, finishes) in sides.items():
        for number, (s, f) in enumerate(zip(starts, finishes), 1):
            if f["timestamp"] >= s["timestamp"]:
                won = 1 if f["outcome"] == 1 else 0
                span = (s["timestamp"], f["timestamp"], f["timestamp"] - s["timestamp"])
                found.add((*group, sessions[s["event_id"]], number, *span, f["outcome"], won))
    return found


def random_events(seed, count, hot_share, seconds):
    """Events of a few players, one of whom owns a large share of them."""
    dice = random.Random(seed)
    events = []
    for i in range(count):
        user = "hot" if dice.random() < hot_share else f"u{dice.randrange(6)}"
        event_id, at = f"e{dice.randrange(10**6):06d}-{i}", dice.randrange(1, seconds)
        kind = dice.randrange(5)
        if kind == 0:
            events.append(ping(event_id, at, user, dice.choice(["started", "ended", None])))
        elif kind == 1:
            events.append(event(event_id, at, "other", user))
        else:
            place = dict(
                map_id=dice.choice(["m1", "m2", None]), opponent_id=dice.choice(["o1", "o2", None])
            )
            if kind < 4:
                events.append(start(event_id, at, user, **place))
            else:
                outcome = dice.choice([1.0, 0.0, 0.5, None])
                events.append(finish(event_id, at, user, outcome=outcome, **place))
    return events


def test_sessions_start_at_zero_and_ties_follow_the_text_of_the_id(spark):
    events = [
        event("a", 1, "other"),
        ping("b10", 5),
        start("b2", 5),
        start("b1", 5),
        ping("c", 9, state="ended"),
        ping("d", 9, state=None),
        ping("e", 12),
        ping("x", 3, user_id="v"),
    ]
    got = as_set(event_sessions(staged(spark, events)), "event_id", "new_session", "session_number")
    assert got == {
        ("a", 0, 0),
        ("b1", 0, 0),
        ("b10", 1, 1),
        ("b2", 0, 1),
        ("c", 0, 1),
        ("d", 0, 1),
        ("e", 1, 2),
        ("x", 1, 1),
    }


@pytest.mark.parametrize("hot_rows", [1, 50, 10**9])
@pytest.mark.parametrize("seconds", [2, 40, 10_000])
def test_all_plans_agree_with_counting_by_hand(spark, seconds, hot_rows):
    """Also with a third of all events in the same seconds of one player."""
    events = random_events(7, 400, hot_share=0.4, seconds=seconds)
    frame = staged(spark, events).repartition(5)
    numbered = event_sessions(frame, hot_rows)
    assert dict(as_set(numbered, "event_id", "session_number")) == sessions_by_hand(events)
    paired = [tuple(row) for row in matches(frame, hot_rows).collect()]
    assert len(paired) == len(set(paired))
    assert set(paired) == matches_by_hand(events)


def test_hot_keys_are_counted_exactly(spark):
    events = [event(str(i), 1, "other", "a" if i % 3 else "b") for i in range(30)]
    frame = staged(spark, events)
    assert hot_keys(frame, ["user_id"], 10) == [("a", 20)]
    assert hot_keys(frame, ["user_id"], 20) == []


def test_null_player_can_be_hot(spark):
    events = [ping(f"e{i:02d}", i, user_id=None) for i in range(12)] + [ping("x", 1)]
    got = event_sessions(staged(spark, events), hot_rows=3)
    assert got.count() == 13
    assert got.agg({"session_number": "max"}).first()[0] == 12


@pytest.mark.parametrize("hot_rows", [1, 10**9])
def test_starts_and_finishes_number_null_places_too(spark, hot_rows):
    events = [
        ping("p", 1),
        start("s1", 2, map_id=None),
        start("s2", 3, map_id=None),
        start("s3", 4),
        finish("f1", 5, map_id=None, outcome=None),
    ]
    frame = staged(spark, events)
    starts = match_starts(frame, hot_rows)
    assert starts.columns == [
        "user_id", "map_id", "opponent_id", "session_number", "start_timestamp", "match_number",
    ]
    assert as_set(starts, "map_id", "session_number", "start_timestamp", "match_number") == {
        (None, 1, 2, 1),
        (None, 1, 3, 2),
        ("m", 1, 4, 1),
    }
    finishes = match_finishes(frame, hot_rows)
    assert as_set(finishes, "map_id", "outcome", "finish_timestamp", "match_number") == {
        (None, None, 5, 1)
    }
    assert matches(frame, hot_rows).count() == 0


def test_pairing_is_by_ordinal(spark):
    """The finish of the first match got lost: later pairs shift, none is made up."""
    events = [start("s1", 10), start("s2", 20), finish("f2", 25), start("s3", 30), finish("f3", 31)]
    got = matches(staged(spark, events))
    assert got.columns == MATCH.fieldNames()
    assert as_set(got, "match_number", "start_timestamp", "finish_timestamp") == {
        (1, 10, 25),
        (2, 20, 31),
    }


def test_pair_that_ends_before_it_starts_is_dropped_not_paired_anew(spark):
    events = [finish("f0", 5), start("s1", 10), finish("f1", 12), start("s2", 11)]
    got = as_set(matches(staged(spark, events)), "match_number", "start_timestamp", "finish_timestamp")
    assert got == {(2, 11, 12)}


def test_win_flag(spark):
    outcomes = {"a": 1.0, "b": 0.0, "c": 0.5, "d": None}
    events = []
    for name, outcome in outcomes.items():
        events += [start(f"s{name}", 1, map_id=name), finish(f"f{name}", 1, map_id=name, outcome=outcome)]
    got = as_set(matches(staged(spark, events)), "map_id", "is_win", "duration")
    assert got == {("a", 1, 0), ("b", 0, 0), ("c", 0, 0), ("d", 0, 0)}


def test_null_timestamps_never_make_a_match(spark):
    events = [start("s", None), finish("f", 5), start("t", 5, map_id="n"), finish("g", None, map_id="n")]
    assert matches(staged(spark, events)).count() == 0

import datetime
import json
import re

import pytest
from pyspark.sql import functions as F
from rows import as_dicts, as_set, plan, raw_line, write_lines

from ludometry.operators import quality
from ludometry.operators.increment import in_dates, new_rows, unprocessed_keys, upsert, watermark
from ludometry.operators.normalize import clean_events, flatten_top_level_map
from ludometry.plans import bronze, flat, gold, silver
from ludometry.plans.lake import Lake
from ludometry.schemas import (
    BRONZE_EVENT,
    BRONZE_MAP,
    CORRUPT,
    MATCH,
    MATCH_KEY,
    QUARANTINED_EVENT,
    RAW_EVENT,
    RAW_TOP_LEVEL_MAP_EVENT,
    SILVER_EVENT,
    SILVER_MAP,
)
from ludometry.session import scratch_path, shared_folder
from ludometry.sinks.tables import append, append_partitioned, overwrite
from ludometry.sinks.versions import current_path, prune, publish, read_current
from ludometry.sources.jsonlines import read_events, read_json_lines
from ludometry.sources.tables import read_or_empty, read_table, stage_events
from ludometry.streaming.ingest import ingest_new_files

SECOND = 1_700_000_000
DAY = datetime.date(2023, 11, 14)


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def deliver(spark, lake, lines, name="all.jsonl"):
    path = write_lines(f"{lake.root}/raw/{name}", lines)
    return bronze.append_new_events(spark, read_events(spark, path), lake)


def stored_bronze(spark, lake):
    return read_or_empty(spark, lake.bronze_events, BRONZE_EVENT)


def stored_silver(spark, lake):
    return read_or_empty(spark, lake.silver_events, SILVER_EVENT)


def stored_quarantine(spark, lake):
    return read_or_empty(spark, lake.quarantined_events, SILVER_EVENT)


EDGE_LINES = {
    "good": raw_line("1"),
    "numeric ids": '{"id": 2, "timestamp": 1700000000, "event_type": "x", "user_id": 7}',
    "blank": "   ",
    "empty": "",
    "text": "not json",
    "array": "[1, 2]",
    "text time": '{"id": "3", "timestamp": "1700000000", "event_type": "x", "user_id": "u"}',
    "fraction": '{"id": "4", "timestamp": 1.5, "event_type": "x", "user_id": "u"}',
    "outcome": '{"id": "5", "timestamp": 1700000000, "event_type": "x", "user_id": "u", '
    '"event_data": {"outcome": "abc", "map_id": "m"}}',
    "nothing": "{}",
    "two": f"[{raw_line('6')}, {raw_line('7')}]",
    "object as text": '{"id": {"a": 1}, "timestamp": 1700000000, "event_type": "x", "user_id": "u"}',
    "extra": '{"id": "8", "timestamp": 1700000000, "event_type": "x", "user_id": "u", "more": 1}',
    "null data": '{"id": "9", "timestamp": 1700000000, "event_type": "x", "user_id": "u", '
    '"event_data": null}',
}


def test_edge_lines(spark, lake):
    assert deliver(spark, lake, EDGE_LINES.values()) == 13
    refined = silver.refine_events(stored_bronze(spark, lake))
    assert refined.columns == SILVER_EVENT.fieldNames()
    verdicts = as_set(refined, "event_id", "validation_error", CORRUPT)
    bad = "malformed JSON"
    assert verdicts == {
        ("1", "valid", None),
        ("2", "valid", None),
        (None, bad, EDGE_LINES["text"]),
        (None, bad, EDGE_LINES["array"]),
        ("3", bad, EDGE_LINES["text time"]),
        ("4", bad, EDGE_LINES["fraction"]),
        ("5", bad, EDGE_LINES["outcome"]),
        (None, "missing event_id", None),
        ("6", "valid", None),
        ("7", "valid", None),
        ('{"a": 1}', "valid", None),
        ("8", "valid", None),
        ("9", "valid", None),
    }
    [kept] = as_dicts(refined.filter("event_id = '5'"), "map_id", "outcome", "user_id")
    assert kept == {"map_id": "m", "outcome": None, "user_id": "u"}


def test_scan_without_corrupt_column_gives_null_rows(spark, tmp_path):
    path = write_lines(tmp_path / "e.jsonl", ["not json", raw_line("1")])
    got = read_json_lines(spark, path, RAW_EVENT, corrupt_column=None)
    assert as_set(got, "id", "timestamp", CORRUPT) == {(None, None, None), ("1", SECOND, None)}


def test_event_time_survives_odd_numbers(spark, lake):
    seconds = {"ok": 86_399, "before": -1, "millis": SECOND * 1000_000, "huge": 10**17, "none": None}
    deliver(spark, lake, [raw_line(name, at) for name, at in seconds.items()])
    days = dict(as_set(stored_bronze(spark, lake), "id", "event_date"))
    assert days == {
        "ok": datetime.date(1970, 1, 1),
        "before": datetime.date(1969, 12, 31),
        "millis": None,
        "huge": None,
        "none": None,
    }
    assert stored_bronze(spark, lake).filter("event_timestamp IS NULL").count() == 3


def test_date_does_not_follow_the_session_zone(spark, lake):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        deliver(spark, lake, [raw_line("1", 86_400)])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert as_set(stored_bronze(spark, lake), "event_date") == {(datetime.date(1970, 1, 2),)}


def test_timestamp_bound_is_off_unless_asked_for(spark):
    rows = spark.createDataFrame(
        [("1", 10**14, "x", "u", None)],
        f"event_id string, timestamp bigint, event_type string, user_id string, {CORRUPT} string",
    )
    assert quality.validate(rows, quality.event_rules()).first().validation_error == "valid"
    bounded = quality.validate(rows, quality.event_rules(max_epoch=4 * 10**9)).first()
    assert (bounded.validation_error, bounded.is_valid) == ("timestamp out of range", False)


def test_first_broken_rule_names_the_row(spark, lake):
    lines = [
        raw_line(None, 0, "", None),
        raw_line("2", 0, "", None),
        raw_line("3", 0, "  "),
        raw_line("4", 0, None),
        raw_line("5", 0),
        raw_line("6", -5),
        raw_line("7", None),
        raw_line("8", 1),
        raw_line("9", 1, "\t"),
    ]
    deliver(spark, lake, lines)
    refined = silver.refine_events(stored_bronze(spark, lake))
    assert as_set(refined, "event_id", "validation_error", "is_valid") == {
        (None, "missing event_id", False),
        ("2", "missing user_id", False),
        ("3", "invalid event_type", False),
        ("4", "invalid event_type", False),
        ("5", "invalid timestamp", False),
        ("6", "invalid timestamp", False),
        ("7", "invalid timestamp", False),
        ("8", "valid", True),
        ("9", "valid", True),  # only blanks are trimmed
    }


def test_cleaning(spark, lake):
    data = dict(
        country=" de ", device_os=" iOS ", username=" Ann B ", state=" Started ", map_id=" m ",
        opponent_id=" o ", outcome=1,
    )
    deliver(spark, lake, [raw_line(" 1 ", SECOND, " Session_PING ", " u ", **data)])
    [row] = as_dicts(silver.refine_events(stored_bronze(spark, lake)))
    shown = {k: row[k] for k in SILVER_EVENT.fieldNames()[:11] if k != "timestamp"}
    assert shown == {
        "event_id": " 1 ", "event_type": "session_ping", "user_id": " u ", "country": "DE",
        "device_os": "ios", "username": "Ann B", "session_state": "started", "map_id": " m ",
        "opponent_id": " o ", "outcome": 1.0,
    }
    assert row["event_date"] == DAY


def test_bronze_again_adds_nothing_even_without_ids(spark, lake):
    lines = [
        raw_line("1"), raw_line("1"), raw_line(None, 5), raw_line(None, 5), raw_line(None, 6),
        "not json", "{}",
    ]
    assert deliver(spark, lake, lines) == 7
    assert deliver(spark, lake, lines) == 0
    assert deliver(spark, lake, [*lines, raw_line("2"), raw_line(None, 7), "other text"]) == 3
    assert stored_bronze(spark, lake).count() == 10
    assert read_table(spark, lake.bronze_events, BRONZE_EVENT).columns == BRONZE_EVENT.fieldNames()


def test_bronze_keeps_the_first_record_of_an_id(spark, lake):
    deliver(spark, lake, [raw_line("1", user_id="first")])
    assert deliver(spark, lake, [raw_line("1", user_id="second"), raw_line("2")]) == 1
    assert as_set(stored_bronze(spark, lake), "id", "user_id") == {("1", "first"), ("2", "u")}


def test_bronze_within_days(spark, lake):
    path = write_lines(f"{lake.root}/raw/a.jsonl", [raw_line("1"), raw_line("2", None)])
    batch = read_events(spark, path)
    assert bronze.append_new_events(spark, batch, lake) == 2
    assert bronze.append_new_events(spark, batch, lake, dates=[DAY, None]) == 0
    assert bronze.append_new_events(spark, batch, lake, dates=[DAY]) == 0
    assert bronze.append_new_events(spark, batch, lake, dates=[None]) == 0


def test_a_day_limits_the_batch_too(spark, lake):
    path = write_lines(f"{lake.root}/raw/a.jsonl", [raw_line("1"), raw_line("2", None)])
    batch = read_events(spark, path)
    assert bronze.append_new_events(spark, batch, lake, dates=[DAY]) == 1
    assert bronze.append_new_events(spark, batch, lake, dates=[DAY]) == 0
    assert bronze.append_new_events(spark, batch, lake, dates=[None]) == 1
    assert bronze.append_new_events(spark, batch, lake) == 0


def test_empty_delivery_adds_no_data(spark, lake, tmp_path):
    assert deliver(spark, lake, []) == 0
    assert not list((tmp_path / "lake/bronze").rglob("*.parquet"))
    assert stored_bronze(spark, lake).count() == 0
    assert deliver(spark, lake, [raw_line("1")]) == 1
    before = sorted((tmp_path / "lake/bronze").rglob("*.parquet"))
    assert deliver(spark, lake, [raw_line("1")]) == 0
    assert sorted((tmp_path / "lake/bronze").rglob("*.parquet")) == before


@pytest.mark.parametrize("counted", [None, 3, 10**9])
def test_new_rows_is_the_same_for_every_plan(spark, counted):
    batch = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4), (None, 5)], "k string, n int")
    stored = spark.createDataFrame([("b",), ("b",), ("x",), (None,)], "k string")
    got = as_set(new_rows(batch, stored, "k", counted), "k", "n")
    assert got == {("a", 1), ("a", 2), ("c", 4), (None, 5)}
    assert new_rows(batch, None, "k").count() == 5
    assert as_set(unprocessed_keys(batch.select("k"), stored, "k"), "k") == {("a",), ("c",)}


def test_streamed_files_are_read_once(spark, lake, tmp_path):
    folder, progress = f"{lake.root}/raw/inbox", str(tmp_path / "progress")
    write_lines(f"{folder}/a.jsonl", [raw_line("1"), raw_line("1"), "not json"])
    ingest_new_files(spark, folder, lake, progress)
    assert stored_bronze(spark, lake).count() == 3
    write_lines(f"{folder}/b.jsonl", [raw_line("1"), raw_line("2"), "not json"])
    ingest_new_files(spark, folder, lake, progress, files_per_batch=1)
    ingest_new_files(spark, folder, lake, progress)
    assert as_set(stored_bronze(spark, lake), "id", CORRUPT) == {
        ("1", None), (None, "not json"), ("2", None),
    }
    assert stored_bronze(spark, lake).count() == 4


SILVER_LINES = [
    raw_line("1", user_id="b"),
    raw_line("1", user_id="a"),
    raw_line("2"),
    raw_line("3", user_id=None),
    raw_line("3", user_id=None, event_type="y"),
    raw_line(None),
    raw_line(None),
    "not json",
]


@pytest.mark.parametrize("broadcast_keys, most_days", [(500_000, 5_000), (500_000, 0), (0, 0)])
def test_silver_again_adds_nothing(spark, lake, monkeypatch, broadcast_keys, most_days):
    monkeypatch.setattr(silver, "BROADCAST_KEYS", broadcast_keys)
    monkeypatch.setattr(silver, "MOST_DAYS", most_days)
    deliver(spark, lake, SILVER_LINES)
    first = silver.run_silver(spark, lake, at=F.lit(datetime.datetime(2024, 1, 1)))
    assert (first["valid_events"], first["quarantined_events"]) == (2, 5)
    assert as_set(stored_silver(spark, lake), "event_id", "user_id") == {("1", "a"), ("2", "u")}
    again = silver.run_silver(spark, lake)
    assert (again["valid_events"], again["quarantined_events"]) == (0, 0)

    more = [*SILVER_LINES, raw_line("4"), raw_line("5", 0), raw_line(None, 9)]
    deliver(spark, lake, more)
    third = silver.run_silver(spark, lake)
    assert (third["valid_events"], third["quarantined_events"]) == (1, 2)
    assert stored_silver(spark, lake).count() == 3
    assert stored_quarantine(spark, lake).count() == 7
    assert stored_silver(spark, lake).filter("NOT is_valid").count() == 0


@pytest.mark.parametrize("broadcast_keys", [500_000, 0])
def test_silver_leaves_bad_rows_of_accepted_ids(spark, lake, monkeypatch, broadcast_keys):
    monkeypatch.setattr(silver, "BROADCAST_KEYS", broadcast_keys)
    deliver(spark, lake, [raw_line("1")])
    silver.run_silver(spark, lake)
    path = write_lines(f"{lake.root}/raw/late.jsonl", [raw_line("1", 0), raw_line("9", 0), raw_line(None, 0)])
    bronze.append_new_events(spark, read_events(spark, path), lake, [datetime.date(1970, 1, 1)])
    assert stored_bronze(spark, lake).count() == 4
    counts = silver.run_silver(spark, lake)
    assert (counts["valid_events"], counts["quarantined_events"]) == (0, 2)
    assert as_set(stored_quarantine(spark, lake), "event_id") == {("9",), (None,)}


def test_silver_reads_only_the_days_of_new_ids(spark, lake):
    later = SECOND + 30 * 86_400
    deliver(spark, lake, [raw_line("1"), raw_line("2", SECOND + 86_400)])
    silver.run_silver(spark, lake)
    deliver(spark, lake, [raw_line("3", later), raw_line("4", None), raw_line(None, 5)], "b.jsonl")
    bronze_rows, done = stored_bronze(spark, lake), stored_silver(spark, lake).select("event_id")
    rows = silver.rows_of(bronze_rows, silver.fresh_ids(bronze_rows, done))
    assert as_set(rows, "id", "timestamp") == {("3", later), ("4", None), (None, 5)}
    shown = plan(rows)
    assert re.search(r"PartitionFilters: \[\(+event_date#\d+ = 2023-12-14", shown)
    assert "PushedFilters: [IsNull(id)]" in shown
    counts = silver.run_silver(spark, lake)
    assert (counts["valid_events"], counts["quarantined_events"]) == (1, 2)


def test_quarantine_does_not_depend_on_how_deliveries_are_cut(spark, tmp_path):
    lines = [
        raw_line(None, 5, " X "), raw_line(None, 5, "x"), raw_line(None, 5, "x"), raw_line("1", 0),
    ]
    whole, cut = Lake(str(tmp_path / "whole")), Lake(str(tmp_path / "cut"))
    deliver(spark, whole, lines)
    silver.run_silver(spark, whole)
    for step, part in enumerate((lines[:1], lines[1:], lines)):
        deliver(spark, cut, part, f"{step}.jsonl")
        silver.run_silver(spark, cut)
    for lake in (whole, cut):
        assert stored_bronze(spark, lake).count() == 4
        assert stored_quarantine(spark, lake).count() == 4


def test_quarantined_ids_are_not_looked_at_again(spark, lake):
    deliver(spark, lake, [raw_line("1"), raw_line("2", None), raw_line("3", user_id=None)])
    silver.run_silver(spark, lake)
    rows, done = stored_bronze(spark, lake), stored_silver(spark, lake)
    held = read_table(spark, lake.quarantined_events, QUARANTINED_EVENT)
    assert silver.fresh_ids(rows, done, held).count() == 0
    assert as_set(silver.fresh_ids(rows, done), "event_id") == {("2",), ("3",)}
    # Nothing but the rows without an id is read whole.
    assert "PushedFilters: [IsNull(id)]" in plan(silver.rows_of(rows, silver.fresh_ids(rows, done, held)))


def test_good_rows_behind_quarantined_ones_are_found(spark, lake):
    """A run that died after it wrote the quarantine."""
    deliver(spark, lake, [raw_line("0")])
    silver.run_silver(spark, lake)
    deliver(spark, lake, [raw_line("1"), raw_line("1", user_id=None), raw_line("2", 0)], "b.jsonl")
    _, rejected = silver.new_events(spark, lake)
    append_partitioned(rejected, lake.quarantined_events, "event_date")
    counts = silver.run_silver(spark, lake)
    assert (counts["valid_events"], counts["quarantined_events"]) == (1, 0)


def test_silver_within_days(spark, lake):
    deliver(spark, lake, [raw_line("1"), raw_line("2", SECOND + 86_400)])
    counts = silver.run_silver(spark, lake, dates=[DAY])
    assert counts["valid_events"] == 1
    assert as_set(stored_silver(spark, lake), "event_id", "event_date") == {("1", DAY)}
    assert silver.run_silver(spark, lake, dates=[DAY])["valid_events"] == 0
    assert silver.run_silver(spark, lake)["valid_events"] == 1


def test_first_run_without_any_event(spark, lake):
    counts = silver.run_silver(spark, lake)
    assert set(counts.values()) == {0}
    silver.write_enriched(spark, lake)
    assert gold.run_gold(spark, lake).count() == 0


def test_maps(spark, lake):
    path = write_lines(
        f"{lake.root}/raw/maps.jsonl",
        [
            '{"id": "a", "name": " Lake "}',
            '{"id": "a", "name": "Zoo"}',
            '{"id": "b", "name": " "}',
            '{"id": "c"}',
            '{"name": "Desert"}',
            '{"id": "d", ',
        ],
    )
    assert bronze.refresh_maps(spark, path, lake) == 6
    assert read_table(spark, lake.bronze_maps, BRONZE_MAP).count() == 6
    counts = silver.run_silver(spark, lake)
    assert (counts["valid_maps"], counts["quarantined_maps"]) == (1, 4)
    good = read_table(spark, lake.silver_maps, SILVER_MAP)
    assert as_set(good, "map_id", "map_name") == {("a", "Lake")}
    bad = read_table(spark, lake.quarantined_maps, SILVER_MAP)
    assert as_set(bad, "map_id", "validation_error") == {
        ("b", "invalid map_name"),
        ("c", "invalid map_name"),
        (None, "missing map_id"),
        (None, "malformed JSON"),
    }
    silver.run_silver(spark, lake)  # a refresh, not an append
    assert read_table(spark, lake.quarantined_maps, SILVER_MAP).count() == 4


def test_enriched_events(spark, lake):
    maps = write_lines(f"{lake.root}/raw/maps.jsonl", ['{"id": "a", "name": "Lake"}'])
    bronze.refresh_maps(spark, maps, lake)
    lines = [
        raw_line("1", map_id="a"), raw_line("2", map_id="z"), raw_line("3"),
        raw_line("4", SECOND + 86_400, map_id="a"),
    ]
    deliver(spark, lake, lines)
    silver.run_silver(spark, lake)
    silver.write_enriched(spark, lake)
    enriched = silver.read_enriched(spark, lake)
    assert enriched.columns[0] == "map_id" and enriched.columns[-1] == "map_name"
    expected = {("1", "a", "Lake"), ("2", "z", None), ("3", None, None), ("4", "a", "Lake")}
    assert as_set(enriched, "event_id", "map_id", "map_name") == expected
    deliver(spark, lake, [*lines, raw_line("5", map_id="a")])
    silver.run_silver(spark, lake)
    silver.write_enriched(spark, lake, dates=[DAY])
    assert as_set(silver.read_enriched(spark, lake), "event_id", "map_id", "map_name") == {
        *expected, ("5", "a", "Lake"),
    }


def test_gold_tables(spark, lake):
    maps = write_lines(f"{lake.root}/raw/maps.jsonl", ['{"id": "a", "name": "Lake"}'])
    bronze.refresh_maps(spark, maps, lake)
    place = dict(map_id="a", opponent_id="o")
    deliver(
        spark,
        lake,
        [
            raw_line("1", 10, "registration", username="ann", country="de"),
            raw_line("2", 20, "session_ping", state="started"),
            raw_line("3", 30, "match_start", **place),
            raw_line("4", 35, "match_finish", outcome=1, **place),
        ],
    )
    silver.run_silver(spark, lake)
    [row] = as_dicts(gold.run_gold(spark, lake))
    assert row == {
        "user_id": "u", "username": "ann", "country": "DE", "fav_map": "Lake",
        "fav_map_win_ratio": 1.0, "total_playtime": 5, "total_win_ratio": 1.0,
        "avg_matches_per_session": 1.0, "registration_date": datetime.date(1970, 1, 1),
        "data_quality_status": "valid",
    }
    assert spark.read.parquet(lake.user_map_stats).columns == [
        "user_id", "map_id", "map_matches", "map_wins", "map_win_ratio",
    ]
    deliver(
        spark,
        lake,
        [
            raw_line("5", 40, "match_start", **place),
            raw_line("6", 50, "match_finish", outcome=0, **place),
        ],
        "more.jsonl",
    )
    silver.run_silver(spark, lake)
    [row] = as_dicts(gold.run_gold(spark, lake, mode="watermark"))
    assert (row["total_playtime"], row["total_win_ratio"]) == (15, 0.5)


def match_events(spark, lake, lines, name):
    deliver(spark, lake, lines, name)
    silver.run_silver(spark, lake)
    return stage_events(stored_silver(spark, lake))


@pytest.mark.parametrize("broadcast_keys", [500_000, 0])
def test_watermark_skips_late_finishes_until_a_rebuild(
    spark, lake, tmp_path, monkeypatch, broadcast_keys
):
    monkeypatch.setattr(gold, "BROADCAST_KEYS", broadcast_keys)
    table = str(tmp_path / "matches")
    place = dict(map_id="a", opponent_id="o")
    other = dict(map_id="b", opponent_id="o")
    first = [
        raw_line("s1", 10, "match_start", **place),
        raw_line("f1", 20, "match_finish", outcome=1, **place),
        raw_line("s2", 30, "match_start", **place),
        raw_line("f2", 40, "match_finish", outcome=1, **place),
        raw_line("g1", 39, "match_finish", outcome=1, **other),
    ]
    events = match_events(spark, lake, first, "a.jsonl")
    keys = ("map_id", "match_number", "start_timestamp", "finish_timestamp")
    assert as_set(gold.update_matches(events, table), *keys) == {("a", 1, 10, 20), ("a", 2, 30, 40)}

    second = [
        raw_line("f0", 15, "match_finish", outcome=0, **place),  # late: shifts all ordinals
        raw_line("t1", 12, "match_start", **other),  # late start of a known finish
        raw_line("s3", 50, "match_start", **place),
        raw_line("f3", 60, "match_finish", outcome=1, **place),
    ]
    events = match_events(spark, lake, second, "b.jsonl")
    updated = gold.update_matches(events, table, mode="watermark")
    # Ordinal 3 is now the pair (50, 40), dropped, and the finish at 60 is the fourth.
    assert as_set(updated, *keys) == {("a", 1, 10, 20), ("a", 2, 30, 40)}
    rebuilt = gold.update_matches(events, table, mode="full")
    assert as_set(rebuilt, *keys) == {("a", 1, 10, 15), ("b", 1, 12, 39)}

    third = [raw_line("s4", 55, "match_start", **place)]
    events = match_events(spark, lake, third, "c.jsonl")
    updated = gold.update_matches(events, table, mode="watermark")
    assert as_set(updated, *keys) == {("a", 1, 10, 15), ("b", 1, 12, 39), ("a", 4, 55, 60)}
    with pytest.raises(ValueError):
        gold.update_matches(events, table, mode="other")


def test_upsert_replaces_equal_keys(spark, tmp_path):
    def row(number, finish):
        return ("u", "m", "o", 1, number, 0, finish, finish, 1.0, 1)

    table = str(tmp_path / "matches")
    publish(spark.createDataFrame([row(1, 10), row(2, 20)], MATCH), table)
    stored = read_current(spark, table, MATCH)
    delta = spark.createDataFrame([row(2, 25), row(3, 30)], MATCH)
    assert as_set(upsert(stored, delta, MATCH_KEY), "match_number", "finish_timestamp") == {
        (1, 10), (2, 25), (3, 30),
    }
    gold._merge(delta, stored, table)
    assert current_path(spark, table).endswith("version=1")
    merged = read_current(spark, table, MATCH)
    assert as_set(merged, "match_number", "finish_timestamp") == {(1, 10), (2, 25), (3, 30)}
    gold._merge(spark.createDataFrame([row(4, 40)], MATCH), merged, table)
    assert current_path(spark, table).endswith("version=1")  # appended, not rewritten
    assert read_current(spark, table, MATCH).count() == 4
    assert watermark(read_current(spark, table, MATCH), "finish_timestamp").first().watermark == 40
    assert watermark(merged.filter("false"), "finish_timestamp").first().watermark == 0


def test_unfinished_delta_is_not_read(spark, tmp_path):
    """A watermark update that died leaves the next one all it had to add."""
    events = spark.createDataFrame(
        [
            (str(i), at, kind, "u", None, "m", "o", 1.0 if kind == "match_finish" else None)
            for i, (at, kind) in enumerate(
                [(1, "match_start"), (2, "match_finish"), (3, "match_start"), (4, "match_finish"),
                 (5, "match_start"), (6, "match_finish")]
            )
        ],
        "event_id string, timestamp long, event_type string, user_id string, "
        "session_state string, map_id string, opponent_id string, outcome double",
    )
    table = str(tmp_path / "matches")
    gold.update_matches(events.filter("timestamp <= 2"), table)
    half = gold.matches(events).filter("finish_timestamp = 6")
    half.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{table}/delta=0-0")
    assert gold.update_matches(events, table, mode="watermark").count() == 3
    assert current_path(spark, table).endswith("version=0")
    assert (tmp_path / "matches/delta=0-1/_SUCCESS").exists()
    assert gold.update_matches(events, table, mode="watermark").count() == 3
    gold.update_matches(events, table)
    gold.update_matches(events, table)
    prune(spark, table)
    assert not list((tmp_path / "matches").glob("delta=*"))


def test_unfinished_version_is_not_read(spark, tmp_path):
    table = str(tmp_path / "t")
    publish(spark.range(1).select(F.col("id").cast("int")), table)
    (tmp_path / "t" / "version=1").mkdir()
    assert current_path(spark, table).endswith("version=0")
    assert publish(spark.range(2).select(F.col("id").cast("int")), table).endswith("version=2")
    assert current_path(spark, str(tmp_path / "none")) is None
    prune(spark, table, keep=3)
    assert len(list((tmp_path / "t").iterdir())) == 3
    prune(spark, table, keep=1)
    assert [path.name for path in (tmp_path / "t").iterdir()] == ["version=2"]


def flat_line(event_id, timestamp=5, event_type="x", user_id="u", user=None):
    record = dict(id=event_id, timestamp=timestamp, event_type=event_type, user_id=user_id, user=user)
    return json.dumps(record)


def test_flat_load_skips_what_is_no_object_and_appends(spark, tmp_path):
    lines = [
        flat_line(1, user=dict(country="de", device_os="IOS", username=" a ")),
        flat_line(1, user=dict(country="DE ", device_os="ios", username="a")),
        flat_line(2, timestamp="soon"),
        flat_line(None),
        flat_line(3, user_id=None),
        flat_line(4, event_type=None),
        flat_line(5, event_type="  "),
        "[1, 2]",
        "7",
        "",
    ]
    raw = write_lines(tmp_path / "e.jsonl", lines)
    table = str(tmp_path / "bronze")
    loaded = flat.load_flat(spark, raw, table)
    assert loaded.columns == [
        "id", "timestamp", "event_type", "user_id", "country", "device_os", "username",
    ]
    assert loaded.count() == 7
    assert flat.load_flat(spark, raw, table).count() == 14
    cleaned = flat.rebuild_clean_flat(spark.read.parquet(table), str(tmp_path / "silver"))
    assert as_set(cleaned, "event_id", "timestamp", "event_type", "country", "username") == {
        ("1", 5, "x", "DE", "a"),
        ("2", None, "x", None, None),
        ("5", 5, "", None, None),
    }
    assert cleaned.count() == 3
    scanned = flat.scan_profiles(spark, raw)
    assert scanned.count() == 4


def test_flat_load_goes_by_the_kind_of_line(spark, tmp_path):
    lines = ['{"timestamp": "soon"}', '[{"id": "1"}, {"id": "2"}]', '{"id": "3", "id": "4"}', "{}", '{"id": ']
    loaded = flat.load_flat(
        spark, write_lines(tmp_path / "e.jsonl", lines), str(tmp_path / "bronze")
    )
    assert loaded.count() == 3
    assert loaded.filter("id IS NOT NULL").count() == 1


def test_top_level_map_variant(spark, tmp_path):
    line = '{"id": "1", "timestamp": 5, "event_type": " X ", "user_id": "u", "map_id": "m", "event_data": {"country": "de"}}'
    raw = read_json_lines(
        spark, write_lines(tmp_path / "e.jsonl", [line, "no"]), RAW_TOP_LEVEL_MAP_EVENT
    )
    flat_rows = clean_events(flatten_top_level_map(raw)).cache()
    checked = quality.validate(flat_rows, quality.event_rules())
    assert as_set(checked, "event_id", "event_type", "map_id", "country", "validation_error") == {
        ("1", "x", "m", "DE", "valid"),
        (None, None, None, None, "malformed JSON"),
    }


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, DAY), (2, None)], "n int, event_date date")
    assert append_partitioned(rows, path, "event_date") == 2
    assert append_partitioned(rows, path, "event_date") == 2
    assert spark.read.parquet(path).filter("event_date IS NULL").count() == 2
    assert in_dates(spark.read.parquet(path), [None]).count() == 2
    flat_path = str(tmp_path / "flat")
    append(rows, flat_path)
    append(rows, flat_path)
    assert spark.read.parquet(flat_path).count() == 4
    assert overwrite(rows, flat_path) == 2
    assert spark.read.parquet(flat_path).count() == 2
    assert read_table(spark, str(tmp_path / "none"), BRONZE_MAP) is None


def test_shared_folder_is_the_one_the_cluster_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == named.rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")

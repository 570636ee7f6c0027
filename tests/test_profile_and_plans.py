import re

import pytest
from rows import as_dicts, as_set, event, maps, plan, staged, write_lines

import __spark_entry__ as entries
from ludometry.checks.fixtures import game_events, game_maps
from ludometry.operators import enrich, profile, quality
from ludometry.operators.matches import matches
from ludometry.operators.mart import player_stats
from ludometry.schemas import RAW_MAP
from ludometry.sources.jsonlines import read_lines

SF = "/root/testdata/sf0.001"


def test_frequency_counts_null_and_breaks_ties(spark):
    frame = staged(
        spark,
        [event(str(i), i, "x", country=c) for i, c in enumerate(["B", "A", None, None, "C", "C", "C"])],
    )
    got = [tuple(row) for row in profile.frequency(frame, "country").collect()]
    assert got == [("C", 3), (None, 2), ("A", 1), ("B", 1)]


def test_distinct_values_and_counts_and_first_rows(spark):
    frame = staged(
        spark, [event(str(i), 9 - i, "x", country=c, username="n") for i, c in enumerate(["A", None, "A"])]
    )
    assert as_set(profile.distinct_values(frame, ["country", "username"]), "column_name", "value") == {
        ("country", "A"), ("username", "n"),
    }
    assert as_set(profile.row_counts({"all": frame, "none": frame.filter("false")}), "layer", "row_count") == {
        ("all", 3), ("none", 0),
    }
    assert [r.event_id for r in profile.first_rows(frame, 2, ["timestamp"]).collect()] == ["2", "1"]


def test_schema_profile(spark):
    frame = spark.createDataFrame([], RAW_MAP)
    assert as_dicts(profile.schema_profile(frame))[0] == {
        "position": 0, "column_name": "id", "data_type": "string", "nullable": True,
    }


def test_raw_field_profile(spark, tmp_path):
    lines = [
        '{"id": "1", "t": 5, "data": {"a": 1, "b": [1, 2], "c": {}}, "z": null}',
        "not json",
        "[1, 2]",
        "",
        '{"id": 2, "f": 1.5, "list": [1, "x", null], "yes": true, "data": {"a": "q"}, "e": []}',
        '{"id": "cut',
    ]
    got = profile.raw_field_profile(read_lines(spark, write_lines(tmp_path / "l", lines)))
    assert as_set(got, "path", "json_type", "row_count", "example") == {
        ("id", "string", 1, '"1"'),
        ("id", "number", 1, "2"),
        ("t", "number", 1, "5"),
        ("data", "object", 2, '{"a":"q"}'),
        ("data.a", "number", 1, "1"),
        ("data.a", "string", 1, '"q"'),
        ("data.b", "array", 1, "[1,2]"),
        ("data.c", "object", 1, "{}"),
        ("z", "null", 1, "null"),
        ("f", "number", 1, "1.5"),
        ("list", "array", 1, '[1,"x",null]'),
        ("list[0]", "number", 1, "1"),
        ("list[1]", "string", 1, '"x"'),
        ("list[2]", "null", 1, "null"),
        ("yes", "boolean", 1, "true"),
        ("e", "array", 1, "[]"),
    }


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_lookup_and_unknown_maps_with_and_without_broadcast(spark, threshold):
    """A third of the events name one map, more have none."""
    events = [event(str(i), 1, "x", map_id="a" if i % 3 == 0 else None) for i in range(60)]
    events += [event("z", 1, "x", map_id="gone"), event("n", 1, "x", map_id="unnamed")]
    frame, names = staged(spark, events), maps(spark, {"a": "Lake", "b": "Desert", "unnamed": None})
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        enriched = enrich.with_map_names(frame, names)
        assert enriched.count() == 62
        assert enriched.filter("map_name = 'Lake'").count() == 20
        assert as_set(enrich.unknown_maps(frame, names), "map_id") == {("gone",), ("unnamed",)}
        assert as_set(enrich.map_names(names), "map_name") == {("Lake",), ("Desert",), (None,)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_one_per_key_is_the_same_for_any_layout(spark):
    rows = [(str(i % 5), i % 7, str(i % 3) if i % 4 else None) for i in range(200)]
    frame = spark.createDataFrame(rows, "k string, a int, b string")
    picked = {
        frozenset(as_set(quality.one_per_key(frame.repartition(parts), "k", ["a", "b"]), "k", "a", "b"))
        for parts in (1, 3, 8)
    }
    assert len(picked) == 1 and len(next(iter(picked))) == 5


def test_small_maps_are_broadcast(spark):
    shown = plan(enrich.with_map_names(game_events(spark, SF), game_maps(spark, SF)))
    assert "BroadcastHashJoin" in shown and "LeftOuter" in shown


def test_matches_shuffle_once(spark):
    """One exchange by player serves both windows and the pairing; no join."""
    shown = plan(matches(game_events(spark, SF)))
    assert shown.count("Exchange") == 1
    assert "Join" not in shown


def test_favorite_is_trimmed_before_the_shuffle(spark):
    shown = plan(entries.queries()["favorite_maps"](spark, SF))
    assert shown.count("WindowGroupLimit") == 2


def test_copies_of_an_event_are_trimmed_before_the_shuffle(spark):
    """Many copies of one id leave each partition as one row."""
    shown = plan(quality.one_per_key(game_events(spark, SF), "event_id", ["timestamp", "user_id"]))
    assert shown.count("WindowGroupLimit") == 2
    assert shown.count("Exchange") == 1


def test_scan_reads_needed_columns_only(spark):
    frame = spark.read.parquet(f"{SF}/events.parquet")
    shown = plan(profile.frequency(frame, "event_type"))
    assert re.search(r"ReadSchema: struct<event_type:string>", shown)


def test_mart_has_no_cross_join_and_no_python(spark):
    shown = plan(player_stats(game_events(spark, SF), game_maps(spark, SF)))
    for unwanted in ("Cartesian", "NestedLoop", "Python", "Pandas"):
        assert unwanted not in shown

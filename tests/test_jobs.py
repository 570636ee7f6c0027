import pytest
from rows import as_set, raw_line, write_lines

from ludometry.__main__ import JOBS, parse, run
from ludometry.operators.running import HOT_ROWS
from ludometry.plans.gold import crowded_players, run_gold
from ludometry.plans.lake import Lake
from ludometry.plans.views import register_views


def test_arguments():
    assert parse(["root"]).jobs == JOBS
    assert [str(day) for day in parse(["root", "--date", "2024-01-02"]).dates] == ["2024-01-02"]
    with pytest.raises(SystemExit):
        parse(["root", "platinum"])


def test_all_jobs_and_their_views(spark, tmp_path, capsys):
    lake = Lake(str(tmp_path))
    write_lines(lake.raw_maps, ['{"id": "a", "name": "Lake"}'])
    place = dict(map_id="a", opponent_id="o")
    lines = [
        raw_line("1", 10, "registration", username="ann", country="de"),
        raw_line("2", 20, "session_ping", state="started"),
        raw_line("3", 30, "match_start", **place),
        raw_line("4", 35, "match_finish", outcome=1, map_id="gone", opponent_id="o"),
        raw_line("5", 36, "match_finish", outcome=1, **place),
        "not json",
    ]
    write_lines(lake.raw_events, lines)
    assert run(spark, parse([lake.root]))
    shown = capsys.readouterr().out
    assert "'new_events': 6" in shown and "'quarantined_events': 1" in shown
    assert "gone" in shown and "user_id_unique passed" in shown

    names = register_views(spark, lake)
    assert len(names) == 16
    counts = {name: spark.table(name).count() for name in names}
    assert counts == {
        "bronze_events": 6, "bronze_maps": 1, "silver_events": 5, "silver_maps": 1,
        "quarantine_events": 1, "quarantine_maps": 0, "stg_events": 5, "stg_maps": 1,
        "int_events_sessions": 5, "int_match_starts": 1, "int_match_finishes": 2,
        "int_matches": 1, "events_enriched": 5, "int_user_map_stats": 1, "int_user_totals": 1,
        "mart_player_stats": 1,
    }
    got = spark.sql("SELECT user_id, fav_map, total_playtime FROM mart_player_stats")
    assert as_set(got, "user_id", "fav_map", "total_playtime") == {("u", "Lake", 6)}

    # A player without a name breaks the mart's not-null test.
    write_lines(lake.raw_events, [*lines, raw_line("6", 40, "registration", "v")])
    assert not run(spark, parse([lake.root, "--matches", "watermark"]))
    assert "username_not_null FAILED: 1 rows" in capsys.readouterr().out


def test_stored_tables_are_registered_without_a_job(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    write_lines(lake.raw_events, [raw_line("1")])
    write_lines(lake.raw_maps, ['{"id": "m", "name": "Lake"}'])
    run(spark, parse([lake.root]))
    spark.sparkContext.setJobGroup("views", "registration of stored tables")
    try:
        register_views(spark, lake, names=["stg_events", "int_matches", "bronze_events"])
        assert spark.sparkContext.statusTracker().getJobIdsForGroup("views") == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_views_before_any_job(spark, tmp_path):
    names = register_views(spark, Lake(str(tmp_path / "none")))
    assert len(names) == 11
    assert all(spark.table(name).count() == 0 for name in names)


@pytest.mark.parametrize("hot_rows", [HOT_ROWS, 2])
def test_all_views_are_registered_without_a_job_once_gold_has_run(spark, tmp_path, hot_rows):
    lake = Lake(str(tmp_path / "lake"))
    place = dict(map_id="m", opponent_id="o")
    write_lines(lake.raw_events, [raw_line("1", 1, "match_start", **place), raw_line("2", 2, "match_finish", **place), raw_line("3", 3, "x")])
    write_lines(lake.raw_maps, ['{"id": "m", "name": "Lake"}'])
    run(spark, parse([lake.root, "bronze", "silver", "enrich"]))
    run_gold(spark, lake, hot_rows=hot_rows)
    assert crowded_players(spark, lake, hot_rows) == ([] if hot_rows == HOT_ROWS else [("u", 3)])
    assert crowded_players(spark, lake, 5) is None
    spark.sparkContext.setJobGroup(f"views {hot_rows}", "registration of all views")
    try:
        names = register_views(spark, lake, hot_rows)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"views {hot_rows}")
        assert (len(jobs) == 0) == (hot_rows == HOT_ROWS)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(names) == 16
    assert spark.table("int_match_starts").count() == spark.table("int_match_finishes").count() == 1
    assert spark.table("int_events_sessions").count() == 3

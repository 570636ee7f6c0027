"""Match tables in buckets: what an update rewrites, adds and leaves alone."""

import pytest
from pyspark.sql import functions as F

from ludometry.plans import gold
from ludometry.schemas import MATCH
from ludometry.sinks import versions
from ludometry.sinks.versions import bucket_count, bucket_name, current_folders, current_path, publish, read_current


def row(user, number, finish):
    return (user, "m", "o", 1, number, 0, finish, finish, 1.0, 1)


def as_pairs(rows):
    return {(r.user_id, r.match_number, r.finish_timestamp) for r in rows.collect()}


def files(folder):
    return {path: path.stat().st_mtime_ns for path in folder.rglob("*.parquet")}


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "matches")
    rows = [row(f"u{k}", n, 10 * n) for k in range(40) for n in (1, 2)]
    publish(spark.createDataFrame(rows, MATCH), path, by="user_id", count=4)
    return path


def merged(spark, path, rows):
    gold._merge(spark.createDataFrame(rows, MATCH), read_current(spark, path, MATCH), path)
    return read_current(spark, path, MATCH)


def test_a_colliding_key_leaves_other_buckets_alone(spark, table, tmp_path):
    assert bucket_count(spark, table) == 4
    before = files(tmp_path)
    players = spark.createDataFrame([(f"u{k}",) for k in range(40)], "user_id string").withColumn("b", bucket_name("user_id", 4))
    of = {r.user_id: r.b for r in players.collect()}
    other = next(user for user in of if of[user] != of["u0"])
    found = merged(spark, table, [row("u0", 2, 25), row("u0", 3, 30), row(other, 3, 31)])
    assert found.count() == 82
    assert {x for x in as_pairs(found) if x[0] in ("u0", other)} == {
        ("u0", 1, 10), ("u0", 2, 25), ("u0", 3, 30), (other, 1, 10), (other, 2, 20), (other, 3, 31),
    }
    after = files(tmp_path)
    assert {path: after[path] for path in before} == before  # nothing is rewritten in place
    fresh = {path.parent.name for path in after if path not in before and "whole" in str(path)}
    assert fresh == {f"bucket={of['u0']}"}
    read = current_folders(spark, table)
    assert f"{table}/version=0/bucket={of['u0']}" not in read
    assert f"{table}/version=0/bucket={of[other]}" in read
    # Once more: the second replacement stands for the first, and additions go on.
    found = merged(spark, table, [row("u0", 3, 33)])
    assert merged(spark, table, [row("u0", 4, 40), row("new", 1, 41)]).count() == 84
    assert {x for x in as_pairs(read_current(spark, table, MATCH)) if x[0] == "u0"} == {
        ("u0", 1, 10), ("u0", 2, 25), ("u0", 3, 33), ("u0", 4, 40),
    }
    assert current_path(spark, table).endswith("version=0")


def test_only_touched_buckets_are_read(spark, table):
    [folder] = current_folders(spark, table, ["1-of-4"])
    assert folder.endswith("version=0/bucket=1-of-4")
    assert read_current(spark, table, MATCH, []).count() == 0
    parts = [read_current(spark, table, MATCH, [f"{k}-of-4"]) for k in range(4)]
    assert sum(part.count() for part in parts) == 80


def test_an_unfinished_replacement_is_not_read(spark, table, tmp_path, monkeypatch):
    before = as_pairs(read_current(spark, table, MATCH))
    quiet = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    half = spark.createDataFrame([row("u0", 2, 99)], MATCH).withColumn("kind", F.lit("whole")).withColumn("bucket", bucket_name("user_id", 4))
    half.write.option(quiet, "false").partitionBy("kind", "bucket").parquet(f"{table}/replace=0-0")
    assert as_pairs(read_current(spark, table, MATCH)) == before
    found = merged(spark, table, [row("u0", 2, 21)])
    assert (tmp_path / "matches/replace=0-1/_SUCCESS").exists()
    assert as_pairs(found) == before - {("u0", 2, 20)} | {("u0", 2, 21)}


def test_many_changes_become_one_version(spark, table, monkeypatch):
    monkeypatch.setattr(gold, "MOST_CHANGES", 3)
    for step in range(3, 8):
        found = merged(spark, table, [row("u1", step, 10 * step), row("u2", 2, 100 + step)])
    assert found.count() == 85
    assert current_path(spark, table).endswith("version=1")
    assert bucket_count(spark, table) == 4
    assert versions.change_count(spark, table) == 2
    for _ in range(2):
        publish(read_current(spark, table, MATCH), table, by="user_id", count=4)
    versions.prune(spark, table, keep=1)
    assert len(current_folders(spark, table)) == 4 and read_current(spark, table, MATCH).count() == 85


def test_a_full_rebuild_keeps_two_versions(spark, tmp_path):
    events = spark.createDataFrame(
        [("1", 1, "match_start", "u", None, "m", "o", None), ("2", 2, "match_finish", "u", None, "m", "o", 1.0)],
        "event_id string, timestamp long, event_type string, user_id string, "
        "session_state string, map_id string, opponent_id string, outcome double",
    )
    path = str(tmp_path / "matches")
    for _ in range(4):
        assert gold.update_matches(events, path).count() == 1
    assert sorted(p.name for p in (tmp_path / "matches").iterdir()) == ["version=2", "version=3"]

"""Key tables, Bronze and Silver that look keys up in them, and Silver from new files."""

import re

import pytest
from pyspark.sql import functions as F
from test_layers import SILVER_LINES, deliver, lake, raw_line, stored_bronze, stored_quarantine, stored_silver  # noqa: F401

from ludometry.operators.increment import fits, without
from ludometry.plans import bronze, silver
from ludometry.schemas import SILVER_EVENT
from ludometry.sinks import keys
from ludometry.sources.tables import file_count, folder_names, read_or_empty
from ludometry.streaming.refine import refine_new_files, run_silver_of_new_files


def numbers(spark, low, high):
    return spark.range(low, high).select(F.concat(F.lit("k"), "id").alias("key"))


def jobs_of(spark, action):
    """How many Spark jobs an action starts, streams included."""
    group = spark.sparkContext.statusTracker().getJobIdsForGroup

    def last(name):
        spark.sparkContext.setJobGroup(name, name)
        spark.range(1).count()
        return max(group(name))

    before = last(f"before-{id(action)}")
    action()
    after = last(f"after-{id(action)}")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return after - before - (last(f"own-{id(action)}") - after)


def test_a_look_up_shuffles_the_batch_alone(spark, tmp_path):
    path = str(tmp_path / "keys")
    stored = keys.stored_keys(spark, path, lambda: numbers(spark, 0, 1_000).union(numbers(spark, 0, 10)), buckets=8)
    assert stored.count() == 1_000
    known = keys.known_among(numbers(spark, 990, 1_010), stored)
    assert {r.key for r in known.collect()} == {f"k{n}" for n in range(990, 1_000)}
    plan = known._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert len(re.findall(r"\bExchange\b", final)) == 1
    assert "Bucketed: true" in final and "Sort " not in final and "BroadcastExchange" not in final


def test_keys_are_added_and_rewritten(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keys, "FILES", 3)
    path = str(tmp_path / "keys")
    keys.publish_keys(numbers(spark, 0, 100), path, buckets=4)
    for step in range(1, 6):
        keys.add_keys(numbers(spark, 100 * step, 100 * step + 100), path)
    stored = keys.stored_keys(spark, path, pytest.fail)
    assert stored.count() == stored.distinct().count() == 600
    [folder] = folder_names(spark, path)
    assert folder != "version=0.buckets=4"
    assert file_count(spark, f"{path}/{folder}") <= 3 * 4 + 1


def test_keys_behind_their_table_are_made_anew(spark, tmp_path):
    path = str(tmp_path / "keys")
    keys.outdate(spark, path)  # nothing there to be behind
    assert folder_names(spark, path) is None
    keys.publish_keys(numbers(spark, 0, 10), path, buckets=2)
    with pytest.raises(RuntimeError), keys.changing(spark, path):
        raise RuntimeError("died between the rows and their keys")
    assert keys.is_changing(spark, path)
    assert keys.stored_keys(spark, path, lambda: numbers(spark, 0, 20)).count() == 20
    assert not keys.is_changing(spark, path)
    assert folder_names(spark, path) == ["version=1.buckets=2"]


def test_a_broadcast_is_bounded_in_characters(spark, monkeypatch):
    from ludometry.operators import increment

    rows = spark.createDataFrame([("a" * 1_000,), ("b",), (None,)], "key string")
    assert fits(rows, "key")
    assert not fits(rows, "key", most=2)
    monkeypatch.setattr(increment, "BROADCAST_CHARS", 1_000)
    assert not fits(rows, "key")
    assert without(rows, rows.filter("key = 'b'"), "key").count() == 2


def test_bronze_that_died_before_its_keys(spark, lake, monkeypatch):  # noqa: F811
    deliver(spark, lake, [raw_line("1")])
    deliver(spark, lake, [raw_line("1"), raw_line("2")], "b.jsonl")
    assert folder_names(spark, lake.bronze_keys)

    def die(*_):
        raise RuntimeError

    with monkeypatch.context() as broken:
        broken.setattr(bronze, "add_keys", die)
        with pytest.raises(RuntimeError):
            deliver(spark, lake, [raw_line("3"), "not json"], "c.jsonl")
    assert stored_bronze(spark, lake).count() == 4
    assert deliver(spark, lake, [raw_line("3"), "not json", raw_line("4")], "d.jsonl") == 1
    assert deliver(spark, lake, [raw_line("3"), "not json", raw_line("4")], "e.jsonl") == 0
    assert stored_bronze(spark, lake).count() == 5


def test_bronze_of_chosen_days_leaves_its_keys_behind(spark, lake):  # noqa: F811
    from ludometry.sources.jsonlines import read_events
    from test_layers import DAY, write_lines

    deliver(spark, lake, [raw_line("1")])
    deliver(spark, lake, [raw_line("2")], "b.jsonl")
    path = write_lines(f"{lake.root}/raw/c.jsonl", [raw_line("3"), raw_line("1")])
    assert bronze.append_new_events(spark, read_events(spark, path), lake, dates=[DAY]) == 1
    assert deliver(spark, lake, [raw_line("3"), raw_line("5")], "d.jsonl") == 1


def test_silver_of_new_files(spark, lake):  # noqa: F811
    assert set(run_silver_of_new_files(spark, lake).values()) == {0}
    deliver(spark, lake, SILVER_LINES)
    first = refine_new_files(spark, lake)
    assert first == {"valid_events": 2, "quarantined_events": 5}
    assert {(r.event_id, r.user_id) for r in stored_silver(spark, lake).collect()} == {("1", "a"), ("2", "u")}
    more = [*SILVER_LINES, raw_line("4"), raw_line("5", 0), raw_line(None, 9)]
    deliver(spark, lake, more, "b.jsonl")
    deliver(spark, lake, [raw_line("6")], "c.jsonl")
    assert refine_new_files(spark, lake) == {"valid_events": 2, "quarantined_events": 2}
    assert stored_silver(spark, lake).count() == 4
    assert stored_quarantine(spark, lake).count() == 7
    whole = silver.run_silver(spark, lake)
    assert (whole["valid_events"], whole["quarantined_events"]) == (0, 0)


def test_no_new_file_starts_no_job(spark, lake):  # noqa: F811
    deliver(spark, lake, SILVER_LINES)
    assert jobs_of(spark, lambda: refine_new_files(spark, lake)) > 0
    assert jobs_of(spark, lambda: refine_new_files(spark, lake)) == 0


def test_a_replayed_batch_adds_nothing(spark, lake, tmp_path, monkeypatch):  # noqa: F811
    deliver(spark, lake, SILVER_LINES)
    refine_new_files(spark, lake)
    deliver(spark, lake, [*SILVER_LINES, raw_line("4"), raw_line("4", user_id=None), raw_line("5", 0)], "b.jsonl")
    calls = []

    def die(*arguments):
        calls.append(arguments)
        if len(calls) == 2:  # quarantine is written with its keys, Silver without
            raise RuntimeError("died")
        return add(*arguments)

    add = silver.add_keys
    with monkeypatch.context() as broken:
        broken.setattr(silver, "add_keys", die)
        with pytest.raises(Exception, match="died"):
            refine_new_files(spark, lake)
    assert len(calls) == 2
    assert stored_silver(spark, lake).count() == 3
    assert refine_new_files(spark, lake) == {"valid_events": 0, "quarantined_events": 0}
    assert stored_silver(spark, lake).count() == 3
    assert stored_quarantine(spark, lake).count() == 7
    deliver(spark, lake, [raw_line("4"), raw_line("6")], "c.jsonl")
    assert refine_new_files(spark, lake) == {"valid_events": 1, "quarantined_events": 0}


def test_batch_and_new_files_in_turn(spark, lake):  # noqa: F811
    deliver(spark, lake, [raw_line("1"), raw_line("2", 0)])
    silver.run_silver(spark, lake)
    deliver(spark, lake, [raw_line("3"), raw_line("4", 0)], "b.jsonl")
    # All Bronze files are new to the stream.
    assert refine_new_files(spark, lake) == {"valid_events": 1, "quarantined_events": 1}
    deliver(spark, lake, [raw_line("5"), raw_line(None, 0)], "c.jsonl")
    silver.run_silver(spark, lake)
    deliver(spark, lake, [raw_line("6")], "d.jsonl")
    assert refine_new_files(spark, lake) == {"valid_events": 1, "quarantined_events": 0}
    rows = read_or_empty(spark, lake.silver_events, SILVER_EVENT)
    assert sorted(r.event_id for r in rows.collect()) == ["1", "3", "5", "6"]
    assert stored_quarantine(spark, lake).count() == 3


def test_bad_rows_of_accepted_ids_are_left_alone(spark, lake):  # noqa: F811
    import datetime

    from ludometry.sources.jsonlines import read_events
    from test_layers import write_lines

    deliver(spark, lake, [raw_line("1")])
    refine_new_files(spark, lake)
    path = write_lines(f"{lake.root}/raw/late.jsonl", [raw_line("1", 0), raw_line("9", 0), raw_line(None, 0)])
    bronze.append_new_events(spark, read_events(spark, path), lake, [datetime.date(1970, 1, 1)])
    assert refine_new_files(spark, lake) == {"valid_events": 0, "quarantined_events": 2}
    assert {r.event_id for r in stored_quarantine(spark, lake).collect()} == {"9", None}

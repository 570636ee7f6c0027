"""Refreshed tables stay readable until the new one is whole."""

import pytest
from pyspark.sql import functions as F
from rows import as_set, raw_line, write_lines

from ludometry.plans import bronze, gold, silver
from ludometry.plans.lake import Lake
from ludometry.sinks.tables import overwrite, overwrite_partitions
from ludometry.sources.jsonlines import read_events
from ludometry.sources.tables import NEXT, OLD, folder_names, read_or_empty, read_table, rename, stored_path

SCHEMA = "n int, day int"


def broken(rows):
    """Rows whose write fails after some of them are written."""
    failing = F.when(F.col("n") == 2, F.raise_error(F.lit("died"))).otherwise(F.lit("").cast("void"))
    return rows.filter(F.coalesce(failing.cast("string"), F.lit("")) == "")


def schema_of(spark):
    return spark.createDataFrame([], SCHEMA).schema


def numbers(spark, *values):
    return spark.createDataFrame([(n, n % 2) for n in values], SCHEMA).repartition(4)


@pytest.mark.parametrize("by", [None, "day"])
def test_a_write_that_dies_leaves_the_old_table(spark, tmp_path, by):
    path = str(tmp_path / "t")

    def refresh(rows):
        return overwrite(rows, path) if by is None else overwrite_partitions(rows, path, by)

    refresh(numbers(spark, 1, 3))
    with pytest.raises(Exception, match="died"):
        refresh(broken(numbers(spark, 1, 2, 3, 4)))
    schema = schema_of(spark)
    assert as_set(read_table(spark, path, schema), "n") == {(1,), (3,)}
    refresh(numbers(spark, 5))
    assert as_set(read_table(spark, path, schema), "n") == {(5,)}
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_a_refresh_that_died_between_its_renames_is_finished(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite(numbers(spark, 1), path)
    numbers(spark, 2).write.parquet(path + NEXT)
    rename(spark, path, path + OLD)
    assert as_set(read_table(spark, path, schema_of(spark)), "n") == {(2,)}
    rename(spark, path, path + OLD + "er")
    assert as_set(read_table(spark, path, schema_of(spark)), "n") == {(1,)}  # no new one: the old one again
    assert stored_path(spark, str(tmp_path / "none")) is None


def test_an_unfinished_next_table_is_not_taken(spark, tmp_path):
    path = str(tmp_path / "t")
    numbers(spark, 2).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path + NEXT)
    assert read_table(spark, path, schema_of(spark)) is None
    assert overwrite(numbers(spark, 3), path) == 1
    assert as_set(read_table(spark, path, schema_of(spark)), "n") == {(3,)}


def test_a_table_may_be_refreshed_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite(numbers(spark, 1, 2, 3), path)
    overwrite(spark.read.parquet(path).filter("n > 1"), path)
    assert as_set(spark.read.parquet(path), "n") == {(2,), (3,)}


def test_a_mart_that_dies_half_way(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path / "lake"))
    raw = write_lines(f"{lake.root}/raw/a.jsonl", [raw_line("1", event_type="registration", username="ann")])
    bronze.append_new_events(spark, read_events(spark, raw), lake)
    silver.run_silver(spark, lake)
    assert gold.run_gold(spark, lake).count() == 1

    def died(*arguments):
        return rows_of(*arguments).withColumn("country", F.raise_error(F.lit("died")).cast("string"))

    rows_of = gold.mart_rows
    with monkeypatch.context() as half:
        half.setattr(gold, "mart_rows", died)
        with pytest.raises(Exception, match="died"):
            gold.run_gold(spark, lake)
    mart = spark.read.parquet(stored_path(spark, lake.player_stats))
    assert as_set(mart, "username") == {("ann",)}
    assert gold.run_gold(spark, lake).count() == 1
    assert not [name for name in folder_names(spark, f"{lake.root}/gold") if name.endswith((NEXT, OLD))]
    assert read_or_empty(spark, lake.player_stats, mart.schema).count() == 1

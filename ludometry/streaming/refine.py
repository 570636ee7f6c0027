"""Silver from the files that Bronze gained.

The batch pass compares all ids of Bronze with those of Silver and quarantine.
This one keeps the list of Bronze files it has seen in a checkpoint and refines
the rows of new ones only; without a new file no job runs. A batch that is
replayed after a failure adds nothing twice, because its ids are looked up.

It must not run while Bronze is written: copies of an event stand in the files of
one Bronze append, and the smallest of all of them is the one that Silver takes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from ludometry.plans.lake import Lake
from ludometry.plans.silver import append_refined, refresh_maps
from ludometry.schemas import BRONZE_EVENT
from ludometry.sources.tables import folder_names


def refine_new_files(
    spark: SparkSession, lake: Lake, progress: str | None = None, at: Column | None = None
) -> dict[str, int]:
    """Refine all Bronze files that came since the last call; returns the rows written.

    ``progress`` is the checkpoint folder, ``lake.silver_progress`` by default.
    A lake that the batch pass served before is looked through once, and nothing
    is added twice; both may be used in turn.
    """
    added = {"quarantined_events": 0, "valid_events": 0}

    def add(batch: DataFrame, _: int) -> None:
        for name, rows in append_refined(batch.sparkSession, batch, lake, at).items():
            added[name] += rows

    if folder_names(spark, lake.bronze_events) is not None:
        query = (
            spark.readStream.schema(BRONZE_EVENT)
            .parquet(lake.bronze_events)
            .writeStream.foreachBatch(add)
            .option("checkpointLocation", progress or lake.silver_progress)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return added


def run_silver_of_new_files(spark: SparkSession, lake: Lake, at: Column | None = None) -> dict[str, int]:
    """One pass over the new files of Bronze, and the maps anew; returns the rows written."""
    return {**refine_new_files(spark, lake, at=at), **refresh_maps(spark, lake, at)}

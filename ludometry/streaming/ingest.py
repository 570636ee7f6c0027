"""Bronze ingestion that reads every raw file once.

The batch job parses the whole raw folder each time and drops what Bronze
already holds. This one keeps the list of files it has seen in a checkpoint
and gives only new files to the same Bronze append. A batch that is replayed
after a failure adds nothing twice, because the append is keyed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ludometry.plans.bronze import append_new_events
from ludometry.plans.lake import Lake
from ludometry.schemas import CORRUPT, RAW_EVENT


def ingest_new_files(
    spark: SparkSession,
    raw_folder: str,
    lake: Lake,
    progress: str,
    files_per_batch: int | None = None,
) -> int:
    """Process all files that arrived since the last call, then stop; returns the rows appended.

    ``progress`` is the query's checkpoint folder, one per raw folder.
    """
    reader = (
        spark.readStream.schema(RAW_EVENT)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    added = [0]

    def add(batch: DataFrame, _: int) -> None:
        added[0] += append_new_events(batch.sparkSession, batch, lake)

    query = (
        reader.json(raw_folder)
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return added[0]

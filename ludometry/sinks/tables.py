"""Appends and full refreshes of Parquet tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ludometry.session import scratch_path
from ludometry.sources.tables import NEXT, discard, settle, swap_in


def append_partitioned(rows: DataFrame, path: str, by: str) -> int:
    """Append in partitions of ``by``; returns the number of rows written.

    Rebalancing gathers each day into files of the advised size and splits a
    day that is too large for one task. The rows are counted while they are
    written, after the last shuffle. An empty frame adds no data file, so no
    job has to ask first whether there is anything to write.
    """
    written = Observation()
    balanced = rows.hint("rebalance", F.col(by))
    (
        balanced.observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("append")
        .partitionBy(by)
        .parquet(path)
    )
    return written.get["rows"]


def append(rows: DataFrame, path: str) -> None:
    """Create the table if it is absent, then append."""
    rows.write.mode("append").parquet(path)


def overwrite(rows: DataFrame, path: str) -> int:
    """Replace the whole table, which stays readable until the new one is whole.

    ``rows`` may read from it. A query that is running on the old table loses its files.
    """
    spark = rows.sparkSession
    settle(spark, path)
    written = Observation()
    counted = rows.observe(written, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").parquet(path + NEXT)
    swap_in(spark, path)
    return written.get["rows"]


def overwrite_partitions(rows: DataFrame, path: str, by: str, only_present: bool = False) -> None:
    """Replace a partitioned table as ``overwrite`` does, or only the partitions that ``rows`` holds.

    Those are replaced one by one at the end of the write.
    """
    spark = rows.sparkSession
    settle(spark, path)
    writer = rows.hint("rebalance", F.col(by)).write.mode("overwrite").partitionBy(by)
    if only_present:
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)
        return
    writer.option("partitionOverwriteMode", "static").parquet(path + NEXT)
    swap_in(spark, path)


@contextmanager
def landed(rows: DataFrame, label: str) -> Iterator[DataFrame]:
    """The rows as a table of the shared folder, which is deleted after the block."""
    spark = rows.sparkSession
    path = scratch_path(spark, label)
    try:
        rows.write.parquet(path)
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        discard(spark, path)

"""Parquet layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ludometry.schemas import STAGED_EVENT, STAGED_MAP


def _file_system(spark: SparkSession, path: str) -> tuple:
    """The Hadoop file system of a path, and the path as it knows it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def folder_names(spark: SparkSession, path: str) -> list[str] | None:
    """Names in a folder of any file system Hadoop knows, None where it is absent."""
    files, folder = _file_system(spark, path)
    if not files.exists(folder):
        return None
    return [status.getPath().getName() for status in files.listStatus(folder)]


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that is no longer read."""
    files, folder = _file_system(spark, path)
    files.delete(folder, True)


def touch(spark: SparkSession, path: str) -> None:
    """Make an empty file, and the folders above it."""
    files, file = _file_system(spark, path)
    files.create(file, True).close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text that the driver knows, in the place of an earlier one."""
    files, file = _file_system(spark, path)
    stream = files.create(file, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text, read by the driver without a job; None where there is none."""
    files, file = _file_system(spark, path)
    if not files.exists(file):
        return None
    stream = files.open(file)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def file_count(spark: SparkSession, path: str) -> int:
    """Files in a folder and those below it."""
    files, folder = _file_system(spark, path)
    return files.getContentSummary(folder).getFileCount()


# A refreshed table is written beside its path and then renamed into it.
NEXT, OLD = ".next", ".old"


def settle(spark: SparkSession, path: str) -> None:
    """Finish or undo a refresh that ended between its two renames."""
    if folder_names(spark, path) is not None:
        return
    for beside in (NEXT, OLD):
        if "_SUCCESS" in (folder_names(spark, path + beside) or []):
            rename(spark, path + beside, path)
            return


def swap_in(spark: SparkSession, path: str) -> None:
    """Put the complete table at ``path`` + NEXT in the place of the one at ``path``.

    The old one is there until the new one is whole. Between the two renames there is
    none; ``settle`` mends that, should the job end just there.
    """
    discard(spark, path + OLD)
    if folder_names(spark, path) is not None:
        rename(spark, path, path + OLD)
    rename(spark, path + NEXT, path)
    discard(spark, path + OLD)


def rename(spark: SparkSession, path: str, target: str) -> None:
    files, folder = _file_system(spark, path)
    if not files.rename(folder, _file_system(spark, target)[1]):
        raise OSError(f"cannot rename {path} to {target}")


def stored_path(spark: SparkSession, path: str) -> str | None:
    """The path of a refreshed table, or None where there is none yet."""
    settle(spark, path)
    return None if folder_names(spark, path) is None else path


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The table with its declared schema, or None where it does not exist yet.

    Partition columns are part of the schema and need no inference.
    """
    if stored_path(spark, path) is None:
        return None
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """As :func:`read_table`, with no rows where the table does not exist yet."""
    found = read_table(spark, path, schema)
    return spark.createDataFrame([], schema) if found is None else found


def stage_events(silver_events: DataFrame) -> DataFrame:
    """The columns that the statistics read."""
    return silver_events.select(*STAGED_EVENT.fieldNames())


def stage_maps(silver_maps: DataFrame) -> DataFrame:
    return silver_maps.select(*STAGED_MAP.fieldNames())

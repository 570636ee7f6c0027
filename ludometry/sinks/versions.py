"""Tables that are rewritten from their own content.

A Parquet path cannot be replaced by a plan that reads it. Each rewrite goes
to a new ``version=N`` folder; readers take the highest one that Spark marked
complete, so a job that dies half-way leaves the table as it was. Changes to a
version are folders of their own, numbered in one order and read under the same
rule: files put into the version itself would become visible one by one.
``delta=N-K`` holds rows that are added, ``replace=N-K`` whole buckets, and rows that
are added at the same moment.

A bucketed version has a folder ``bucket=B-of-M`` for every hash of a column. A
whole bucket takes the place of what the version and earlier changes hold of it;
all other buckets stay the files they were.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ludometry.sources.tables import discard, folder_names

PREFIX = "version="
DELTA, REPLACE, BUCKET = "delta=", "replace=", "bucket="
WHOLE, ADDED = "whole", "added"


def _versions(spark: SparkSession, path: str) -> list[int]:
    names = folder_names(spark, path) or []
    return sorted(int(name[len(PREFIX) :]) for name in names if name.startswith(PREFIX))


def _changes(spark: SparkSession, path: str, version: int) -> list[tuple[int, str]]:
    """Numbers and folders of the changes to a version in order, unfinished ones among them."""
    starts = (f"{DELTA}{version}-", f"{REPLACE}{version}-")
    names = folder_names(spark, path) or []
    return sorted((int(name.rpartition("-")[2]), name) for name in names if name.startswith(starts))


def _is_complete(spark: SparkSession, folder: str) -> bool:
    return "_SUCCESS" in folder_names(spark, folder)


def _complete(spark: SparkSession, path: str) -> list[int]:
    return [
        number
        for number in _versions(spark, path)
        if _is_complete(spark, f"{path}/{PREFIX}{number}")
    ]


def current_path(spark: SparkSession, path: str) -> str | None:
    complete = _complete(spark, path)
    return f"{path}/{PREFIX}{complete[-1]}" if complete else None


def _buckets(spark: SparkSession, folder: str) -> list[str]:
    return [name for name in folder_names(spark, folder) if name.startswith(BUCKET)]


def bucket_count(spark: SparkSession, path: str) -> int | None:
    """Buckets of the current version; None if it has none, being empty or not bucketed."""
    names = _buckets(spark, current_path(spark, path))
    return int(names[0].rpartition("-of-")[2]) if names else None


def bucket_name(column: str, count: int) -> Column:
    """The bucket of a row, as folders are named."""
    return F.concat(F.pmod(F.xxhash64(column), F.lit(count)).cast("string"), F.lit(f"-of-{count}"))


def current_folders(spark: SparkSession, path: str, buckets: Sequence[str] | None = None) -> list[str] | None:
    """The folders that make up the current table, or some buckets of it; None if there is no table."""
    complete = _complete(spark, path)
    if not complete:
        return None
    parts: list[tuple[int, str, str]] = [(-1, PREFIX, f"{path}/{PREFIX}{complete[-1]}")]
    for n, name in _changes(spark, path, complete[-1]):
        folder = f"{path}/{name}"
        if not _is_complete(spark, folder):
            continue
        if name.startswith(DELTA):
            parts.append((n, ADDED, folder))
        else:
            kinds = folder_names(spark, folder)
            parts.extend((n, kind, f"{folder}/kind={kind}") for kind in (WHOLE, ADDED) if f"kind={kind}" in kinds)
    held = {folder: _buckets(spark, folder) for _, _, folder in parts}
    # Of every bucket, the last change that replaced it.
    replaced = {own: n for n, kind, folder in parts if kind == WHOLE for own in held[folder]}
    found = []
    for n, _, folder in parts:
        if not held[folder]:  # not bucketed
            found.append(folder)
        found.extend(
            f"{folder}/{bucket}"
            for bucket in held[folder]
            if n >= replaced.get(bucket, -1) and (buckets is None or bucket[len(BUCKET) :] in buckets)
        )
    return found


def read_current(
    spark: SparkSession, path: str, schema: T.StructType, buckets: Sequence[str] | None = None
) -> DataFrame | None:
    """The current table; with ``buckets``, as ``bucket_name`` has them, no other bucket is read."""
    folders = current_folders(spark, path, buckets)
    if folders is None:
        return None
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def _write(rows: DataFrame, target: str, by: str | None, count: int) -> str:
    if by is None:
        rows.write.mode("errorifexists").parquet(target)
    else:
        # A bucket is one file of the advised size, or several.
        bucketed = rows.withColumn("bucket", bucket_name(by, count)).hint("rebalance", F.col("bucket"))
        bucketed.write.mode("errorifexists").partitionBy("bucket").parquet(target)
    return target


def publish(rows: DataFrame, path: str, by: str | None = None, count: int = 1) -> str:
    """Write ``rows`` as the next version, in ``count`` buckets of ``by`` if given; they may read the current one."""
    every = _versions(rows.sparkSession, path)
    return _write(rows, f"{path}/{PREFIX}{every[-1] + 1 if every else 0}", by, count)


def _next_change(spark: SparkSession, path: str, kind: str) -> str:
    version = _complete(spark, path)[-1]
    taken = [number for number, _ in _changes(spark, path, version)]
    return f"{path}/{kind}{version}-{max(taken, default=-1) + 1}"


def extend(rows: DataFrame, path: str, by: str | None = None) -> str:
    """Add ``rows`` to the current version, all of them at one moment."""
    spark = rows.sparkSession
    count = None if by is None else bucket_count(spark, path)
    return _write(rows, _next_change(spark, path, DELTA), by if count else None, count or 1)


def replace_buckets(whole: DataFrame, added: DataFrame, path: str, by: str) -> str:
    """Put ``whole`` in the place of the buckets it lies in, and add ``added``, at one moment.

    ``added`` has no row of a bucket that is replaced.
    """
    spark = whole.sparkSession
    target, count = _next_change(spark, path, REPLACE), bucket_count(spark, path)
    rows = whole.withColumn("kind", F.lit(WHOLE)).unionByName(added.withColumn("kind", F.lit(ADDED)))
    bucketed = rows.withColumn("bucket", bucket_name(by, count)).hint("rebalance", F.col("bucket"))
    bucketed.write.mode("errorifexists").partitionBy("kind", "bucket").parquet(target)
    return target


def state(spark: SparkSession, path: str) -> str | None:
    """A name for what the current table holds: its version and its last complete change."""
    complete = _complete(spark, path)
    if not complete:
        return None
    done = [n for n, name in _changes(spark, path, complete[-1]) if _is_complete(spark, f"{path}/{name}")]
    return f"{complete[-1]}-{max(done, default=-1)}"


def change_count(spark: SparkSession, path: str) -> int:
    """Changes that the current version has gathered."""
    return len(_changes(spark, path, _complete(spark, path)[-1]))


def prune(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete versions older than the ``keep`` newest complete ones.

    Two by default, since a running reader may still hold the one before.
    """
    complete = _complete(spark, path)
    if len(complete) < keep:
        return
    for number in _versions(spark, path):
        if number < complete[-keep]:
            for _, name in _changes(spark, path, number):
                discard(spark, f"{path}/{name}")
            discard(spark, f"{path}/{PREFIX}{number}")

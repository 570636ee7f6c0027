"""Key tables: the keys of a stored table alone, in buckets, so that batches are looked up cheaply.

A batch is shuffled by key to the buckets; what is stored is neither shuffled nor
sorted, however much it is. Each key table stands beside the table it describes, as
``version=N.buckets=M`` folders of which the highest complete one counts.

Rows and keys are two writes. The change of both is marked before the first and
unmarked after the second. A mark that is found later tells of a job that died in
between; then the keys are made anew from the table, which is the truth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludometry.sources.tables import discard, file_count, folder_names, touch

# Files a bucket may gather before the table is rewritten.
FILES = 32
VERSION, MARK = "version=", "_changing"


def _versions(spark: SparkSession, path: str) -> list[tuple[int, int, str]]:
    """(number, buckets, folder) of the complete versions, in order."""
    found = []
    for name in folder_names(spark, path) or []:
        if name.startswith(VERSION) and "_SUCCESS" in folder_names(spark, f"{path}/{name}"):
            number, buckets = name[len(VERSION) :].split(".buckets=")
            found.append((int(number), int(buckets), f"{path}/{name}"))
    return sorted(found)


def _table(spark: SparkSession, folder: str, buckets: int) -> str:
    """The folder as a bucketed table of this session's catalog; returns its name."""
    name = f"ludometry_keys_{hashlib.md5(folder.encode()).hexdigest()}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (key STRING) USING parquet "
        f"CLUSTERED BY (key) SORTED BY (key) INTO {buckets} BUCKETS LOCATION '{folder}'"
    )
    spark.catalog.refreshTable(name)  # other sessions write to the folder too
    return name


def _insert(keys: DataFrame, folder: str, buckets: int) -> None:
    name = _table(keys.sparkSession, folder, buckets)
    keys.select("key").write.insertInto(name)


def is_changing(spark: SparkSession, path: str) -> bool:
    return MARK in (folder_names(spark, path) or [])


@contextmanager
def changing(spark: SparkSession, path: str) -> Iterator[None]:
    """Marks the keys at ``path`` as behind their table until the block has ended well."""
    touch(spark, f"{path}/{MARK}")
    yield
    discard(spark, f"{path}/{MARK}")


def outdate(spark: SparkSession, path: str) -> None:
    """Mark keys, where there are any, that a write to their table left behind."""
    if folder_names(spark, path) is not None:
        touch(spark, f"{path}/{MARK}")


def publish_keys(keys: DataFrame, path: str, buckets: int | None = None) -> None:
    """Write the distinct ``key`` of some rows as the next version, and drop older ones.

    By default there are as many buckets as the session has shuffle partitions.
    """
    spark = keys.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = [name for name in folder_names(spark, path) or [] if name.startswith(VERSION)]
    number = max((int(name[len(VERSION) :].split(".")[0]) for name in names), default=-1) + 1
    distinct = keys.select("key").distinct()
    _insert(distinct.repartition(buckets, "key"), f"{path}/{VERSION}{number}.buckets={buckets}", buckets)
    for _, own, folder in _versions(spark, path)[:-1]:
        spark.sql(f"DROP TABLE IF EXISTS {_table(spark, folder, own)}")
        discard(spark, folder)


def stored_keys(
    spark: SparkSession, path: str, of: Callable[[], DataFrame], buckets: int | None = None
) -> DataFrame:
    """The key table at ``path``; made from ``of()``, rows with a ``key``, if it is absent or behind."""
    versions = _versions(spark, path)
    if not versions or is_changing(spark, path):
        publish_keys(of(), path, versions[-1][1] if versions else buckets)
        discard(spark, f"{path}/{MARK}")
        versions = _versions(spark, path)
    _, buckets, folder = versions[-1]
    return spark.table(_table(spark, folder, buckets))


def add_keys(keys: DataFrame, path: str) -> None:
    """Append distinct keys to a key table, which is rewritten once its files are many.

    The rewriting reads and writes bucket by bucket, without a shuffle.
    """
    spark = keys.sparkSession
    _, buckets, folder = _versions(spark, path)[-1]
    _insert(keys.select("key").repartition(buckets, "key"), folder, buckets)
    if file_count(spark, folder) > FILES * buckets:
        compact_keys(spark, path)


def compact_keys(spark: SparkSession, path: str) -> None:
    """One file a bucket again; making keys distinct keeps the scan to the buckets as they are."""
    number, buckets, folder = _versions(spark, path)[-1]
    _insert(spark.table(_table(spark, folder, buckets)).distinct(), f"{path}/{VERSION}{number + 1}.buckets={buckets}", buckets)
    spark.sql(f"DROP TABLE IF EXISTS {_table(spark, folder, buckets)}")
    discard(spark, folder)


def known_among(keys: DataFrame, stored: DataFrame) -> DataFrame:
    """The ``key`` of ``keys``, distinct, that ``stored`` (a key table) holds.

    The hint makes the batch the hashed side; the stored side streams through as it lies.
    """
    return stored.join(keys.select("key").distinct().hint("shuffle_hash"), "key", "left_semi").distinct()

"""What the corpus operators share: tables, scratch, row identity, safe column names."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ludometry.session import scratch_path
from ludometry.sources.tables import discard

# Rows up to which a written table of a few numbers a row is broadcast: 16 MB or so;
# and characters that its texts may have.
BROADCAST, CHARACTERS = 1_000_000, 16_000_000
# Bytes of rows that Spark hands to Python at a time; texts are long, so its default
# of rows would be many megabytes in every worker.
BATCH, _BATCH = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def bounded(spark: SparkSession) -> None:
    """Lower the session's bytes of an Arrow batch to ``BATCH``, if they are more."""
    held = str(spark.conf.get(_BATCH)).rstrip("bB")
    if not held.isdigit() or int(held) > BATCH:
        spark.conf.set(_BATCH, str(BATCH))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Paths written within the blocks of ``scratch``, innermost last.
_SCRATCH: list[list[str]] = []


def written(rows: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends there.

    The table stays until the block of ``scratch`` around it, if there is one, ends.
    """
    spark = rows.sparkSession
    bounded(spark)
    path = scratch_path(spark, label)
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end of the block what operators wrote in it.

    Results that read such tables must have been consumed, or written elsewhere,
    by then.
    """
    _SCRATCH.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.pop():
            discard(spark, path)


def few(rows: DataFrame, most: int = BROADCAST) -> DataFrame:
    """A written table of narrow rows whose number and length were checked, to be broadcast if small.

    Beyond ``most`` rows or ``CHARACTERS`` characters Spark chooses the join.
    """
    lengths = [F.coalesce(F.sum(F.length(f.name)), F.lit(0)) for f in rows.schema.fields if isinstance(f.dataType, T.StringType)]
    found = rows.agg(F.count(F.lit(1)), *lengths).first()
    return F.broadcast(rows) if found[0] <= most and sum(found[1:]) <= CHARACTERS else rows


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the key, as a long, and the text; every other column is left behind.

    Columns are taken by name, so extra columns of any name do no harm.
    """
    bounded(docs.sparkSession)
    return docs.select(
        F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )


def has_unique_keys(docs: DataFrame, key: str = "doc_id") -> bool:
    """Whether no key is null or repeated. Reads the key column only."""
    counts = docs.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter("key IS NULL OR n > 1").isEmpty()


def fresh_name(docs: DataFrame, name: str = "_row") -> str:
    """A name that no column has; Spark minds no case."""
    taken = {column.lower() for column in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(docs: DataFrame, key: str, *order: str) -> tuple[DataFrame, str]:
    """Rows with a column that tells them apart and sorts like the key.

    Where the key is unique it is that column itself. Otherwise the rows are
    sorted by key (null first), ``order`` and where they lie, numbered in that
    order, with gaps, and written, so that a lost executor cannot number them anew.
    """
    if has_unique_keys(docs, key):
        return docs, key
    name, place = fresh_name(docs), fresh_name(docs, "_place")
    # Where a row lies also parts rows that are the same, however many.
    sorted_ = docs.withColumn(place, F.monotonically_increasing_id()).orderBy(key, *order, place).drop(place)
    return written(sorted_.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def row_keys(docs: DataFrame, key: str) -> tuple[DataFrame, str]:
    """Rows with a long that tells them apart, in native functions only.

    Where the key is unique it is that column itself. Otherwise the rows are
    written with numbers, in no order, which a lost executor cannot give anew.
    """
    if has_unique_keys(docs.select(F.col(key).cast("long").alias(key)), key):
        return docs, key
    name = fresh_name(docs)
    return written(docs.withColumn(name, F.monotonically_increasing_id()), "rows"), name


def batches(schema: str | T.StructType) -> pa.Schema:
    """The Arrow schema of a mapInArrow result."""
    from pyspark.sql.pandas.types import to_arrow_schema

    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    return to_arrow_schema(schema)


def slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the strings of a slice hold about ``limit`` bytes, or are one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
    start, held = 0, 0
    for row, size in enumerate(sizes):
        if row > start and held + size > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)

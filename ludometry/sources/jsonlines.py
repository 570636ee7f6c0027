"""JSON Lines with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ludometry.operators.normalize import flatten_profiles
from ludometry.schemas import CORRUPT, RAW_EVENT, RAW_MAP, RAW_PROFILE_EVENT


def read_json_lines(
    spark: SparkSession, path: str, schema: T.StructType, corrupt_column: str | None = CORRUPT
) -> DataFrame:
    """Permissive scan; bad lines are kept whole in the corrupt column.

    Without a corrupt column, bad lines become all-null rows. Write the result
    before validating it: a pruned JSON scan does not parse, and so does not
    flag, the fields that it skips.
    """
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE")
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.json(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return read_json_lines(spark, path, RAW_EVENT)


def read_maps(spark: SparkSession, path: str) -> DataFrame:
    return read_json_lines(spark, path, RAW_MAP)


def read_flat_events(spark: SparkSession, path: str) -> DataFrame:
    """Profile events as flat rows; lines that hold no object are skipped.

    The kind of the line decides, not its fields: an object whose only field is
    mistyped stays, with that field null, and an array of objects is no object.
    """
    fields = T.StructType([field for field in RAW_PROFILE_EVENT if field.name != CORRUPT])
    objects = read_lines(spark, path).filter(F.json_object_keys("value").isNotNull())
    return flatten_profiles(objects.select(F.from_json("value", fields).alias("_")).select("_.*"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The raw text, one row per line, for profiling."""
    return spark.read.text(path)

"""Profiling reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def frequency(rows: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; null is a value."""
    return (
        rows.groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc_nulls_last(column))
    )


def distinct_values(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-null values of several columns as (column_name, value), one pass."""
    return (
        rows.select(*columns)
        .unpivot([], list(columns), "column_name", "value")
        .filter(F.col("value").isNotNull())
        .distinct()
    )


def row_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows per named frame as (layer, row_count)."""
    counts = [
        rows.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("layer"), "row_count"
        )
        for name, rows in layers.items()
    ]
    total = counts[0]
    for count in counts[1:]:
        total = total.unionByName(count)
    return total


def first_rows(rows: DataFrame, count: int, order: Sequence[str]) -> DataFrame:
    """The first rows of a fixed order, for looking at data."""
    return rows.orderBy(*order).limit(count)


def schema_profile(rows: DataFrame) -> DataFrame:
    """The schema as (position, column_name, data_type, nullable)."""
    described = [
        (i, field.name, field.dataType.simpleString(), field.nullable)
        for i, field in enumerate(rows.schema.fields)
    ]
    return rows.sparkSession.createDataFrame(
        described, "position int, column_name string, data_type string, nullable boolean"
    )


# Spark's names for the six kinds of JSON value.
JSON_KINDS = {
    "BIGINT": "number",
    "DOUBLE": "number",
    "STRING": "string",
    "BOOLEAN": "boolean",
    "VOID": "null",
}


def _json_kind(schema: Column) -> Column:
    kind = (
        F.when(schema.startswith("OBJECT"), "object")
        .when(schema.startswith("ARRAY"), "array")
        .when(schema.startswith("DECIMAL"), "number")
    )
    for name, meaning in JSON_KINDS.items():
        kind = kind.when(schema == name, meaning)
    return kind.otherwise(F.lower(schema))


def raw_field_profile(lines: DataFrame, column: str = "value") -> DataFrame:
    """Fields of raw JSON lines with type, frequency and an example.

    Returns (path, json_type, row_count, example) for every field of every
    object, one level into nested objects (``a.b``) and arrays (``a[i]``).
    Lines that hold no JSON object are left out. The text is parsed once, and
    grouping on (path, type) is combined map-side, so the shuffle carries one
    row per field and partition.
    """
    explode = lines.sparkSession.tvf
    top = (
        lines.select(F.try_parse_json(column).alias("line"))
        .lateralJoin(explode.variant_explode(F.col("line").outer()))
        .filter(F.col("key").isNotNull())  # members of objects, not of arrays
        .select(F.col("key").alias("path"), F.col("value").alias("field"))
    )
    inner = top.lateralJoin(
        explode.variant_explode_outer(F.col("field").outer()).toDF(
            "inner_pos", "inner_key", "inner_value"
        )
    )

    def described(path: Column, field: str) -> Column:
        return F.struct(
            path.alias("path"),
            _json_kind(F.schema_of_variant(field)).alias("json_type"),
            F.to_json(field).alias("shown"),
        )

    element = F.concat("path", F.lit("["), F.col("inner_pos").cast("string"), F.lit("]"))
    member = F.concat("path", F.lit("."), "inner_key")
    # A field gives one row per inner value; its first row also speaks for itself.
    itself = F.when(
        F.coalesce(F.col("inner_pos"), F.lit(0)) == 0, described(F.col("path"), "field")
    )
    inside = F.when(
        F.col("inner_pos").isNotNull(),
        described(F.coalesce(member, element), "inner_value"),
    )
    return (
        inner.select(F.inline(F.array_compact(F.array(itself, inside))))
        .groupBy("path", "json_type")
        .agg(F.count(F.lit(1)).alias("row_count"), F.min("shown").alias("example"))
    )


def merged_raw_schema(lines: DataFrame, column: str = "value") -> DataFrame:
    """The one schema that covers the objects of all lines, as DDL text."""
    is_object = F.schema_of_variant("line").startswith("OBJECT")
    return lines.select(F.try_parse_json(column).alias("line")).agg(
        F.schema_of_variant_agg(F.when(is_object, F.col("line"))).alias("merged_schema")
    )

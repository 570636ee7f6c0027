"""Named validation rules, routing of bad rows, and checks on results."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ludometry.operators import checks
from ludometry.schemas import CORRUPT

Rule = tuple[str, Column]

VALID = "valid"


def _blank(name: str) -> Column:
    return F.col(name).isNull() | (F.col(name) == "")


def event_rules(max_epoch: int | None = None) -> list[Rule]:
    """Reasons to reject an event, most basic first; their names are fixed values.

    ``max_epoch`` adds an upper bound for the timestamp, off unless asked for.
    """
    rules = [
        ("malformed JSON", F.col(CORRUPT).isNotNull()),
        ("missing event_id", F.col("event_id").isNull()),
        ("missing user_id", F.col("user_id").isNull()),
        ("invalid event_type", _blank("event_type")),
        ("invalid timestamp", F.col("timestamp").isNull() | (F.col("timestamp") <= 0)),
    ]
    if max_epoch is not None:
        rules.append(("timestamp out of range", F.col("timestamp") > max_epoch))
    return rules


def map_rules() -> list[Rule]:
    return [
        ("malformed JSON", F.col(CORRUPT).isNotNull()),
        ("missing map_id", F.col("map_id").isNull()),
        ("invalid map_name", _blank("map_name")),
    ]


def validate(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``validation_error``, the first broken rule, and ``is_valid``."""
    verdict = reduce(
        lambda otherwise, rule: F.when(rule[1], rule[0]).otherwise(otherwise),
        reversed(rules),
        F.lit(VALID),
    )
    return rows.withColumn("validation_error", verdict).withColumn(
        "is_valid", F.col("validation_error") == VALID
    )


def split(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows and quarantined rows."""
    return validated.filter("is_valid"), validated.filter("NOT is_valid")


def one_per_key(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """De-duplicate on ``key``; the smallest row in ``order`` survives.

    The rank filter trims every partition before the shuffle, so a key with
    very many copies reaches its task as one row per input partition.
    """
    first = Window.partitionBy(key).orderBy(*[F.asc_nulls_last(name) for name in order])
    return (
        rows.withColumn("_copy", F.row_number().over(first)).filter("_copy = 1").drop("_copy")
    )


def unresolved(rows: DataFrame, dimension: DataFrame, key: str, name: str) -> DataFrame:
    """Distinct non-null keys without a named entry in the dimension.

    The keys are made distinct before the lookup, so a crowded key is one row.
    """
    named = dimension.filter(F.col(name).isNotNull()).select(key)
    keys = rows.filter(F.col(key).isNotNull()).select(key).distinct()
    return keys.join(named, key, "left_anti")


# Checks return the rows that break them; an empty result passes.


def null_violations(rows: DataFrame, column: str) -> DataFrame:
    return rows.filter(checks.check(checks.NOT_NULL, column).broken())


def duplicate_violations(rows: DataFrame, key: str) -> DataFrame:
    return checks.copies(rows, checks.check(checks.UNIQUE, key))


def ratio_violations(rows: DataFrame, column: str) -> DataFrame:
    return rows.filter(checks.check(checks.IN_RANGE, column, low=0, high=1).broken())


def negative_violations(rows: DataFrame, column: str) -> DataFrame:
    return rows.filter(checks.check(checks.NOT_NEGATIVE, column).broken())


def mart_checks(mart: DataFrame) -> DataFrame:
    """Number of violations of every mart check, as (check_name, violations, passed)."""
    return checks.violations(mart, checks.MART_CHECKS)

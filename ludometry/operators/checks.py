"""Checks of a table declared as data: which columns, what they must be, within which bounds.

One list of checks gives the number of violations of each, in a single pass over the
table, and the rows that break them, with the names of what they break.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NOT_NULL, UNIQUE, IN_RANGE, NOT_NEGATIVE, ACCEPTED = "not_null", "unique", "in_range", "not_negative", "accepted"


@dataclass(frozen=True)
class Check:
    """What one column, or several together for UNIQUE, must be.

    ``low`` and ``high`` bound IN_RANGE, null standing for no bound; ``values``
    are those that ACCEPTED takes. Nulls break NOT_NULL alone; keys with a null
    are not counted as copies.
    """

    columns: tuple[str, ...]
    kind: str
    low: float | None = None
    high: float | None = None
    values: tuple = ()

    def __post_init__(self) -> None:
        if self.kind not in (NOT_NULL, UNIQUE, IN_RANGE, NOT_NEGATIVE, ACCEPTED):
            raise ValueError(f"unknown kind of check {self.kind!r}")
        if len(self.columns) != 1 and self.kind != UNIQUE:
            raise ValueError(f"a check of {self.kind} is on one column")

    @property
    def name(self) -> str:
        return f"{'_'.join(self.columns)}_{self.kind}"

    def broken(self) -> Column:
        """Whether a row breaks the check by itself; for all kinds but UNIQUE."""
        column = F.col(self.columns[0])
        if self.kind == NOT_NULL:
            return column.isNull()
        if self.kind == ACCEPTED:
            found = ~column.isin(*self.values)
        else:
            low, high = (0, None) if self.kind == NOT_NEGATIVE else (self.low, self.high)
            bounds = [] if low is None else [column < low]
            bounds += [] if high is None else [column > high]
            found = reduce(Column.__or__, bounds, F.lit(False))
        return F.coalesce(found, F.lit(False))

    def is_key(self) -> Column:
        return reduce(Column.__and__, [F.col(name).isNotNull() for name in self.columns])


def check(kind: str, *columns: str, **bounds) -> Check:
    return Check(columns, kind, **bounds)


def copies(rows: DataFrame, key: Check) -> DataFrame:
    """Keys that several rows share, and how many do."""
    counted = rows.filter(key.is_key()).groupBy(*key.columns).agg(F.count(F.lit(1)).alias("copies"))
    return counted.filter("copies > 1")


def violations(rows: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(check_name, violations, passed) of every check; for UNIQUE, keys with copies are counted.

    Checks of rows are counted in the fold that finds copies of the first key, so
    the table is read once; further keys are a fold each.
    """
    keys = [own for own in checks if own.kind == UNIQUE]
    per_row = [own for own in checks if own.kind != UNIQUE]
    counts = [F.count_if(own.broken()).alias(own.name) for own in per_row]
    if keys:
        first = keys[0]
        folded = rows.groupBy(*first.columns).agg(F.count(F.lit(1)).alias("_copies"), *counts)
        repeated = first.is_key() & (F.col("_copies") > 1)
        totals = [F.coalesce(F.sum(own.name), F.lit(0)).alias(own.name) for own in per_row]
        counted = folded.agg(F.count_if(repeated).alias(first.name), *totals)
    else:
        counted = rows.agg(*counts)
    found = counted.unpivot([], counted.columns, "check_name", "violations")
    for key in keys[1:]:
        found = found.unionByName(
            copies(rows, key).agg(F.count(F.lit(1)).alias("violations")).select(F.lit(key.name).alias("check_name"), "violations")
        )
    return found.withColumn("passed", F.col("violations") == 0)


def violating(rows: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """The rows that break a check, with ``broken``, the names of those that they break, sorted."""
    names = [F.when(own.broken(), F.lit(own.name)) for own in checks if own.kind != UNIQUE]
    found = rows.withColumn("broken", F.array_compact(F.array(*names)) if names else F.array().cast("array<string>"))
    for key in (own for own in checks if own.kind == UNIQUE):
        # Few keys have copies; a crowded one is one row of theirs.
        repeated = copies(rows, key).select(*key.columns, F.lit(key.name).alias("_copy"))
        found = found.join(repeated, list(key.columns), "left").withColumn(
            "broken", F.array_compact(F.concat("broken", F.array("_copy")))
        )
        found = found.drop("_copy")
    return found.filter(F.size("broken") > 0).withColumn("broken", F.array_sort("broken")).select(*rows.columns, "broken")


MART_CHECKS = [
    check(UNIQUE, "user_id"),
    check(NOT_NULL, "user_id"),
    check(NOT_NULL, "username"),
    check(NOT_NULL, "registration_date"),
    check(IN_RANGE, "fav_map_win_ratio", low=0, high=1),
    check(IN_RANGE, "total_win_ratio", low=0, high=1),
    check(NOT_NEGATIVE, "total_playtime"),
]

MATCH_CHECKS = [
    check(UNIQUE, "user_id", "map_id", "opponent_id", "match_number"),
    check(NOT_NULL, "user_id"),
    check(NOT_NULL, "map_id"),
    check(NOT_NULL, "opponent_id"),
    check(NOT_NEGATIVE, "duration"),
    check(ACCEPTED, "is_win", values=(0, 1)),
    check(IN_RANGE, "outcome", low=0, high=1),
]

"""Running totals that stay balanced when one key owns much of the data.

A window partitioned by a key puts the whole key into one task. That is the
cheapest plan for ordinary keys, so they keep it. A key with more rows than
``hot_rows`` is range-partitioned by its *order* instead: every slice numbers
its own rows and adds the total of the slices before it. Both ways give the
same numbers for every row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ludometry.session import ensure_checkpoints

# Rows one task sorts without trouble (about 1-2 GB of narrow event rows).
HOT_ROWS = 20_000_000

RunningTotal = Callable[[DataFrame, Sequence[str], Sequence[str], Column, str], DataFrame]


def running_total(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str
) -> DataFrame:
    """Sum of ``value`` from the first row of the key to the current one."""
    frame = (
        Window.partitionBy(*keys)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return rows.withColumn(name, F.sum(value).over(frame))


def sliced_running_total(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
    slices: int,
) -> DataFrame:
    """The same numbers as :func:`running_total` with no key kept in one task.

    The range partitioning samples its bounds, so a recomputed plan could cut
    elsewhere. The checkpoint pins the slice numbers before they are used twice.
    """
    ensure_checkpoints(rows.sparkSession)
    sliced = (
        rows.withColumn("_value", value)
        .repartitionByRange(slices, *keys, *order)
        .withColumn("_slice", F.spark_partition_id())
        .withColumn("_key", F.struct(*keys))
        .checkpoint()
    )
    earlier = (
        Window.partitionBy("_key")
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        sliced.groupBy("_key", "_slice")
        .agg(F.sum("_value").alias("_total"))
        .select("_key", "_slice", F.sum("_total").over(earlier).alias("_before"))
    )
    within = running_total(sliced, ["_key", "_slice"], order, F.col("_value"), "_within")
    total = F.col("_within") + F.coalesce(F.col("_before"), F.lit(0))
    return (
        within.join(offsets, ["_key", "_slice"], "left")
        .withColumn(name, total)
        .drop("_value", "_slice", "_key", "_within", "_before")
    )


def hot_keys(rows: DataFrame, keys: Sequence[str], hot_rows: int) -> list[tuple]:
    """Keys with more than ``hot_rows`` rows, each with its number of rows last.

    One map-side-combined count over the key columns. The answer holds at most
    ``rows / hot_rows`` keys, which bounds both the driver and the broadcast.
    """
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return [tuple(row) for row in counted.filter(F.col("_n") > hot_rows).collect()]


def per_key(
    rows: DataFrame,
    keys: Sequence[str],
    apply: Callable[[DataFrame, RunningTotal], DataFrame],
    hot_rows: int = HOT_ROWS,
    hot: list[tuple] | None = None,
) -> DataFrame:
    """Run ``apply`` with the plain running total, and with a safe one on hot keys.

    ``hot``, where the caller knows them, are the keys as ``hot_keys`` gives them;
    nothing is counted then. They choose the plan and not the numbers.

    The safe one slices the hot keys themselves; totals over finer keys, which
    may be hot or not, are decided by a count of their own. A slice holds about
    as many rows as the largest key that is not hot.
    """
    hot = hot_keys(rows, keys, hot_rows) if hot is None else hot
    if not hot:
        return apply(rows, running_total)
    slices = 1 + sum(found[-1] for found in hot) // hot_rows

    def safe_total(
        part: DataFrame, by: Sequence[str], order: Sequence[str], value: Column, name: str
    ) -> DataFrame:
        if list(by) == list(keys):
            return sliced_running_total(part, by, order, value, name, slices)
        return per_key(part, by, lambda some, total: total(some, by, order, value, name), hot_rows)

    renamed = rows.select(*[F.col(key).alias(f"_hot_{key}") for key in keys])
    listed = F.broadcast(
        rows.sparkSession.createDataFrame([found[:-1] for found in hot], renamed.schema)
    )
    same = [F.col(key).eqNullSafe(F.col(f"_hot_{key}")) for key in keys]
    ordinary = rows.join(listed, same, "left_anti")
    heavy = rows.join(listed, same, "left_semi")
    return apply(ordinary, running_total).unionByName(apply(heavy, safe_total))

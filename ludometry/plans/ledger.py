"""The ledger of runs: what every job wrote, noted as it was written.

Jobs count their rows while they write them. The ledger keeps those counts, so how
many rows a layer has is a sum over a few rows of the ledger and not over the layer.
Layers that a run replaces have the rows of their last run, the others those of all
runs added up.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ludometry.plans.lake import Lake
from ludometry.schemas import LEDGER
from ludometry.sinks.tables import append
from ludometry.sources.tables import read_or_empty

# The layer of each count that the jobs return, and whether a run replaces the layer.
LAYERS = {
    "new_events": ("bronze_events", False),
    "maps": ("bronze_maps", True),
    "valid_events": ("silver_events", False),
    "quarantined_events": ("quarantined_events", False),
    "valid_maps": ("silver_maps", True),
    "quarantined_maps": ("quarantined_maps", True),
}


def record(
    spark: SparkSession, lake: Lake, job: str, counts: Mapping[str, int], at: datetime.datetime | None = None
) -> None:
    """Note the counts of one run of a job; other names than those of ``LAYERS`` are an error."""
    now = at or datetime.datetime.now(datetime.UTC)
    run = uuid.uuid4().hex
    rows = [(run, now, job, *LAYERS[name], int(count)) for name, count in counts.items()]
    append(spark.createDataFrame(rows, LEDGER).coalesce(1), lake.ledger)


def runs(spark: SparkSession, lake: Lake) -> DataFrame:
    """Everything noted: run, run_at, job, layer, replaced, row_count."""
    return read_or_empty(spark, lake.ledger, LEDGER)


def layer_totals(spark: SparkSession, lake: Lake) -> DataFrame:
    """(layer, row_count) of every layer that a run was noted for."""
    last = Window.partitionBy("layer").orderBy(F.desc("run_at"), F.desc("run"))
    noted = runs(spark, lake).withColumn("_age", F.row_number().over(last))
    return noted.filter("NOT replaced OR _age = 1").groupBy("layer").agg(F.sum("row_count").alias("row_count"))

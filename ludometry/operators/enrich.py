"""Map names for events."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ludometry.operators.quality import unresolved


def with_map_names(events: DataFrame, maps: DataFrame) -> DataFrame:
    """Left-outer lookup of the map name; the join key comes first.

    No broadcast is forced. Spark broadcasts the maps while their size, as
    estimated or as measured at run time, is under its threshold. A dimension
    that outgrew it is joined by a shuffle whose crowded keys, such as the null
    key of all non-match events, are split by the adaptive skew join.
    """
    return events.join(maps.select("map_id", "map_name"), "map_id", "left")


def unknown_maps(events: DataFrame, maps: DataFrame) -> DataFrame:
    """Map ids that events name and the maps lack."""
    return unresolved(events, maps, "map_id", "map_name")


def map_names(maps: DataFrame) -> DataFrame:
    return maps.select("map_name").distinct()

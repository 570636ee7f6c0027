"""Game telemetry derived from the driver's tables.

The given ``events`` become game events, ``region`` the maps and ``nation`` the countries. Every event
row is used. Field ``k`` of ``props`` decides the details, among them which raw
lines are damaged and how.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
REGION = T.StructType(
    [T.StructField("r_regionkey", T.IntegerType()), T.StructField("r_name", T.StringType())]
)

NATION = T.StructType(
    [T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType())]
)

# A signup of some value registers its player; some players never do.
GAME_TYPE = """
CASE WHEN event_type = 'signup' AND value >= 80 THEN 'registration'
     WHEN event_type = 'signup' THEN 'tutorial'
     WHEN event_type = 'error' THEN 'session_ping'
     WHEN event_type = 'view' THEN 'match_start'
     WHEN event_type = 'purchase' THEN 'match_finish'
     ELSE 'other' END"""

# Whole seconds since the epoch. Subtracting two zone-less instants keeps the
# session time zone out of it.
SECONDS = "CAST(CAST(ts - TIMESTAMP_NTZ '1970-01-01 00:00:00' AS INTERVAL SECOND) AS BIGINT)"

# Players 0 to 24 of every 26 live in the nation of that key; the last has none.
DETAILS = {
    "event_id": "CAST(event_id AS STRING)",
    "timestamp": "seconds",
    "event_type": "game_type",
    "user_id": "CAST(user_id AS STRING)",
    "country": "CASE WHEN game_type = 'registration' AND k >= 10 THEN n_name END",
    "device_os": """CASE WHEN game_type = 'registration'
                         THEN CASE k % 3 WHEN 0 THEN 'ios' WHEN 1 THEN 'android' ELSE 'web' END
                    END""",
    "username": """CASE WHEN game_type = 'registration'
                        THEN concat('player_', user_id, CASE k % 2 WHEN 0 THEN '' ELSE '_x' END)
                   END""",
    "session_state": """CASE WHEN game_type = 'session_ping'
                             THEN CASE k % 2 WHEN 0 THEN 'started' ELSE 'in_progress' END END""",
    "map_id": """CASE WHEN game_type IN ('match_start', 'match_finish')
                      THEN CAST(k % 7 AS STRING) END""",
    "opponent_id": """CASE WHEN game_type IN ('match_start', 'match_finish')
                           THEN CAST((k div 7) % 2 AS STRING) END""",
    "outcome": """CASE WHEN game_type = 'match_finish'
                       THEN CASE WHEN value >= 20 THEN 1D ELSE 0D END END""",
}

# Cleaned fields made untidy again. The numbers of k that damage a record:
# 90 a cut line, 91 no user, 92 second zero, 93 a blank type, 94 no id,
# 95 the line twice, 96 a text as time, and 97 (profiles only) no object.
RAW_ID = "CASE WHEN k <> 94 THEN event_id END AS id"
RAW_TIME = "CASE WHEN k = 92 THEN 0L ELSE timestamp END AS timestamp"
RAW_TYPE = """CASE WHEN k = 93 THEN '  ' WHEN k % 5 = 0 THEN concat(' ', upper(event_type), ' ')
                   ELSE event_type END AS event_type"""
RAW_USER = "CASE WHEN k <> 91 THEN user_id END AS user_id"
RAW_PROFILE = """concat(' ', lower(country)) AS country,
                 concat(upper(device_os), ' ') AS device_os,
                 concat(' ', username, ' ') AS username"""
RAW_DATA = f"""struct({RAW_PROFILE}, upper(session_state) AS state,
                      map_id, opponent_id, outcome) AS event_data"""


def _details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned fields that each type of event carries, and k."""
    events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    nations = spark.read.schema(NATION).parquet(f"{sf_dir}/nation.parquet")
    kinds = events.selectExpr(
        "event_id",
        f"{SECONDS} AS seconds",
        f"{GAME_TYPE} AS game_type",
        "user_id",
        "value",
        "CAST(get_json_object(props, '$.k') AS INT) AS k",
    )
    names = [F.lit(x) for row in nations.collect() for x in (row.n_nationkey, row.n_name)]  # 25 rows
    named = kinds.withColumn("n_name", F.try_element_at(F.create_map(*names), (F.col("user_id") % 26).cast("int")))
    return named.selectExpr(*[f"{how} AS {name}" for name, how in DETAILS.items()], "k")


def game_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged events, as Silver would give them without any damage."""
    return _details(spark, sf_dir).selectExpr(
        *DETAILS, "timestamp_seconds(timestamp) AS event_timestamp"
    )


def _region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(REGION).parquet(f"{sf_dir}/region.parquet")


def game_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged maps; map ids 5 and 6 of the events have none."""
    return _region(spark, sf_dir).selectExpr(
        "CAST(r_regionkey AS STRING) AS map_id", "r_name AS map_name"
    )


def _lines(details: DataFrame, nested: str, broken: str) -> DataFrame:
    """Raw JSON lines (value) with the second of their event (_at).

    ``broken`` names further damage as a CASE branch.
    """

    def line(time: str) -> str:
        return f"to_json(struct({RAW_ID}, {time}, {RAW_TYPE}, {RAW_USER}, {nested}))"

    value = f"""CASE WHEN k = 90 THEN concat('{{"id": "', event_id, '", "timestamp": ')
                     WHEN k = 96 THEN {line("'soon' AS timestamp")}
                     {broken}
                     ELSE {line(RAW_TIME)} END"""
    copies = "CASE WHEN k = 95 THEN 2 ELSE 1 END"
    return details.selectExpr(
        f"explode(array_repeat({value}, {copies})) AS value", "timestamp AS _at"
    )


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(_details(spark, sf_dir), RAW_DATA, "")


def profile_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The variant that nests the profile under ``user``."""
    return _lines(
        _details(spark, sf_dir), f"struct({RAW_PROFILE}) AS user", "WHEN k = 97 THEN '[1, 2]'"
    )


def top_level_map_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The variant with the map beside the profile, which lies under ``event_data``."""
    return _lines(_details(spark, sf_dir), f"map_id, struct({RAW_PROFILE}) AS event_data", "")


def map_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map dimension as raw lines, each region also in four damaged shapes."""
    key, name = "CAST(r_regionkey AS STRING)", "concat(' ', r_name, ' ') AS name"
    whole = f"to_json(struct({key} AS id, {name}))"
    shapes = [
        whole,
        whole,
        f"""concat('{{"id": "', {key})""",
        f"to_json(struct({name}))",
        f"to_json(struct(concat('blank_', {key}) AS id, '  ' AS name))",
    ]
    return _region(spark, sf_dir).selectExpr(f"explode(array({', '.join(shapes)})) AS value")

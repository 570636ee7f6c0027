"""Declared schemas of every layer. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "invalid_record"

STRING, LONG, DOUBLE = T.StringType(), T.LongType(), T.DoubleType()
INSTANT, DAY, FLAG = T.TimestampType(), T.DateType(), T.BooleanType()


def _fields(kind: T.DataType, names: str) -> list[T.StructField]:
    return [T.StructField(name, kind) for name in names.split()]


def _schema(*groups: list[T.StructField]) -> T.StructType:
    return T.StructType([field for group in groups for field in group])


_RAW_HEAD = [
    *_fields(STRING, "id"),
    *_fields(LONG, "timestamp"),
    *_fields(STRING, "event_type user_id"),
]
_PROFILE = _fields(STRING, "country device_os username")
_BAD_LINE = _fields(STRING, CORRUPT)

RAW_EVENT = _schema(
    _RAW_HEAD,
    _fields(
        _schema(
            _PROFILE, _fields(STRING, "state map_id opponent_id"), _fields(DOUBLE, "outcome")
        ),
        "event_data",
    ),
    _BAD_LINE,
)
# What tells one raw event from another.
RAW_PAYLOAD = [name for name in RAW_EVENT.fieldNames() if name != CORRUPT]
# Older producers nest the profile under "user" and send no match fields.
RAW_PROFILE_EVENT = _schema(_RAW_HEAD, _fields(_schema(_PROFILE), "user"), _BAD_LINE)
# Another early shape: the map at the top level, the profile under "event_data".
RAW_TOP_LEVEL_MAP_EVENT = _schema(
    _RAW_HEAD, _fields(STRING, "map_id"), _fields(_schema(_PROFILE), "event_data"), _BAD_LINE
)
RAW_MAP = _schema(_fields(STRING, "id name"), _BAD_LINE)

BRONZE_EVENT = _schema(
    RAW_EVENT.fields, _fields(INSTANT, "event_timestamp"), _fields(DAY, "event_date")
)
BRONZE_MAP = RAW_MAP

FLAT_EVENT = _schema(_RAW_HEAD, _PROFILE)

_FLAT_FIELDS = [
    *_fields(STRING, "event_id"),
    *_fields(LONG, "timestamp"),
    *_fields(STRING, "event_type user_id"),
    *_PROFILE,
    *_fields(STRING, "session_state map_id opponent_id"),
    *_fields(DOUBLE, "outcome"),
]
_VERDICT = [
    *_fields(STRING, "validation_error"),
    *_fields(FLAG, "is_valid"),
    *_fields(INSTANT, "processed_at"),
]

STAGED_EVENT = _schema(_FLAT_FIELDS, _fields(INSTANT, "event_timestamp"))
STAGED_MAP = _schema(_fields(STRING, "map_id map_name"))

SILVER_EVENT = _schema(
    _FLAT_FIELDS,
    _BAD_LINE,
    _fields(INSTANT, "event_timestamp"),
    _VERDICT,
    _fields(DAY, "event_date"),
)
# Quarantine also keeps which raw record a row came from.
RECORD_KEY = "record_key"
QUARANTINED_EVENT = _schema(SILVER_EVENT.fields, _fields(STRING, RECORD_KEY))
SILVER_MAP = _schema(STAGED_MAP.fields, _BAD_LINE, _VERDICT)

MATCH = _schema(
    _fields(STRING, "user_id map_id opponent_id"),
    _fields(LONG, "session_number match_number start_timestamp finish_timestamp duration"),
    _fields(DOUBLE, "outcome"),
    _fields(T.IntegerType(), "is_win"),
)
MATCH_KEY = ["user_id", "map_id", "opponent_id", "match_number"]

# Sums of matches that statistics are made of.
MAP_SUMS = _schema(_fields(STRING, "user_id map_id"), _fields(LONG, "map_matches map_wins"))
SESSION_SUMS = _schema(_fields(STRING, "user_id"), _fields(LONG, "session_number playtime wins matches"))

# One row for each layer that a run of a job wrote.
LEDGER = _schema(
    _fields(STRING, "run"), _fields(INSTANT, "run_at"), _fields(STRING, "job layer"), _fields(FLAG, "replaced"), _fields(LONG, "row_count")
)

ENRICHED_EVENT = _schema(SILVER_EVENT.fields, _fields(STRING, "map_name"))
USER_MAP_STATS = _schema(
    _fields(STRING, "user_id map_id"), _fields(LONG, "map_matches map_wins"), _fields(DOUBLE, "map_win_ratio")
)
USER_TOTALS = _schema(
    _fields(STRING, "user_id"),
    _fields(LONG, "total_playtime total_wins total_matches total_sessions"),
    _fields(DOUBLE, "total_win_ratio avg_matches_per_session"),
)
PLAYER_STATS = _schema(
    _fields(STRING, "user_id username country fav_map"),
    _fields(DOUBLE, "fav_map_win_ratio"),
    _fields(LONG, "total_playtime"),
    _fields(DOUBLE, "total_win_ratio avg_matches_per_session"),
    _fields(DAY, "registration_date"),
    _fields(STRING, "data_quality_status"),
)

# What a match update carries from one batch of events to the next, as rows that add up.
CARRIED = _schema(
    _fields(STRING, "user_id map_id opponent_id kind"),
    _fields(LONG, "match_number session_number at"),
    _fields(STRING, "event_id"),
    _fields(LONG, "n"),
)

"""Sessions, opened by an explicit ping and numbered per player."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludometry.operators.running import HOT_ROWS, per_key

# Fixed values of the event vocabulary.
REGISTRATION = "registration"
SESSION_PING = "session_ping"
SESSION_STARTED = "started"
MATCH_START = "match_start"
MATCH_FINISH = "match_finish"

EVENT_ORDER = ["timestamp", "event_id"]


def opens_session() -> Column:
    """1 on the ping that starts a session, else 0; a null state is 0."""
    ping = F.col("event_type") == SESSION_PING
    started = F.col("session_state") == SESSION_STARTED
    return F.when(ping & started, 1).otherwise(0)


def event_sessions(
    events: DataFrame, hot_rows: int = HOT_ROWS, hot: list[tuple] | None = None
) -> DataFrame:
    """Every event with its start flag and the running number of its session.

    Events before a player's first start belong to session 0.
    """
    flagged = events.withColumn("new_session", opens_session())
    return per_key(
        flagged,
        ["user_id"],
        lambda rows, total: total(
            rows, ["user_id"], EVENT_ORDER, F.col("new_session"), "session_number"
        ),
        hot_rows,
        hot,
    )

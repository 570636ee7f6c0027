"""Small frames for tests."""

import contextlib
import io
import json
from pathlib import Path

from ludometry.schemas import STAGED_EVENT, STAGED_MAP

FIELDS = [name for name in STAGED_EVENT.fieldNames() if name != "event_timestamp"]


def staged(spark, events):
    """Staged events from dicts; absent fields are null."""
    rows = [tuple(event.get(name) for name in FIELDS) + (None,) for event in events]
    return spark.createDataFrame(rows, STAGED_EVENT)


def maps(spark, names):
    return spark.createDataFrame(list(names.items()), STAGED_MAP)


def event(event_id, timestamp, event_type, user_id="u", **more):
    return dict(
        event_id=event_id, timestamp=timestamp, event_type=event_type, user_id=user_id, **more
    )


def ping(event_id, timestamp, user_id="u", state="started"):
    return event(event_id, timestamp, "session_ping", user_id, session_state=state)


def start(event_id, timestamp, user_id="u", map_id="m", opponent_id="o"):
    return event(
        event_id, timestamp, "match_start", user_id, map_id=map_id, opponent_id=opponent_id
    )


def finish(event_id, timestamp, user_id="u", map_id="m", opponent_id="o", outcome=1.0):
    return event(
        event_id,
        timestamp,
        "match_finish",
        user_id,
        map_id=map_id,
        opponent_id=opponent_id,
        outcome=outcome,
    )


def raw_line(event_id, timestamp=1_700_000_000, event_type="other", user_id="u", **data):
    record = dict(id=event_id, timestamp=timestamp, event_type=event_type, user_id=user_id)
    if data:
        record["event_data"] = data
    return json.dumps({key: value for key, value in record.items() if value is not None})


def write_lines(path, lines):
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text("".join(f"{line}\n" for line in lines), encoding="utf-8")
    return str(path)


def as_dicts(frame, *columns):
    chosen = frame.select(*columns) if columns else frame
    return [row.asDict(recursive=True) for row in chosen.collect()]


def as_set(frame, *columns):
    return {tuple(row) for row in frame.select(*columns).collect()}


def plan(frame):
    """The physical plan, as Spark shows it, before adaptive changes."""
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        frame.explain()
    return shown.getvalue()

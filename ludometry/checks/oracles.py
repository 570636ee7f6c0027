"""The registered queries in SQL for a single-process database.

Written from the meaning of each query, not from the Spark plan: pairing is a
join, the favourite map a ranking, the incremental jobs their end state.
"""

from __future__ import annotations

# The derived game events, as in fixtures.py.
_GAME = """
src AS (
  SELECT cast(event_id AS varchar) AS event_id,
         cast(floor(epoch(ts)) AS bigint) AS timestamp,
         CASE WHEN event_type = 'signup' AND value >= 80 THEN 'registration'
              WHEN event_type = 'signup' THEN 'tutorial'
              WHEN event_type = 'error' THEN 'session_ping'
              WHEN event_type = 'view' THEN 'match_start'
              WHEN event_type = 'purchase' THEN 'match_finish'
              ELSE 'other' END AS event_type,
         user_id AS uid, cast(user_id AS varchar) AS user_id, value,
         cast(json_extract(props, '$.k') AS int) AS k
  FROM events
),
detail AS (
  SELECT s.event_id, s.timestamp, s.event_type, s.user_id,
         CASE WHEN s.event_type = 'registration' AND k >= 10 THEN upper(n_name) END AS country,
         CASE WHEN s.event_type = 'registration'
              THEN CASE k % 3 WHEN 0 THEN 'ios' WHEN 1 THEN 'android' ELSE 'web' END
         END AS device_os,
         CASE WHEN s.event_type = 'registration'
              THEN 'player_' || s.user_id || CASE WHEN k % 2 = 0 THEN '' ELSE '_x' END
         END AS username,
         CASE WHEN s.event_type = 'session_ping'
              THEN CASE WHEN k % 2 = 0 THEN 'started' ELSE 'in_progress' END
         END AS session_state,
         CASE WHEN s.event_type IN ('match_start', 'match_finish')
              THEN cast(k % 7 AS varchar) END AS map_id,
         CASE WHEN s.event_type IN ('match_start', 'match_finish')
              THEN cast((k // 7) % 2 AS varchar) END AS opponent_id,
         CASE WHEN s.event_type = 'match_finish'
              THEN CASE WHEN value >= 20 THEN 1.0::double ELSE 0.0::double END END AS outcome,
         k
  FROM src s LEFT JOIN nation ON n_nationkey = s.uid % 26
),
game AS (SELECT * EXCLUDE (k) FROM detail),
maps AS (SELECT cast(r_regionkey AS varchar) AS map_id, r_name AS map_name FROM region)
"""

# Raw records as Bronze keeps them, copies of doubled events included.
_BRONZE = """
copies AS (
  SELECT d.* FROM detail d
  UNION ALL
  SELECT d.* FROM detail d WHERE k = 95
),
bronze AS (
  SELECT CASE WHEN k NOT IN (90, 94) THEN event_id END AS id,
         CASE WHEN k = 92 THEN 0 WHEN k NOT IN (90, 96) THEN timestamp END AS timestamp,
         CASE WHEN k = 90 THEN NULL WHEN k = 93 THEN '  '
              WHEN k % 5 = 0 THEN ' ' || upper(event_type) || ' ' ELSE event_type END AS event_type,
         CASE WHEN k NOT IN (90, 91) THEN user_id END AS user_id,
         CASE WHEN k <> 90 THEN ' ' || lower(country) END AS country,
         CASE WHEN k <> 90 THEN upper(device_os) || ' ' END AS device_os,
         CASE WHEN k <> 90 THEN ' ' || username || ' ' END AS username,
         CASE WHEN k <> 90 THEN upper(session_state) END AS state,
         CASE WHEN k <> 90 THEN map_id END AS map_id,
         CASE WHEN k <> 90 THEN opponent_id END AS opponent_id,
         CASE WHEN k <> 90 THEN outcome END AS outcome,
         CASE WHEN k IN (90, 96) THEN 1 ELSE 0 END AS malformed
  FROM copies
)
"""

_BRONZE_ROWS = """
SELECT *, timestamp AS event_second,
       strftime(DATE '1970-01-01' + cast(timestamp // 86400 AS int), '%Y-%m-%d') AS event_date
FROM bronze
"""

_SILVER = """
refined AS (
  SELECT id AS event_id, timestamp, lower(trim(event_type)) AS event_type, user_id,
         upper(trim(country)) AS country, lower(trim(device_os)) AS device_os,
         trim(username) AS username, lower(trim(state)) AS session_state,
         map_id, opponent_id, outcome,
         CASE WHEN malformed = 1 THEN 'malformed JSON'
              WHEN id IS NULL THEN 'missing event_id'
              WHEN user_id IS NULL THEN 'missing user_id'
              WHEN coalesce(trim(event_type), '') = '' THEN 'invalid event_type'
              WHEN timestamp IS NULL OR timestamp <= 0 THEN 'invalid timestamp'
              ELSE 'valid' END AS validation_error,
         timestamp AS event_second,
         strftime(DATE '1970-01-01' + cast(timestamp // 86400 AS int), '%Y-%m-%d') AS event_date
  FROM bronze
),
checked AS (
  SELECT *, CASE WHEN validation_error = 'valid' THEN 1 ELSE 0 END AS is_valid FROM refined
),
silver AS (SELECT DISTINCT * FROM checked WHERE is_valid = 1),
quarantine AS (SELECT * FROM checked WHERE is_valid = 0)
"""

_MAP_CHECK = """
map_checked AS (
  SELECT cast(r_regionkey AS varchar) AS map_id, r_name AS map_name,
         'valid' AS validation_error, 1 AS is_valid FROM region
  UNION ALL
  SELECT NULL, NULL, 'malformed JSON', 0 FROM region
  UNION ALL
  SELECT NULL, r_name, 'missing map_id', 0 FROM region
  UNION ALL
  SELECT 'blank_' || r_regionkey, '', 'invalid map_name', 0 FROM region
)
"""

# Flat rows of the profile variant; 97 is a line that is no object.
_FLAT = """
flat AS (
  SELECT CASE WHEN k <> 94 THEN event_id END AS id,
         CASE WHEN k = 92 THEN 0 WHEN k <> 96 THEN timestamp END AS timestamp,
         CASE WHEN k = 93 THEN '  ' WHEN k % 5 = 0 THEN ' ' || upper(event_type) || ' '
              ELSE event_type END AS event_type,
         CASE WHEN k <> 91 THEN user_id END AS user_id,
         ' ' || lower(country) AS country, upper(device_os) || ' ' AS device_os,
         ' ' || username || ' ' AS username
  FROM (SELECT * FROM detail UNION ALL SELECT * FROM detail WHERE k = 95)
  WHERE k NOT IN (90, 97)
)
"""


def _matches(events: str = "game", prefix: str = "") -> str:
    """Sessions, numbered sides and matches of the events, as CTEs."""
    return f"""
{prefix}sessions AS (
  SELECT *, cast(coalesce(event_type = 'session_ping' AND session_state = 'started', false) AS int)
              AS new_session,
         count(*) FILTER (event_type = 'session_ping' AND session_state = 'started')
           OVER so_far AS session_number
  FROM {events}
  WINDOW so_far AS (PARTITION BY user_id ORDER BY timestamp, event_id ROWS UNBOUNDED PRECEDING)
),
{prefix}sides AS (
  SELECT *, row_number() OVER same_place AS match_number
  FROM {prefix}sessions
  WHERE event_type IN ('match_start', 'match_finish')
  WINDOW same_place AS (PARTITION BY event_type, user_id, map_id, opponent_id
                        ORDER BY timestamp, event_id)
),
{prefix}matches AS (
  SELECT user_id, map_id, opponent_id, match_number, a.session_number,
         a.timestamp AS start_timestamp, b.timestamp AS finish_timestamp,
         b.timestamp - a.timestamp AS duration, b.outcome,
         cast(coalesce(b.outcome = 1, false) AS int) AS is_win
  FROM {prefix}sides a JOIN {prefix}sides b
    USING (user_id, map_id, opponent_id, match_number)
  WHERE a.event_type = 'match_start' AND b.event_type = 'match_finish'
    AND a.timestamp <= b.timestamp
)"""


_MAP_STATS = """
map_stats AS (
  SELECT user_id, map_id, count(*) AS map_matches, cast(sum(is_win) AS bigint) AS map_wins,
         avg(is_win) AS map_win_ratio
  FROM matches GROUP BY ALL
)"""

_TOTALS = """
totals AS (
  SELECT user_id, cast(sum(duration) AS bigint) AS total_playtime,
         cast(sum(is_win) AS bigint) AS total_wins, count(*) AS total_matches,
         count(DISTINCT session_number) AS total_sessions, avg(is_win) AS total_win_ratio,
         count(*) / count(DISTINCT session_number) AS avg_matches_per_session
  FROM matches GROUP BY ALL
)"""

_FAVORITES = """
favorites AS (
  SELECT user_id, max(map_win_ratio) AS fav_map_win_ratio,
         first(map_name ORDER BY map_win_ratio DESC, map_matches DESC,
                                 map_name NULLS LAST, map_id) AS fav_map
  FROM map_stats LEFT JOIN maps USING (map_id)
  GROUP BY user_id
)"""


def _registrations(events: str = "game") -> str:
    return f"""
registered AS (
  SELECT user_id, max(username) AS username, max(country) AS country,
         strftime(to_timestamp(min(timestamp)) AT TIME ZONE 'UTC', '%Y-%m-%d')
           AS registration_date
  FROM {events} WHERE event_type = 'registration' GROUP BY ALL
)"""


_MART = """
SELECT user_id, username, country, fav_map,
       round(fav_map_win_ratio, 3) AS fav_map_win_ratio,
       total_playtime,
       round(total_win_ratio, 3) AS total_win_ratio,
       round(avg_matches_per_session, 2) AS avg_matches_per_session,
       registration_date,
       CASE WHEN country IS NULL THEN 'missing_country' ELSE 'valid' END AS data_quality_status
FROM registered LEFT JOIN totals USING (user_id) LEFT JOIN favorites USING (user_id)
ORDER BY total_playtime DESC NULLS LAST
"""


def _statistics(events: str = "game") -> str:
    return (
        f"{_matches(events)}, {_MAP_STATS}, {_TOTALS}, {_FAVORITES}, {_registrations(events)}"
    )


def _with(*parts: str, then: str) -> str:
    return "WITH " + ",\n".join(part.strip() for part in parts) + "\n" + then.strip()


# The matches of the first delivery, before 2024-01-20 and without the week
# before 2024-01-15, as the stored table.
_FIRST = (
    """early AS (SELECT * FROM game WHERE timestamp < 1705708800
              AND (timestamp < 1704672000 OR timestamp >= 1705276800))""",
    _matches("early", "early_"),
    "stored AS (SELECT * FROM early_matches)",
)

_KEPT = """
SELECT * FROM stored ANTI JOIN delta USING (user_id, map_id, opponent_id, match_number)
UNION ALL
SELECT * FROM delta
"""

_SCHEMA_SQL = " UNION ALL ".join(
    f"""
SELECT '{table}' AS table_name, row_number() OVER () - 1 AS position, column_name,
       CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int'
            WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS data_type,
       1 AS nullable
FROM (DESCRIBE {table})"""
    for table in ("events", "customer", "orders", "lineitem")
)

_FREQ = """
SELECT {c}, count(*) AS count FROM game GROUP BY {c} ORDER BY count DESC
"""

_CHECK_ROWS = """
SELECT 'user_id_not_null' AS check_name, count(*) FILTER (user_id IS NULL) AS violations FROM mart
UNION ALL
SELECT 'user_id_unique', count(*) FROM (
  SELECT user_id FROM mart WHERE user_id IS NOT NULL GROUP BY user_id HAVING count(*) > 1)
UNION ALL
SELECT 'username_not_null', count(*) FILTER (username IS NULL) FROM mart
UNION ALL
SELECT 'registration_date_not_null', count(*) FILTER (registration_date IS NULL) FROM mart
UNION ALL
SELECT 'fav_map_win_ratio_in_range',
       count(*) FILTER (fav_map_win_ratio < 0 OR fav_map_win_ratio > 1) FROM mart
UNION ALL
SELECT 'total_win_ratio_in_range',
       count(*) FILTER (total_win_ratio < 0 OR total_win_ratio > 1) FROM mart
UNION ALL
SELECT 'total_playtime_not_negative', count(*) FILTER (total_playtime < 0) FROM mart
"""

_DAMAGED = """
mart AS (
  SELECT CASE WHEN total_playtime IS NOT NULL OR country IS NULL THEN user_id END AS user_id,
         CASE WHEN total_playtime IS NOT NULL OR country > 'NATION_2' THEN username END AS username,
         CASE WHEN registration_date >= '2024-01-05' THEN registration_date END
           AS registration_date,
         fav_map_win_ratio * 1.5 AS fav_map_win_ratio,
         total_win_ratio - 0.25 AS total_win_ratio,
         CASE WHEN country IS NULL THEN total_playtime - 1000000 ELSE total_playtime END
           AS total_playtime
  FROM (SELECT * FROM whole UNION ALL SELECT * FROM whole WHERE country IS NULL)
)
"""

# The raw lines rebuilt as JSON; json_merge_patch leaves out null members, as
# the raw lines do.
_LINES = """
lines AS (
  SELECT json_merge_patch('{}'::json, json_object(
           'id', id,
           'timestamp', CASE WHEN malformed = 1 THEN to_json('soon'::varchar)
                             ELSE to_json(timestamp) END,
           'event_type', event_type,
           'user_id', user_id,
           'event_data', json_object(
             'country', country, 'device_os', device_os, 'username', username, 'state', state,
             'map_id', map_id, 'opponent_id', opponent_id, 'outcome', outcome))) AS line
  FROM bronze WHERE event_type IS NOT NULL
),
top AS (
  SELECT f.key AS path, f.value AS field, f.type AS kind FROM lines, json_each(line) f
),
inside AS (
  SELECT 'event_data.' || f.key AS path, f.value AS field, f.type AS kind
  FROM lines, json_each(line, '$.event_data') f
),
fields AS (SELECT * FROM top UNION ALL SELECT * FROM inside)
"""

_FIELD_PROFILE = """
SELECT path,
       CASE WHEN kind IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN 'number'
            WHEN kind = 'VARCHAR' THEN 'string' ELSE lower(kind) END AS json_type,
       count(*) AS row_count,
       min(CASE WHEN kind = 'DOUBLE' THEN printf('%g', cast(field AS double))
                ELSE cast(field AS varchar) END) AS example
FROM fields GROUP BY 1, 2
"""

# A field of several kinds is a variant; the only numbers with a point are outcomes.
_MERGED_SCHEMA = """
, kinds AS (
  SELECT path,
         CASE WHEN count(DISTINCT kind) > 1 THEN 'VARIANT'
              WHEN min(kind) = 'VARCHAR' THEN 'STRING'
              WHEN min(kind) = 'DOUBLE' THEN 'DECIMAL('
                || max(length(cast(try_cast(field AS double)::bigint AS varchar)))
                  FILTER (kind = 'DOUBLE') || ',0)'
              WHEN min(kind) IN ('BIGINT', 'UBIGINT') THEN 'BIGINT' END AS type
  FROM fields WHERE kind <> 'OBJECT' GROUP BY path
),
nested AS (
  SELECT 'OBJECT<' || string_agg(substr(path, 12) || ': ' || type, ', ' ORDER BY path) || '>'
           AS type
  FROM kinds WHERE starts_with(path, 'event_data.')
),
outer_kinds AS (
  SELECT path, type FROM kinds WHERE NOT contains(path, '.')
  UNION ALL SELECT 'event_data', type FROM nested
)
SELECT 'OBJECT<' || string_agg(path || ': ' || type, ', ' ORDER BY path) || '>' AS merged_schema
FROM outer_kinds
"""

_BRONZE_SQL = _with(_GAME, _BRONZE, then=_BRONZE_ROWS)
_SESSIONS_SQL = _with(_GAME, _matches(), then="SELECT * FROM sessions")
_MATCHES_SQL = _with(_GAME, _matches(), then="SELECT * FROM matches")

ORACLES: dict[str, str] = {
    "bronze_ingest": _BRONZE_SQL,
    "bronze_incremental": _BRONZE_SQL,
    "bronze_incremental_by_date": _BRONZE_SQL,
    "table_schemas": _SCHEMA_SQL,
    "bronze_new_files": _BRONZE_SQL,
    "flat_load": _with(_GAME, _FLAT, then="SELECT * FROM flat"),
    "flat_clean": _with(
        _GAME,
        _FLAT,
        then="""
SELECT DISTINCT id AS event_id, timestamp, lower(trim(event_type)) AS event_type, user_id,
       upper(trim(country)) AS country, lower(trim(device_os)) AS device_os,
       trim(username) AS username
FROM flat WHERE id IS NOT NULL AND user_id IS NOT NULL AND event_type IS NOT NULL""",
    ),
    "profile_scan": _with(
        _GAME,
        _FLAT,
        then="""
SELECT id AS event_id, timestamp, event_type, user_id, country, device_os, username
FROM flat WHERE id IS NOT NULL AND user_id IS NOT NULL AND event_type IS NOT NULL""",
    ),
    "top_level_map_validate": _with(
        _GAME,
        _BRONZE,
        _SILVER,
        then="""
SELECT event_id, timestamp, event_type, user_id, map_id, country, device_os, username,
       validation_error, is_valid, event_second
FROM checked""",
    ),
    "silver_validate": _with(_GAME, _BRONZE, _SILVER, then="SELECT * FROM silver"),
    "silver_quarantine": _with(_GAME, _BRONZE, _SILVER, then="SELECT * FROM quarantine"),
    "silver_incremental": _with(
        _GAME, _BRONZE, _SILVER, then="SELECT * FROM silver UNION ALL SELECT * FROM quarantine"
    ),
    "maps_validate": _with(_MAP_CHECK, then="SELECT * FROM map_checked"),
    "staged_tables": _with(
        _GAME,
        _BRONZE,
        _SILVER,
        then="""
SELECT s.* EXCLUDE (validation_error, is_valid, event_second, event_date), m.map_name
FROM silver s LEFT JOIN maps m ON s.map_id = m.map_id""",
    ),
    "events_enriched": _with(
        _GAME,
        then="SELECT g.*, m.map_name FROM game g LEFT JOIN maps m ON g.map_id = m.map_id",
    ),
    "events_enriched_by_date": _with(
        _GAME,
        _BRONZE,
        _SILVER,
        then="""
SELECT s.map_id, s.event_id, s.timestamp, s.event_type, s.user_id, m.map_name
FROM silver s LEFT JOIN maps m ON s.map_id = m.map_id""",
    ),
    "unknown_maps": _with(
        _GAME,
        then="""
SELECT DISTINCT map_id FROM game
WHERE map_id IS NOT NULL AND map_id NOT IN (SELECT map_id FROM maps)""",
    ),
    "map_names": _with(_GAME, then="SELECT DISTINCT map_name FROM maps"),
    "event_sessions": _SESSIONS_SQL,
    "event_sessions_crowded": _SESSIONS_SQL,
    "match_starts": _with(
        _GAME,
        _matches(),
        then="""
SELECT user_id, map_id, opponent_id, session_number, timestamp AS start_timestamp, match_number
FROM sides WHERE event_type = 'match_start'""",
    ),
    "match_finishes": _with(
        _GAME,
        _matches(),
        then="""
SELECT user_id, map_id, opponent_id, outcome, timestamp AS finish_timestamp, match_number
FROM sides WHERE event_type = 'match_finish'""",
    ),
    "matches": _MATCHES_SQL,
    "matches_crowded": _MATCHES_SQL,
    "matches_incremental": _with(
        _GAME,
        *_FIRST,
        _matches(),
        """
delta AS (
  SELECT * FROM matches
  WHERE finish_timestamp > (SELECT coalesce(max(finish_timestamp), 0) FROM stored))""",
        then=_KEPT,
    ),
    "matches_rebuilt": _MATCHES_SQL,
    "matches_upsert": _with(
        _GAME, *_FIRST, _matches(), "delta AS (SELECT * FROM matches WHERE map_id = '3')", then=_KEPT
    ),
    "registrations": _with(_GAME, _registrations(), then="SELECT * FROM registered"),
    "registrations_first": _with(
        _GAME,
        then="""
SELECT user_id,
       arg_min(username, (timestamp, event_id)) FILTER (username IS NOT NULL) AS username,
       arg_min(country, (timestamp, event_id)) FILTER (country IS NOT NULL) AS country,
       strftime(to_timestamp(min(timestamp)) AT TIME ZONE 'UTC', '%Y-%m-%d') AS registration_date
FROM game WHERE event_type = 'registration' GROUP BY user_id""",
    ),
    "user_map_stats": _with(_GAME, _matches(), _MAP_STATS, then="SELECT * FROM map_stats"),
    "user_totals": _with(_GAME, _matches(), _TOTALS, then="SELECT * FROM totals"),
    "favorite_maps": _with(
        _GAME, _matches(), _MAP_STATS, _FAVORITES, then="SELECT * FROM favorites"
    ),
    "player_rollup": _with(
        _GAME,
        _matches(),
        _MAP_STATS,
        _TOTALS,
        _FAVORITES,
        then="SELECT * FROM totals JOIN favorites USING (user_id)",
    ),
    "player_stats": _with(
        _GAME, _statistics(), then=_MART
    ),
    "lake_player_stats": _with(
        _GAME,
        _BRONZE,
        _SILVER,
        _statistics("silver"),
        then=_MART,
    ),
    "mart_by_sql": _with(
        _GAME,
        _BRONZE,
        _SILVER,
        _statistics("silver"),
        then="""
SELECT r.user_id, f.fav_map, t.total_playtime, t.total_sessions, count(*) AS starts,
       max(s.session_number) AS last_session
FROM registered r
JOIN totals t ON r.user_id = t.user_id
JOIN favorites f ON r.user_id = f.user_id
JOIN sides s ON r.user_id = s.user_id AND s.event_type = 'match_start'
GROUP BY ALL""",
    ),
    "freq_event_type": _with(_GAME, then=_FREQ.format(c="event_type")),
    "freq_country": _with(_GAME, then=_FREQ.format(c="country")),
    "freq_device_os": _with(_GAME, then=_FREQ.format(c="device_os")),
    "distinct_values": _with(
        _GAME,
        then="""
SELECT DISTINCT 'username' AS column_name, username AS value FROM game WHERE username IS NOT NULL
UNION ALL
SELECT DISTINCT 'country', country FROM game WHERE country IS NOT NULL
UNION ALL
SELECT DISTINCT 'device_os', device_os FROM game WHERE device_os IS NOT NULL""",
    ),
    "first_events": _with(
        _GAME, then="SELECT * FROM game ORDER BY timestamp, event_id LIMIT 20"
    ),
    "layer_counts": _with(
        _GAME,
        _BRONZE,
        _SILVER,
        _MAP_CHECK,
        then="""
SELECT 'raw_events' AS layer, count(*) AS row_count FROM bronze
UNION ALL SELECT 'bronze_events', count(*) FROM bronze
UNION ALL SELECT 'silver_events', count(*) FROM silver
UNION ALL SELECT 'quarantined_events', count(*) FROM quarantine
UNION ALL SELECT 'silver_maps', count(*) FROM map_checked WHERE is_valid = 1
UNION ALL SELECT 'quarantined_maps', count(*) FROM map_checked WHERE is_valid = 0""",
    ),
    "quality_checks": _with(
        _GAME,
        _statistics(),
        f"mart AS ({_MART})",
        f"counted AS ({_CHECK_ROWS})",
        then="""
SELECT check_name, violations, CASE WHEN violations = 0 THEN 1 ELSE 0 END AS passed
FROM counted""",
    ),
    "quality_checks_damaged": _with(
        _GAME,
        _statistics(),
        f"whole AS ({_MART})",
        _DAMAGED,
        f"counted AS ({_CHECK_ROWS})",
        then="""
SELECT check_name, violations, CASE WHEN violations = 0 THEN 1 ELSE 0 END AS passed
FROM counted""",
    ),
    "raw_field_profile": _with(_GAME, _BRONZE, _LINES, then=_FIELD_PROFILE),
    "raw_schema": _with(_GAME, _BRONZE, _LINES, then=_MERGED_SCHEMA),
}
ORACLES["quality_violations_damaged"] = _with(
    _GAME,
    _statistics(),
    f"whole AS ({_MART})",
    _DAMAGED,
    """
repeated AS (SELECT user_id FROM mart WHERE user_id IS NOT NULL GROUP BY user_id HAVING count(*) > 1),
named AS (
  SELECT user_id, username, registration_date, total_playtime, list_sort(list_filter([
    CASE WHEN user_id IS NULL THEN 'user_id_not_null' END,
    CASE WHEN user_id IN (SELECT user_id FROM repeated) THEN 'user_id_unique' END,
    CASE WHEN username IS NULL THEN 'username_not_null' END,
    CASE WHEN registration_date IS NULL THEN 'registration_date_not_null' END,
    CASE WHEN fav_map_win_ratio NOT BETWEEN 0 AND 1 THEN 'fav_map_win_ratio_in_range' END,
    CASE WHEN total_win_ratio NOT BETWEEN 0 AND 1 THEN 'total_win_ratio_in_range' END,
    CASE WHEN total_playtime < 0 THEN 'total_playtime_not_negative' END], lambda x: x IS NOT NULL)) AS broken
  FROM mart)""",
    then="""
SELECT user_id, username, registration_date, total_playtime, array_to_string(broken, ',') AS broken
FROM named WHERE len(broken) > 0""",
)
ORACLES["quality_checks_matches"] = _with(
    _GAME,
    _matches(),
    """
played AS (
  SELECT user_id, CASE WHEN duration % 5 <> 0 THEN map_id END AS map_id, opponent_id, match_number,
         duration - 3600 AS duration, is_win + CASE WHEN opponent_id = '1' THEN 1 ELSE 0 END AS is_win,
         CASE WHEN match_number > 1 THEN outcome * 2 END AS outcome
  FROM (SELECT * FROM matches UNION ALL SELECT * FROM matches WHERE map_id = '2')),
counted AS (
  SELECT 'user_id_map_id_opponent_id_match_number_unique' AS check_name, count(*) AS violations FROM (
    SELECT 1 FROM played WHERE user_id IS NOT NULL AND map_id IS NOT NULL AND opponent_id IS NOT NULL
    GROUP BY user_id, map_id, opponent_id, match_number HAVING count(*) > 1)
  UNION ALL SELECT 'user_id_not_null', count(*) FILTER (user_id IS NULL) FROM played
  UNION ALL SELECT 'map_id_not_null', count(*) FILTER (map_id IS NULL) FROM played
  UNION ALL SELECT 'opponent_id_not_null', count(*) FILTER (opponent_id IS NULL) FROM played
  UNION ALL SELECT 'duration_not_negative', count(*) FILTER (duration < 0) FROM played
  UNION ALL SELECT 'is_win_accepted', count(*) FILTER (is_win NOT IN (0, 1)) FROM played
  UNION ALL SELECT 'outcome_in_range', count(*) FILTER (outcome NOT BETWEEN 0 AND 1) FROM played)""",
    then="SELECT check_name, violations, CASE WHEN violations = 0 THEN 1 ELSE 0 END AS passed FROM counted",
)
ORACLES["layer_counts_noted"] = _with(
    _GAME,
    _BRONZE,
    _SILVER,
    _MAP_CHECK,
    then="""
SELECT 'bronze_events' AS layer, count(*) AS row_count FROM bronze
UNION ALL SELECT 'bronze_maps', count(*) + sum(is_valid)::BIGINT FROM map_checked -- good lines come twice
UNION ALL SELECT 'silver_events', count(*) FROM silver
UNION ALL SELECT 'quarantined_events', count(*) FROM quarantine
UNION ALL SELECT 'silver_maps', count(*) FROM map_checked WHERE is_valid = 1
UNION ALL SELECT 'quarantined_maps', count(*) FROM map_checked WHERE is_valid = 0""",
)
# Other plans for the same rows.
ORACLES["silver_incremental_by_id"] = ORACLES["silver_incremental"]
ORACLES["matches_followed"] = ORACLES["matches_incremental"]
ORACLES["lake_player_stats_followed"] = ORACLES["lake_player_stats"]

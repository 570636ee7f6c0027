"""Where the layers live."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Lake:
    root: str

    def _table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def raw_events(self) -> str:
        return self._table("raw/events.jsonl")

    @property
    def raw_maps(self) -> str:
        return self._table("raw/maps.jsonl")

    @property
    def bronze_events(self) -> str:
        return self._table("bronze/events")

    @property
    def bronze_keys(self) -> str:
        return self._table("bronze/event_keys")

    @property
    def bronze_progress(self) -> str:
        return self._table("bronze/progress")

    @property
    def bronze_maps(self) -> str:
        return self._table("bronze/maps")

    @property
    def silver_events(self) -> str:
        return self._table("silver/events")

    @property
    def silver_keys(self) -> str:
        return self._table("silver/event_keys")

    @property
    def silver_progress(self) -> str:
        return self._table("silver/progress")

    @property
    def silver_maps(self) -> str:
        return self._table("silver/maps")

    @property
    def enriched_events(self) -> str:
        return self._table("silver/events_enriched")

    @property
    def quarantined_events(self) -> str:
        return self._table("quarantine/events")

    @property
    def quarantine_keys(self) -> str:
        return self._table("quarantine/record_keys")

    @property
    def quarantined_maps(self) -> str:
        return self._table("quarantine/maps")

    @property
    def matches(self) -> str:
        return self._table("gold/int_matches")

    @property
    def carried(self) -> str:
        return self._table("gold/carried")

    @property
    def gold_progress(self) -> str:
        return self._table("gold/progress")

    @property
    def map_sums(self) -> str:
        return self._table("gold/map_sums")

    @property
    def session_sums(self) -> str:
        return self._table("gold/session_sums")

    @property
    def user_map_stats(self) -> str:
        return self._table("gold/int_user_map_stats")

    @property
    def user_totals(self) -> str:
        return self._table("gold/int_user_totals")

    @property
    def crowded_players(self) -> str:
        return self._table("gold/crowded_players.json")

    @property
    def player_stats(self) -> str:
        return self._table("gold/mart_player_stats")

    @property
    def ledger(self) -> str:
        return self._table("ledger")

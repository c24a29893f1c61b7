"""Thresholds used by the plans."""

from __future__ import annotations

from dataclasses import dataclass

# They must equal the source pipeline's variables and lookup tables.
RACE_TYPES = ("Race", "Sprint")
QUALIFYING_TYPES = ("Qualifying", "Sprint Qualifying", "Sprint Shootout")
SESSION_TYPES = ("Practice", "Qualifying", "Race", "Sprint", "Sprint Shootout", "Sprint Qualifying")
COMPOUNDS = ("SOFT", "MEDIUM", "HARD", "INTERMEDIATE", "WET", "UNKNOWN", "TEST_UNKNOWN")
POINTS = {1: 25, 2: 18, 3: 15, 4: 12, 5: 10, 6: 8, 7: 6, 8: 4, 9: 2, 10: 1}
DRS_STATES = (0, 1, 2, 3, 8, 9, 10, 11, 12, 13, 14, 15)
DRS_ACTIVE = (10, 12, 14)
DRS_DETECTED = (8, 10, 12, 14)
NULL_TOKENS = ("None", "null", "NULL", "")


@dataclass(frozen=True)
class Settings:
    lookback_days: int = 3
    min_telemetry_samples: int = 3
    lap_seconds: tuple[float, float] = (40.0, 300.0)
    sector_seconds: tuple[float, float] = (5.0, 120.0)
    stop_seconds: tuple[float, float] = (0.0, 120.0)
    lane_seconds: tuple[float, float] = (0.0, 1800.0)
    min_tyre_laps: int = 5
    full_throttle_from: int = 95
    open_lap_minutes: int = 5
    weather_minutes: int = 5
    replay_minutes: int = 30
    # laps of one driver kept together when an ordered scan splits a long history
    lap_bucket: int = 1024
    # reproduce two known quirks of the source pipeline instead of the documented meaning
    compat: bool = False


DEFAULTS = Settings()

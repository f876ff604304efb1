"""Declared schemas of the raw tables, of the landed source feeds, and their keys.

Every column is nullable. Nothing is ever inferred from files.
"""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, WHOLE, REAL, FLAG = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()
DAY, INSTANT, LOCAL_TIME = T.DateType(), T.TimestampType(), T.TimestampNTZType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


# Names and types of the raw tables and their columns.
RAW = {
    "sessions": _schema(
        session_id=TEXT, season=WHOLE, round_number=WHOLE, country=TEXT, location=TEXT,
        circuit_key=TEXT, session_type=TEXT, session_date=DAY, loaded_at=INSTANT,
    ),
    "results": _schema(
        session_id=TEXT, driver_number=TEXT, abbreviation=TEXT, full_name=TEXT, team_name=TEXT,
        grid_position=REAL, finish_position=REAL, points=REAL, status=TEXT, time=TEXT,
        loaded_at=INSTANT,
    ),
    "laps": _schema(
        session_id=TEXT, driver_number=TEXT, abbreviation=TEXT, lap_number=WHOLE,
        lap_time_seconds=REAL, sector_1_seconds=REAL, sector_2_seconds=REAL,
        sector_3_seconds=REAL, compound=TEXT, tyre_life=REAL, is_personal_best=FLAG,
        pit_in_time_seconds=REAL, pit_out_time_seconds=REAL, track_status=TEXT,
        loaded_at=INSTANT,
    ),
    "pit_stops": _schema(
        session_id=TEXT, driver_number=TEXT, abbreviation=TEXT, stop_number=WHOLE,
        lap_number=WHOLE, pit_duration_seconds=REAL, loaded_at=INSTANT,
    ),
    "weather": _schema(
        session_id=TEXT, timestamp=TEXT, air_temp=REAL, track_temp=REAL, humidity=REAL,
        rainfall=FLAG, wind_speed=REAL, loaded_at=INSTANT,
    ),
    "drivers": _schema(
        driver_number=TEXT, abbreviation=TEXT, full_name=TEXT, nationality=TEXT, team_name=TEXT,
        season=WHOLE, loaded_at=INSTANT,
    ),
    "circuits": _schema(
        circuit_key=TEXT, circuit_name=TEXT, country=TEXT, location=TEXT, loaded_at=INSTANT,
    ),
}

# Columns of the landed source feeds, as the timing library names them.
# Durations land as whole nanoseconds, which is how a pandas timedelta is stored in parquet.
SOURCE = {
    "events": _schema(
        season=WHOLE, round_number=WHOLE, session_type=TEXT, Country=TEXT, Location=TEXT,
        OfficialEventName=TEXT, SessionDate=LOCAL_TIME, loaded_at=LOCAL_TIME,
    ),
    "results": _schema(
        session_id=TEXT, season=WHOLE, DriverNumber=TEXT, Abbreviation=TEXT, FullName=TEXT,
        TeamName=TEXT, CountryCode=TEXT, GridPosition=TEXT, Position=TEXT, Points=REAL,
        Status=TEXT, Time=TEXT, loaded_at=LOCAL_TIME,
    ),
    "laps": _schema(
        session_id=TEXT, DriverNumber=TEXT, Driver=TEXT, LapNumber=REAL, LapTime=WHOLE,
        Sector1Time=WHOLE, Sector2Time=WHOLE, Sector3Time=WHOLE, Compound=TEXT, TyreLife=REAL,
        IsPersonalBest=FLAG, PitInTime=WHOLE, PitOutTime=WHOLE, TrackStatus=TEXT,
        loaded_at=LOCAL_TIME,
    ),
    "weather": _schema(
        session_id=TEXT, Time=WHOLE, AirTemp=REAL, TrackTemp=REAL, Humidity=REAL, Rainfall=FLAG,
        WindSpeed=REAL, loaded_at=LOCAL_TIME,
    ),
    "schedule": _schema(season=WHOLE, RoundNumber=WHOLE, EventDate=LOCAL_TIME),
}

# One row per key once duplicates are removed.
NATURAL_KEYS = {
    "sessions": ["session_id"],
    "results": ["session_id", "driver_number"],
    "laps": ["session_id", "driver_number", "lap_number"],
    "pit_stops": ["session_id", "driver_number", "stop_number"],
    "weather": ["session_id", "timestamp"],
    "drivers": ["abbreviation", "season"],
    "circuits": ["circuit_key"],
}

# Feeds whose rows name the session they were loaded from.
SESSION_FEEDS = ["results", "laps", "weather", "pit_stops"]

SESSION_TYPES = ["Q", "R"]

# Rounds each season is expected to have.
SEASON_ROUNDS = {2021: 22, 2022: 22, 2023: 22, 2024: 24, 2025: 24}

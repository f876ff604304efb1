"""Typed staging relations over the raw tables.

Results, drivers and circuits keep the latest row per key. Sessions, laps, pit
stops and weather keep every row, so a session loaded twice counts twice
downstream; ``dedupe=True`` keeps the latest row per natural key there too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackside.functions import is_classified, race_name, session_type_name, whole_number
from trackside.operators import latest_by_key
from trackside.schemas import NATURAL_KEYS


def _latest(df: DataFrame, feed: str, tiebreak: Sequence[str] | None) -> DataFrame:
    """Latest load per natural key; without a given tie-break all other columns decide."""
    keys = NATURAL_KEYS[feed]
    if tiebreak is None:
        tiebreak = [c for c in df.columns if c not in {*keys, "loaded_at"}]
    return latest_by_key(df, keys, ["loaded_at"], tiebreak)


def stage_sessions(raw: DataFrame, dedupe: bool = False) -> DataFrame:
    """Sessions with a readable type and the race name."""
    kept = raw.filter(F.col("session_id").isNotNull())
    if dedupe:
        kept = _latest(kept, "sessions", None)
    return kept.select(
        "session_id", "season", "round_number", "country", "location", "circuit_key",
        "session_type", "session_date", "loaded_at",
        session_type_name("session_type").alias("session_type_name"),
        race_name("season", "country").alias("race_name"),
    )


def stage_results(raw: DataFrame, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """The latest result per session and driver, with whole positions."""
    kept = _latest(raw.filter(F.col("session_id").isNotNull()), "results", tiebreak)
    grid, finish = whole_number(F.col("grid_position")), whole_number(F.col("finish_position"))
    return kept.select(
        "session_id", "driver_number", "abbreviation", "full_name", "team_name",
        grid.alias("grid_position"),
        finish.alias("finish_position"),
        "points", "status",
        F.col("time").alias("finish_time"),
        "loaded_at",
        (grid - finish).alias("positions_gained"),
        is_classified("status").alias("is_classified"),
    )


def stage_laps(raw: DataFrame, dedupe: bool = False) -> DataFrame:
    """Laps with upper-case compound, whole tyre life and pit and track flags."""
    kept = raw.filter(F.col("session_id").isNotNull() & F.col("lap_number").isNotNull())
    if dedupe:
        kept = _latest(kept, "laps", None)
    return kept.select(
        "session_id", "driver_number", "abbreviation", "lap_number", "lap_time_seconds",
        "sector_1_seconds", "sector_2_seconds", "sector_3_seconds",
        F.upper("compound").alias("compound"),
        whole_number(F.col("tyre_life")).alias("tyre_life"),
        "is_personal_best", "pit_in_time_seconds", "pit_out_time_seconds", "track_status",
        "loaded_at",
        F.col("pit_in_time_seconds").isNotNull().alias("is_pit_in_lap"),
        F.col("pit_out_time_seconds").isNotNull().alias("is_pit_out_lap"),
        # NULL for an unknown track status, on purpose.
        (F.col("track_status") != "1").alias("is_abnormal_track_status"),
    )


def stage_pit_stops(raw: DataFrame, dedupe: bool = False) -> DataFrame:
    kept = raw.filter(F.col("session_id").isNotNull())
    if dedupe:
        kept = _latest(kept, "pit_stops", None)
    return kept.select(
        "session_id", "driver_number", "abbreviation", "lap_number", "stop_number",
        "pit_duration_seconds", "loaded_at",
    )


def stage_weather(raw: DataFrame, dedupe: bool = False) -> DataFrame:
    kept = raw.filter(F.col("session_id").isNotNull())
    if dedupe:
        kept = _latest(kept, "weather", None)
    return kept.select(
        "session_id", F.col("timestamp").alias("reading_time"), "air_temp", "track_temp",
        "humidity", "rainfall", "wind_speed", "loaded_at",
    )


def stage_drivers(raw: DataFrame, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """The latest row per driver and season."""
    kept = _latest(raw.filter(F.col("abbreviation").isNotNull()), "drivers", tiebreak)
    return kept.select(
        "driver_number", "abbreviation", "full_name", "team_name", "nationality", "season",
        "loaded_at",
    )


def stage_circuits(raw: DataFrame, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """The latest row per circuit key."""
    kept = _latest(raw.filter(F.col("circuit_key").isNotNull()), "circuits", tiebreak)
    return kept.select("circuit_key", "circuit_name", "country", "location", "loaded_at")

"""Landed source feeds to raw rows, for all sessions of a load at once.

``carry`` names extra source columns to keep, such as tie-breaks for a later
deduplication. ``loaded_at`` stamps a whole load with one instant; without it
the feed's own ``loaded_at`` column is used.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackside.functions import (
    build_session_id,
    clean_real,
    duration_seconds,
    duration_text,
    to_real,
)
from trackside.operators import next_row_lookup, sequence_within
from trackside.operators.ordered import Order

Stamp = datetime | None
Carry = Sequence[str | Column]


def _stamp(loaded_at: Stamp) -> Column:
    return F.col("loaded_at") if loaded_at is None else F.lit(loaded_at).alias("loaded_at")


def _text(df: DataFrame, name: str) -> Column:
    """Event text, empty when the event does not have it."""
    if name not in df.columns:
        return F.lit("")
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def shape_sessions(events: DataFrame, loaded_at: Stamp = None) -> DataFrame:
    """One session row per event and session type."""
    return events.select(
        build_session_id("season", "round_number", "session_type").alias("session_id"),
        F.col("season").cast("bigint").alias("season"),
        F.col("round_number").cast("bigint").alias("round_number"),
        _text(events, "Country").alias("country"),
        _text(events, "Location").alias("location"),
        _text(events, "OfficialEventName").alias("circuit_key"),
        "session_type",
        F.to_date("SessionDate").alias("session_date"),
        _stamp(loaded_at),
    )


def shape_results(
    results: DataFrame, loaded_at: Stamp = None, carry: Carry = ()
) -> DataFrame:
    """Result rows; positions that are no number become NULL."""
    return results.select(
        "session_id",
        F.col("DriverNumber").alias("driver_number"),
        F.col("Abbreviation").alias("abbreviation"),
        F.col("FullName").alias("full_name"),
        F.col("TeamName").alias("team_name"),
        to_real("GridPosition").alias("grid_position"),
        to_real("Position").alias("finish_position"),
        clean_real(F.col("Points")).alias("points"),
        F.col("Status").alias("status"),
        duration_text(results, "Time").alias("time"),
        _stamp(loaded_at),
        *carry,
    )


def shape_laps(laps: DataFrame, loaded_at: Stamp = None, carry: Carry = ()) -> DataFrame:
    """Lap rows with the six durations in seconds."""
    return laps.select(
        "session_id",
        F.col("DriverNumber").alias("driver_number"),
        F.col("Driver").alias("abbreviation"),
        clean_real(F.col("LapNumber")).cast("bigint").alias("lap_number"),
        duration_seconds(laps, "LapTime").alias("lap_time_seconds"),
        duration_seconds(laps, "Sector1Time").alias("sector_1_seconds"),
        duration_seconds(laps, "Sector2Time").alias("sector_2_seconds"),
        duration_seconds(laps, "Sector3Time").alias("sector_3_seconds"),
        F.col("Compound").alias("compound"),
        clean_real(F.col("TyreLife")).alias("tyre_life"),
        F.col("IsPersonalBest").alias("is_personal_best"),
        duration_seconds(laps, "PitInTime").alias("pit_in_time_seconds"),
        duration_seconds(laps, "PitOutTime").alias("pit_out_time_seconds"),
        F.col("TrackStatus").alias("track_status"),
        _stamp(loaded_at),
        *carry,
    )


def shape_weather(
    weather: DataFrame, events: DataFrame, loaded_at: Stamp = None, carry: Carry = ()
) -> DataFrame:
    """Weather rows; the reading time is session start plus offset, as text to the second."""
    starts = events.select(
        build_session_id("season", "round_number", "session_type").alias("session_id"),
        F.col("SessionDate").alias("_start"),
    )
    offset = F.make_dt_interval(
        secs=F.col("_offset").cast("decimal(18,6)")
    )
    return (
        weather.withColumn("_offset", duration_seconds(weather, "Time"))
        .join(starts, "session_id", "left")
        .select(
            "session_id",
            F.date_format(F.col("_start") + offset, "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
            clean_real(F.col("AirTemp")).alias("air_temp"),
            clean_real(F.col("TrackTemp")).alias("track_temp"),
            clean_real(F.col("Humidity")).alias("humidity"),
            F.col("Rainfall").alias("rainfall"),
            clean_real(F.col("WindSpeed")).alias("wind_speed"),
            _stamp(loaded_at),
            *carry,
        )
    )


def shape_drivers(
    results: DataFrame, loaded_at: Stamp = None, carry: Carry = ()
) -> DataFrame:
    """Driver rows of a season, one per result row."""
    return results.select(
        F.col("DriverNumber").alias("driver_number"),
        F.col("Abbreviation").alias("abbreviation"),
        F.col("FullName").alias("full_name"),
        F.col("CountryCode").alias("nationality"),
        F.col("TeamName").alias("team_name"),
        F.col("season").cast("bigint").alias("season"),
        _stamp(loaded_at),
        *carry,
    )


def shape_circuits(
    events: DataFrame, loaded_at: Stamp = None, carry: Carry = ()
) -> DataFrame:
    """One circuit row per event and session; the key is the event's official name."""
    return events.select(
        _text(events, "OfficialEventName").alias("circuit_key"),
        _text(events, "Location").alias("circuit_name"),
        _text(events, "Country").alias("country"),
        _text(events, "Location").alias("location"),
        _stamp(loaded_at),
        *carry,
    )


def extract_pit_stops(
    laps: DataFrame, order: Order | None = None, block: Column | None = None
) -> DataFrame:
    """Pit events from raw laps: laps with a pit-in time, numbered per driver.

    In order of the lap, laps without a number last, then of the pit-in and pit-out time and
    the load. ``block`` may cut a driver's stops, rising with that order (``operators.ordered``).

    ``pit_duration_seconds`` is pit-out minus pit-in *of the same lap row*. A car
    normally leaves the pits on its next lap, so this is NULL or negative for an
    ordinary stop; ``pit_lane_time`` gives the time spent in the pit lane.
    """
    stops = laps.filter(F.col("pit_in_time_seconds").isNotNull()).withColumn(
        "pit_duration_seconds", F.col("pit_out_time_seconds") - F.col("pit_in_time_seconds")
    )
    order = order or [
        F.col("lap_number").asc_nulls_last(), "pit_in_time_seconds",
        F.col("pit_out_time_seconds").asc_nulls_last(), "loaded_at",
    ]
    return sequence_within(
        stops, ["session_id", "driver_number"], order, "stop_number", block
    ).select(
        "session_id", "driver_number", "abbreviation", "stop_number", "lap_number",
        "pit_duration_seconds", "loaded_at",
    )


def pit_lane_time(laps: DataFrame) -> DataFrame:
    """Time from pit-in to the pit-out of the following lap; NULL if that lap is missing."""
    keys = ["session_id", "driver_number"]
    stops = laps.filter(F.col("pit_in_time_seconds").isNotNull()).select(
        *keys, "abbreviation", "lap_number", "pit_in_time_seconds"
    )
    leaving = laps.filter(F.col("pit_out_time_seconds").isNotNull())
    return next_row_lookup(
        stops, leaving, keys, "lap_number", {"pit_out_time_seconds": "_left_at"}
    ).select(
        *keys, "abbreviation", "lap_number",
        (F.col("_left_at") - F.col("pit_in_time_seconds")).alias("pit_lane_seconds"),
    )

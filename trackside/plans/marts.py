"""Analytical tables over the staging relations."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackside.operators import (
    delta_to_median,
    hot,
    islands,
    latest_by_key,
    next_row_lookup,
    rank_within,
    running_total,
)

RACE, QUALIFYING = "R", "Q"


def _sessions_of(sessions: DataFrame, kind: str, *columns: str) -> DataFrame:
    return sessions.filter(F.col("session_type") == kind).select("session_id", *columns)


def race_results(results: DataFrame, sessions: DataFrame) -> DataFrame:
    """Race result rows with the attributes of their session."""
    races = _sessions_of(
        sessions, RACE,
        "season", "round_number", "race_name", "country", "location", "session_date",
    )
    return results.join(races, "session_id").select(
        "season", "round_number", "race_name", "country", "location", "session_date",
        "session_id", "driver_number", "abbreviation", "full_name", "team_name",
        "grid_position", "finish_position", "positions_gained", "points", "status",
        "finish_time", "is_classified",
        (~F.col("is_classified")).alias("is_dnf"),
    )


def qualifying_results(results: DataFrame, sessions: DataFrame) -> DataFrame:
    """Qualifying rows; the finishing position is the qualifying position."""
    qualifying = _sessions_of(
        sessions, QUALIFYING, "season", "round_number", "race_name", "session_date"
    )
    return results.join(qualifying, "session_id").select(
        "season", "round_number", "race_name", "session_date", "session_id", "abbreviation",
        "full_name", "team_name",
        F.col("finish_position").alias("qualifying_position"),
    )


def driver_totals(race: DataFrame) -> DataFrame:
    """Points of each round and so far, per driver; missing points count as none."""
    scored = race.select(
        "season", "round_number", "race_name", "session_date", "abbreviation", "full_name",
        "team_name",
        F.coalesce("points", F.lit(0.0)).alias("round_points"),
        "session_id", "driver_number",
    )
    return running_total(
        scored, "round_points", ["season", "abbreviation"],
        ["round_number", "session_id", "driver_number"], "cumulative_points",
    ).drop("session_id", "driver_number")


def driver_standings(race: DataFrame) -> DataFrame:
    """Points so far and championship position after each round a driver took part in.

    Ties share a position.
    """
    return rank_within(
        driver_totals(race), ["season", "round_number"], "cumulative_points",
        "championship_position",
    )


def final_standings(standings: DataFrame) -> DataFrame:
    """Each driver's last row of the season, ranked; leavers keep their points."""
    last = latest_by_key(
        standings, ["season", "abbreviation"], ["round_number"],
        ["cumulative_points", "full_name", "team_name"],
    ).select(
        "season", "abbreviation", "full_name", "team_name",
        F.col("cumulative_points").alias("final_points"),
        F.col("round_number").alias("last_round_raced"),
    )
    return rank_within(last, ["season"], "final_points", "final_championship_position")


def constructor_standings(race: DataFrame) -> DataFrame:
    """Team points per round, so far, and the position after each round."""
    per_round = race.groupBy(
        "season", "round_number", "race_name", "session_date", "team_name"
    ).agg(F.sum(F.coalesce("points", F.lit(0.0))).alias("team_points"))
    running = running_total(
        per_round, "team_points", ["season", "team_name"],
        ["round_number", "race_name", "session_date"], "cumulative_points",
    )
    return rank_within(
        running, ["season", "round_number"], "cumulative_points", "constructor_position"
    )


# Laps of a driver and race that meet in one task where a table of laps is worked on in order.
LAPS_PER_BLOCK = 1000
SECONDS_PER_BLOCK = 10


def _lap_block(size: int = LAPS_PER_BLOCK) -> Column:
    return F.floor(F.col("lap_number") / size)


def lap_times(
    laps: DataFrame, sessions: DataFrame, block_seconds: float = SECONDS_PER_BLOCK
) -> DataFrame:
    """Race laps with a clean-lap flag and the gap to the driver's median lap of the race.

    An unknown track status leaves the flag NULL unless something else rules the
    lap out. The median covers all the driver's laps, clean or not.
    """
    return delta_to_median(
        _race_laps(laps, sessions), "lap_time_seconds", ["session_id", "abbreviation"],
        "delta_to_driver_median", block=F.floor(F.col("lap_time_seconds") / block_seconds),
    )


def lap_times_once(laps: DataFrame, sessions: DataFrame, hot_rows: int = hot.HOT_ROWS) -> DataFrame:
    """``lap_times`` where it is going to be stored: laps meet their sessions once, and no block is given."""
    return hot.delta_to_median(
        _race_laps(laps, sessions), "lap_time_seconds", ["session_id", "abbreviation"],
        "delta_to_driver_median", hot_rows=hot_rows,
    )


def lap_times_in_place(laps: DataFrame, sessions: DataFrame) -> DataFrame:
    """``lap_times`` over laps that are stored in buckets of session and driver: no lap moves."""
    return hot.delta_in_place(
        _race_laps(laps, sessions), "lap_time_seconds", ["session_id", "abbreviation"],
        "delta_to_driver_median",
    )


def _race_laps(laps: DataFrame, sessions: DataFrame) -> DataFrame:
    races = _sessions_of(sessions, RACE, "season", "round_number", "race_name")
    clean = (
        F.col("lap_time_seconds").isNotNull()
        & ~F.col("is_pit_in_lap") & ~F.col("is_pit_out_lap") & ~F.col("is_abnormal_track_status")
    )
    return laps.join(races, "session_id").select(
        "season", "round_number", "race_name", "session_id", "abbreviation", "driver_number",
        "lap_number", "lap_time_seconds", "sector_1_seconds", "sector_2_seconds",
        "sector_3_seconds", "compound", "tyre_life", "is_personal_best", "is_pit_in_lap",
        "is_pit_out_lap", "is_abnormal_track_status",
        clean.alias("is_clean_lap"),
    )


def pit_stops(stops: DataFrame, sessions: DataFrame, laps: DataFrame) -> DataFrame:
    """Race pit stops with the tyres the car carried on its next lap."""
    races = _sessions_of(sessions, RACE, "season", "round_number", "race_name")
    fitted = next_row_lookup(
        stops.join(races, "session_id"), laps, ["session_id", "abbreviation"], "lap_number",
        {"compound": "compound_after_stop", "tyre_life": "tyre_age_after_stop"},
    )
    return fitted.select(
        "season", "round_number", "race_name", "session_id", "abbreviation", "driver_number",
        "stop_number", "lap_number", "pit_duration_seconds", "compound_after_stop",
        "tyre_age_after_stop",
    )


def tyre_strategy(
    laps: DataFrame, sessions: DataFrame, block_laps: int = LAPS_PER_BLOCK
) -> DataFrame:
    """Stints per driver and race.

    A stint starts on lap 1 and on every pit-out lap. Laps without a known
    compound are dropped first, so a lost lap 1 leaves stint 0 and a lost pit-out
    lap joins two stints.
    """
    numbered = islands(
        _known_laps(laps, sessions), _starts_stint(), STINT_KEYS, STINT_ORDER, "stint_number",
        _lap_block(block_laps),
    )
    return _stints(numbered)


def tyre_strategy_once(laps: DataFrame, sessions: DataFrame, hot_rows: int = hot.HOT_ROWS) -> DataFrame:
    """``tyre_strategy`` where it is going to be stored: laps meet their sessions once, and no block is given."""
    return _stints(hot.islands(
        _known_laps(laps, sessions), _starts_stint(), STINT_KEYS, STINT_ORDER, "stint_number", hot_rows
    ))


def tyre_strategy_in_place(laps: DataFrame, sessions: DataFrame) -> DataFrame:
    """``tyre_strategy`` over laps that are stored in buckets of session and driver: no lap moves."""
    return _stints(islands(
        _known_laps(laps, sessions), _starts_stint(), STINT_KEYS, STINT_ORDER, "stint_number"
    ))


STINT_KEYS = ["session_id", "abbreviation"]
# The lap decides; the rest only makes copies of a lap come in a fixed order.
STINT_ORDER = ["lap_number", "is_pit_out_lap", "lap_time_seconds", "compound"]


def _starts_stint() -> Column:
    return (F.col("lap_number") == 1) | F.col("is_pit_out_lap")


def _known_laps(laps: DataFrame, sessions: DataFrame) -> DataFrame:
    races = _sessions_of(sessions, RACE, "season", "round_number", "race_name")
    return (
        laps.filter(F.col("compound").isNotNull())
        .select(
            "session_id", "abbreviation", "lap_number", "lap_time_seconds", "compound",
            "is_pit_out_lap",
        )
        .join(races, "session_id")
    )


def _stints(numbered: DataFrame) -> DataFrame:
    return numbered.groupBy(
        "season", "round_number", "race_name", "session_id", "abbreviation", "stint_number"
    ).agg(
        F.min("compound").alias("compound"),
        F.min("lap_number").alias("stint_start_lap"),
        F.max("lap_number").alias("stint_end_lap"),
        F.count(F.lit(1)).alias("stint_length"),
        F.avg("lap_time_seconds").alias("avg_lap_time"),
        F.min("lap_time_seconds").alias("best_lap_time"),
    )


def season_calendar(sessions: DataFrame, as_of: date | None = None) -> DataFrame:
    """Races in calendar order, completed if dated before ``as_of`` (today by default)."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    return (
        sessions.filter(F.col("session_type") == RACE)
        .select(
            "season", "round_number", "race_name", "country", "location", "circuit_key",
            F.col("session_date").alias("race_date"),
            F.when(F.col("session_date") < today, "completed")
            .otherwise("upcoming").alias("race_status"),
        )
        .orderBy("season", "round_number")
    )


def race_summary(race: DataFrame, qualifying: DataFrame) -> DataFrame:
    """Winner and pole sitter of each race; both sides are reduced before they join."""
    winners = race.groupBy("season", "round_number", "race_name", "country", "location").agg(
        F.max(F.when(F.col("finish_position") == 1, F.col("abbreviation"))).alias("race_winner")
    )
    poles = (
        qualifying.filter(F.col("qualifying_position") == 1)
        .groupBy("season", "round_number").agg(F.max("abbreviation").alias("pole_sitter"))
    )
    return winners.join(poles, ["season", "round_number"], "left").select(
        "season", "round_number", "race_name", "country", "location", "race_winner",
        "pole_sitter",
    )


def pit_summary(stops: DataFrame) -> DataFrame:
    """Stops per driver who stopped, for each race."""
    return stops.groupBy("season", "round_number").agg(
        F.try_divide(F.count(F.lit(1)), F.count_distinct("abbreviation"))
        .alias("avg_stops_per_driver")
    )


def circuit_stats(race: DataFrame, qualifying: DataFrame, stops: DataFrame) -> DataFrame:
    """Races held, pole-to-win conversion and mean stops per location and country."""
    races = race_summary(race, qualifying).join(
        pit_summary(stops), ["season", "round_number"], "left"
    )
    converted = F.count_if(F.col("race_winner") == F.col("pole_sitter"))
    return races.groupBy("location", "country").agg(
        F.count_distinct("season", "round_number").alias("races_held"),
        converted.alias("pole_to_win_count"),
        F.round(converted / F.count(F.lit(1)) * 100, 1).alias("pole_to_win_pct"),
        F.round(F.avg("avg_stops_per_driver"), 2).alias("avg_pit_stops_per_driver"),
    )

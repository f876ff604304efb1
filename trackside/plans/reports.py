"""Report queries over the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackside.operators import group_quantile


def _season(df: DataFrame, season: int | None) -> DataFrame:
    """Restrict to one season; reports without one cover them all."""
    return df if season is None else df.filter(F.col("season") == season)


def standings(final: DataFrame, season: int | None = None) -> DataFrame:
    """Season standings in championship order."""
    return (
        _season(final, season)
        .select(
            "season", "final_championship_position", "abbreviation", "full_name", "team_name",
            "final_points", "last_round_raced",
        )
        .orderBy("season", "final_championship_position", "abbreviation")
    )


def points_progression(drivers: DataFrame, season: int | None = None) -> DataFrame:
    """Points after each round, per driver."""
    return (
        _season(drivers, season)
        .select(
            "season", "abbreviation", "round_number", "round_points", "cumulative_points",
            "championship_position",
        )
        .orderBy("season", "abbreviation", "round_number")
    )


def gap_to_leader(totals: DataFrame, season: int | None = None) -> DataFrame:
    """Points each driver is behind the leader after each round.

    ``totals`` are the drivers' points so far (``marts.driver_totals`` or the standings); the leader's are
    the highest of the round, which has one row per driver.
    """
    leader = F.max("cumulative_points").over(Window.partitionBy("season", "round_number"))
    return _season(totals, season).select(
        "season", "round_number", "abbreviation", "cumulative_points",
        leader.alias("leader_points"),
        (leader - F.col("cumulative_points")).alias("gap_to_leader"),
    )


def team_wins_dnfs(race: DataFrame, season: int | None = None) -> DataFrame:
    """Wins and retirements per season and team."""
    return _season(race, season).groupBy("season", "team_name").agg(
        F.count_if(F.col("finish_position") == 1).alias("wins"),
        F.count_if("is_dnf").alias("dnfs"),
        F.count(F.lit(1)).alias("starts"),
    )


def clean_pace(laps: DataFrame, season: int | None = None, block_seconds: float = 10) -> DataFrame:
    """Mean and median clean lap per driver and race, from one grouping by lap time."""
    keys = ["season", "round_number", "session_id", "abbreviation"]
    time, rows = F.col("lap_time_seconds"), F.col("_rows")
    # Narrow enough that the product keeps all twelve digits behind the point.
    exact = time.cast("decimal(25,12)") * rows.cast("decimal(12,0)")
    paced = group_quantile(
        _season(laps, season).filter("is_clean_lap"), "lap_time_seconds", keys, "median_lap_time",
        block=F.floor(time / block_seconds),
        others=[
            F.sum("_rows").alias("clean_laps"),
            (F.sum(exact).cast("double") / F.sum("_rows")).alias("avg_lap_time"),
            F.min("lap_time_seconds").alias("best_lap_time"),
        ],
    )
    return paced.select(
        *keys, "clean_laps", "avg_lap_time", "median_lap_time", "best_lap_time"
    )


def grid_vs_finish(race: DataFrame, season: int | None = None) -> DataFrame:
    """Mean grid slot, mean finish and places gained per driver and season."""
    return _season(race, season).groupBy("season", "abbreviation").agg(
        F.count(F.lit(1)).alias("races"),
        F.avg("grid_position").alias("avg_grid"),
        F.avg("finish_position").alias("avg_finish"),
        F.sum("positions_gained").alias("positions_gained"),
    )


def stints(strategy: DataFrame, season: int | None = None) -> DataFrame:
    """Tyre stints, driver by driver through each race."""
    return (
        _season(strategy, season)
        .select(
            "season", "round_number", "session_id", "abbreviation", "stint_number", "compound",
            "stint_start_lap", "stint_end_lap", "stint_length",
        )
        .orderBy("season", "round_number", "session_id", "abbreviation", "stint_number")
    )


def pit_timing(stops: DataFrame, season: int | None = None) -> DataFrame:
    """Stops by race and lap, with the mean recorded duration."""
    return _season(stops, season).groupBy("season", "round_number", "lap_number").agg(
        F.count(F.lit(1)).alias("stops"),
        F.avg("pit_duration_seconds").alias("avg_pit_duration"),
    )


def laps_where(laps: DataFrame, calendar: DataFrame, where: Column) -> DataFrame:
    """Clean laps of the races that the calendar shows under a condition, such as a country.

    Seasons of such races are known only when the calendar has been read. Over a stored mart Spark reads the calendar
    first and then no other season's directory.
    """
    races = calendar.filter(where).select("season", "round_number", "country")
    return (
        laps.filter("is_clean_lap").join(races, ["season", "round_number"])
        .groupBy("season", "round_number", "country", "abbreviation").agg(
            F.count(F.lit(1)).alias("clean_laps"), F.min("lap_time_seconds").alias("best_lap_time"),
        )
    )


def degradation(laps: DataFrame, season: int | None = None) -> DataFrame:
    """Mean gap to the driver's median over clean laps, by compound and tyre age."""
    known = F.col("is_clean_lap") & F.col("compound").isNotNull() & F.col("tyre_life").isNotNull()
    return _season(laps, season).filter(known).groupBy("compound", "tyre_life").agg(
        F.count(F.lit(1)).alias("laps"),
        F.avg("delta_to_driver_median").alias("avg_delta"),
    )


def _slope(x: Column, y: Column) -> Column:
    """Least-squares slope from plain sums: exact for small whole numbers such as tyre ages.

    Loses digits where values are large against their spread; centre them first then.
    """
    n = F.count(F.lit(1)).cast("double")
    spread = n * F.sum(x * x) - F.sum(x) * F.sum(x)
    together = n * F.sum(x * y) - F.sum(x) * F.sum(y)
    return F.when(spread != 0, together / spread)


def tyre_falloff(laps: DataFrame, season: int | None = None) -> DataFrame:
    """Seconds lost per lap of tyre age for each compound, over clean laps."""
    known = F.col("is_clean_lap") & F.col("compound").isNotNull() & F.col("tyre_life").isNotNull()
    age, delta = F.col("tyre_life").cast("double"), F.col("delta_to_driver_median")
    return _season(laps, season).filter(known).groupBy("compound").agg(
        F.count(F.lit(1)).alias("laps"), _slope(age, delta).alias("seconds_per_lap")
    )


def pole_to_win(circuits: DataFrame) -> DataFrame:
    """Pole-to-win conversion per circuit, best first."""
    return circuits.select(
        "location", "country", "races_held", "pole_to_win_count", "pole_to_win_pct"
    ).orderBy(F.col("pole_to_win_pct").desc(), "location", "country")


def avg_stops(circuits: DataFrame) -> DataFrame:
    """Mean stops per driver per circuit; circuits without any stop come last."""
    return circuits.select("location", "country", "avg_pit_stops_per_driver").orderBy(
        F.col("avg_pit_stops_per_driver").desc_nulls_last(), "location", "country"
    )


def lap_times_slice(laps: DataFrame, season: int, abbreviation: str | None = None,
                    round_number: int | None = None) -> DataFrame:
    """One season of the lap-time mart, optionally one driver or round of it."""
    rows = laps.filter(F.col("season") == season)
    if abbreviation is not None:
        rows = rows.filter(F.col("abbreviation") == abbreviation)
    if round_number is not None:
        rows = rows.filter(F.col("round_number") == round_number)
    return rows

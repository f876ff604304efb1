"""What to load, and loading it: worklists and the set-wise load of source feeds."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackside.functions import build_session_id
from trackside.operators import only_new
from trackside.schemas import RAW, SEASON_ROUNDS, SESSION_FEEDS, SESSION_TYPES
from trackside.session import settled
from trackside.sources import landing, loads, shaping, storage


def season_rounds(spark: SparkSession, rounds: dict[int, int] = SEASON_ROUNDS) -> DataFrame:
    """The expected number of rounds per season as a table ``season, rounds``."""
    return spark.createDataFrame(list(rounds.items()), "season bigint, rounds bigint")


def expected_grid(rounds: DataFrame, types: Sequence[str] = SESSION_TYPES) -> DataFrame:
    """Every session a season should have: season × round × type, with its id."""
    return (
        rounds.filter("rounds > 0")
        .select("season", F.explode(F.sequence(F.lit(1), F.col("rounds"))).alias("round_number"))
        .select(
            "season",
            F.col("round_number").cast("bigint").alias("round_number"),
            F.explode(F.array(*[F.lit(t) for t in types])).alias("session_type"),
        )
        .withColumn("session_id", build_session_id("season", "round_number", "session_type"))
    )


def in_order(worklist: DataFrame) -> DataFrame:
    """A worklist by season and round, qualifying before the race."""
    return worklist.orderBy("season", "round_number", "session_type")


def load_worklist(rounds: DataFrame, loaded: DataFrame) -> DataFrame:
    """Expected sessions that are not loaded yet."""
    return in_order(only_new(expected_grid(rounds), loaded, ["session_id"]))


def weekend_worklist(rounds: DataFrame, season: int, round_number: int) -> DataFrame:
    """Both sessions of one race weekend."""
    return in_order(expected_grid(rounds).filter(
        (F.col("season") == season) & (F.col("round_number") == round_number)
    ))


def latest_completed_round(
    schedule: DataFrame, as_of: datetime, season: int | None = None
) -> DataFrame:
    """The highest round whose event date has passed, per season; NULL when none has.

    Testing events carry round 0 and do not count.
    """
    if season is not None:
        schedule = schedule.filter(F.col("season") == season)
    past = F.col("EventDate") < F.lit(as_of).cast(schedule.schema["EventDate"].dataType)
    return schedule.filter("RoundNumber > 0").groupBy("season").agg(
        F.max(F.when(past, F.col("RoundNumber"))).alias("latest_round")
    )


def latest_weekend_worklist(schedule: DataFrame, as_of: datetime) -> DataFrame:
    """Both sessions of each season's latest completed round; none before its first."""
    latest = latest_completed_round(schedule, as_of).filter("latest_round is not null")
    return in_order(
        latest.select(
            "season",
            F.col("latest_round").alias("round_number"),
            F.explode(F.array(*[F.lit(t) for t in SESSION_TYPES])).alias("session_type"),
        )
        .withColumn("session_id", build_session_id("season", "round_number", "session_type"))
    )


def pit_stop_backfill(
    sessions: DataFrame, laps: DataFrame, existing: DataFrame
) -> DataFrame:
    """Pit stops of loaded races that have none yet, derived from their laps.

    A session already holding pit stops is left alone, so running it twice adds nothing.
    """
    races = sessions.filter(F.col("session_type") == "R").select("session_id").distinct()
    wanted = only_new(races, existing, ["session_id"])
    return shaping.extract_pit_stops(laps.join(wanted, "session_id", "left_semi"))


def backfill_pit_stops(spark: SparkSession, root: str) -> DataFrame:
    """Derive and store the pit stops of loaded races that have none; returns the session ids."""
    raw = landing.read_raw_tables(spark, root, ("sessions", "laps", "pit_stops"))
    found = settled(pit_stop_backfill(raw["sessions"], raw["laps"], raw["pit_stops"]))
    landing.replace_sessions(found, root, "pit_stops")
    return found.select("session_id").distinct()


def shape_feeds(
    feeds: dict[str, DataFrame], loaded_at: datetime | None = None
) -> dict[str, DataFrame]:
    """All seven raw feeds from the landed source feeds, laps read once for laps and pit stops.

    Drivers and circuits carry the session that they were loaded from as ``from_session``.
    """
    laps = shaping.shape_laps(feeds["laps"], loaded_at)
    event_id = build_session_id("season", "round_number", "session_type").alias("from_session")
    return {
        "results": shaping.shape_results(feeds["results"], loaded_at),
        "laps": laps,
        "weather": shaping.shape_weather(feeds["weather"], feeds["events"], loaded_at),
        "drivers": shaping.shape_drivers(
            feeds["results"], loaded_at, [F.col("session_id").alias("from_session")]
        ),
        "circuits": shaping.shape_circuits(feeds["events"], loaded_at, [event_id]),
        "pit_stops": shaping.extract_pit_stops(laps),
        "sessions": shaping.shape_sessions(feeds["events"], loaded_at),
    }


def load_sessions(
    spark: SparkSession, feeds: dict[str, DataFrame], root: str, loaded_at: datetime,
    worklist: DataFrame | None = None,
) -> DataFrame:
    """Load the sessions of the landed feeds that are not in the raw tables yet.

    With a ``worklist`` only its sessions are loaded, and loaded again if they are there; those of it
    that the feeds do not know are left as they are. A load is committed at once for all seven feeds, and what a session
    has in none of them afterwards is gone. A load that broke off, anywhere, has changed nothing for
    readers and is run again.

    Returns ``feed, rows_without_session``: landed rows that name no session belong to no load and
    are left out, but counted.
    """
    event_id = build_session_id("season", "round_number", "session_type")
    events = feeds["events"].withColumn("session_id", event_id)
    if worklist is None:
        new = only_new(events, loads.Snapshot(spark, root).loaded(), ["session_id"])
    else:
        new = events.join(worklist.select("session_id").distinct(), "session_id", "left_semi")
    new = settled(new.filter("session_id is not null"))
    wanted = new.select("session_id").distinct()
    fresh = {
        name: feed.join(wanted, "session_id", "left_semi")
        for name, feed in feeds.items() if name != "events" and "session_id" in feed.columns
    }
    fresh["laps"], fresh["results"] = settled(fresh["laps"]), settled(fresh["results"])
    shaped = shape_feeds({**fresh, "events": new.drop("session_id")}, loaded_at)
    frames = {
        feed: storage.by_session(
            shaped[feed], RAW[feed],
            F.col("from_session" if feed in ("drivers", "circuits") else "session_id"),
        )
        for feed in (*SESSION_FEEDS, "drivers", "circuits", "sessions")
    }
    loads.commit(spark, root, frames, wanted)
    lost = [
        feed.filter("session_id is null").agg(F.count(F.lit(1)).alias("rows_without_session"))
        .select(F.lit(name).alias("feed"), "rows_without_session")
        for name, feed in {**feeds, "events": events}.items() if "session_id" in feed.columns
    ]
    report = lost[0]
    for more in lost[1:]:
        report = report.unionByName(more)
    return report


def load_weekend(
    spark: SparkSession, feeds: dict[str, DataFrame], root: str, loaded_at: datetime,
    season: int, round_number: int,
) -> DataFrame:
    """Load both sessions of one race weekend."""
    rounds = season_rounds(spark, {season: round_number})
    return load_sessions(
        spark, feeds, root, loaded_at, weekend_worklist(rounds, season, round_number)
    )


def load_latest(
    spark: SparkSession, feeds: dict[str, DataFrame], root: str, loaded_at: datetime,
    as_of: datetime,
) -> DataFrame:
    """Load both sessions of each season's latest completed round."""
    worklist = latest_weekend_worklist(feeds["schedule"], as_of)
    return load_sessions(spark, feeds, root, loaded_at, worklist)

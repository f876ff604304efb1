
from __future__ import annotations

import os
import re
import sys
import tempfile
from collections.abc import Callable, Sequence
from datetime import date, datetime
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle  # noqa: E402
from trackside import fixtures, operators  # noqa: E402
from trackside.functions import build_session_id  # noqa: E402
from trackside.operators import quality  # noqa: E402
from trackside.operators.watch import Watch  # noqa: E402
from trackside.plans import marts, reports, seasons  # noqa: E402
from trackside.plans.pipeline import Pipeline  # noqa: E402
from trackside.schemas import NATURAL_KEYS, RAW, SOURCE  # noqa: E402
from trackside.session import apply_settings, scratch_path, settled  # noqa: E402
from trackside.sources import batches, catalog, drift, landing, loading, loads, shaping  # noqa: E402
from trackside.streaming import incremental_session_append  # noqa: E402

# The subpackage for text corpora and its pipeline are optional: without them the rest works.
try:
    import corpus_pipeline
    from trackside.llm import queries as llm_queries
    from trackside.llm import sql as llm_sql
except ModuleNotFoundError as error:
    if error.name not in ("corpus_pipeline", "trackside.llm"):
        raise
    corpus_pipeline = llm_queries = llm_sql = None

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = date(1998, 6, 15)
SMOKE_DIR = "/root/testdata/sf0.001"


# What is worth storing before a relation is built, because it is read more than once.
LAPS, RESULTS = (["laps"], []), ([], ["stg_results"])
RACES = ([], ["race_results"])
KEPT = {
    "driver_standings": RACES,
    "final_standings": RACES,
    "constructor_standings": RACES,
    "lap_times": LAPS,
    "tyre_strategy": LAPS,
    "pit_stops": LAPS,
    "pit_summary": LAPS,
    "race_summary": RESULTS,
    "circuit_stats": (["laps"], ["stg_results"]),
}


def _raw(spark: SparkSession, sf_dir: str, keep: Sequence[str] = ()) -> fixtures.RawFeeds:
    """The raw feeds over the given tables; ``keep`` names feeds to store first."""
    feeds = fixtures.RawFeeds(spark, sf_dir)
    return feeds.keep(scratch_path(spark, "raw"), *keep) if keep else feeds


def pipeline(
    spark: SparkSession, sf_dir: str, raw: Sequence[str] = (), keep: Sequence[str] = (), **options
) -> Pipeline:
    """The pipeline over the raw feeds; ``raw`` and ``keep`` are stored on the way."""
    made = fixtures.pipeline(_raw(spark, sf_dir, raw), **options)
    return made.keep(scratch_path(spark, "kept"), *keep) if keep else made


def _made(spark: SparkSession, sf_dir: str, name: str, **options) -> DataFrame:
    raw, keep = KEPT.get(name, ([], []))
    return getattr(pipeline(spark, sf_dir, raw, keep, **options), name)


def _relation(name: str, **options) -> Query:
    return lambda spark, sf_dir: _made(spark, sf_dir, name, **options)


def _local_time(df: DataFrame) -> DataFrame:
    """Load times without zone, which is how the given tables hold them."""
    if "loaded_at" not in df.columns:
        return df
    return df.withColumn("loaded_at", F.col("loaded_at").cast("timestamp_ntz"))


def _shaped(feed: str) -> Query:
    return lambda spark, sf_dir: _raw(spark, sf_dir)[feed].select(*RAW[feed].names)


def _scan_raw(feed: str) -> Query:
    """Store the raw feed as a table and scan the table under its declared schema."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch_path(spark, "raw")
        landing.append(_raw(spark, sf_dir)[feed], f"{root}/raw_{feed}", RAW[feed])
        return _local_time(landing.read_raw(spark, root, feed))

    return run


def _scan_source(feed: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch_path(spark, "landing")
        frame = getattr(fixtures.Sources(spark, sf_dir), feed)
        landing.append(frame, f"{root}/{feed}", SOURCE[feed])
        return landing.read_source(spark, root, feed)

    return run


def land_by_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land all laps, then land two seasons again: they replace themselves."""
    path = scratch_path(spark, "laps")
    laps = landing.conform(_raw(spark, sf_dir).laps, RAW["laps"])
    landing.land_by_session(laps, path)
    again = F.split_part("session_id", F.lit("_"), F.lit(1)).isin("1996", "1997")
    landing.land_by_session(laps.filter(again), path)
    return _local_time(landing.read_table(spark, path, RAW["laps"]))


def append_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends, the second one with its columns in another order."""
    path = scratch_path(spark, "raw_results")
    results = _raw(spark, sf_dir).results
    early = F.col("loaded_at") < "1998-01-01"
    landing.append(results.filter(early), path, RAW["results"])
    landing.append(
        results.filter(~early).select(*reversed(results.columns)), path, RAW["results"]
    )
    return _local_time(landing.read_table(spark, path, RAW["results"]))


def _load_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The source feeds as landed tables."""
    feeds = fixtures.Sources(spark, sf_dir).feeds()
    return {name: settled(feeds[name]) for name in ("events", "results", "laps", "weather", "schedule")}


LOADED_AT, RELOADED_AT = datetime(2002, 1, 1), datetime(2003, 1, 1)


def load_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load two thirds of the seasons, then everything; all result rows as stored."""
    root, feeds = scratch_path(spark, "raw"), _load_feeds(spark, sf_dir)
    first = {**feeds, "events": feeds["events"].filter("season <= 1999")}
    loading.load_sessions(spark, first, root, LOADED_AT)
    loading.load_sessions(spark, feeds, root, LOADED_AT)
    return _local_time(landing.read_raw(spark, root, "results"))


def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per raw table after a load, and the landed rows that name no session."""
    root, feeds = scratch_path(spark, "raw"), _load_feeds(spark, sf_dir)
    left_out = loading.load_sessions(spark, feeds, root, LOADED_AT)
    total = left_out.select(
        F.concat(F.lit("without session: "), "feed").alias("feed"),
        F.col("rows_without_session").alias("row_count"),
    )
    for feed in RAW:
        count = landing.read_raw(spark, root, feed).agg(F.count(F.lit(1)).alias("row_count"))
        total = total.unionByName(count.select(F.lit(feed).alias("feed"), "row_count"))
    return total


def load_weekend(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, feeds = scratch_path(spark, "raw"), _load_feeds(spark, sf_dir)
    loading.load_weekend(spark, feeds, root, LOADED_AT, 1997, 4)
    return _local_time(landing.read_raw(spark, root, "laps"))


def load_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, feeds = scratch_path(spark, "raw"), _load_feeds(spark, sf_dir)
    loading.load_latest(spark, feeds, root, LOADED_AT, datetime(1998, 6, 15))
    return _local_time(landing.read_raw(spark, root, "sessions"))


def backfill_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pit stops as stored after a backfill where only first rounds had theirs."""
    root, raw = scratch_path(spark, "raw"), _raw(spark, sf_dir, ["laps"])
    for feed in ("sessions", "laps"):
        landing.replace_sessions(raw[feed], root, feed)
    first = raw.pit_stops.filter(F.split_part("session_id", F.lit("_"), F.lit(2)) == "1")
    landing.replace_sessions(first, root, "pit_stops")
    loading.backfill_pit_stops(spark, root)
    return _local_time(landing.read_raw(spark, root, "pit_stops"))


def reload_emptied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pit stops as stored after 1997 was loaded again from feeds that lost their laps of odd rounds."""
    root, feeds = scratch_path(spark, "raw"), _load_feeds(spark, sf_dir)
    loading.load_sessions(spark, feeds, root, LOADED_AT)
    kept = F.split_part("session_id", F.lit("_"), F.lit(2)).cast("int") % 2 == 0
    worklist = loading.expected_grid(_season_rounds(spark, sf_dir)).filter("season = 1997")
    loading.load_sessions(spark, {**feeds, "laps": feeds["laps"].filter(kept)}, root, RELOADED_AT, worklist)
    return _local_time(landing.read_raw(spark, root, "pit_stops"))


def reload_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each raw table as two readers see them, one from before and one from after a reload."""
    root, feeds = scratch_path(spark, "raw"), _load_feeds(spark, sf_dir)
    loading.load_sessions(spark, feeds, root, LOADED_AT)
    before = loads.Snapshot(spark, root)
    worklist = loading.expected_grid(_season_rounds(spark, sf_dir)).filter("season = 1997")
    emptied = {name: feeds[name].filter("session_id not like '1997%'") for name in ("results", "laps")}
    loading.load_sessions(spark, {**feeds, **emptied}, root, RELOADED_AT, worklist)
    counts = [
        reader.read(feed).groupBy(F.lit(state).alias("state"), F.lit(feed).alias("feed")).agg(
            F.count(F.lit(1)).alias("row_count")
        )
        for state, reader in (("before", before), ("after", loads.Snapshot(spark, root)))
        for feed in RAW
    ]
    return reduce(DataFrame.unionByName, counts)


def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings, the second with sessions of the first again, through the stream."""
    root = scratch_path(spark, "stream")
    stops = landing.conform(_raw(spark, sf_dir).pit_stops, RAW["pit_stops"])
    season = F.split_part("session_id", F.lit("_"), F.lit(1)).cast("int")
    for part in (season <= 1998, season >= 1997):
        stops.filter(part).write.mode("append").parquet(f"{root}/landing")
        incremental_session_append(
            spark, f"{root}/landing", f"{root}/raw_pit_stops", f"{root}/progress",
            RAW["pit_stops"], NATURAL_KEYS["pit_stops"],
        ).awaitTermination()
    return _local_time(landing.read_raw(spark, root, "pit_stops"))


def batches_thrice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All results three times under three names: what the table holds and what it keeps apart.

    Some results have no session or one that names no season, some lack the driver.
    """
    path, key = scratch_path(spark, "batches"), F.col("l_orderkey")
    results = _raw(spark, sf_dir).results
    odd = results.withColumn(
        "session_id", F.when(key % 13 == 0, F.concat(F.lit("test_"), "session_id")).otherwise(F.col("session_id"))
    ).withColumn("driver_number", F.when(key % 17 != 0, F.col("driver_number")))
    rows = settled(landing.conform(odd, RAW["results"]))
    for name in ("first", "second", "third"):
        batches.add(rows, path, RAW["results"], NATURAL_KEYS["results"], name)
    held = [
        (place, table.groupBy("session_id", "driver_number").agg(F.count(F.lit(1)).alias("row_count")))
        for place, table in (
            ("held", batches.read(spark, path, RAW["results"])),
            ("apart", batches.unplaced(spark, path, RAW["results"])),
        )
    ]
    return reduce(DataFrame.unionByName, [df.withColumn("place", F.lit(place)) for place, df in held])


def skip_loaded_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    loaded = raw.sessions.filter("season < 1998")
    return operators.only_new(
        raw.results.select(*RAW["results"].names), loaded, ["session_id"]
    )


def session_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fixtures.table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("season"), F.month("l_shipdate").alias("round_number"),
        F.when(F.col("l_linestatus") == "F", "R").otherwise("Q").alias("session_type"),
    )
    return lines.distinct().select(
        build_session_id("season", "round_number", "session_type").alias("session_id")
    )


def _season_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).sessions.groupBy("season").agg(
        F.count_distinct("round_number").alias("rounds")
    )


def load_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = _raw(spark, sf_dir).sessions.filter("season < 1998")
    return loading.load_worklist(_season_rounds(spark, sf_dir), loaded)


def weekend_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loading.weekend_worklist(_season_rounds(spark, sf_dir), 1997, 4)


def latest_completed_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    schedule = fixtures.Sources(spark, sf_dir).schedule
    return loading.latest_completed_round(schedule, datetime(1998, 6, 15))


def latest_weekend_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    schedule = fixtures.Sources(spark, sf_dir).schedule
    return loading.latest_weekend_worklist(schedule, datetime(1998, 6, 15))


def backfill_pit_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backfill where the first round of every season has its pit stops already."""
    raw = _raw(spark, sf_dir, ["laps"])
    existing = raw.pit_stops.filter(
        F.split_part("session_id", F.lit("_"), F.lit(2)) == "1"
    )
    return loading.pit_stop_backfill(raw.sessions, raw.laps, existing)


def lap_times_season_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the partitioned lap-time mart and read one driver's season of it."""
    stored = landing.write_clustered(
        _made(spark, sf_dir, "lap_times"), scratch_path(spark, "lap_times")
    )
    return reports.lap_times_slice(stored, 1996, "D3")


def pit_lane_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaping.pit_lane_time(_raw(spark, sf_dir).laps)


def _check(check: Callable[[fixtures.RawFeeds], DataFrame]) -> Query:
    return lambda spark, sf_dir: check(_raw(spark, sf_dir))


def dq_missing_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = _raw(spark, sf_dir).sessions
    twelve = sessions.select("season").distinct().withColumn("rounds", F.lit(12).cast("bigint"))
    return quality.missing_rounds(loading.expected_grid(twelve), sessions)


def dq_reconcile_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standings against the points of all loads, with one point per qualifying to adjust."""
    made = pipeline(spark, sf_dir, keep=["stg_results", "race_results"])
    keys = ["season", "abbreviation"]
    adjustments = made.qualifying_results.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("double").alias("adjustment_points")
    )
    lines = fixtures.Sources(spark, sf_dir).lines
    official = lines.groupBy(
        "season", F.concat(F.lit("D"), F.col("drv").cast("string")).alias("abbreviation")
    ).agg(F.sum("l_quantity").alias("official_points"))
    points = F.sum(F.coalesce("points", F.lit(0.0))).alias("final_points")
    computed = made.race_results.groupBy(*keys).agg(points)
    return quality.reconcile_points(computed, official, adjustments)


def dq_season_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = pipeline(spark, sf_dir, ["laps"], ["stg_results"], as_of=AS_OF)
    names = ["race_results", "qualifying_results", "lap_times", "season_calendar"]
    return quality.season_coverage({name: getattr(made, name) for name in names})


def dq_watched_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULLs in result rows, counted while these are stored."""
    watch = Watch(["session_id", "finish_position", "points", "status"])
    landing.write_mart(_raw(spark, sf_dir).results, scratch_path(spark, "watched"), watch)
    return watch.nulls(spark)


def dq_watched_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status codes that are not accepted, noticed while results are stored and looked up there."""
    watch = Watch(accepted={"status": ["Finished", "Retired"]})
    results = _raw(spark, sf_dir).results
    return watch.others(landing.write_mart(results, scratch_path(spark, "watched"), watch), "status")


def dq_watched_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["race_results", "qualifying_results", "lap_times", "season_calendar"]
    made = pipeline(spark, sf_dir, ["laps"], ["stg_results"], as_of=AS_OF)
    return made.keep(scratch_path(spark, "watched"), *names).coverage(*names)


def dq_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of landed laps by what their files have otherwise than declared; from 1997 on a feed has changed."""
    path, laps = scratch_path(spark, "landing"), fixtures.Sources(spark, sf_dir).laps
    laps = landing.conform(laps, SOURCE["laps"])
    late = F.coalesce(F.col("session_id") >= "1997", F.lit(False))
    renamed = laps.withColumn("LapNumber", F.col("LapNumber").cast("bigint")).withColumnRenamed("TyreLife", "TyreAge")
    laps.filter(~late).write.parquet(f"{path}/part=early")
    renamed.filter(late).write.parquet(f"{path}/part=late")
    return drift.schema_drift(spark, path, SOURCE["laps"]).groupBy(
        "column_name", "problem", "declared", "found"
    ).agg(F.sum("rows").alias("rows"))


def refresh_lap_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lap times by season, refreshed after a load of two thirds of the seasons and after one of the rest."""
    raw, root, feeds = scratch_path(spark, "raw"), scratch_path(spark, "seasons"), _load_feeds(spark, sf_dir)
    for events in (feeds["events"].filter("season <= 1996"), feeds["events"]):
        loading.load_sessions(spark, {**feeds, "events": events}, raw, LOADED_AT)
        seasons.refresh(spark, raw, root, AS_OF)
    return seasons.SeasonMarts(spark, root).read("lap_times")


def refresh_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Laps by season and the refresh that made them, after 1997 was loaded again without odd rounds' laps."""
    raw, root, feeds = scratch_path(spark, "raw"), scratch_path(spark, "seasons"), _load_feeds(spark, sf_dir)
    loading.load_sessions(spark, feeds, raw, LOADED_AT)
    seasons.refresh(spark, raw, root, AS_OF)
    even = F.split_part("session_id", F.lit("_"), F.lit(2)).cast("int") % 2 == 0
    worklist = loading.expected_grid(_season_rounds(spark, sf_dir)).filter("season = 1997")
    loading.load_sessions(spark, {**feeds, "laps": feeds["laps"].filter(even)}, raw, RELOADED_AT, worklist)
    seasons.refresh(spark, raw, root, AS_OF)
    now = seasons.SeasonMarts(spark, root)
    laps = now.read("lap_times").groupBy("season").agg(F.count(F.lit(1)).alias("laps"))
    made_by = F.split_part("version", F.lit("-"), F.lit(1)).cast("int").alias("refresh")
    return laps.join(now.versions().select("season", made_by), "season")


def _report(report: Callable[..., DataFrame], mart: str) -> Query:
    return lambda spark, sf_dir: report(_made(spark, sf_dir, mart))


def report_clean_pace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.clean_pace(pipeline(spark, sf_dir, ["laps"], ["lap_times"]).lap_times)


def _on(name: str, run: Callable[[DataFrame], DataFrame]) -> Query:
    """An operator applied to one of the given tables."""
    return lambda spark, sf_dir: run(fixtures.table(spark, sf_dir, name))


def orders_latest_per_customer(orders: DataFrame) -> DataFrame:
    return operators.latest_by_key(
        orders.select("o_custkey", "o_orderkey", "o_orderdate"),
        ["o_custkey"], ["o_orderdate"], ["o_orderkey"],
    )


def events_running_errors(events: DataFrame, unit: str | None = None) -> DataFrame:
    """Errors so far of each user; ``unit`` of time cuts a user's events into blocks."""
    error = F.when(F.col("event_type") == "error", 1).otherwise(0).cast("bigint")
    return operators.running_total(
        events.select("event_id", "user_id", "ts", "event_type"), error, ["user_id"],
        ["ts", "event_id"], "errors_so_far", F.date_trunc(unit, "ts") if unit else None,
    ).drop("event_type")


def events_signup_islands(events: DataFrame) -> DataFrame:
    numbered = operators.islands(
        events.select("event_id", "user_id", "ts", "event_type"),
        F.col("event_type") == "signup", ["user_id"], ["ts", "event_id"], "stretch",
    )
    return numbered.groupBy("user_id", "stretch").agg(
        F.count(F.lit(1)).alias("events"),
        F.min("event_id").alias("first_event"),
        F.max("event_id").alias("last_event"),
    )


def events_sequence(events: DataFrame) -> DataFrame:
    return operators.sequence_within(
        events.select("event_id", "user_id", "ts"), ["user_id"], ["ts", "event_id"],
        "event_number",
    ).drop("ts")


def orders_rank_by_priority(orders: DataFrame, step: int | None = None) -> DataFrame:
    """Rank by price; ``step`` of price cuts a priority's orders into blocks."""
    return operators.rank_within(
        orders.select("o_orderkey", "o_orderpriority", "o_totalprice"),
        ["o_orderpriority"], "o_totalprice", "price_rank",
        -F.floor(F.col("o_totalprice") / step) if step else None,
    )


def lines_delta_to_median(lines: DataFrame, step: int | None = None) -> DataFrame:
    """Quantity against the supplier's median; ``step`` of quantity makes blocks."""
    return operators.delta_to_median(
        lines.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"),
        "l_quantity", ["l_suppkey"], "delta_to_median",
        block=F.floor(F.col("l_quantity") / step) if step else None,
    )


def lap_times_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lap-time mart with blocks of a quarter of a second."""
    made = pipeline(spark, sf_dir, ["laps"])
    return marts.lap_times(made.stg_laps, made.stg_sessions, 0.25)


def laps_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lap-time mart as it is stored, every driver's race being hot from 20 laps on."""
    made = pipeline(spark, sf_dir, ["laps"])
    return marts.lap_times_once(made.stg_laps, made.stg_sessions, hot_rows=20)


def stints_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stints as they are stored, every driver's race being hot from 20 laps on."""
    made = pipeline(spark, sf_dir, ["laps"])
    return marts.tyre_strategy_once(made.stg_laps, made.stg_sessions, hot_rows=20)


def stored_marts(name: str) -> Query:
    """A mart as the pipeline stores it."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        made = pipeline(spark, sf_dir, ["laps"])
        return getattr(made.keep(scratch_path(spark, "marts"), name), name)

    return run


def in_buckets(name: str) -> Query:
    """A mart over laps stored in buckets of session and driver."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        made = pipeline(spark, sf_dir, ["laps"])
        path = scratch_path(spark, "buckets")
        return getattr(made.bucket_laps(_database(path), path, buckets=8), name)

    return run


def _database(path: str) -> str:
    """A database name for one folder."""
    return f"timing_{path.split('/')[-2]}"


def catalog_created(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw circuits by name, from a table that was missing and is created twice."""
    path, circuits = scratch_path(spark, "catalog"), _raw(spark, sf_dir).circuits
    for part in (F.col("loaded_at") < "1998-01-01", F.col("loaded_at") >= "1998-01-01"):
        catalog.create_raw_tables(spark, _database(path), path)
        catalog.append(circuits.filter(part), _database(path), "raw_circuits")
    return _local_time(spark.sql(f"select * from {_database(path)}.raw_circuits"))


def catalog_leaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaders after each round, by SQL over a mart that was published twice."""
    path, made = scratch_path(spark, "catalog"), pipeline(spark, sf_dir, keep=["race_results"])
    for _ in range(2):
        made.publish(_database(path), path, "driver_standings")
    return spark.sql(
        "select season, round_number, abbreviation, cumulative_points"
        f" from {_database(path)}.driver_standings where championship_position = 1"
    )


def report_laps_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best clean laps in one country before 1997, from the stored mart and the stored calendar."""
    made = pipeline(spark, sf_dir, ["laps"], ["lap_times", "season_calendar"], as_of=AS_OF)
    where = (F.col("country") == "NATION_3") & (F.col("race_date") < "1997-01-01")
    return reports.laps_where(made.lap_times, made.season_calendar, where)


def events_running_errors_cuts(events: DataFrame) -> DataFrame:
    """Errors so far of each user, users of more than 50 events being hot."""
    error = F.when(F.col("event_type") == "error", 1).otherwise(0).cast("bigint")
    return operators.hot.running_total(
        events.select("event_id", "user_id", "ts", "event_type"), error, ["user_id"],
        ["ts", "event_id"], "errors_so_far", hot_rows=50,
    ).drop("event_type")


def lines_delta_to_median_cuts(lines: DataFrame) -> DataFrame:
    """Quantity against the supplier's median, suppliers of more than 100 lines being hot."""
    return operators.hot.delta_to_median(
        lines.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"),
        "l_quantity", ["l_suppkey"], "delta_to_median", hot_rows=100,
    )


def lines_next_line(lines: DataFrame) -> DataFrame:
    narrow = lines.select("l_orderkey", "l_linenumber", "l_partkey")
    return operators.next_row_lookup(
        narrow, narrow, ["l_orderkey"], "l_linenumber", {"l_partkey": "next_partkey"}
    )


def orders_without_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fixtures.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = fixtures.table(spark, sf_dir, "lineitem")
    return operators.not_in(
        orders, lines.select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"]
    )


def entry(spark: SparkSession) -> DataFrame:
    """Final season standings from raw results."""
    _ready(spark)
    return reports.standings(_made(spark, SMOKE_DIR, "final_standings"))


def _all_queries() -> dict[str, Query]:
    return {
        **{f"scan_raw_{feed}": _scan_raw(feed) for feed in RAW},
        **{f"scan_source_{feed}": _scan_source(feed) for feed in SOURCE},
        **{f"raw_{feed}": _shaped(feed) for feed in RAW},
        "land_by_session": land_by_session,
        "append_raw": append_raw,
        "load_sessions": load_sessions,
        "load_counts": load_counts,
        "load_weekend": load_weekend,
        "load_latest": load_latest,
        "reload_emptied": reload_emptied,
        "reload_states": reload_states,
        "batches_thrice": batches_thrice,
        "backfill_stored": backfill_stored,
        "incremental_session_append": stream_sessions,
        "skip_loaded_sessions": skip_loaded_sessions,
        "session_id": session_ids,
        "load_worklist": load_worklist,
        "weekend_worklist": weekend_worklist,
        "latest_completed_round": latest_completed_round,
        "latest_weekend_worklist": latest_weekend_worklist,
        "backfill_pit_stops": backfill_pit_stops,
        "lap_times_season_slice": lap_times_season_slice,
        "pit_lane_time": pit_lane_time,
        **{
            name: _relation(name)
            for name in (
                "stg_sessions", "stg_results", "stg_laps", "stg_pit_stops", "stg_weather",
                "stg_drivers", "stg_circuits", "race_results", "qualifying_results",
                "driver_standings", "final_standings", "constructor_standings", "lap_times",
                "pit_stops", "tyre_strategy", "race_summary", "pit_summary", "circuit_stats",
            )
        },
        "season_calendar": _relation("season_calendar", as_of=AS_OF),
        "stg_laps_latest": _relation("stg_laps", dedupe=True),
        "stg_sessions_latest": _relation("stg_sessions", dedupe=True),
        "dq_unique": _check(lambda raw: quality.unique(raw.circuits, "circuit_key")),
        "dq_not_null": _check(
            lambda raw: quality.not_null(
                raw.results, ["session_id", "finish_position", "points", "status"]
            )
        ),
        "dq_accepted_values": _check(
            lambda raw: quality.accepted_values(raw.results, "status", ["Finished", "Retired"])
        ),
        "dq_missing_rounds": dq_missing_rounds,
        "dq_null_race_points": _check(
            lambda raw: quality.null_race_points(raw.results, raw.sessions)
        ),
        "dq_reconcile_points": dq_reconcile_points,
        "dq_duplicates": _check(
            lambda raw: quality.duplicates(raw.results, NATURAL_KEYS["results"])
        ),
        "dq_orphans": _check(
            lambda raw: quality.orphans(raw.results, raw.sessions.filter("season < 1998"))
        ),
        "dq_season_coverage": dq_season_coverage,
        "report_standings": _report(reports.standings, "final_standings"),
        "report_points_progression": _report(reports.points_progression, "driver_standings"),
        "report_gap_to_leader": _report(
            lambda race: reports.gap_to_leader(marts.driver_totals(race)), "race_results"
        ),
        "report_team_wins_dnfs": _report(reports.team_wins_dnfs, "race_results"),
        "report_clean_pace": report_clean_pace,
        "report_grid_vs_finish": _report(reports.grid_vs_finish, "race_results"),
        "report_stints": _report(reports.stints, "tyre_strategy"),
        "report_pit_timing": _report(reports.pit_timing, "pit_stops"),
        "report_degradation": _report(reports.degradation, "lap_times"),
        "report_tyre_falloff": _report(reports.tyre_falloff, "lap_times"),
        "report_pole_to_win": _report(reports.pole_to_win, "circuit_stats"),
        "report_avg_stops": _report(reports.avg_stops, "circuit_stats"),
        "orders_latest_per_customer": _on("orders", orders_latest_per_customer),
        "events_running_errors": _on("events", events_running_errors),
        "events_signup_islands": _on("events", events_signup_islands),
        "events_sequence": _on("events", events_sequence),
        "orders_rank_by_priority": _on("orders", orders_rank_by_priority),
        "lines_delta_to_median": _on("lineitem", lines_delta_to_median),
        "events_running_errors_blocks": _on(
            "events", lambda events: events_running_errors(events, "hour")
        ),
        "orders_rank_blocks": _on("orders", lambda orders: orders_rank_by_priority(orders, 1000)),
        "lines_delta_to_median_blocks": _on(
            "lineitem", lambda lines: lines_delta_to_median(lines, 3)
        ),
        "lap_times_blocks": lap_times_blocks,
        "lap_times_cuts": laps_once,
        "tyre_strategy_cuts": stints_once,
        "lap_times_stored": stored_marts("lap_times"),
        "tyre_strategy_stored": stored_marts("tyre_strategy"),
        **{f"{name}_in_buckets": in_buckets(name) for name in ("lap_times", "tyre_strategy", "pit_stops")},
        "catalog_created": catalog_created,
        "catalog_leaders": catalog_leaders,
        "report_laps_where": report_laps_where,
        "dq_watched_nulls": dq_watched_nulls,
        "dq_watched_values": dq_watched_values,
        "dq_watched_coverage": dq_watched_coverage,
        "dq_schema_drift": dq_schema_drift,
        "refresh_lap_times": refresh_lap_times,
        "refresh_seasons": refresh_seasons,
        "events_running_errors_cuts": _on("events", events_running_errors_cuts),
        "lines_delta_to_median_cuts": _on("lineitem", lines_delta_to_median_cuts),
        "lines_next_line": _on("lineitem", lines_next_line),
        "orders_without_lines": orders_without_lines,
    }


def _ready(spark: SparkSession) -> SparkSession:
    """The session with the library's settings, and with a scratch folder if it is a local one.

    On a cluster ``spark.checkpoint.dir`` has to name a folder that all executors share.
    """
    context = spark.sparkContext
    unnamed = spark.conf.get("spark.checkpoint.dir", None) is None and not context.getCheckpointDir()
    if unnamed and re.fullmatch(r"local(\[.*\])?", context.master):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="trackside-"))
    return apply_settings(spark)


def queries() -> dict[str, Query]:

    def with_settings(run: Query) -> Query:
        return lambda spark, sf_dir: run(_ready(spark), sf_dir)

    every = _all_queries()
    if corpus_pipeline:
        every |= llm_queries.queries() | {"pipeline": corpus_pipeline.run}
    return {name: with_settings(run) for name, run in every.items()}


def oracle_sql() -> dict[str, str]:
    """The DuckDB statement for each query."""
    statements = oracle.statements()
    if corpus_pipeline:
        statements |= llm_sql.statements()
        if corpus_pipeline.ORACLE_SQL:
            statements["pipeline"] = corpus_pipeline.ORACLE_SQL
    return statements

"""Test inputs: timing feeds derived from TPC-H-like tables (mapping: FIXTURES.md).

``sources`` builds the landed source feeds, ``raw`` puts them through the shaping
functions. Lines of ``lineitem`` become results, ``events`` become laps and
weather readings, one race per calendar day.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackside.functions import build_session_id
from trackside.plans.pipeline import Pipeline
from trackside.sources import shaping
from trackside.sources.landing import write_mart

NANOS = 1_000_000_000
RESULT_TIES = ["l_orderkey", "l_linenumber", "l_partkey"]


# Columns of the given tables that the feeds and queries use.
TABLES = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_name string",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_discount double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _text(*parts: Column | str) -> Column:
    return F.concat(
        *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    )


def _nanos(seconds: Column) -> Column:
    return (seconds * NANOS).cast("bigint")


class Sources:
    """The source feeds of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def lines(self) -> DataFrame:
        """Order lines with the season, round, session type, driver and team they stand for."""
        month = F.month("l_shipdate")
        # Driver 3 leaves after round 8 of every season; number 4 drives these lines too.
        left = (F.col("l_suppkey") % 20 == 3) & (month > 8)
        driver = F.when(left, 4).otherwise(F.col("l_suppkey") % 20).cast("bigint")
        return (
            table(self.spark, self.sf_dir, "lineitem")
            .withColumn("season", F.year("l_shipdate").cast("bigint"))
            .withColumn("round_number", month.cast("bigint"))
            .withColumn(
                "session_type", F.when(F.col("l_linestatus") == "F", "R").otherwise("Q")
            )
            .withColumn("drv", driver)
            .withColumn("tm", (driver + F.when(month > 6, 1).otherwise(0)) % 10)
        )

    @cached_property
    def events(self) -> DataFrame:
        """One event per session."""
        nation = table(self.spark, self.sf_dir, "nation").select(
            F.col("n_nationkey").cast("bigint").alias("round_number"), "n_name"
        )
        # Few rows per session are left before the join.
        return (
            self.lines.groupBy("season", "round_number", "session_type")
            .agg(
                F.min(F.date_trunc("month", "l_shipdate")).alias("first"),
                F.max("l_shipdate").alias("loaded_at"),
            )
            .join(nation, "round_number")
            .select(
                "season", "round_number", "session_type",
                F.col("n_name").alias("Country"), F.col("n_name").alias("Location"),
                F.col("n_name").alias("OfficialEventName"),
                F.col("first").cast("timestamp_ntz").alias("SessionDate"), "loaded_at",
            )
        )

    @cached_property
    def schedule(self) -> DataFrame:
        """Race dates of every season."""
        return self.events.filter("session_type = 'R'").select(
            "season", F.col("round_number").alias("RoundNumber"),
            F.col("SessionDate").alias("EventDate"),
        )

    @cached_property
    def results(self) -> DataFrame:
        key, place = F.col("l_orderkey"), 1 + F.col("l_partkey") % 20
        sid = build_session_id("season", "round_number", "session_type")
        return self.lines.select(
            F.when(key % 101 != 0, sid).alias("session_id"),
            "season",
            _text(F.col("drv")).alias("DriverNumber"),
            _text("D", F.col("drv")).alias("Abbreviation"),
            _text("Driver ", F.col("drv")).alias("FullName"),
            _text("T", F.col("tm")).alias("TeamName"),
            _text("C", F.col("drv") % 5).alias("CountryCode"),
            _text(key % 21).alias("GridPosition"),
            # An unplaced car has text here; half places test the rounding cast.
            F.when(key % 37 == 0, "NC").when(key % 50 == 0, _text(place, ".5"))
            .otherwise(_text(place)).alias("Position"),
            F.when(F.col("l_discount") < 0.09, F.col("l_quantity")).alias("Points"),
            F.when(F.col("l_returnflag") == "N", "Finished")
            .when(F.col("l_returnflag") == "A", "+1 Lap").otherwise("Retired").alias("Status"),
            _text(F.col("l_linenumber")).alias("Time"),
            F.col("l_shipdate").alias("loaded_at"),
            *RESULT_TIES,
        )

    @cached_property
    def drivers(self) -> DataFrame:
        """Result rows as the driver feed sees them; some lack the abbreviation."""
        return self.results.withColumn(
            "Abbreviation", F.when(F.col("l_orderkey") % 103 != 0, F.col("Abbreviation"))
        )

    @cached_property
    def _readings(self) -> DataFrame:
        day = F.dayofmonth("ts")
        return (
            table(self.spark, self.sf_dir, "events")
            .withColumn("season", (1995 + day % 7).cast("bigint"))
            .withColumn("round_number", (1 + F.floor(day / 7)).cast("bigint"))
            .withColumn("session_id", _text(F.col("season"), "_", F.col("round_number"), "_R"))
        )

    @cached_property
    def laps(self) -> DataFrame:
        key = F.col("event_id")
        second = (F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")).cast("bigint")
        base = self._readings.select(
            "session_id", (F.col("user_id") % 20).alias("drv"), "ts", "event_id", "event_type",
            "value", F.when(F.col("event_type") == "error", second).alias("pit_in"),
        )
        by_time = Window.partitionBy("session_id", "drv").orderBy("ts", "event_id")
        numbered = base.withColumn("n", F.row_number().over(by_time).cast("bigint")).withColumn(
            "prev_in", F.lag("pit_in").over(by_time)
        )
        seconds = F.floor(F.col("value") * 8) / 8
        return numbered.select(
            "session_id",
            _text(F.col("drv")).alias("DriverNumber"),
            _text("D", F.col("drv")).alias("Driver"),
            F.when(key % 211 != 0, F.col("n")).cast("double").alias("LapNumber"),
            F.when(F.col("event_type") != "signup", _nanos(seconds)).alias("LapTime"),
            _nanos(F.floor(F.col("value") * 2) / 8).alias("Sector1Time"),
            _nanos(F.floor(F.col("value") * 3) / 8).alias("Sector2Time"),
            _nanos(F.floor(F.col("value") * 3) / 8).alias("Sector3Time"),
            F.when(key % 3 == 0, "soft").when(key % 3 == 1, "Medium")
            .when(key % 29 == 2, None).otherwise("HARD").alias("Compound"),
            (key % 25).cast("double").alias("TyreLife"),
            (F.col("event_type") == "purchase").alias("IsPersonalBest"),
            _nanos(F.col("pit_in")).alias("PitInTime"),
            _nanos(F.col("prev_in") + 25 + key % 7).alias("PitOutTime"),
            F.when(key % 10 == 0, "4").when(key % 17 == 0, None).otherwise("1")
            .alias("TrackStatus"),
            F.col("ts").alias("loaded_at"),
        )

    @cached_property
    def weather(self) -> DataFrame:
        key = F.col("event_id")
        start = F.make_timestamp_ntz(
            F.col("season").cast("int"), F.col("round_number").cast("int"),
            F.lit(1), F.lit(0), F.lit(0), F.lit(0),
        )
        air = F.floor(F.col("value") * 8) / 8
        micros = F.timestamp_diff("MICROSECOND", start, F.col("ts"))
        return self._readings.select(
            "session_id",
            (micros * 1000).alias("Time"),
            air.alias("AirTemp"),
            (air + 10).alias("TrackTemp"),
            (key % 100).cast("double").alias("Humidity"),
            (F.col("event_type") == "error").alias("Rainfall"),
            ((key % 80) / 8).alias("WindSpeed"),
            F.col("ts").alias("loaded_at"),
        )

    def feeds(self) -> dict[str, DataFrame]:
        names = ["events", "results", "laps", "weather", "schedule"]
        return {name: getattr(self, name) for name in names}


class RawFeeds:
    """The raw relations of one scale factor, each made when it is asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.sources = Sources(spark, sf_dir)

    def __getitem__(self, feed: str) -> DataFrame:
        return getattr(self, feed)

    def keep(self, root: str, *feeds: str) -> RawFeeds:
        """Store feeds that are read several times, as a load would have."""
        for feed in feeds:
            setattr(self, feed, write_mart(getattr(self, feed), f"{root}/raw_{feed}"))
        return self

    @cached_property
    def sessions(self) -> DataFrame:
        return shaping.shape_sessions(self.sources.events)

    @cached_property
    def results(self) -> DataFrame:
        return shaping.shape_results(self.sources.results, carry=RESULT_TIES)

    @cached_property
    def laps(self) -> DataFrame:
        return shaping.shape_laps(self.sources.laps)

    @cached_property
    def pit_stops(self) -> DataFrame:
        return shaping.extract_pit_stops(self.laps)

    @cached_property
    def weather(self) -> DataFrame:
        return shaping.shape_weather(self.sources.weather, self.sources.events)

    @cached_property
    def drivers(self) -> DataFrame:
        return shaping.shape_drivers(self.sources.drivers, carry=RESULT_TIES)

    @cached_property
    def circuits(self) -> DataFrame:
        # The session id breaks ties between loads of the same moment.
        sid = build_session_id("season", "round_number", "session_type").alias("session_id")
        return shaping.shape_circuits(self.sources.events, carry=[sid])


def pipeline(raw: RawFeeds, **options) -> Pipeline:
    ties = {"results": RESULT_TIES, "drivers": RESULT_TIES, "circuits": ["session_id"]}
    return Pipeline(raw, tiebreaks=ties, **options)

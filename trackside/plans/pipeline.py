"""Raw tables to marts: each relation is made from the ones it depends on."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from trackside.operators import quality
from trackside.operators.watch import Watch, coverage
from trackside.plans import marts, staging
from trackside.schemas import RAW, SESSION_TYPES
from trackside.sources import catalog, landing, loading

MARTS = [
    "race_results", "qualifying_results", "driver_standings", "final_standings",
    "constructor_standings", "lap_times", "pit_stops", "tyre_strategy", "season_calendar",
    "circuit_stats",
]
CLUSTERED = {
    "lap_times": ("abbreviation", "round_number"),
    "race_results": ("abbreviation", "round_number"),
}

# What every mart needs of a session.
SESSION_COLUMNS = ["session_id", "season", "session_type"]
# Columns whose NULLs are counted in whatever else is stored.
NEEDED = ["session_id", "season", "round_number", "points"]
LAP_BUCKETS = ["session_id", "abbreviation"]
# Relations that read their laps once where they may store what they read.
ONCE = {"lap_times": marts.lap_times_once, "tyre_strategy": marts.tyre_strategy_once}


def _watch(name: str, columns: Sequence[str]) -> Watch:
    """What is counted while a relation is stored."""
    accepted = {"session_type": SESSION_TYPES} if name == "stg_sessions" else {}
    needed = SESSION_COLUMNS if name == "stg_sessions" else [c for c in NEEDED if c in columns]
    return Watch(needed, accepted, "season" if "season" in columns else None)


class Pipeline:
    """Staging relations and marts over seven raw relations.

    Nothing is built before it is asked for, and all of it stays lazy unless
    ``keep`` or ``write`` has stored it.

    ``tiebreaks`` names, per feed, the columns that decide between rows of the
    same key and load time. ``dedupe`` also reduces the feeds that are otherwise
    kept whole.
    """

    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        as_of: date | None = None,
        tiebreaks: Mapping[str, Sequence[str]] | None = None,
        dedupe: bool = False,
    ):
        self.raw, self.as_of, self.dedupe = raw, as_of, dedupe
        self.tiebreaks = tiebreaks or {}
        self.in_buckets = False
        self.watched: dict[str, Watch] = {}

    @classmethod
    def over(cls, spark: SparkSession, root: str, **options) -> Pipeline:
        """Over the raw tables stored under ``root``, all at the same state."""
        return cls(landing.read_raw_tables(spark, root), **options)

    @cached_property
    def stg_sessions(self) -> DataFrame:
        return staging.stage_sessions(self.raw["sessions"], self.dedupe)

    @cached_property
    def stg_results(self) -> DataFrame:
        return staging.stage_results(self.raw["results"], self.tiebreaks.get("results"))

    @cached_property
    def stg_laps(self) -> DataFrame:
        return staging.stage_laps(self.raw["laps"], self.dedupe)

    @cached_property
    def stg_pit_stops(self) -> DataFrame:
        return staging.stage_pit_stops(self.raw["pit_stops"], self.dedupe)

    @cached_property
    def stg_weather(self) -> DataFrame:
        return staging.stage_weather(self.raw["weather"], self.dedupe)

    @cached_property
    def stg_drivers(self) -> DataFrame:
        return staging.stage_drivers(self.raw["drivers"], self.tiebreaks.get("drivers"))

    @cached_property
    def stg_circuits(self) -> DataFrame:
        return staging.stage_circuits(self.raw["circuits"], self.tiebreaks.get("circuits"))

    @cached_property
    def race_results(self) -> DataFrame:
        return marts.race_results(self.stg_results, self.stg_sessions)

    @cached_property
    def qualifying_results(self) -> DataFrame:
        return marts.qualifying_results(self.stg_results, self.stg_sessions)

    @cached_property
    def driver_standings(self) -> DataFrame:
        return marts.driver_standings(self.race_results)

    @cached_property
    def final_standings(self) -> DataFrame:
        return marts.final_standings(self.driver_standings)

    @cached_property
    def constructor_standings(self) -> DataFrame:
        return marts.constructor_standings(self.race_results)

    @cached_property
    def lap_times(self) -> DataFrame:
        build = marts.lap_times_in_place if self.in_buckets else marts.lap_times
        return build(self.stg_laps, self.stg_sessions)

    @cached_property
    def pit_stops(self) -> DataFrame:
        return marts.pit_stops(self.stg_pit_stops, self.stg_sessions, self.stg_laps)

    @cached_property
    def tyre_strategy(self) -> DataFrame:
        build = marts.tyre_strategy_in_place if self.in_buckets else marts.tyre_strategy
        return build(self.stg_laps, self.stg_sessions)

    @cached_property
    def season_calendar(self) -> DataFrame:
        return marts.season_calendar(self.stg_sessions, self.as_of)

    @cached_property
    def race_summary(self) -> DataFrame:
        return marts.race_summary(self.race_results, self.qualifying_results)

    @cached_property
    def pit_summary(self) -> DataFrame:
        return marts.pit_summary(self.pit_stops)

    @cached_property
    def circuit_stats(self) -> DataFrame:
        return marts.circuit_stats(self.race_results, self.qualifying_results, self.pit_stops)

    def check(self, rounds: DataFrame | None = None) -> None:
        """Stop on session rows that would spoil every mart, and on rounds that are missing.

        ``rounds``: the expected ``season, rounds``; without it completeness is not checked. Of sessions
        that ``keep`` has stored, NULLs and values were counted then and are not scanned for again.
        """
        sessions, watch = self.stg_sessions, self.watched.get("stg_sessions")
        quality.gate("unique session_id", quality.unique(sessions, "session_id"))
        if watch:
            nulls = watch.nulls(sessions.sparkSession)
            others = watch.others(sessions, "session_type")
        else:
            nulls = quality.not_null(sessions, SESSION_COLUMNS)
            others = quality.accepted_values(sessions, "session_type", SESSION_TYPES)
        quality.gate("not null", nulls)
        quality.gate("session_type", others)
        if rounds is not None:
            missing = quality.missing_rounds(loading.expected_grid(rounds), sessions)
            quality.gate("all rounds", missing)

    def to_store(self, name: str) -> DataFrame:
        """A relation in the form that is best where it is stored anyway: it may store on its way."""
        if name in ONCE and name not in self.__dict__ and not self.in_buckets:
            return ONCE[name](self.stg_laps, self.stg_sessions)
        return getattr(self, name)

    def keep(self, root: str, *names: str) -> Pipeline:
        """Store relations under ``root``; what is built on them from now on reads them there.

        Worth it for a relation that is costly to make and read by several marts.
        """
        for name in names:
            path, relation = f"{root}/{name}", self.to_store(name)
            watch = self.watched[name] = _watch(name, relation.columns)
            if name in CLUSTERED:
                stored = landing.write_clustered(relation, path, cluster=CLUSTERED[name], watch=watch)
            else:
                stored = landing.write_mart(relation, path, watch)
            setattr(self, name, stored)
        return self

    def coverage(self, *names: str) -> DataFrame:
        """The seasons of stored relations, as counted while they were written: ``season, in_<name> …``."""
        watched = {name: self.watched[name] for name in names}
        return coverage(self.raw["sessions"].sparkSession, watched)

    def write(self, root: str, rounds: DataFrame | None = None) -> dict[str, DataFrame]:
        """Check, then store all marts in order of dependence; later ones read the stored earlier ones.

        Sessions and deduplicated results are stored too, since several marts read them. Writing again stores
        new versions made from the raw tables as they are now.
        """
        for name in ("stg_sessions", "stg_results", *MARTS):
            self.__dict__.pop(name, None)
        self.keep(root, "stg_sessions").check(rounds)
        self.keep(root, "stg_results", *MARTS)
        return {name: getattr(self, name) for name in MARTS}

    def bucket_laps(self, database: str, path: str, buckets: int) -> Pipeline:
        """Store the staged laps in buckets of session and driver; what is built on laps from now on reads these.

        Lap times, stints and the tyres after a stop all go by session and driver, so one shuffle at the
        time of storing takes the place of one in each of them. A driver's race must fit a task. The session
        is told that a join may use buckets of some of its keys, as that on the next lap does.
        """
        self.stg_laps.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        self.stg_laps = catalog.publish(
            self.stg_laps, database, "stg_laps", path, buckets=buckets,
            bucket_by=LAP_BUCKETS, sort_by=[*LAP_BUCKETS, "lap_number"], analyse=["session_id"],
        )
        for name in ("lap_times", "tyre_strategy", "pit_stops"):
            self.__dict__.pop(name, None)
        self.in_buckets = True
        return self

    def publish(self, database: str, path: str, *names: str) -> Pipeline:
        """Store marts as tables of the catalog with statistics; SQL finds them by name."""
        for name in names or MARTS:
            mart = getattr(self, name)
            parts = ["season"] if name in CLUSTERED else []
            keys = [c for c in ("season", "round_number", "abbreviation") if c in mart.columns]
            setattr(self, name, catalog.publish(mart, database, name, path, parts, analyse=keys))
        return self

    def register_views(self, spark: SparkSession) -> None:
        """Staging relations as temporary views, for use from SQL."""
        for feed in RAW:
            getattr(self, f"stg_{feed}").createOrReplaceTempView(f"stg_{feed}")

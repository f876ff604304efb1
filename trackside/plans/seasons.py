"""Stored marts by season: a load rewrites the seasons that it has changed, and no others.

``<root>/<mart>/version=<v>/season=<s>/`` holds the rows of a season as one refresh made them;
``<root>/state/version=<v>/`` says, for each season, which version counts, and which loads of the raw tables the
state has seen. A state is one directory and is either complete or not there, so all marts
change at once. What a refresh that broke off has left is named by no state and never read.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackside.operators import quality
from trackside.plans import marts
from trackside.plans.pipeline import CLUSTERED, MARTS, Pipeline
from trackside.schemas import RAW
from trackside.session import scratch_path
from trackside.sources import landing, loads, storage

VERSION = "version"
#: A row for each season (its version) and for each load that is seen (the state's own version).
STATE = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField(VERSION, T.StringType()),
])
#: One row per race or circuit, over all seasons: made again by every refresh.
OVERALL = ["season_calendar", "circuit_stats"]
#: The others, in order of dependence. No row of theirs depends on another season.
SEASONAL = [name for name in MARTS if name not in OVERALL]


@dataclass(frozen=True)
class State:
    """One state of the stored marts: its name, the version of each season, and the loads seen."""

    name: str | None
    seasons: dict[int, str]
    loads: frozenset[str]


def _named(spark: SparkSession, root: str, name: str) -> State:
    # A row per season and load: small whatever the seasons hold.
    rows = spark.read.schema(STATE).parquet(f"{root}/state/{VERSION}={name}").collect()
    return State(
        name, {int(r["name"]): r[VERSION] for r in rows if r["kind"] == "season"},
        frozenset(r["name"] for r in rows if r["kind"] == "load"),
    )


def _states(spark: SparkSession, root: str) -> list[str]:
    return [n.partition("=")[2] for n in storage.complete(spark, f"{root}/state")]


def state(spark: SparkSession, root: str) -> State:
    """The newest state; an empty one before the first refresh."""
    names = _states(spark, root)
    return _named(spark, root, names[-1]) if names else State(None, {}, frozenset())


class SeasonMarts:
    """The marts as one state names them; later refreshes change nothing of it."""

    def __init__(self, spark: SparkSession, root: str, at: State | None = None):
        self.spark, self.root = spark, root
        self.state = state(spark, root) if at is None else at

    @cached_property
    def _schemas(self) -> dict[str, T.StructType]:
        empty = Pipeline({feed: self.spark.createDataFrame([], kind) for feed, kind in RAW.items()})
        return {name: getattr(empty, name).schema for name in MARTS}

    def read(self, name: str) -> DataFrame:
        """A mart; of its directories only those that the state names are listed."""
        schema, path = self._schemas[name], f"{self.root}/{name}"
        if name in OVERALL:
            parts = [f"{VERSION}={self.state.name}"] if self.state.name else []
        else:
            parts = [
                f"{VERSION}={version}/{season}"
                for version in sorted(set(self.state.seasons.values()))
                for season in storage.children(self.spark, f"{path}/{VERSION}={version}")
                if self.state.seasons.get(_season(season)) == version
            ]
        stored = T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())])
        return storage.read_parts(self.spark, path, stored, parts).select(*schema.names)

    def versions(self) -> DataFrame:
        """``season, version`` as the state has them."""
        return self.spark.createDataFrame(sorted(self.state.seasons.items()), f"season bigint, {VERSION} string")


def _season(directory: str) -> int | None:
    value = directory.partition("=")[2]
    return int(value) if value.lstrip("-").isdigit() else None


def changed_seasons(spark: SparkSession, raw: str, unseen: Sequence[str]) -> list[int]:
    """The seasons of the sessions that these loads cover, with rows or without."""
    season = storage.season_of(F.col("session_id")).alias("season")
    entries = loads.Snapshot(spark, raw, unseen).entries()
    return sorted(r[0] for r in entries.select(season).distinct().filter("season is not null").collect())


def refresh(
    spark: SparkSession, raw: str, root: str, as_of: date | None = None, **options
) -> list[int]:
    """Bring the marts under ``root`` up to the loads under ``raw``; returns the seasons made again.

    Raw rows of other seasons are neither read nor written; the calendar and the circuits' figures,
    a row per race or circuit, are made over all seasons from what is stored. The result equals a full build. A refresh
    that broke off has changed nothing for readers and is run again. Sessions whose own season is not
    the one in their id would belong to two seasons: they raise.
    """
    now, before = loads.Snapshot(spark, raw), state(spark, root)
    unseen = [name for name in now.loads if name not in before.loads]
    seasons = changed_seasons(spark, raw, unseen)
    number = int(before.name.split("-")[0]) + 1 if before.name else 1
    version = f"{number:012d}-{uuid.uuid4().hex[:8]}"
    if seasons:
        _write_seasons(Pipeline(
            {feed: now.read(feed, seasons) for feed in RAW}, as_of=as_of, **options
        ), root, version)
    after = State(
        version, before.seasons | {season: version for season in seasons}, before.loads | set(now.loads)
    )
    made = SeasonMarts(spark, root, after)
    sessions = Pipeline({feed: now.read(feed) for feed in RAW}, **options).stg_sessions
    overall = {
        "season_calendar": marts.season_calendar(sessions, as_of),
        "circuit_stats": marts.circuit_stats(
            *[made.read(name) for name in ("race_results", "qualifying_results", "pit_stops")]
        ),
    }
    for name, rows in overall.items():
        rows.write.parquet(f"{root}/{name}/{VERSION}={version}")
    rows = [("season", str(s), v) for s, v in sorted(after.seasons.items())]
    rows += [("load", name, version) for name in sorted(after.loads)]
    spark.createDataFrame(rows, STATE).write.options(**storage.MARKED).parquet(f"{root}/state/{VERSION}={version}")
    return seasons


def _write_seasons(made: Pipeline, root: str, version: str) -> None:
    """Store the seasonal marts of some seasons; later ones read the stored earlier ones."""
    spark = made.raw["sessions"].sparkSession
    made.keep(scratch_path(spark, "refresh"), "stg_sessions", "stg_results")
    made.check()
    apart = ~F.col("season").eqNullSafe(storage.season_of(F.col("session_id")))
    quality.gate("season as in session_id", made.stg_sessions.filter(apart))
    for name in SEASONAL:
        relation, path = made.to_store(name), f"{root}/{name}/{VERSION}={version}"
        if name in CLUSTERED:
            placed = landing.clustered(relation, "season", CLUSTERED[name])
        else:
            placed = relation.hint("rebalance", "season")
        placed.write.partitionBy("season").parquet(path)
        setattr(made, name, spark.read.schema(relation.schema).parquet(path).select(*relation.columns))


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete the versions that the ``keep`` newest states do not need; returns their names.

    Not to be run while a refresh is: its rows belong to no state yet.
    """
    names = _states(spark, root)
    needed = set(names[-keep:])
    for name in names[-keep:]:
        needed |= set(_named(spark, root, name).seasons.values())
    gone = set()
    for mart in ("state", *MARTS):
        for directory in storage.children(spark, f"{root}/{mart}"):
            if directory.partition("=")[2] not in needed:
                storage.delete(spark, f"{root}/{mart}/{directory}")
                gone.add(directory.partition("=")[2])
    return sorted(gone)

"""The raw tables as loads, and the manifest that says which load of a session counts.

A load writes its rows into directories of its own, and after them one manifest: a row for each
session and each feed that it covers, feeds without rows included. The manifest is one
directory and is either complete or not there, so all feeds of a load become visible at once. For a session and
feed the newest load counts and no other: a session loaded again with fewer rows, or with none, keeps nothing of
what it had. What a load that broke off has left is named by no manifest and never read.

``raw_<feed>/load=<name>/part_season=<season>/`` holds the rows, sorted by session;
``manifest/load=<name>/`` the manifest.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackside.schemas import RAW
from trackside.sources import storage
from trackside.sources.storage import PART_SEASON, PART_SESSION

LOAD = "load"
MANIFEST = T.StructType([
    T.StructField("session_id", T.StringType()), T.StructField("feed", T.StringType()),
    T.StructField("row_count", T.LongType()), T.StructField(LOAD, T.StringType()),
])


def committed(spark: SparkSession, root: str) -> list[str]:
    """The loads that have a manifest, oldest first."""
    return [name.partition("=")[2] for name in storage.complete(spark, f"{root}/manifest")]


def _next(spark: SparkSession, root: str) -> str:
    """A name after all that are committed; of two loads at the same time either may come last."""
    loads = committed(spark, root)
    number = int(loads[-1].split("-")[0]) + 1 if loads else 1
    return f"{number:012d}-{uuid.uuid4().hex[:8]}"


class Snapshot:
    """The raw tables as the loads committed so far make them.

    All feeds are read at the same state, and later loads change nothing of it, until ``vacuum``
    deletes rows that are replaced.
    """

    def __init__(self, spark: SparkSession, root: str, loads: Sequence[str] | None = None):
        self.spark, self.root = spark, root
        self.loads = list(committed(spark, root) if loads is None else loads)

    def entries(self) -> DataFrame:
        """Every manifest's rows: ``session_id, feed, row_count, load``."""
        names = [f"{LOAD}={name}" for name in self.loads]
        return storage.read_parts(self.spark, f"{self.root}/manifest", MANIFEST, names)

    def current(self) -> DataFrame:
        """``session_id, feed, load, row_count`` of the load that counts."""
        newest = F.max(F.struct(LOAD, "row_count")).alias("newest")
        return self.entries().groupBy("session_id", "feed").agg(newest).select(
            "session_id", "feed", f"newest.{LOAD}", "newest.row_count"
        )

    def loaded(self) -> DataFrame:
        """``session_id`` of the sessions whose own row is there."""
        return self.current().filter("feed = 'sessions' and row_count > 0").select("session_id")

    def _replaced(self, feed: str) -> DataFrame:
        """Session and load of the rows of a feed that a later load has replaced."""
        of_feed = self.entries().filter((F.col("feed") == feed) & (F.col("row_count") > 0))
        newest = self.current().filter(F.col("feed") == feed).select(
            "session_id", F.col(LOAD).alias("newest")
        )
        return of_feed.join(newest, "session_id").filter(F.col(LOAD) < F.col("newest")).select(
            F.col("session_id").alias(PART_SESSION), LOAD
        )

    def placed(self, feed: str, seasons: Sequence[int] | None = None) -> DataFrame:
        """The rows that count, with the season and session they were loaded from."""
        path, known = f"{self.root}/raw_{feed}", set(self.loads)
        names = [n for n in storage.children(self.spark, path) if n.partition("=")[2] in known]
        rows = storage.read_parts(self.spark, path, storage.placed_schema(RAW[feed], LOAD), names)
        if seasons is not None:
            rows = rows.filter(F.col(PART_SEASON).isin(list(seasons)))
        if len(names) == 0 or len(self.loads) == 1:
            return rows.drop(LOAD)
        return rows.join(self._replaced(feed), [PART_SESSION, LOAD], "left_anti").drop(LOAD)

    def read(self, feed: str, seasons: Sequence[int] | None = None) -> DataFrame:
        """The rows of a feed under its declared schema; with ``seasons`` no other directory is read."""
        return self.placed(feed, seasons).select(*RAW[feed].names)


def commit(
    spark: SparkSession, root: str, frames: Mapping[str, DataFrame], sessions: DataFrame
) -> str:
    """Store a load: for each of ``sessions`` and each feed of ``frames`` these rows and no others.

    ``frames`` carry ``PART_SEASON`` and ``PART_SESSION`` (``storage.by_session``); rows without a
    session are not stored. Returns the load's name. Run again after a failure it is a new load, which replaces
    whatever the first one has committed.
    """
    name = _next(spark, root)

    def store(feed: str) -> DataFrame:
        path = f"{root}/raw_{feed}/{LOAD}={name}"
        (
            frames[feed].filter(F.col(PART_SESSION).isNotNull())
            .hint("rebalance", PART_SEASON).sortWithinPartitions(PART_SEASON, PART_SESSION)
            .write.options(**storage.MARKED).partitionBy(PART_SEASON).parquet(path)
        )
        stored = spark.read.schema(storage.placed_schema(RAW[feed])).parquet(path)
        return stored.select(F.col(PART_SESSION).alias("session_id"), F.lit(feed).alias("feed"))

    # The feeds' writes are jobs of their own; together they fill the tails of each other.
    with ThreadPoolExecutor(len(frames)) as pool:
        stored = list(pool.map(store, frames))
    counts = reduce(DataFrame.unionByName, stored).groupBy("session_id", "feed").agg(
        F.count(F.lit(1)).alias("row_count")
    )
    feeds = F.explode(F.array(*[F.lit(feed) for feed in frames])).alias("feed")
    covered = sessions.select("session_id").filter("session_id is not null").distinct()
    entries = covered.select("session_id", feeds).join(counts, ["session_id", "feed"], "full_outer")
    (
        entries.select("session_id", "feed", F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"))
        .write.options(**storage.MARKED).parquet(f"{root}/manifest/{LOAD}={name}")
    )
    return name


def compact(spark: SparkSession, root: str) -> str:
    """Store all rows that count as one load, so that readers list one directory a feed again."""
    now = Snapshot(spark, root)
    frames = {feed: now.placed(feed) for feed in RAW}
    return commit(spark, root, frames, now.current().select("session_id"))


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete rows of loads that are replaced altogether, or were never committed; returns their names.

    What the ``keep`` newest states need stays, for readers that have begun. Not to be run while a
    load is: its rows are not committed yet.
    """
    loads = committed(spark, root)
    needed: set[str] = set(loads[-keep:])
    for at in range(max(1, len(loads) - keep + 1), len(loads) + 1):
        used = Snapshot(spark, root, loads[:at]).current().filter("row_count > 0")
        needed |= {r[LOAD] for r in used.select(LOAD).distinct().collect()}
    gone = set()
    for feed in RAW:
        for name in storage.children(spark, f"{root}/raw_{feed}"):
            if name.startswith(f"{LOAD}=") and name.partition("=")[2] not in needed:
                storage.delete(spark, f"{root}/raw_{feed}/{name}")
                gone.add(name.partition("=")[2])
    return sorted(gone)

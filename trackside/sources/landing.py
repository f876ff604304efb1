"""Parquet landing files, raw tables and mart tables: readers and writers."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackside.operators.watch import Watch
from trackside.schemas import RAW, SOURCE
from trackside.session import settled
from trackside.sources import batches, loads, storage
from trackside.sources.storage import conform


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A parquet table under its declared schema; columns come back in schema order."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_raw(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """A raw table: what its loads or its batches make it, or all its files where there are neither."""
    return read_raw_tables(spark, root, [feed])[feed]


def read_raw_tables(
    spark: SparkSession, root: str, feeds: Sequence[str] = tuple(RAW)
) -> dict[str, DataFrame]:
    """Several raw tables at the same state."""
    now = loads.Snapshot(spark, root)
    if now.loads:
        return {feed: now.read(feed) for feed in feeds}
    return {feed: _read_unmanaged(spark, f"{root}/raw_{feed}", RAW[feed]) for feed in feeds}


def _read_unmanaged(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if batches.is_batch_table(spark, path):
        return batches.read(spark, path, schema)
    return read_table(spark, path, schema)


def read_source(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """The landed files of one source feed, all sessions in one scan."""
    return read_table(spark, f"{root}/{feed}", SOURCE[feed])


def create_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Create an empty table; leave one that is already there alone."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def create_raw_tables(spark: SparkSession, root: str) -> None:
    for feed, schema in RAW.items():
        create_table(spark, f"{root}/raw_{feed}", schema)


def land_by_session(df: DataFrame, path: str, keys: Sequence[str] = ("session_id",)) -> None:
    """Land rows in one directory per session, replacing the sessions that come in.

    ``rebalance`` puts a session's rows together, so that a directory gets few
    files, and cuts a session too big for one task into several. On a lake with
    millions of sessions give ``keys=("season", "round_number")`` or the like,
    to keep the number of directories in hand; what is replaced is then a round.
    """
    (
        df.hint("rebalance", *keys)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys).parquet(path)
    )


def append(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Append rows to a raw table, matched by name."""
    conform(df, schema).write.mode("append").parquet(path)


def replace_sessions(
    df: DataFrame, root: str, feed: str, session: Column | None = None,
    sessions: DataFrame | None = None,
) -> str:
    """Store rows of one feed so that each session that comes in has these rows and no others.

    ``sessions`` names the sessions; those without rows lose what they had. By default they are the
    sessions of the rows. Readers see the old rows or the new ones, for all sessions at once.
    """
    rows = storage.by_session(df, RAW[feed], F.col("session_id") if session is None else session)
    if sessions is None:
        sessions = df.limit(0).select(F.lit(None).cast("string").alias("session_id"))
    return loads.commit(df.sparkSession, root, {feed: rows}, sessions)


def _versions(spark: SparkSession, path: str) -> list[str]:
    """The complete versions of a mart, oldest first."""
    return [f"{path}/{name}" for name in storage.complete(spark, path)]


def read_mart(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest complete version of a mart."""
    versions = _versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no complete version of a mart in {path}")
    return spark.read.schema(schema).parquet(versions[-1]).select(*schema.names)


def _new_version(spark: SparkSession, path: str) -> str:
    return f"{path}/v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _switched(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Drop all versions but the newest two: a reader may still be at the one before."""
    for old in _versions(spark, path)[:-2]:
        storage.delete(spark, old)
    return read_mart(spark, path, schema)


def write_mart(df: DataFrame, path: str, watch: Watch | None = None) -> DataFrame:
    """Store a new version of a mart and return it as stored; ``watch`` counts while it is written.

    The version before stays until the new one is complete, so a write that fails leaves
    the old mart, and a mart may be made from itself.
    """
    rows = watch.on(df) if watch else df
    rows.write.parquet(_new_version(df.sparkSession, path))
    return _switched(df.sparkSession, path, df.schema)


def clustered(df: DataFrame, partition: str, cluster: Sequence[str]) -> DataFrame:
    """The rows in range partitions by ``partition`` and ``cluster``, sorted within, to be written.

    Range partitioning on these columns gives every file a narrow range of the cluster columns, so
    that a reader skips directories by season and row groups by driver and round. A hash of the
    row comes last, so that a season, driver and round with any part of all rows is spread over
    tasks and files too. The rows are stored before, as the ranges are found by reading them.
    """
    last = F.xxhash64(*df.columns)
    return settled(df).repartitionByRange(partition, *cluster, last).sortWithinPartitions(partition, *cluster)


def write_clustered(
    df: DataFrame, path: str, partition: str = "season",
    cluster: Sequence[str] = ("abbreviation", "round_number"), watch: Watch | None = None,
) -> DataFrame:
    """Store a new version of a mart, partitioned by ``partition`` and ``clustered`` within."""
    rows = clustered(df, partition, cluster)
    rows = watch.on(rows) if watch else rows
    rows.write.partitionBy(partition).parquet(_new_version(df.sparkSession, path))
    return _switched(df.sparkSession, path, df.schema)

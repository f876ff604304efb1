"""Tables and marts by name: declared tables, published marts with statistics, laps in buckets.

A published mart is a table for each version and a view of the mart's name. The view is switched in one step once
the new table is complete and analysed, so SQL reads the old version or the new one.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from trackside.schemas import RAW

#: Versions of a mart that stay: a reader may still be at the one before.
KEPT = 2


def _quoted(*names: str) -> str:
    return ".".join(f"`{name}`" for name in names)


def create_database(spark: SparkSession, database: str, path: str) -> None:
    """A database whose folder is ``path``; one that is already there stays as it is."""
    spark.sql(f"create database if not exists {_quoted(database)} location '{path}'")


def create_table(
    spark: SparkSession, database: str, name: str, schema: T.StructType, path: str,
    partition: Sequence[str] = (),
) -> None:
    """A parquet table with declared columns; one that is already there stays as it is.

    Its files are in a folder of the table's name below ``path``, named by the caller so that no table ends
    up on the disk of one machine.
    """
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
    parts = f" partitioned by ({', '.join(_quoted(p) for p in partition)})" if partition else ""
    spark.sql(
        f"create table if not exists {_quoted(database, name)} ({columns}) using parquet{parts}"
        f" location '{path}/{name}'"
    )


def create_raw_tables(spark: SparkSession, database: str, path: str) -> None:
    """The seven raw tables under their names, where they are not there yet."""
    create_database(spark, database, path)
    for feed, schema in RAW.items():
        create_table(spark, database, f"raw_{feed}", schema, path)


def append(df: DataFrame, database: str, name: str) -> None:
    """Append rows to a declared table, matched by name and cast to the declared types."""
    declared = df.sparkSession.table(_quoted(database, name)).schema
    rows = df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in declared])
    rows.write.insertInto(_quoted(database, name))


def _versions(spark: SparkSession, database: str, name: str) -> list[str]:
    tables = spark.sql(f"show tables in {_quoted(database)}").collect()
    return sorted(t["tableName"] for t in tables if t["tableName"].startswith(f"{name}_v"))


def publish(
    df: DataFrame, database: str, name: str, path: str, partition: Sequence[str] = (),
    buckets: int = 0, bucket_by: Sequence[str] = (), sort_by: Sequence[str] = (),
    analyse: Sequence[str] = (),
) -> DataFrame:
    """Store a mart as a new table, analyse it, and let the mart's name mean it; returns it by name.

    ``analyse`` names the columns whose statistics the planner gets beside the number of rows and bytes.
    Tables before the newest ``KEPT`` leave the catalog; their files stay with the caller.
    """
    spark = df.sparkSession
    create_database(spark, database, path)
    known = _versions(spark, database, name)
    number = int(known[-1].removeprefix(f"{name}_v").split("_")[0]) + 1 if known else 1
    version = f"{name}_v{number:08d}_{uuid.uuid4().hex[:8]}"
    writer = df.write.format("parquet").option("path", f"{path}/{version}")
    if partition:
        writer = writer.partitionBy(*partition)
    if buckets:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*(sort_by or bucket_by))
    writer.saveAsTable(_quoted(database, version))
    columns = f" for columns {', '.join(_quoted(c) for c in analyse)}" if analyse else ""
    spark.sql(f"analyze table {_quoted(database, version)} compute statistics{columns}")
    spark.sql(
        f"create or replace view {_quoted(database, name)} as select * from {_quoted(database, version)}"
    )
    for old in _versions(spark, database, name)[:-KEPT]:
        spark.sql(f"drop table if exists {_quoted(database, old)}")
    return spark.table(_quoted(database, name))

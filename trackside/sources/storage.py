"""What all stored tables share: declared columns, places by season and session, complete directories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Where a raw row is stored: by the season and the session it was loaded from. Not part of its schema.
PART_SEASON, PART_SESSION = "part_season", "part_session"

# A directory is complete once its writer has put this file into it, whatever the cluster's default.
MARKED = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "true"}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in declared order and type; matched by name, never by position."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def season_of(session: Column) -> Column:
    """The season that a session id begins with; NULL when it begins with no number."""
    return F.substring_index(session, "_", 1).try_cast("bigint")


def by_session(df: DataFrame, schema: T.StructType, session: Column) -> DataFrame:
    """The declared columns, and season and session that the rows were loaded from."""
    placed = df.withColumn(PART_SESSION, session).withColumn(PART_SEASON, season_of(session))
    return placed.select(*conform_columns(schema), PART_SEASON, PART_SESSION)


def conform_columns(schema: T.StructType) -> list[Column]:
    return [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]


def placed_schema(schema: T.StructType, *parts: str) -> T.StructType:
    """A schema with season and session of the rows, and names of further directories."""
    return T.StructType([
        *schema.fields, T.StructField(PART_SESSION, T.StringType()),
        T.StructField(PART_SEASON, T.LongType()), *[T.StructField(p, T.StringType()) for p in parts],
    ])


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories in a folder, in order; none if there is no such folder."""
    place, files = _folder(spark, path)
    if not files.exists(place):
        return []
    return sorted(str(x.getPath().getName()) for x in files.listStatus(place) if x.isDirectory())


def is_complete(spark: SparkSession, path: str) -> bool:
    place, files = _folder(spark, f"{path}/_SUCCESS")
    return files.exists(place)


def complete(spark: SparkSession, path: str) -> list[str]:
    """Names of the complete directories in a folder, in order."""
    return [name for name in children(spark, path) if is_complete(spark, f"{path}/{name}")]


def delete(spark: SparkSession, path: str) -> None:
    place, files = _folder(spark, path)
    files.delete(place, True)


def read_parts(
    spark: SparkSession, path: str, schema: T.StructType, names: Sequence[str]
) -> DataFrame:
    """The rows of some directories ``column=value`` of a folder; no other is listed or read."""
    if not names:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", path)
    return reader.parquet(*[f"{path}/{name}" for name in names])

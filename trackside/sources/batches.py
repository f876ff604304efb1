"""A table that batches are added to, each exactly once, with a ledger of the batches.

A batch writes its rows into a directory of its own, those whose session names no season into another, and
then its line in the ledger. Readers take the directories of batches in the ledger. A batch that
is run again after a failure overwrites what it has left; one that is in the ledger is passed over.

Below the table's path: ``rows/batch=<name>/part_season=<season>/``, ``unplaced/batch=<name>/`` and
``ledger/batch=<name>/``; while a batch is added, ``newest/batch=<name>/`` too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackside.operators import latest_by_key
from trackside.operators.ordered import prefixed, same_keys
from trackside.sources import storage
from trackside.sources.storage import PART_SEASON

BATCH = "batch"
LEDGER = T.StructType([
    T.StructField("row_count", T.LongType()), T.StructField("unplaced_count", T.LongType()),
    T.StructField(BATCH, T.StringType()),
])
#: A batch of at most so many seasons is compared with their directories only; one of more with all rows.
SEASONS = 1000
#: When a row was loaded says nothing about which row it is.
STAMP = "loaded_at"


def _committed(spark: SparkSession, path: str) -> list[str]:
    return storage.complete(spark, f"{path}/ledger")


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """One row for each batch that was added: ``batch, row_count, unplaced_count``."""
    return storage.read_parts(spark, f"{path}/ledger", LEDGER, _committed(spark, path)).select(
        BATCH, "row_count", "unplaced_count"
    )


def _seasoned(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(PART_SEASON, T.LongType())])


def _rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return storage.read_parts(spark, f"{path}/rows", _seasoned(schema), _committed(spark, path))


def is_batch_table(spark: SparkSession, path: str) -> bool:
    return bool(storage.children(spark, f"{path}/ledger"))


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all batches that were added."""
    return _rows(spark, path, schema).select(*schema.names)


def unplaced(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows that are kept apart because no season can be read from their session."""
    return storage.read_parts(spark, f"{path}/unplaced", schema, _committed(spark, path))


def _unheld(rows: DataFrame, held: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The different ``columns`` of the rows that no held row has, each with its latest load time; NULL equals NULL.

    One aggregate over both: nothing is sorted, and a task sends each value once.
    """
    stamp = rows.schema[STAMP].dataType
    both = rows.select(*columns, STAMP, F.lit(False).alias("_held")).unionByName(
        held.select(*columns, F.lit(None).cast(stamp).alias(STAMP), F.lit(True).alias("_held"))
    )
    # Grouping makes 0.0 of -0.0; the rows keep what they had.
    real = [c for c in columns if isinstance(rows.schema[c].dataType, (T.DoubleType, T.FloatType))]
    found = both.groupBy(*[F.col(c).alias(f"_by_{c}") if c in real else c for c in columns]).agg(
        *[F.first(c).alias(c) for c in real], F.max(STAMP).alias(STAMP), F.max("_held").alias("_held")
    )
    return found.filter(~F.col("_held")).select(*columns, STAMP)


def _lacking(keys: Sequence[str]) -> Column:
    lacking = F.lit(False)
    for key in keys:
        lacking = lacking | F.col(key).isNull()
    return lacking


def _written(df: DataFrame, path: str, *parts: str) -> DataFrame:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.options(**storage.MARKED).partitionBy(*parts).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def add(
    batch: DataFrame, path: str, schema: T.StructType, keys: Sequence[str], name: str
) -> bool:
    """Add the rows of a batch that the table does not hold; false if ``name`` was added before.

    A row whose key is complete is known by its key: of several in the batch the latest counts, and one that is
    held stays as it is. A row that lacks a part of its key is known by all its columns but the load
    time. So is a row whose session names no season; it is kept apart. However often the same rows come in,
    under whatever names, they are held once.
    """
    spark = batch.sparkSession
    if storage.is_complete(spark, f"{path}/ledger/{BATCH}={name}"):
        return False
    others = [c for c in schema.names if c not in {*keys, STAMP}]
    whole = [c for c in schema.names if c != STAMP]
    season = storage.season_of(F.col("session_id"))
    rows = storage.conform(batch, schema)
    placed = rows.filter(season.isNotNull())
    lacking = _lacking(keys)
    held = _rows(spark, path, schema)
    if _committed(spark, path):
        seasons = placed.select(season).distinct().limit(SEASONS + 1).collect()
        if len(seasons) <= SEASONS:
            held = held.filter(F.col(PART_SEASON).isin([r[0] for r in seasons]))
    complete = placed.filter(~lacking)
    # Stored, so that its size is known when the rows are joined with it. Only rows of keys that are
    # not held, and of these the ones loaded last, are ranked.
    newest = _written(_unheld(complete, held.filter(~lacking), keys), f"{path}/newest/{BATCH}={name}")
    known_by = [*keys, STAMP]
    last = complete.join(prefixed(newest, known_by, "_last_"), same_keys(known_by, "_last_"), "left_semi")
    known = latest_by_key(last, keys, [STAMP], others)
    vague = _unheld(placed.filter(lacking), held.filter(lacking), whole)
    fresh = known.unionByName(vague).withColumn(PART_SEASON, season)
    kept = _unheld(rows.filter(season.isNull()), unplaced(spark, path, schema), whole).select(*schema.names)
    new = _written(fresh, f"{path}/rows/{BATCH}={name}", PART_SEASON).agg(F.count(F.lit(1)).alias("row_count"))
    odd = _written(kept, f"{path}/unplaced/{BATCH}={name}").agg(F.count(F.lit(1)).alias("unplaced_count"))
    storage.delete(spark, f"{path}/newest/{BATCH}={name}")
    _written(new.join(odd), f"{path}/ledger/{BATCH}={name}")
    return True

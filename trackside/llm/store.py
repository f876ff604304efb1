"""Intermediate tables in the shared folder, and rows carried through an operator whole."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackside.session import scratch_path

ROW = "__row"
#: What goes to a Python worker at a time. The default of 10,000 rows makes both it and the executor's JVM hold
#: buffers of tens of megabytes for each task, and keep them.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def small_batches(spark: SparkSession) -> None:
    """Tell the session to hand texts to Python in small batches, from now on."""
    for key, value in BATCHES.items():
        spark.conf.set(key, value)


def _with_folder(spark: SparkSession) -> SparkSession:
    """Give a session on this machine alone a folder, if none is named; a cluster must name one."""
    context = spark.sparkContext
    if spark.conf.get("spark.checkpoint.dir", None) is None and not context.getCheckpointDir():
        if re.fullmatch(r"local(\[.*\])?", context.master):
            context.setCheckpointDir(tempfile.mkdtemp(prefix="trackside-"))
    return spark


def keep(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table written to the shared folder: computed once, safe from lost executors."""
    path = scratch_path(_with_folder(df.sparkSession), name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """Every input row as one struct beside ``columns``, so that no name of it can clash."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(ROW),
                     *[value.alias(name) for name, value in columns.items()])


def unpacked(df: DataFrame, **results: Column) -> DataFrame:
    """The input columns again, followed by ``results``; a result replaces a column of its name."""
    kept = [c for c in df.schema[ROW].dataType.names if c not in results]
    return df.select(*[F.col(ROW)[c].alias(c) for c in kept],
                     *[value.alias(name) for name, value in results.items()])

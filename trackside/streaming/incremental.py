"""Incremental load of landed files as they arrive."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from trackside.sources import batches


def stream_id(spark: SparkSession, checkpoint_path: str) -> str:
    """The id that a stream keeps as long as its progress; a stream that starts anew gets another."""
    return json.loads(spark.read.text(f"{checkpoint_path}/metadata").first()[0])["id"]


def incremental_session_append(
    spark: SparkSession,
    landing_path: str,
    table_path: str,
    checkpoint_path: str,
    schema: T.StructType,
    row_key: Sequence[str],
) -> StreamingQuery:
    """Add the rows of newly landed files that the table does not hold yet.

    Takes all files that are waiting and stops. Every micro-batch is added exactly once (``batches.add``):
    its number and the stream's id name it in the table's ledger. A stream that has lost its progress
    and takes all files again adds nothing that is held. A session's files may come in any number of parts.
    Rows whose session names no season are kept apart (``batches.unplaced``).
    """

    def add(batch: DataFrame, number: int) -> None:
        name = f"{stream_id(spark, checkpoint_path)}-{number:012d}"
        batches.add(batch, table_path, schema, row_key, name)

    return (
        spark.readStream.schema(schema).parquet(landing_path)
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )

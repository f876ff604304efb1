"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A fact table joined on session_id is usually windowed on (session_id, driver) next.
    # Without this the window reuses the join's partitioning and a hot session stays whole.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "trackside", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` adds or replaces any of them."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false").config(
        "spark.ui.showConsoleProgress", "false"
    )
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the run-time settings on a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


class NoSharedFolder(RuntimeError):
    """No folder was named that the driver and all executors share."""


def scratch_root(spark: SparkSession) -> str:
    """The shared folder: ``spark.checkpoint.dir``, or the checkpoint folder of the context.

    A local folder would be a different one on each machine, so none is made up here.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    root = named or spark.sparkContext.getCheckpointDir()
    if root is None:
        raise NoSharedFolder("set spark.checkpoint.dir to a folder that all executors share")
    return root


def _application_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark).rstrip('/')}/trackside-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path for a table in the shared folder.

    Tables stay there, under one directory per application, until ``drop_scratch``: a stored
    result may be read long after the call that made it.
    """
    return f"{_application_folder(spark)}/{uuid.uuid4().hex}/{name}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete all that this application has stored; frames that read it cannot be used any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_application_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settled(df: DataFrame) -> DataFrame:
    """The rows as a table written to the shared folder.

    Cuts the lineage for good: what reads the result is not affected when an
    executor is lost, and reads only the columns it needs.
    """
    path = scratch_path(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Checks taken while a frame is written, by the job that writes it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trackside.operators import quality


class Watch:
    """Counts over the rows of one frame, taken by the first action on what ``on`` returns.

    Put it right below the write, after the last shuffle: there each task's counts are taken once,
    even if an executor is lost and the task is run again. What was watched has to be written
    before a check is asked for, or the check waits for it. A check that has counted nothing wrong runs no job; one
    that has looks its rows up in what was stored. ``seasons`` names a column of few values,
    all of which go to the driver.
    """

    def __init__(
        self, not_null: Sequence[str] = (), accepted: Mapping[str, Sequence[str]] | None = None,
        seasons: str | None = None,
    ):
        self.columns, self.accepted, self.season = list(not_null), dict(accepted or {}), seasons
        self.observation = Observation()

    def on(self, df: DataFrame) -> DataFrame:
        """``df`` unchanged, counted when it is written."""
        counts = [F.count(F.lit(1)).alias("rows")]
        counts += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in self.columns]
        counts += [
            F.count_if(~F.col(c).isin(list(values))).alias(f"other_{c}")
            for c, values in self.accepted.items()
        ]
        if self.season:
            counts.append(F.collect_set(self.season).alias("seasons"))
        return df.observe(self.observation, *counts)

    @cached_property
    def _counted(self) -> dict:
        return self.observation.get

    @property
    def rows(self) -> int:
        return self._counted["rows"]

    @property
    def seasons(self) -> list[int]:
        """The different values of the season column, without NULL."""
        return sorted(self._counted["seasons"])

    def nulls(self, spark: SparkSession) -> DataFrame:
        """As ``quality.not_null``: ``column_name, null_count`` of the columns that have any."""
        found = [(c, self._counted[f"null_{c}"]) for c in self.columns]
        return spark.createDataFrame(
            [(c, n) for c, n in found if n > 0], "column_name string, null_count bigint"
        )

    def others(self, stored: DataFrame, column: str) -> DataFrame:
        """As ``quality.accepted_values``; ``stored`` is read only if there is such a value."""
        if self._counted[f"other_{column}"] == 0:
            stored = stored.limit(0)
        return quality.accepted_values(stored, column, self.accepted[column])

    def without_points(self, stored: DataFrame) -> DataFrame:
        """As ``quality.null_race_points``, of watched race results; read only if points are missing."""
        if self._counted["null_points"] == 0:
            stored = stored.limit(0)
        return stored.filter("points is null").groupBy("session_id", "season", "round_number").agg(
            F.count(F.lit(1)).alias("null_rows")
        )


def coverage(spark: SparkSession, watched: Mapping[str, Watch]) -> DataFrame:
    """As ``quality.season_coverage``, from what was counted while the marts were written."""
    seasons = {name: set(watch.seasons) for name, watch in watched.items()}
    flags = ", ".join(f"in_{name} boolean" for name in seasons)
    rows = [
        (season, *[season in found for found in seasons.values()])
        for season in sorted(set().union(*seasons.values()))
    ]
    return spark.createDataFrame(rows, f"season bigint, {flags}")

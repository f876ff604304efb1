"""Data-quality checks. Each returns the offending rows; an empty result passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackside.operators.lookup import missing_condition, not_in


class QualityError(RuntimeError):
    """A check found rows it should not have."""


def gate(name: str, offending: DataFrame) -> None:
    """Raise when a check returns anything. Looks at one row, never at all of them."""
    example = offending.limit(1).collect()
    if example:
        raise QualityError(f"check {name} failed, for example: {example[0].asDict()}")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count; NULL keys are ignored."""
    return (
        df.filter(~missing_condition(keys))
        .groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
        .filter("row_count > 1")
    )


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values of one column that occur more than once."""
    return duplicates(df, [column])


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of NULLs for each column that has any: ``column_name, null_count``."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return (
        counts.unpivot([], list(columns), "column_name", "null_count").filter("null_count > 0")
    )


def accepted_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values outside the accepted list with their row count; NULL does not fail."""
    return (
        df.filter(~F.col(column).isin(list(accepted)))
        .groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("row_count"))
    )


def missing_rounds(expected: DataFrame, sessions: DataFrame) -> DataFrame:
    """Expected (season, round, type) with no loaded session."""
    return not_in(expected, sessions, ["season", "round_number", "session_type"])


def null_race_points(results: DataFrame, sessions: DataFrame) -> DataFrame:
    """Races with rows lacking points. Qualifying awards none and is left out."""
    races = sessions.filter(F.col("session_type") == "R").select(
        "session_id", "season", "round_number"
    )
    # Counted before the join: one row per session crosses it.
    lacking = (
        results.filter(F.col("points").isNull())
        .groupBy("session_id").agg(F.count(F.lit(1)).alias("null_rows"))
    )
    return lacking.join(races, "session_id").select(
        "session_id", "season", "round_number", "null_rows"
    )


def reconcile_points(
    standings: DataFrame, official: DataFrame, adjustments: DataFrame
) -> DataFrame:
    """Computed totals plus adjustments (sprint points) against the official totals.

    ``standings``: season, abbreviation, final_points. ``official``: season,
    abbreviation, official_points. ``adjustments``: season, abbreviation,
    adjustment_points. Every driver named in any of them appears once;
    ``difference`` is official minus (computed + adjustment), 0 when it all fits.
    """
    keys = ["season", "abbreviation"]
    computed = standings.select(*keys, F.col("final_points").alias("computed_points"))
    zero = F.lit(0.0)
    return (
        computed.join(adjustments.select(*keys, "adjustment_points"), keys, "full_outer")
        .join(official.select(*keys, "official_points"), keys, "full_outer")
        .select(
            *keys,
            F.coalesce("computed_points", zero).alias("computed_points"),
            F.coalesce("adjustment_points", zero).alias("adjustment_points"),
            F.coalesce("official_points", zero).alias("official_points"),
        )
        .withColumn(
            "difference",
            F.col("official_points") - F.col("computed_points") - F.col("adjustment_points"),
        )
    )


def orphans(child: DataFrame, sessions: DataFrame) -> DataFrame:
    """Session ids of a feed that the session table does not know, with row counts."""
    counts = (
        child.filter(F.col("session_id").isNotNull())
        .groupBy("session_id").agg(F.count(F.lit(1)).alias("row_count"))
    )
    return not_in(counts, sessions, ["session_id"])


def season_coverage(marts: dict[str, DataFrame]) -> DataFrame:
    """One row per season found anywhere, with a flag ``in_<mart>`` for each mart."""
    tagged = None
    for name, mart in marts.items():
        seasons = mart.select("season", F.lit(name).alias("mart")).distinct()
        tagged = seasons if tagged is None else tagged.unionByName(seasons)
    return tagged.groupBy("season").agg(
        *[
            (F.count_if(F.col("mart") == name) > 0).alias(f"in_{name}")
            for name in marts
        ]
    )

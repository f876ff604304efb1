"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    newest_first: Sequence[str],
    tiebreak: Sequence[str | Column],
) -> DataFrame:
    """One row per key: the first by ``newest_first`` descending, then by ``tiebreak``.

    ``tiebreak`` is mandatory, because rows often share a load time and the row
    kept must not depend on how the data happened to be partitioned.

    The ``row_number() = 1`` form is planned with a group limit on both sides of
    the shuffle: each map task sends at most one row per key, so a key that holds
    a large share of the rows is no burden on the reducer.
    """
    order = [F.col(name).desc_nulls_last() for name in newest_first]
    order += [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in tiebreak]
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).filter("_position = 1").drop("_position")

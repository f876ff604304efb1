"""Joins of rows to their groups that hold for groups of any size, and numbering without one big window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A group with more than this part of all rows is hot. There are fewer than 1000 of them.
HOT_PART = 1000


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """``rows`` inner-joined to ``groups`` on ``key``, no task getting a hot group's rows together.

    ``groups`` has one row for each key, ``size`` at least the number of the key's rows, and
    sizes that add up to ``total`` at most. Groups of more than a thousandth of ``total`` are
    fewer than 1000, and that table is broadcast; the other rows are joined by shuffle.
    """
    limit = max(1, total // HOT_PART)
    hot = F.broadcast(groups.filter(F.col(size) > limit))
    return (
        rows.join(hot, key)
        .unionByName(
            rows.join(F.broadcast(groups.filter(F.col(size) > limit).select(key)), key, "left_anti")
            .join(groups.filter(F.col(size) <= limit), key)
        )
    )


def numbered(
    df: DataFrame, by: Sequence[str], order: Sequence[str], name: str, total: int,
    block_rows: int = 50_000,
) -> DataFrame:
    """Gapless numbers from 0 within each group of ``by``, however large.

    Rows are dealt by a hash of ``order`` into blocks of about ``block_rows``. A row's
    number is its place in its block plus the sizes of the group's blocks before. ``order`` must be
    unique within a group.
    """
    blocks = max(1, -(-total // block_rows))
    dealt = df.withColumn("__part", F.pmod(F.xxhash64(*order), F.lit(blocks)))
    cells = [*by, "__part"]
    before = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy(*cells).agg(F.count(F.lit(1)).alias("__n")).select(
        *cells, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")
    )
    place = F.row_number().over(Window.partitionBy(*cells).orderBy(*order)) - 1
    return (
        dealt.withColumn("__place", place).join(offsets, cells)
        .withColumn(name, (F.col("__place") + F.col("__before")).cast("bigint"))
        .drop("__part", "__place", "__before")
    )

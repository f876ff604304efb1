"""Ordered work within groups: running totals, sequences, ranks, islands, medians.

Building a frame runs no job, and the answer does not depend on how a group is cut.

A window sends a group to one task, where it is sorted and may spill. That is right for groups
that the model bounds, such as a driver's season. For groups that can grow without
bound give ``block``: an expression that rises with the order, such as the hour of a time stamp
or a thousand laps. Then only the rows of one block meet in a task, and a group's blocks are
put together from one total each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

Order = Sequence[str | Column]

#: Digits behind the point with which real values are added up.
SCALE = 12


def same_keys(keys: Sequence[str], prefix: str) -> Column:
    """NULL-safe equality of ``key`` and ``prefix + key`` for every key."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(prefix + key))
    return condition


def prefixed(df: DataFrame, keys: Sequence[str], prefix: str, *others: str) -> DataFrame:
    """Select the keys under prefixed names, so that they can be joined back."""
    return df.select(*[F.col(key).alias(prefix + key) for key in keys], *others)


def _exact(df: DataFrame, value: Column) -> tuple[Column, T.DataType]:
    """The value in a type whose sums are exact in any order, and the type of the total."""
    kind = df.select(value.alias("v")).schema["v"].dataType
    if isinstance(kind, T.DecimalType):
        return value, T.DecimalType(min(38, kind.precision + 10), kind.scale)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return value.cast(T.DecimalType(38, SCALE)), T.DoubleType()
    return value.cast("bigint"), T.LongType()


def _addable(total: Column, kind: T.DataType) -> Column:
    """A total that can be added to another without losing a digit behind the point.

    The sum of two 38-digit decimals would have one digit less there.
    """
    if isinstance(kind, T.LongType):
        return total
    scale = kind.scale if isinstance(kind, T.DecimalType) else SCALE
    return total.cast(T.DecimalType(37, scale))


def running_total(
    df: DataFrame,
    value: str | Column,
    keys: Sequence[str],
    order: Order,
    out: str,
    block: Column | None = None,
) -> DataFrame:
    """Sum of ``value`` from the first row of the group up to the current row.

    Row frame: rows that tie in ``order`` get successive totals, so give an order
    that is total when the result must be repeatable. Real values are added up as
    decimals with ``SCALE`` digits behind the point, so 0.1 + 0.2 is 0.3 and blocks make no difference.
    """
    value = F.col(value) if isinstance(value, str) else value
    exact, kind = _exact(df, value)
    columns = [c for c in df.columns if c != out]
    so_far = (Window.unboundedPreceding, Window.currentRow)
    if block is None:
        frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*so_far)
        return df.select(*columns, F.sum(exact).over(frame).cast(kind).alias(out))
    cut = df.withColumn("_block", block).withColumn("_value", exact)
    within = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(*so_far)
    # One row per block of the group.
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy(*keys, "_block").agg(F.sum("_value").alias("_total"))
    before = prefixed(
        totals.withColumn("_before", F.sum("_total").over(earlier)), [*keys, "_block"], "_b_", "_before"
    )
    local, carried = _addable(F.col("_local"), kind), _addable(F.col("_before"), kind)
    return (
        cut.withColumn("_local", F.sum("_value").over(within))
        .join(before, same_keys([*keys, "_block"], "_b_"))
        .select(*columns, F.coalesce(carried + local, local, carried).cast(kind).alias(out))
    )


def sequence_within(
    df: DataFrame, keys: Sequence[str], order: Order, out: str, block: Column | None = None
) -> DataFrame:
    """1, 2, 3 … within the group, in ``order``."""
    if block is not None:
        return running_total(df, F.lit(1).cast("bigint"), keys, order, out, block)
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(out, number.cast("bigint"))


def islands(
    df: DataFrame,
    is_start: Column,
    keys: Sequence[str],
    order: Order,
    out: str,
    block: Column | None = None,
) -> DataFrame:
    """Number the runs of rows: a new one begins wherever ``is_start`` is true.

    Rows before the first start belong to island 0.
    """
    marker = F.when(is_start, 1).otherwise(0).cast("bigint")
    return running_total(df, marker, keys, order, out, block)


def rank_within(
    df: DataFrame, keys: Sequence[str], highest_first: str, out: str, block: Column | None = None
) -> DataFrame:
    """Rank by a value descending; ties share a rank and leave a gap after it.

    ``block`` must rise as the value falls, NULL coming last in both.
    """
    if block is None:
        best = Window.partitionBy(*keys).orderBy(F.col(highest_first).desc_nulls_last())
        return df.withColumn(out, F.rank().over(best).cast("bigint"))
    # Equal values share a rank, so rank the distinct values by how many rows precede them.
    values = [*keys, highest_first]
    counts = df.groupBy(*values).agg(F.count(F.lit(1)).alias("_rows"))
    through = running_total(
        counts, "_rows", keys, [F.col(highest_first).desc_nulls_last()], "_through", block
    )
    ranks = prefixed(
        through.withColumn(out, F.col("_through") - F.col("_rows") + 1), values, "_r_", out
    )
    return df.drop(out).join(ranks, same_keys(values, "_r_")).select(
        *[c for c in df.columns if c != out], out
    )


def group_quantile(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    out: str,
    p: float = 0.5,
    block: Column | None = None,
    others: Sequence[Column] = (),
) -> DataFrame:
    """Exact interpolated quantile per group, ignoring NULL: keys, ``others`` and ``out``.

    Picks the two neighbouring values by their place among the counted distinct values, so no group's
    values are held in memory. ``block`` must rise with the value, NULL coming first in both.
    ``others`` are sums over the counted values, made in the same pass from ``value`` and the
    column ``_rows``.
    """
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_all"))
    counts = counts.withColumn("_rows", F.when(F.col(value).isNotNull(), F.col("_all")).otherwise(0))
    through = running_total(counts, "_rows", keys, [value], "_through", block)
    sizes = counts.groupBy(*keys).agg(F.sum("_rows").alias("_size"))
    if block is None:
        whole = Window.partitionBy(*keys)
        sized = through.withColumn("_size", F.sum("_rows").over(whole))
    else:
        sized = through.join(prefixed(sizes, keys, "_q_", "_size"), same_keys(keys, "_q_"))
    position = (F.col("_size") - 1) * F.lit(float(p))
    low, high = F.floor(position), F.ceil(position)
    reached = F.when(F.col("_rows") > 0, F.col(value))
    neighbours = sized.groupBy(*keys, "_size").agg(
        F.min(F.when(F.col("_through") > low, reached)).alias("_low"),
        F.min(F.when(F.col("_through") > high, reached)).alias("_high"),
        *others,
    )
    weighted = (high - position) * F.col("_low") + (position - low) * F.col("_high")
    exact = F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(weighted)
    rest = [c for c in neighbours.columns if c not in {*keys, "_size", "_low", "_high"}]
    return neighbours.select(*keys, *rest, exact.alias(out))


def delta_to_median(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    out: str,
    p: float = 0.5,
    block: Column | None = None,
) -> DataFrame:
    """``value`` minus the group's exact quantile (the median by default)."""
    middle = group_quantile(df, value, keys, "_middle", p, block)
    return (
        df.join(prefixed(middle, keys, "_m_", "_middle"), same_keys(keys, "_m_"))
        .withColumn(out, F.col(value) - F.col("_middle"))
        .select(*[c for c in df.columns if c != out], out)
    )

"""Ordered work within groups of any size: one window for ordinary groups, cuts for hot ones.

The input is stored once, and everything else reads the stored table. A group with more than a thousandth of
all rows (and more than ``HOT_ROWS``) is hot; there are fewer than a thousand of them. Ordinary groups take one
window, that is one shuffle. Hot groups are cut without being told how: by boundaries
sampled from their own order, or by histograms of their values. What is known of hot groups and their cuts
is a few thousand rows, goes through the driver, and Spark sees how small it is.

Unlike ``ordered`` these operators run jobs and need the shared folder (``session.settled``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackside.operators.ordered import _addable, _exact, prefixed, same_keys
from trackside.session import settled

#: A group with fewer rows is never hot.
HOT_ROWS = 1_000_000
#: A hot group has more than this part of all rows.
HOT_PART = 1000
#: Samples for each cut of a hot group.
SAMPLES_PER_CUT = 100
#: Bars of a histogram, and rows of a bar that are few enough to be sorted at once.
BARS, FEW = 256, 10_000


def known_size(df: DataFrame) -> DataFrame:
    """Few rows taken through the driver, so that the planner knows how small they are."""
    return df.sparkSession.createDataFrame(df.toArrow(), df.schema)


@dataclass
class Split:
    """A stored table, its hot keys with their row counts, and the rows of both kinds of groups."""

    rows: DataFrame
    keys: list[str]
    hot_keys: DataFrame
    limit: int
    any_hot: bool

    @property
    def ordinary(self) -> DataFrame:
        if not self.any_hot:
            return self.rows
        there = prefixed(self.hot_keys, self.keys, "_h_")
        return self.rows.join(there, same_keys(self.keys, "_h_"), "left_anti")

    def hot(self, details: DataFrame) -> DataFrame:
        """Hot rows with ``details`` of their group."""
        others = [c for c in details.columns if c not in self.keys]
        joined = self.rows.join(prefixed(details, self.keys, "_h_", *others), same_keys(self.keys, "_h_"))
        return joined.select(*self.rows.columns, *others)


def split(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> Split:
    """Store the rows and find the hot keys by one count."""
    rows, keys = settled(df), list(keys)
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_group_rows"))
    limit = max(1, hot_rows, rows.count() // HOT_PART)
    hot = known_size(sizes.filter(F.col("_group_rows") > limit))
    return Split(rows, keys, hot, limit, not hot.isEmpty())


def _bounds(parts: Split, order: Sequence[str]) -> DataFrame:
    """For each hot key an array of places in its order that cut it into runs of about ``limit`` rows.

    The places come from a sample: rows whose hash falls on a multiple. The same rows give the same
    sample, however they are spread.
    """
    every = max(1, parts.limit // SAMPLES_PER_CUT)
    hot = parts.hot(parts.hot_keys)
    sample = hot.filter(F.pmod(F.xxhash64(*parts.rows.columns), F.lit(every)) == 0)
    runs = F.ceil(F.col("_group_rows") / parts.limit).cast("int")
    in_order = Window.partitionBy(*parts.keys).orderBy("_at")
    whole = Window.partitionBy(*parts.keys)
    placed = sample.select(*parts.keys, runs.alias("_runs"), F.struct(*order).alias("_at")).select(
        "*", F.row_number().over(in_order).alias("_n"), F.count(F.lit(1)).over(whole).alias("_of")
    )
    # The first sample at or behind each boundary of equal runs.
    run = F.floor((F.col("_n") - 1) * F.col("_runs") / F.col("_of"))
    first = placed.withColumn("_run", run).groupBy(*parts.keys, "_run").agg(F.min("_at").alias("_at"))
    return known_size(first.filter("_run > 0").groupBy(*parts.keys).agg(F.collect_set("_at").alias("_bounds")))


def running_total(
    df: DataFrame, value: str | Column, keys: Sequence[str], order: Sequence[str], out: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``ordered.running_total`` for groups of any size; ``order`` names columns, rising, NULL first.

    A hot group's runs are summed up each in a task of its own, and every run starts from the totals of
    the runs before it. Rows that tie in the whole of ``order`` stay in one run.
    """
    value = F.col(value) if isinstance(value, str) else value
    exact, kind = _exact(df, value)
    columns = [c for c in df.columns if c != out]
    # Parquet keeps the exact value; a group without keys is one group.
    parts = split(df.withColumn("_value", exact).withColumn("_all", F.lit(0)), [*keys, "_all"], hot_rows)
    frame = (Window.unboundedPreceding, Window.currentRow)
    within = Window.partitionBy(*parts.keys).orderBy(*order).rowsBetween(*frame)
    ordinary = parts.ordinary.select(*columns, F.sum("_value").over(within).cast(kind).alias(out))
    if not parts.any_hot:
        return ordinary
    bounds = parts.hot_keys.drop("_group_rows").join(
        prefixed(_bounds(parts, order), parts.keys, "_b_", "_bounds"), same_keys(parts.keys, "_b_"), "left"
    ).select(*parts.keys, "_bounds")
    here = F.struct(*order)
    run = F.coalesce(F.size(F.filter("_bounds", lambda bound: bound <= here)), F.lit(0))
    cut = parts.hot(known_size(bounds)).withColumn("_run", run).drop("_bounds")
    runs = [*parts.keys, "_run"]
    earlier = Window.partitionBy(*parts.keys).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy(*runs).agg(F.sum("_value").alias("_total"))
    carried = known_size(totals.select(*runs, F.sum("_total").over(earlier).alias("_before")))
    local = Window.partitionBy(*runs).orderBy(*order).rowsBetween(*frame)
    summed = cut.withColumn("_local", F.sum("_value").over(local)).join(
        prefixed(carried, runs, "_c_", "_before"), same_keys(runs, "_c_")
    )
    before, here = _addable(F.col("_before"), kind), _addable(F.col("_local"), kind)
    hot = summed.select(*columns, F.coalesce(before + here, here, before).cast(kind).alias(out))
    return ordinary.unionByName(hot)


def sequence_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """1, 2, 3 … within groups of any size."""
    return running_total(df, F.lit(1).cast("bigint"), keys, order, out, hot_rows)


def islands(
    df: DataFrame, is_start: Column, keys: Sequence[str], order: Sequence[str], out: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Number the runs of rows that begin where ``is_start`` is true, in groups of any size."""
    marker = F.when(is_start, 1).otherwise(0).cast("bigint")
    return running_total(df, marker, keys, order, out, hot_rows)


def _interpolated(low: Column, high: Column, position: Column) -> Column:
    """The value between two neighbours, as ``ordered.group_quantile`` has it."""
    weighted = (F.ceil(position) - position) * low + (position - F.floor(position)) * high
    return F.when(low == high, low).otherwise(weighted)


def _position(p: float, size: str = "_size") -> Column:
    return (F.col(size) - 1) * F.lit(float(p))


def _bar(value: Column) -> Column:
    """The bar of a value between ``_from`` and ``_to``: these have the first and the last for themselves or share it.

    Bars are equally wide. Where no width can be told (infinite or NaN ends, or numbers too close for a
    double) all but the ends share one bar, so that at least the ends part.
    """
    low, high = F.col("_from").cast("double") / 2, F.col("_to").cast("double") / 2
    at = F.try_divide(value.cast("double") / 2 - low, high - low)
    told = at.isNotNull() & ~F.isnan(at) & ~F.isnan(high - low) & (F.abs(high - low) < float("inf"))
    wide = F.least(F.lit(BARS - 1), F.greatest(F.lit(0), F.floor(at * BARS).cast("int")))
    inner = F.when(told, wide).otherwise(BARS // 2)
    return F.when(value <= F.col("_from"), 0).when(value >= F.col("_to"), BARS - 1).otherwise(inner)


def _hot_quantiles(parts: Split, value: str, p: float) -> DataFrame:
    """The exact quantile of each hot group, found by histograms: keys and ``_middle``.

    Every round counts the values between the ends of what can still hold the two neighbours, in ``BARS`` bars
    a group, and goes on in the bar that holds them. Ends are values that occur, so a far outlier costs
    one round. No row moves; a round sends a group's bars.
    """
    keys, v = parts.keys, F.col(value)
    start = parts.hot(parts.hot_keys).filter(v.isNotNull()).groupBy(*keys).agg(
        F.count(value).alias("_size"), F.min(value).alias("_from"), F.max(value).alias("_to")
    )
    state = known_size(start.select(
        *keys, "_size", "_from", "_to", F.lit(0).cast("bigint").alias("_before"),
        F.col("_size").alias("_within"),
    ))
    found: list[DataFrame] = []
    position = _position(p)
    while not state.isEmpty():
        ready = (F.col("_from") == F.col("_to")) | (F.col("_within") <= FEW)
        few = parts.hot(state.filter(ready)).filter((v >= F.col("_from")) & (v <= F.col("_to")))
        picked = few.groupBy(*keys, "_size", "_before").agg(
            F.when(F.min(value) == F.max(value), F.array(F.min(value))).otherwise(
                F.sort_array(F.collect_list(F.when(F.col("_from") != F.col("_to"), v)))
            ).alias("_values")
        )

        def at(place: Column) -> Column:
            return F.get("_values", F.least(place - F.col("_before"), F.size("_values") - 1).cast("int"))

        low, high = at(F.floor(position)), at(F.ceil(position))
        found.append(known_size(picked.select(*keys, _interpolated(low, high, position).alias("_middle"))))
        open_ = known_size(state.filter(~ready))
        if open_.isEmpty():
            break
        between = parts.hot(open_).filter((v >= F.col("_from")) & (v <= F.col("_to")))
        bars = between.groupBy(*keys, "_size", "_before", _bar(v).alias("_bar")).agg(
            F.count(F.lit(1)).alias("_n"), F.min(value).alias("_low"), F.max(value).alias("_high")
        )
        rising = Window.partitionBy(*keys).orderBy("_bar").rowsBetween(Window.unboundedPreceding, -1)
        below = F.col("_before") + F.coalesce(F.sum("_n").over(rising), F.lit(0))
        held = bars.withColumn("_below", below).filter(
            (F.col("_below") <= F.ceil(position)) & (F.col("_below") + F.col("_n") > F.floor(position))
        )
        # One bar holds both neighbours, or two bars one each: the highest of the one, the lowest of the other.
        chosen = known_size(held.groupBy(*keys, "_size").agg(
            F.count(F.lit(1)).alias("_bars"), F.min("_low").alias("_from"), F.max("_high").alias("_to"),
            F.min("_high").alias("_left"), F.max("_low").alias("_right"),
            F.min("_below").alias("_before"), F.sum("_n").alias("_within"),
        ))
        parted = chosen.filter("_bars = 2")
        middle = _interpolated(F.col("_left"), F.col("_right"), position)
        found.append(parted.select(*keys, middle.alias("_middle")))
        state = known_size(chosen.filter("_bars = 1").select(*state.columns))
    made = found[0] if found else parts.hot_keys.limit(0).select(*keys, F.lit(None).cast("double").alias("_middle"))
    for more in found[1:]:
        made = made.unionByName(more)
    return known_size(made)


def delta_in_place(
    df: DataFrame, value: str, keys: Sequence[str], out: str, p: float = 0.5
) -> DataFrame:
    """``value`` minus its group's quantile by windows over the group alone: no join, at most one shuffle.

    None where the rows are stored in buckets of ``keys``. A group meets in one task.
    """
    columns = [c for c in df.columns if c != out]
    whole = Window.partitionBy(*keys)
    rising = whole.orderBy(F.col(value).asc_nulls_last())
    sized = df.withColumn("_size", F.count(value).over(whole)).withColumn(
        "_place", F.row_number().over(rising) - 1
    )
    position = _position(p)

    def at(place: Column) -> Column:
        return F.max(F.when(F.col("_place") == place, F.col(value))).over(whole)

    middle = _interpolated(at(F.floor(position)), at(F.ceil(position)), position)
    return sized.withColumn("_middle", middle).select(
        *columns, (F.col(value) - F.col("_middle")).alias(out)
    )


def delta_to_median(
    df: DataFrame, value: str, keys: Sequence[str], out: str, p: float = 0.5, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``ordered.delta_to_median`` for groups of any size; the input is made once.

    Ordinary groups are sorted by value in one window, which gives the quantile to every row without a join. A
    hot group's rows do not move at all.
    """
    columns = [c for c in df.columns if c != out]
    parts = split(df, keys, hot_rows)
    ordinary = delta_in_place(parts.ordinary, value, keys, out, p).select(*columns, out)
    if not parts.any_hot:
        return ordinary
    middles = parts.hot_keys.select(*keys).join(
        prefixed(_hot_quantiles(parts, value, p), keys, "_q_", "_middle"), same_keys(keys, "_q_"), "left"
    ).select(*keys, "_middle")
    hot = parts.hot(known_size(middles)).select(*columns, (F.col(value) - F.col("_middle")).alias(out))
    return ordinary.unionByName(hot)

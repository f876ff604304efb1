"""Join-based lookups: the row a step ahead, and rows whose key is not there yet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def next_row_lookup(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    step_col: str,
    columns: dict[str, str],
    step: int = 1,
) -> DataFrame:
    """Add ``columns`` (right name → new name) from the row ``step`` further on.

    A left equi join, not ``lead``: when the row in question is missing the result
    is NULL and not some later row's value. The step is taken off on the right, so
    all keys stay plain columns. Several matching rows all match.
    """
    ahead = right.select(
        *keys,
        (F.col(step_col) - F.lit(step)).alias(step_col),
        *[F.col(name).alias(new) for name, new in columns.items()],
    )
    return left.join(ahead, [*keys, step_col], "left")


def only_new(
    incoming: DataFrame, existing: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Rows of ``incoming`` whose key is not in ``existing``.

    ``existing`` is usually the whole history, so it is first cut down to the keys
    that come in; what the anti join then sees is no larger than the batch.
    """
    candidates = incoming.select(*keys).distinct()
    present = existing.select(*keys).join(candidates, list(keys), "left_semi").distinct()
    return incoming.join(present, list(keys), "left_anti")


def not_in(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``child`` that have no parent; rows with a NULL key have none."""
    return child.join(parent.select(*keys).distinct(), list(keys), "left_anti")


def missing_condition(columns: Sequence[str]) -> Column:
    """True when any of the columns is NULL."""
    condition = F.lit(False)
    for name in columns:
        condition = condition | F.col(name).isNull()
    return condition

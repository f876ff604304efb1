"""Fixed-size tables of cells that tasks fill and that are added up without a full one moving per row.

A task hands out its table in compressed segments. Segments are folded in two steps, first in
lanes, then whole, each in one streaming pass over sorted rows, so that memory is that of
one segment however many tasks there are. The driver gets the folded table, whose size is a constant.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

SEGMENT = 1 << 15
LANES = 16
SCHEMA = "segment int, lane int, cells binary"

Fold = Callable[[np.ndarray, np.ndarray], np.ndarray]


def segments(table: np.ndarray) -> Iterator[pd.DataFrame]:
    """A task's table (first axis: cells) in compressed segments; empty ones are left out."""
    lane = TaskContext.get().partitionId() % LANES
    rows = []
    for i, at in enumerate(range(0, len(table), SEGMENT)):
        part = table[at : at + SEGMENT]
        if part.any():
            rows.append((i, lane, zlib.compress(part.tobytes(), 1)))
    yield pd.DataFrame(rows, columns=["segment", "lane", "cells"])


def _folded(df: DataFrame, keys: list[str], dtype: str, fold: Fold) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, sum_ = None, None
        for batch in batches:
            for row in batch.itertuples(index=False):
                key = tuple(getattr(row, k) for k in keys)
                cells = np.frombuffer(zlib.decompress(row.cells), dtype)
                if key == at:
                    sum_ = fold(sum_, cells)
                    continue
                if at is not None:
                    yield _row(at, sum_)
                at, sum_ = key, cells
        if at is not None:
            yield _row(at, sum_)

    def _row(key: tuple, cells: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame(
            [(key[0], 0, zlib.compress(cells.tobytes(), 1))], columns=["segment", "lane", "cells"]
        )

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, SCHEMA)


def whole(df: DataFrame, size: int, dtype: str, fold: Fold) -> np.ndarray:
    """The fold of all tasks' tables of ``size`` numbers."""
    lanes = _folded(df, ["segment", "lane"], dtype, fold)
    table = np.zeros(size, dtype)
    width = len(np.zeros(1, dtype).tobytes())
    for row in _folded(lanes, ["segment"], dtype, fold).toLocalIterator():
        cells = np.frombuffer(zlib.decompress(row.cells), dtype)
        at = row.segment * SEGMENT
        table[at : at + len(cells)] = cells
    assert table.nbytes == size * width
    return table

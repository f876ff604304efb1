"""Packing token sequences: repeat counts of length combinations by non-negative least squares."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackside.llm.groups import numbered
from trackside.llm.store import keep
from trackside.llm.tokens import tokenizer_path, word_tokenizer

WINDOW = 2048
END_ID = 1
#: Steps of the least-squares search.
STEPS = 200
_RANK_BITS = 40

Pattern = tuple[tuple[int, ...], int]


def pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
    end_id: int = END_ID, path: str | None = None,
) -> DataFrame:
    """Whole windows and the rest of every document: ``id, row, start, length, ids_crc32, doc_tokens``.

    A document's ids are its text's, special strings included, and ``end_id``; a null or
    empty text has ``end_id`` only. The checksum is of the ids as little-endian 32-bit numbers.
    """
    path = path or tokenizer_path()
    end = np.uint16(end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path, False)
        for batch in batches:
            place, start, length, crc, total = [], [], [], [], []
            for i, ids in enumerate(tokenizer.arrays(batch.column("text"))):
                numbers = np.append(ids, end).astype("<u4")
                for cut in range(0, len(numbers), window):
                    part = numbers[cut : cut + window]
                    place.append(i)
                    start.append(cut)
                    length.append(len(part))
                    crc.append(zlib.crc32(part))
                    total.append(len(numbers))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(pa.array(place, pa.int64())) for c in ("id", "row")),
                 *(pa.array(x, pa.int64()) for x in (start, length, crc, total))],
                ["id", "row", "start", "length", "ids_crc32", "doc_tokens"],
            )

    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.monotonically_increasing_id().alias("row"),
        F.col(f"`{text_col}`").alias("text"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"id {kind}, row bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    )


def combinations(present: np.ndarray, window: int) -> np.ndarray:
    """All pairs and triples of lengths that occur and fill the window; a pair has a 0 in front."""
    there = np.zeros(window + 1, bool)
    there[present[present < window]] = True
    found = []
    for a in range(window // 3 + 1):
        b = np.arange(max(a, 1), (window - a) // 2 + 1)
        if a == 0 or there[a]:
            fits = there[b] & there[window - a - b]
            b = b[fits]
            found.append(np.stack([np.full(len(b), a), b, window - a - b], 1))
    return np.concatenate(found)


def repeat_counts(combos: np.ndarray, histogram: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Non-negative least squares: how often each combination, so that lengths come out as in the histogram."""
    size = len(histogram)
    target = histogram.astype(float)
    target[0] = 0.0

    def lengths_of(x: np.ndarray) -> np.ndarray:
        made = sum(np.bincount(combos[:, j], x, size) for j in range(combos.shape[1]))
        made[0] = 0.0
        return made

    def of_lengths(r: np.ndarray) -> np.ndarray:
        return sum(r[combos[:, j]] for j in range(combos.shape[1]))

    v = np.ones(len(combos))
    for _ in range(20):
        v = of_lengths(lengths_of(v))
        norm = np.linalg.norm(v)
        v /= norm
    x = y = np.zeros(len(combos))
    momentum = 1.0
    for _ in range(steps):
        r = lengths_of(y) - target
        r[0] = 0.0
        fresh = np.maximum(0.0, y - of_lengths(r) / (1.05 * norm))
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        y = fresh + (momentum - 1) / following * (fresh - x)
        x, momentum = fresh, following
    return x


def plan(histogram: np.ndarray, window: int = WINDOW) -> list[Pattern]:
    """Patterns of lengths and how often each is repeated; they use every length of the histogram up.

    ``histogram[n]`` is the number of pieces of length ``n``. Whole windows stand alone.
    Combinations that fill the window get the rounded least-squares counts, as far as the lengths last,
    the larger first. The rest is packed greedily, the longest piece first and into
    each gap the longest that fits; each such pattern is repeated until one of its lengths is used up.
    """
    left = histogram.astype(np.int64).copy()
    made: list[Pattern] = [((window,), int(left[window]))] if left[window] else []
    left[window] = 0
    combos = combinations(np.flatnonzero(left), window)
    if len(combos):
        counts = repeat_counts(combos, left)
        for i in np.argsort(-counts, kind="stable"):
            lengths = tuple(int(n) for n in combos[i] if n)
            most = min(int(left[n]) // lengths.count(n) for n in lengths)
            times = min(most, int(counts[i] + 0.5))
            if times:
                made.append((lengths, times))
                for n in lengths:
                    left[n] -= times
    while (longest := int(np.flatnonzero(left).max(initial=0))):
        lengths, gap, free = [], window, left.copy()
        fit = longest
        while fit:
            lengths.append(fit)
            free[fit] -= 1
            gap -= fit
            fit = int(np.flatnonzero(free[: gap + 1]).max(initial=0))
        times = min(int(left[n]) // lengths.count(n) for n in set(lengths))
        made.append((tuple(lengths), times))
        for n in lengths:
            left[n] -= times
    return made


def _slots(patterns: list[Pattern]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For runs of equally long pieces, by length and rank: first key, first sequence, offset."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, times in patterns:
        offset = 0
        for n in lengths:
            rank = used.get(n, 0)
            rows.append(((n << _RANK_BITS) + rank, sequence, offset))
            used[n] = rank + times
            offset += n
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 3)
    return table[:, 0], table[:, 1], table[:, 2]


def pack(pieces_: DataFrame, window: int = WINDOW) -> DataFrame:
    """``pieces_`` (with ``length``, ``row``, ``start``) with ``sequence_id`` and ``offset``.

    The histogram of lengths, at most ``window`` numbers, decides everything: the driver plans
    patterns from it, and a piece finds its place by its length and its number among the
    pieces of that length, which is counted without any length's pieces meeting in one task.
    An empty table has no sequence.
    """
    histogram = np.zeros(window + 1, np.int64)
    for r in pieces_.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():
        histogram[r.length] = r.n
    slots = pieces_.sparkSession.sparkContext.broadcast(_slots(plan(histogram, window)))
    ranked = numbered(pieces_, ["length"], ["row", "start"], "__rank", int(histogram.sum()))

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        keys, sequences, offsets = slots.value
        key = (length.to_numpy() << _RANK_BITS) + rank.to_numpy()
        at = np.searchsorted(keys, key, "right") - 1
        return pd.DataFrame({"sequence_id": sequences[at] + key - keys[at], "offset": offsets[at]})

    return ranked.withColumn("__at", place("length", "__rank")).select(
        *pieces_.columns, F.col("__at.sequence_id"), F.col("__at.offset")
    )


def pack_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
    path: str | None = None,
) -> DataFrame:
    """One row for each piece of each document, with its sequence and its place there.

    Documents longer than the window are cut into whole windows and a rest; nothing else is
    cut. Each id lies in one piece, rows that repeat an id are documents of their own.
    """
    return pack(keep(pieces(docs, id_col, text_col, window, path=path), "pieces"), window).drop("row")

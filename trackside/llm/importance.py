"""Importance resampling towards a target corpus, drawn by exact ranks from a parallel sort.

Each text is a bag of hashed word runs. A bucket's gain is the log ratio of its shares in the
target and in the corpus; a text's weight is the mean gain of its runs, and its score the weight
plus Gumbel noise made from its id, so that the highest scores are a draw without replacement.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackside.llm.store import keep
from trackside.llm.textscan import ALPHANUMERIC, LOWER, texts

#: Buckets that word runs are hashed into: the size of every table of gains.
CELLS = 10_000
#: Bytes of text that are looked at together; a longer text is cut between words.
WINDOW = 1 << 22
#: Words up to this many bytes go through the vectorised checksum, longer ones one by one.
SHORT = 48
#: At most so many samples of the sorted runs reach the driver.
SAMPLES = 100_000
#: Rows that meet in one task of the exchange, about.
SEGMENT_ROWS = 500_000


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


_CRC = _crc_table()


def _step(state: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return _CRC[(state ^ byte) & np.uint32(255)] ^ (state >> np.uint32(8))


def continued(crc: np.ndarray, low: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Checksums ``crc`` carried on over the bytes of words, all words at once."""
    state = ~crc
    short = lengths <= SHORT
    at = np.flatnonzero(short & (lengths > 0))
    j = 0
    while len(at):
        state[at] = _step(state[at], low[starts[at] + j].astype(np.uint32))
        j += 1
        at = at[lengths[at] > j]
    state = ~state
    for i in np.flatnonzero(~short):
        word = low[starts[i] : starts[i] + lengths[i]]
        state[i] = zlib.crc32(word.tobytes(), int(crc[i]))
    return state


@dataclass
class _Piece:
    """Words of a stretch of bytes: place, length, number of their text, and which ones are new."""

    low: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    text: np.ndarray
    fresh: np.ndarray


def _end(inside: np.ndarray, offsets: np.ndarray, cut: int, window: int) -> int:
    """Where the stretch that begins at ``cut`` ends: within ``window`` bytes unless a word is longer."""
    end = cut + window
    while end < len(inside):
        outside = np.flatnonzero(~inside[end - window : end])
        behind = end - window + int(outside[-1]) + 1 if len(outside) else 0
        text = int(offsets[np.searchsorted(offsets, end, "right") - 1])
        if max(behind, text) > cut:
            return max(behind, text)
        end += window
    return len(inside)


def _pieces(data: np.ndarray, offsets: np.ndarray, longest: int, window: int) -> Iterator[_Piece]:
    """The words of all texts in stretches of about ``window`` bytes.

    A stretch ends between two words or texts. It begins ``longest - 1`` words early, so that no run
    of words is lost to a cut; words that were there before are not ``fresh``.
    """
    inside = ALPHANUMERIC[data]
    begin = cut = 0
    while cut < len(data):
        end = _end(inside, offsets, cut, window)
        within = inside[begin:end]
        edge = np.zeros(end - begin + 1, bool)
        edge[offsets[(offsets >= begin) & (offsets <= end)] - begin] = True
        first, last = within.copy(), within.copy()
        first[1:] &= ~within[:-1] | edge[1:-1]
        last[:-1] &= ~within[1:] | edge[1:-1]
        starts = np.flatnonzero(first)
        lengths = np.flatnonzero(last) + 1 - starts
        text = np.searchsorted(offsets, starts + begin, "right") - 1
        yield _Piece(LOWER[data[begin:end]], starts, lengths, text, starts + begin >= cut)
        early = min(longest - 1, len(starts))
        begin = begin + int(starts[-early]) if early else end
        cut = end


def run_buckets(
    column: pa.Array, longest: int = 1, cells: int = CELLS, window: int = WINDOW
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, bucket, run length) of all runs of 1 to ``longest`` consecutive words of each text.

    A run is its lower-cased (A-Z) words joined by one space, its bucket the CRC-32 of its UTF-8
    bytes modulo ``cells``. A null text has none.
    """
    data, offsets = texts(column)
    for piece in _pieces(data, offsets, longest, window):
        crc = np.zeros(len(piece.starts), np.uint32)
        for size in range(1, longest + 1):
            count = len(piece.starts) - size + 1
            if count <= 0:
                break
            state = crc[:count]
            if size > 1:
                state = ~_step(~state, np.full(count, 32, np.uint32))
            crc = continued(state, piece.low, piece.starts[size - 1 :], piece.lengths[size - 1 :])
            whole = (piece.text[:count] == piece.text[size - 1 :]) & piece.fresh[size - 1 :]
            yield (
                piece.text[:count][whole], (crc[whole] % np.uint32(cells)).astype(np.int64),
                np.full(int(whole.sum()), size),
            )


def bucket_counts(docs: DataFrame, text_col: str, longest: int = 1, cells: int = CELLS) -> np.ndarray:
    """How often each bucket occurs in all texts. Tasks send one row per bucket; so does the driver get."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int64)
        for batch in batches:
            for _, bucket, _ in run_buckets(batch.column(0), longest, cells):
                total += np.bincount(bucket, minlength=cells)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    text = F.col(f"`{text_col}`").alias("text")
    found = docs.select(text).mapInArrow(run, "bucket bigint, n bigint")
    counts = np.zeros(cells, np.int64)
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    return counts


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousand times the log ratio of the smoothed shares in the target and the corpus, floored."""
    cells = len(corpus)
    s, t = corpus.astype(np.float64), target.astype(np.float64)
    ratio = ((t + 1) * (s.sum() + cells)) / ((s + 1) * (t.sum() + cells))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(
    docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
    longest: int = 1,
) -> DataFrame:
    """``id, n_words, n_features, weight`` of every row: the floored mean gain of its runs, 0 without any."""
    cells = len(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words, features, total = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for text, bucket, size in run_buckets(batch.column("text"), longest, cells):
                # Whole numbers far below 2^53: adding them up as doubles is exact.
                total += np.bincount(text, gains[bucket], n).astype(np.int64)
                features += np.bincount(text, minlength=n)
                words += np.bincount(text[size == 1], minlength=n)
            mean = total // np.maximum(features, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(words), pa.array(features), pa.array(mean)],
                ["id", "n_words", "n_features", "weight"],
            )

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_words bigint, n_features bigint, weight bigint")


def noise(id_: Column, seed: int) -> Column:
    """Gumbel noise in thousandths from an id: the first 32 bits of the SHA-256 of ``seed:id``."""
    said = F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("")))
    number = F.conv(F.substring(F.sha2(said, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((number + 0.5) / F.lit(4294967296.0)))).cast("bigint")


def _order() -> list[Column]:
    """Of equal scores the smallest id comes first, then rows without id, then the row stored first."""
    return [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("row").asc()]


def _keys(batch: pa.RecordBatch) -> list[np.ndarray]:
    """The sort keys of a batch as whole numbers, least significant first."""
    ids = batch.column("id")
    empty = np.asarray(ids.is_null())
    return [
        np.asarray(batch.column("row")), np.asarray(ids.fill_null(0)), empty.astype(np.int64),
        -np.asarray(batch.column("score")),
    ]


def _sample(runs: DataFrame, stride: int) -> np.ndarray:
    """Every ``stride``-th row of each sorted run, as sort keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed = 0
        for batch in batches:
            first = (stride // 2 - passed) % stride
            passed += batch.num_rows
            keys = [pa.array(k[first::stride]) for k in _keys(batch)]
            yield pa.RecordBatch.from_arrays(keys, ["a", "b", "c", "d"])

    found = runs.mapInArrow(run, "a bigint, b bigint, c bigint, d bigint").toPandas()
    keys = found.to_numpy(np.int64).reshape(-1, 4)
    return keys[np.lexsort(keys.T)]


def _segmented(runs: DataFrame, splitters: np.ndarray) -> DataFrame:
    """The rows with the ``segment`` that they fall into: how many splitters stand before them."""
    n = len(splitters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [np.concatenate([s, k]) for s, k in zip(splitters.T, _keys(batch), strict=True)]
            order = np.lexsort(keys)
            before = np.empty(len(order), np.int64)
            before[order] = np.cumsum(order < n)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(before[n:])], [*batch.schema.names, "segment"]
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in runs.schema)
    return runs.mapInArrow(run, f"{kinds}, segment bigint")


def ranked(runs: DataFrame, draw: int, eligible: str, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """All rows with ``rank`` 1, 2, 3 … for the first ``draw`` of the rows where ``eligible``; else null.

    ``runs`` is a stored table of sorted runs with whole-number ``id``, ``score`` and a unique
    ``row``. Sorting by regular sampling: the runs' regular samples give splitters that cut all rows
    into segments of similar size, because a full order has no ties to pile up in one of them.
    Segments are exchanged, each is merged in one task, and the counts of the segments before it
    make its places exact ranks. Segments that begin behind the last drawn rank stay where they are.
    """
    spark = runs.sparkSession
    rows = runs.filter(eligible)
    each = rows.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
    total, parts = each.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    segments = min(SAMPLES, max(slots, -(-total // segment_rows)))
    stride = max(1, total // min(SAMPLES, 4 * max(parts, 1) * segments))
    samples = _sample(rows, stride)
    at = np.arange(1, segments) * len(samples) // segments
    splitters = samples[np.unique(at)] if len(samples) else samples
    placed = _segmented(rows, splitters)
    counts = {r["segment"]: r["n"] for r in placed.groupBy("segment").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, passed, last = [], 0, -1
    for segment in sorted(counts):
        before.append((segment, passed))
        last = segment if passed < draw else last
        passed += counts[segment]
    prefix = spark.createDataFrame(before, "segment bigint, before bigint")
    merged = Window.partitionBy("segment").orderBy(*_order())
    place = placed.filter(F.col("segment") <= last).withColumn("place", F.row_number().over(merged))
    rank = F.col("before") + F.col("place")
    near = place.join(F.broadcast(prefix), "segment").withColumn(
        "rank", F.when(rank <= draw, rank).cast("bigint")
    ).drop("segment", "place", "before")
    undrawn = F.lit(None).cast("bigint")
    far = placed.filter(F.col("segment") > last).drop("segment").withColumn("rank", undrawn)
    rest = runs.filter(~F.expr(eligible)).withColumn("rank", undrawn)
    return near.unionByName(far).unionByName(rest)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 10, seed: int = 2024, longest: int = 1,
    least_words: int = 20, cells: int = CELLS, id_col: str = "doc_id", text_col: str = "text",
    target_text_col: str = "text", segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """``id, n_features, weight, score, rank`` of every row of ``docs``.

    ``percent`` of the rows with at least ``least_words`` words are drawn, those of the highest scores;
    ``rank`` is 1, 2, 3 … for these and null for the others. Ids are whole numbers.

    A null or empty text has no runs and weight 0. Noise depends on the id alone, so rows that repeat
    an id and a text tie, and each has a rank of its own; a row without id has the noise of an empty id and
    comes after all ids of the same score. An empty table gives an empty result, an empty target the
    smoothed gains of no counts. Other columns of ``docs`` play no part, whatever their names.
    """
    gains = bucket_gains(
        bucket_counts(docs, text_col, longest, cells),
        bucket_counts(target, target_text_col, longest, cells),
    )
    scored = (
        weights(docs.withColumn(id_col, F.col(f"`{id_col}`").cast("bigint")), gains, id_col, text_col, longest)
        .withColumn("score", F.col("weight") + noise(F.col("id"), seed))
        .withColumn("row", F.monotonically_increasing_id())
    )
    runs = keep(scored.sortWithinPartitions(*_order()), "runs")
    eligible = f"n_words >= {least_words}"
    draw = runs.filter(eligible).count() * percent // 100
    made = ranked(runs, draw, eligible, segment_rows)
    return made.select("id", "n_features", "weight", "score", "rank")

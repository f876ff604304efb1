"""Hard negatives by rotated one-bit codes with exact intervals around their estimates.

A vector is rotated and written as signs: the code, and beside it the code-vector alignment, the factor
that brings the signs closest to the vector. What is left over is rotated and coded again, a few
levels deep, and the length of the last rest is stored. For a query whose rotations are cut into bit planes,
popcounts give its product with each code; Cauchy-Schwarz bounds its product with the rest. So every
estimate has an interval that holds the true score for certain. Candidates whose interval cannot
matter go, level by level; the others are scored in whole numbers. Results are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackside.llm.store import keep
from trackside.session import scratch_path

#: Codes of each vector. A level leaves about 0.6 of the rest before it.
LEVELS = 4
#: Bits of a query's components.
PLANES = 8
#: Anchors that are searched in one pass over all rows, about: what is broadcast at a time.
BLOCK = 1024
#: Rows that are compared with a block of anchors at once.
ROWS = 2048
#: Rows that are scored first, for thresholds that all tasks can start from.
SEED_ROWS = 4096
#: Scored pairs that a task holds before it cuts its lists to their lengths.
HELD = 500_000
#: Longest vector of whole components whose products are sure to fit into 64 bits.
LONGEST = 2.0**31
_SLACK = 1e-9


@dataclass
class Wanted:
    """What to mine: so many positives an anchor, so many negatives a positive, in this window of scores."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90


def rotation(dims: int) -> np.ndarray:
    """A fixed random rotation."""
    made, upper = np.linalg.qr(np.random.default_rng(20240607).standard_normal((dims, dims)))
    return made * np.sign(np.diag(upper))


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    spare = -bits.shape[-1] % 64
    wide = np.pad(bits, [(0, 0)] * (bits.ndim - 1) + [(0, spare)])
    return np.packbits(wide, axis=-1, bitorder="little").view(np.uint64)


@dataclass
class Codes:
    """Codes of some vectors: signs (row, level, word), alignments and rests (row, level)."""

    signs: np.ndarray
    alignment: np.ndarray
    rest: np.ndarray


def coded(vectors: np.ndarray, turn: np.ndarray, levels: int = LEVELS) -> Codes:
    """Each level holds the rotated rest of the level before; a zero vector has alignment 0."""
    dims = vectors.shape[1]
    left, signs, alignment, rest = vectors.astype(np.float64), [], [], []
    for _ in range(levels):
        left = left @ turn.T
        up = left >= 0
        share = np.abs(left).mean(axis=1)
        left = left - share[:, None] * np.where(up, 1.0, -1.0)
        signs.append(_packed(up))
        alignment.append(share * np.sqrt(dims))
        rest.append(np.sqrt((left**2).sum(axis=1)))
    return Codes(np.stack(signs, 1), np.stack(alignment, 1), np.stack(rest, 1))


class Queries:
    """Anchors ready for popcounts: bit planes of their rotations, one set for each level."""

    def __init__(self, vectors: np.ndarray, turn: np.ndarray, levels: int = LEVELS):
        self.dims = vectors.shape[1]
        self.length = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        self.planes, self.step, self.base, self.error = [], [], [], []
        q = vectors.astype(np.float64)
        for _ in range(levels):
            q = q @ turn.T
            base = q.min(axis=1, initial=0.0)
            step = np.maximum((q.max(axis=1, initial=0.0) - base) / (2**PLANES - 1), 1e-300)
            whole = np.rint((q - base[:, None]) / step[:, None]).astype(np.int64)
            self.planes.append(np.stack([_packed((whole >> j) & 1 == 1) for j in range(PLANES)], 1))
            self.step.append(step)
            self.base.append(base)
            # The product with a code of signs is off by this much at most.
            self.error.append(np.abs(base[:, None] + whole * step[:, None] - q).sum(axis=1))
        self.total = [
            b * self.dims + s * sum(
                np.bitwise_count(p[:, j]).sum(axis=-1, dtype=np.int64) << j for j in range(PLANES)
            )
            for b, s, p in zip(self.base, self.step, self.planes, strict=True)
        ]

    def product(self, level: int, a: np.ndarray, signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated products of anchors ``a`` with unit code vectors, and how far off they can be.

        ``a`` and ``signs`` are pairs, or broadcast against each other.
        """
        ups = np.zeros(np.broadcast_shapes(a.shape, signs.shape[:-1]), np.int64)
        for j in range(PLANES):
            both = self.planes[level][a, j] & signs
            ups += np.bitwise_count(both).sum(axis=-1, dtype=np.int64) << j
        count = np.bitwise_count(signs).sum(axis=-1, dtype=np.int64)
        # Twice the sum over positive signs less the sum over all.
        value = 2 * (self.base[level][a] * count + self.step[level][a] * ups) - self.total[level][a]
        root = np.sqrt(self.dims)
        return value / root, self.error[level][a] / root

    def interval(
        self, level: int, a: np.ndarray, codes: Codes, r: np.ndarray, before: np.ndarray, loose: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(low, high) of the scores of pairs, and the estimate and its looseness for the next level."""
        along, off = self.product(level, a, codes.signs[r, level])
        share = codes.alignment[r, level]
        estimate, loose = before + share * along, loose + share * off
        # The rest stands at right angles to its code: only the query's part that does so too counts.
        least = np.maximum(np.abs(along) - off, 0.0)
        across = np.sqrt(np.maximum(self.length[a] ** 2 - least**2, 0.0))
        width = loose + codes.rest[r, level] * across + _SLACK * (1 + self.length[a] * (
            codes.rest[r, level] + np.abs(share)
        ))
        return estimate - width, estimate + width, estimate, loose


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row; minus infinity where there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k]


@dataclass
class Block:
    """Anchors that are searched together. ``floor`` and ``low``/``high`` are (anchor, goal) arrays.

    A goal is one list to fill: the rows of the anchor's label, or the negatives of one positive.
    """

    vectors: np.ndarray
    label: np.ndarray
    row: np.ndarray
    same: bool
    keep: int
    low: np.ndarray
    high: np.ndarray
    floor: np.ndarray

    def goals(self) -> int:
        return self.low.shape[1]


class _Search:
    """Fills the lists of a block from batches of rows, and remembers the best scores so far."""

    def __init__(self, block: Block, turn: np.ndarray):
        self.block, self.queries = block, Queries(block.vectors, turn)
        n = len(block.vectors)
        self.best = np.full((n, block.goals(), block.keep), -np.inf)
        self.found: list[tuple[np.ndarray, ...]] = []

    def floor(self) -> np.ndarray:
        """Scores below this cannot be in a list any more."""
        return np.maximum(self.block.floor, self.best.min(axis=2))

    def add(self, vectors: np.ndarray, label: np.ndarray, row: np.ndarray, ids: np.ndarray, codes: Codes) -> None:
        block, q = self.block, self.queries
        fits = (block.label[:, None] == label[None, :]) == block.same
        fits &= block.row[:, None] != row[None, :]
        floor = self.floor()
        pairs = None
        for level in range(codes.signs.shape[1]):
            if pairs is None:
                a, r = np.arange(len(block.vectors))[:, None], np.arange(len(row))[None, :]
                low, high, estimate, loose = q.interval(level, a, codes, r, 0.0, 0.0)
                for goal in range(block.goals()):
                    sure = fits & (low >= block.low[:, goal, None]) & (high <= block.high[:, goal, None])
                    floor[:, goal] = np.maximum(floor[:, goal], _kth(np.where(sure, low, -np.inf), block.keep))
                may = self._may(slice(None), low, high, floor, (len(block.vectors), 1)) & fits
                pairs = np.nonzero(may)
                estimate, loose = estimate[pairs], np.broadcast_to(loose, may.shape)[pairs]
            else:
                low, high, estimate, loose = q.interval(level, pairs[0], codes, pairs[1], estimate, loose)
                stay = self._may(pairs[0], low, high, floor, (-1,))
                pairs = pairs[0][stay], pairs[1][stay]
                estimate, loose = estimate[stay], loose[stay]
        self._score(pairs, vectors, row, ids)

    def _may(self, a, low: np.ndarray, high: np.ndarray, floor: np.ndarray, shape: tuple) -> np.ndarray:
        """Whether the interval of a pair leaves it a place in any of the anchor's lists."""
        block, may = self.block, False
        for goal in range(block.goals()):
            least = np.maximum(block.low[a, goal], floor[a, goal]).reshape(shape)
            may = may | (high >= least) & (low <= block.high[a, goal].reshape(shape))
        return may

    def _score(self, pairs: tuple[np.ndarray, np.ndarray], vectors: np.ndarray, row: np.ndarray, ids: np.ndarray) -> None:
        block = self.block
        a, r = pairs
        score = np.einsum("ij,ij->i", block.vectors[a], vectors[r]) if len(a) else np.zeros(0, np.int64)
        floor, useful = self.floor(), np.zeros(len(a), bool)
        for goal in range(block.goals()):
            inside = (score >= block.low[a, goal]) & (score <= block.high[a, goal]) & (score >= floor[a, goal])
            useful |= inside
            self._remember(a[inside], score[inside], goal)
        self.found.append((a[useful], ids[r[useful]], row[r[useful]], score[useful]))
        if sum(len(part[0]) for part in self.found) > HELD:
            self.found = [self.results()]

    def _remember(self, a: np.ndarray, score: np.ndarray, goal: int) -> None:
        """The best scores of each anchor: old ones and new ones sorted together."""
        n, size = len(self.block.vectors), self.block.keep
        who = np.concatenate([np.repeat(np.arange(n), size), a])
        what = np.concatenate([self.best[:, goal].ravel(), score])
        order = np.lexsort((-what, who))
        who, what = who[order], what[order]
        place = np.arange(len(who)) - np.searchsorted(who, np.arange(n))[who]
        top = place < size
        self.best[:, goal] = what[top].reshape(n, size)

    def results(self) -> tuple[np.ndarray, ...]:
        """(anchor, id, row, score) of the rows that are in a list, ties cut by id and row."""
        if not self.found:
            return (np.zeros(0, np.int64),) * 4
        a, ids, row, score = (np.concatenate(x) for x in zip(*self.found, strict=True))
        order = np.lexsort((row, ids, -score, a))
        a, ids, row, score = a[order], ids[order], row[order], score[order]
        useful = np.zeros(len(a), bool)
        for goal in range(self.block.goals()):
            inside = np.flatnonzero((score >= self.block.low[a, goal]) & (score <= self.block.high[a, goal]))
            who = a[inside]
            place = np.arange(len(who)) - np.searchsorted(who, who)
            useful[inside[place < self.block.keep]] = True
        return a[useful], ids[useful], row[useful], score[useful]


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1)


_FOUND = "anchor bigint, id bigint, row bigint, score bigint"


def _searched(rows: DataFrame, block: Block, turn: np.ndarray) -> DataFrame:
    """All rows against a block of anchors: each task gives what its rows can add to the lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _Search(block, turn)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                n = part.num_rows
                signs = np.frombuffer(b"".join(part.column("signs").to_pylist()), np.uint64)
                codes = Codes(
                    signs.reshape(n, LEVELS, -1), _matrix(part.column("alignment"), np.float64),
                    _matrix(part.column("rest"), np.float64),
                )
                search.add(
                    _matrix(part.column("vector"), np.int64), np.asarray(part.column("label")),
                    np.asarray(part.column("row")), np.asarray(part.column("id")), codes,
                )
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in search.results()], ["anchor", "id", "row", "score"])

    return rows.select("id", "row", "label", "vector", "signs", "alignment", "rest").mapInArrow(run, _FOUND)


def whole_vectors(
    vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int
) -> DataFrame:
    """``id, label, vector, row`` of the rows that take part, vectors in whole numbers.

    A row without id, label or vector, or with a null or non-finite component, takes no part; nor does
    a vector of another length than most (of equally frequent lengths the greatest), or one so long that a
    product might not fit into 64 bits.
    """
    vector = F.col(f"`{vector_col}`")
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{label_col}`").cast("bigint").alias("label"),
        F.when(finite, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))).alias("v"),
        F.monotonically_increasing_id().alias("row"),
    ).filter("id is not null and label is not null and v is not null and size(v) > 0")
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    rows = keep(
        rows.filter(square < LONGEST**2).withColumn("v", F.transform("v", lambda x: x.cast("bigint")))
        .withColumnRenamed("v", "vector"), "vectors",
    )
    common = rows.groupBy(F.size("vector").alias("dims")).agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), F.desc("dims")
    ).first()
    return rows.filter(F.size("vector") == (common["dims"] if common else 0))


def with_codes(rows: DataFrame, turn: np.ndarray, levels: int = LEVELS) -> DataFrame:
    """The rows with their codes: ``signs`` of all levels, ``alignment`` and ``rest`` of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                made = coded(_matrix(part.column("vector"), np.int64), turn, levels)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([s.tobytes() for s in made.signs], pa.binary()),
                     pa.array(list(made.alignment)), pa.array(list(made.rest))],
                    [*part.schema.names, "signs", "alignment", "rest"],
                )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{kinds}, signs binary, alignment array<double>, rest array<double>")


def _top(found: DataFrame, keys: list[str], size: int) -> DataFrame:
    best = Window.partitionBy(*keys).orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= size)


def _exact(block: Block, rows: tuple[np.ndarray, ...]) -> np.ndarray:
    """The k-th best score in each goal among some rows: no list can end below it."""
    vectors, label, row = rows
    score = (block.vectors @ vectors.T).astype(np.float64)
    fits = ((block.label[:, None] == label) == block.same) & (block.row[:, None] != row)
    return np.stack([
        _kth(np.where(fits & (score >= block.low[:, g, None]) & (score <= block.high[:, g, None]), score, -np.inf),
             block.keep)
        for g in range(block.goals())
    ], 1)


def _local(df: DataFrame) -> tuple[np.ndarray, ...]:
    table = df.select("vector", "label", "row", "id").toArrow().combine_chunks()
    return (
        _matrix(table.column("vector").combine_chunks(), np.int64) if table.num_rows else np.zeros((0, 0), np.int64),
        np.asarray(table.column("label")), np.asarray(table.column("row")), np.asarray(table.column("id")),
    )


def _mined(
    spark: SparkSession, rows: DataFrame, anchors: DataFrame, seed: tuple[np.ndarray, ...], wanted: Wanted
) -> DataFrame | None:
    """Positives and negatives of one block of anchors."""
    vectors, label, row, ids = _local(anchors)
    n = len(ids)
    if n == 0:
        return None
    turn = rotation(vectors.shape[1])
    everything = np.full((n, 1), -np.inf), np.full((n, 1), np.inf), np.full((n, 1), -np.inf)
    near = Block(vectors, label, row, True, wanted.positives, *everything)
    near.floor = _exact(near, seed[:3])
    positives = _top(_searched(rows, near, turn), ["anchor"], wanted.positives).toPandas()
    # An anchor with fewer positives has goals that nothing reaches.
    low, high = np.full((n, wanted.positives), np.inf), np.full((n, wanted.positives), -np.inf)
    a, j, p = (positives[c].to_numpy(np.int64) for c in ("anchor", "rank", "score"))
    low[a, j - 1], high[a, j - 1] = -(-wanted.low * p // 100), wanted.high * p // 100
    far = Block(vectors, label, row, False, wanted.negatives, low, high, np.full(low.shape, -np.inf))
    far.floor = _exact(far, seed[:3])
    known = spark.createDataFrame(
        [(int(x), int(ids[x]), int(i), int(k), int(s), int(low[x, k - 1]), int(high[x, k - 1]))
         for x, i, k, s in zip(a, positives["id"], j, p, strict=True)],
        "anchor bigint, anchor_id bigint, positive_id bigint, place int, positive_score bigint, low bigint, high bigint",
    )
    pairs = _searched(rows, far, turn).join(F.broadcast(known), "anchor").filter("score between low and high")
    return _top(pairs, ["anchor", "place"], wanted.negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


_MINED = (
    "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, "
    "negative_score bigint"
)


def mine(
    vectors: DataFrame, is_anchor: Column, wanted: Wanted | None = None, label: Column | None = None,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256,
    block: int = BLOCK,
) -> DataFrame:
    """For each anchor and each of its positives, the best negatives in a window of the positive's score.

    Components become ``floor(scale * x)``; a score is the whole-number inner product with the anchor,
    higher ones first, ties by smaller id, then by the row stored first. Positives are the anchor's first other rows
    of its label; negatives are the rows of other labels with ``low`` to ``high`` percent of the
    positive's score. ``is_anchor`` and ``label`` are expressions over the columns ``id`` and ``label``.

    All rows are compared with all anchors, a block of anchors at a time: a block, its thresholds and its
    positives are all that is sent to the tasks, and a block's results are stored before the next. Rows that take
    no part are named in ``whole_vectors``. Rows that repeat an id are rows of their own. An
    anchor without positives, or with a negative positive score (an empty window), gives no rows.
    """
    spark, wanted = vectors.sparkSession, wanted or Wanted()
    rows = whole_vectors(vectors, id_col, vector_col, label_col, scale)
    if label is not None:
        rows = rows.withColumn("label", label.cast("bigint"))
    first = rows.first()
    if first is None:
        return spark.createDataFrame([], _MINED)
    rows = keep(with_codes(rows, rotation(len(first["vector"]))), "codes")
    seed = _local(rows.orderBy(F.xxhash64("row"), "row").limit(SEED_ROWS))
    blocks = max(1, -(-rows.filter(is_anchor).count() // block))
    dealt = rows.filter(is_anchor).withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    path = scratch_path(spark, "mined")
    spark.createDataFrame([], _MINED).write.parquet(path)
    for number in range(blocks):
        made = _mined(spark, rows, dealt.filter(F.col("block") == number), seed, wanted)
        if made is not None:
            made.write.mode("append").parquet(path)
    return spark.read.schema(_MINED).parquet(path)

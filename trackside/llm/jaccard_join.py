"""Near-duplicate join on word n-grams: rare-first prefixes, then length, position and suffix filters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackside.llm import filters, tables, textscan
from trackside.llm.components import components
from trackside.llm.groups import attach
from trackside.llm.store import ROW, keep, packed, unpacked

#: Cells in which n-grams are counted; their number does not depend on the corpus.
CELLS = 1 << 20
#: Parts into which the suffix filter deals a set.
PARTS = 64
#: Rounds in which every list of a shared n-gram is compared to two of its members only.
STAR_ROUNDS = 1
#: Members of a list that are compared to as many others in one place.
BLOCK = 500
CLASS_BITS = np.uint64(56)


def _shingle_runs(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, n-gram hashes, offsets by text) of runs of texts.

    A text of fewer words than ``size`` has one n-gram of all its words, one without words none.
    """
    for at, data, offsets in textscan.pieces(column):
        w = textscan.words(data, offsets, textscan.BLANK_SEPARATED)
        count = np.diff(w.first)
        grams = textscan.shingles(w.hashes, size)
        number = np.where(count >= size, count - size + 1, np.minimum(count, 1))
        first = np.concatenate([[0], np.cumsum(number)])
        made = np.zeros(first[-1], np.uint64)
        # The n-grams that start at a text's first words and do not reach over its end.
        text = np.repeat(np.arange(len(count)), number)
        place = w.first[text] + np.arange(first[-1]) - first[text]
        long = count[text] >= size
        made[long] = grams[place[long]]
        for short in range(1, size):
            rows = np.flatnonzero(count[text] == short)
            if len(rows):
                made[rows] = textscan.shingles(w.hashes, short)[place[rows]]
        yield at, made, first


def _rarity(docs: DataFrame, size: int) -> np.ndarray:
    """For each cell the class of its count over all documents: an eighth of a power of two."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.int64)
        for batch in batches:
            for _, grams, _ in _shingle_runs(batch.column("text"), size):
                cells += np.bincount((grams >> np.uint64(44)).astype(np.int64), minlength=CELLS)
        for part in tables.segments(np.minimum(cells, 2**32 - 1).astype(np.uint32)):
            columns = [pa.array(part["segment"], pa.int32()), pa.array(part["lane"], pa.int32()),
                       pa.array(part["cells"], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["segment", "lane", "cells"])

    def fold(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.minimum(a.astype(np.uint64) + b, 2**32 - 1).astype(np.uint32)

    counts = tables.whole(docs.select("text").mapInArrow(count, tables.SCHEMA), CELLS, "uint32", fold)
    return (8 * np.log2(1 + counts.astype(np.float64))).astype(np.uint8)


def _codes(grams: np.ndarray, first: np.ndarray, rarity: np.ndarray) -> Iterator[np.ndarray]:
    """Each text's distinct n-grams in the common order: rare before frequent, then by hash.

    A code holds the class of the count above 56 bits of the hash, so sorting numbers gives the order.
    """
    rank = rarity[(grams >> np.uint64(44)).astype(np.int64)].astype(np.uint64)
    codes = (rank << CLASS_BITS) | (grams >> np.uint64(8))
    for i in range(len(first) - 1):
        ordered = np.sort(codes[first[i] : first[i + 1]])
        if len(ordered) > 1:
            fresh = np.ones(len(ordered), bool)
            np.not_equal(ordered[1:], ordered[:-1], out=fresh[1:])
            ordered = ordered[fresh]
        yield ordered


def _prefix_length(n: int, percent: int) -> int:
    """How many first n-grams of a set of ``n`` a partner must share one of."""
    return n - -(-percent * n // 100) + 1 if n else 0


def _signatures(docs: DataFrame, size: int, percent: int, rarity: np.ndarray) -> DataFrame:
    """One row for each document: ``id, row, n, digest, prefix, parts``."""
    shared = docs.sparkSession.sparkContext.broadcast(rarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digests, prefixes, parts = [], [], [], []
            for _, grams, first in _shingle_runs(batch.column("text"), size):
                for codes in _codes(grams, first, shared.value):
                    n.append(len(codes))
                    twice = textscan.mixed(codes), textscan.mixed(~codes)
                    digests.append(b"".join(x.sum(dtype=np.uint64).tobytes() for x in twice))
                    prefixes.append(codes[: _prefix_length(len(codes), percent)].view(np.int64))
                    part = (codes & np.uint64(PARTS - 1)).astype(np.int64)
                    parts.append(np.bincount(part, minlength=PARTS).astype(np.int32))
            lists = [
                pa.ListArray.from_arrays(
                    np.concatenate([[0], np.cumsum([len(x) for x in xs])]).astype(np.int32),
                    pa.array(np.concatenate(xs) if xs else np.zeros(0, kind), type_),
                )
                for xs, kind, type_ in ((prefixes, np.int64, pa.int64()), (parts, np.int32, pa.int32()))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("row"), pa.array(n, pa.int32()),
                 pa.array(digests, pa.binary()), *lists],
                ["id", "row", "n", "digest", "prefix", "parts"],
            )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(
        run, f"id {kind}, row bigint, n int, digest binary, prefix array<bigint>, parts array<int>"
    )


class _Sets:
    """The whole sets of the representatives that some candidate pair needs."""

    def __init__(self, docs: DataFrame, size: int, rarity: np.ndarray) -> None:
        self.docs, self.size = docs, size
        self.rarity = docs.sparkSession.sparkContext.broadcast(rarity)

    def of(self, nodes: DataFrame) -> DataFrame:
        """(rep, codes) for the representatives in ``nodes`` (rep); texts stay where they are."""
        rows = keep(nodes.select("rep", F.col("rep").alias("row")), "needed")
        blocks = filters.blocks_for(rows.count())
        bloom = filters.seen(rows, "row", blocks)
        near = filters.flagged(self.docs, bloom, F.col("row"), blocks, "needed").filter("needed")
        size, rarity = self.size, self.rarity

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                codes = [
                    x.tobytes()
                    for _, grams, first in _shingle_runs(batch.column("text"), size)
                    for x in _codes(grams, first, rarity.value)
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), pa.array(codes, pa.binary())], ["row", "codes"]
                )

        made = near.select("row", "text").mapInArrow(run, "row bigint, codes binary")
        return keep(rows.join(made, "row").select("rep", "codes"), "sets")


def _common(a: pa.Array, b: pa.Array) -> pa.Array:
    """How many codes two sorted sets share, row by row."""
    shared = []
    for x, y in zip(a, b, strict=True):
        x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
        if len(x) > len(y):
            x, y = y, x
        place = np.searchsorted(y, x)
        place[place == len(y)] = 0
        shared.append(int((y[place] == x).sum()) if len(y) else 0)
    return pa.array(shared, pa.int64())


def _least_common(a: Column, b: Column, percent: int) -> Column:
    """The common n-grams that two sets of these sizes need for the similarity."""
    return F.ceil((a + b) * F.lit(percent) / F.lit(100 + percent))


def _verified(pairs: DataFrame, reps: DataFrame, sets: _Sets, percent: int) -> DataFrame:
    """The candidate pairs (a, b), each once, that reach the similarity.

    First the length filter and the suffix filter, from what every representative carries: sets
    are dealt into parts by their hash, and two sets differ at least by the differences of
    their parts' sizes. What is left is counted exactly on the whole sets.
    """
    narrow = reps.select("rep", "n", "parts")
    left = narrow.toDF("a", "n_a", "parts_a")
    right = narrow.toDF("b", "n_b", "parts_b")
    apart = F.aggregate(
        F.zip_with("parts_a", "parts_b", lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x
    )
    need = _least_common(F.col("n_a"), F.col("n_b"), percent)
    near = keep(
        pairs.join(left, "a").join(right, "b")
        .filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
        .filter(apart <= F.col("n_a") + F.col("n_b") - 2 * need)
        .select("a", "b", "n_a", "n_b"),
        "near",
    )
    whole = sets.of(near.select(F.explode(F.array("a", "b")).alias("rep")).distinct())
    both = near.join(whole.toDF("a", "codes_a"), "a").join(whole.toDF("b", "codes_b"), "b")
    common = F.arrow_udf(_common, "bigint")
    counted = both.select("a", "b", "n_a", "n_b", common("codes_a", "codes_b").alias("common"))
    union = F.col("n_a") + F.col("n_b") - F.col("common")
    return keep(counted.filter(F.col("common") * 100 >= union * percent).select("a", "b"), "links")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
    percent: int = 80,
) -> DataFrame:
    """One row for each document: ``id, row, n_shingles, class_id, component_id, kept``.

    Words are what stands between blanks, A-Z lower-cased; a document's set is its distinct runs of
    ``size`` words, one of all its words if it has fewer, empty without words. Two documents
    link when ``100 * |intersection| >= percent * |union|``; an empty set links with nothing.
    ``class_id`` is the smallest id with the same set, ``component_id`` the smallest
    id that links reach, the own one included; ``kept`` marks one row of each component, its
    first. ``docs`` is read once: its ids, texts and ``row``, the number of a row, are stored and read from there.

    n-grams are counted over all documents in a table of fixed size, whose classes put rare
    ones first; any such order gives the same result, a good one short lists. Equal sets are
    one representative. Representatives meet where they share an n-gram of their prefixes, and:

    1. in each list of a shared n-gram every member is paired to two members, one of them that with
       the fewest n-grams of its own; the pairs are verified once, and what links is one component;
    2. then all pairs of a list from different components that pass the length and position filters are
       verified. Pairs within a component cannot change it, so none is needed.

    So a group of near copies costs a few pairs per member instead of all pairs, and no link between
    components is missed: there is no cap. Rows that repeat an id count as documents of
    their own, and take the id's component. A null id comes after the others.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.monotonically_increasing_id().alias("row"),
        F.col(f"`{text_col}`").alias("text"),
    )
    return _judged(keep(rows, "numbered"), size, percent)


def _judged(rows: DataFrame, size: int, percent: int) -> DataFrame:
    """``near_duplicates`` of stored rows ``id, row, text``.

    A scan must not number its rows again: how files are dealt to tasks, and so the numbers, depends on
    settings and on the cores that are registered when it is planned.
    """
    rarity, signed, classes, total = _classes(rows, size, percent)
    links = _links(rows, _representatives(signed, classes, total), size, percent, rarity)
    found = components(links)
    named = classes.select("rep", "class_id").join(
        found.withColumnRenamed("node", "rep"), "rep"
    )
    first = F.struct(F.col("class_id").isNull(), "class_id", "rep")
    smallest = keep(
        named.groupBy("component").agg(
            F.min(first).alias("first"), F.count(F.lit(1)).alias("classes")
        ),
        "smallest",
    )
    joined = attach(
        keep(named, "named"), smallest, "component", "classes", max(1, classes.count())
    ).select("rep", "first")
    verdict = keep(
        classes.join(joined, "rep", "left")
        .withColumn("first", F.coalesce("first", first)).select(
            "digest", "members", "class_id", F.col("first.class_id").alias("component_id"),
            F.col("first.rep").alias("first_row"),
        ),
        "verdicts",
    )
    alone = signed.filter("n = 0").select(
        "id", "row", "n", F.col("id").alias("class_id"), F.col("id").alias("component_id"),
        F.lit(True).alias("kept"),
    )
    grouped = attach(
        signed.filter("n > 0").select("id", "row", "n", "digest"), verdict, "digest", "members", total
    ).select("id", "row", "n", "class_id", "component_id", (F.col("row") == F.col("first_row")).alias("kept"))
    return grouped.unionByName(alone).select(
        "id", "row", F.col("n").cast("bigint").alias("n_shingles"), "class_id", "component_id", "kept"
    )


def _classes(
    rows: DataFrame, size: int, percent: int
) -> tuple[np.ndarray, DataFrame, DataFrame, int]:
    """The classes of counts, the signatures of ``rows``, one row for each set that is not empty, and the number of rows."""
    rarity = _rarity(rows, size)
    signed = keep(_signatures(rows, size, percent, rarity), "signatures")
    total = signed.count()
    order = F.struct(F.col("id").isNull(), "id", "row")
    classes = keep(
        signed.filter("n > 0").groupBy("digest").agg(
            F.min(order).alias("best"), F.count(F.lit(1)).alias("members")
        ).select("digest", "members", F.col("best.row").alias("rep"), F.col("best.id").alias("class_id")),
        "classes",
    )
    return rarity, signed, classes, total


def links(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
    percent: int = 80,
) -> tuple[DataFrame, DataFrame]:
    """The similarity join: (members, pairs), for the links that ``near_duplicates`` speaks of.

    ``members`` has one row for each document: ``id, row, n_shingles, class_row, class_id, n_links``.
    Documents with the same set are one class, named by its first row; ``n_links`` counts the other
    documents that link with this one, those of its class included. ``pairs`` has each two classes that
    link once, ``a, b, id_a, id_b`` with class rows ``a < b``. No pair is left out, and so a group of k
    different near copies costs and gives up to k * (k - 1) / 2 pairs; ``near_duplicates`` needs fewer for its groups.
    """
    rows = keep(
        docs.select(
            F.col(f"`{id_col}`").alias("id"), F.monotonically_increasing_id().alias("row"),
            F.col(f"`{text_col}`").alias("text"),
        ),
        "numbered",
    )
    rarity, signed, classes, total = _classes(rows, size, percent)
    found = _all_links(rows, _representatives(signed, classes, total), size, percent, rarity)
    both = keep(found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b"))), "both")
    degrees = both.groupBy("a").agg(F.count(F.lit(1)).alias("degree"))
    named = keep(
        classes.join(degrees.withColumnRenamed("a", "rep"), "rep").select("rep", "class_id", "members", "degree"),
        "linked",
    )
    ends = max(1, both.count())
    others = attach(
        both, named.select(F.col("rep").alias("b"), "members", "degree"), "b", "degree", ends
    ).groupBy("a").agg(F.sum("members").alias("others"))
    counted = keep(
        classes.join(others.withColumnRenamed("a", "rep"), "rep", "left").select(
            "digest", "members", "class_id", "rep",
            (F.col("members") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        ),
        "counted",
    )
    alone = signed.filter("n = 0").select(
        "id", "row", "n", F.col("row").alias("rep"), F.col("id").alias("class_id"),
        F.lit(0).cast("bigint").alias("n_links"),
    )
    members = attach(
        signed.filter("n > 0").select("id", "row", "n", "digest"), counted, "digest", "members", total
    ).select("id", "row", "n", "rep", "class_id", "n_links").unionByName(alone).select(
        "id", "row", F.col("n").cast("bigint").alias("n_shingles"), F.col("rep").alias("class_row"),
        "class_id", "n_links",
    )

    def end(side: str) -> DataFrame:
        return named.select(F.col("rep").alias(side), F.col("class_id").alias(f"id_{side}"), "degree")

    one = attach(found, end("a"), "a", "degree", ends).drop("degree")
    pairs = attach(one, end("b"), "b", "degree", ends).select("a", "b", "id_a", "id_b")
    return members, pairs


def _representatives(signed: DataFrame, classes: DataFrame, total: int) -> DataFrame:
    """The signatures of the first row of each set, as ``rep``; the others are held back by a filter.

    Most rows are the only one of their set, so the few copies are looked for and the prefixes stay where they are.
    """
    groups = classes.filter("members > 1")
    copies = keep(
        attach(signed.select("row", "digest"), groups, "digest", "members", total)
        .filter("row <> rep").select(F.col("row").alias("copy")),
        "copies",
    )
    blocks = filters.blocks_for(copies.count())
    bloom = filters.seen(copies, "copy", blocks)
    marked = filters.flagged(signed.filter("n > 0"), bloom, F.col("row"), blocks, "maybe")
    unsure = marked.filter("maybe").join(copies, F.col("row") == F.col("copy"), "left_anti")
    return marked.filter("not maybe").unionByName(unsure).drop("maybe").withColumn("rep", F.col("row"))


def survivors(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
    percent: int = 80,
) -> DataFrame:
    """One document of each component, the first, with all its columns; empty sets all stay.

    Rows are stored once with their numbers, as ``docs`` is read once; from there texts stay where they are,
    but for those that a filter of the dropped rows holds back to check.
    """
    rows = keep(packed(docs, __row_id=F.monotonically_increasing_id()), "numbered")
    judged = _judged(
        rows.select(
            F.col(ROW)[id_col].alias("id"), F.col("__row_id").alias("row"), F.col(ROW)[text_col].alias("text")
        ),
        size, percent,
    )
    dropped = keep(judged.filter("not kept").select(F.col("row").alias("__gone")), "dropped")
    blocks = filters.blocks_for(dropped.count())
    bloom = filters.seen(dropped, "__gone", blocks)
    marked = filters.flagged(rows, bloom, F.col("__row_id"), blocks, "__maybe")
    unsure = marked.filter("__maybe").join(dropped, F.col("__row_id") == F.col("__gone"), "left_anti")
    return unpacked(marked.filter("not __maybe").unionByName(unsure))


def _overlap_bound(x: str, y: str) -> Column:
    """The most n-grams that two sets can share, from one they share at a place of each.

    After the shared n-gram at most the shorter rest is common. Before it only n-grams that
    stand in another prefix as well can be, so rare n-grams of one document alone count against it.
    """
    return F.least(f"{x}.before", f"{y}.before") + F.least(
        F.col(f"{x}.n") - F.col(f"{x}.place"), F.col(f"{y}.n") - F.col(f"{y}.place")
    )


def _possible(pairs: DataFrame, percent: int) -> DataFrame:
    """The distinct (a, b) of postings ``x`` and ``y`` that pass the length and position filters."""
    n, m = F.col("x.n"), F.col("y.n")
    need = _least_common(n, m, percent)
    return (
        pairs.filter("x.rep <> y.rep")
        .filter(F.least(n, m) * 100 >= F.greatest(n, m) * percent)
        # The first n-gram in common leaves as many as are needed; later ones only find the pair again.
        .filter((F.col("x.place") <= n - need) & (F.col("y.place") <= m - need))
        .filter(_overlap_bound("x", "y") >= need)
        .select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b"))
        .distinct()
    )


def _shared_postings(reps: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Postings of n-grams that two representatives share at least, each its own component yet.

    With them the lists' sizes, what every representative carries, and the number of postings.
    """
    postings = reps.select("rep", "n", F.posexplode("prefix").alias("place", "token"))
    lists = reps.select(F.explode("prefix").alias("token")).groupBy("token")
    shared = keep(lists.agg(F.count(F.lit(1)).alias("members")).filter("members > 1"), "shared")
    # N-grams of one document alone are most of all; a filter keeps them from moving again.
    blocks = filters.blocks_for(shared.count())
    bloom = filters.seen(shared, "token", blocks)
    postings = keep(
        filters.flagged(postings, bloom, F.col("token"), blocks, "maybe").filter("maybe").drop("maybe"),
        "postings",
    )
    reps = keep(reps.select("rep", "n", "parts"), "representatives")
    total = max(1, shared.agg(F.sum("members")).first()[0] or 1)
    own = Window.partitionBy("rep").orderBy("place")
    live = keep(
        attach(postings, shared, "token", "members", total).select(
            "token", F.col("rep").alias("component"),
            F.struct("rep", "n", "place", (F.row_number().over(own) - 1).alias("before")).alias("x"),
        ),
        "live",
    )
    return live, shared, reps, total


def _all_links(
    rows: DataFrame, reps: DataFrame, size: int, percent: int, rarity: np.ndarray
) -> DataFrame:
    """All pairs (a, b) of representatives that link, each once, ``a`` the smaller row.

    Every pair of a list that passes the length and position filters is verified. A list is dealt into
    blocks of about ``BLOCK`` members; two blocks, or one with itself, are the most that meets in a task.
    """
    live, shared, reps, total = _shared_postings(reps)
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    sized = attach(live, shared.select("token", "members"), "token", "members", total)
    own = F.pmod(F.xxhash64("x.rep"), blocks).cast("int")
    dealt = sized.select("token", "x", own.alias("own"), blocks.alias("blocks")).select(
        "token", "x", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    )
    cells = keep(
        dealt.select(
            "token", "x", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
        ),
        "cells",
    )
    left = cells.filter("own = low")
    right = cells.filter("own = high").withColumnRenamed("x", "y").drop("own")
    met = left.join(right, ["token", "low", "high"]).filter("low < high or x.rep < y.rep")
    return _verified(keep(_possible(met, percent), "pairs"), reps, _Sets(rows, size, rarity), percent)


def _links(
    rows: DataFrame, reps: DataFrame, size: int, percent: int, rarity: np.ndarray
) -> DataFrame:
    """Verified pairs (a, b) of representatives that connect what links connect."""
    sets = _Sets(rows, size, rarity)
    live, _, reps, total = _shared_postings(reps)
    tested = links = None
    for turn in range(STAR_ROUNDS):
        mark = F.xxhash64("x.rep", F.lit(turn))
        # The member with the fewest n-grams of its own before is the likeliest to link with many.
        central = F.struct((F.col("x.place") - F.col("x.before")).alias("alone"), mark.alias("mark"))
        hubs = keep(
            live.groupBy("token").agg(
                F.min(F.struct(central.alias("order"), "x")).alias("one"),
                F.min(F.struct(mark.alias("order"), "x")).alias("two"),
                F.count(F.lit(1)).alias("members"),
            ).select("token", F.array("one.x", "two.x").alias("hubs"), "members"),
            "hubs",
        )
        spokes = attach(live.select("token", "x"), hubs, "token", "members", total)
        found = _possible(
            spokes.select("x", F.col("hubs")[0].alias("y"))
            .unionByName(spokes.select("x", F.col("hubs")[1].alias("y"))), percent
        ).distinct()
        if tested is not None:
            found = found.join(tested, ["a", "b"], "left_anti")
        found = keep(found, "pairs")
        tested = found if tested is None else tested.unionByName(found)
        new = _verified(found, reps, sets, percent)
        links = new if links is None else links.unionByName(new)
        live = _open_lists(live, links)
    other = live.select("token", F.col("component").alias("other"), F.col("x").alias("y"))
    across = live.join(other, "token").filter("component < other")
    across = _possible(across, percent).join(tested, ["a", "b"], "left_anti")
    return links.unionByName(_verified(keep(across, "across"), reps, sets, percent))


def _open_lists(live: DataFrame, links: DataFrame) -> DataFrame:
    """The postings with their component by ``links``, of the lists that hold more than one."""
    found = components(links)
    labels = found.withColumnRenamed("node", "rep").withColumnRenamed("component", "linked")
    labelled = keep(
        live.withColumn("rep", F.col("x.rep")).join(labels, "rep", "left").select(
            "token", F.coalesce("linked", "rep").alias("component"), "x"
        ),
        "labelled",
    )
    open_ = labelled.groupBy("token").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.count(F.lit(1)).alias("entries"),
    ).filter("low < high").select("token", "entries")
    open_ = keep(open_, "open")
    total = max(1, open_.agg(F.sum("entries")).first()[0] or 1)
    return keep(attach(labelled, open_, "token", "entries", total).drop("entries"), "live")

"""Sharding by a k-d tree over document metadata, with leaves of near-equal bytes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackside.llm.groups import attach, numbered
from trackside.llm.store import keep

#: Steps of a dimension's axis, and hashed places at each step that order equal values.
AXIS, TIES = 2**31 - 1, 2**31
#: Bins of one round of the median search.
BINS = 1024


def _placed(rows: DataFrame, dim: str, total: int) -> DataFrame:
    """``rows`` with the texts of ``dim`` replaced by their places among its different texts in order.

    The different texts are sorted by range, so any number of them is placed in many tasks; a
    hot text's rows take its place where they lie.
    """
    texts = keep(
        rows.groupBy(dim).agg(F.count(F.lit(1)).alias("__n")).repartitionByRange(dim)
        .select(dim, "__n", F.spark_partition_id().alias("__range")),
        "texts",
    )
    # One row for each range, and there are no more of these than the session has shuffle partitions.
    before = texts.groupBy("__range").agg(F.count(F.lit(1)).alias("__size")).select(
        "__range", (F.sum("__size").over(Window.orderBy("__range")) - F.col("__size")).alias("__before")
    )
    number = F.row_number().over(Window.partitionBy("__range").orderBy(dim)) - 1
    places = texts.withColumn("__number", number).join(F.broadcast(before), "__range").select(
        dim, "__n", (F.col("__number") + F.col("__before")).cast("double").alias("__at")
    )
    others = [F.col(c) for c in rows.columns if c != dim]
    return attach(rows, places, dim, "__n", total).select(*others, F.col("__at").alias(dim))


def _axes(rows: DataFrame, dims: list[str]) -> DataFrame:
    """Each dimension as whole numbers: the value on a common axis, then a hash for equal values."""
    ends = rows.agg(*[f(d).alias(f"{f.__name__}_{d}") for d in dims for f in (F.min, F.max)]).first()
    tie = F.xxhash64("id", "row").bitwiseAND(TIES - 1)

    def place(d: str) -> Column:
        low, high = ends[f"min_{d}"], ends[f"max_{d}"]
        if low is None or high == low:
            return F.lit(0).cast("bigint")
        at = (F.col(d) - F.lit(low)) / F.lit(high - low) * AXIS
        return F.coalesce(F.floor(at), F.lit(0)).cast("bigint")

    return rows.select(
        "id", "row", "size", "text_crc32", *[(place(d) * TIES + tie).alias(d) for d in dims]
    )


def _widest(rows: DataFrame, dims: list[str]) -> DataFrame:
    """For each node that is still to be split: its bytes and its widest dimension with both ends."""
    found = rows.groupBy("node", "leaves").agg(
        F.sum("size").alias("total"),
        *[f(d).alias(f"{f.__name__}_{d}") for d in dims for f in (F.min, F.max)],
    )
    by_width = F.array_max(F.array(*[
        F.struct(
            # The width counts values only, so dimensions of one value are never chosen for their hash.
            (F.expr(f"max_{d} div {TIES} - min_{d} div {TIES}")).alias("width"),
            F.lit(-i).alias("first"), F.col(f"min_{d}").alias("low"), F.col(f"max_{d}").alias("high"),
        )
        for i, d in enumerate(dims)
    ]))
    return found.select("node", "leaves", "total", by_width.alias("w")).select(
        "node", "leaves", "total", (-F.col("w.first")).alias("dim"), "w.low", "w.high",
    )


def _cuts(rows: DataFrame, dims: list[str]) -> list[tuple[int, int, int]]:
    """The (node, dimension, last key of the left half) of every node, by rounds of histograms.

    Each round cuts the range that holds a node's weighted median into ``BINS`` bins, sums
    the bytes of each where the rows lie, and goes on with the bin in which the target is
    reached, until that bin holds a single key. The driver gets one row per node and round, never more than the tree has leaves.
    """
    spark = rows.sparkSession
    state = {}
    for r in _widest(rows, dims).collect():
        target = r.total * (r.leaves // 2) / r.leaves
        state[r.node] = {"dim": r.dim, "low": r.low, "high": r.high, "below": 0, "target": target}
    done: list[tuple[int, int, int]] = []
    while state:
        values = ", ".join(
            f"({n}L, {s['dim']}, {s['low']}L, {max(1, -(-(s['high'] - s['low'] + 1) // BINS))}L,"
            f" {s['high']}L, {s['target'] - s['below']!r}D)" for n, s in state.items()
        )
        open_nodes = spark.sql(
            f"select * from values {values} as t(node, dim, low, step, high, target)"
        )
        key = F.element_at(F.array(*dims), F.col("dim") + 1)
        bins = (
            rows.join(F.broadcast(open_nodes), "node")
            .filter(key.between(F.col("low"), F.col("high")))
            .groupBy("node", "target", F.floor((key - F.col("low")) / F.col("step")).alias("bin"))
            .agg(F.sum("size").alias("size"), F.min(key).alias("first"), F.max(key).alias("last"))
        )
        up_to = F.sum("size").over(Window.partitionBy("node").orderBy("bin"))
        reached = (
            bins.withColumn("up_to", up_to).filter("up_to >= target")
            .groupBy("node").agg(F.min(F.struct("bin", "size", "up_to", "first", "last")).alias("at"))
        )
        for r in reached.collect():
            s, at = state[r.node], r["at"]
            left = s["below"] + at.up_to - at.size
            if at.first < at.last:
                s |= {"below": left, "low": at.first, "high": at.last}
                continue
            # One key is left: it goes to the side that ends nearer to the target.
            nearer = s["target"] - left < left + at.size - s["target"]
            done.append((r.node, s["dim"], at.first - 1 if nearer else at.first))
            del state[r.node]
    return done


def kd_shards(
    docs: DataFrame, shards: int | None = None, target_bytes: int | None = None,
    id_col: str = "doc_id", text_col: str = "text", dims: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row for each document: ``id, size, text_crc32, shard, slot``.

    The documents are points whose coordinates are their metadata. Starting from one node, each
    node is cut at the weighted median (weights: bytes) of its widest dimension, until every
    leaf stands for one shard; a leaf that stands for an odd number is cut in proportion. ``shards``
    gives their number, or ``target_bytes`` the bytes of a shard. All rows with the value at
    the cut, a hot source for instance, are ordered by a hash of their id and divided too.
    ``dims`` maps names to columns of numbers or texts; by default source, language, length and id, as
    far as the table has them. Texts lie on their axis by order, at equal distances.

    Size is the text's UTF-8 bytes plus one, a null text none. Null metadata count as the
    lowest value. Slots are gapless from 0 in each shard. With fewer rows than shards some
    shards are empty; an empty table gives an empty result.
    """
    text = F.col(f"`{text_col}`")
    size = F.coalesce(F.octet_length(text), F.lit(0)) + 1
    if dims is None:
        dims = {c: F.col(c).cast("string") for c in ("source", "lang") if c in docs.columns}
        dims |= {"length": size.cast("double")}
        if dict(docs.dtypes)[id_col] in ("bigint", "int", "smallint", "tinyint"):
            dims |= {"id_order": F.col(f"`{id_col}`").cast("double")}
    names = [f"d_{i}" for i in range(len(dims))]
    of_texts = [n for n, c in zip(names, dims.values(), strict=True)
                if docs.select(c.alias(n)).schema[n].dataType == T.StringType()]
    points = keep(
        docs.select(
            F.col(f"`{id_col}`").alias("id"), F.monotonically_increasing_id().alias("row"),
            size.cast("bigint").alias("size"),
            F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).alias("text_crc32"),
            *[(F.coalesce(c, F.lit("")) if n in of_texts else c).alias(n)
              for n, c in zip(names, dims.values(), strict=True)],
        ),
        "points",
    )
    whole = points.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).first()
    if shards is None:
        shards = max(1, -(-(whole.bytes or 0) // (target_bytes or 2**30)))
    for n in of_texts:
        points = keep(_placed(points, n, whole.n), "points")
    placed = keep(
        _axes(points, names).withColumns(
            {"node": F.lit(0).cast("bigint"), "leaves": F.lit(shards).cast("bigint")}
        ),
        "axes",
    )
    while whole.n and (cuts := _cuts(placed.filter("leaves > 1"), names)):
        values = ", ".join(f"({n}L, {d}, {k}L)" for n, d, k in cuts)
        table = placed.sparkSession.sql(f"select * from values {values} as t(node, __dim, __key)")
        right = F.element_at(F.array(*names), F.col("__dim") + 1) > F.col("__key")
        half = F.expr("leaves div 2")
        # A node is named by its first shard, so the left half keeps the name.
        placed = keep(
            placed.join(F.broadcast(table), "node", "left").withColumn("__right", right).select(
                "id", "row", "size", "text_crc32", *names,
                F.when(F.col("__right"), F.col("node") + half).otherwise(F.col("node")).alias("node"),
                F.when(F.col("__right"), F.col("leaves") - half)
                .when(F.col("__dim").isNotNull(), half).otherwise(F.col("leaves")).alias("leaves"),
            ),
            "nodes",
        )
    shard = placed.select("id", "row", "size", "text_crc32", F.col("node").cast("int").alias("shard"))
    return numbered(shard, ["shard"], ["id", "row"], "slot", whole.n).drop("row")

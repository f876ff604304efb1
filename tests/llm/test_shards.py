from __future__ import annotations

import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from trackside.llm import kd_shards


def sizes(made, shards):
    rows = made.collect()
    total = [0] * shards
    slots = [[] for _ in range(shards)]
    for r in rows:
        total[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    return rows, total


def test_shards_of_a_hot_source_are_even(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 40).cast("int")).alias("text"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"),
        F.lit("en").alias("lang"),
    )
    for shards in (1, 3, 16):
        rows, total = sizes(kd_shards.kd_shards(docs, shards=shards), shards)
        assert len(rows) == 4000 and sum(total) == sum(i % 40 + 1 for i in range(4000))
        assert max(total) - min(total) <= 2 * 41 * 4
    rows, total = sizes(kd_shards.kd_shards(docs, target_bytes=10_000), 9)
    assert max(total) <= 10_000


def test_odd_documents(odd_docs, no_docs):
    rows, total = sizes(kd_shards.kd_shards(odd_docs, shards=4), 4)
    assert len(rows) == odd_docs.count()
    assert sorted(r.size for r in rows)[:2] == [1, 1]
    assert kd_shards.kd_shards(no_docs, shards=4).count() == 0


def test_equal_documents_are_divided(spark):
    docs = spark.range(64).select(F.lit(5).cast("bigint").alias("doc_id"), F.lit("same").alias("text"))
    _, total = sizes(kd_shards.kd_shards(docs, shards=4), 4)
    assert total == [80] * 4


def axis_keys(values, ties):
    """Numbers or None on the common axis, equal ones told apart by ``ties``."""
    there = [v for v in values if v is not None]
    low, high = min(there), max(there)
    at = [0 if v is None or high == low else int((v - low) / (high - low) * kd_shards.AXIS) for v in values]
    flat = high == low
    return [(0 if flat else a) * kd_shards.TIES + t for a, t in zip(at, ties, strict=True)]


def order_of(texts):
    texts = [t or "" for t in texts]
    places = {t: float(i) for i, t in enumerate(sorted(set(texts), key=str.encode))}
    return [places[t] for t in texts]


def tie(id_, row):
    seed = 42
    for value in (id_, row):
        if value is not None:
            seed = xxhash.xxh64_intdigest(struct.pack("<q", value), seed)
    return seed & (kd_shards.TIES - 1)


def tree(rows, sizes_, keys, node, leaves, made):
    """The shard of every row: split at the weighted median of the widest axis."""
    if leaves == 1 or not rows:
        made.update(dict.fromkeys(rows, node))
        return
    spans = [[k[i] for i in rows] for k in keys]
    widths = [max(s) // kd_shards.TIES - min(s) // kd_shards.TIES for s in spans]
    axis = keys[widths.index(max(widths))]
    target = sum(sizes_[i] for i in rows) * (leaves // 2) / leaves
    weight = {}
    for i in rows:
        weight[axis[i]] = weight.get(axis[i], 0) + sizes_[i]
    below = 0
    for key in sorted(weight):
        if below + weight[key] >= target:
            break
        below += weight[key]
    last = key - 1 if target - below < below + weight[key] - target else key
    half = leaves // 2
    tree([i for i in rows if axis[i] <= last], sizes_, keys, node, half, made)
    tree([i for i in rows if axis[i] > last], sizes_, keys, node + half, leaves - half, made)


@pytest.mark.parametrize("shards", [2, 7, 16])
def test_shards_are_those_of_a_tree_grown_row_by_row(spark, shards):
    sources = ["dataset_0", "dataset_1", "dataset_10", "a", None, "", "é", "datasét"]
    docs = [
        (None if i == 17 else i // 2 if i < 40 else i * i, None if i % 31 == 0 else "wört " * (i * 37 % 101),
         "dataset_2" if i % 3 == 0 else sources[i * 7 % 8], ["en", "de", None][i % 3 * (i % 2)])
        for i in range(600)
    ]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, source string, lang string").coalesce(1)
    sizes_ = [len((t or "").encode()) + 1 for _, t, _, _ in docs]
    ties = [tie(d[0], row) for row, d in enumerate(docs)]
    columns = [
        order_of([d[2] for d in docs]), order_of([d[3] for d in docs]), [float(s) for s in sizes_],
        [None if d[0] is None else float(d[0]) for d in docs],
    ]
    made = {}
    tree(list(range(600)), sizes_, [axis_keys(c, ties) for c in columns], 0, shards, made)
    got = kd_shards.kd_shards(frame, shards=shards).collect()
    want = sorted((str(docs[i][0]), sizes_[i], s) for i, s in made.items())
    assert sorted((str(r.id), r["size"], r.shard) for r in got) == want


def test_texts_with_a_long_common_start_are_split_along(spark):
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"), F.lit("same").alias("text"),
        F.concat(F.lit("https://www.example.org/dataset_"), F.col("id") % 4).alias("source"),
    )
    made = kd_shards.kd_shards(docs, shards=4, dims={"source": F.col("source")})
    held = made.groupBy("shard").agg(F.collect_set(F.col("id") % 4).alias("sources")).collect()
    assert sorted(r.sources for r in held) == [[0], [1], [2], [3]]

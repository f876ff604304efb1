from __future__ import annotations

import random

from pyspark.sql import functions as F

from trackside.llm import filters, groups
from trackside.llm.components import components


def test_filters_miss_nothing(spark):
    keys = spark.range(5000).select((F.col("id") % 4000).cast("string").alias("k"))
    twice = filters.seen_twice(keys, "k", 4)
    flagged = filters.flagged(keys, twice, F.col("k"), 4, "maybe")
    assert flagged.filter("int(k) < 1000 and not maybe").count() == 0
    assert flagged.filter("int(k) >= 1000 and maybe").count() < 600
    once = filters.seen(keys.filter("int(k) < 100"), "k", 4)
    assert filters.flagged(keys, once, F.col("k"), 4, "m").filter("int(k) < 100 and not m").count() == 0
    empty = filters.seen(keys.limit(0), "k", 1)
    assert filters.flagged(keys, empty, F.col("k"), 1, "m").filter("m").count() == 0


def test_filter_size_is_bounded():
    assert filters.blocks_for(0) == 1
    assert filters.blocks_for(10**12) == filters.MAX_BLOCKS


def test_attach_with_and_without_hot_groups(spark):
    rows = spark.range(6000).select("id", F.when(F.col("id") < 4000, 0).otherwise(F.col("id")).alias("k"))
    sizes = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    joined = groups.attach(rows, sizes, "k", "n", 6000)
    assert joined.count() == 6000 and joined.filter("k = 0 and n = 4000").count() == 4000


def test_numbers_are_gapless(spark):
    rows = spark.range(1000).select("id", (F.col("id") % 3 == 0).alias("g"))
    made = groups.numbered(rows, ["g"], ["id"], "slot", 1000, block_rows=50)
    for g, n in ((True, 334), (False, 666)):
        slots = [r.slot for r in made.filter(F.col("g") == g).collect()]
        assert sorted(slots) == list(range(n))


def test_components_are_those_of_union_find(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    links += [(1000 + i, 1001 + i) for i in range(60)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    found = components(spark.createDataFrame(links, "a bigint, b bigint"))
    assert {r.node: r.component for r in found.collect()} == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0

"""Window form and block form must agree, however the groups are cut."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from trackside.operators import (
    delta_to_median,
    group_quantile,
    islands,
    latest_by_key,
    next_row_lookup,
    only_new,
    rank_within,
    running_total,
    sequence_within,
)

SCHEMA = "id bigint, k string, j bigint, pos bigint, v double, flag boolean"


def _rows(n: int = 300, seed: int = 7) -> list[tuple]:
    """A third of the rows in one group, a group with a NULL key, ties, NULL values."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        value = None if rng.random() < 0.1 else rng.randrange(-40, 40) / 8
        rows.append((i, key, rng.choice([1, None]) if key == "c" else 1, rng.randrange(40),
                     value, rng.random() < 0.2))
    return rows


@pytest.fixture(scope="module")
def skewed(spark):
    return spark.createDataFrame(_rows(), SCHEMA).repartition(5).cache()


def _set(df):
    return sorted(df.collect(), key=repr)


KEYS, ORDER = ["k", "j"], ["pos", "id"]


def _positions(size):
    return F.floor(F.col("pos") / size)


def _values(size):
    return F.floor(F.col("v") / size)


def _falling(size):
    """Blocks that rise as the value falls, NULL last."""
    return F.coalesce(-F.floor(F.col("v") / size), F.lit(10**9))


@pytest.mark.parametrize("size", [1, 7, 1000])
@pytest.mark.parametrize(
    ("build", "block"),
    [
        (lambda df, block: running_total(df, "v", KEYS, ORDER, "out", block), _positions),
        (lambda df, block: running_total(df, F.col("id") * 0.1, KEYS, ORDER, "out", block), _positions),
        (lambda df, block: running_total(
            df, F.col("id").cast("decimal(15,2)"), KEYS, ORDER, "out", block), _positions),
        (lambda df, block: running_total(
            df, F.col("v") * 2, ["k"], [F.col("pos").desc(), "id"], "out", block),
         lambda size: -_positions(size)),
        (lambda df, block: sequence_within(df, KEYS, ORDER, "out", block), _positions),
        (lambda df, block: islands(df, F.col("flag"), KEYS, ORDER, "out", block), _positions),
        (lambda df, block: rank_within(df, KEYS, "v", "out", block), _falling),
        (lambda df, block: delta_to_median(df, "v", KEYS, "out", block=block), _values),
        (lambda df, block: delta_to_median(df, "v", ["k"], "out", p=0.3, block=block), _values),
        (lambda df, block: group_quantile(df, "v", KEYS, "out", 0.5, block), _values),
        (lambda df, block: group_quantile(df, "v", KEYS, "out", 1.0, block), _values),
    ],
)
def test_block_form_equals_window_form(skewed, build, block, size):
    plain, cut = build(skewed, None), build(skewed, block(size))
    assert cut.dtypes == plain.dtypes
    assert _set(cut) == _set(plain)


def test_types_and_values_are_those_of_exact_sums(spark):
    df = spark.range(1, 41).select("id", (F.col("id") * 0.1).alias("x"),
                                   F.col("id").cast("decimal(15,2)").alias("d"))
    for block in (None, F.floor(F.col("id") / 3)):
        real = running_total(df, "x", [], ["id"], "out", block)
        assert real.schema["out"].dataType.simpleString() == "double"
        assert [r.out for r in real.orderBy("id").collect()] == [
            round(n * (n + 1) / 20, 10) for n in range(1, 41)
        ]
        money = running_total(df, "d", [], ["id"], "out", block)
        assert money.schema["out"].dataType.simpleString() == "decimal(25,2)"


def test_quantile_is_that_of_the_percentile_function(skewed):
    for p in (0.0, 0.25, 0.5, 0.9):
        own = {tuple(r)[:2]: r.out for r in group_quantile(skewed, "v", KEYS, "out", p, _values(5)).collect()}
        theirs = skewed.groupBy(*KEYS).agg(F.percentile("v", p).alias("out"))
        assert own == {tuple(r)[:2]: r.out for r in theirs.collect()}


def test_running_total_against_plain_python(skewed):
    expected, totals = {}, {}
    for row in sorted(skewed.collect(), key=lambda r: (r.pos, r.id)):
        key = (row.k, row.j)
        if row.v is not None:
            totals[key] = totals.get(key, 0.0) + row.v
        expected[row.id] = totals.get(key)
    result = running_total(skewed, "v", KEYS, ORDER, "out", _positions(7)).collect()
    assert {row.id: row.out for row in result} == expected


def test_copies_of_one_row_are_all_kept_and_counted(spark):
    copies = spark.createDataFrame([("x", 1)] * 50 + [("y", 1)], "k string, pos bigint")
    numbers = sequence_within(copies, ["k"], ["pos"], "n", F.floor(F.col("pos") / 5))
    assert sorted(r.n for r in numbers.filter("k = 'x'").collect()) == list(range(1, 51))


def test_latest_by_key_is_idempotent_and_breaks_ties(spark):
    rows = [("a", 1, 5, "x"), ("a", 1, 5, "y"), ("a", 1, 4, "z"), (None, 1, 1, "n"), ("b", 2, None, "q")]
    df = spark.createDataFrame(rows, "k string, j int, at int, tie string")
    once = latest_by_key(df, ["k", "j"], ["at"], ["tie"])
    assert {(r.k, r.tie) for r in once.collect()} == {("a", "y"), (None, "n"), ("b", "q")}
    assert _set(latest_by_key(once, ["k", "j"], ["at"], ["tie"])) == _set(once)


def test_next_row_lookup_leaves_a_gap_empty_where_lead_would_not(spark):
    laps = spark.createDataFrame([("s", 1, "A"), ("s", 2, "B"), ("s", 4, "D")], "s string, lap bigint, c string")
    found = {r.lap: r.nxt for r in next_row_lookup(laps, laps, ["s"], "lap", {"c": "nxt"}).collect()}
    assert found == {1: "B", 2: None, 4: None}
    lead = laps.withColumn("nxt", F.lead("c").over(Window.partitionBy("s").orderBy("lap")))
    assert {r.lap: r.nxt for r in lead.collect()}[2] == "D"


def test_only_new_keeps_rows_without_a_key(spark):
    incoming = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    existing = spark.createDataFrame([("a",), ("c",), (None,)], "k string")
    assert {r.k for r in only_new(incoming, existing, ["k"]).collect()} == {"b", None}

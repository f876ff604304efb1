"""Operators for groups of any size against the window form: every setting gives the same rows."""

from __future__ import annotations

import contextlib
import io
import math
import random

import pytest
from pyspark.sql import functions as F

from trackside.operators import hot, ordered

SCHEMA = "id bigint, k string, j bigint, pos bigint, v double, flag boolean"
KEYS, ORDER = ["k", "j"], ["pos", "id"]


def _rows(n=600, seed=11):
    """A third of the rows in one group, a NULL key, ties in order and value, NULL values."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        value = None if rng.random() < 0.1 else rng.choice([rng.randrange(-40, 40) / 8, 1e12, rng.random()])
        rows.append((i, key, rng.choice([1, None]) if key == "c" else 1, rng.randrange(60), value, rng.random() < 0.2))
    return rows


@pytest.fixture(scope="module")
def skewed(spark):
    return spark.createDataFrame(_rows(), SCHEMA).repartition(5).cache()


def _set(df):
    return sorted(map(repr, df.collect()))


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize("hot_rows", [1, 40, 10**6])
def test_totals_sequences_and_islands(skewed, hot_rows):
    for value, keys in (("v", KEYS), (F.col("id") * 0.1, ["k"]), (F.col("id").cast("decimal(15,2)"), [])):
        got = hot.running_total(skewed, value, keys, ORDER, "out", hot_rows)
        expected = ordered.running_total(skewed, value, keys, ORDER, "out")
        assert got.dtypes == expected.dtypes and _set(got) == _set(expected)
    assert _set(hot.sequence_within(skewed, KEYS, ORDER, "out", hot_rows)) == _set(
        ordered.sequence_within(skewed, KEYS, ORDER, "out"))
    assert _set(hot.islands(skewed, F.col("flag"), KEYS, ORDER, "out", hot_rows)) == _set(
        ordered.islands(skewed, F.col("flag"), KEYS, ORDER, "out"))


@pytest.mark.parametrize(("bars", "few"), [(3, 3), (256, 0), (256, 10_000)])
def test_medians(skewed, monkeypatch, bars, few):
    monkeypatch.setattr(hot, "BARS", bars)
    monkeypatch.setattr(hot, "FEW", few)
    for p, hot_rows in ((0.5, 1), (0.3, 150)):
        got = hot.delta_to_median(skewed, "v", KEYS, "out", p, hot_rows)
        expected = ordered.delta_to_median(skewed, "v", KEYS, "out", p)
        assert got.dtypes == expected.dtypes and _set(got) == _set(expected)


@pytest.mark.parametrize("values", [
    [1.0], [None, None], [1.0, 2.0], [1.0, 1.0, 1.0, 9.0], [-math.inf, 1.0, 2.0, math.inf], [math.inf, math.inf, 1.0],
    [5e-324, 0.0, 1e308, -1e308], [float(2**53), float(2**53) + 2, 1.0, 3.0], [0.1 * 2.0**n for n in range(-60, 60)],
])
def test_medians_of_odd_values(spark, monkeypatch, values):
    monkeypatch.setattr(hot, "FEW", 0)
    df = spark.createDataFrame([("x", i, v) for i, v in enumerate(values)], "k string, id int, v double")
    got = hot.delta_to_median(df, "v", ["k"], "out", 0.5, 0)
    assert _set(got) == _set(ordered.delta_to_median(df, "v", ["k"], "out"))


def test_whole_numbers_and_empty_tables(spark):
    df = spark.range(1000).selectExpr("id", "id % 2 as k", "id * id as v")
    for hot_rows in (10, 10**6):
        got = hot.delta_to_median(df, "v", ["k"], "out", 0.5, hot_rows)
        expected = ordered.delta_to_median(df, "v", ["k"], "out")
        assert sorted((r.id, float(r.out)) for r in got.collect()) == sorted((r.id, float(r.out)) for r in expected.collect())
    none = df.limit(0)
    assert hot.delta_to_median(none, "v", ["k"], "out").count() == 0
    assert hot.running_total(none, "v", ["k"], ["id"], "out").count() == 0


def test_a_hot_group_is_cut_into_runs_of_about_the_limit(spark):
    df = spark.range(30_000).selectExpr("id", "if(id % 3 = 0, -1, id % 500) as k", "cast(hash(id) as bigint) as at")
    parts = hot.split(df, ["k"], 1000)
    assert parts.any_hot and [r[0] for r in parts.hot_keys.select("k").collect()] == [-1]
    bounds = hot._bounds(parts, ["at", "id"])
    assert 8 <= len(bounds.first()["_bounds"]) <= 10
    at = F.struct("at", "id")
    runs = parts.hot(bounds).groupBy(F.size(F.filter("_bounds", lambda b: b <= at))).count().collect()
    assert max(r["count"] for r in runs) < 2500


@pytest.mark.parametrize("hot_rows", [100, 10**6])
def test_the_input_is_made_once(spark, hot_rows):
    """An accumulator counts the rows that the input hands out, whatever reads the result."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(900).selectExpr("id", "if(id % 3 = 0, 'hot', 'k' || id % 50) as k", "id * 0.5D as v")
    df = df.mapInArrow(counted, df.schema)
    for build in (lambda: hot.delta_to_median(df, "v", ["k"], "out", 0.5, hot_rows),
                  lambda: hot.running_total(df, "v", ["k"], ["id"], "out", hot_rows)):
        seen.value = 0
        made = build()
        assert made.count() == 900 and made.filter("out > 1").count() > 0
        assert seen.value == 900


def test_hot_rows_do_not_shuffle_for_their_median(spark):
    df = spark.range(900).selectExpr("id", "'hot' as k", "id * 0.5D as v")
    text = plan(hot.delta_to_median(df, "v", ["k"], "out", 0.5, 10).filter("k = 'hot'"))
    # The ordinary side has the only hash exchange; the hot side joins the medians where its rows are.
    assert text.count("hashpartitioning(k") == 1
    assert "SortMergeJoin" not in text and "CartesianProduct" not in text

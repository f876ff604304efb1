from __future__ import annotations

import pytest

from trackside.operators import quality
from trackside.sources import loading


def test_gate_raises_with_an_example_and_passes_on_nothing(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "session_id string")
    with pytest.raises(quality.QualityError, match="'session_id': 'a'"):
        quality.gate("unique", quality.unique(df, "session_id"))
    quality.gate("unique", quality.unique(df.distinct(), "session_id"))


def test_null_is_an_accepted_value_but_not_not_null(spark):
    df = spark.createDataFrame([("R",), ("Q",), (None,), ("S",)], "t string")
    assert [r[:] for r in quality.accepted_values(df, "t", ["R", "Q"]).collect()] == [("S", 1)]
    assert [r[:] for r in quality.not_null(df, ["t"]).collect()] == [("t", 1)]
    assert quality.not_null(df.filter("t is not null"), ["t"]).count() == 0


def test_missing_rounds_are_found_and_stop_the_run(spark):
    rounds = spark.createDataFrame([(2023, 2)], "season bigint, rounds bigint")
    loaded = spark.createDataFrame([(2023, 1, "R"), (2023, 1, "Q"), (2023, 2, "Q")], "season bigint, round_number bigint, session_type string")
    missing = quality.missing_rounds(loading.expected_grid(rounds), loaded)
    assert [r.session_id for r in missing.collect()] == ["2023_2_R"]
    with pytest.raises(quality.QualityError):
        quality.gate("completeness", missing)


def test_reconciliation_with_sprint_points(spark):
    key = "season bigint, abbreviation string, "
    computed = spark.createDataFrame([(2024, "A", 399.0), (2024, "B", 10.0)], key + "final_points double")
    sprints = spark.createDataFrame([(2024, "A", 38.0)], key + "adjustment_points double")
    official = spark.createDataFrame([(2024, "A", 437.0), (2024, "B", 12.0), (2024, "C", 1.0)], key + "official_points double")
    found = quality.reconcile_points(computed, official, sprints)
    assert {r.abbreviation: r.difference for r in found.collect()} == {"A": 0.0, "B": 2.0, "C": 1.0}


def test_null_points_count_only_in_races(spark):
    results = spark.createDataFrame([("2024_1_R", None), ("2024_1_R", 5.0), ("2024_1_Q", None)], "session_id string, points double")
    sessions = spark.createDataFrame([("2024_1_R", 2024, 1, "R"), ("2024_1_Q", 2024, 1, "Q")], "session_id string, season bigint, round_number bigint, session_type string")
    assert [r[:] for r in quality.null_race_points(results, sessions).collect()] == [("2024_1_R", 2024, 1, 1)]


def test_orphans_and_coverage(spark):
    sessions = spark.createDataFrame([("a",)], "session_id string")
    child = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "session_id string")
    assert [r[:] for r in quality.orphans(child, sessions).collect()] == [("b", 2)]
    one, two = spark.createDataFrame([(1,), (2,)], "season int"), spark.createDataFrame([(2,), (2,)], "season int")
    covered = quality.season_coverage({"one": one, "two": two})
    assert {r.season: (r.in_one, r.in_two) for r in covered.collect()} == {1: (True, False), 2: (True, True)}

"""Plans that have to keep their shape at scale."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from trackside import fixtures
from trackside.operators import latest_by_key, next_row_lookup
from trackside.plans import marts, reports
from trackside.session import scratch_path
from trackside.sources import landing

MARTS = ["race_results", "qualifying_results", "driver_standings", "final_standings",
         "constructor_standings", "lap_times", "pit_stops", "tyre_strategy",
         "season_calendar", "circuit_stats"]


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture(scope="module")
def made(spark, small_dir):
    return fixtures.pipeline(fixtures.RawFeeds(spark, small_dir))


def test_latest_row_is_limited_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 7 as k", "id as at", "id as tie")
    text = plan(latest_by_key(df, ["k"], ["at"], ["tie"]))
    assert text.index("WindowGroupLimit") and text.count("+- WindowGroupLimit") == 2


@pytest.mark.parametrize("name", MARTS)
def test_no_cross_join_and_no_python_in_the_marts(made, name):
    text = plan(getattr(made, name))
    for operator in ("CartesianProduct", "NestedLoop", "PythonUDF", "ArrowEval", "MapInPandas"):
        assert operator not in text


@pytest.mark.parametrize("name", MARTS)
def test_no_job_runs_while_a_mart_is_built(spark, small_dir, name):
    group = f"build-{name}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        getattr(fixtures.pipeline(fixtures.RawFeeds(spark, small_dir)), name)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_standings_and_pace_read_their_mart_once(spark, made):
    race = landing.write_mart(made.race_results, scratch_path(spark, "race"))
    laps = landing.write_mart(made.lap_times, scratch_path(spark, "laps"))
    gaps = plan(reports.gap_to_leader(marts.driver_totals(race)))
    assert gaps.count("Location: InMemoryFileIndex") == 1
    assert plan(marts.driver_standings(race)).count("Location: InMemoryFileIndex") == 1
    assert "percentile" not in plan(reports.clean_pace(laps))


def test_windows_are_always_partitioned(made):
    for name in MARTS:
        assert "SinglePartition" not in plan(getattr(made, name))


def test_season_slice_reads_one_directory_and_pushes_the_driver_down(spark, made):
    stored = landing.write_clustered(made.lap_times, scratch_path(spark, "lap_times"))
    text = plan(reports.lap_times_slice(stored, 1996, "D3", 2))
    assert re.search(r"PartitionFilters: \[.*season.* = 1996", text)
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "EqualTo(abbreviation,D3)" in pushed and "EqualTo(round_number,2)" in pushed


def test_report_reads_only_the_columns_it_needs(spark, made):
    stored = landing.write_clustered(made.lap_times, scratch_path(spark, "lap_times"))
    text = plan(reports.degradation(stored, 1996))
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "compound", "tyre_life", "is_clean_lap", "delta_to_driver_median",
    }


def test_clustered_files_cover_narrow_ranges(spark, made):
    path = scratch_path(spark, "lap_times")
    wide = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stored = landing.write_clustered(made.lap_times, path)
        files = stored.groupBy(F.input_file_name().alias("f")).agg(
            F.count_distinct("season").alias("seasons"), F.count_distinct("abbreviation").alias("drivers")
        ).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", wide)
    assert all(f.seasons == 1 for f in files) and len(files) > 7


def test_lookup_stays_an_equi_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(10).selectExpr("id % 2 as k", "id as lap", "id as v")
        text = plan(next_row_lookup(df, df, ["k"], "lap", {"v": "nxt"}))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin LeftOuter" in text


def test_marts_work_without_any_broadcast(spark, made):
    """Plans must not depend on a side being small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        pits = marts.pit_stops(made.stg_pit_stops, made.stg_sessions, made.stg_laps)
        text = plan(pits)
        assert "Broadcast" not in text and pits.count() == 201
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_no_fixed_broadcasts_or_driver_side_loops_in_the_library():
    from pathlib import Path

    for file in Path(entry.__file__).parent.joinpath("trackside").rglob("*.py"):
        if file.parent.name == "llm":
            continue
        text = file.read_text()
        for word in ("broadcast(", "localCheckpoint(", "toPandas(", "crossJoin(", "coalesce(1)", ".rdd"):
            assert word not in text, (file, word)

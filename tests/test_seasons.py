"""Marts by season, checks taken while writing, and schema drift."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from trackside.operators import quality
from trackside.operators.watch import Watch
from trackside.plans import seasons
from trackside.plans.pipeline import MARTS, Pipeline
from trackside.schemas import RAW, SOURCE
from trackside.session import scratch_path
from trackside.sources import drift, landing, loads, storage

STAMP, AS_OF = datetime(2025, 1, 1), date(2025, 1, 1)


def _load(spark, raw, ids, laps=3, own_season=None):
    """A load of races with two drivers each and ``laps`` laps a driver."""
    rows = {feed: [] for feed in RAW}
    for sid in ids:
        season, number, kind = sid.split("_")
        rows["sessions"].append((sid, own_season or int(season), int(number), "C", "L", "K", kind, date(int(season), 5, 1), STAMP))
        for d in (1, 2):
            rows["results"].append((sid, str(d), f"D{d}", f"N{d}", f"T{d}", float(d), float(3 - d), 10.0 * d, "Finished", None, STAMP))
            for lap in range(1, laps + 1):
                rows["laps"].append((sid, str(d), f"D{d}", lap, 90.0 + d + lap, None, None, None, "SOFT", float(lap), False, None, None, "1", STAMP))
    frames = {
        feed: storage.by_session(spark.createDataFrame(rows[feed], RAW[feed]), RAW[feed], F.lit(ids[0]) if feed in ("drivers", "circuits") else F.col("session_id"))
        for feed in RAW
    }
    return loads.commit(spark, raw, frames, spark.createDataFrame([(i,) for i in ids], "session_id string"))


def _rows(df):
    return sorted(map(repr, df.collect()))


SOME = ("final_standings", "lap_times", "season_calendar", "circuit_stats")


def _same_as_full_build(spark, raw, root, names=SOME):
    stored, full = seasons.SeasonMarts(spark, root), Pipeline.over(spark, raw, as_of=AS_OF)
    for name in names:
        assert stored.read(name).schema.simpleString() == getattr(full, name).schema.simpleString(), name
        assert _rows(stored.read(name)) == _rows(getattr(full, name)), name


def test_a_load_rewrites_its_season_alone(spark):
    raw, root = scratch_path(spark, "raw"), scratch_path(spark, "seasons")
    assert seasons.SeasonMarts(spark, root).read("lap_times").count() == 0
    _load(spark, raw, ["2023_1_R", "2023_1_Q", "2024_1_R", "2024_2_R"])
    assert seasons.refresh(spark, raw, root, AS_OF) == [2023, 2024]
    before = seasons.SeasonMarts(spark, root)
    _load(spark, raw, ["2024_2_R"], laps=1)
    assert seasons.refresh(spark, raw, root, AS_OF) == [2024]
    assert storage.children(spark, f"{root}/lap_times/version={seasons.state(spark, root).name}") == ["season=2024"]
    _same_as_full_build(spark, raw, root, MARTS)
    assert before.read("lap_times").count() == 18 and seasons.SeasonMarts(spark, root).read("lap_times").count() == 14
    # Nothing new: no season is made again, the calendar follows the date.
    assert seasons.refresh(spark, raw, root, date(2020, 1, 1)) == []
    calendar = seasons.SeasonMarts(spark, root).read("season_calendar")
    assert {r.race_status for r in calendar.collect()} == {"upcoming"}


def test_a_season_that_was_emptied(spark):
    raw, root = scratch_path(spark, "raw"), scratch_path(spark, "seasons")
    _load(spark, raw, ["2023_1_R", "2024_1_R"])
    seasons.refresh(spark, raw, root, AS_OF)
    frames = {feed: storage.by_session(spark.createDataFrame([], RAW[feed]), RAW[feed], F.lit("2024_1_R")) for feed in RAW}
    loads.commit(spark, raw, frames, spark.createDataFrame([("2024_1_R",)], "session_id string"))
    assert seasons.refresh(spark, raw, root, AS_OF) == [2024]
    _same_as_full_build(spark, raw, root)


def test_a_refresh_that_broke_off_changes_nothing(spark, monkeypatch):
    raw, root = scratch_path(spark, "raw"), scratch_path(spark, "seasons")
    _load(spark, raw, ["2023_1_R", "2024_1_R"])
    seasons.refresh(spark, raw, root, AS_OF)
    _load(spark, raw, ["2024_1_R"], laps=1)
    broken = lambda *_: (_ for _ in ()).throw(RuntimeError("lost"))
    with monkeypatch.context() as patch:
        patch.setattr(seasons.marts, "circuit_stats", broken)
        with pytest.raises(RuntimeError, match="lost"):
            seasons.refresh(spark, raw, root, AS_OF)
    assert seasons.SeasonMarts(spark, root).read("lap_times").count() == 12
    assert seasons.refresh(spark, raw, root, AS_OF) == [2024]
    # The half-written version goes, what the newest state names stays.
    assert len(seasons.vacuum(spark, root, keep=1)) == 1
    _same_as_full_build(spark, raw, root)


def test_sessions_of_another_season_raise(spark):
    raw, root = scratch_path(spark, "raw"), scratch_path(spark, "seasons")
    _load(spark, raw, ["2024_1_R"], own_season=2023)
    with pytest.raises(quality.QualityError, match="season as in session_id"):
        seasons.refresh(spark, raw, root, AS_OF)


def _jobs(spark, group, run):
    spark.sparkContext.setJobGroup(group, "counted")
    result = run()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_checks_ride_on_the_write(spark):
    rows = spark.createDataFrame(
        [("a", 1, "R"), (None, 2, "Q"), ("c", None, "X"), ("d", 2, None)], "id string, season bigint, kind string"
    )
    plain, watched = scratch_path(spark, "plain"), scratch_path(spark, "watched")
    watch = Watch(["id", "season"], {"kind": ["Q", "R"]}, "season")
    _, without = _jobs(spark, "plain", lambda: landing.write_mart(rows, plain))
    stored, with_checks = _jobs(spark, "watched", lambda: landing.write_mart(rows, watched, watch))
    assert with_checks == without
    assert watch.rows == 4 and watch.seasons == [1, 2]
    assert _rows(watch.nulls(spark)) == _rows(quality.not_null(rows, ["id", "season"]))
    assert _rows(watch.others(stored, "kind")) == _rows(quality.accepted_values(rows, "kind", ["Q", "R"]))


def test_watching_no_rows(spark):
    watch = Watch(["season"], {"season": ["1"]}, "season")
    stored = landing.write_mart(spark.createDataFrame([], "season bigint"), scratch_path(spark, "none"), watch)
    assert watch.rows == 0 and watch.seasons == [] and watch.nulls(spark).count() == 0
    assert watch.others(stored, "season").count() == 0


def test_missing_points_are_looked_up_in_what_is_stored(spark):
    raw, kept = scratch_path(spark, "raw"), scratch_path(spark, "kept")
    _load(spark, raw, ["2023_1_R", "2024_1_R"])
    tables = landing.read_raw_tables(spark, raw)
    lost = F.when(F.col("session_id") != "2024_1_R", F.col("points"))
    made = Pipeline({**tables, "results": tables["results"].withColumn("points", lost)}).keep(kept, "race_results")
    found = made.watched["race_results"].without_points(made.race_results)
    assert _rows(found) == _rows(quality.null_race_points(made.stg_results, made.stg_sessions)) != []


def test_drift_names_file_and_column(spark):
    path = scratch_path(spark, "landing")
    good = spark.createDataFrame([], SOURCE["schedule"])
    good.drop("season").write.parquet(f"{path}/season=2023")
    bad = spark.createDataFrame([(2024, 1, "2024-05-01")], "season int, Round bigint, eventdate string")
    bad.coalesce(1).write.parquet(f"{path}/other place")
    found = drift.schema_drift(spark, path, SOURCE["schedule"])
    assert all("other" in r.file and r.rows == 1 for r in found.collect())
    assert sorted(tuple(r)[2:] for r in found.collect()) == [
        ("EventDate", "type", "timestamp_ntz", "string"), ("Round", "undeclared", None, "bigint"),
        ("RoundNumber", "missing", "bigint", None), ("season", "type", "bigint", "int"),
    ]


def test_a_file_without_footer_is_named(spark, tmp_path):
    (tmp_path / "x.parquet").write_bytes(b"not a parquet file")
    found = drift.schema_drift(spark, str(tmp_path), SOURCE["schedule"]).collect()
    assert [(r.problem, r.rows, r.column_name) for r in found] == [("unreadable", None, None)]
    assert found[0].file.endswith("x.parquet")

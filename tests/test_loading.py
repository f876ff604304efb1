"""Landing, appending, worklists and the set-wise load."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from trackside import fixtures, session
from trackside.operators import quality
from trackside.plans.pipeline import MARTS, Pipeline
from trackside.schemas import RAW, SEASON_ROUNDS, SOURCE
from trackside.session import scratch_path
from trackside.sources import landing, loading, loads, storage

STAMP = datetime(2002, 1, 1)


@pytest.fixture(scope="module")
def feeds(spark, small_dir):
    """Source feeds of one scale factor, written once."""
    root = scratch_path(spark, "feeds")
    made = fixtures.Sources(spark, small_dir)
    stored = {}
    for name in ("events", "results", "laps", "weather"):
        stored[name] = landing.write_mart(getattr(made, name), f"{root}/{name}")
    return stored


def _counts(spark, root):
    return {feed: landing.read_raw(spark, root, feed).count() for feed in RAW}


def test_sessions_named_without_rows_lose_what_they_had(spark):
    root = scratch_path(spark, "raw")
    stops = [(f"2024_{n}_R", "1", "D1", 1, n, 2.0, STAMP) for n in (1, 2, 3)]
    landing.replace_sessions(spark.createDataFrame(stops, RAW["pit_stops"]), root, "pit_stops")
    wanted = spark.createDataFrame([("2024_1_R",), ("2024_2_R",), (None,)], "session_id string")
    landing.replace_sessions(spark.createDataFrame(stops[:1], RAW["pit_stops"]), root, "pit_stops", sessions=wanted)
    assert sorted(r.session_id for r in landing.read_raw(spark, root, "pit_stops").collect()) == ["2024_1_R", "2024_3_R"]


def test_create_leaves_an_existing_table_alone(spark):
    path = scratch_path(spark, "t")
    landing.create_table(spark, path, RAW["circuits"])
    assert landing.read_table(spark, path, RAW["circuits"]).count() == 0
    rows = spark.createDataFrame([("k", "n", "c", "l", STAMP)], RAW["circuits"])
    landing.append(rows, path, RAW["circuits"])
    landing.create_table(spark, path, RAW["circuits"])
    stored = landing.read_table(spark, path, RAW["circuits"])
    assert stored.count() == 1 and stored.schema == RAW["circuits"]


def test_append_matches_by_name(spark):
    path = scratch_path(spark, "t")
    rows = spark.createDataFrame([(STAMP, "l", "c", "n", "k")], "loaded_at timestamp, location string, country string, circuit_name string, circuit_key string")
    landing.append(rows, path, RAW["circuits"])
    assert landing.read_table(spark, path, RAW["circuits"]).first()[:4] == ("k", "n", "c", "l")


def test_landing_a_session_again_replaces_only_it(spark):
    path = scratch_path(spark, "t")
    schema = "session_id string, v int"
    landing.land_by_session(spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], schema), path)
    landing.land_by_session(spark.createDataFrame([("a", 9)], schema), path)
    stored = spark.read.schema("v int, session_id string").parquet(path)
    assert sorted((r.session_id, r.v) for r in stored.collect()) == [("a", 9), ("b", 3)]


def test_loading_twice_is_loading_once(spark, feeds):
    root = scratch_path(spark, "raw")
    loading.load_sessions(spark, feeds, root, STAMP)
    once = _counts(spark, root)
    assert once["sessions"] == 166 and once["laps"] == 1000 and once["pit_stops"] > 0
    loading.load_sessions(spark, feeds, root, STAMP)
    assert _counts(spark, root) == once
    assert {r[0] for r in landing.read_raw(spark, root, "sessions").select("loaded_at").distinct().collect()} == {STAMP}


def _rows(spark, root, feed):
    return sorted(map(repr, landing.read_raw(spark, root, feed).collect()))


def test_a_load_that_broke_off_changes_nothing_and_is_run_again(spark, feeds):
    whole, broken = scratch_path(spark, "raw"), scratch_path(spark, "raw")
    loading.load_sessions(spark, feeds, whole, STAMP)
    lost = feeds["weather"].withColumn("AirTemp", F.expr("double(raise_error('executor lost'))"))
    early = {**feeds, "events": feeds["events"].filter("season < 1997")}
    loading.load_sessions(spark, early, broken, STAMP)
    before = {feed: _rows(spark, broken, feed) for feed in RAW}
    with pytest.raises(Exception, match="executor lost"):
        loading.load_sessions(spark, {**feeds, "weather": lost}, broken, STAMP)
    assert {feed: _rows(spark, broken, feed) for feed in RAW} == before
    loading.load_sessions(spark, feeds, broken, STAMP)
    for feed in RAW:
        assert _rows(spark, broken, feed) == _rows(spark, whole, feed)
    # What the broken load has left is found and deleted, and nothing else.
    assert len(loads.vacuum(spark, broken)) == 1
    for feed in RAW:
        assert _rows(spark, broken, feed) == _rows(spark, whole, feed)


def _one_session(laps, session="2024_2_R", results=1):
    """Feeds of one session with so many laps, some of them with a stop, and results."""
    lap = [(session, "1", "VER", float(n), 90, 1, 1, 1, "SOFT", 1.0, True, 5 if n % 5 == 0 else None, None, "1", None)
           for n in range(1, laps + 1)]
    result = [(session, 2024, str(n), f"D{n}", "N", "T", "C", "1", "1", 1.0, "Finished", "t", None) for n in range(results)]
    event = [(2024, 2, "R", "C", "L", "E", datetime(2024, 3, 9), None)]
    return event, result, lap


def _feeds_of(spark, *args, **options):
    event, result, lap = _one_session(*args, **options)
    return {
        "events": spark.createDataFrame(event, SOURCE["events"]),
        "results": spark.createDataFrame(result, SOURCE["results"]),
        "laps": spark.createDataFrame(lap, SOURCE["laps"]),
        "weather": spark.createDataFrame([], SOURCE["weather"]),
    }


def test_a_feed_that_is_empty_now_keeps_none_of_its_old_rows(spark):
    root = scratch_path(spark, "raw")
    work = loading.weekend_worklist(loading.season_rounds(spark), 2024, 2)
    loading.load_sessions(spark, _feeds_of(spark, 11, results=3), root, STAMP, work)
    assert _counts(spark, root) == {
        "sessions": 1, "results": 3, "laps": 11, "pit_stops": 2, "weather": 0, "drivers": 3, "circuits": 1,
    }
    reader = loads.Snapshot(spark, root)
    loading.load_sessions(spark, _feeds_of(spark, 4, results=0), root, STAMP, work)
    assert _counts(spark, root) == {
        "sessions": 1, "results": 0, "laps": 4, "pit_stops": 0, "weather": 0, "drivers": 0, "circuits": 1,
    }
    # A reader that began before sees the old rows of all feeds.
    assert {feed: reader.read(feed).count() for feed in ("results", "laps", "pit_stops", "drivers")} == {
        "results": 3, "laps": 11, "pit_stops": 2, "drivers": 3,
    }
    entries = {r.feed: r.row_count for r in loads.Snapshot(spark, root).current().collect()}
    assert entries["pit_stops"] == 0 and set(entries) == set(RAW)


def test_a_load_killed_before_its_manifest_is_complete_is_not_seen(spark):
    """Old or new for all seven feeds, wherever the load stops."""
    root = scratch_path(spark, "raw")
    work = loading.weekend_worklist(loading.season_rounds(spark), 2024, 2)
    loading.load_sessions(spark, _feeds_of(spark, 11, results=3), root, STAMP, work)
    before = {feed: _rows(spark, root, feed) for feed in RAW}
    loading.load_sessions(spark, _feeds_of(spark, 20, results=1), root, STAMP, work)
    after = {feed: _rows(spark, root, feed) for feed in RAW}
    last = loads.committed(spark, root)[-1]
    mark = f"{root}/manifest/load={last}/_SUCCESS"
    storage.delete(spark, mark)
    assert {feed: _rows(spark, root, feed) for feed in RAW} == before
    loading.load_sessions(spark, _feeds_of(spark, 20, results=1), root, STAMP, work)
    assert {feed: _rows(spark, root, feed) for feed in RAW} == after


def test_compaction_and_vacuum_keep_the_rows(spark, feeds):
    root = scratch_path(spark, "raw")
    loading.load_sessions(spark, feeds, root, STAMP)
    loading.load_weekend(spark, feeds, root, STAMP, 1997, 4)
    loading.load_weekend(spark, feeds, root, STAMP, 1998, 2)
    before = {feed: _rows(spark, root, feed) for feed in RAW}
    reader = loads.Snapshot(spark, root)
    loads.compact(spark, root)
    assert {feed: _rows(spark, root, feed) for feed in RAW} == before
    assert loads.vacuum(spark, root) == []
    assert sorted(map(repr, reader.read("laps").collect())) == before["laps"]
    assert len(loads.vacuum(spark, root, keep=1)) == 3
    assert {feed: _rows(spark, root, feed) for feed in RAW} == before


def test_one_load_is_read_without_a_join(spark, feeds):
    root = scratch_path(spark, "raw")
    loading.load_sessions(spark, feeds, root, STAMP)
    plan = loads.Snapshot(spark, root).read("laps")._jdf.queryExecution().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_rows_without_session_are_counted(spark, feeds):
    report = loading.load_sessions(spark, feeds, scratch_path(spark, "raw"), STAMP)
    lost = {r.feed: r.rows_without_session for r in report.collect()}
    assert lost["results"] == feeds["results"].filter("session_id is null").count() > 0
    assert lost["laps"] == lost["events"] == 0


def test_a_worklist_loads_its_sessions_again(spark, feeds):
    root = scratch_path(spark, "raw")
    for stamp in (STAMP, datetime(2003, 1, 1)):
        loading.load_weekend(spark, feeds, root, stamp, 1997, 4)
    sessions = landing.read_raw(spark, root, "sessions").collect()
    assert {r.session_id for r in sessions} == {"1997_4_Q", "1997_4_R"}
    assert {r.loaded_at for r in sessions} == {datetime(2003, 1, 1)}
    laps = landing.read_raw(spark, root, "laps")
    assert laps.count() == feeds["laps"].filter("session_id = '1997_4_R'").count()


def test_seasons_are_read_from_their_directories_only(spark, feeds, capsys):
    root = scratch_path(spark, "raw")
    loading.load_weekend(spark, feeds, root, STAMP, 1997, 4)
    reader = loads.Snapshot(spark, root)
    reader.read("sessions", [1996]).explain("formatted")
    text = capsys.readouterr().out
    assert "part_season#" in text.split("PartitionFilters")[1]
    assert reader.read("sessions", [1996]).count() == 0 and reader.read("sessions", [1997]).count() == 2


def test_worklists_are_in_order(spark):
    rounds = loading.season_rounds(spark, {2025: 2, 2024: 11})
    loaded = loading.expected_grid(rounds).limit(0)
    ids = [r.session_id for r in loading.load_worklist(rounds, loaded).collect()]
    assert ids[:4] == ["2024_1_Q", "2024_1_R", "2024_2_Q", "2024_2_R"] and ids[-1] == "2025_2_R"


def test_backfill_stores_what_is_missing(spark, feeds):
    root = scratch_path(spark, "raw")
    loading.load_sessions(spark, feeds, root, STAMP)
    before = _rows(spark, root, "pit_stops")
    few = scratch_path(spark, "raw")
    for feed in ("sessions", "laps"):
        landing.replace_sessions(landing.read_raw(spark, root, feed), few, feed)
    part = landing.read_raw(spark, root, "pit_stops").filter("session_id not like '1996%'")
    landing.replace_sessions(part, few, "pit_stops")
    added = loading.backfill_pit_stops(spark, few)
    assert {r.session_id[:4] for r in added.collect()} == {"1996"}
    assert _rows(spark, few, "pit_stops") == before
    assert loading.backfill_pit_stops(spark, few).count() == 0


def test_marts_survive_a_failed_write_and_a_second_one(spark):
    path = scratch_path(spark, "mart")
    first = landing.write_mart(spark.range(5), path)
    failing = spark.range(9).selectExpr("id", "raise_error('lost') as x").select("id", "x")
    with pytest.raises(Exception, match="lost"):
        landing.write_mart(failing, path)
    assert landing.read_mart(spark, path, first.schema).count() == 5
    again = landing.write_mart(first.union(first), path)
    assert again.count() == 10 and first.count() == 5
    with pytest.raises(FileNotFoundError):
        landing.read_mart(spark, scratch_path(spark, "none"), first.schema)


def test_a_hot_driver_and_race_is_spread_over_files(spark):
    rows = spark.range(20_000).selectExpr(
        "1996L as season", "if(id % 2 = 0, 'D1', concat('D', id % 40)) as abbreviation",
        "if(id % 2 = 0, 1L, id % 20) as round_number", "id as lap_number",
    )
    wide = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stored = landing.write_clustered(rows, scratch_path(spark, "hot"))
        hot = stored.filter("abbreviation = 'D1' and round_number = 1")
        files = hot.groupBy(F.input_file_name().alias("f")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", wide)
    assert len(files) > 1 and max(f["count"] for f in files) < 8000


def test_scratch_needs_a_named_folder(spark):
    path = scratch_path(spark, "t")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3

    class Unnamed:
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})
        sparkContext = type("S", (), {"getCheckpointDir": staticmethod(lambda: None)})

    with pytest.raises(session.NoSharedFolder):
        session.scratch_root(Unnamed())


def test_backfill_twice_adds_nothing(spark, feeds):
    root = scratch_path(spark, "raw")
    loading.load_sessions(spark, feeds, root, STAMP)
    stops = landing.read_raw(spark, root, "pit_stops")
    again = loading.pit_stop_backfill(
        landing.read_raw(spark, root, "sessions"), landing.read_raw(spark, root, "laps"), stops
    )
    assert again.count() == 0
    from_nothing = loading.pit_stop_backfill(
        landing.read_raw(spark, root, "sessions"), landing.read_raw(spark, root, "laps"),
        stops.limit(0),
    )
    assert from_nothing.count() == stops.count()


def test_grid_of_the_known_seasons(spark):
    grid = loading.expected_grid(loading.season_rounds(spark))
    assert grid.count() == 2 * sum(SEASON_ROUNDS.values()) == 228
    assert grid.filter("session_id = '2024_24_Q'").count() == 1


def test_latest_round(spark):
    schedule = spark.createDataFrame(
        [(2024, 0, datetime(2024, 2, 20)), (2024, 1, datetime(2024, 3, 2)),
         (2024, 2, datetime(2024, 3, 9)), (2025, 1, datetime(2025, 3, 9))],
        "season bigint, RoundNumber bigint, EventDate timestamp_ntz",
    )
    latest = loading.latest_completed_round(schedule, datetime(2024, 3, 9))
    assert {r.season: r.latest_round for r in latest.collect()} == {2024: 1, 2025: None}
    work = loading.latest_weekend_worklist(schedule, datetime(2024, 3, 10))
    assert {r.session_id for r in work.collect()} == {"2024_2_Q", "2024_2_R"}
    weekend = loading.weekend_worklist(loading.season_rounds(spark), 2024, 24)
    assert {r.session_id for r in weekend.collect()} == {"2024_24_Q", "2024_24_R"}


def test_pipeline_over_stored_raw_tables(spark, feeds):
    root = scratch_path(spark, "raw")
    loading.load_sessions(spark, feeds, root, STAMP)
    made = Pipeline.over(spark, root, as_of=datetime(1998, 6, 15).date())
    made.check()
    marts = scratch_path(spark, "marts")
    written = made.write(marts)
    assert list(written) == MARTS
    twice = made.write(marts)
    for name in ("final_standings", "lap_times"):
        assert sorted(map(repr, twice[name].collect())) == sorted(map(repr, written[name].collect()))
    with pytest.raises(quality.QualityError, match="all rounds"):
        made.write(marts, loading.season_rounds(spark, {1996: 13}))
    assert written["final_standings"].count() == 70
    assert written["lap_times"].count() == 995
    made.register_views(spark)
    assert spark.sql("select count(*) from stg_laps").first()[0] == written["lap_times"].count()


def test_written_marts_equal_the_lazy_ones(spark, small_dir):
    lazy = fixtures.pipeline(fixtures.RawFeeds(spark, small_dir))
    stored = fixtures.pipeline(fixtures.RawFeeds(spark, small_dir)).keep(scratch_path(spark, "kept"), "lap_times", "tyre_strategy")
    for name in ("lap_times", "tyre_strategy"):
        left, right = getattr(lazy, name), getattr(stored, name)
        assert left.columns == right.columns
        assert left.exceptAll(right).count() == right.exceptAll(left).count() == 0


def test_season_and_round_landing(spark):
    path = scratch_path(spark, "t")
    rows = spark.createDataFrame([("a", 2024, 1), ("b", 2024, 2)], "session_id string, season int, round_number int")
    landing.land_by_session(rows, path, ["season", "round_number"])
    assert spark.read.parquet(path).filter(F.col("season") == 2024).count() == 2

"""Hand-made cases for the semantics that are easy to get wrong."""

from __future__ import annotations

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from trackside.functions import duration_seconds, duration_text, to_real, whole_number
from trackside.plans import marts, staging
from trackside.plans.pipeline import Pipeline
from trackside.schemas import RAW
from trackside.sources import shaping

T0, T1 = datetime(2024, 3, 1), datetime(2024, 3, 2)


def frame(spark, feed, rows):
    """Raw rows from dictionaries; columns left out are NULL."""
    schema = RAW[feed]
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


def session(round_number, kind="R", season=2024, country="Bahrain", **more):
    return {
        "session_id": f"{season}_{round_number}_{kind}", "season": season,
        "round_number": round_number, "country": country, "location": country,
        "circuit_key": f"{country} GP", "session_type": kind,
        "session_date": date(season, 3, round_number), "loaded_at": T0, **more,
    }


def result(round_number, driver, points=None, finish=None, kind="R", season=2024, **more):
    return {
        "session_id": f"{season}_{round_number}_{kind}", "driver_number": driver,
        "abbreviation": f"D{driver}", "full_name": f"Driver {driver}", "team_name": "T",
        "grid_position": 1.0, "finish_position": finish, "points": points,
        "status": "Finished", "loaded_at": T0, **more,
    }


def lap(number, driver="1", seconds=90.0, round_number=1, compound="SOFT", **more):
    return {
        "session_id": f"2024_{round_number}_R", "driver_number": driver,
        "abbreviation": f"D{driver}", "lap_number": number, "lap_time_seconds": seconds,
        "compound": compound, "tyre_life": 1.0, "track_status": "1", "loaded_at": T0, **more,
    }


def pipeline(spark, **feeds):
    options = {k: feeds.pop(k) for k in ("as_of", "dedupe") if k in feeds}
    return Pipeline({f: frame(spark, f, feeds.get(f, [])) for f in RAW}, **options)


@pytest.mark.parametrize(
    ("value", "whole"),
    [(2.5, 3), (-2.5, -3), (2.4, 2), (2.7, 3), (0.5, 1), (math.nan, None), (None, None)],
)
def test_floats_round_half_away_from_zero(spark, value, whole):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(whole_number(F.col("v"))).first()[0] == whole


def test_text_that_is_no_number_becomes_null(spark):
    df = spark.createDataFrame([("3",), ("4.5",), ("NC",), ("",), ("nan",), (None,)], "v string")
    assert [r[0] for r in df.select(to_real("v")).collect()] == [3.0, 4.5, None, None, None, None]
    odd = spark.createDataFrame([(x,) for x in ("1d", "2f", "1D", " 7 ", "-1.5e2", ".5", "5.", "+", "0x1")], "v string")
    assert [r[0] for r in odd.select(to_real("v")).collect()] == [
        None, None, None, 7.0, -150.0, 0.5, 5.0, None, None
    ]


def test_durations_of_any_storage(spark):
    df = spark.sql(
        "select interval '1 02:03:04.125' day to second as i, 93784125000000L as n,"
        " 93784.125D as d"
    )
    assert df.select(*[duration_seconds(df, c) for c in "ind"]).first()[:] == (93784.125,) * 3


@pytest.mark.parametrize(
    ("nanos", "text"),
    [
        (5504742000000, "0 days 01:31:44.742000"),
        (22000000000, "0 days 00:00:22"),
        (93784125000000, "1 days 02:03:04.125000"),
        (-1000000000, "-1 days +23:59:59"),
        (None, "NaT"),
    ],
)
def test_duration_text(spark, nanos, text):
    df = spark.createDataFrame([(nanos,)], "t bigint")
    assert df.select(duration_text(df, "t")).first()[0] == text


def test_missing_duration_text_is_nat(spark):
    df = spark.createDataFrame([(None,), ("x",)], "t string")
    assert [r[0] for r in df.select(duration_text(df, "t")).collect()] == ["NaT", "x"]


def test_race_name_is_null_without_country(spark):
    staged = pipeline(spark, sessions=[session(1), session(2, country=None)]).stg_sessions
    assert {r.round_number: r.race_name for r in staged.collect()} == {
        1: "2024 Bahrain Grand Prix", 2: None,
    }


def test_unknown_session_type_keeps_its_code(spark):
    staged = pipeline(spark, sessions=[session(1, "R"), session(1, "Q"), session(1, "S")])
    assert {r.session_type_name for r in staged.stg_sessions.collect()} == {
        "Race", "Qualifying", "S",
    }


def test_clean_lap_is_null_for_unknown_track_status_unless_ruled_out(spark):
    laps = [
        lap(1), lap(2, track_status=None), lap(3, track_status="4"),
        lap(4, track_status=None, pit_in_time_seconds=1.0), lap(5, seconds=None),
    ]
    made = pipeline(spark, sessions=[session(1)], laps=laps)
    assert {r.lap_number: r.is_clean_lap for r in made.lap_times.collect()} == {
        1: True, 2: None, 3: False, 4: False, 5: False,
    }


def test_median_covers_all_laps_and_delta_needs_a_time(spark):
    laps = [lap(1, seconds=90.0), lap(2, seconds=92.0), lap(3, seconds=None),
            lap(4, seconds=140.0, track_status="4"), lap(5, seconds=94.0)]
    made = pipeline(spark, sessions=[session(1)], laps=laps)
    assert {r.lap_number: r.delta_to_driver_median for r in made.lap_times.collect()} == {
        1: -3.0, 2: -1.0, 3: None, 4: 47.0, 5: 1.0,
    }


def test_only_finished_and_lapped_are_classified(spark):
    status = ["Finished", "+1 Lap", "Retired", None, "finished"]
    rows = [result(1, str(i), status=s) for i, s in enumerate(status)]
    made = pipeline(spark, sessions=[session(1)], results=rows)
    got = {r.driver_number: (r.is_classified, r.is_dnf) for r in made.race_results.collect()}
    assert [got[str(i)] for i in range(5)] == [
        (True, False), (True, False), (False, True), (False, True), (False, True),
    ]


def test_latest_load_wins_and_ties_do_not_depend_on_partitioning(spark):
    rows = [result(1, "1", 25.0), result(1, "1", 18.0, loaded_at=T1), result(1, "1", 15.0)]
    raw = frame(spark, "results", rows)
    assert [r.points for r in staging.stage_results(raw).collect()] == [18.0]
    tied = frame(spark, "results", [rows[0], rows[2]])
    kept = {
        staging.stage_results(tied.repartition(n)).first().points for n in (1, 2, 3)
    }
    assert kept == {25.0}


def test_doubled_session_fans_out_unless_deduplicated(spark):
    feeds = {"sessions": [session(1), session(1, loaded_at=T1)], "results": [result(1, "1", 25.0)]}
    assert pipeline(spark, **feeds).race_results.count() == 2
    assert pipeline(spark, dedupe=True, **feeds).race_results.count() == 1


def test_standings_ties_gaps_leavers_and_missing_points(spark):
    sessions = [session(1), session(2)]
    results = [
        result(1, "1", 25.0), result(1, "2", 25.0), result(1, "3", 18.0), result(1, "4", None),
        result(2, "1", 0.0), result(2, "2", 1.0), result(2, "4", 1.0),
    ]
    made = pipeline(spark, sessions=sessions, results=results)
    standings = {
        (r.round_number, r.abbreviation): (r.round_points, r.cumulative_points, r.championship_position)
        for r in made.driver_standings.collect()
    }
    assert standings[1, "D1"] == (25.0, 25.0, 1) and standings[1, "D2"][2] == 1
    assert standings[1, "D3"][2] == 3 and standings[1, "D4"] == (0.0, 0.0, 4)
    assert (2, "D3") not in standings
    final = {r.abbreviation: r for r in made.final_standings.collect()}
    assert final["D3"].final_points == 18.0 and final["D3"].last_round_raced == 1
    assert [final[f"D{i}"].final_championship_position for i in (2, 1, 3, 4)] == [1, 2, 3, 4]
    assert {r.abbreviation: r.points for r in made.race_results.filter("round_number = 1").collect()}["D4"] is None


def test_running_total_of_last_round_is_the_season_sum(spark):
    results = [result(r, str(d), float(r * d)) for r in range(1, 9) for d in range(1, 5)]
    made = pipeline(spark, sessions=[session(r) for r in range(1, 9)], results=results)
    last = made.driver_standings.filter("round_number = 8")
    assert {r.abbreviation: r.cumulative_points for r in last.collect()} == {
        f"D{d}": 36.0 * d for d in range(1, 5)
    }


def test_team_points_are_summed_before_they_run(spark):
    results = [result(1, "1", 25.0), result(1, "2", None), result(2, "1", 18.0), result(2, "2", 10.0)]
    made = pipeline(spark, sessions=[session(1), session(2)], results=results)
    assert {r.round_number: (r.team_points, r.cumulative_points) for r in made.constructor_standings.collect()} == {
        1: (25.0, 25.0), 2: (28.0, 53.0),
    }


def test_stints(spark):
    laps = [
        lap(1, compound=None), lap(2), lap(3, compound="soft"),
        lap(4, compound=None, pit_out_time_seconds=5.0), lap(5, compound="HARD"),
        lap(6, compound="HARD", pit_out_time_seconds=9.0), lap(7, compound="HARD", seconds=None),
        lap(1, driver="2"), lap(2, driver="2"),
    ]
    made = pipeline(spark, sessions=[session(1)], laps=laps)
    stints = {(r.abbreviation, r.stint_number): r for r in made.tyre_strategy.collect()}
    # Lap 1 lost: stint 0. Pit-out lap 4 lost: lap 5 still belongs to it.
    assert (stints["D1", 0].stint_start_lap, stints["D1", 0].stint_end_lap) == (2, 5)
    assert stints["D1", 0].compound == "HARD" and stints["D1", 0].stint_length == 3
    assert (stints["D1", 1].stint_start_lap, stints["D1", 1].stint_length) == (6, 2)
    assert stints["D1", 1].avg_lap_time == 90.0
    assert stints["D2", 1].stint_length == 2 and len(stints) == 3
    assert sum(s.stint_length for s in stints.values()) == sum(
        1 for row in laps if row["compound"] is not None
    )


def test_same_row_duration_and_pit_lane_time(spark):
    laps = frame(spark, "laps", [
        lap(1, pit_in_time_seconds=100.0), lap(2, pit_out_time_seconds=122.0, pit_in_time_seconds=200.0),
        lap(4, pit_out_time_seconds=999.0),
    ])
    stops = {r.lap_number: r for r in shaping.extract_pit_stops(laps).collect()}
    assert stops[1].pit_duration_seconds is None and stops[2].pit_duration_seconds == -78.0
    assert (stops[1].stop_number, stops[2].stop_number) == (1, 2)
    lane = {r.lap_number: r.pit_lane_seconds for r in shaping.pit_lane_time(laps).collect()}
    assert lane == {1: 22.0, 2: None}


def test_pit_stop_takes_tyres_of_the_next_lap_only(spark):
    stops = [{"session_id": "2024_1_R", "driver_number": "1", "abbreviation": "D1",
              "stop_number": i, "lap_number": n, "loaded_at": T0} for i, n in ((1, 5), (2, 9))]
    laps = [lap(6, compound="hard"), lap(11, compound="soft")]
    made = pipeline(spark, sessions=[session(1)], laps=laps, pit_stops=stops)
    assert {r.lap_number: r.compound_after_stop for r in made.pit_stops.collect()} == {5: "HARD", 9: None}


def test_calendar_status_is_strict_and_null_is_upcoming(spark):
    sessions = [session(1), session(2), session(3, session_date=None), session(1, "Q")]
    made = pipeline(spark, sessions=sessions, as_of=date(2024, 3, 2))
    assert [(r.round_number, r.race_status) for r in made.season_calendar.collect()] == [
        (1, "completed"), (2, "upcoming"), (3, "upcoming"),
    ]


def test_circuit_stats_count_races_without_pole_or_stops(spark):
    sessions = [session(r, k) for r in (1, 2, 3) for k in "RQ"]
    results = [
        result(1, "1", finish=1.0), result(1, "1", finish=1.0, kind="Q"),
        result(2, "1", finish=2.0), result(2, "2", finish=1.0), result(2, "1", finish=1.0, kind="Q"),
        result(3, "2", finish=1.0),
    ]
    stops = [{"session_id": "2024_1_R", "driver_number": "1", "abbreviation": "D1",
              "stop_number": i, "lap_number": i, "loaded_at": T0} for i in (1, 2)]
    made = pipeline(spark, sessions=sessions, results=results, pit_stops=stops)
    stats = made.circuit_stats.collect()
    assert len(stats) == 1
    assert (stats[0].races_held, stats[0].pole_to_win_count, stats[0].pole_to_win_pct) == (3, 1, 33.3)
    assert stats[0].avg_pit_stops_per_driver == 2.0


def test_empty_inputs_give_empty_marts(spark):
    made = pipeline(spark, as_of=date(2024, 1, 1))
    assert made.final_standings.count() == 0 and made.tyre_strategy.count() == 0
    assert made.lap_times.count() == 0 and made.circuit_stats.count() == 0


def test_weather_reading_time_is_start_plus_offset_to_the_second(spark):
    events = spark.createDataFrame(
        [(2024, 1, "R", datetime(2024, 3, 2, 15, 0, 0))],
        "season bigint, round_number bigint, session_type string, SessionDate timestamp_ntz",
    )
    weather = spark.createDataFrame(
        [("2024_1_R", 61_999_000_000, 20.0, 30.0, float("nan"), False, 1.5, T0)],
        "session_id string, Time bigint, AirTemp double, TrackTemp double, Humidity double,"
        " Rainfall boolean, WindSpeed double, loaded_at timestamp",
    )
    row = shaping.shape_weather(weather, events).first()
    assert row.timestamp == "2024-03-02 15:01:01" and row.humidity is None


def test_events_without_a_text_column_get_the_empty_text(spark):
    events = spark.createDataFrame(
        [(2024, 1, "R", None, datetime(2024, 3, 2), T0)],
        "season bigint, round_number bigint, session_type string, Country string,"
        " SessionDate timestamp_ntz, loaded_at timestamp",
    )
    row = shaping.shape_sessions(events).first()
    assert (row.session_id, row.country, row.location, row.circuit_key) == ("2024_1_R", "", "", "")
    assert row.session_date == date(2024, 3, 2)
    stamped = shaping.shape_sessions(events, loaded_at=T1).first()
    assert stamped.loaded_at == T1


def test_marts_do_not_depend_on_how_groups_are_cut(spark):
    laps = [lap(n, driver=str(d), seconds=80 + (n * d) % 9 / 8,
                pit_out_time_seconds=1.0 if n % 5 == 0 else None)
            for n in range(1, 21) for d in range(1, 4)]
    made = pipeline(spark, sessions=[session(r) for r in range(1, 9)], laps=laps)
    for build in (
        lambda size: marts.lap_times(made.stg_laps, made.stg_sessions, size),
        lambda size: marts.tyre_strategy(made.stg_laps, made.stg_sessions, size),
    ):
        assert sorted(map(repr, build(1).collect())) == sorted(map(repr, build(1000).collect()))

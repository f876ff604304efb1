"""DuckDB SQL for the queries in ``__spark_entry__``, written independently of them.

Relations are named pieces; ``query`` puts the pieces a statement needs in front
of it. Running totals, ranks and stints are spelled as self joins here and the
latest row per key as ``arg_max``, so that a mistake in a Spark window does not
repeat itself on this side.
"""

from __future__ import annotations

import re

RELATIONS: dict[str, str] = {}


def _relation(name: str, sql: str) -> None:
    RELATIONS[name] = sql


def query(sql: str) -> str:
    """The statement preceded by every relation it names, directly or not."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"[a-z_0-9]+", text)):
            if word in RELATIONS and word not in needed:
                visit(RELATIONS[word])
                if word not in needed:
                    needed.append(word)

    visit(sql)
    if not needed:
        return sql
    pieces = ",\n".join(f"{name} as ({RELATIONS[name]})" for name in needed)
    return f"with {pieces}\n{sql}"


# --- test inputs -----------------------------------------------------------

_relation("li", """
  select l.*, cast(year(l_shipdate) as bigint) as season,
         cast(month(l_shipdate) as bigint) as round_number,
         if(l_linestatus = 'F', 'R', 'Q') as session_type,
         d.drv, (d.drv + if(month(l_shipdate) > 6, 1, 0)) % 10 as tm,
         year(l_shipdate) || '_' || month(l_shipdate) || '_' || if(l_linestatus = 'F', 'R', 'Q') as sid
  from lineitem l,
    lateral (select case when l.l_suppkey % 20 = 3 and month(l.l_shipdate) > 8 then 4
                         else l.l_suppkey % 20 end as drv) d""")

_relation("raw_sessions", """
  select sid as session_id, season, round_number, n_name as country, n_name as location,
         n_name as circuit_key, session_type,
         cast(min(date_trunc('month', l_shipdate)) as date) as session_date,
         max(l_shipdate) as loaded_at
  from li join nation on n_nationkey = round_number
  group by all""")

_relation("raw_results", """
  select if(l_orderkey % 101 = 0, null, sid) as session_id, cast(drv as varchar) as driver_number,
         'D' || drv as abbreviation, 'Driver ' || drv as full_name, 'T' || tm as team_name,
         cast(l_orderkey % 21 as double) as grid_position,
         if(l_orderkey % 37 = 0, null,
            1 + l_partkey % 20 + if(l_orderkey % 50 = 0, 0.5, 0.0))::double as finish_position,
         if(l_discount >= 0.09, null, l_quantity) as points,
         case l_returnflag when 'N' then 'Finished' when 'A' then '+1 Lap' else 'Retired' end as status,
         cast(l_linenumber as varchar) as "time", l_shipdate as loaded_at,
         l_orderkey, l_linenumber, l_partkey
  from li""")

_relation("raw_drivers", """
  select cast(drv as varchar) as driver_number,
         if(l_orderkey % 103 = 0, null, 'D' || drv) as abbreviation,
         'Driver ' || drv as full_name, 'C' || (drv % 5) as nationality, 'T' || tm as team_name,
         season, l_shipdate as loaded_at, l_orderkey, l_linenumber, l_partkey
  from li""")

_relation("raw_circuits", """
  select circuit_key, location as circuit_name, country, location, loaded_at, session_id
  from raw_sessions""")

_relation("ev", """
  select *, lag(if(event_type = 'error', sod, null)) over w as prev_in,
         row_number() over w as n
  from (select *, (1995 + day(ts) % 7) || '_' || (1 + day(ts) // 7) || '_R' as session_id,
               user_id % 20 as drv,
               hour(ts) * 3600 + minute(ts) * 60 + second(ts) as sod
        from events)
  window w as (partition by session_id, drv order by ts, event_id)""")

_relation("raw_laps", """
  select session_id, cast(drv as varchar) as driver_number, 'D' || drv as abbreviation,
         if(event_id % 211 = 0, null, n)::bigint as lap_number,
         if(event_type = 'signup', null, floor(value * 8) / 8) as lap_time_seconds,
         floor(value * 2) / 8 as sector_1_seconds, floor(value * 3) / 8 as sector_2_seconds,
         floor(value * 3) / 8 as sector_3_seconds,
         case when event_id % 3 = 0 then 'soft' when event_id % 3 = 1 then 'Medium'
              when event_id % 29 = 2 then null else 'HARD' end as compound,
         cast(event_id % 25 as double) as tyre_life,
         event_type = 'purchase' as is_personal_best,
         if(event_type = 'error', sod, null)::double as pit_in_time_seconds,
         (prev_in + 25 + event_id % 7)::double as pit_out_time_seconds,
         case when event_id % 10 = 0 then '4' when event_id % 17 = 0 then null else '1' end as track_status,
         ts as loaded_at
  from ev""")

_relation("raw_pit_stops", """
  select session_id, driver_number, abbreviation,
         rank() over (partition by session_id, driver_number
                      order by lap_number nulls last, pit_in_time_seconds,
                               pit_out_time_seconds nulls last, loaded_at) as stop_number,
         lap_number, pit_out_time_seconds - pit_in_time_seconds as pit_duration_seconds, loaded_at
  from raw_laps
  where pit_in_time_seconds is not null""")

_relation("raw_weather", """
  select session_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as "timestamp",
         floor(value * 8) / 8 as air_temp, floor(value * 8) / 8 + 10 as track_temp,
         cast(event_id % 100 as double) as humidity, event_type = 'error' as rainfall,
         (event_id % 80) / 8 as wind_speed, ts as loaded_at
  from ev""")

# --- staging ---------------------------------------------------------------

_relation("stg_sessions", """
  select *, case session_type when 'R' then 'Race' when 'Q' then 'Qualifying'
                 else session_type end as session_type_name,
         season || ' ' || country || ' Grand Prix' as race_name
  from raw_sessions where session_id is not null""")

_relation("stg_results", """
  select r.session_id, r.driver_number, r.abbreviation, r.full_name, r.team_name,
         cast(round(r.grid_position) as bigint) as grid_position,
         cast(round(r.finish_position) as bigint) as finish_position,
         r.points, r.status, r."time" as finish_time, r.loaded_at,
         cast(round(r.grid_position) as bigint)
           - cast(round(r.finish_position) as bigint) as positions_gained,
         coalesce(r.status = 'Finished' or r.status[1] = '+', false) as is_classified
  from (select arg_max(x, (loaded_at, l_orderkey, l_linenumber, l_partkey)) as r
        from raw_results x where session_id is not null
        group by session_id, driver_number)""")

_relation("stg_laps", """
  select * exclude (compound, tyre_life), upper(compound) as compound,
         cast(round(tyre_life) as bigint) as tyre_life,
         pit_in_time_seconds is not null as is_pit_in_lap,
         pit_out_time_seconds is not null as is_pit_out_lap,
         track_status <> '1' as is_abnormal_track_status
  from raw_laps where session_id is not null and lap_number is not null""")

_relation("stg_pit_stops", "select * from raw_pit_stops where session_id is not null")

_relation("stg_weather", """
  select * rename ("timestamp" as reading_time) from raw_weather where session_id is not null""")

_relation("stg_drivers", """
  select r.driver_number, r.abbreviation, r.full_name, r.team_name, r.nationality, r.season,
         r.loaded_at
  from (select arg_max(x, (loaded_at, l_orderkey, l_linenumber, l_partkey)) as r
        from raw_drivers x where abbreviation is not null group by abbreviation, season)""")

_relation("stg_circuits", """
  select r.circuit_key, r.circuit_name, r.country, r.location, r.loaded_at
  from (select arg_max(x, (loaded_at, session_id)) as r
        from raw_circuits x where circuit_key is not null group by circuit_key)""")

# --- marts -----------------------------------------------------------------

_relation("race_results", """
  select season, round_number, race_name, country, location, session_date, session_id,
         driver_number, abbreviation, full_name, team_name, grid_position, finish_position,
         positions_gained, points, status, finish_time, is_classified,
         is_classified is not true as is_dnf
  from stg_results r
  join (select * exclude (loaded_at) from stg_sessions where session_type = 'R') using (session_id)""")

_relation("qualifying_results", """
  select season, round_number, race_name, session_date, session_id, abbreviation, full_name,
         team_name, finish_position as qualifying_position
  from stg_results r
  join (select * exclude (loaded_at) from stg_sessions where session_type = 'Q') using (session_id)""")

_relation("driver_totals", """
  select a.season, a.round_number, a.race_name, a.session_date, a.abbreviation, a.full_name,
         a.team_name, coalesce(any_value(a.points), 0) as round_points,
         sum(coalesce(b.points, 0)) as cumulative_points
  from race_results a
  join race_results b on b.season = a.season and b.abbreviation = a.abbreviation
                     and b.round_number <= a.round_number
  group by a.season, a.round_number, a.race_name, a.session_date, a.abbreviation, a.full_name,
           a.team_name""")

_relation("driver_standings", """
  select *, 1 + (select count(*) from driver_totals o
                 where o.season = t.season and o.round_number = t.round_number
                   and o.cumulative_points > t.cumulative_points) as championship_position
  from driver_totals t""")

_relation("final_totals", """
  select season, abbreviation, arg_max(full_name, round_number) as full_name,
         arg_max(team_name, round_number) as team_name,
         arg_max(cumulative_points, round_number) as final_points,
         max(round_number) as last_round_raced
  from driver_totals group by season, abbreviation""")

_relation("final_standings", """
  select *, 1 + (select count(*) from final_totals o
                 where o.season = t.season and o.final_points > t.final_points)
              as final_championship_position
  from final_totals t""")

_relation("team_rounds", """
  select season, round_number, race_name, session_date, team_name,
         sum(ifnull(points, 0)) as team_points
  from race_results group by all""")

_relation("team_totals", """
  select t.*, (select sum(e.team_points) from team_rounds e
               where e.season = t.season and e.team_name = t.team_name
                 and e.round_number <= t.round_number) as cumulative_points
  from team_rounds t""")

_relation("constructor_standings", """
  select *, 1 + (select count(*) from team_totals o
                 where o.season = t.season and o.round_number = t.round_number
                   and o.cumulative_points > t.cumulative_points) as constructor_position
  from team_totals t""")

_relation("race_laps", """
  select season, round_number, race_name, l.*
  from stg_laps l
  join (select session_id, season, round_number, race_name
        from stg_sessions where session_type = 'R') using (session_id)""")

_relation("lap_times", """
  select season, round_number, race_name, l.session_id, l.abbreviation, driver_number, lap_number,
         lap_time_seconds, sector_1_seconds, sector_2_seconds, sector_3_seconds, compound,
         tyre_life, is_personal_best, is_pit_in_lap, is_pit_out_lap, is_abnormal_track_status,
         (lap_time_seconds is not null and not is_pit_in_lap and not is_pit_out_lap
          and not is_abnormal_track_status) as is_clean_lap,
         lap_time_seconds - middle as delta_to_driver_median
  from race_laps l
  join (select session_id, abbreviation, quantile_cont(lap_time_seconds, 0.5) as middle
        from race_laps group by all) m
    on m.session_id = l.session_id and m.abbreviation = l.abbreviation""")

_relation("pit_stops", """
  select season, round_number, race_name, p.session_id, p.abbreviation, p.driver_number,
         stop_number, p.lap_number, pit_duration_seconds, n.compound as compound_after_stop,
         n.tyre_life as tyre_age_after_stop
  from stg_pit_stops p
  join stg_sessions s on s.session_id = p.session_id and s.session_type = 'R'
  left join stg_laps n on n.session_id = p.session_id and n.abbreviation = p.abbreviation
                      and n.lap_number = p.lap_number + 1""")

_relation("known_laps", "select * from race_laps where compound is not null")

_relation("stint_laps", """
  select *, (select count(*) from known_laps e
             where e.session_id = l.session_id and e.abbreviation = l.abbreviation
               and e.lap_number <= l.lap_number
               and (e.lap_number = 1 or e.is_pit_out_lap)) as stint_number
  from known_laps l""")

_relation("tyre_strategy", """
  select season, round_number, race_name, session_id, abbreviation, stint_number,
         min(compound) as compound, min(lap_number) as stint_start_lap,
         max(lap_number) as stint_end_lap, count(*) as stint_length,
         avg(lap_time_seconds) as avg_lap_time, min(lap_time_seconds) as best_lap_time
  from stint_laps group by all""")

_relation("season_calendar", """
  select season, round_number, race_name, country, location, circuit_key,
         session_date as race_date,
         if(session_date < date '1998-06-15', 'completed', 'upcoming') as race_status
  from stg_sessions where session_type = 'R'""")

_relation("firsts", """
  select season, round_number, race_name, country, location, abbreviation as winner, null as pole
  from race_results where finish_position = 1
  union all
  select season, round_number, null, null, null, null, abbreviation
  from qualifying_results where qualifying_position = 1
  union all
  select distinct season, round_number, race_name, country, location, null, null from race_results""")

_relation("race_summary", """
  select season, round_number, any_value(race_name) as race_name, any_value(country) as country,
         any_value(location) as location, max(winner) as race_winner, max(pole) as pole_sitter
  from firsts group by season, round_number having count(location) > 0""")

_relation("pit_summary", """
  select season, round_number, sum(n) / count(*) as avg_stops_per_driver
  from (select season, round_number, abbreviation, count(*) as n from pit_stops group by all)
  group by season, round_number""")

_relation("circuit_stats", """
  select s.location, s.country, count(*) as races_held,
         count(*) filter (s.race_winner = s.pole_sitter) as pole_to_win_count,
         round(count(*) filter (s.race_winner = s.pole_sitter) / count(*) * 100, 1) as pole_to_win_pct,
         round(avg((select p.avg_stops_per_driver from pit_summary p
                    where p.season = s.season and p.round_number = s.round_number)), 2)
           as avg_pit_stops_per_driver
  from race_summary s group by s.location, s.country""")

# --- worklists and checks --------------------------------------------------

_relation("season_rounds", """
  select season, cast(count(distinct round_number) as bigint) as rounds
  from raw_sessions group by season""")

_relation("expected", """
  select g.season, g.round_number, t.session_type,
         g.season || '_' || g.round_number || '_' || t.session_type as session_id
  from (select season, unnest(range(1, rounds + 1)) as round_number from season_rounds) g,
       (values ('Q'), ('R')) t(session_type)""")

_relation("loaded_sessions", "select * from raw_sessions where season < 1998")

_SCAN = {
    "sessions": "select * from raw_sessions",
    "results": "select * exclude (l_orderkey, l_linenumber, l_partkey) from raw_results",
    "laps": "select * from raw_laps",
    "pit_stops": "select * from raw_pit_stops",
    "weather": "select * from raw_weather",
    "drivers": "select * exclude (l_orderkey, l_linenumber, l_partkey) from raw_drivers",
    "circuits": "select * exclude (session_id) from raw_circuits",
}

_NANOS = {
    "LapTime": "lap_time_seconds", "Sector1Time": "sector_1_seconds",
    "Sector2Time": "sector_2_seconds", "Sector3Time": "sector_3_seconds",
    "PitInTime": "pit_in_time_seconds", "PitOutTime": "pit_out_time_seconds",
}

_START = "make_timestamp(season, round_number, 1, 0, 0, 0)"

STATEMENTS: dict[str, str] = {
    **{f"scan_raw_{feed}": sql for feed, sql in _SCAN.items()},
    **{f"raw_{feed}": sql for feed, sql in _SCAN.items()},
    "scan_source_events": """
      select season, round_number, session_type, country as "Country", location as "Location",
             circuit_key as "OfficialEventName", cast(session_date as timestamp) as "SessionDate",
             loaded_at from raw_sessions""",
    "scan_source_results": """
      select if(l_orderkey % 101 = 0, null, sid) as session_id, season,
             cast(drv as varchar) as "DriverNumber", 'D' || drv as "Abbreviation",
             'Driver ' || drv as "FullName", 'T' || tm as "TeamName",
             'C' || (drv % 5) as "CountryCode", cast(l_orderkey % 21 as varchar) as "GridPosition",
             case when l_orderkey % 37 = 0 then 'NC'
                  when l_orderkey % 50 = 0 then (1 + l_partkey % 20) || '.5'
                  else cast(1 + l_partkey % 20 as varchar) end as "Position",
             if(l_discount >= 0.09, null, l_quantity) as "Points",
             case l_returnflag when 'N' then 'Finished' when 'A' then '+1 Lap'
                  else 'Retired' end as "Status",
             cast(l_linenumber as varchar) as "Time", l_shipdate as loaded_at
      from li""",
    "scan_source_laps": f"""
      select session_id, driver_number as "DriverNumber", abbreviation as "Driver",
             cast(lap_number as double) as "LapNumber", compound as "Compound",
             tyre_life as "TyreLife", is_personal_best as "IsPersonalBest",
             track_status as "TrackStatus", loaded_at,
             {', '.join(f'cast({raw} * 1000000000 as bigint) as "{src}"' for src, raw in _NANOS.items())}
      from raw_laps""",
    "scan_source_weather": """
      select session_id,
             1000 * (epoch_us(ts) - epoch_us(make_timestamp(1995 + day(ts) % 7, 1 + day(ts) // 7, 1, 0, 0, 0))) as "Time",
             floor(value * 8) / 8 as "AirTemp", floor(value * 8) / 8 + 10 as "TrackTemp",
             cast(event_id % 100 as double) as "Humidity", event_type = 'error' as "Rainfall",
             (event_id % 80) / 8 as "WindSpeed", ts as loaded_at
      from ev""",
    "scan_source_schedule": """
      select season, round_number as "RoundNumber", cast(session_date as timestamp) as "EventDate"
      from raw_sessions where session_type = 'R'""",
    "land_by_session": _SCAN["laps"],
    "append_raw": _SCAN["results"],
    "load_sessions": """
      select * exclude (l_orderkey, l_linenumber, l_partkey) replace (timestamp '2002-01-01' as loaded_at)
      from raw_results where session_id is not null""",
    "load_counts": """
      select 'sessions' as feed, count(*) as row_count from raw_sessions
      union all select 'results', count(session_id) from raw_results
      union all select 'laps', count(*) from raw_laps
      union all select 'weather', count(*) from raw_weather
      union all select 'drivers', count(session_id) from raw_results
      union all select 'circuits', count(*) from raw_circuits
      union all select 'pit_stops', count(*) from raw_laps where pit_in_time_seconds is not null
      union all select 'without session: results', count(*) - count(session_id) from raw_results
      union all select 'without session: laps', count(*) - count(session_id) from raw_laps
      union all select 'without session: weather', count(*) - count(session_id) from raw_weather
      union all select 'without session: events', count(*) - count(session_id) from raw_sessions""",
    "load_weekend": """
      select * replace (timestamp '2002-01-01' as loaded_at) from raw_laps
      where session_id in ('1997_4_R', '1997_4_Q')""",
    "load_latest": """
      select * replace (timestamp '2002-01-01' as loaded_at) from raw_sessions s
      where round_number = (select max(o.round_number) from raw_sessions o
                            where o.season = s.season and o.session_type = 'R'
                              and o.session_date < date '1998-06-15')""",
    "reload_emptied": """
      select * replace (if(session_id like '1997%', timestamp '2003-01-01', timestamp '2002-01-01') as loaded_at)
      from raw_pit_stops
      where session_id not like '1997%' or split_part(session_id, '_', 2)::int % 2 = 0""",
    "reload_states": """
      select state, feed, count(*) as row_count
      from (
        select 'sessions' as feed, session_id from raw_sessions
        union all select 'results', session_id from raw_results
        union all select 'drivers', session_id from raw_results
        union all select 'laps', session_id from raw_laps
        union all select 'weather', session_id from raw_weather
        union all select 'pit_stops', session_id from raw_laps where pit_in_time_seconds is not null
        union all select 'circuits', session_id from raw_sessions),
        (values ('before'), ('after')) t(state)
      where session_id is not null
        and (state = 'before' or session_id not like '1997%'
             or feed in ('sessions', 'weather', 'circuits'))
      group by state, feed""",
    "batches_thrice": """
      select place, session_id, driver_number,
             if(place = 'held' and driver_number is not null, 1, count(*)) as row_count
      from (
        select distinct if(coalesce(session_id, 'test') like 'test%', 'apart', 'held') as place, *
        from (select if(l_orderkey % 13 = 0, 'test_' || session_id, session_id) as session_id,
                     if(l_orderkey % 17 = 0, null, driver_number) as driver_number,
                     abbreviation, full_name, team_name, grid_position, finish_position, points,
                     status, "time"
              from raw_results))
      group by place, session_id, driver_number""",
    "backfill_stored": _SCAN["pit_stops"],
    "stg_laps_latest": """
      select r.* from (select arg_max(x, (loaded_at, x::varchar)) as r from stg_laps x
                       group by session_id, driver_number, lap_number)""",
    "stg_sessions_latest": """
      select r.* from (select arg_max(x, (loaded_at, x::varchar)) as r from stg_sessions x
                       group by session_id)""",
    "incremental_session_append": _SCAN["pit_stops"],
    "skip_loaded_sessions": """
      select * exclude (l_orderkey, l_linenumber, l_partkey) from raw_results r
      where not exists (from loaded_sessions s where s.session_id = r.session_id)""",
    "session_id": """
      select distinct year(l_shipdate) || '_' || month(l_shipdate) || '_'
             || if(l_linestatus = 'F', 'R', 'Q') as session_id
      from lineitem""",
    "load_worklist": """
      select * from expected where session_id not in (select session_id from loaded_sessions)""",
    "weekend_worklist": "select * from expected where season = 1997 and round_number = 4",
    "latest_completed_round": """
      select season, max(if(cast(session_date as timestamp) < timestamp '1998-06-15 00:00:00',
                            round_number, null)) as latest_round
      from raw_sessions where session_type = 'R' group by season""",
    "latest_weekend_worklist": """
      select season, round_number, session_type,
             season || '_' || round_number || '_' || session_type as session_id
      from (select season, max(round_number) as round_number from raw_sessions
            where session_type = 'R' and session_date < date '1998-06-15' group by season),
           (values ('Q'), ('R')) t(session_type)""",
    "backfill_pit_stops": """
      select * from raw_pit_stops p
      where not exists (from raw_pit_stops h
                        where h.session_id = p.session_id and split_part(h.session_id, '_', 2) = '1')""",
    "lap_times_season_slice": "select * from lap_times where season = 1996 and abbreviation = 'D3'",
    "pit_lane_time": """
      select l.session_id, l.driver_number, l.abbreviation, l.lap_number,
             n.pit_out_time_seconds - l.pit_in_time_seconds as pit_lane_seconds
      from raw_laps l
      left join raw_laps n on n.session_id = l.session_id and n.driver_number = l.driver_number
                          and n.lap_number = l.lap_number + 1
      where l.pit_in_time_seconds is not null""",
    **{name: f"select * from {name}" for name in (
        "stg_sessions", "stg_results", "stg_laps", "stg_pit_stops", "stg_weather", "stg_drivers",
        "stg_circuits", "race_results", "qualifying_results", "driver_standings",
        "final_standings", "constructor_standings", "lap_times", "pit_stops", "tyre_strategy",
        "season_calendar", "race_summary", "pit_summary", "circuit_stats",
    )},
    "dq_unique": """
      select circuit_key, count(*) as row_count from raw_circuits
      where circuit_key is not null group by all having count(*) > 1""",
    "dq_not_null": """
      select * from (
        select 'session_id' as column_name, count(*) - count(session_id) as null_count from raw_results
        union all select 'finish_position', count(*) - count(finish_position) from raw_results
        union all select 'points', count(*) - count(points) from raw_results
        union all select 'status', count(*) - count(status) from raw_results)
      where null_count > 0""",
    "dq_accepted_values": """
      select status as "value", count(*) as row_count from raw_results
      where status not in ('Finished', 'Retired') group by all""",
    "dq_schema_drift": """
      select column_name, problem, declared, found, "rows"
      from (select count(*) as "rows" from raw_laps where session_id >= '1997'),
           (values ('TyreLife', 'missing', 'double', null), ('TyreAge', 'undeclared', null, 'double'),
                   ('LapNumber', 'type', 'double', 'bigint')) t(column_name, problem, declared, found)""",
    "refresh_seasons": """
      select season, count(*) as laps, if(season = 1997, 2, 1) as refresh
      from lap_times where season <> 1997 or round_number % 2 = 0 group by season""",
    "dq_missing_rounds": """
      select g.season, g.round_number, t.session_type,
             g.season || '_' || g.round_number || '_' || t.session_type as session_id
      from (select season, unnest(range(1, 13)) as round_number from season_rounds) g,
           (values ('Q'), ('R')) t(session_type)
      where not exists (from raw_sessions s
                        where s.season = g.season and s.round_number = g.round_number
                          and s.session_type = t.session_type)""",
    "dq_null_race_points": """
      select session_id, season, round_number, count(*) as null_rows
      from raw_results join raw_sessions using (session_id)
      where points is null and session_type = 'R' group by all""",
    "dq_reconcile_points": """
      select season, abbreviation, ifnull(c, 0) as computed_points, ifnull(a, 0) as adjustment_points,
             ifnull(o, 0) as official_points, ifnull(o, 0) - ifnull(c, 0) - ifnull(a, 0) as difference
      from (select season, abbreviation, final_points as c from final_standings)
      full join (select season, abbreviation, count(*)::double as a from qualifying_results group by all)
        using (season, abbreviation)
      full join (select season, 'D' || drv as abbreviation, sum(l_quantity) as o from li group by all)
        using (season, abbreviation)""",
    "dq_duplicates": """
      select session_id, driver_number, count(*) as row_count from raw_results
      where session_id is not null and driver_number is not null
      group by all having count(*) > 1""",
    "dq_orphans": """
      select session_id, count(*) as row_count from raw_results
      where session_id is not null
        and session_id not in (select session_id from loaded_sessions) group by all""",
    "dq_season_coverage": """
      select season, count(*) filter (m = 1) > 0 as in_race_results,
             count(*) filter (m = 2) > 0 as in_qualifying_results,
             count(*) filter (m = 3) > 0 as in_lap_times,
             count(*) filter (m = 4) > 0 as in_season_calendar
      from (select season, 1 as m from race_results
            union all select season, 2 from qualifying_results
            union all select season, 3 from race_laps
            union all select season, 4 from season_calendar)
      group by season""",
    "report_standings": """
      select season, final_championship_position, abbreviation, full_name, team_name, final_points,
             last_round_raced from final_standings""",
    "report_points_progression": """
      select season, abbreviation, round_number, round_points, cumulative_points,
             championship_position from driver_standings""",
    "report_gap_to_leader": """
      select season, round_number, abbreviation, cumulative_points,
             max(cumulative_points) over (partition by season, round_number) as leader_points,
             leader_points - cumulative_points as gap_to_leader
      from driver_totals""",
    "report_team_wins_dnfs": """
      select season, team_name, count(*) filter (finish_position = 1) as wins,
             count(*) filter (is_dnf) as dnfs, count(*) as starts
      from race_results group by all""",
    "report_clean_pace": """
      select season, round_number, session_id, abbreviation, count(*) as clean_laps,
             avg(lap_time_seconds) as avg_lap_time,
             quantile_cont(lap_time_seconds, 0.5) as median_lap_time,
             min(lap_time_seconds) as best_lap_time
      from lap_times where is_clean_lap group by all""",
    "report_grid_vs_finish": """
      select season, abbreviation, count(*) as races, avg(grid_position) as avg_grid,
             avg(finish_position) as avg_finish,
             cast(sum(positions_gained) as bigint) as positions_gained
      from race_results group by all""",
    "report_stints": """
      select season, round_number, session_id, abbreviation, stint_number, compound,
             stint_start_lap, stint_end_lap, stint_length from tyre_strategy""",
    "report_pit_timing": """
      select season, round_number, lap_number, count(*) as stops,
             avg(pit_duration_seconds) as avg_pit_duration
      from pit_stops group by all""",
    "catalog_leaders": """
      select season, round_number, abbreviation, cumulative_points
      from driver_standings where championship_position = 1""",
    "report_laps_where": """
      select l.season, l.round_number, c.country, l.abbreviation, count(*) as clean_laps,
             min(l.lap_time_seconds) as best_lap_time
      from lap_times l join season_calendar c
        on c.season = l.season and c.round_number = l.round_number
      where l.is_clean_lap and c.country = 'NATION_3' and c.race_date < date '1997-01-01'
      group by all""",
    "report_degradation": """
      select compound, tyre_life, count(*) as laps, avg(delta_to_driver_median) as avg_delta
      from lap_times where is_clean_lap and compound is not null and tyre_life is not null
      group by all""",
    "report_tyre_falloff": """
      select compound, laps,
             if(n * sxx - sx * sx <> 0, (n * sxy - sx * sy) / (n * sxx - sx * sx), null) as seconds_per_lap
      from (select compound, count(*) as laps, count(*)::double as n, sum(tyre_life::double) as sx,
                   sum(delta_to_driver_median) as sy,
                   sum(tyre_life::double * tyre_life) as sxx,
                   sum(tyre_life::double * delta_to_driver_median) as sxy
            from lap_times where is_clean_lap and compound is not null and tyre_life is not null
            group by all)""",
    "report_pole_to_win": """
      select location, country, races_held, pole_to_win_count, pole_to_win_pct from circuit_stats""",
    "report_avg_stops": "select location, country, avg_pit_stops_per_driver from circuit_stats",
    "orders_latest_per_customer": """
      select o_custkey, max((o_orderdate, o_orderkey))[2] as o_orderkey,
             max(o_orderdate) as o_orderdate
      from orders group by o_custkey""",
    "events_running_errors": """
      select event_id, user_id, ts,
             cast(sum(if(event_type = 'error', 1, 0)) over
                  (partition by user_id order by ts, event_id rows unbounded preceding) as bigint)
               as errors_so_far
      from events""",
    "events_signup_islands": """
      select user_id, stretch, count(*) as events, min(event_id) as first_event,
             max(event_id) as last_event
      from (select user_id, event_id,
                   cast(count(*) filter (event_type = 'signup') over
                        (partition by user_id order by ts, event_id rows unbounded preceding) as bigint)
                     as stretch
            from events)
      group by all""",
    "events_sequence": """
      select event_id, user_id,
             row_number() over (partition by user_id order by ts, event_id) as event_number
      from events""",
    "orders_rank_by_priority": """
      select o_orderkey, o_orderpriority, o_totalprice,
             rank() over (partition by o_orderpriority order by o_totalprice desc) as price_rank
      from orders""",
    "lines_delta_to_median": """
      select l_orderkey, l_linenumber, l_suppkey, l_quantity,
             l_quantity - quantile_cont(l_quantity, 0.5) over (partition by l_suppkey) as delta_to_median
      from lineitem""",
    "lines_next_line": """
      select a.l_orderkey, a.l_linenumber, a.l_partkey, b.l_partkey as next_partkey
      from lineitem a left join lineitem b
        on b.l_orderkey = a.l_orderkey and b.l_linenumber = a.l_linenumber + 1""",
    "orders_without_lines": """
      select o_orderkey, o_custkey from orders
      where o_orderkey not in (select l_orderkey from lineitem where l_orderkey is not null)""",
}


for _blocks, _plain in {
    "events_running_errors_blocks": "events_running_errors",
    "orders_rank_blocks": "orders_rank_by_priority",
    "lines_delta_to_median_blocks": "lines_delta_to_median",
    "lap_times_blocks": "lap_times",
    "lap_times_cuts": "lap_times",
    "tyre_strategy_cuts": "tyre_strategy",
    "lap_times_stored": "lap_times",
    "tyre_strategy_stored": "tyre_strategy",
    "events_running_errors_cuts": "events_running_errors",
    "lines_delta_to_median_cuts": "lines_delta_to_median",
    "lap_times_in_buckets": "lap_times",
    "tyre_strategy_in_buckets": "tyre_strategy",
    "pit_stops_in_buckets": "pit_stops",
    "catalog_created": "scan_raw_circuits",
    "dq_watched_nulls": "dq_not_null",
    "dq_watched_values": "dq_accepted_values",
    "dq_watched_coverage": "dq_season_coverage",
    "refresh_lap_times": "lap_times",
}.items():
    STATEMENTS[_blocks] = STATEMENTS[_plain]


def statements() -> dict[str, str]:
    return {name: query(sql) for name, sql in STATEMENTS.items()}

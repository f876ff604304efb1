"""Tables by name, laps in buckets, and seasons pruned through a join."""

from __future__ import annotations

import contextlib
import io
import re
import uuid

import pytest
from pyspark.sql import functions as F

from trackside import fixtures
from trackside.plans import reports
from trackside.schemas import RAW
from trackside.session import scratch_path
from trackside.sources import catalog


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def tree(df):
    """The operators of the plan, one a line, without their details."""
    return plan(df).split("\n\n")[0]


@pytest.fixture(scope="module")
def made(spark, small_dir):
    feeds = fixtures.RawFeeds(spark, small_dir).keep(scratch_path(spark, "raw"), "laps")
    return fixtures.pipeline(feeds).keep(scratch_path(spark, "kept"), "stg_sessions", "stg_pit_stops")


@pytest.fixture
def database():
    return f"d_{uuid.uuid4().hex[:12]}"


@pytest.fixture
def in_buckets(spark, small_dir, database):
    feeds = fixtures.RawFeeds(spark, small_dir).keep(scratch_path(spark, "raw"), "laps")
    kept = fixtures.pipeline(feeds).keep(scratch_path(spark, "kept"), "stg_sessions", "stg_pit_stops")
    yield kept.bucket_laps(database, scratch_path(spark, "buckets"), 8)
    spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")


def _above_laps(df):
    """The operators between the bucketed scan and the root."""
    lines = tree(df).split("\n")
    at = next(i for i, line in enumerate(lines) if "Scan parquet" in line and "stg_laps" in line)
    depth, path = len(re.match(r"[\s:|+\-]*", lines[at]).group()), []
    for line in reversed(lines[:at]):
        here = len(re.match(r"[\s:|+\-]*", line).group())
        if here < depth:
            path.append(line)
            depth = here
    return "\n".join(path)


@pytest.mark.parametrize("name", ["lap_times", "tyre_strategy", "pit_stops"])
def test_laps_in_buckets_do_not_move(made, in_buckets, name):
    spark = made.stg_sessions.sparkSession
    if name == "pit_stops":
        # Also where the stops are too many to be sent to all tasks.
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "5000")
    try:
        bucketed = getattr(in_buckets, name)
        above = _above_laps(bucketed)
        assert "Exchange" not in above and above
        assert sorted(map(repr, bucketed.collect())) == sorted(map(repr, getattr(made, name).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_raw_tables_are_declared_once_and_appended_by_name(spark, database):
    path = scratch_path(spark, "catalog")
    catalog.create_raw_tables(spark, database, path)
    rows = spark.createDataFrame([("l", "k", "c", "n")], "location string, circuit_key string, country string, circuit_name string")
    catalog.append(rows.withColumn("loaded_at", F.current_timestamp()), database, "raw_circuits")
    catalog.create_raw_tables(spark, database, path)
    stored = spark.sql(f"select * from {database}.raw_circuits")
    assert stored.schema == RAW["circuits"] and stored.first()[:4] == ("k", "n", "c", "l")
    assert {t.name for t in spark.catalog.listTables(database)} == {f"raw_{feed}" for feed in RAW}
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        catalog.append(rows, database, "raw_nothing")


def test_partitioned_tables(spark, database):
    path = scratch_path(spark, "catalog")
    catalog.create_database(spark, database, path)
    catalog.create_table(spark, database, "t", RAW["sessions"], path, ["season"])
    rows = [("2024_1_R", 2024, 1, "C", "L", "K", "R", None, None), ("2023_1_R", 2023, 1, "C", "L", "K", "R", None, None)]
    catalog.append(spark.createDataFrame(rows, RAW["sessions"]), database, "t")
    one = spark.sql(f"select session_id from {database}.t where season = 2024")
    assert [r[0] for r in one.collect()] == ["2024_1_R"]
    assert re.search(r"PartitionFilters: \[.*season.* = 2024", plan(one))


def test_a_published_mart_switches_versions_and_has_statistics(spark, database):
    path, kinds = scratch_path(spark, "catalog"), "season bigint, v int"
    for n in (1, 2, 3):
        rows = spark.createDataFrame([(2024, i) for i in range(n)], kinds)
        stored = catalog.publish(rows, database, "mart", path, ["season"], analyse=["v"])
        assert stored.count() == n == spark.sql(f"select count(*) from {database}.mart").first()[0]
    tables = sorted(t.name for t in spark.catalog.listTables(database) if t.name != "mart")
    assert len(tables) == 2
    known = spark.sql(f"describe extended {database}.{tables[-1]}").collect()
    assert any(r[0] == "Statistics" and "3 rows" in r[1] for r in known)


def test_a_failed_publication_leaves_the_mart(spark, database):
    path = scratch_path(spark, "catalog")
    catalog.publish(spark.range(4), database, "mart", path)
    with pytest.raises(Exception, match="lost"):
        catalog.publish(spark.range(9).selectExpr("id + raise_error('lost') as id"), database, "mart", path)
    assert spark.table(f"{database}.mart").count() == 4


def test_seasons_are_pruned_by_the_calendar(spark, made):
    kept = made.keep(scratch_path(spark, "pruned"), "lap_times", "season_calendar")
    where = (F.col("country") == "NATION_3") & (F.col("race_date") < "1997-01-01")
    report = reports.laps_where(kept.lap_times, kept.season_calendar, where)
    filters = re.findall(r"PartitionFilters: \[(.*)\]", plan(report))
    assert any("dynamicpruning" in f and "season" in f for f in filters)
    assert {r.season for r in report.select("season").distinct().collect()} <= {1995, 1996}

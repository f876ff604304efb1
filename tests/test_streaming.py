from __future__ import annotations

from datetime import datetime

from trackside.schemas import NATURAL_KEYS, RAW
from trackside.session import scratch_path
from trackside.sources import batches, landing, storage
from trackside.streaming import incremental_session_append

STAMP = datetime(2024, 3, 1)


def test_sessions_are_appended_once(spark):
    root = scratch_path(spark, "stream")

    def land(*stops):
        rows = [(f"2024_{s}_R", "1", "D1", n, n, 2.0, STAMP) for s, n in stops]
        spark.createDataFrame(rows, RAW["pit_stops"]).write.mode("append").parquet(f"{root}/landing")

    def run(progress="progress"):
        incremental_session_append(
            spark, f"{root}/landing", f"{root}/table", f"{root}/{progress}", RAW["pit_stops"],
            NATURAL_KEYS["pit_stops"],
        ).awaitTermination()
        table = batches.read(spark, f"{root}/table", RAW["pit_stops"])
        return sorted((r.session_id, r.stop_number) for r in table.collect())

    land((1, 1), (1, 2), (1, 2))
    first = [("2024_1_R", 1), ("2024_1_R", 2)]
    assert run() == first
    assert run() == first
    land((1, 1), (2, 1))
    assert run() == [*first, ("2024_2_R", 1)]
    # A second file of a session that is loaded already.
    land((2, 2), (2, 3))
    assert run() == [*first, ("2024_2_R", 1), ("2024_2_R", 2), ("2024_2_R", 3)]
    # All files again, as after lost progress: nothing is doubled.
    assert run("other") == [*first, ("2024_2_R", 1), ("2024_2_R", 2), ("2024_2_R", 3)]


PIT, KEYS = RAW["pit_stops"], NATURAL_KEYS["pit_stops"]
ODD = [
    ("2024_1_R", "1", "D1", 1, 5, 2.0, STAMP),
    ("2024_1_R", "1", "D1", 1, 5, 2.5, datetime(2024, 3, 2)),  # the latest of a key
    ("2024_1_R", None, "D1", 1, 5, 2.0, STAMP), ("2024_1_R", None, "D1", 1, 5, 2.0, STAMP),
    ("2024_1_R", None, "D1", 1, 6, 2.0, STAMP), ("2024_1_R", "1", None, None, None, None, None),
    (None, "1", "D1", 1, 5, 2.0, STAMP), (None, "1", "D1", 1, 5, 2.0, STAMP), (None, None, None, None, None, None, None),
    ("sprint", "1", "D1", 1, 5, 2.0, STAMP), ("", "1", "D1", 1, 5, 2.0, STAMP), ("_1_R", "1", "D1", 1, 5, 2.0, STAMP),
]


def _state(spark, path):
    return [sorted(map(repr, read(spark, path, PIT).collect())) for read in (batches.read, batches.unplaced)]


def test_the_same_batch_three_times_is_once(spark):
    """Null, malformed and ordinary rows, under the same name and under others."""
    path, rows = scratch_path(spark, "table"), spark.createDataFrame(ODD, PIT)
    assert batches.add(rows, path, PIT, KEYS, "a")
    once = _state(spark, path)
    assert [len(x) for x in once] == [4, 5]
    assert not batches.add(rows, path, PIT, KEYS, "a")
    for name in ("b", "c"):
        assert batches.add(rows.repartition(3), path, PIT, KEYS, name)
        assert _state(spark, path) == once
    assert sorted(tuple(r) for r in batches.ledger(spark, path).collect()) == [("a", 4, 5), ("b", 0, 0), ("c", 0, 0)]


def test_a_batch_killed_before_its_ledger_line_is_not_seen_and_is_added_again(spark):
    path, rows = scratch_path(spark, "table"), spark.createDataFrame(ODD, PIT)
    batches.add(rows.limit(1), path, PIT, KEYS, "a")
    before = _state(spark, path)
    batches.add(rows, path, PIT, KEYS, "b")
    after = _state(spark, path)
    storage.delete(spark, f"{path}/ledger/batch=b/_SUCCESS")
    assert _state(spark, path) == before
    assert batches.add(rows, path, PIT, KEYS, "b")
    assert _state(spark, path) == after


def test_a_stream_keeps_odd_rows_once(spark):
    root = scratch_path(spark, "stream")
    for progress in ("progress", "progress", "lost"):
        spark.createDataFrame(ODD, PIT).write.mode("append").parquet(f"{root}/landing")
        incremental_session_append(
            spark, f"{root}/landing", f"{root}/raw_pit_stops", f"{root}/{progress}", PIT, KEYS
        ).awaitTermination()
    assert [len(x) for x in _state(spark, f"{root}/raw_pit_stops")] == [4, 5]
    assert landing.read_raw(spark, root, "pit_stops").count() == 4


def test_an_empty_batch(spark):
    path = scratch_path(spark, "table")
    assert batches.add(spark.createDataFrame([], PIT), path, PIT, KEYS, "a")
    assert batches.read(spark, path, PIT).count() == batches.unplaced(spark, path, PIT).count() == 0


def test_only_rows_loaded_last_of_keys_not_held_are_ranked(spark, monkeypatch):
    """Ranking sorts its rows, so those that cannot be the one of their key stay out of it."""
    ranked, rank = [], batches.latest_by_key

    def counted(df, *args):
        ranked.append(df.count())
        return rank(df, *args)

    monkeypatch.setattr(batches, "latest_by_key", counted)
    path = scratch_path(spark, "table")
    rows = spark.createDataFrame([*ODD, ("2024_1_R", "1", "D1", 1, 6, 2.5, datetime(2024, 3, 2))], PIT)
    batches.add(rows, path, PIT, KEYS, "a")
    batches.add(rows, path, PIT, KEYS, "b")
    # Two keys, each with one row of the latest time; the second time both are held.
    assert ranked == [2, 0]
    assert not storage.children(spark, f"{path}/newest/")


def test_unknown_load_times_and_zeros_with_a_sign(spark):
    path = scratch_path(spark, "table")
    rows = [
        ("2024_1_R", "1", "D1", 1, 5, -0.0, None), ("2024_1_R", "1", "D1", 1, 5, None, None),
        ("2024_1_R", None, "D1", 1, 5, -0.0, STAMP), ("2024_1_R", None, "D1", 1, 5, -0.0, None),
        ("no", None, "D1", 1, 5, -0.0, None),
    ]
    for name in ("a", "b"):
        batches.add(spark.createDataFrame(rows, PIT), path, PIT, KEYS, name)
    held, apart = _state(spark, path)
    assert len(held) == 2 and len(apart) == 1
    assert all("=-0.0" in x for x in [*held, *apart])
    assert sum("loaded_at=None" in x for x in held) == 1

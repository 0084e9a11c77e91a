import pytest
from conftest import SF_DIR, plan_of
from pyspark.sql import functions as F

from headway.functions import from_hour, with_event_parts
from headway.operators import incremental
from headway.operators.incremental import UpsertSpec, newest_hour, rows_after, upsert_latest
from headway.plans.marts import DEDUP, dedup_latest
from headway.sinks.tables import append_silver, read_table
from workload import fixtures as fx

SPEC = UpsertSpec(keys=("trip_id", "year", "month", "day", "hour"))
HOUR = 1705266000


def silver(rows, data, extra=""):
    return with_event_parts(rows(data, "trip_id string, source_timestamp bigint, v int" + extra))


def contents(spark, path):
    return sorted((r.trip_id, r.source_timestamp - HOUR, r.v) for r in read_table(spark, path).collect())


def test_replace_skip_and_keep(spark, rows, tmp_path):
    target = str(tmp_path / "t")
    first = silver(rows, [("a", HOUR + 10, 1), ("a", HOUR + 20, 2), ("b", HOUR + 50, 3), ("c", HOUR - 3600, 4)])
    assert upsert_latest(spark, first, target, SPEC) is None
    assert contents(spark, target) == [("a", 20, 2), ("b", 50, 3), ("c", -3600, 4)]

    second = silver(
        rows,
        [("a", HOUR + 60, 5), ("b", HOUR + 50, 6), ("a", HOUR + 40, 7), ("c", HOUR - 3000, 8), ("d", HOUR + 7200, 9)],
    )
    assert upsert_latest(spark, second, target, SPEC) == HOUR + 50
    after = [("a", 60, 5), ("b", 50, 3), ("c", -3600, 4), ("d", 7200, 9)]
    assert contents(spark, target) == after

    assert upsert_latest(spark, second, target, SPEC) == HOUR + 7200
    assert contents(spark, target) == after


def test_first_run_on_an_empty_source(spark, rows, tmp_path):
    target = str(tmp_path / "t")
    upsert_latest(spark, silver(rows, []), target, SPEC)
    upsert_latest(spark, silver(rows, [("a", HOUR, 1)]), target, SPEC)
    assert contents(spark, target) == [("a", 0, 1)]


def test_new_columns_are_appended(spark, rows, tmp_path):
    target = str(tmp_path / "t")
    upsert_latest(spark, silver(rows, [("a", HOUR, 1), ("b", HOUR - 3600, 2), ("c", HOUR, 1)]), target, SPEC)
    upsert_latest(spark, silver(rows, [("a", HOUR + 5, 3, "x")], ", note string"), target, SPEC)
    got = read_table(spark, target).select("trip_id", "v", "note").collect()
    assert sorted(tuple(r) for r in got) == [("a", 3, "x"), ("b", 2, None), ("c", 1, None)]


def test_incremental_equals_full_with_unusable_clocks_and_late_rows(spark, rows, tmp_path):
    early = [("a", HOUR, 1), ("x", 9_000_000_000_000_000, 2), ("y", None, 2), ("z", None, 9)]
    late = [("b", HOUR + 1, 3), ("w", 9_000_000_000_000_000, 2), ("y", None, 5), ("c", HOUR - 4000, 6), ("a", HOUR - 20, 7)]
    whole, parts = str(tmp_path / "whole"), str(tmp_path / "parts")
    spec = UpsertSpec(keys=SPEC.keys, late_seconds=7200)
    upsert_latest(spark, silver(rows, early + late), whole, spec)
    upsert_latest(spark, silver(rows, early), parts, spec)
    assert upsert_latest(spark, silver(rows, late), parts, spec) == HOUR - 7200
    assert contents(spark, parts) == contents(spark, whole)
    assert {row[0] for row in contents(spark, parts)} == {"a", "b", "c"}


def test_empty_hour_folders_are_passed_over(spark, rows, tmp_path):
    target = tmp_path / "t"
    upsert_latest(spark, silver(rows, [("a", HOUR, 1)]), str(target), SPEC)
    (target / "year=2024" / "month=2" / "day=1").mkdir(parents=True)
    assert newest_hour(spark, str(target)).count() == 1


def test_a_lost_driver_between_staging_and_publishing(spark, rows, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    upsert_latest(spark, silver(rows, [("a", HOUR, 1)]), target, SPEC)
    with monkeypatch.context() as broken:

        def lost(*_):
            raise RuntimeError("driver lost")

        broken.setattr(incremental, "publish_hours", lost)
        try:
            upsert_latest(spark, silver(rows, [("b", HOUR + 9, 2)]), target, SPEC)
        except RuntimeError:
            pass
    assert contents(spark, target) == [("a", 0, 1)]
    assert upsert_latest(spark, silver(rows, [("c", HOUR + 20, 3)]), target, SPEC) == HOUR + 9
    assert contents(spark, target) == [("a", 0, 1), ("b", 9, 2), ("c", 20, 3)]


def test_a_lost_driver_during_the_first_load(spark, rows, tmp_path):
    target = str(tmp_path / "t")
    upsert_latest(spark, silver(rows, [("half", HOUR + 7200, 1)]), target, SPEC)
    (tmp_path / "t_loading").mkdir()
    assert upsert_latest(spark, silver(rows, [("a", HOUR, 1), ("b", HOUR + 9, 2)]), target, SPEC) is None
    assert contents(spark, target) == [("a", 0, 1), ("b", 9, 2)]
    assert not (tmp_path / "t_loading").exists()


def test_a_driver_lost_while_hours_are_moved(spark, rows, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    upsert_latest(spark, silver(rows, [("a", HOUR, 1)]), target, SPEC)
    move, moved = incremental.move, []

    def lost_after_one(*folders):
        if moved:
            raise RuntimeError("driver lost")
        moved.append(folders)
        move(*folders)

    with monkeypatch.context() as broken:
        broken.setattr(incremental, "move", lost_after_one)
        with pytest.raises(RuntimeError):
            upsert_latest(spark, silver(rows, [("b", HOUR + 9, 2), ("c", HOUR + 3600, 3)]), target, SPEC)
    assert upsert_latest(spark, silver(rows, []), target, SPEC) == HOUR + 3600
    assert contents(spark, target) == [("a", 0, 1), ("b", 9, 2), ("c", 3600, 3)]


def test_increment_reads_only_its_partitions(spark, rows, tmp_path):
    path = str(tmp_path / "silver")
    append_silver(silver(rows, [(str(i), HOUR + i * 3600, i) for i in range(6)]), path)
    late = rows_after(read_table(spark, path), HOUR + 4 * 3600)
    assert [r.trip_id for r in late.collect()] == ["5"]
    line = next(text for text in plan_of(late).splitlines() if "PartitionFilters" in text)
    assert "PartitionFilters: []" not in line and "GreaterThan(source_timestamp" in line
    assert read_table(spark, path).filter(from_hour(HOUR + 5 * 3600)).count() == 1
    assert newest_hour(spark, path).select(F.max("source_timestamp")).first()[0] == HOUR + 5 * 3600


def test_many_small_runs_equal_one_full_run(spark, tmp_path):
    updates = fx.silver_updates(spark, SF_DIR).filter("source_timestamp % 2 = 0").cache()
    first, last = updates.agg(F.min("source_timestamp"), F.max("source_timestamp")).first()
    target = str(tmp_path / "t")
    for end in range(first, last + 1, (last - first) // 3 + 1):
        upto = updates.filter(F.col("source_timestamp") <= end)
        upsert_latest(spark, upto, target, DEDUP)
    upsert_latest(spark, updates, target, DEDUP)
    columns = updates.columns
    got = sorted(map(str, read_table(spark, target).select(columns).collect()))
    assert got == sorted(map(str, dedup_latest(updates).select(columns).collect()))

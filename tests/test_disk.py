"""What refreshes and landings leave on the executors' disks and in the shared folder while they run."""

import os
import time

import pytest
from conftest import SF_DIR, plan_of
from pyspark.sql import functions as F
from test_refresh import HOUR, in_silver, random_rows

from headway.operators.incremental import UpsertSpec, plan_upsert, upsert_latest
from headway.plans import marts
from headway.plans.marts import DEDUP_KEYS, dedup_latest, refresh_tables
from headway.schemas import SILVER_TRIP_UPDATES
from headway.session import shared_dir
from headway.sinks.tables import append_silver, read_table, replace_mart
from workload import queries


def shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {name for folder in folders for _, _, names in os.walk(str(folder)) for name in names if name.startswith("shuffle_")}


@pytest.mark.parametrize("write", [append_silver, lambda rows, path: upsert_latest(rows.sparkSession, rows, path, marts.DEDUP), replace_mart])
def test_the_shuffles_of_a_write_go_when_it_ends(spark, tmp_path, write):
    rows = in_silver(spark, random_rows(11, 60, HOUR, HOUR + 9000))
    before = shuffle_files(spark)
    write(rows.repartition(3, "trip_id"), str(tmp_path / "t"))
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


@pytest.mark.parametrize("name", ["late_rows", "late_refresh", "schema_growth_refresh", "stop_hourly_refresh", "route_hourly_refresh"])
def test_the_rows_of_two_landings_are_stored_until_the_second(spark, monkeypatch, name):
    landed, appended = [], []
    append = queries.append_silver

    def landings():
        return {child for child in os.listdir(shared_dir(spark).removeprefix("file:")) if child.startswith("landing-")}

    def fold(*_args, **_kept):
        landed.append(len(landings()))

    monkeypatch.setattr(queries, "append_silver", lambda rows, path: appended.append((plan_of(rows), rows.count())) or append(rows, path))
    monkeypatch.setattr(marts, "refresh_marts", fold)
    monkeypatch.setattr(queries, "upsert_latest", fold)
    with pytest.raises(Exception, match="nothing was written|PATH_NOT_FOUND"):
        queries.all_queries()[name](spark, SF_DIR)
    assert landed == [1, 0]
    assert len(appended) == 2 and all(n and "Join" not in plan and "Scan parquet" in plan for plan, n in appended)


def test_counts_of_new_hours_come_from_what_is_staged(spark, tmp_path, monkeypatch):
    """No row of an hour that was not stored before is kept or ranked for its count."""
    target, data, seen = str(tmp_path / "gold"), random_rows(12, 50, HOUR, HOUR + 4000), []
    refresh_tables(spark, in_silver(spark, data), target)
    weighed = marts.weighed_counts
    monkeypatch.setattr(marts, "weighed_counts", lambda rows, weight: seen.append(rows) or weighed(rows, weight))
    plans = []
    stage = marts.stage_jointly
    monkeypatch.setattr(marts, "stage_jointly", lambda rows, path: plans.append([(plan_of(s), s.inputFiles()) for s in seen]) or stage(rows, path))
    refresh_tables(spark, in_silver(spark, data + random_rows(13, 80, HOUR + 3000, HOUR + 20000)), target)
    assert len(seen) == 1 and plans[0] == []
    plan, files = plans[1][0]
    assert "Window" not in plan.split("InMemoryRelation")[0] and any("/trip_updates_deduped_joint/" in file for file in files)
    deduped = read_table(spark, f"{target}/trip_updates_deduped", schema=SILVER_TRIP_UPDATES)
    counted = read_table(spark, f"{target}/stop_counts").agg(F.sum("total_stops")).first()[0]
    assert counted == deduped.count()


@pytest.mark.parametrize("ties", [None, ("stop_id", "mode", "delay_seconds")])
def test_late_rows_join_no_row_of_a_new_hour(spark, tmp_path, ties):
    target, spec = str(tmp_path / "t"), UpsertSpec(keys=DEDUP_KEYS, ties=ties, late_seconds=8000)
    data = random_rows(14, 80, HOUR, HOUR + 7000)
    upsert_latest(spark, in_silver(spark, data), target, spec)
    # Late rows may be older than the stored ones of their keys, as old, or newer; some are stored already.
    data += random_rows(15, 120, HOUR, HOUR + 20000)
    silver = in_silver(spark, data)
    kept, once = (plan_upsert(spark, silver, target, spec, keep=keep) for keep in (True, False))
    columns = [f.name for f in SILVER_TRIP_UPDATES]
    content = lambda df: sorted(map(str, df.select(columns).collect()))
    expected = content(dedup_latest(silver, ties))
    assert content(once.rows) == content(kept.rows) == expected
    assert "Join LeftAnti" not in plan_of(once.rows) and "LeftAnti" not in plan_of(kept.rows)
    assert set(content(once.gained)) == set(content(kept.gained)) and content(once.lost) == content(kept.lost)
    left = [row for row in content(read_table(spark, target)) if row not in content(kept.lost)]
    assert sorted(left + content(kept.gained)) == expected
    kept.done()

"""Refreshes by difference, marks from footers, snapshot schemas, versions and closed hours."""

import random

import pytest
from conftest import SF_DIR, plan_of
from pyspark.sql import functions as F

from headway.functions import with_event_parts
from headway.operators import incremental
from headway.operators.incremental import UpsertSpec, footer_max, footer_scan, plan_upsert, stored_mark, upsert_latest
from headway.operators.key_filter import key_bits, may_match, only_matching
from headway.plans import marts
from headway.plans.marts import DEDUP, dedup_latest, refresh_marts, refresh_tables
from headway.schemas import SILVER_TRIP_UPDATES
from headway.sinks import closed, versions
from headway.sinks.closed import close_hours, read_silver
from headway.sinks.tables import append_silver, read_mart, read_table
from headway.sinks.versions import Versions
from headway.sources import static
from headway.sources.static import append_snapshot, read_newest_snapshots, read_snapshots
from workload import queries

HOUR = 1705266000
SILVER = "trip_id string, route_id string, stop_sequence int, stop_id string, mode string, source_timestamp bigint, delay_seconds bigint"


def in_silver(spark, data):
    rows = with_event_parts(spark.createDataFrame(data, SILVER))
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in SILVER_TRIP_UPDATES if f.name not in rows.columns]
    return rows.select("*", *missing).select(SILVER_TRIP_UPDATES.names)


def random_rows(seed, n, first, last):
    rng = random.Random(seed)
    pick = rng.choice
    return [
        (pick("abc"), pick(["r", None]), pick([1, 2, None]), pick(["s", "t", None]), pick(["bus", "tram"]), rng.randint(first, last),
         pick([5, 40, None]))
        for _ in range(n)
    ]


def counts_of(spark, target, name, key):
    stored = read_table(spark, f"{target}/{name}")
    return sorted(map(str, stored.select(key, *marts.HOUR, "total_stops", "on_time_stops").collect()))


def expected_counts(deduped, key):
    counted = marts.hourly_counts(deduped, key).select(key, *marts.HOUR, "total_stops", "on_time_stops")
    return sorted(map(str, counted.withColumn("on_time_stops", F.col("on_time_stops")).collect()))


def test_counts_by_difference_equal_counting_everything(spark, tmp_path):
    """Late rows, replaced delays and stops, NULL keys; after each refresh the counts are those of the whole table."""
    target, so_far = str(tmp_path / "gold"), []
    for run, (first, last) in enumerate([(0, 9000), (7000, 15000), (10000, 15000), (15000, 20000)]):
        fresh = random_rows(run, 60, HOUR + first, HOUR + last)
        so_far += fresh
        refresh_tables(spark, in_silver(spark, so_far), target, late_seconds=6000)
        deduped = read_table(spark, f"{target}/trip_updates_deduped", schema=SILVER_TRIP_UPDATES)
        if run in (0, 2):  # later runs skip rows that come too late
            columns = [f.name for f in SILVER_TRIP_UPDATES]
            whole = dedup_latest(in_silver(spark, so_far)).select(columns)
            assert sorted(map(str, deduped.select(columns).collect())) == sorted(map(str, whole.collect()))
        for name, key in marts.COUNTS.items():
            assert counts_of(spark, target, name, key) == expected_counts(deduped, key)


@pytest.mark.parametrize("lost_at", ["staging", "publishing"])
def test_counts_and_rows_change_together(spark, tmp_path, monkeypatch, lost_at):
    target = str(tmp_path / "gold")
    data = random_rows(1, 40, HOUR, HOUR + 4000)
    refresh_tables(spark, in_silver(spark, data), target)
    more = data + random_rows(2, 40, HOUR + 3000, HOUR + 9000)
    calls = []

    def lost(real):
        def call(*args):
            calls.append(args)
            if len(calls) > 2:
                raise RuntimeError("driver lost")
            return real(*args)

        return call

    name = "_write_hours" if lost_at == "staging" else "move"
    with monkeypatch.context() as broken:
        broken.setattr(incremental, name, lost(getattr(incremental, name)))
        with pytest.raises(RuntimeError):
            refresh_tables(spark, in_silver(spark, more), target)
    refresh_tables(spark, in_silver(spark, more), target)
    deduped = read_table(spark, f"{target}/trip_updates_deduped", schema=SILVER_TRIP_UPDATES)
    accepted = [r for r in more if r in data or r[5] > max(x[5] for x in data)]
    assert deduped.count() == dedup_latest(in_silver(spark, accepted)).count()
    for name, key in marts.COUNTS.items():
        assert counts_of(spark, target, name, key) == expected_counts(deduped, key)
    assert not [p.name for p in (tmp_path / "gold").iterdir() if p.name.endswith(("_joint", "_staged"))]


def test_a_refresh_does_not_count_stored_rows_again(spark, tmp_path, monkeypatch):
    target, data = str(tmp_path / "gold"), random_rows(3, 50, HOUR, HOUR + 4000)
    refresh_tables(spark, in_silver(spark, data), target)
    monkeypatch.setattr(marts, "recount", None)
    monkeypatch.setattr(marts, "upsert_latest", None)
    refresh_tables(spark, in_silver(spark, data + random_rows(4, 9, HOUR + 4001, HOUR + 9000)), target)
    deduped = read_table(spark, f"{target}/trip_updates_deduped", schema=SILVER_TRIP_UPDATES)
    assert counts_of(spark, target, "stop_counts", "stop_id") == expected_counts(deduped, "stop_id")


def test_recounting_reads_no_older_hour(spark, tmp_path, monkeypatch):
    """Without joint publication, counts are made up from the newest counted hour on."""
    target, data = str(tmp_path / "gold"), random_rows(6, 60, HOUR, HOUR + 8000)
    deduped = lambda rows: dedup_latest(in_silver(spark, rows))
    marts.recount(deduped(data), target)
    more = data + random_rows(7, 60, HOUR + 7200, HOUR + 16000)
    seen = []
    weighed = marts.weighed_counts
    monkeypatch.setattr(marts, "weighed_counts", lambda rows, weight: seen.append(rows.count()) or weighed(rows, weight))
    marts.recount(deduped(more), target)
    assert 0 < seen[0] < deduped(more).count()
    for name, key in marts.COUNTS.items():
        assert counts_of(spark, target, name, key) == expected_counts(deduped(more), key)


def test_late_rows_through_the_production_refresh(spark, tmp_path):
    base = str(tmp_path)
    for name, columns in {"stops": "stop_id string, stop_name string", "trips": "trip_id string, route_id string",
                          "routes": "route_id string, route_short_name string, route_long_name string"}.items():
        spark.createDataFrame([], f"{columns}, ingested_at timestamp").write.parquet(f"{base}/static/{name}")
    on_time = [("a", "r", 1, "s", "bus", HOUR + 60, 0)]
    late = [("b", "r", 1, "s", "bus", HOUR + 5, 0), ("c", "r", 1, "s", "bus", HOUR - 7200, 0)]
    totals = {}
    for seconds in (0, 3600):
        silver, gold = f"{base}/silver{seconds}", f"{base}/gold{seconds}"
        append_silver(in_silver(spark, on_time), silver)
        refresh_marts(spark, silver, f"{base}/static", gold, late_seconds=seconds)
        append_silver(in_silver(spark, late), silver)
        refresh_marts(spark, silver, f"{base}/static", gold, late_seconds=seconds)
        totals[seconds] = read_mart(spark, f"{gold}/stop_hourly").agg(F.sum("total_stops")).first()[0]
    assert totals == {0: 1, 3600: 2}


# --- Upsert by changed keys


def test_rows_that_nothing_replaces_are_not_sorted(spark, tmp_path):
    target = str(tmp_path / "t")
    spec = UpsertSpec(keys=("trip_id", "year", "month", "day", "hour"))
    stored = with_event_parts(spark.range(20_000).selectExpr("CAST(id AS STRING) trip_id", f"{HOUR} + id % 60 AS source_timestamp"))
    upsert_latest(spark, stored, target, spec)
    fresh = with_event_parts(spark.createDataFrame([("7", HOUR + 100), ("new", HOUR + 101)], "trip_id string, source_timestamp bigint"))
    planned = plan_upsert(spark, fresh, target, spec)
    assert sorted(r.trip_id for r in planned.gained.collect()) == ["7", "new"]
    assert [(r.trip_id, r.source_timestamp) for r in planned.lost.collect()] == [("7", HOUR + 7)]
    assert len(planned.rows.collect()) == 20_001
    plan = plan_of(planned.rows)
    final = plan.split("Initial Plan")[0]
    # Windows rank the new rows, once for writing and once for comparing; the stored ones meet no sort and no shuffle.
    assert "SortMergeJoin" not in final and final.count("row_number") and final.count("- Window ") == 2, final
    planned.done()


def test_key_filter_keeps_every_partner(spark):
    keys = spark.range(3000).selectExpr("IF(id = 5, NULL, CAST(id * 7 AS INT)) AS a", "CAST(id % 3 AS STRING) AS b")
    rows = spark.range(60_000).selectExpr("IF(id = 1, NULL, id) AS a", "CAST(id % 3 AS STRING) AS b", "id AS _word")
    bits = key_bits(keys, ["a", "b"])
    kept = only_matching(rows, bits, ["a", "b"])
    assert kept.columns == ["a", "b", "_word"]
    partners = rows.join(keys, [rows.a.eqNullSafe(keys.a), rows.b == keys.b], "left_semi")
    assert partners.exceptAll(kept).count() == 0 and kept.count() < 6000
    assert may_match(rows, key_bits(keys.limit(0), ["a", "b"]), ["a", "b"], "m").filter("m").count() == 0


# --- Marks from footers


def test_the_mark_reads_no_row_group(spark, tmp_path):
    path = str(tmp_path / "silver")
    append_silver(in_silver(spark, random_rows(5, 90, HOUR - 9000, HOUR + 2000)), path)
    expected = read_table(spark, path).agg(F.max("source_timestamp")).first()[0]
    assert stored_mark(spark, path, "source_timestamp") == expected
    folder = next(incremental.hour_folders(spark, path))
    assert "PushedAggregation: [MAX(source_timestamp)]" in footer_scan(spark, folder, "source_timestamp")._jdf.queryExecution().toString()
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_marks_of_empty_and_null_files(spark, tmp_path):
    frames = {"empty": "id < 0", "null": "id = 99", "some": "id <= 99"}
    for name, condition in frames.items():
        rows = spark.range(100).filter(condition).selectExpr("IF(id = 99, NULL, id) AS mark").coalesce(1)
        rows.write.parquet(str(tmp_path / name))
    assert [footer_max(spark, str(tmp_path / name), "mark") for name in frames] == [None, None, 98]
    rows.write.mode("append").parquet(str(tmp_path / "null"))
    assert footer_max(spark, str(tmp_path / "null"), "mark") == 98
    with pytest.raises(Exception, match="nothing|cannot be resolved|UNRESOLVED"):
        footer_max(spark, str(tmp_path / "some"), "nothing")
    assert stored_mark(spark, str(tmp_path / "none"), "mark") is None


# --- Schemas of snapshots


def test_a_dimension_opens_one_footer_a_snapshot(spark, tmp_path):
    path = str(tmp_path / "trips")
    for day in (1, 2, 3):
        extra = ["'x' AS shape_id"] if day == 3 else []
        for mode in ("bus", "tram"):
            rows = spark.range(30).selectExpr("id AS trip_id", f"'{mode}' AS transport_mode", f"DATE '2024-01-0{day}' AS valid_from", *extra)
            append_snapshot(rows.repartition(4), path)
    files = static.schema_files(spark, path)
    assert len(files) == 6 < len(list((tmp_path / "trips").rglob("*.parquet"))) == 24
    assert len({f.rsplit("/", 1)[0] for f in files}) == 6
    whole = read_snapshots(spark, path)
    assert whole.count() == 180 and whole.filter("shape_id = 'x'").count() == 60
    assert set(whole.columns) == {"trip_id", "transport_mode", "valid_from", "shape_id"}
    assert read_newest_snapshots(spark, path, ["trip_id", "shape_id"]).filter("shape_id = 'x'").count() == 60


# --- Versions


def test_store_calls_do_not_grow_with_the_versions(spark, tmp_path, monkeypatch):
    table = Versions(spark, str(tmp_path / "v"), retain_seconds=3600)
    calls = []
    for name in ("child_names", "exists", "modified_at", "delete"):
        real = getattr(versions, name)
        monkeypatch.setattr(versions, name, lambda *a, real=real, name=name: calls.append(name) or real(*a))
    rows = spark.range(1)
    seen = []
    for _ in range(8):
        calls.clear()
        table.add(rows)
        seen.append(len(calls))
    assert max(seen) <= 5 and seen[-1] == seen[3]
    calls.clear()
    table.newest()
    assert len(calls) == 2


# --- Closed hours


def test_closing_an_hour_changes_no_row(spark, tmp_path):
    path = str(tmp_path / "silver")
    for minute in range(6):
        append_silver(in_silver(spark, [(f"t{i}", "r", 1, "s", "bus", HOUR + 60 * minute + i, 0) for i in range(5)]), path)
    append_silver(in_silver(spark, [("now", "r", 1, "s", "bus", HOUR + 4000, 0)]), path)
    rows = lambda df: sorted(map(str, df.select(SILVER_TRIP_UPDATES.names).collect()))
    expected = rows(read_silver(spark, path))
    early = read_silver(spark, path)
    assert close_hours(spark, path, HOUR + 3600) == [(2024, 1, 14, 21)]
    for reader in (early, read_silver(spark, path), read_silver(spark, path, schema=SILVER_TRIP_UPDATES)):
        assert rows(reader) == expected
    assert len([p for p in (tmp_path / "silver_closed").rglob("part-*.parquet") if p.is_file()]) == 1
    # Rows that are late for a closed hour are seen at once, and stay when the replaced files go.
    late = in_silver(spark, [("late", "r", 1, "s", "bus", HOUR + 1, 0)])
    append_silver(late, path)
    expected = sorted(expected + rows(late))
    assert rows(read_silver(spark, path)) == expected
    assert close_hours(spark, path, HOUR + 3600) == [] and len(list((tmp_path / "silver").rglob("*.parquet"))) == 8
    close_hours(spark, path, HOUR + 3600, retain_seconds=-1)
    assert len(list((tmp_path / "silver").rglob("*.parquet"))) == 2
    assert rows(read_silver(spark, path)) == expected
    pruned = read_silver(spark, path, schema=SILVER_TRIP_UPDATES).filter("hour = 22")
    assert pruned.count() == 1


def test_a_reader_never_sees_half_a_closed_hour(spark, tmp_path, monkeypatch):
    """Readers at every step of closing, and those who opened the table before it, see all rows once."""
    path = str(tmp_path / "silver")
    for minute in range(5):
        append_silver(in_silver(spark, [("t", "r", minute, "s", "bus", HOUR + 60 * minute, 0)]), path)
    opened, steps = [], []

    def watched(name):
        real = getattr(closed, name)

        def call(*args):
            opened.append(read_silver(spark, path))
            steps.append(name)
            done = real(*args)
            opened.append(read_silver(spark, path))
            return done

        return call

    for name in ("make_dir", "rename"):
        monkeypatch.setattr(closed, name, watched(name))
    with monkeypatch.context() as broken:
        broken.setattr(closed, "rename", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            close_hours(spark, path, HOUR + 3600)
    assert read_silver(spark, path).count() == 5
    assert len(close_hours(spark, path, HOUR + 3600)) == 1
    assert "rename" in steps and [df.count() for df in opened] == [5] * len(opened)


def test_marts_read_closed_hours(spark, tmp_path):
    path, target = str(tmp_path / "silver"), str(tmp_path / "gold")
    data = random_rows(8, 60, HOUR, HOUR + 9000)
    for part in range(5):
        append_silver(in_silver(spark, data[part::5]), path)
    assert close_hours(spark, path, HOUR + 7200)
    refresh_tables(spark, read_silver(spark, path, schema=SILVER_TRIP_UPDATES), target)
    got = read_table(spark, f"{target}/trip_updates_deduped").select(*DEDUP.keys, "source_timestamp")
    expected = dedup_latest(in_silver(spark, data)).select(*DEDUP.keys, "source_timestamp")
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


# --- What is used more than once


def test_rows_of_two_landings_are_made_once(spark, monkeypatch):
    seen, append = [], queries.append_silver
    monkeypatch.setattr(queries, "append_silver", lambda rows, path: seen.append(plan_of(rows)) or append(rows, path))
    queries.all_queries()["incremental_dedup"](spark, SF_DIR)
    assert len(seen) == 2 and all("InMemoryTableScan" in plan for plan in seen)


def test_a_kept_upsert_joins_once(spark, tmp_path):
    target = str(tmp_path / "t")
    upsert_latest(spark, in_silver(spark, random_rows(9, 30, HOUR, HOUR + 900)), target, DEDUP)
    planned = plan_upsert(spark, in_silver(spark, random_rows(10, 30, HOUR + 901, HOUR + 1800)), target, DEDUP, keep=True)
    assert planned.lost.count() > 0 and planned.rows.count() > 0
    for frame in (planned.lost, planned.rows):
        assert "_beaten" in plan_of(frame).split("InMemoryRelation")[0] and "InMemoryTableScan" in plan_of(frame)
    planned.done()

import pytest

from headway.operators.live import DELAY_VIEW, LiveView, live_entries, live_view
from headway.sinks.live import LiveTable

ROWS = "trip_id string, source_timestamp bigint, stop_sequence int, delay_seconds bigint"


def shown(df):
    return sorted((r.key, r.last_stop_sequence, r.delay_seconds, r.expires_at) for r in df.collect())


def test_newest_row_of_each_trip(rows):
    df = rows([("t", 10, 1, 5), ("t", 10, 2, 6), ("t", 9, 9, 7), (None, 11, 1, 8), ("u", None, 1, 9)], ROWS)
    assert shown(live_view(df, DELAY_VIEW, 1000)) == [("delay:trip:t", 2, 6, 1120), ("delay:trip:u", 1, 9, 1120)]


def test_upserts_keep_the_newer_row_and_renew_its_lifetime(spark, rows, tmp_path):
    table = LiveTable(spark, str(tmp_path / "live"), DELAY_VIEW)
    with pytest.raises(ValueError):
        table.read(0)
    write = lambda data, now: table.upsert(live_entries(rows(data, ROWS), DELAY_VIEW), now)
    write([("t", 10, 1, 5), ("u", 10, 1, 1)], 1000)
    write([("t", 8, 3, 6)], 1050)
    assert shown(table.read(1060)) == [("delay:trip:t", 1, 5, 1170), ("delay:trip:u", 1, 1, 1120)]
    assert shown(table.read(1119)) == [("delay:trip:t", 1, 5, 1170), ("delay:trip:u", 1, 1, 1120)]
    assert shown(table.read(1121)) == [("delay:trip:t", 1, 5, 1170)]


def test_an_expired_row_is_forgotten_even_if_newer(spark, rows, tmp_path):
    table = LiveTable(spark, str(tmp_path / "live"), DELAY_VIEW)
    table.upsert(live_entries(rows([("t", 10, 1, 5)], ROWS), DELAY_VIEW), 1000)
    table.upsert(live_entries(rows([("t", 3, 1, 9)], ROWS), DELAY_VIEW), 1121)
    assert shown(table.read(1122)) == [("delay:trip:t", 1, 9, 1241)]


def test_a_reader_outlives_many_batches(spark, rows, tmp_path):
    table = LiveTable(spark, str(tmp_path / "live"), DELAY_VIEW)
    batch = live_entries(rows([("t", 10, 1, 5)], ROWS), DELAY_VIEW)
    table.upsert(batch, 1000)
    early = table.read(1000)
    for _ in range(11):
        table.upsert(batch, 1000)
    assert shown(early) == shown(table.read(1000))


def test_repeating_a_batch_and_old_versions(spark, rows, tmp_path):
    table = LiveTable(spark, str(tmp_path / "live"), DELAY_VIEW, retain_seconds=-1)
    batch = live_entries(rows([("t", 10, 1, 5)], ROWS), DELAY_VIEW)
    for _ in range(5):
        table.upsert(batch, 1000)
    assert shown(table.read(1000)) == [("delay:trip:t", 1, 5, 1120)]
    assert sorted(p.name for p in (tmp_path / "live").iterdir()) == ["version=4"]


def test_an_unfinished_version_is_ignored(spark, rows, tmp_path):
    table = LiveTable(spark, str(tmp_path / "live"), DELAY_VIEW)
    table.upsert(live_entries(rows([("t", 10, 1, 5)], ROWS), DELAY_VIEW), 1000)
    (tmp_path / "live" / "version=1").mkdir()
    assert len(table.read(1000).collect()) == 1
    table.upsert(live_entries(rows([("u", 10, 1, 5)], ROWS), DELAY_VIEW), 1001)
    assert len(table.read(1002).collect()) == 2


def test_a_view_needs_fields():
    with pytest.raises(ValueError):
        LiveView(prefix="x", fields={}, order=("a",))

import pytest
from pyspark.sql import functions as F

from headway.functions import local_epoch, service_date, service_seconds, with_event_parts

ZONE = "Australia/Melbourne"


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York"])
def test_edge_rows(spark, rows, session_zone):
    cases = [
        ("20240115", "08:05:09", 1705266309),
        ("20240115", "8:05:09", 1705266309),
        ("20240115", "24:00:00", 1705323600),
        ("20240115", "25:10:00", 1705327800),
        ("20240115", "49:10:00", 1705414200),
        ("20240115", None, None),
        (None, "08:05:09", None),
        ("", "08:05:09", None),
        ("2024-01-15", "08:05:09", None),
        ("20241315", "08:05:09", None),
        ("20240115", "08:05", None),
        ("20240115", "", None),
        ("20240115", "08:75:00", None),
        ("20240115", "-1:00:00", None),
        ("20240115", "ab:00:00", None),
        ("20241006", "02:30:00", 1728145800),
        ("20240407", "02:30:00", 1712417400),
    ]
    df = rows(cases, "d string, t string, expected bigint")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        typed = df.select("*", service_date("d").alias("date"), service_seconds("t").alias("seconds"))
        got = typed.select("*", local_epoch("date", "seconds", ZONE).alias("got")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [(r.d, r.t, r.got) for r in got] == cases


@pytest.mark.parametrize("session_zone", ["UTC", "Asia/Tokyo"])
def test_event_parts_do_not_follow_the_session_zone(spark, rows, session_zone):
    df = rows([(1705266309,), (1704067199,), (-1,), (0,), (None,), (9_000_000_000_000_000,)], "source_timestamp bigint")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        got = with_event_parts(df).select("year", "month", "day", "hour", F.unix_seconds("event_ts")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [tuple(r) for r in got] == [
        (2024, 1, 14, 21, 1705266309),
        (2023, 12, 31, 23, 1704067199),
        (1969, 12, 31, 23, -1),
        (1970, 1, 1, 0, 0),
        (None,) * 5,
        (None,) * 5,
    ]

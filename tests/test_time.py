import datetime as dt

from seismiq.functions import timefmt as tf


def test_epoch_to_iso(spark):
    rows = [(None,), (0,), (1704067200000,), (1704067200123,), (1704067200001,)]
    df = spark.createDataFrame(rows, "ms long")
    got = [r[0] for r in df.select(tf.iso_utc_text("ms")).collect()]
    assert got == [None, None, "2024-01-01T00:00:00Z", "2024-01-01T00:00:00.123000Z",
                   "2024-01-01T00:00:00.001000Z"]


def test_parse_iso(spark):
    rows = [("2024-01-01T00:00:00Z",), ("2024-01-01T00:00:00.123000Z",), (None,), ("garbage",),
            ("2024-13-45T00:00:00Z",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(tf.parse_iso_utc("s")).collect()]
    assert got == [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 0, 123000), None, None, None]


def test_roundtrip_ntz_text(spark):
    rows = [(dt.datetime(2024, 1, 2, 3, 4, 5, 6),), (dt.datetime(2024, 1, 2, 3, 4, 5),)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    out = df.select(tf.ntz_to_iso_text("t").alias("s")).select(tf.parse_iso_utc("s")).collect()
    assert [r[0] for r in out] == [r[0] for r in rows]


def test_hour_of(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5, 59, 59),), (None,)], "t timestamp_ntz")
    got = [r[0] for r in df.select(tf.hour_of("t")).collect()]
    assert got == [dt.datetime(2024, 1, 1, 5), None]


def test_feed_times_whatever_the_session_zone(spark):
    from seismiq.functions.timefmt import now_utc, parse_iso_utc
    texts = ["2024-01-31T00:00:00Z", "2024-01-31T05:06:07.25Z", "2024", "12:30", "garbage", "2024-02-30T00:00:00Z", "2024-01-31 05:06:07Z", "2024-01-31T05:06:07+02:00", None]
    want = ["2024-01-31 00:00:00", "2024-01-31 05:06:07.25"] + [None] * 7
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", z)
            df = spark.createDataFrame([(t,) for t in texts], "t string")
            assert [r[0] for r in df.select(parse_iso_utc("t").cast("string")).collect()] == want
            import datetime
            now = spark.range(1).select(now_utc().cast("string")).first()[0]
            assert abs((datetime.datetime.fromisoformat(now) - datetime.datetime.now(datetime.UTC).replace(tzinfo=None)).total_seconds()) < 120
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_versions_are_ordered_by_time_not_by_text(spark):
    from seismiq.operators.dedup import dedup_latest
    rows = [("e", "2024-01-01T00:00:05Z", 1), ("e", "2024-01-01T00:00:05.500000Z", 2), ("e", "2024-01-01T00:00:04.900000Z", 0)]
    df = spark.createDataFrame(rows, "event_id string, ingestion_timestamp_utc string, n int")
    assert [r.n for r in dedup_latest(df).collect()] == [2]

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from seismiq.operators.dedup import dedup_latest
from seismiq.operators.silver import silver

T0 = dt.datetime(2024, 1, 1)


def _bronze(spark, rows):
    return spark.createDataFrame(rows, "event_id string, bronze_load_timestamp timestamp, "
                                       "ingestion_timestamp_utc string, source_file string, v int")


def test_dedup_cases(spark):
    rows = [
        (None, T0, "a", "f1", 1),                                   # null id dropped
        ("one", T0, "2024-01-01T00:00:00.000001Z", "f1", 1),        # single version
        ("tie", T0, "2024-01-01T00:00:01.000000Z", "f1", 1),        # same load time:
        ("tie", T0, "2024-01-01T00:00:02.000000Z", "f1", 2),        #   later ingestion wins
        ("three", T0, "x", "f1", 1),
        ("three", T0 + dt.timedelta(hours=2), "x", "f1", 3),        # latest load wins
        ("three", T0 + dt.timedelta(hours=1), "x", "f1", 2),
    ]
    got = {r.event_id: r.v for r in dedup_latest(_bronze(spark, rows)).collect()}
    assert got == {"one": 1, "tie": 2, "three": 3}


@settings(max_examples=8, deadline=None, derandomize=True)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 5),
                          st.integers(0, 3)), min_size=1, max_size=20))
def test_dedup_properties(spark, rows):
    data = [(k, T0 + dt.timedelta(hours=h), f"t{i:03d}", "f", i) for i, (k, h, _) in enumerate(rows)]
    df = _bronze(spark, data)
    once = dedup_latest(df)
    ids = [r.event_id for r in once.collect()]
    assert len(ids) == len(set(ids)) == len({k for k, _, _ in rows if k is not None})
    twice = dedup_latest(once)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    # the winner has the greatest (load time, ingestion text)
    for r in once.collect():
        best = max((d for d in data if d[0] == r.event_id), key=lambda d: (d[1], d[2]))
        assert r.v == best[4]


def test_silver_columns_and_parse(spark):
    rows = [("e1", T0, "2024-01-01T00:00:00.5Z", "f", 1)]
    df = _bronze(spark, rows).selectExpr(
        "*", "6.5 as magnitude", "10.0 as depth_km", "40.0 as latitude", "-100.0 as longitude",
        "cast(null as string) as alert_level", "'2024-01-01T03:04:05Z' as event_time_utc")
    out = silver(df).collect()[0]
    assert out.severity == "MAJOR" and out.depth_category == "SHALLOW"
    assert out.region == "North America" and out.alert_level == "none"
    assert out.event_timestamp == dt.datetime(2024, 1, 1, 3, 4, 5)
    assert out.silver_load_timestamp is not None

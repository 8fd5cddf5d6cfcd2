import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seismiq.operators import anomaly as an
from seismiq.operators.gold import gold
from seismiq.operators.silver import classify

sixteenths = st.integers(-160, 160).map(lambda i: i / 16)


@settings(max_examples=6, deadline=None, derandomize=True)
@given(st.lists(st.tuples(sixteenths, st.integers(0, 700).map(float), st.integers(0, 1000)),
                min_size=2, max_size=40))
def test_flag_iff_max_z_over_threshold(spark, rows):
    df = spark.createDataFrame([(f"e{i}", *r) for i, r in enumerate(rows)],
                               "event_id string, magnitude double, depth_km double, significance int")
    for r in an.anomalies(df).collect():
        zs = [z for z in (r.zscore_magnitude, r.zscore_depth_km, r.zscore_significance) if z is not None]
        assert r.is_anomaly == int(any(z > an.ANOMALY_THRESHOLD for z in zs))
        assert (r.anomaly_reason == "none") == (r.is_anomaly == 0)
        if zs:
            assert abs(r.anomaly_score - round(max(zs), 4)) < 1e-9


@settings(max_examples=5, deadline=None, derandomize=True)
@given(st.lists(st.tuples(st.integers(0, 72), st.one_of(st.none(), sixteenths),
                          st.one_of(st.none(), st.integers(-90, 90).map(float)),
                          st.integers(-180, 180).map(float), st.booleans()),
                min_size=1, max_size=40))
def test_gold_totals_equal_silver_rows(spark, rows):
    t0 = dt.datetime(2024, 1, 1)
    data = [(f"e{i}", t0 + dt.timedelta(hours=h, minutes=i % 60), m, 10.0, la, lo, ts, None, i)
            for i, (h, m, la, lo, ts) in enumerate(rows)]
    s = classify(spark.createDataFrame(
        data, "event_id string, event_timestamp timestamp_ntz, magnitude double, depth_km double, "
              "latitude double, longitude double, tsunami_flag boolean, alert_level string, "
              "significance int"
    ).withColumn("place", F.concat(F.lit("p"), F.col("event_id"))))
    g = gold(s, stamp=False)
    tot = g.agg(F.sum("total_events"), F.sum("unique_events"), F.sum("tsunami_count")).collect()[0]
    assert tot[0] == tot[1] == len(rows)
    assert tot[2] == sum(1 for r in rows if r[4])
    # the notable place belongs to the group's strongest event
    for r in g.collect():
        if r.max_magnitude is not None:
            cands = [d for d in data if d[2] == r.max_magnitude]
            assert r.most_notable_place in {"p" + d[0] for d in cands}


def test_gold_distinct_on_repeated_ids(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("a", t0, 3.0), ("a", t0, 3.5), ("b", t0, 3.2)]
    df = classify(spark.createDataFrame(rows, "event_id string, event_timestamp timestamp_ntz, magnitude double")
                  .selectExpr("*", "10.0 as depth_km", "0.0 as latitude", "0.0 as longitude",
                              "false as tsunami_flag", "cast(null as string) as alert_level",
                              "1 as significance", "concat('p', event_id) as place"))
    r = gold(df, stamp=False, unique_ids=False).collect()[0]
    assert (r.total_events, r.unique_events, r.most_notable_place) == (3, 2, "pa")

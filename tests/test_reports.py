from pyspark.sql import functions as F

from conftest import SF_SMALL
from seismiq.operators import reports as rp
from seismiq.plans import queries as Q


def test_render_reports_and_history(spark, tmp):
    ml = Q.ml_of(spark, SF_SMALL, with_model=True)
    reports = rp.render_reports(ml)
    rows = {r.output_type: r for r in reports.collect()}
    assert set(rows) == {"daily_summary", "cluster_explanation", "response_playbook"}
    assert all(r.model_used == "template" and len(r.generated_at) == 26 for r in rows.values())
    kpi = rp.daily_kpis(ml).collect()[0]
    daily = rows["daily_summary"].content
    assert f"Events: {kpi.total_events}" in daily and f"Anomalies: {kpi.anomaly_count}" in daily
    # the playbook describes the strongest event
    top = rp.playbook_event(ml).collect()[0]
    assert f"Location: {top.place}" in rows["response_playbook"].content
    assert "Model prediction:" in rows["response_playbook"].content
    regions = ml.select("region").distinct().count()
    assert len(rows["cluster_explanation"].content.splitlines()) == 1 + regions
    path = f"{tmp}/history"
    rp.append_history(reports, path)
    rp.append_history(reports, path)
    hist = rp.report_history(spark.read.parquet(path)).collect()
    assert len(hist) == 6 and all(len(h.content_preview) <= 200 for h in hist)
    assert [h.generated_at for h in hist] == sorted((h.generated_at for h in hist), reverse=True)


def _ml(spark, rows):
    schema = ("event_id string, place string, magnitude double, depth_km double, severity string, "
              "region string, tsunami_flag boolean, is_anomaly int, anomaly_reason string, "
              "predicted_severity string, prediction_confidence double")
    return spark.createDataFrame(rows, schema)


def test_context_lines_are_the_whole_lists(spark):
    rows = [(f"e{i:02d}", f"p{i}", float(i % 9), 10.0, "MINOR", "Asia" if i % 2 else "Europe",
             False, int(i % 3 == 0), "unusual_depth" if i % 3 == 0 else "none", None, None)
            for i in range(300)]
    ml = _ml(spark, rows)
    lines = rp.context_lines(ml)
    daily = lines.filter("output_type = 'daily_summary'").collect()
    assert sorted(r.event_id for r in daily) == sorted(r[0] for r in rows if r[7])     # every anomaly, no cap
    assert sorted(r.event_id for r in lines.filter("section = 'events'").collect()) == sorted(r[0] for r in rows)
    assert all(r.line == f"p{int(r.event_id[1:])} | {r.magnitude} | unusual_depth" for r in daily)


def test_report_without_anomalies(spark):
    ml = _ml(spark, [("e1", "p1", 2.5, 5.0, "MICRO", "Asia", False, 0, "none", None, None)])
    content = {r.output_type: r.content for r in rp.render_reports(ml).collect()}
    assert "Anomalies: 0" in content["daily_summary"]
    assert rp.context_lines(ml).filter("output_type = 'daily_summary'").count() == 0
    assert "Model prediction: None (confidence None%)" in content["response_playbook"]


def test_lists_come_strongest_first(spark):
    """The oracle comparison ignores order; this does not."""
    rows = [(f"e{i}", f"p{i}", None if i % 7 == 0 else float(i % 5), 10.0, "MAJOR", "Asia", False, i % 2, "x", "MAJOR", 0.5) for i in range(40)]
    ml = _ml(spark, rows).withColumn("event_timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    want = [r[1] for r in sorted(rows, key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))]
    assert [r.place for r in rp.qa_context(ml).collect()] == want
    assert [r.place for r in rp.anomalous_events(ml).collect()] == [p for p in want if int(p[1:]) % 2]
    assert [r.place for r in rp.critical_events(ml).collect()] == want
    assert rp.qa_context(ml).first().event_time_utc == "2024-01-01T00:00:00Z"
    g = spark.createDataFrame([("2024-01-01 00:00:00", "A", "r", 1, 1.0, m, 0, "p") for m in (3.0, None, 5.0)],
                              "event_hour string, severity string, region string, total_events long, avg_magnitude double, "
                              "max_magnitude double, tsunami_count long, most_notable_place string")
    assert [r.max_magnitude for r in rp.gold_context(g).collect()] == [5.0, 3.0, None]

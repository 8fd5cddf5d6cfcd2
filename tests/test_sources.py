import json
import os

from seismiq.sources import geojson as gj
from seismiq.sources import landing as ld
from seismiq.sources.schemas import FEED_COLUMNS


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_geojson_edge_features(spark, tmp):
    doc = {"type": "FeatureCollection", "features": [
        {"id": "ok", "properties": {"mag": 4.5, "time": 1704067200123, "tsunami": 1, "sig": 10},
         "geometry": {"coordinates": [10.0, 20.0, 30.0]}},
        {"id": "nullgeom", "properties": {"mag": 1.0, "time": 0}, "geometry": None},
        {"id": "twocoords", "properties": {"mag": 1.0, "tsunami": None}, "geometry": {"coordinates": [1.0, 2.0]}},
        {"id": "noprops"},
    ]}
    _write(f"{tmp}/a/doc1.json", json.dumps(doc, indent=2))
    _write(f"{tmp}/a/doc2.json", json.dumps({"type": "FeatureCollection", "features": []}))
    rows = {r.event_id: r for r in gj.read_geojson(spark, f"{tmp}/a").collect()}
    assert set(rows) == {"ok", "nullgeom", "twocoords", "noprops"}
    ok = rows["ok"]
    assert (ok.longitude, ok.latitude, ok.depth_km) == (10.0, 20.0, 30.0)
    assert ok.tsunami_flag is True and ok.event_time_utc == "2024-01-01T00:00:00.123000Z"
    assert ok.source == "USGS" and ok.ingestion_timestamp_utc.endswith("Z")
    assert rows["nullgeom"].latitude is None and rows["nullgeom"].event_time_utc is None
    assert rows["twocoords"].depth_km is None and rows["twocoords"].latitude == 2.0
    assert rows["twocoords"].tsunami_flag is False
    assert rows["noprops"].magnitude is None and rows["noprops"].tsunami_flag is False
    assert list(gj.read_geojson(spark, f"{tmp}/a").columns) == FEED_COLUMNS


def test_landing_permissive_and_corrupt(spark, tmp):
    land = f"{tmp}/landing"
    good = {"event_id": "e1", "magnitude": 2.5, "extra_field": 1}
    wrong = {"event_id": "e2", "magnitude": "big"}
    _write(f"{land}/b1/part-1.json", json.dumps(good) + "\n" + json.dumps(wrong) + "\n{broken\n")
    _write(f"{land}/b2/part-1.json", "")
    rows = ld.read_landing(spark, land, corrupt=True).collect()
    by = {r.event_id: r for r in rows if r.event_id}
    assert by["e1"].magnitude == 2.5
    assert by["e2"].magnitude is None
    broken = [r for r in rows if r["_corrupt_record"] == "{broken"]
    assert len(broken) == 1 and broken[0].event_id is None
    files = ld.list_landing(spark, land).collect()
    # zero-length files hold no records and are skipped by the file scan
    assert len(files) == 1 and files[0].file_name == "part-1.json" and files[0].size_bytes > 0


def test_land_writes_new_batch_dirs(spark, tmp):
    df = spark.createDataFrame([("e1", 1.0)], "event_id string, magnitude double")
    a = ld.land(df, f"{tmp}/l")
    b = ld.land(df, f"{tmp}/l")
    assert a != b
    assert ld.read_landing(spark, f"{tmp}/l").count() == 2

from pyspark.sql import functions as F

from seismiq.functions import labels


def _apply(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_severity_edges(spark):
    mags = [7.0, 6.999, 6.0, 5.0, 4.0, 3.0, 2.0, 1.999, -0.5, None]
    got = _apply(spark, [(m,) for m in mags], "magnitude double", labels.severity("magnitude"))
    assert got == ["CATASTROPHIC", "MAJOR", "MAJOR", "STRONG", "MODERATE", "MINOR", "MICRO",
                   "NEGLIGIBLE", "NEGLIGIBLE", "NEGLIGIBLE"]


def test_depth_edges(spark):
    ds = [70.0, 70.001, 300.0, 300.001, -1.0, None]
    got = _apply(spark, [(d,) for d in ds], "depth_km double", labels.depth_category("depth_km"))
    assert got == ["SHALLOW", "INTERMEDIATE", "INTERMEDIATE", "DEEP", "SHALLOW", "DEEP"]


def test_region_corners_and_overlaps(spark):
    rows, want = [], []
    for name, a, b, c, d in labels.REGION_BOXES:
        for lat, lon in [(a, c), (a, d), (b, c), (b, d)]:
            rows.append((float(lat), float(lon)))
            want.append(name)
    got = _apply(spark, rows, "latitude double, longitude double", labels.region())
    # A corner shared with an earlier box belongs to the earlier box.
    for (lat, lon), g, w in zip(rows, got, want):
        first = next(n for n, a, b, c, d in labels.REGION_BOXES if a <= lat <= b and c <= lon <= d)
        assert g == first
    special = [(36.0, 0.0), (-10.0, 120.0), (60.0, -150.0), (None, None), (0.0, -170.0)]
    got = _apply(spark, special, "latitude double, longitude double", labels.region())
    assert got == ["Europe", "Asia", "Alaska/Arctic", "Pacific/Other", "Pacific/Other"]


def test_alert_fill(spark):
    got = _apply(spark, [("red",), (None,)], "alert_level string", labels.alert_level())
    assert got == ["red", "none"]


def test_critical_membership(spark):
    got = _apply(spark, [(s,) for s in labels.SEVERITY_LABELS], "severity string",
                 labels.is_critical("severity"))
    assert dict(zip(labels.SEVERITY_LABELS, got)) == {
        "CATASTROPHIC": True, "MAJOR": True, "STRONG": True, "MODERATE": False,
        "MINOR": False, "MICRO": False, "NEGLIGIBLE": False}
    assert F  # imported for parity with other tests

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from seismiq.plans import queries as Q
from seismiq.plans.oracle import SQL


def test_layer_invariants(spark):
    b = Q.bronze_of(spark, SF_SMALL)
    s = Q.silver_of(spark, SF_SMALL)
    g = Q.gold_of(spark, SF_SMALL)
    nb, ns = b.count(), s.count()
    assert nb >= ns >= g.count()
    tot = g.agg(F.sum("total_events"), F.sum("unique_events")).collect()[0]
    assert tot[0] == tot[1] == ns
    assert s.select("event_id").distinct().count() == ns


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


TABLES = "events".split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if v != v:
            return None
        return str(int(v)) if v.is_integer() else repr(v)
    try:
        import pandas as pd
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def _rows(pdf):
    cols = sorted(pdf.columns)
    return sorted("|".join(str(_norm(r[c])) for c in cols) for r in pdf[cols].to_dict("records"))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    s = Q.REGISTRY[name](spark, SF_SMALL).toPandas()
    o = duck.execute(SQL[name]).fetchdf()
    assert sorted(s.columns) == sorted(o.columns)
    assert _rows(s) == _rows(o)


def test_build_layers(spark, tmp):
    from seismiq.plans.medallion import build_layers
    from seismiq.sources.adapter import OBS_ORDER
    run = build_layers(spark, Q.bronze_of(spark, SF_SMALL), root=f"{tmp}/layers", order=OBS_ORDER)
    s = spark.read.parquet(run.paths["silver"])
    g = spark.read.parquet(run.paths["gold"])
    assert s.count() == Q.silver_of(spark, SF_SMALL).count()
    assert g.agg(F.sum("total_events")).collect()[0][0] == s.count()
    rows = {m["table_name"]: m["rows"] for m in run.manifest}
    assert rows == {"GOLD_INSIGHTS": g.count(), "ML_PREDICTIONS": s.count(), "GENAI_OUTPUTS": 3}
    assert spark.read.parquet(run.paths["ml_runs"]).count() == 1
    lines = spark.read.parquet(run.paths["report_lines"])
    ml = spark.read.parquet(run.paths["ml"])
    assert lines.filter("output_type = 'cluster_explanation'").count() == s.count()
    assert (lines.filter("output_type = 'daily_summary'").count()
            == ml.filter("is_anomaly = 1").count())


def test_enrich_join_matches_projection(spark):
    from seismiq.operators import classifier as clf
    s = Q.silver_of(spark, SF_SMALL)
    ml = clf.ml_table(s, stamp=False)
    pred = ml.filter("is_anomaly is not null").select("event_id", "is_anomaly", "anomaly_reason")
    joined = clf.enrich(s, pred, stamp=False)
    a = sorted(map(tuple, joined.select("event_id", "is_anomaly", "anomaly_reason").collect()))
    b = sorted(map(tuple, ml.select("event_id", "is_anomaly", "anomaly_reason").collect()))
    assert a == b

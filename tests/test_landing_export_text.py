"""Quarantine of malformed lines, reconciled exports, whole texts in chunks, reloaded models."""

import json
import os

import pytest
from pyspark.sql import functions as F

from seismiq.functions.text import text_chunks
from seismiq.operators import anomaly as an
from seismiq.operators import classifier as clf
from seismiq.plans import queries as q
from seismiq.sources import export as ex
from seismiq.sources import landing as ld
from seismiq.sources import versions as vs


def _lines(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines))


def test_each_line_goes_to_one_side(spark, tmp):
    good = [json.dumps({"event_id": "a", "magnitude": 1.5}), "{}", json.dumps({"event_id": None, "unknown": [1]})]
    bad = ['{"event_id": "b", "magnitude":', "no json", '{"event_id": "c", "magnitude": "strong"}', '{"event_id": "d", "nst": 1.5}', "é {"]
    _lines(f"{tmp}/land/b/a.json", [*good[:2], *bad[:3], "", *good[2:], *bad[3:]])
    counts = ld.split_landing(spark, f"{tmp}/land/*/*.json", f"{tmp}/sides")
    assert counts == {"good": 3, "corrupt": 5}
    assert sorted(str(r.event_id) for r in ld.read_good(spark, f"{tmp}/sides").collect()) == ["None", "None", "a"]
    rows = ld.read_corrupt(spark, f"{tmp}/sides").collect()
    assert sorted(r.line for r in rows) == sorted(bad) and all(r.source_file.endswith("/a.json") for r in rows)


def test_only_good_lines(spark, tmp):
    _lines(f"{tmp}/land/b/a.json", [json.dumps({"event_id": "a"})])
    assert ld.split_landing(spark, f"{tmp}/land/*/*.json", f"{tmp}/sides") == {"good": 1, "corrupt": 0}
    assert ld.read_corrupt(spark, f"{tmp}/sides").count() == 0


def test_a_repeated_run_adds_nothing(spark, tmp):
    df = spark.range(10).select(F.col("id").alias("event_id"))
    ex.export_reconciled(df, tmp, "t", "r1")
    ex.export_reconciled(df.limit(3), tmp, "t", "r1")
    assert ex.read_export(spark, tmp, "t").count() == 10
    runs = ex.export_reconciled(df.limit(4), tmp, "t", "r2").collect()
    assert [(r.TABLE_NAME, r.RUN_ID, r.SOURCE_ROWS, r.TARGET_ROWS, r.EQUAL) for r in runs] == [("T", "r1", 10, 10, True), ("T", "r2", 4, 4, True)]
    assert ex.read_export(spark, tmp, "t").columns == ["EVENT_ID"] and ex.read_export(spark, tmp, "t").count() == 14
    ex.export_reconciled(df.limit(0), tmp, "t", "r3", mode="overwrite")
    assert ex.read_export(spark, tmp, "t").count() == 0
    with pytest.raises(ValueError):
        ex.export_reconciled(df, tmp, "t", "r4", mode="merge")


def test_a_target_that_lost_rows_is_not_published(spark, tmp, monkeypatch):
    df = spark.range(10).toDF("event_id")
    ex.export_reconciled(df, tmp, "t", "r1")
    real = ex._run_path
    short = f"{tmp}/short"
    ex.upper_columns(df.limit(9)).write.parquet(short)
    calls = []
    # the staged rows are read from a folder that lacks one
    monkeypatch.setattr(ex, "_run_path", lambda target, run: short if run == "r2" and calls.append(run) is None and len(calls) == 2 else real(target, run))
    with pytest.raises(ex.ExportMismatch):
        ex.export_reconciled(df, tmp, "t", "r2")
    monkeypatch.undo()
    assert ex.read_export(spark, tmp, "t").count() == 10 and vs.published(spark, real(tmp, "")[:0] or ex.target_path(tmp, "t")) == [0]
    ex.export_reconciled(df, tmp, "t", "r2")
    assert ex.read_export(spark, tmp, "t").count() == 20


@pytest.mark.parametrize("size", [1, 7, 50, 10 ** 6])
def test_chunks_join_to_the_whole_text(spark, size):
    rows = [(t, i, f"{t} line {i} " + "é" * (i % 11)) for t in "ab" for i in range(300)] + [("c", 0, ""), ("d", 0, "x" * 5000)]
    df = spark.createDataFrame(rows, "name string, n int, line string").repartition(7)
    out = text_chunks(df, F.col("line"), [F.col("n").desc()], ["name"], size).collect()
    for t in "abcd":
        mine = sorted((r.chunk, r.content, r.lines) for r in out if r.name == t)
        lines = [x[2] for x in sorted(rows, key=lambda r: -r[1]) if x[0] == t]
        assert "\n".join(c for _, c, _ in mine) == "\n".join(lines) and sum(n for *_, n in mine) == len(lines)
        assert all(len(c) <= size + max(map(len, lines)) for _, c, _ in mine)
    assert text_chunks(df.limit(0), F.col("line"), [F.col("n")], ["name"], size).count() == 0


def test_a_loaded_model_scores_a_stream_as_a_batch(spark, tmp):
    model = q.threshold_model(spark)
    clf.save_model(model, f"{tmp}/model")
    loaded = clf.load_model(f"{tmp}/model")
    s = q.silver_of(spark, "/root/testdata/sf0.001")
    s.repartition(3).write.parquet(f"{tmp}/silver")
    stream = spark.readStream.schema(s.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/silver")
    clf.scored_stream(loaded, stream, f"{tmp}/scored", f"{tmp}/ck").awaitTermination()
    columns = ["event_id", "predicted_severity", "prediction_confidence"]
    batch = clf.predict(model, an.scored_base(s)).select(*columns)
    got = spark.read.parquet(f"{tmp}/scored").select(*columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect())) and got.count() > 0

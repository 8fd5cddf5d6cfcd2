import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seismiq.sources import landing as ld
from seismiq.sources import versions as vs
from seismiq.streaming import bronze as sb
from seismiq.streaming import evolving as ev
from seismiq.streaming import silver as ss


def _rows(ids, t="2024-01-01T00:00:00Z", ing="2024-01-01T00:00:00.000000Z", mag=1.0):
    return [{"event_id": i, "magnitude": mag, "event_time_utc": t, "ingestion_timestamp_utc": ing,
             "latitude": 0.0, "longitude": 0.0, "depth_km": 5.0} for i in ids]


def _put(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))


def _run(spark, land, bronze, ckpt):
    q = sb.start_bronze(spark, land, bronze, ckpt)
    q.awaitTermination()
    return spark.read.parquet(bronze)


def test_bronze_restart_and_new_files(spark, tmp):
    land, bronze, ckpt = f"{tmp}/land", f"{tmp}/bronze", f"{tmp}/ckpt"
    _put(f"{land}/b1/a.json", _rows(["e1", "e2"]))
    assert _run(spark, land, bronze, ckpt).count() == 2
    # restart with nothing new adds nothing
    assert _run(spark, land, bronze, ckpt).count() == 2
    # a file rewritten under the same name is not read again
    _put(f"{land}/b1/a.json", _rows(["e9"]))
    assert _run(spark, land, bronze, ckpt).count() == 2
    # a new file adds only its rows, with their own load stamp and file name
    _put(f"{land}/b2/b.json", _rows(["e3"]))
    df = _run(spark, land, bronze, ckpt)
    assert df.count() == 3
    r = df.filter("event_id = 'e3'").collect()[0]
    assert r.source_file.endswith("/b2/b.json") and r.bronze_load_timestamp is not None


def _stream(spark, bronze, root, ckpt, **options):
    ss.start_silver(spark, bronze, root, ckpt, with_gold=True, **options).awaitTermination()


def _gold_rows(df):
    cols = [c for c in sorted(df.columns) if c != "event_date"]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def _check(spark, bronze, root):
    """Streamed Silver and Gold equal the batch layers over the same Bronze rows."""
    from seismiq.operators.gold import gold as gold_of
    from seismiq.operators.silver import silver as silver_of
    full = silver_of(spark.read.parquet(bronze))
    held = ss.read_silver(spark, root)
    assert sorted((r.event_id, r.magnitude) for r in held.collect()) == sorted((r.event_id, r.magnitude) for r in full.collect())
    assert _gold_rows(ss.read_gold(spark, root)) == _gold_rows(gold_of(full, stamp=False))


def test_streaming_silver_equals_batch(spark, tmp):
    land, bronze = f"{tmp}/land", f"{tmp}/bronze"
    root = f"{tmp}/layers"
    _put(f"{land}/b1/a.json", _rows(["e1", "e2"], ing="2024-01-01T00:00:01.000000Z", mag=1.0))
    _run(spark, land, bronze, f"{tmp}/ck1")
    _stream(spark, bronze, root, f"{tmp}/ck2")
    # a later revision of e1 moves it to another day and raises its magnitude
    _put(f"{land}/b2/a.json", _rows(["e1"], t="2024-01-03T00:00:00Z",
                                     ing="2024-01-03T00:00:01.000000Z", mag=7.5))
    _run(spark, land, bronze, f"{tmp}/ck1")
    _stream(spark, bronze, root, f"{tmp}/ck2")
    assert {r.event_id: r.magnitude for r in ss.read_silver(spark, root).collect()} == {"e1": 7.5, "e2": 1.0}
    # the old day's Gold no longer counts e1; the new day holds it
    got = {(str(r.event_date), r.severity): r.total_events for r in ss.read_gold(spark, root, dated=True).collect()}
    assert got == {("2024-01-01", "NEGLIGIBLE"): 1, ("2024-01-03", "CATASTROPHIC"): 1}
    _check(spark, bronze, root)
    # a restart with nothing new changes nothing
    _stream(spark, bronze, root, f"{tmp}/ck2")
    _check(spark, bronze, root)
    assert ld.landing_glob(land).endswith("/*/*.json")


def test_bronze_processing_time_trigger(spark, tmp):
    land = f"{tmp}/land"
    _put(f"{land}/b1/a.json", _rows(["e1"]))
    q = sb.start_bronze(spark, land, f"{tmp}/bronze", f"{tmp}/ck", trigger="1 second")
    try:
        q.processAllAvailable()
        _put(f"{land}/b2/a.json", _rows(["e2", "e3"]))
        q.processAllAvailable()
        assert q.isActive and sb.stream_status(spark)[0]["active"]
    finally:
        q.stop()
    assert spark.read.parquet(f"{tmp}/bronze").count() == 3


def test_batches_of_any_size_keep_silver_and_gold_exact(spark, tmp):
    """Events move between days, days empty and fill again, times are missing or do not parse."""
    land, bronze, root = (f"{tmp}/{x}" for x in ("land", "bronze", "layers"))
    rounds = [
        [("a", 1, 1.0), ("b", 1, 2.5), ("c", 2, 3.5), ("d", 3, 4.5), ("n", None, 1.5)],
        [("a", 2, 5.5), ("b", 3, 2.0), ("e", 1, 0.5), ("g", "garbage", 2.5)],   # a and b move days
        [("a", None, 6.5), ("c", 3, 7.5), ("n", 2, 1.5)],                       # a loses its time, n gets one
        [("a", 1, 6.5), ("b", 1, 1.0), ("g", "2024", 0.5)],                     # a comes back
    ]
    for i, rows in enumerate(rounds):
        for k, (e, day, mag) in enumerate(rows):
            t = f"2024-01-0{day}T12:00:00Z" if isinstance(day, int) else day
            _put(f"{land}/b{i}/{k}.json", _rows([e], t=t, ing=f"2024-02-0{i + 1}T12:00:00.000000Z", mag=mag))
        _run(spark, land, bronze, f"{tmp}/ck1")
        _stream(spark, bronze, root, f"{tmp}/ck2", max_files=None if i % 2 else 2)
        _check(spark, bronze, root)
    assert ss.read_silver(spark, root).filter("event_timestamp is null").count() == 1
    assert ss.read_gold(spark, root, dated=True).filter("event_date is null").agg(F.sum("total_events")).first()[0] == 1


def test_gold_day_emptied_by_a_revision_is_cleared(spark, tmp):
    """A revision that moves a day's only event elsewhere leaves no row for that day, with or without a time."""
    land, bronze, root = (f"{tmp}/{x}" for x in ("land", "bronze", "layers"))
    for i, t in enumerate(["2024-01-01T06:00:00Z", "2024-01-02T07:00:00Z", None, "2024-01-01T06:00:00Z"]):
        _put(f"{land}/b{i}/a.json", _rows(["e1"], t=t, ing=f"2024-03-0{i + 1}T00:00:00.000000Z", mag=3.0))
        _run(spark, land, bronze, f"{tmp}/ck1")
        _stream(spark, bronze, root, f"{tmp}/ck2")
        got = [(r.event_date and str(r.event_date), r.total_events) for r in ss.read_gold(spark, root, dated=True).collect()]
        assert got == [(t and t[:10], 1)]


def _crashing(spark, bronze, root, ck, write):
    """Run the stream with a sink that dies; returns when the query has ended with the error."""
    q = (ss.latest_events(spark.readStream.schema(ss.BRONZE_SCHEMA).parquet(bronze)).writeStream.outputMode("update")
         .foreachBatch(write).option("checkpointLocation", ck).trigger(availableNow=True).start())
    with pytest.raises(StreamingQueryException):
        q.awaitTermination()


def test_replay_after_a_crash(spark, tmp):
    """The driver dies after a batch was published, or staged, but before the stream committed it."""
    land, bronze, root, ck = (f"{tmp}/{x}" for x in ("land", "bronze", "layers", "ck2"))
    _put(f"{land}/b1/a.json", _rows(["e1", "e2", "e3"], ing="2024-01-01T00:00:01.000000Z"))
    _run(spark, land, bronze, f"{tmp}/ck1")
    _stream(spark, bronze, root, ck)
    for n, staged_only in enumerate((False, True)):
        _put(f"{land}/c{n}/a.json", _rows(["e1"], t=f"2024-01-0{n + 2}T07:00:00Z", ing=f"2024-01-0{n + 2}T07:00:01.000000Z", mag=3.0 + n))
        _run(spark, land, bronze, f"{tmp}/ck1")
        before = sorted(tuple(r) for r in ss.read_silver(spark, root, stamp=False).collect())

        def die(batch_id):
            raise RuntimeError("driver lost")

        write = ss._writer(spark, root, before_publish=die if staged_only else None)

        def crash(batch, batch_id, write=write):
            write(batch, batch_id)
            raise RuntimeError("driver lost before the batch commit")

        _crashing(spark, bronze, root, ck, crash)
        if staged_only:  # nothing of the failed batch is visible
            assert sorted(tuple(r) for r in ss.read_silver(spark, root, stamp=False).collect()) == before
        else:
            _check(spark, bronze, root)
        _stream(spark, bronze, root, ck)
        _check(spark, bronze, root)
    assert {r.event_id: r.magnitude for r in ss.read_silver(spark, root).filter("event_id = 'e1'").collect()} == {"e1": 4.0}


def test_readers_keep_their_version_and_old_folders_go(spark, tmp):
    land, bronze, root, ck = (f"{tmp}/{x}" for x in ("land", "bronze", "layers", "ck2"))
    held = None
    for i in range(5):
        _put(f"{land}/b{i}/a.json", _rows(["e1", f"x{i}"], t=f"2024-01-0{i % 2 + 1}T06:00:00Z", ing=f"2024-03-0{i + 1}T00:00:00.000000Z", mag=float(i)))
        _run(spark, land, bronze, f"{tmp}/ck1")
        _stream(spark, bronze, root, ck)
        if held is not None:  # a reader that took the version before still reads it
            assert held.count() == i + 1
        held = ss.read_silver(spark, root)
        _check(spark, bronze, root)
    assert vs.published(spark, root) == [3, 4]
    assert [r.n for r in ss.read_silver(spark, root, version=3).groupBy().agg(F.count("*").alias("n")).collect()] == [5]
    named = {f.name for v in (3, 4) for f in ss._folders(spark, root, v)}
    there = {f"{layer}/{v}/{d}" for layer in ("silver", "gold") for v in vs.folders(spark, f"{root}/{layer}") for d in vs.folders(spark, f"{root}/{layer}/{v}")}
    assert there == named


def test_gold_reads_silver_again_only_for_lost_extremes(spark, tmp):
    land, bronze, root, ck = (f"{tmp}/{x}" for x in ("land", "bronze", "layers", "ck2"))

    def step(i, rows):
        for k, (e, mag, sig) in enumerate(rows):
            _put(f"{land}/b{i}/{k}.json", [dict(r, significance=sig, place=f"at {e}") for r in _rows([e], ing=f"2024-03-0{i + 1}T00:00:00.000000Z", mag=mag)])
        _run(spark, land, bronze, f"{tmp}/ck1")
        _stream(spark, bronze, root, ck)
        _check(spark, bronze, root)
        b = ss.read_batches(spark, root).where(f"batch_id = {i}").first()
        return b.groups, b.stale_groups, b.silver_dates_read

    assert step(0, [("a", 2.1, 5), ("b", 2.5, 7), ("c", 2.9, 1)])[1:] == (0, 0)
    assert step(1, [("d", 2.7, 6)])[1:] == (0, 0)          # only added
    assert step(2, [("d", 2.6, 3)])[1:] == (0, 0)          # within the extremes
    assert step(3, [("d", 2.6, 3)])[1:] == (0, 0)          # nothing changed
    assert step(4, [("c", 2.2, 1)])[1:] == (1, 1)          # the strongest event got weaker
    assert step(5, [("b", None, None)])[1:] == (1, 1)      # the most significant one loses its values
    assert step(6, [("a", 3.5, 5)])[1:] == (1, 1)          # the weakest leaves for another group


def test_sums_leave_no_residue(spark, tmp):
    """Averages after many revisions are those of the values that are left."""
    land, bronze, root = (f"{tmp}/{x}" for x in ("land", "bronze", "layers"))
    for i, mags in enumerate([(2.1, 2.2, 2.3), (2.7, 2.4, 2.9), (2.3, 2.35, 2.1)]):
        for k, m in enumerate(mags):
            _put(f"{land}/b{i}/{k}.json", _rows([f"e{k}"], ing=f"2024-03-0{i + 1}T00:00:00.000000Z", mag=m))
        _run(spark, land, bronze, f"{tmp}/ck1")
        _stream(spark, bronze, root, f"{tmp}/ck2", max_files=2)
        _check(spark, bronze, root)


def test_a_missing_table_is_an_error(spark, tmp):
    with pytest.raises(FileNotFoundError):
        ss.read_silver(spark, f"{tmp}/nothing").count()


def test_progress_is_appended_once(spark, tmp):
    land, path = f"{tmp}/land", f"{tmp}/progress"
    for i in range(3):
        _put(f"{land}/b{i}/a.json", _rows([f"e{i}", f"f{i}"]))
    q = sb.start_bronze(spark, land, f"{tmp}/bronze", f"{tmp}/ck", max_files=1)
    q.awaitTermination()
    for _ in range(2):
        sb.append_progress(spark, q, path, "bronze")
    rows = sb.read_progress(spark, path).orderBy("batch_id").collect()
    assert [(r.batch_id, r.input_rows, r.query) for r in rows] == [(0, 2, "bronze"), (1, 2, "bronze"), (2, 2, "bronze")]


# ---- append table that follows the files' schema -----------------------------------


def _lines(path, *rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))


BASE = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("x", T.DoubleType())])


def _evolve(spark, tmp):
    ev.start_evolving(spark, f"{tmp}/land", f"{tmp}/table", f"{tmp}/ck", max_files=1, base=BASE).awaitTermination()
    return ev.read_evolving(spark, f"{tmp}/table")


def test_new_and_wider_columns(spark, tmp):
    _lines(f"{tmp}/land/b0/a.json", {"id": "a", "n": 1, "x": 1}, {"id": "b", "n": None})
    df = _evolve(spark, tmp)
    assert df.schema["n"].dataType == T.IntegerType() and df.columns[:3] == ["id", "n", "x"]
    _lines(f"{tmp}/land/b1/a.json", {"id": "c", "n": 1 << 40, "tags": ["t"], "at": {"lat": 1}})
    df = _evolve(spark, tmp)
    assert df.schema["n"].dataType == T.LongType()
    _lines(f"{tmp}/land/b2/a.json", {"id": "d", "n": 2.5, "at": {"lat": 1.5, "lon": 2}, "ID2": None}, {"id": "e", "n": "text", "x": True}, "broken {")
    df = _evolve(spark, tmp)
    assert df.schema["n"].dataType == T.DoubleType() and "ID2" not in df.columns
    assert df.schema["at"].dataType.fieldNames() == ["lat", "lon"]
    rows = {r.id: (r.n, r.x, r.tags, tuple(r["at"]) if r["at"] else None, r.batch) for r in df.where("id is not null").collect()}
    assert rows == {"a": (1.0, 1.0, None, None, 0), "b": (None, None, None, None, 0), "c": (float(1 << 40), None, ["t"], (1.0, None), 1),
                    "d": (2.5, None, None, (1.5, 2), 2), "e": (None, None, None, None, 2)}
    assert _evolve(spark, tmp).count() == df.count() == 6  # a restart adds nothing
    _lines(f"{tmp}/land/b3/a.json", {"id": "f", "n": 7})
    df = _evolve(spark, tmp)
    assert df.where("id = 'f'").first().n == 7.0 and len(vs.folders(spark, f"{tmp}/table/data")) == 3


def test_an_evolving_batch_that_fails_is_not_seen(spark, tmp, monkeypatch):
    _lines(f"{tmp}/land/b0/a.json", {"id": "a", "n": 1})
    _evolve(spark, tmp)
    _lines(f"{tmp}/land/b1/a.json", {"id": "b", "new": 1})
    with monkeypatch.context() as m:
        m.setattr(vs, "publish", lambda *a: 1 / 0)
        with pytest.raises(StreamingQueryException):
            _evolve(spark, tmp)
    between = ev.read_evolving(spark, f"{tmp}/table")
    assert between.count() == 1 and "new" not in between.columns
    assert sorted((r.id, r.new) for r in _evolve(spark, tmp).collect()) == [("a", None), ("b", 1)]


def test_every_poll_is_one_batch_of_as_many_files(spark, tmp):
    """Later rows revise earlier ones: were a poll's files taken in two batches, an older version could load last."""
    from seismiq.plans import queries as q
    rows = spark.range(120_000).selectExpr("id as event_id", "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) as ts", "id % 7 as user_id",
                                           "'view' as event_type", "cast(id % 300 as double) as value", "'{\"k\": 5}' as props")
    rows.repartitionByRange(2, "event_id").write.parquet(f"{tmp}/sf/events.parquet")
    parts = [p.rdd.getNumPartitions() for p in q.polls(spark, f"{tmp}/sf")]
    assert parts == [q.files_per_poll(20_000, spark.sparkContext.defaultParallelism)] * q.POLLS
    bronze = spark.read.parquet(q._run_bronze(spark, f"{tmp}/sf"))
    loads = bronze.groupBy(F.regexp_extract("source_file", "batch=([0-9]+)", 1).alias("poll")).agg(F.count_distinct("bronze_load_timestamp").alias("n"))
    assert [r.n for r in loads.collect()] == [1] * q.POLLS
    assert bronze.select("bronze_load_timestamp").distinct().count() == q.POLLS


@pytest.mark.parametrize("rows, cores, files", [(0, 12, 1), (160, 12, 1), (17_000, 12, 4), (1_000_000, 12, 12), (6_000_000, 12, 36), (6_000_000, 1, 30)])
def test_files_of_a_poll(rows, cores, files):
    from seismiq.plans.queries import files_per_poll
    assert files_per_poll(rows, cores) == files


def test_a_batch_writes_only_folders_that_held_its_events(spark, tmp, monkeypatch):
    """Folders of the same date without a changed event stay as they are, until a date has too many."""
    monkeypatch.setattr(ss, "MAX_FOLDERS", 4)
    land, bronze, root = (f"{tmp}/{x}" for x in ("land", "bronze", "layers"))

    def step(i, *ids):
        _put(f"{land}/b{i}/a.json", _rows(ids, ing=f"2024-03-{i + 1:02d}T00:00:00.000000Z", mag=float(i)))
        _run(spark, land, bronze, f"{tmp}/ck1")
        _stream(spark, bronze, root, f"{tmp}/ck2")
        _check(spark, bronze, root)
        return sorted(f.version for f in ss._folders(spark, root, i) if f.layer == "silver")

    assert step(0, "a", "b") == [0]
    assert step(1, "c") == [0, 1]
    assert step(2, "d", "e") == [0, 1, 2]
    assert step(3, "c") == [0, 2, 3]          # the folder of c alone
    assert step(4, "a", "d") == [3, 4]        # b and e move along
    assert step(5, "f") == [3, 4, 5]
    assert step(6, "g") == [3, 4, 5, 6]
    assert step(7, "h") == [7]                # too many: written as one

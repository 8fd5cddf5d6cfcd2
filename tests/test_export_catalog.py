from seismiq.operators.audit import layer_audit, table_status
from seismiq.sources import catalog
from seismiq.sources import export as ex


def test_export_upper_case_and_empty(spark, tmp):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "Mixed_Case int, lower string")
    res = ex.export(df, tmp, "Some_Table")
    assert res["rows"] == 2 and res["table_name"] == "SOME_TABLE"
    back = spark.read.parquet(ex.target_path(tmp, "some_table"))
    assert back.columns == ["MIXED_CASE", "LOWER"]
    res = ex.export(df, tmp, "Some_Table", mode="append")
    assert spark.read.parquet(ex.target_path(tmp, "some_table")).count() == 4
    empty = ex.export(df.limit(0), tmp, "empty_t")
    assert empty["rows"] == 0
    m = ex.verify_exports(spark, tmp, ["some_table", "empty_t"]).collect()
    assert {r.TABLE_NAME: r.ROWS for r in m} == {"SOME_TABLE": 4, "EMPTY_T": 0}


def test_catalog_tables_and_status(spark):
    catalog.ensure_schemas(spark, ["bronze_t", "silver_t"])
    df = spark.createDataFrame([(1,)], "x int")
    catalog.save_overwrite(df, "bronze_t.rows_t")
    catalog.save_append(df, "bronze_t.rows_t")
    catalog.save_overwrite(df, "bronze_t.rows_t")
    assert spark.table("bronze_t.rows_t").count() == 1
    catalog.save_append(df, "bronze_t.hist")
    catalog.save_append(df, "bronze_t.hist")
    assert spark.table("bronze_t.hist").count() == 2
    names = {r.tableName for r in catalog.list_tables(spark, "bronze_t").collect()}
    assert {"rows_t", "hist"} <= names
    st = {r.table_name: r for r in table_status(spark, ["bronze_t.hist", "bronze_t.nope"]).collect()}
    assert st["bronze_t.hist"].rows == 2 and st["bronze_t.hist"].status == "ok"
    assert st["bronze_t.nope"].status == "missing" and len(st["bronze_t.nope"].error) <= 80
    la = {r.layer: r.rows for r in layer_audit({"A": df, "B": df.union(df)}).collect()}
    assert la == {"A": 1, "B": 2}


def test_scale_settings():
    from seismiq.session import scale_settings
    s = scale_settings(100 << 40, 8000)          # 100 TiB on 8,000 cores
    # splits capped at 1 GiB: 102,400 map tasks (about 13 waves)
    assert int(s["spark.sql.files.maxPartitionBytes"]) == 1 << 30
    # 50 TiB shuffled / 256 MiB would be 204,800 reducers: capped
    assert int(s["spark.sql.shuffle.partitions"]) == 100_000
    m = scale_settings(1 << 40, 8000)            # 1 TiB: floor of two waves
    assert int(m["spark.sql.shuffle.partitions"]) == 16_000
    assert int(m["spark.sql.files.maxPartitionBytes"]) == 128 << 20
    assert int(scale_settings(1 << 20, 8)["spark.sql.shuffle.partitions"]) == 16


def test_bronze_stream_to_catalog_table(spark, tmp):
    import json
    import os
    from seismiq.streaming import bronze as sb
    os.makedirs(f"{tmp}/land/b1")
    with open(f"{tmp}/land/b1/x.json", "w") as f:
        f.write(json.dumps({"event_id": "e1", "magnitude": 1.0}))
    catalog.ensure_schemas(spark, ["bronze_s"])
    q = sb.start_bronze(spark, f"{tmp}/land", f"{tmp}/bronze", f"{tmp}/ck", table="bronze_s.quakes")
    q.awaitTermination()
    assert spark.table("bronze_s.quakes").count() == 1
    assert sb.stream_status(spark) == []


def test_apply_scale_reads_input_size(spark, tmp):
    from seismiq.session import apply_scale, input_bytes
    spark.range(1000).write.parquet(f"{tmp}/t")
    n = input_bytes(spark, f"{tmp}/t")
    assert n > 0
    keys = ["spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.enabled",
            "spark.sql.adaptive.skewJoin.enabled"]
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        conf = apply_scale(spark, f"{tmp}/t", 4)
        assert spark.conf.get("spark.sql.shuffle.partitions") == conf["spark.sql.shuffle.partitions"] == "8"
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)

import duckdb
from pyspark.sql import functions as F

from seismiq.llm import sharding


def compared(spark, docs, limit):
    got = sorted(map(tuple, sharding.shards(docs, limit).collect()), key=str)
    documents = docs.select("doc_id", "text").toPandas()  # noqa: F841  read by name
    return got, sorted(map(tuple, duckdb.sql(sharding.oracle(limit)).fetchall()), key=str)


def test_documents_equal_the_sql_at_any_limit(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for limit in (1 << 30, 200_000, 5_000):
        got, want = compared(spark, docs, limit)
        assert got == want
        sizes = {r[2]: r[4] for r in got}
        assert sum(sizes.values()) == sum(r[1] for r in got)
        assert all(b <= limit or sum(r[2] == s for r in got) == 1 for s, b in sizes.items())


def test_no_more_splits_than_needed(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    names = {r["shard"]: r["shard_bytes"] for r in sharding.shards(docs, 40_000).collect()}
    for s in names:  # the bucket that was split held more than the limit
        assert s == "" or sum(b for t, b in names.items() if t.startswith(s[:-1])) > 40_000


def test_repeated_rows_are_dealt_to_parts(spark):
    rows = [(None, "x" * 100)] * 50 + [(i, "y" * 10) for i in range(50)] + [(7, None), (7, ""), (8, "z" * 5_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("own"))
    got = sharding.shards(docs, 350).collect()
    assert len(got) == len(rows)
    held = {}
    for r in got:
        held.setdefault(r["shard"], []).append(r["n_bytes"])
    assert all(sum(b) <= 350 or len(b) == 1 for b in held.values())
    assert all(sum(held[r["shard"]]) == r["shard_bytes"] for r in got)
    assert sum(len(b) == 3 and set(b) == {100} for b in held.values()) >= 16


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.shards(docs, 10).count() == 0
    assert sharding.shards(spark.createDataFrame([(1, None)], "doc_id long, text string"), 10).collect()[0]["shard"] == ""

"""Sharding by extendible hashing; DataFrame functions only.

A document's hash is 60 bits of an MD5 over its id and text.  The directory
starts with one bucket (no bits); a bucket over the byte limit is split on the
next bit, others stay, until every bucket fits.  Which buckets are split depends
only on the bytes below each hash prefix, so one pass builds a histogram of
prefixes (a few bits finer than total / limit), the sums of all shorter prefixes
follow from it, and a bucket is the shortest prefix that fits.  Documents below
prefixes that are still too large go through the same pass with more bits.

Defined results: a null text has 0 bytes; a document larger than the limit gets
a shard of its own, the only kind above the limit; rows that repeat (same id and
text) have the same hash, and if they do not fit one shard are dealt to numbered
parts of it; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seismiq.llm.common import materialise, text_or_empty

HASH_BITS, FINER_BITS, PART_ROWS = 60, 4, 100_000


def hashed(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, h."""
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text_or_empty()))
    return docs.select("doc_id", F.octet_length(text_or_empty()).cast("long").alias("n_bytes"),
                       F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long").alias("h"))


def _prefix(bits: int) -> Column:
    return F.shiftright("h", HASH_BITS - bits)


def _directory(rows: DataFrame, bits: int, low: int, limit: int) -> DataFrame:
    """(cell, depth, shard_bytes): the bucket of each prefix of ``bits`` bits; depth null where none fits yet."""
    cells = materialise(rows.groupBy(_prefix(bits).alias("cell"))
                        .agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n")), "cells")
    paths = cells.withColumn("depth", F.explode(F.sequence(F.lit(low), F.lit(bits)))) \
        .withColumn("bucket", F.expr(f"shiftright(cell, {bits} - depth)"))
    # a lone row cannot be split any more
    fit = (paths.groupBy("depth", "bucket").agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("rows"))
           .where((F.col("shard_bytes") <= limit) | (F.col("rows") == 1)).drop("rows"))
    # no bucket above the lowest depth of those that fit is one: without them no key holds all cells
    lowest = fit.agg(F.min("depth")).first()[0]
    if lowest is not None:
        paths = paths.where(F.col("depth") >= lowest)
    # sort-merge: Spark's estimate does not see the explode and would broadcast a table that grows with the input
    first = (paths.hint("merge").join(fit, ["depth", "bucket"]).groupBy("cell")
             .agg(F.min(F.struct("depth", "shard_bytes")).alias("f")))
    return cells.select("cell").hint("merge").join(first, "cell", "left").select("cell", "f.depth", "f.shard_bytes")


def _name(depth: Column) -> Column:
    """The depth highest bits of the hash."""
    return F.substring(F.lpad(F.bin("h"), HASH_BITS, "0"), F.lit(1), depth)


def shards(docs: DataFrame, limit: int) -> DataFrame:
    """doc_id, n_bytes, shard (its hash prefix as bits, with .k for a part of repeated rows), depth, shard_bytes."""
    rows = materialise(hashed(docs), "hashed")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    done, low, bits = None, 0, min(HASH_BITS, max(0, math.ceil(math.log2(max(1, total) / limit))) + FINER_BITS)
    out = ["doc_id", "n_bytes", "shard", "depth", "shard_bytes"]
    while True:
        directory = _directory(rows, bits, low, limit)
        placed = materialise(rows.withColumn("cell", _prefix(bits)).hint("merge").join(directory, "cell"), "placed")
        fits = placed.where("depth is not null").withColumn("shard", _name(F.col("depth"))).select(*out)
        done = fits if done is None else done.union(fits)
        rows = placed.where("depth is null").select("doc_id", "n_bytes", "h")
        if rows.isEmpty():
            return done
        if bits == HASH_BITS:
            return done.union(_dealt(rows, limit).select(*out))
        low, bits = bits + 1, min(HASH_BITS, bits + 2 * FINER_BITS)


def _dealt(rows: DataFrame, limit: int) -> DataFrame:
    """Rows of one hash: counted, then dealt to parts that fit; runs of rows are made on many tasks."""
    per = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.col("n_bytes"))).cast("long")
    groups = rows.groupBy("doc_id", "n_bytes", "h").agg(F.count("*").alias("n")).withColumn("per", per)
    runs = (groups.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(PART_ROWS).cast("long"))))
            .repartition("h", "from"))
    each = runs.withColumn("i", F.explode(F.sequence("from", F.least(F.col("from") + PART_ROWS, F.col("n")) - 1)))
    part = F.floor(F.col("i") / F.col("per"))
    return each.select("doc_id", "n_bytes", F.concat_ws(".", _name(F.lit(HASH_BITS)), part).alias("shard"), F.lit(HASH_BITS).alias("depth"),
                       (F.least("per", F.col("n") - part * F.col("per")) * F.col("n_bytes")).alias("shard_bytes"))


def oracle(limit: int) -> str:
    return f"""
WITH d AS (SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes,
                  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS h
           FROM documents),
k AS (SELECT unnest(range(0, {HASH_BITS + 1})) AS depth),
t AS (SELECT depth, h >> ({HASH_BITS} - depth) AS bucket, sum(n_bytes) AS b, count(*) AS n FROM d, k GROUP BY ALL
      HAVING sum(n_bytes) <= {limit} OR count(*) = 1),
f AS (SELECT d.doc_id, d.n_bytes, d.h, min(t.depth) AS depth FROM d JOIN t ON t.bucket = d.h >> ({HASH_BITS} - t.depth)
      GROUP BY ALL)
SELECT f.doc_id, f.n_bytes, substr(lpad(bin(f.h), {HASH_BITS}, '0'), 1, CAST(f.depth AS INT)) AS shard,
       CAST(f.depth AS INT) AS depth, CAST(t.b AS BIGINT) AS shard_bytes
FROM f JOIN t ON t.depth = f.depth AND t.bucket = f.h >> ({HASH_BITS} - f.depth)"""

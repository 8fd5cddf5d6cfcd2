"""Append stream whose table takes up new and wider columns of late files.

Each micro-batch infers the schema of its own files and reconciles it with the
table's: columns that are new are added, integers become longs or doubles where
values need it, structs and arrays are reconciled inside.  A type that cannot be
widened (text in a number's column) keeps the table's type, and such values read
as null, as a permissive JSON reader does.  Files stay as they were written, in a
folder for each schema; a reader gets the latest schema, with null where a file
has no such column.  A batch is visible once its manifest is published, so a
replay after a failure adds nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..sources import versions as vs
from ..sources.landing import landing_glob
from ..sources.schemas import FEED_SCHEMA

_NUMBERS = (T.IntegerType, T.LongType, T.DoubleType)


def widened(known: T.DataType, found: T.DataType) -> T.DataType:
    """The type that holds both, or the known one where no type does."""
    if isinstance(known, T.StructType) and isinstance(found, T.StructType):
        return merged(known, found)
    if isinstance(known, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(widened(known.elementType, found.elementType))
    if isinstance(known, _NUMBERS) and isinstance(found, _NUMBERS):
        return max(known, found, key=lambda t: _NUMBERS.index(type(t)))
    return found if isinstance(known, T.NullType) else known


def merged(known: T.StructType, found: T.StructType) -> T.StructType:
    """The known columns in their order, widened, then the new ones; names match without regard to case."""
    names = {f.name.lower(): f for f in found.fields}
    out = [T.StructField(f.name, widened(f.dataType, names[f.name.lower()].dataType) if f.name.lower() in names else f.dataType) for f in known.fields]
    held = {f.name.lower() for f in known.fields}
    return T.StructType(out + [T.StructField(f.name, f.dataType) for f in found.fields
                               if f.name.lower() not in held and not isinstance(f.dataType, T.NullType)])


def _whole_numbers(lines: DataFrame, known: T.StructType, found: T.StructType, wide: T.StructType) -> T.StructType:
    """Decide by the batch's values where inference cannot: it calls whole numbers longs, and a column with one text text.

    A column known as int or long stays so unless a value needs a long or has a
    fraction.
    """
    names = {f.name.lower(): f.dataType for f in found.fields}
    doubt = [f.name for f in known.fields if isinstance(f.dataType, (T.IntegerType, T.LongType)) and isinstance(
        names.get(f.name.lower()), (T.StringType, T.LongType) if isinstance(f.dataType, T.IntegerType) else T.StringType)]
    if not doubt:
        return wide
    parsed = lines.select(F.from_json("value", T.StructType([T.StructField(c, T.DoubleType()) for c in doubt])).alias("r")).select("r.*")
    asked = [(F.coalesce(F.max(F.abs(f"`{c}`")), F.lit(0.0)) >= 1 << 31, F.count_if(F.col(f"`{c}`") != F.floor(f"`{c}`")) > 0) for c in doubt]
    told = parsed.agg(*[c.alias(f"{what}{i}") for i, pair in enumerate(asked) for what, c in zip(("long", "double"), pair)]).first()

    def decided(field: T.StructField, was: T.DataType) -> T.StructField:
        i = doubt.index(field.name)
        kind = T.DoubleType() if told[f"double{i}"] else T.LongType() if told[f"long{i}"] else T.IntegerType()
        return T.StructField(field.name, widened(was, kind))

    return T.StructType([decided(f, known[f.name].dataType) if f.name in doubt else f for f in wide.fields])


def _schemas(spark: SparkSession, root: str) -> list[T.StructType]:
    """The schemas that the table as published has had, oldest first; a folder of data for each."""
    return [T.StructType.fromJson(e) for e in vs.manifest(spark, root, vs.latest(spark, root))]


def _writer(root: str, base: T.StructType):
    root = root.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if vs.is_published(spark, root, batch_id):
            return
        held = _schemas(spark, root)
        known = held[-1] if held else base
        files = [r[0] for r in batch.select("source_file").distinct().collect()]  # at most max_files
        if not files:
            return
        found = spark.read.option("dropFieldIfAllNull", True).json(files).drop("_corrupt_record").schema
        wide = _whole_numbers(batch, known, found, merged(known, found))
        if not held or wide != known:
            held = [*held, wide]
        rows = batch.select(F.from_json("value", wide).alias("r"), "source_file").select("r.*", F.current_timestamp().alias("bronze_load_timestamp"), "source_file")
        rows.write.mode("overwrite").parquet(f"{root}/data/schema_id={len(held) - 1}/batch={batch_id}")
        vs.publish(spark, root, batch_id, [h.jsonValue() for h in held])
    return write_batch


def start_evolving(spark: SparkSession, landing: str, root: str, checkpoint: str, trigger: str | None = None,
                   max_files: int = 1000, base: T.StructType = FEED_SCHEMA) -> StreamingQuery:
    """Landing -> append table that follows the files' schema.  ``max_files`` bounds a micro-batch and its file list."""
    lines = (spark.readStream.option("maxFilesPerTrigger", max_files).text(landing_glob(landing))
             .select("value", F.col("_metadata.file_path").alias("source_file")))
    w = lines.writeStream.foreachBatch(_writer(root, base)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger is None else w.trigger(processingTime=trigger)
    return w.start()


STAMPS = [T.StructField("bronze_load_timestamp", T.TimestampType()), T.StructField("source_file", T.StringType())]


def _fields(value: Callable[[str], Column], own: T.StructType, wide: T.StructType) -> list[Column]:
    """The fields of a record written under ``own`` in the order and types of ``wide``; null where there is none."""
    names = {f.name.lower(): f for f in own.fields}
    found = [names.get(f.name.lower()) for f in wide.fields]
    return [_as(value(h.name), h.dataType, f.dataType) if h else F.lit(None).cast(f.dataType) for h, f in zip(found, wide.fields)]


def _as(value: Column, own: T.DataType, wide: T.DataType) -> Column:
    if own == wide:
        return value
    if isinstance(wide, T.StructType):
        fields = _fields(value.getField, own, wide)
        return F.when(value.isNotNull(), F.struct(*[c.alias(f.name) for c, f in zip(fields, wide.fields)]))
    if isinstance(wide, T.ArrayType):
        return F.transform(value, lambda x: _as(x, own.elementType, wide.elementType))
    return value.cast(wide)


def read_evolving(spark: SparkSession, root: str) -> DataFrame:
    """All published rows under the latest schema, and ``batch``."""
    root = root.rstrip("/")
    held, last = _schemas(spark, root), vs.latest(spark, root)
    if last is None:
        raise FileNotFoundError(f"no batch is published under {root}")
    latest, parts = held[-1], []
    for k, own in enumerate(held):
        files = (spark.read.schema(T.StructType(own.fields + STAMPS + [T.StructField("batch", T.IntegerType())]))
                 .parquet(f"{root}/data/schema_id={k}").where(F.col("batch") <= last))
        columns = [c.alias(f.name) for c, f in zip(_fields(F.col, own, latest), latest.fields)]
        parts.append(files.select(*columns, *[s.name for s in STAMPS], "batch"))
    return reduce(DataFrame.unionByName, parts)

"""Gold layer: hourly rollup by (event_hour, severity, region)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import hour_of


def flag_count(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` as a bigint (nulls count 0)."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def notable_place() -> Column:
    """Place of the strongest event in the group.

    Ties on magnitude go to the largest ``event_id``; unknown magnitudes rank
    below any known one.  Deterministic, unlike taking the first row.
    """
    return F.max_by("place", F.struct(F.col("magnitude"), F.col("event_id")))


def gold(silver: DataFrame, stamp: bool = True, sort: bool = False,
         unique_ids: bool = True) -> DataFrame:
    """Silver -> Gold (14 columns).

    One aggregation with map-side partial aggregation: the shuffle carries
    one row per (map task, hour, severity, region), so a hot group does not
    concentrate raw rows.

    ``unique_ids``: Silver holds exactly one row per non-null ``event_id``
    (the dedup guarantees it), so the distinct count of ids equals the count
    of ids and needs no extra aggregation level.  Pass ``False`` for an
    input that may repeat an id: ``countDistinct`` then adds a second
    aggregation level keyed by (group, event_id).
    ``sort`` reproduces the global (hour desc, max magnitude desc) order of
    the table; leave it off when the reader sorts.
    """
    distinct = F.count("event_id") if unique_ids else F.countDistinct("event_id")
    aggs = [
        F.count(F.lit(1)).alias("total_events"),
        distinct.alias("unique_events"),
        F.round(F.avg("magnitude"), 2).alias("avg_magnitude"),
        F.max("magnitude").alias("max_magnitude"),
        F.min("magnitude").alias("min_magnitude"),
        F.round(F.avg("depth_km"), 2).alias("avg_depth_km"),
        flag_count(F.col("tsunami_flag") == F.lit(True)).alias("tsunami_count"),
        flag_count(F.col("alert_level") != F.lit("none")).alias("alerted_events"),
        F.max("significance").alias("max_significance"),
        notable_place().alias("most_notable_place"),
    ]
    if stamp:
        aggs.append(F.current_timestamp().alias("gold_load_timestamp"))
    out = (silver.groupBy(hour_of("event_timestamp").alias("event_hour"), "severity", "region")
                 .agg(*aggs))
    if sort:
        out = out.orderBy(F.col("event_hour").desc(), F.col("max_magnitude").desc())
    return out

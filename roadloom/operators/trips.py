"""Interval joins of fixes with trips, and traces."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadloom.operators.ranking import numbered

BUCKET_S = 4 * 3600


def bucketed(trips: DataFrame, start: str, end: str, width: int = BUCKET_S) -> DataFrame:
    """A row for each time bucket that an interval touches (column ``bucket``)."""
    first, last = F.floor(F.col(start) / width), F.floor(F.col(end) / width)
    return trips.filter(F.col(start) <= F.col(end)).withColumn("bucket", F.explode(F.sequence(first, last)))


def in_interval(points: DataFrame, trips: DataFrame, key: str, t: str, start: str, end: str, how: str = "inner", width: int = BUCKET_S) -> DataFrame:
    """Points with the trips of the same key that hold their time (both ends inclusive).

    The join is on (key, time bucket) with a residual range test, so one busy
    key is spread over its buckets, and a point is compared with the trips of
    its own hours only. A point lies in one bucket, so no pair comes twice.
    """
    left = points.withColumn("_bucket", F.floor(F.col(t) / width))
    right = bucketed(trips, start, end, width).withColumnRenamed(key, "_key")
    on = (F.col(key) == F.col("_key")) & (F.col("_bucket") == F.col("bucket")) & F.col(t).between(F.col(start), F.col(end))
    return left.join(right, on, how).drop("_bucket", "_key", "bucket")


def hired(points: DataFrame, trips: DataFrame, key: str, t: str, start: str, end: str) -> DataFrame:
    """Points within any trip of their key."""
    return in_interval(points, trips, key, t, start, end, "left_semi")


def hire_flags(points: DataFrame, trips: DataFrame, key: str, t: str, start: str, end: str, point_id: str) -> DataFrame:
    """All points of keys that have trips, with hire_status TRUE or FALSE."""
    known = points.join(trips.select(F.col(key)).distinct(), key, "left_semi")
    yes = hired(known, trips, key, t, start, end).select(point_id, F.lit("TRUE").alias("hire_status"))
    return known.join(yes, point_id, "left").withColumn("hire_status", F.coalesce("hire_status", F.lit("FALSE")))


def long_enough(points: DataFrame, key: str, least: int) -> DataFrame:
    """Points of traces with at least ``least`` points."""
    return points.withColumn("_n", F.count("*").over(Window.partitionBy(key))).filter(F.col("_n") >= least).drop("_n")


def traces(points: DataFrame, key: str, t: str, *others: str) -> DataFrame:
    """One row per trace: its points, ordered by time. A trace is what a matcher takes as a whole."""
    return points.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(t, *others))).alias("points"))


def sample_trips(points: DataFrame, key: str, rate: float, seed: int = 0) -> DataFrame:
    """int(n * rate) traces without replacement: those with the least seeded hash. The same call gives the same sample."""
    ids = points.select(key).distinct()
    n = ids.count()
    head = F.substring(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))), 1, 15)
    hashed = ids.withColumn("_h", F.conv(head, 16, 10).cast("long"))
    chosen = numbered(hashed, ["_h", key], "_r").filter(F.col("_r") <= int(n * rate)).select(key)
    return points.join(chosen, key, "left_semi")

"""Cleaning of heartbeats and trips."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadloom.functions.text import first_number, is_missing, wkt_point
from roadloom.operators.ranking import numbered, quantiles
from roadloom.params import Params


def drop_incomplete(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with nulls in those of ``columns`` that exist go."""
    return df.dropna(subset=[c for c in columns if c in df.columns])


def clean_heartbeats(raw: DataFrame) -> DataFrame:
    """Renames the meter, fills device times from the server's, drops incomplete rows and repeated headers, and parses points."""
    named = raw.withColumnRenamed("f0_", "meter_id") if "f0_" in raw.columns else raw
    filled = named.withColumn("device_time", F.coalesce("device_time", "server_time"))
    whole = drop_incomplete(filled, ["device_time", "meter_id", "location"])
    rows = whole.filter(F.col("device_time").cast("string") != "device_time")
    return rows.withColumns({"lon": wkt_point(F.col("location"))["lon"], "lat": wkt_point(F.col("location"))["lat"]})


def inside_box(lat: Column, lon: Column, p: Params = Params()) -> Column:
    return lat.between(*p.lat_range) & lon.between(*p.lon_range)


def valid_live(lat: Column, lon: Column, speed: Column, p: Params = Params()) -> Column:
    """The live path's test: in the box, 0 <= speed <= top."""
    return inside_box(lat, lon, p) & speed.between(0.0, p.top_kph)


def valid_for_conversion(lat: Column, lon: Column, speed: Column, p: Params = Params()) -> Column:
    """The converter's test: speed above 0, and no (0, 0) point."""
    return ~((lat == 0) & (lon == 0)) & inside_box(lat, lon, p) & (speed > 0) & (speed <= p.top_kph)


def invalid_trip(s_lat: Column, s_lon: Column, e_lat: Column, e_lon: Column, near: float) -> Column:
    """Same or nearly the same ends, an end at zero, or latitude equal to longitude; comparisons with nulls are false."""
    tests = [
        (s_lat == e_lat) & (s_lon == e_lon),
        (F.abs(s_lat - e_lat) < near) & (F.abs(s_lon - e_lon) < near),
        (s_lat == 0) & (s_lon == 0),
        (e_lat == 0) & (e_lon == 0),
        s_lat == s_lon,
        e_lat == e_lon,
    ]
    return reduce(lambda a, b: a | b, [F.coalesce(t, F.lit(False)) for t in tests])


def drop_outliers(df: DataFrame, fare: str, columns: list[str], p: Params = Params()) -> DataFrame:
    """fare <= bound, and each column at most Q99 + (Q99 - Q1), all limits from the same input. A null fails.

    The quantiles are exact, from a distributed order of each column; the
    limits go into the filter as numbers, so that it is pushed down.
    """
    kept = F.col(fare) <= p.fare_upper_bound
    for c in columns:
        low, high = quantiles(df, c, [0.01, 0.99])
        kept = kept & (F.col(c) <= 2 * high - low if high is not None else F.lit(False))
    return df.filter(kept)


def missing_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: missing values in each column."""
    numeric = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    return df.agg(*[F.count_if(is_missing(F.col(c), c in numeric)).alias(c) for c in columns])


def assert_complete(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fails at run time on the first row with a missing value."""
    bad = reduce(lambda a, b: a | b, [is_missing(F.col(c)) for c in columns])
    return df.filter(F.when(bad, F.raise_error(F.lit("missing value"))).otherwise(F.lit(True)).cast("boolean"))


def dedup_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def extend_ids(known: DataFrame, ids: DataFrame, key: str = "id", name: str = "name", prefix: str = "Car") -> DataFrame:
    """Known (id, name) plus unseen ids, which get the next numbers in id order.

    Numbering goes by ranges of the ids, not through one task.
    """
    fresh = ids.select(key).filter(F.col(key).isNotNull()).distinct().join(known.select(key), key, "left_anti")
    base = known.agg(F.count("*").alias("_n"))
    ranked = numbered(fresh, [key], "_r").join(F.broadcast(base))
    return known.select(key, name).unionByName(ranked.select(key, F.concat(F.lit(prefix), (F.col("_n") + F.col("_r")).cast("string")).alias(name)))


def highest_number(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.max(first_number(F.col(name))).alias("highest"))


def frequent_only(df: DataFrame, key: str, least: int) -> DataFrame:
    """Rows whose key occurs more than ``least`` times."""
    often = df.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > least)
    return df.join(often.select(key), key, "left_semi")

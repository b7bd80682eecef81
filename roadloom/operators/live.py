"""The live view: decayed speeds, tiles of packed records, updates and fusion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadloom.functions import traffic_bits as bits
from roadloom.functions.graphid import tile_of_pseudo
from roadloom.params import Params


def decay(age_s: Column, window_s: float, floor: float = 0.1) -> Column:
    return F.greatest(F.lit(floor), 1.0 - age_s / F.lit(float(window_s)))


def decayed_mean(samples: DataFrame, keys: list[str], speed: str, age_s: Column, window_s: float, floor: float = 0.1, closed: bool = True) -> DataFrame:
    """(keys, speed_kph, samples): weighted mean of what is not older than the window (younger, if not ``closed``). Plain sums, so it combines before the shuffle and runs the same in batch and stream."""
    fresh = samples.withColumn("_age", age_s).filter(F.col("_age") <= window_s if closed else F.col("_age") < window_s).withColumn("_w", decay(F.col("_age"), window_s, floor))
    sums = fresh.groupBy(*keys).agg(F.sum(F.col(speed) * F.col("_w")).alias("_vw"), F.sum("_w").alias("_sw"), F.count("*").alias("samples"))
    return sums.filter(F.col("_sw") >= 0.01).select(*keys, (F.col("_vw") / F.col("_sw")).alias("speed_kph"), "samples")


def plausible(speeds: DataFrame, p: Params = Params()) -> DataFrame:
    return speeds.filter(F.col("speed_kph").between(1.0, p.top_kph))


def records(speeds: DataFrame, p: Params = Params(), offset: int = 1) -> DataFrame:
    """Adds raw_speed, congestion and the packed record to (…, speed_kph)."""
    raw, band = bits.encode_speed(F.col("speed_kph"), p.speed_clamp), bits.congestion_band(F.col("speed_kph"), offset)
    return speeds.withColumns({"raw_speed": raw, "congestion": band}).withColumn("record", bits.record(F.col("raw_speed"), F.col("congestion")))


def to_tiles(speeds: DataFrame, edge: str, per_tile: int = 1000) -> DataFrame:
    tile, index = tile_of_pseudo(F.col(edge), per_tile)
    return speeds.withColumns({"tile": tile, "edge_index": index})


def last_write(updates: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """The value with the greatest sequence number of each key (of equal numbers, the greatest value)."""
    return updates.groupBy(*keys).agg(F.max_by(value, F.struct(order, value)).alias(value))


def dense(present: DataFrame, tiles: DataFrame, policy: str = "invalid", p: Params = Params()) -> DataFrame:
    """(tile, edge_index, record) for every edge 0..edge_count-1 of every tile in ``tiles`` (tile, edge_count). Edges without a record are invalid, or look like 127 km/h (``policy`` 'fast')."""
    grid = tiles.filter("edge_count > 0").select("tile", F.explode(F.sequence(F.lit(0), F.col("edge_count") - 1)).alias("edge_index"))
    gap = bits.invalid() if policy == "invalid" else bits.record(bits.encode_speed(F.lit(127.0), 127), F.lit(7))
    return grid.join(present.select("tile", "edge_index", "record"), ["tile", "edge_index"], "left").select("tile", "edge_index", F.coalesce("record", gap).alias("record"))


def constant_tile(spark, tile: int, edge_count: int, raw_speed: int) -> DataFrame:
    """Every edge of a tile with one encoded speed and congestion 1, 2, 3."""
    r = bits.pack(overall=raw_speed, speed1=raw_speed, speed2=raw_speed, speed3=raw_speed, breakpoint1=255, breakpoint2=255, congestion1=1, congestion2=2, congestion3=3)
    return spark.range(edge_count).select(F.lit(tile).alias("tile"), F.col("id").cast("int").alias("edge_index"), r.alias("record"))


def upsert(current: DataFrame, updates: DataFrame) -> DataFrame:
    """Listed edges take the new record; edges that the tile doesn't have are ignored. Adds whether a row changed hands."""
    new = updates.select("tile", "edge_index", F.col("record").alias("_new"))
    joined = current.join(new, ["tile", "edge_index"], "left")
    return joined.select("tile", "edge_index", F.coalesce("_new", "record").alias("record"), F.col("_new").isNotNull().alias("updated"))


def upsert_constant(current: DataFrame, raw_speed: int) -> DataFrame:
    return current.withColumn("record", bits.with_speed(F.col("record"), F.lit(raw_speed)))


def profile_report(hb: DataFrame, valid: Column) -> DataFrame:
    """One row: counts, speed range and bounding box of the valid rows."""
    on = lambda c: F.when(valid, F.col(c))
    return hb.agg(
        F.count("*").alias("rows"), F.count_if(valid).alias("valid_rows"), F.avg(on("speed")).alias("avg_speed"), F.min(on("speed")).alias("min_speed"), F.max(on("speed")).alias("max_speed"),
        F.min(on("lat")).alias("min_lat"), F.max(on("lat")).alias("max_lat"), F.min(on("lon")).alias("min_lon"), F.max(on("lon")).alias("max_lon"),
    )


def fade(age_s: Column, fade_s: int = 3600) -> Column:
    return F.greatest(F.lit(0.0), 1.0 - age_s / F.lit(float(fade_s)))


def fused_speed(live: Column, age_s: Column, coverage: Column, predicted: Column, constrained: Column, freeflow: Column, second_of_day: Column, default_kph: float, p: Params = Params()) -> Column:
    """Live speed, faded over an hour and by its share of the edge, blended with the best of predicted, constrained (7 to 19 h), free flow and default."""
    daytime = second_of_day.between(7 * 3600, 19 * 3600 - 1)
    fallback = F.coalesce(predicted, F.when(daytime, constrained), freeflow, F.lit(default_kph))
    share = F.when(live.isNotNull(), fade(age_s, p.fade_s) * coverage).otherwise(F.lit(0.0))
    return share * F.coalesce(live, F.lit(0.0)) + (1.0 - share) * fallback


def speed_penalty(avg_kph: Column, top_kph: Column) -> Column:
    return F.when(avg_kph > top_kph, (avg_kph - top_kph) * 0.05).otherwise(F.lit(0.0))


def travel_seconds(length_m: Column, kph: Column) -> Column:
    return F.when(kph > 0, length_m / (kph / 3.6))


def coverage_check(df: DataFrame, key: str, value: str) -> DataFrame:
    """Whether all values of a key agree."""
    return df.groupBy(key).agg((F.count_distinct(value) == 1).alias("consistent"))


def middle_row(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The row in the middle (n div 2, from 0) of each key."""
    w = Window.partitionBy(key)
    placed = df.withColumns({"_r": F.row_number().over(w.orderBy(*order)), "_n": F.count("*").over(w)})
    return placed.filter(F.col("_r") == F.floor(F.col("_n") / 2) + 1).drop("_r", "_n")

"""Speeds along traces, and their distribution over edges and weekly slots."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadloom.functions.geo import distance_km, step_kph
from roadloom.functions.timeslot import slot_of_epoch
from roadloom.params import Params


def trace_speeds(points: DataFrame, key: str, p: Params, ties: list[str]) -> DataFrame:
    """Adds rn, dt_s, dist_km, raw_kph and speed_kph to (key, t, lat, lon).

    raw_kph is 0 on the first point and null where time stands still. Interior
    dips (below both raw neighbours) become the neighbours' mean. Points more
    than max_gap_s after the one before go at last. One window serves all steps.
    """
    w = Window.partitionBy(key).orderBy("t", *ties)
    before = lambda c: F.lag(c).over(w)
    steps = points.withColumns(
        {"rn": F.row_number().over(w), "dt_s": (F.col("t") - before("t")).cast("double"), "dist_km": distance_km(before("lat"), before("lon"), F.col("lat"), F.col("lon"))}
    )
    raw = steps.withColumn("raw_kph", F.when(F.col("rn") == 1, F.lit(0.0)).otherwise(step_kph(F.col("dist_km"), F.col("dt_s"))))
    left, right = F.lag("raw_kph").over(w), F.lead("raw_kph").over(w)
    dip = (F.col("raw_kph") < left) & (F.col("raw_kph") < right)
    smooth = raw.withColumn("speed_kph", F.when(dip, (left + right) / 2).otherwise(F.col("raw_kph")))
    return smooth.filter((F.col("rn") == 1) | (F.col("dt_s") <= p.max_gap_s))


def on_edges(speeds: DataFrame, matched: DataFrame, key: str, p: Params) -> DataFrame:
    """(key, edge_id, slot, speed_kph): points on matched edges with plausible speeds.

    ``matched`` has (key, points array<struct<edge_index,type>>, edges
    array<struct<id,length>>); its points stand beside the trace's by place.
    A trace without match drops out; of several matches the first counts.
    """
    one = matched.dropDuplicates([key])
    placed = one.select(key, "edges", F.posexplode("matched_points").alias("pos", "m"))
    edge = F.get(F.col("edges"), F.col("m.edge_index"))
    named = placed.filter((F.col("m.type") != "unmatched") & (F.col("pos") > 0)).select(F.col(key).alias("_key"), "pos", edge["id"].alias("edge_id"))
    rows = speeds.join(named, (F.col(key) == F.col("_key")) & (F.col("rn") == F.col("pos") + 1))
    good = rows.filter(F.col("edge_id").isNotNull() & (F.col("speed_kph") > p.min_kph) & (F.col("speed_kph") < p.max_kph))
    return good.select(key, "edge_id", slot_of_epoch(F.col("t")).alias("slot"), "speed_kph")


def edge_ids(edges):
    """Column: the ids of an edge list as texts, nulls left out."""
    return F.transform(F.filter(edges, lambda e: e["id"].isNotNull()), lambda e: e["id"].cast("string"))


def collect_speeds(obs: DataFrame, edge: str, slot: str, speed: str) -> DataFrame:
    """(edge, slot, speeds sorted): map-side lists are merged, whatever the number of input files."""
    return obs.groupBy(edge, slot).agg(F.array_sort(F.collect_list(speed)).alias("speeds"))


def nested_json(collected: DataFrame, edge: str, slot: str) -> DataFrame:
    """(edge, json): {slot: [speeds]} with slots in order."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(slot).alias("key"), F.col("speeds").alias("value"))))
    return collected.groupBy(edge).agg(F.to_json(F.map_from_entries(F.transform(entries, lambda e: F.struct(e["key"].cast("string"), e["value"])))).alias("json"))

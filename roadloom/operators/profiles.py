"""Weekly speed profiles: filling, trimming, smoothing and export rows.

A week is 2016 slots. Steps that look at neighbouring slots work on whole
weeks: one row per edge with its observed slots (bounded by 2016), many edges
at a time as a matrix. One shuffle by edge serves filling, trimming, smoothing
and encoding.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadloom.functions.encode import compress, to_text
from roadloom.functions.graphid import index, level, name, tile, tile_path
from roadloom.functions.text import contains_folded
from roadloom.functions.timeslot import slot_hour
from roadloom.params import SLOTS_PER_DAY, SLOTS_PER_WEEK, Params

EDGES_AT_ONCE = 256


def weeks(obs: DataFrame, edge: str, slot: str, speed: str) -> DataFrame:
    """(edge, week): observed slots as array<struct<slot,total,n>>; slots outside the week or not numeric go."""
    s = F.col(slot).try_cast("int")
    good = obs.select(F.col(edge), s.alias("slot"), F.col(speed).cast("double").alias("v")).filter(s.between(0, SLOTS_PER_WEEK - 1))
    cells = good.groupBy(edge, "slot").agg(F.sum("v").alias("total"), F.count("v").alias("n"))
    return cells.groupBy(edge).agg(F.collect_list(F.struct("slot", "total", "n")).alias("week"))


def fill_weeks(total: np.ndarray, n: np.ndarray, k: int) -> np.ndarray:
    """Means of observed slots; an empty slot takes the mean of all speeds within k slots, in ascending order, so that filled slots (one speed each) feed later ones. NaN where nothing is near."""
    total, n = total.copy(), n.copy()
    width = total.shape[1]
    out = np.where(n > 0, total / np.maximum(n, 1), np.nan)
    for t in range(width):
        empty = n[:, t] == 0
        if empty.any():
            a, b = max(0, t - k), min(width, t + k + 1)
            many = n[empty, a:b].sum(axis=1)
            mean = np.where(many > 0, total[empty, a:b].sum(axis=1) / np.maximum(many, 1), np.nan)
            out[empty, t] = mean
            total[empty, t] = np.nan_to_num(mean)
            n[empty, t] = many > 0
    return out


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    weeks_ = batch.column("week").to_pylist()
    for at in range(0, len(weeks_), EDGES_AT_ONCE):
        part = weeks_[at : at + EDGES_AT_ONCE]
        total, n = np.zeros((len(part), SLOTS_PER_WEEK)), np.zeros((len(part), SLOTS_PER_WEEK), dtype=np.int64)
        for i, week in enumerate(part):
            for c in week:
                total[i, c["slot"]], n[i, c["slot"]] = c["total"], c["n"]
        yield slice(at, at + len(part)), total, n


def _fill(edge: str, k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(edge)
        for rows, total, n in _matrices(batch):
            filled = fill_weeks(total, n, k)
            i, slot = np.nonzero(~np.isnan(filled))
            part = ids.slice(rows.start, rows.stop - rows.start)
            yield pa.RecordBatch.from_arrays([part.take(pa.array(i)), pa.array(slot.astype(np.int32)), pa.array(filled[i, slot]), pa.array(n[i, slot] == 0)], names=[edge, "slot", "speed_kph", "filled"])


def fill_temporal(obs: DataFrame, edge: str, slot: str, speed: str, k: int) -> DataFrame:
    """(edge, slot, speed_kph, filled): neighbour filling along the week."""
    w = weeks(obs, edge, slot, speed)
    kind = w.schema[edge].dataType.simpleString()
    return w.mapInArrow(partial(_fill, edge, k), f"{edge} {kind}, slot int, speed_kph double, filled boolean")


def fill_fold(obs: DataFrame, edge: str, slot: str, speed: str, k: int, slots: int = SLOTS_PER_WEEK) -> DataFrame:
    """The same as column expressions only, for short grids: a fold whose state is the slots so far."""
    w = weeks(obs, edge, slot, speed)
    kind = "array<struct<s:double,c:double>>"
    find = lambda t: F.filter("week", lambda c: c["slot"] == t)
    cell = lambda t: F.coalesce(F.get(F.transform(find(t), lambda c: F.struct(c["total"].alias("s"), c["n"].cast("double").alias("c"))), F.lit(0)), F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("c")))
    raw = F.transform(F.sequence(F.lit(0), F.lit(slots - 1)), cell)
    rows = w.withColumn("raw", raw)

    def step(acc: Column, t: Column) -> Column:
        near = F.concat(F.slice(acc, F.greatest(t - k + 1, F.lit(1)), F.least(t, F.lit(k))), F.slice("raw", t + 1, k + 1))
        s = F.aggregate(near, F.lit(0.0), lambda a, x: a + x["s"])
        c = F.aggregate(near, F.lit(0.0), lambda a, x: a + x["c"])
        own = F.get("raw", t)
        made = F.when(own["c"] > 0, own).when(c > 0, F.struct((s / F.when(c > 0, c)).alias("s"), F.lit(1.0).alias("c"))).otherwise(F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("c")))
        return F.concat(acc, F.array(made))

    folded = rows.select(edge, F.aggregate(F.sequence(F.lit(0), F.lit(slots - 1)), F.array().cast(kind), step).alias("all"), "raw")
    out = folded.select(edge, F.posexplode("all").alias("slot", "x"), "raw")
    return out.filter("x.c > 0").select(edge, "slot", (F.col("x.s") / F.col("x.c")).alias("speed_kph"), (F.get("raw", F.col("slot"))["c"] == 0).alias("filled"))


def fill_same_time(means: DataFrame, edge: str) -> DataFrame:
    """The documented alternative: a missing slot takes the mean of the same time on the other days. ``means`` has (edge, slot, speed_kph)."""
    grid = means.select(edge).distinct().withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(SLOTS_PER_WEEK - 1))))
    day = F.avg("speed_kph").over(Window.partitionBy(edge, F.col("slot") % SLOTS_PER_DAY))
    joined = grid.join(means.select(edge, "slot", "speed_kph"), [edge, "slot"], "left").withColumn("other", day)
    return joined.select(edge, "slot", F.coalesce("speed_kph", "other").alias("speed_kph"), F.col("speed_kph").isNull().alias("filled")).filter("speed_kph is not null")


def trimmed_means(obs: DataFrame, edge: str, slot: str, speed: str, factor: float) -> DataFrame:
    """(edge, slot, speed_kph): mean of the speeds within the quartiles, widened by factor x IQR. One shuffle: the cell's speeds travel as one array."""
    cells = obs.groupBy(edge, slot).agg(F.percentile(speed, F.array(F.lit(0.25), F.lit(0.75))).alias("q"), F.collect_list(speed).alias("v"))
    q1, q3 = F.col("q")[0], F.col("q")[1]
    kept = F.filter("v", lambda x: x.between(q1 - factor * (q3 - q1), q3 + factor * (q3 - q1)))
    total = F.aggregate(kept, F.lit(0.0), lambda a, x: a + x)
    return cells.select(edge, slot, F.when(F.size(kept) > 0, total / F.size(kept)).alias("speed_kph"))


def hampel(x: np.ndarray, window: int, sigmas: float, scale: float) -> np.ndarray:
    """Weeks (rows) whose outliers are replaced by their window's median. Single precision out.

    A slot's window is that around the nearest slot with a whole window: the week's ends share the first and the last
    one. Weeks shorter than a window have none and stay as they are.
    """
    if window < 3 or window % 2 == 0:
        raise ValueError("the window must be odd and at least 3")
    slots, reach = x.shape[1], window // 2
    if slots >= window:
        centre = np.clip(np.arange(slots), reach, slots - 1 - reach)
        middle = lambda values: np.partition(values, reach, axis=2)[:, :, reach]
        near = x[:, centre[:, None] + np.arange(-reach, reach + 1)]
        usual = middle(near)
        deviation = middle(np.abs(near - usual[:, :, None]))
        x = np.where(np.abs(x - usual) <= sigmas * scale * deviation, x, usual)
    return x.astype(np.float32)


def _profile(edge: str, p: Params, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, default = batch.column(edge), batch.column("default_kph").to_numpy(zero_copy_only=False)
        for rows, total, n in _matrices(batch):
            raw = np.where(n > 0, total / np.maximum(n, 1), default[rows][:, None]).astype(np.float32)
            smooth = hampel(raw.astype(np.float64), p.hampel_window, p.hampel_sigmas, p.mad_scale)
            text = [to_text(c) for c in compress(smooth)] if p.encode else [""] * len(smooth)
            part = ids.slice(rows.start, rows.stop - rows.start)
            yield pa.RecordBatch.from_arrays([part, pa.array(list(smooth), pa.list_(pa.float32())), pa.array(text)], names=[edge, "profile", "encoded"])


def smooth_profiles(means: DataFrame, defaults: DataFrame | float, edge: str, p: Params) -> DataFrame:
    """(edge, profile array<float>, encoded): trimmed means by slot, the edge's default elsewhere, Hampel-smoothed and encoded. ``defaults`` is one speed for all, or (edge, default_kph)."""
    w = weeks(means.filter("speed_kph is not null"), edge, "slot", "speed_kph")
    w = w.join(defaults, edge) if isinstance(defaults, DataFrame) else w.withColumn("default_kph", F.lit(float(defaults)))
    kind = w.schema[edge].dataType.simpleString()
    return w.select(edge, "week", "default_kph").mapInArrow(partial(_profile, edge, p), f"{edge} {kind}, profile array<float>, encoded string")


def edge_types(edges: DataFrame, ways: DataFrame, roads: DataFrame, strict: bool) -> DataFrame:
    """Edges with way_id and highway_type: unknown way -> 'unknown'; an edge without way fails (strict) or is left out."""
    hop = edges.join(ways, "edge_no", "left").join(roads.select("way_id", "highway_type"), "way_id", "left")
    typed = hop.withColumn("highway_type", F.coalesce("highway_type", F.lit("unknown")))
    if strict:
        return typed.filter(F.when(F.col("way_id").isNull(), F.raise_error(F.lit("edge without way"))).otherwise(F.lit(True)).cast("boolean"))
    return typed.filter("way_id is not null")


def rule_speeds(types: DataFrame, p: Params) -> DataFrame:
    """Adds freeflow_kph and constrained_kph by road type, defaults for the rest."""
    pick = lambda i, other: F.coalesce(F.try_element_at(F.create_map(*[x for t, v in p.road_speeds.items() for x in (F.lit(t), F.lit(v[i]))]), F.col("highway_type")), F.lit(other))
    return types.withColumns({"freeflow_kph": pick(0, p.freeflow_kph), "constrained_kph": pick(1, p.constrained_kph)})


def data_speeds(obs: DataFrame, edge: str, slot: str, speed: str, p: Params) -> DataFrame:
    """(edge, freeflow_kph): a high percentile of off-peak speeds."""
    quiet = obs.filter(slot_hour(F.col(slot)).isin(list(p.off_peak_hours)))
    return quiet.groupBy(edge).agg(F.percentile(speed, F.lit(p.percentile)).alias("freeflow_kph"))


def tunnel_edges(ways: DataFrame, roads: DataFrame) -> DataFrame:
    return ways.join(roads.filter(contains_folded(F.col("name"), "tunnel")).select("way_id"), "way_id", "left_semi").select("edge_no").distinct()


def without_edges(df: DataFrame, gone: DataFrame, edge: str = "edge_no") -> DataFrame:
    return df.join(gone.select(edge).distinct(), edge, "left_anti")


def export_rows(profiles: DataFrame, graph_id: str, freeflow: str, constrained: str, encoded: str) -> DataFrame:
    """(file_path, line): headerless rows of the tile-hierarchy files."""
    g = F.col(graph_id)
    line = F.concat_ws(",", name(g, masked=False), F.col(freeflow).cast("int").cast("string"), F.col(constrained).cast("int").cast("string"), F.col(encoded))
    return profiles.select(tile_path(level(g), tile(g)).alias("file_path"), index(g, masked=False).alias("edge_in_tile"), line.alias("line"))

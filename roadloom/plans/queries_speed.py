"""Queries over speeds, profiles, tiles, sinks, streams and consumers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.functions import encode, geo, graphid
from roadloom.functions import traffic_bits as bits
from roadloom.functions.timeslot import slot_hour, slot_of_epoch
from roadloom.operators import live, profiles, speeds, trips
from roadloom.params import Params
from roadloom.plans.registry import query
from roadloom.plans.views import Tables
from roadloom.session import scratch
from roadloom.sinks import files as sinks
from roadloom.sources import files as src
from roadloom.sources import matcher
from roadloom.sources.tiles import TileTar
from roadloom.streaming import live as stream

P = Params(max_gap_s=3600.0, min_points=5)
r6 = lambda c: F.round(c, 6)

# DuckDB pieces: distance, dip smoothing, matched points.
DIST = """atan2(sqrt(power(cos(g2) * sin(dl), 2) + power(cos(g1) * sin(g2) - sin(g1) * cos(g2) * cos(dl), 2)), sin(g1) * sin(g2) + cos(g1) * cos(g2) * cos(dl)) * 6378.1::double"""
STEPS = """geo AS MATERIALIZED (select *, atan(tan(radians(lat)) * power(1 - 1 / 298.257223563::double, 2)) as g2 from $pts),
steps AS MATERIALIZED (select *, row_number() over w as rn, cast(t - lag(t) over w as double) as dt_s, lag(g2) over w as g1, radians(lon - lag(lon) over w) as dl from geo window w as (partition by trip_id order by t, event_id)),
kph AS MATERIALIZED (select *, DIST as dist_km, case when rn = 1 then 0 when dt_s > 0 then (DIST) / (dt_s / 3600) end as raw_kph from steps),
smooth AS MATERIALIZED (select *, case when raw_kph < lag(raw_kph) over w and raw_kph < lead(raw_kph) over w then (lag(raw_kph) over w + lead(raw_kph) over w) / 2 else raw_kph end as speed_kph
  from kph window w as (partition by trip_id order by t, event_id)),
kept AS MATERIALIZED (select * from smooth where rn = 1 or dt_s <= 3600),
hits AS MATERIALIZED (select trip_id, cast(trunc(abs(lat) * 100000::double + abs(lon) * 100000::double) as bigint) % 10000 as edge_id,
  cast(((t // 86400 + 4) % 7) * 288 + (t % 86400) // 300 as int) as slot, speed_kph from kept where rn > 1 and event_id % 7 <> 0 and speed_kph > 5 and speed_kph < 150)""".replace("DIST", DIST)


def _speeds(t: Tables) -> DataFrame:
    return speeds.trace_speeds(t.pts.select("trip_id", "t", "lat", "lon", "event_id"), "trip_id", P, ["event_id"])


def _hits(t: Tables) -> DataFrame:
    traces = trips.traces(t.pts, "trip_id", "t", "event_id", "lat", "lon")
    return speeds.on_edges(_speeds(t), matcher.RecordedMatcher(matcher.pseudo_match(traces)).match(traces), "trip_id", P)


@query("m01_w01_w02_steps", "select trip_id, rn, dt_s, round(dist_km, 6) as dist_km from kph", STEPS)
def m01(t: Tables) -> DataFrame:
    return geo.with_steps(t.pts, "trip_id", "t", "lat", "lon", ["event_id"]).select("trip_id", F.col("rn").cast("long").alias("rn"), "dt_s", r6("dist_km").alias("dist_km"))


@query("m02_w03_p18_speeds", "select trip_id, event_id, round(raw_kph, 6) as raw_kph, round(speed_kph, 6) as speed_kph from kept", STEPS)
def m02(t: Tables) -> DataFrame:
    return _speeds(t).select("trip_id", "event_id", r6("raw_kph").alias("raw_kph"), r6("speed_kph").alias("speed_kph"))


@query("j05_j06_j07_p17_on_edges", "select trip_id, edge_id, slot, round(speed_kph, 6) as speed_kph from hits", STEPS)
def j05(t: Tables) -> DataFrame:
    return _hits(t).select("trip_id", "edge_id", "slot", r6("speed_kph").alias("speed_kph"))


@query("w08_drop_first", "select trip_id, event_id from steps where rn > 1", STEPS)
def w08(t: Tables) -> DataFrame:
    return geo.with_steps(t.pts, "trip_id", "t", "lat", "lon", ["event_id"]).filter("rn > 1").select("trip_id", "event_id")


@query("a01_a02_collect_speeds", "select edge_no, slot, count(*) as n, string_agg(cast(cast(speed_kph as int) as varchar), ',' order by speed_kph) as speeds from $obs group by edge_no, slot")
def a01(t: Tables) -> DataFrame:
    got = speeds.collect_speeds(t.obs, "edge_no", "slot", "speed_kph")
    return got.select("edge_no", "slot", F.size("speeds").cast("long").alias("n"), F.array_join(F.transform("speeds", lambda v: v.cast("int").cast("string")), ",").alias("speeds"))


@query("a03_a04_group_points", "select trip_id, count(*) as n, min(t) as first_t, max(t) as last_t from $pts group by trip_id")
def a03(t: Tables) -> DataFrame:
    got = trips.traces(t.pts, "trip_id", "t", "event_id")
    return got.select("trip_id", F.size("points").cast("long").alias("n"), F.get("points", F.lit(0))["t"].alias("first_t"), F.element_at("points", -1)["t"].alias("last_t"))


@query("a06_iqr_mean", """select o.edge_no, o.slot, round(avg(speed_kph), 6) as speed_kph from $obs o join (select edge_no, slot, quantile_cont(speed_kph, 0.25) as q1, quantile_cont(speed_kph, 0.75) as q3 from obs group by edge_no, slot) q
  on o.edge_no = q.edge_no and o.slot = q.slot and speed_kph between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) group by o.edge_no, o.slot""")
def a06(t: Tables) -> DataFrame:
    return profiles.trimmed_means(t.obs, "edge_no", "slot", "speed_kph", P.iqr_factor).select("edge_no", "slot", r6("speed_kph").alias("speed_kph"))


DECAY = """select vehicle, round(sum(speed * w) / sum(w), 6) as speed_kph, count(*) as samples from (select *, greatest(0.1, 1 - age / 86400::double) as w from
  (select vehicle, speed, (select max(t) from $hbp) - t as age from hbp) a where age OP 86400) b group by vehicle"""


@query("a07_decayed_mean_converter", DECAY.replace("OP", "<="))
def a07(t: Tables) -> DataFrame:
    now = t.hbp.agg(F.max("t").alias("now"))
    return live.decayed_mean(t.hbp.join(F.broadcast(now)), ["vehicle"], "speed", F.col("now") - F.col("t"), 86_400).withColumn("speed_kph", r6("speed_kph"))


@query("a07b_x04_decayed_mean_daemon", DECAY.replace("OP", "<"))
def a07b(t: Tables) -> DataFrame:
    now = t.hbp.agg(F.max("t").alias("now"))
    return live.decayed_mean(t.hbp.join(F.broadcast(now)), ["vehicle"], "speed", F.col("now") - F.col("t"), 86_400, closed=False).withColumn("speed_kph", r6("speed_kph"))


@query("a08_snk18_report", """select count(*) as rows, count(*) filter (where ok) as valid_rows, round(avg(speed) filter (where ok), 6) as avg_speed, min(speed) filter (where ok) as min_speed, max(speed) filter (where ok) as max_speed,
  min(lat) filter (where ok) as min_lat, max(lat) filter (where ok) as max_lat, min(lon) filter (where ok) as min_lon, max(lon) filter (where ok) as max_lon
  from (select *, lat between 22 and 22.6 and lon between 113.8 and 114.3 and speed > 0 and speed <= 150 as ok from $hbp) x""")  # fmt: skip
def a08(t: Tables) -> DataFrame:
    from roadloom.operators.clean import valid_for_conversion

    return live.profile_report(t.hbp, valid_for_conversion(F.col("lat"), F.col("lon"), F.col("speed"))).withColumn("avg_speed", r6("avg_speed"))


@query("a09_average_as_int", "select cast(trunc(avg(speed)) as int) as mean from $hbp")
def a09(t: Tables) -> DataFrame:
    return t.hbp.agg(F.avg("speed").cast("int").alias("mean"))


@query("a10_a12_a17_counts", """select count(*) as rows, count(distinct vehicle) as vehicles, count(distinct edge) as edges, count(distinct edge // 1000) as tiles, count(*) filter (where edge % 5 = 0) as mapped
  from (select vehicle, cast(trunc(abs(lat) * 100000::double + abs(lon) * 100000::double) as bigint) % 10000 as edge from $hbp) x""")
def a10(t: Tables) -> DataFrame:
    e = t.hbp.select("vehicle", graphid.pseudo_edge(F.col("lat"), F.col("lon")).alias("edge"))
    e = live.to_tiles(e, "edge")
    return e.agg(F.count("*").alias("rows"), F.count_distinct("vehicle").alias("vehicles"), F.count_distinct("edge").alias("edges"), F.count_distinct("tile").alias("tiles"), F.count_if(F.col("edge") % 5 == 0).alias("mapped"))


@query("a13_last_write", "select edge_no, slot, arg_max(speed_kph, row(seq, speed_kph)) as speed_kph from $obs group by edge_no, slot")
def a13(t: Tables) -> DataFrame:
    return live.last_write(t.obs, ["edge_no", "slot"], "speed_kph", "seq")


@query("a14_a15_by_tile", "select graph_id & 33554431 as tile_id, count(distinct graph_id) as edges, count(*) as n from $obs group by 1")
def a14(t: Tables) -> DataFrame:
    return t.obs.groupBy(graphid.tile_base(F.col("graph_id")).alias("tile_id")).agg(F.count_distinct("graph_id").alias("edges"), F.count("*").alias("n"))


@query("a16_offpeak_percentile", "select edge_no, round(quantile_cont(speed_kph, 0.95), 6) as freeflow_kph from $obs where (slot % 288) // 12 in (0, 1, 2, 3, 4, 5, 22, 23) group by edge_no")
def a16(t: Tables) -> DataFrame:
    return profiles.data_speeds(t.obs, "edge_no", "slot", "speed_kph", P).withColumn("freeflow_kph", r6("freeflow_kph"))


@query("a18_latency_stats", "select event_type, round(avg(value), 6) as avg_v, min(value) as min_v, max(value) as max_v, round(avg(case when value > 300 then 1.0 else 0.0 end), 6) as error_rate from $events group by event_type")
def a18(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(r6(F.avg("value")).alias("avg_v"), F.min("value").alias("min_v"), F.max("value").alias("max_v"), r6(F.avg((F.col("value") > 300).cast("double"))).alias("error_rate"))


@query("a19_edge_id_lists", "select trip_id, string_agg(cast(cast(trunc(abs(lat) * 100000::double + abs(lon) * 100000::double) as bigint) % 10000 as varchar), ',' order by t, event_id) as ids from $pts group by trip_id")
def a19(t: Tables) -> DataFrame:
    traces = trips.traces(t.pts, "trip_id", "t", "event_id", "lat", "lon")
    got = matcher.RecordedMatcher(matcher.pseudo_match(traces)).match(traces)
    return got.select("trip_id", F.array_join(speeds.edge_ids(F.col("edges")), ",").alias("ids"))


FILL = """base AS MATERIALIZED (select edge_no, slot, sum(speed_kph) as s, count(*) as c from $obs group by edge_no, slot),
grid AS MATERIALIZED (select e.edge_no, g.slot, coalesce(s, 0) as s, coalesce(c, 0)::double as c from (select distinct edge_no from base) e cross join (select unnest(range(2016)) as slot) g left join base b on b.edge_no = e.edge_no and b.slot = g.slot),
ahead AS MATERIALIZED (select *, coalesce(sum(s) over w, 0) as fs, coalesce(sum(c) over w, 0) as fc from grid window w as (partition by edge_no order by slot rows between 1 following and 3 following)),
walk AS (select edge_no, -1::bigint as slot, [0::double, 0, 0] as ps, [0::double, 0, 0] as pc, 0::double as v, 0::double as n, false as filled from (select distinct edge_no from base) x
  union all select edge_no, slot, [ps[2], ps[3], case when c > 0 then s when pool > 0 then total / pool else 0 end], [pc[2], pc[3], case when c > 0 then c when pool > 0 then 1 else 0 end],
    case when c > 0 then s / c when pool > 0 then total / pool else 0 end, case when c > 0 then c when pool > 0 then 1 else 0 end, c = 0
  from (select a.edge_no, a.slot, a.s, a.c, w.ps, w.pc, w.ps[1] + w.ps[2] + w.ps[3] + a.fs as total, w.pc[1] + w.pc[2] + w.pc[3] + a.fc as pool from walk w join ahead a on a.edge_no = w.edge_no and a.slot = w.slot + 1) z)"""


@query("w06_temporal_fill", "select edge_no, cast(slot as int) as slot, round(v, 6) as speed_kph, filled from walk where slot >= 0 and n > 0", FILL)
def w06(t: Tables) -> DataFrame:
    return profiles.fill_temporal(t.obs, "edge_no", "slot", "speed_kph", P.neighbor_size).withColumn("speed_kph", r6("speed_kph"))


@query("w07_same_time_fill", """select g.edge_no, cast(g.slot as int) as slot, round(coalesce(m.v, avg(m.v) over (partition by g.edge_no, g.slot % 288)), 6) as speed_kph, m.v is null as filled
  from (select e.edge_no, s.slot from (select distinct edge_no from $obs) e cross join (select unnest(range(2016)) as slot) s) g left join (select edge_no, slot, avg(speed_kph) as v from obs group by edge_no, slot) m on m.edge_no = g.edge_no and m.slot = g.slot
  qualify avg(m.v) over (partition by g.edge_no, g.slot % 288) is not null""")  # fmt: skip
def w07(t: Tables) -> DataFrame:
    means = t.obs.groupBy("edge_no", "slot").agg(F.avg("speed_kph").alias("speed_kph"))
    return profiles.fill_same_time(means, "edge_no").withColumn("speed_kph", r6("speed_kph"))


PROFILE = """m AS MATERIALIZED (select o.edge_no, o.slot, avg(speed_kph) as v from $obs o join (select edge_no, slot, quantile_cont(speed_kph, 0.25) as q1, quantile_cont(speed_kph, 0.75) as q3 from obs group by edge_no, slot) q
  on o.edge_no = q.edge_no and o.slot = q.slot and speed_kph between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) group by o.edge_no, o.slot),
g AS MATERIALIZED (select e.edge_no, s.slot, cast(coalesce(m.v, 40) as float)::double as x from (select distinct edge_no from m) e cross join (select unnest(range(2016)) as slot) s left join m on m.edge_no = e.edge_no and m.slot = s.slot),
f AS MATERIALIZED (select edge_no, slot, median(x) over w as md, mad(x) over w as ad from g window w as (partition by edge_no order by slot rows between 7 preceding and 7 following)),
h AS MATERIALIZED (select g.edge_no, g.slot, cast(case when abs(x - md) > 2.5::double * 1.4826::double * ad then md else x end as float)::double as v from g join f on f.edge_no = g.edge_no and f.slot = greatest(7, least(2008, g.slot)))"""


def _profiles(obs: DataFrame) -> DataFrame:
    means = profiles.trimmed_means(obs, "edge_no", "slot", "speed_kph", P.iqr_factor)
    return profiles.smooth_profiles(means, P.freeflow_kph * P.default_speed_factor, "edge_no", P)


@query("w05_hampel", "select edge_no, cast(slot as int) as slot, round(v, 4) as speed_kph from h", PROFILE)
def w05(t: Tables) -> DataFrame:
    smooth = _profiles(t.obs).select("edge_no", F.posexplode("profile").alias("slot", "v"))
    return smooth.select("edge_no", "slot", F.round(F.col("v").cast("double"), 4).alias("speed_kph"))


@query("m03_dct", """select edge_no, k, cast(round_even(sum(v * cos(pi() / 2016 * k * (slot + 0.5::double))) * case when k = 0 then sqrt(1 / 2016::double) else sqrt(2 / 2016::double) end, 0) as int) as coefficient
  from h, (select cast(unnest(range(200)) as int) as k) ks group by edge_no, k""", PROFILE)  # fmt: skip
def m03(t: Tables) -> DataFrame:
    """The coefficients that the encoded profiles hold."""
    return _profiles(t.obs).select("edge_no", F.posexplode(encode.coefficients_in(F.col("encoded"))).alias("k", "coefficient"))


CONSTANT = "select cast(v as bigint) as kph, concat(substr(x, 1, 4), repeat('0', 796)) as code from (select v, lower(format('{:08x}', cast(round_even(v * sqrt(2016::double), 0) as int)))[5:8] as x from (select unnest(range(10, 130, 10)) as v) a) b"


@query("m04_m05_snk14_constant_profiles", CONSTANT)
def m04(t: Tables) -> DataFrame:
    week = F.array_repeat(F.col("kph").cast("double"), 2016)
    text = encode.pack_text(encode.coefficients_of(week))
    rows = t.spark.range(10, 130, 10).select(F.col("id").alias("kph")).select("kph", text.alias("text"))
    return rows.select("kph", F.lower(F.hex(F.unbase64("text"))).alias("code"))


@query("m06_decode_profile")
def m06(t: Tables) -> DataFrame:
    def decode(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            back = [encode.decompress(encode.from_text(x)) for x in b.column("encoded").to_pylist()]
            error = [float(np.abs(a - np.array(p)).mean()) for a, p in zip(back, b.column("profile").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("edge_no"), pa.array(error)], names=["edge_no", "mean_error"])

    return _profiles(t.obs).mapInArrow(decode, "edge_no long, mean_error double")


@query("j09_j13_edge_types", """select e.edge_no, w.way_id, coalesce(r.highway_type, 'unknown') as highway_type,
  case r.highway_type when 'motorway' then 100.0 when 'primary' then 70.0 when 'secondary' then 60.0 when 'residential' then 40.0 else 50.0 end::double as freeflow_kph,
  case r.highway_type when 'motorway' then 80.0 when 'primary' then 50.0 when 'secondary' then 45.0 when 'residential' then 30.0 else 40.0 end::double as constrained_kph
  from (select distinct edge_no from $obs) e join $ways w on w.edge_no = e.edge_no left join $roads r on r.way_id = w.way_id""")  # fmt: skip
def j09(t: Tables) -> DataFrame:
    types = profiles.edge_types(t.obs.select("edge_no").distinct(), t.ways, t.roads, strict=False)
    return profiles.rule_speeds(types, P).select("edge_no", "way_id", "highway_type", "freeflow_kph", "constrained_kph")


@query("j10_tunnels", "select distinct edge_no from $ways where way_id in (select way_id from $roads where lower(name) like '%tunnel%')")
def j10(t: Tables) -> DataFrame:
    return profiles.tunnel_edges(t.ways, t.roads)


@query("j11_without_tunnels", "select edge_no, count(*) as n from $obs where edge_no not in (select edge_no from $ways where way_id in (select way_id from $roads where lower(name) like '%tunnel%')) group by edge_no")
def j11(t: Tables) -> DataFrame:
    return profiles.without_edges(t.obs, profiles.tunnel_edges(t.ways, t.roads)).groupBy("edge_no").agg(F.count("*").alias("n"))


@query("p19_slot_range", "select edge_no, slot from $obs where slot >= 0 and slot < 2016 and slot % 3 <> 0 group by all")
def p19(t: Tables) -> DataFrame:
    odd = t.obs.withColumn("text_slot", F.when(F.col("slot") % 3 == 0, F.concat(F.lit("x"), F.col("slot").cast("string"))).otherwise(F.col("slot").cast("string")))
    return profiles.weeks(odd, "edge_no", "text_slot", "speed_kph").select("edge_no", F.explode("week").alias("c")).select("edge_no", "c.slot")


@query("snk04_nested_json", """select edge_no, concat('{', string_agg(concat('"', slot, '":[', v, ']'), ',' order by slot), '}') as json from (select edge_no, slot, string_agg(cast(cast(speed_kph as int) as varchar), ',' order by speed_kph) as v from $obs group by edge_no, slot) x group by edge_no""")
def snk04(t: Tables) -> DataFrame:
    got = speeds.collect_speeds(t.obs.withColumn("speed_kph", F.col("speed_kph").cast("int")), "edge_no", "slot", "speed_kph")
    return speeds.nested_json(got, "edge_no", "slot")


GID = "select distinct graph_id, graph_id & 7 as level, (graph_id >> 3) & 4194303 as tile, graph_id >> 25 as idx from $obs"


@query("f13_f14_f15_f16_graph_ids", f"select graph_id, cast(level as int) as level, cast(tile as int) as tile, (idx & 2097151) as idx, concat(level, '/', tile, '/', idx) as name, level | (tile << 3) as base from ({GID}) x")
def f13(t: Tables) -> DataFrame:
    g = F.col("graph_id")
    ids = t.obs.select("graph_id").distinct()
    again = graphid.pack(graphid.level(g), graphid.tile(g), graphid.index(g))
    return ids.filter(again == g).select("graph_id", graphid.level(g).alias("level"), graphid.tile(g).alias("tile"), graphid.index(g).alias("idx"), graphid.name(g).alias("name"), graphid.parse_base(graphid.name(g)).alias("base"))


@query("f17_f30_tile_paths", "select v as tile, case when v < 1000 then concat('2/', lpad(cast(v as varchar), 3, '0'), '.csv') when v < 1000000 then concat('2/', lpad(cast(v // 1000 as varchar), 3, '0'), '/', lpad(cast(v % 1000 as varchar), 3, '0'), '.csv') else concat('2/', lpad(cast(v // 1000000 as varchar), 3, '0'), '/', lpad(cast(v // 1000 % 1000 as varchar), 3, '0'), '/', lpad(cast(v % 1000 as varchar), 3, '0'), '.csv') end as path, concat(case when v < 100000 then lpad(cast(v as varchar), 5, '0') else cast(v as varchar) end, '.gph') as member from (select distinct o_orderkey * 137 % 3000000 as v from $orders) x")
def f17(t: Tables) -> DataFrame:
    v = t.orders.select((F.col("o_orderkey") * 137 % 3_000_000).alias("tile")).distinct()
    return v.select("tile", graphid.tile_path(F.lit(2), F.col("tile")).alias("path"), graphid.member_name(F.col("tile")).alias("member"))


@query("f18_f22_f29_bits", """select edge_no, slot, least(cast(trunc(speed_kph / 2) as int), 126) as lib, least(cast(trunc(speed_kph * 3 / 2) as int), 127) as daemon, least(cast(trunc(speed_kph / 2) as int), 126) * 2 as decoded,
  cast(case when speed_kph < 10 then 51 when speed_kph < 20 then 31 when speed_kph < 40 then 16 else 6 end as int) as band, cast(greatest(1, least(slot, 63)) as int) as clamped, cast(slot // 1000 as int) as tile, cast(slot % 1000 as int) as idx from $obs group by all""")
def f18(t: Tables) -> DataFrame:
    v = F.col("speed_kph")
    tile, idx = graphid.tile_of_pseudo(F.col("slot"))
    raw = bits.encode_speed(v)
    return t.obs.select("edge_no", "slot", raw.alias("lib"), bits.encode_speed(v * 3, 127).alias("daemon"), bits.decode_speed(raw).alias("decoded"), bits.congestion_band(v).alias("band"), bits.clamp_congestion(F.col("slot"), 1).alias("clamped"), tile.alias("tile"), idx.alias("idx")).distinct()


REC = "(r::bigint | (r::bigint << 7) | (r::bigint << 14) | (r::bigint << 21) | (255::bigint << 28) | (255::bigint << 36) | (c::bigint << 44) | (c::bigint << 50) | (c::bigint << 56))"
LAST = "last AS MATERIALIZED (select edge_no as edge_index, arg_max(speed_kph, row(seq, speed_kph)) as v from $obs where edge_no % 3 <> 1 group by edge_no), rec AS MATERIALIZED (select edge_index, least(cast(trunc(v / 2) as int), 126) as r, case when v < 10 then 52 when v < 20 then 32 when v < 40 then 17 else 7 end as c from last)"


def _records(t: Tables) -> DataFrame:
    last = live.last_write(t.obs.filter("edge_no % 3 <> 1"), ["edge_no"], "speed_kph", "seq")
    return live.records(last).select(F.lit(7).alias("tile"), F.col("edge_no").cast("int").alias("edge_index"), "record")


def _tiles(t: Tables, n: int = 105) -> DataFrame:
    return t.spark.createDataFrame([(7, n)], "tile int, edge_count int")


@query("f23_f24_f25_x11_records", f"select edge_index, {REC} as record, r <> 127 as valid, r = 0 as closed, r as overall from rec", LAST)
def f23(t: Tables) -> DataFrame:
    r = F.col("record")
    return _records(t).select(F.col("edge_index").cast("long").alias("edge_index"), "record", bits.speed_valid(r).alias("valid"), bits.closed(r).alias("closed"), bits.unpack(r, "overall").alias("overall"))


@query("j08_snk07_dense_tile", f"select 7 as tile, cast(g.i as int) as edge_index, coalesce({REC}, 268435455) as record from (select unnest(range(105)) as i) g left join rec on rec.edge_index = g.i", LAST)
def j08(t: Tables) -> DataFrame:
    return live.dense(_records(t), _tiles(t))


@query("snk08_dense_tile_fast_gaps", f"select 7 as tile, cast(g.i as int) as edge_index, {REC} as record from (select g.i, coalesce(r, 63) as r, coalesce(c, 7) as c from (select unnest(range(105)) as i) g left join rec on rec.edge_index = g.i) g", LAST)
def snk08(t: Tables) -> DataFrame:
    return live.dense(_records(t), _tiles(t), policy="fast")


@query("src15_snk07_tar_round_trip", f"select 7::bigint as tile, cast(g.i as int) as edge_index, coalesce({REC}, 268435455) as record, 1700000000::bigint as last_update from (select unnest(range(105)) as i) g left join rec on rec.edge_index = g.i", LAST)
def src15(t: Tables) -> DataFrame:
    import os

    path = scratch(t.spark, "archive").removeprefix("file://").removeprefix("file:")
    os.makedirs(path)
    sinks.write_archive(live.dense(_records(t), _tiles(t)), f"{path}/traffic.tar", updated=1_700_000_000)
    t.spark.dataSource.register(TileTar)
    return t.spark.read.format("tile_tar").load(f"{path}/traffic.tar")


@query("snk10_constant_tile", "select 9 as tile, cast(i as int) as edge_index, 45::bigint | (45::bigint << 7) | (45::bigint << 14) | (45::bigint << 21) | (255::bigint << 28) | (255::bigint << 36) | (1::bigint << 44) | (2::bigint << 50) | (3::bigint << 56) as record from (select unnest(range(300)) as i) x")
def snk10(t: Tables) -> DataFrame:
    return live.constant_tile(t.spark, 9, 300, 45)


@query("j12_snk11_a17_upsert", f"select 7 as tile, cast(g.i as int) as edge_index, case when g.i % 2 = 0 and g.i < 99 then 1000 + g.i else coalesce({REC}, 268435455) end as record, g.i % 2 = 0 and g.i < 99 as updated from (select unnest(range(105)) as i) g left join rec on rec.edge_index = g.i", LAST)
def snk11(t: Tables) -> DataFrame:
    new = t.spark.range(0, 99, 2).select(F.lit(7).alias("tile"), F.col("id").cast("int").alias("edge_index"), (F.col("id") + 1000).alias("record"))
    beyond = t.spark.createDataFrame([(7, 5000, 1), (8, 1, 1)], "tile int, edge_index int, record long")
    return live.upsert(live.dense(_records(t), _tiles(t)), new.unionByName(beyond))


@query("snk12_constant_upsert", f"select 7 as tile, cast(g.i as int) as edge_index, (coalesce({REC}, 268435455) & ~(127::bigint | (255::bigint << 28))) | 33 | (255::bigint << 28) as record from (select unnest(range(105)) as i) g left join rec on rec.edge_index = g.i", LAST)
def snk12(t: Tables) -> DataFrame:
    return live.upsert_constant(live.dense(_records(t), _tiles(t)), 33)


@query("snk01_snk02_traces_round_trip", "select cast(trip_id as varchar) as trip_id, count(*) as n, sum(t)::bigint as total from $pts group by trip_id")
def snk02(t: Tables) -> DataFrame:
    path = scratch(t.spark, "ndjson")
    sinks.write_ndjson(t.pts, path)
    return src.traces_ndjson(t.spark, path).groupBy("trip_id").agg(F.count("*").alias("n"), F.sum("t").alias("total"))


@query("snk03_by_vehicle", "select meter_id, count(*) as n from $hb group by meter_id")
def snk03(t: Tables) -> DataFrame:
    path = scratch(t.spark, "vehicles")
    sinks.write_by_vehicle(t.hb.select("meter_id", "event_id", "location"), "meter_id", ["event_id"], path)
    return t.spark.read.schema("meter_id string, event_id long, location string").option("header", True).csv(path).groupBy("meter_id").agg(F.count("*").alias("n"))


TILE_FILES = "select concat(g & 7, '/', lpad(cast((g >> 3) & 4194303 as varchar), 3, '0'), '.csv') as file_path, count(*) as n from (select distinct graph_id as g from $obs) x group by 1"


def _tile_files(t: Tables, obs: DataFrame) -> DataFrame:
    ids = t.obs.select("edge_no", "graph_id").distinct()
    rows = profiles.export_rows(_profiles(obs).join(ids, "edge_no").withColumns({"freeflow": F.lit(50.0), "constrained": F.lit(40.0)}), "graph_id", "freeflow", "constrained", "encoded")
    return sinks.write_tile_csv(rows, scratch(t.spark, "tilecsv"))


@query("snk06_tile_csv", TILE_FILES)
def snk06(t: Tables) -> DataFrame:
    return _tile_files(t, t.obs)


@query("snk13_edge_csv", "select concat('2/7/0,', edge_index, ',', cast(cast(v as int) as varchar), ',', case when v < 10 then 51 when v < 20 then 31 when v < 40 then 16 else 6 end) as value from last", LAST)
def snk13(t: Tables) -> DataFrame:
    last = live.last_write(t.obs.filter("edge_no % 3 <> 1"), ["edge_no"], "speed_kph", "seq")
    rows = last.select(F.lit(2).alias("level"), F.lit(7).alias("tile"), F.col("edge_no").alias("edge_index"), F.col("speed_kph").cast("int").alias("speed_kph"), bits.congestion_band(F.col("speed_kph")).alias("congestion"))
    path = scratch(t.spark, "edgecsv")
    sinks.write_lines(sinks.edge_csv_lines(rows), path)
    return t.spark.read.text(path)


@query("snk17_id_dictionary", "select distinct meter_id as id, concat('Car', dense_rank() over (order by meter_id)) as name from $hb")
def snk17(t: Tables) -> DataFrame:
    from roadloom.operators.clean import extend_ids

    known = t.spark.createDataFrame([], "id string, name string")
    path = scratch(t.spark, "dim")
    extend_ids(known, t.hb.select(F.col("meter_id").alias("id"))).write.parquet(path)
    return t.spark.read.parquet(path)


@query("p20_plausible", "select vehicle, round(v, 6) as speed_kph from (select vehicle, avg(speed) as v from $hbp group by vehicle) x where v between 1 and 150")
def p20(t: Tables) -> DataFrame:
    return live.plausible(t.hbp.groupBy("vehicle").agg(F.avg("speed").alias("speed_kph"))).select("vehicle", r6("speed_kph").alias("speed_kph"))


@query("w10_consistency", "select vehicle, count(distinct event_id % 2) = 1 as consistent from $hbp group by vehicle")
def w10(t: Tables) -> DataFrame:
    return live.coverage_check(t.hbp.withColumn("v", F.col("event_id") % 2), "vehicle", "v")


WINDOWS = """select edge, w as window_end, round(sum(speed * k) / sum(k), 6) as speed_kph, count(*) as samples from (select edge, speed, w, greatest(0.1, 1 - (w - t) / 3600::double) as k from
  (select cast(cast(trunc(abs(lat) * 100000::double + abs(lon) * 100000::double) as bigint) % 10000 as int) as edge, speed, t, unnest([(t // 900 + 1) * 900, (t // 900 + 2) * 900, (t // 900 + 3) * 900, (t // 900 + 4) * 900]) as w
   from $hbp where lat between 22 and 22.6 and lon between 113.8 and 114.3 and speed between 0 and 150) a) b group by edge, w having sum(speed * k) / sum(k) between 1 and 150"""
LIVE = Params(window_s=3600, interval_s=900)


@query("st02_st05_windowed_batch", WINDOWS)
def st05(t: Tables) -> DataFrame:
    return stream.windowed_speeds(stream.samples_of(t.hbp, LIVE), LIVE).withColumn("speed_kph", r6("speed_kph"))


@query("st01_st05_windowed_stream", WINDOWS)
def st01(t: Tables) -> DataFrame:
    """The same body over a file stream, drained once; a far event closes all windows."""
    path, out = scratch(t.spark, "stream"), scratch(t.spark, "streamed")
    rows = stream.samples_of(t.hbp, LIVE)
    end = rows.agg(F.max("ts").alias("m")).select(F.lit(-1).alias("edge"), F.lit(0.0).alias("speed"), (F.col("m") + F.expr("interval 2 days")).alias("ts"))
    rows.coalesce(1).write.parquet(f"{path}/1")
    end.coalesce(1).write.parquet(f"{path}/2")
    live_rows = t.spark.readStream.schema("edge int, speed double, ts timestamp").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(path)
    stream.run_once(stream.windowed_speeds(live_rows, LIVE), scratch(t.spark, "offsets"), out)
    return t.spark.read.parquet(out).filter("edge >= 0").select("edge", "window_end", r6("speed_kph").alias("speed_kph"), "samples")


@query("x10_fused_speed", """select l_orderkey, l_linenumber, round(p * coalesce(live, 0) + (1 - p) * coalesce(pred, case when sod between 25200 and 68399 then 40::double end, 50::double, 35::double), 6) as kph from (select *, case when live is not null then greatest(0, 1 - age / 3600::double) * cov else 0 end as p from
  (select l_orderkey, l_linenumber, case when l_orderkey % 3 <> 0 then l_quantity * 2 end as live, l_partkey % 5000 as age, l_discount * 10 as cov, case when l_orderkey % 4 = 0 then l_quantity + 20 end as pred, l_suppkey * 7919 % 86400 as sod from $lineitem) a) b""")
def x10(t: Tables) -> DataFrame:
    k = F.col("l_orderkey")
    kph = live.fused_speed(F.when(k % 3 != 0, F.col("l_quantity") * 2), F.col("l_partkey") % 5000, F.col("l_discount") * 10, F.when(k % 4 == 0, F.col("l_quantity") + 20), F.lit(40.0), F.lit(50.0), F.col("l_suppkey") * 7919 % 86_400, 35.0)
    return t.lineitem.select("l_orderkey", "l_linenumber", r6(kph).alias("kph"))


@query("x12_x13_costs", "select l_orderkey, l_linenumber, round(case when l_quantity > 30 then (l_quantity - 30) * 0.05::double else 0 end, 6) as penalty, round(l_partkey / (l_quantity / 3.6::double), 6) as seconds from $lineitem")
def x12(t: Tables) -> DataFrame:
    q = F.col("l_quantity")
    return t.lineitem.select("l_orderkey", "l_linenumber", r6(live.speed_penalty(q, F.lit(30.0))).alias("penalty"), r6(live.travel_seconds(F.col("l_partkey"), q)).alias("seconds"))


@query("x09_cli_verbs", "select 2 as level, 647736 as tile, '2/647/736.csv' as path, 5181890::bigint as base")
def x09(t: Tables) -> DataFrame:
    one = t.spark.range(1).select(F.lit(2).alias("level"), F.lit(647_736).alias("tile"))
    return one.select("level", "tile", graphid.tile_path(F.col("level"), F.col("tile")).alias("path"), graphid.parse_base(F.concat_ws("/", F.col("level").cast("string"), F.col("tile").cast("string"), F.lit("0"))).alias("base"))


@query("f28_slot_hours", "select distinct slot, cast((slot % 288) // 12 as int) as hour from $obs")
def f28(t: Tables) -> DataFrame:
    return t.obs.select("slot", slot_hour(F.col("slot")).alias("hour")).distinct()


@query("f04b_slot_of_epoch", "select event_id, cast(((t // 86400 + 4) % 7) * 288 + (t % 86400) // 300 as int) as slot from $hbp")
def f04b(t: Tables) -> DataFrame:
    return t.hbp.select("event_id", slot_of_epoch(F.col("t")).alias("slot"))


@query("x01_x02_batch_path")
def x01(t: Tables) -> DataFrame:
    """All batch stages in one plan: (edge_id, slots, mean_kph) of the smoothed profiles."""
    from roadloom.plans.batch import run

    state = run({"heartbeats": t.hbp, "trips": t.trips}, lambda traces: matcher.RecordedMatcher(matcher.pseudo_match(traces)), P)
    mean = F.aggregate(F.transform("profile", lambda v: v.cast("double")), F.lit(0.0), lambda a, v: a + v) / F.size("profile")
    return state.frames["profiles"].select("edge_id", F.size("profile").alias("slots"), r6(mean).alias("mean_kph"))


LAST_ANSWERS = """select edge, m as now, round(sum(speed * k) / sum(k), 6) as speed_kph, count(*) as samples from (select edge, speed, m, greatest(0.1, 1 - (m - t) / 3600::double) as k from (select *, max(t) over (partition by edge) as m from
  (select cast(cast(trunc(abs(lat) * 100000::double + abs(lon) * 100000::double) as bigint) % 10000 as int) as edge, speed, t::double as t from $hbp where lat between 22 and 22.6 and lon between 113.8 and 114.3 and speed between 0 and 150) a) b where t > m - 3600) c group by edge, m"""


def _states(t: Tables) -> tuple[DataFrame, list]:
    """Answers of the exact state over three files in the order of time, with their batch, and the query's progress."""
    path, out = scratch(t.spark, "state"), scratch(t.spark, "states")
    rows = stream.samples_of(t.hbp, LIVE).select("edge", F.unix_timestamp("ts").cast("double").alias("t"), "speed")
    least, most = rows.agg(F.min("t"), F.max("t")).first()
    third = F.least(F.floor((F.col("t") - least) / ((most - least) / 3)), F.lit(2))
    for k in range(3):
        rows.filter(third == k).coalesce(1).write.mode("append").parquet(path)
    live_rows = t.spark.readStream.schema("edge int, t double, speed double").option("maxFilesPerTrigger", 1).parquet(path)
    q = stream.publish_each(stream.exact_state(live_rows, LIVE), scratch(t.spark, "offsets"), lambda df, i: df.write.mode("overwrite").parquet(f"{out}/batch={i}")).trigger(availableNow=True).start()
    q.awaitTermination()
    return t.spark.read.parquet(out), q.recentProgress


@query("st06_exact_state", LAST_ANSWERS)
def st06(t: Tables) -> DataFrame:
    """Sliding samples kept as state: the last answer of each edge."""
    last = _states(t)[0].groupBy("edge").agg(F.max_by(F.struct("now", "speed_kph", "samples"), "batch").alias("x"))
    return last.select("edge", "x.now", r6("x.speed_kph").alias("speed_kph"), "x.samples")


@query("snk15_snk16_publish_swap", f"select 7::bigint as tile, cast(g.i as int) as edge_index, (coalesce({REC}, 268435455) & ~(127::bigint | (255::bigint << 28))) | 33 | (255::bigint << 28) as record, 2::bigint as last_update from (select unnest(range(105)) as i) g left join rec on rec.edge_index = g.i", LAST)
def snk15(t: Tables) -> DataFrame:
    """Two publications; what ``current`` then points to."""
    folder = scratch(t.spark, "published").removeprefix("file://").removeprefix("file:")
    tile = live.dense(_records(t), _tiles(t))
    sinks.publish(tile, folder, updated=1)
    sinks.publish(live.upsert_constant(tile, 33), folder, updated=2)
    t.spark.dataSource.register(TileTar)
    return t.spark.read.format("tile_tar").load(f"{folder}/current")


@query("snk05_u01_partials", "select edge_no, slot, count(*) as n, sum(speed_kph) as total from $obs group by edge_no, slot")
def snk05(t: Tables) -> DataFrame:
    """Partial results in files, read together and aggregated again."""
    path = scratch(t.spark, "partials")
    for k in range(3):
        part = t.obs.filter(F.col("seq") % 3 == k).groupBy("edge_no", "slot").agg(F.count("*").alias("n"), F.sum("speed_kph").alias("total"))
        part.write.mode("append").parquet(path)
    return t.spark.read.parquet(path).groupBy("edge_no", "slot").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


@query("st07_st08_published_batches", "select batch, count(*) as rows, count(distinct vehicle) as vehicles from (select vehicle, vehicle % 2 as batch from $hbp) x group by batch")
def st07(t: Tables) -> DataFrame:
    """A file a micro-batch, each published under its batch id with its counters."""
    path, out = scratch(t.spark, "feed"), scratch(t.spark, "counters")
    for k in range(2):
        t.hbp.filter(F.col("vehicle") % 2 == k).coalesce(1).write.parquet(f"{path}/{k}")
    feed = t.spark.readStream.schema(t.hbp.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(path)

    def publish(df: DataFrame, batch: int) -> None:
        df.groupBy((F.col("vehicle") % 2).alias("batch")).agg(F.count("*").alias("rows"), F.count_distinct("vehicle").alias("vehicles")).write.mode("overwrite").parquet(f"{out}/batch_id={batch}")

    stream.publish_each(feed, scratch(t.spark, "offsets"), publish, mode="append").trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.parquet(out).select("batch", "rows", "vehicles")


@query("st03_state_expiry", """select edge, max(t) as now, count(*) as kept from (select cast(cast(trunc(abs(lat) * 100000::double + abs(lon) * 100000::double) as bigint) % 10000 as int) as edge, t, max(t) over (partition by cast(trunc(abs(lat) * 100000::double + abs(lon) * 100000::double) as bigint) % 10000) as m
  from $hbp where lat between 22 and 22.6 and lon between 113.8 and 114.3 and speed between 0 and 150) x where t > m - 3600 group by edge""")
def st03(t: Tables) -> DataFrame:
    """What an edge's state keeps at its last sample: strictly younger than the window."""
    from pyspark.sql import Window

    rows = stream.samples_of(t.hbp, LIVE).select("edge", F.unix_seconds("ts").alias("t"))
    last = rows.withColumn("m", F.max("t").over(Window.partitionBy("edge")))
    return last.filter(F.col("t") > F.col("m") - LIVE.window_s).groupBy("edge").agg(F.max("t").alias("now"), F.count("*").alias("kept"))


@query("st03_expired_keys", LAST_ANSWERS.replace("select edge, m as now, round(sum(speed * k) / sum(k), 6) as speed_kph, count(*) as samples from", "select count(distinct edge) as edges, count(distinct case when m + 3600 >= (select max(t) from $hbp where lat between 22 and 22.6 and lon between 113.8 and 114.3 and speed between 0 and 150) - 60 then edge end) as alive from").removesuffix(" group by edge, m"))
def st03b(t: Tables) -> DataFrame:
    """Edges that the stream has seen, and those that still have state when it ends: silent ones are dropped by event time."""
    out, progress = _states(t)
    alive = int(progress[-1]["stateOperators"][0]["numRowsTotal"])
    return out.agg(F.count_distinct("edge").alias("edges")).select("edges", F.lit(alive).cast("long").alias("alive"))

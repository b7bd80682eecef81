"""Queries over scans, predicates, joins and cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadloom.functions import text as tx
from roadloom.functions import timeslot as ts
from roadloom.functions.graphid import pseudo_edge, pseudo_edge_single, tile_base
from roadloom.operators import clean, live, ranking, trips
from roadloom.params import Params
from roadloom.plans.registry import query
from roadloom.plans.views import Tables
from roadloom.session import scratch
from roadloom.sinks import files as sinks
from roadloom.sources import files as src
from roadloom.sources import matcher

P = Params()
RAW_HB = """select cast(event_id as varchar(20)) as id, meter_id as f0_,
    case when event_id % 97 = 0 then 'POINT(114.1)' when event_id % 89 = 0 then 'nowhere' else location end as location,
    case when event_id % 31 = 0 then '' else cast(bearing as varchar(10)) end as bearing,
    case when event_id % 29 = 0 then '' when event_id % 83 = 0 then 'fast' else cast(event_id * 13 % 170 as varchar(10)) end as speed,
    case when device_time is null then null when event_id % 77 = 0 then 'device_time' else 'T' end as device_time, 'S' as server_time, event_id from $hb"""
LINES = """select way_id as line, concat(cast(way_id as varchar(10)), ',0,', cast(way_id * 4 as varchar(10)), ',1,', cast(way_id * 4 + 1 as varchar(10)), ',0,', cast(way_id * 4 + 2 as varchar(10)),
    case when way_id % 5 = 0 then ',1,bad' when way_id % 5 = 1 then '' else concat(',1,', cast(way_id * 4 + 3 as varchar(10))) end) as value from (select distinct way_id from $ways) w"""
EDGE_LINES = """select l_orderkey * 8 + l_linenumber as line, case when l_orderkey % 50 = 0 then '# note' when l_orderkey % 51 = 0 then '  ' when l_orderkey % 53 = 0 then '2/7/0,x,3'
    when l_orderkey % 3 = 0 then concat('2/', cast(l_suppkey % 9 as varchar(10)), '/0,', cast(l_partkey % 40 as varchar(10)), ',', cast(l_orderkey % 120 as varchar(10)))
    when l_orderkey % 3 = 1 then concat(cast(l_suppkey % 9 * 8 + 2 as varchar(10)), ', ', cast(l_partkey % 40 as varchar(10)), ', ', cast(l_orderkey % 120 as varchar(10)), ', ', cast(l_linenumber as varchar(10)))
    else 'short,1' end as value from $lineitem"""


def _raw(t: Tables) -> DataFrame:
    return t.sql(RAW_HB)


@query("flagship_live_records", """
select edge, round(speed_kph, 6) as speed_kph, samples, raw_speed, congestion,
  cast(raw_speed as bigint) | (cast(raw_speed as bigint) << 7) | (cast(raw_speed as bigint) << 14) | (cast(raw_speed as bigint) << 21) | (255::bigint << 28) | (255::bigint << 36)
  | (cast(congestion as bigint) << 44) | (cast(congestion as bigint) << 50) | (cast(congestion as bigint) << 56) as record
from (select *, least(cast(trunc(speed_kph / 2) as int), 126) as raw_speed, cast(case when speed_kph < 10 then 52 when speed_kph < 20 then 32 when speed_kph < 40 then 17 else 7 end as int) as congestion
  from (select edge, sum(speed * w) / sum(w) as speed_kph, count(*) as samples
    from (select *, greatest(0.1, 1.0 - age / 864000::double) as w from (select cast(cast(trunc(abs(lat) * 100000::double + abs(lon) * 100000::double) as bigint) % 10000 as int) as edge, speed,
      (select max(t) from $hbp) - t as age from $hbp where lat between 22 and 22.6 and lon between 113.8 and 114.3 and speed between 0 and 150) where age <= 864000) group by edge)
  where speed_kph between 1 and 150)""")  # fmt: skip
def flagship(t: Tables) -> DataFrame:
    """Heartbeats -> valid points -> edges -> decayed mean -> congestion -> packed record."""
    now = t.hbp.agg(F.max("t").alias("now"))
    good = t.hbp.filter(clean.valid_live(F.col("lat"), F.col("lon"), F.col("speed"), P)).join(F.broadcast(now))
    edges = good.select(pseudo_edge(F.col("lat"), F.col("lon")).alias("edge"), "speed", "t", "now")
    means = live.plausible(live.decayed_mean(edges, ["edge"], "speed", F.col("now") - F.col("t"), 864_000))
    return live.records(means).select("edge", F.round("speed_kph", 6).alias("speed_kph"), "samples", "raw_speed", "congestion", "record")


@query("src01_csv_scan", "select id, f0_, location, nullif(speed, '') as speed from raw", "raw AS (" + RAW_HB + ")")
def src01(t: Tables) -> DataFrame:
    path = scratch(t.spark, "csv")
    _raw(t).drop("event_id").write.option("header", True).csv(path)
    return src.table_csv(t.spark, path, src.HEARTBEAT).select("id", "f0_", "location", "speed")


@query("src02_pruned_scan", "select meter_id, count(*) as n, min(speed) as least from $hb group by meter_id")
def src02(t: Tables) -> DataFrame:
    return t.hb.select("meter_id", "speed").groupBy("meter_id").agg(F.count("*").alias("n"), F.min("speed").alias("least"))


@query("src03_heartbeat_parse", """select id, meter_id, lon, lat, bearing, speed from (
  select id, f0_ as meter_id, case when len(p) = 2 then try_cast(p[1] as double) end as lon, case when len(p) = 2 then try_cast(p[2] as double) end as lat,
    case when bearing = '' then 0 else try_cast(bearing as double) end as bearing, case when speed = '' then 0 else try_cast(speed as double) end as speed
  from (select *, string_split(trim(replace(replace(location, 'POINT(', ''), ')', '')), ' ') as p from raw)) x
  where lon between 113.8 and 114.3 and lat between 22 and 22.6 and speed between 0 and 150 and bearing is not null""", "raw AS (" + RAW_HB + ")")  # fmt: skip
def src03(t: Tables) -> DataFrame:
    return src.parse_heartbeats(_raw(t), P).select("id", "meter_id", "lon", "lat", "bearing", "speed")


@query("src04_limit_before_filter", """select id, speed from (select id, location, case when speed = '' then 0 else try_cast(speed as double) end as speed,
  string_split(trim(replace(replace(location, 'POINT(', ''), ')', '')), ' ') as p from (select * from raw order by event_id limit 500)) x
  where len(p) = 2 and try_cast(p[1] as double) between 113.8 and 114.3 and try_cast(p[2] as double) between 22 and 22.6 and speed > 0 and speed <= 150""", "raw AS (" + RAW_HB + ")")  # fmt: skip
def src04(t: Tables) -> DataFrame:
    return src.convert_heartbeats(_raw(t), 500, "event_id").select("id", F.col("kph").alias("speed"))


@query("src05_06_07_trace_scan", "select cast(trip_id as varchar) as trip_id, count(*) as n, min(t) as first_t from (select *, count(*) over (partition by trip_id) as c from $pts) x where c >= 5 group by trip_id")
def src05(t: Tables) -> DataFrame:
    path = scratch(t.spark, "traces")
    sinks.write_traces(t.pts, path)
    return src.traces_parquet(t.spark, path, 5).groupBy("trip_id").agg(F.count("*").alias("n"), F.min("t").alias("first_t"))


@query("src08_way_edges_strict", """select edge_no, max(way_id) as way_id from (select way_id, unnest([way_id * 4, way_id * 4 + 1, way_id * 4 + 2]) as edge_no from (select distinct way_id from $ways where way_id % 5 <> 0)
  union all select way_id, way_id * 4 + 3 from (select distinct way_id from ways where way_id % 5 not in (0, 1))) x group by edge_no""")
def src08(t: Tables) -> DataFrame:
    return src.way_edges(t.sql(LINES).filter("line % 5 <> 0"), strict=True)


@query("src09_way_edges_tolerant", """select edge_no, max(way_id) as way_id from (select way_id, unnest([way_id * 4, way_id * 4 + 1, way_id * 4 + 2]) as edge_no from (select distinct way_id from $ways)
  union all select way_id, way_id * 4 + 3 from (select distinct way_id from ways where way_id % 5 not in (0, 1))) x group by edge_no""")
def src09(t: Tables) -> DataFrame:
    return src.way_edges(t.sql(LINES))


@query("src10_first_match", "select line, value from (" + LINES + ") x where value like '%17%' order by line limit 1")
def src10(t: Tables) -> DataFrame:
    return src.first_line_with(t.sql(LINES), "17")


@query("src11_roads_scan", "select way_id, highway_type, name from $roads")
def src11(t: Tables) -> DataFrame:
    path = scratch(t.spark, "roads")
    t.roads.write.option("header", True).csv(path)
    return src.table_csv(t.spark, path, src.ROADS)


@query("src12_json_object", "select distinct meter_id as key, concat('Car', cast(substr(meter_id, 4) as int) + 1) as value from $hb")
def src12(t: Tables) -> DataFrame:
    path = scratch(t.spark, "ids")
    ids = t.hb.select("meter_id").distinct().select("meter_id", F.concat(F.lit("Car"), (F.substring("meter_id", 4, 9).cast("int") + 1).cast("string")).alias("name"))
    one = ids.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("meter_id", "name"))))).alias("value"))
    one.write.text(path)
    return src.json_map(t.spark, path)


@query("src13_edge_speed_lines", """select l_orderkey * 8 + l_linenumber as line, l_suppkey % 9 * 8 + 2 as tile, cast(l_partkey % 40 as int) as edge_index, cast(l_orderkey % 120 as float) as speed_kph,
  cast(case when l_orderkey % 3 = 0 then 1 else l_linenumber end as int) as congestion from $lineitem where l_orderkey % 3 < 2 and l_orderkey % 50 <> 0 and l_orderkey % 51 <> 0 and l_orderkey % 53 <> 0""")
def src13(t: Tables) -> DataFrame:
    return src.edge_speed_lines(t.sql(EDGE_LINES))


@query("src14_edge_specs", "select * from (values (0, 58, 3, 40.0::float, 1), (1, 66, 4, 50.5::float, 7), (2, 42, 5, 60.0::float, 1)) v(line, tile, edge_index, speed_kph, congestion)")
def src14(t: Tables) -> DataFrame:
    tokens = ["2/7/0", "3", "40", "2/8/0", "4", "50.5", "7", "2/5/0", "5", "60"]
    return src.edge_specs(t.spark, tokens).select("line", F.col("tile").cast("int").alias("tile"), "edge_index", "speed_kph", "congestion")


@query("src16_tile_edge_counts", "select graph_id & 33554431 as tile_id, max(graph_id >> 25) + 1 as edge_count from $obs group by 1")
def src16(t: Tables) -> DataFrame:
    return t.obs.groupBy(tile_base(F.col("graph_id")).alias("tile_id")).agg((F.max(F.shiftright("graph_id", 25)) + 1).alias("edge_count"))


@query("src17_recorded_match", """select trip_id, count(*) as n, sum(case when event_id % 7 = 0 then 0 else 1 end)::bigint as matched from $pts group by trip_id""")
def src17(t: Tables) -> DataFrame:
    traces = trips.traces(t.pts, "trip_id", "t", "lat", "lon", "event_id")
    got = matcher.RecordedMatcher(matcher.pseudo_match(traces)).match(traces)
    return got.select("trip_id", F.size("edges").cast("long").alias("n"), F.size(F.filter("matched_points", lambda p: p["type"] == "matched")).cast("long").alias("matched"))


@query("src18_snap_responses", "select event_id, case when event_id % 3 = 2 then null else event_id * 5 end as edge_id from $hbp")
def src18(t: Tables) -> DataFrame:
    k = F.col("event_id")
    response = F.when(k % 3 == 0, F.concat(F.lit('[{"edges":[{"edge_id":{"value":'), (k * 5).cast("string"), F.lit("}}]}]"))).when(
        k % 3 == 1, F.concat(F.lit('[{"edges":[{"id":'), (k * 5).cast("string"), F.lit("},{\"id\":1}]}]"))
    ).otherwise(F.lit('[{"edges":[]}]'))
    return t.hbp.select("event_id", matcher.parse_snap(response).alias("edge_id"))


@query("src19_pseudo_edge", """select event_id, cast(cast(trunc(abs(lat) * 100000::double + abs(lon) * 100000::double) as bigint) % 10000 as int) as edge,
  cast((cast(floor(cast(cast(abs(lat) as float) * 100000::float as double)) as bigint) + cast(floor(cast(cast(abs(lon) as float) * 100000::float as double)) as bigint)) % 100000 as int) as edge_single from $hbp""")
def src19(t: Tables) -> DataFrame:
    return t.hbp.select("event_id", pseudo_edge(F.col("lat"), F.col("lon")).alias("edge"), pseudo_edge_single(F.col("lat"), F.col("lon")).alias("edge_single"))


@query("p01_p04_clean_heartbeats", """select id, meter_id, device_time, regexp_matches(location, 'POINT') as has_point from (select id, f0_ as meter_id, coalesce(device_time, server_time) as device_time, location from raw) x where device_time <> 'device_time'""", "raw AS (" + RAW_HB + ")")
def p01(t: Tables) -> DataFrame:
    return clean.clean_heartbeats(_raw(t)).select("id", "meter_id", "device_time", F.contains("location", F.lit("POINT")).alias("has_point"))


@query("p05_p06_wkt_points", """select id, try_cast(nullif(regexp_extract(location, 'POINT\\((\\S+) (\\S+)\\)', 1), '') as double) as lon, try_cast(nullif(regexp_extract(location, 'POINT\\((\\S+) (\\S+)\\)', 2), '') as double) as lat,
  len(string_split(trim(replace(replace(location, 'POINT(', ''), ')', '')), ' ')) = 2 as two_tokens from raw""", "raw AS (" + RAW_HB + ")")  # fmt: skip
def p05(t: Tables) -> DataFrame:
    point, strict = tx.wkt_point(F.col("location")), tx.wkt_tokens(F.col("location"))
    return _raw(t).select("id", point["lon"].alias("lon"), point["lat"].alias("lat"), strict.isNotNull().alias("two_tokens"))


@query("p07_empty_as_zero", "select id, case when speed = '' then 0 else try_cast(speed as double) end as speed from raw", "raw AS (" + RAW_HB + ")")
def p07(t: Tables) -> DataFrame:
    return _raw(t).select("id", tx.number_or_zero(F.col("speed")).alias("speed"))


@query("p08_live_predicate", "select event_id, speed from $hbp where lat between 22.0 and 22.6 and lon between 113.8 and 114.3 and speed between 0 and 150")
def p08(t: Tables) -> DataFrame:
    return t.hbp.filter(clean.valid_live(F.col("lat"), F.col("lon"), F.col("speed"), P)).select("event_id", "speed")


@query("p09_converter_predicate", "select event_id, speed from $hbp where lat between 22.0 and 22.6 and lon between 113.8 and 114.3 and speed > 0 and speed <= 150 and not (lat = 0 and lon = 0)")
def p09(t: Tables) -> DataFrame:
    return t.hbp.filter(clean.valid_for_conversion(F.col("lat"), F.col("lon"), F.col("speed"), P)).select("event_id", "speed")


@query("p10_row_arity", "select line, len(string_split(value, ',')) as fields from lines where len(string_split(value, ',')) >= 9", "lines AS (" + LINES + ")")
def p10(t: Tables) -> DataFrame:
    n = F.size(F.split("value", ","))
    return t.sql(LINES).select("line", n.cast("long").alias("fields")).filter("fields >= 9")


@query("p11_valid_trips", """select id from $fares where not (coalesce(s_lat = e_lat and s_lon = e_lon, false) or coalesce(abs(s_lat - e_lat) < 0.001 and abs(s_lon - e_lon) < 0.001, false)
  or coalesce(s_lat = 0 and s_lon = 0, false) or coalesce(e_lat = 0 and e_lon = 0, false) or coalesce(s_lat = s_lon, false) or coalesce(e_lat = e_lon, false))""")
def p11(t: Tables) -> DataFrame:
    return t.fares.filter(~clean.invalid_trip(F.col("s_lat"), F.col("s_lon"), F.col("e_lat"), F.col("e_lon"), P.near_same_deg)).select("id")


@query("p12_a05_outliers", """select id, fare, distance from $fares, (select 2 * quantile_cont(fare, 0.99) - quantile_cont(fare, 0.01) as tf, 2 * quantile_cont(distance, 0.99) - quantile_cont(distance, 0.01) as td from fares) q
  where fare <= 700 and fare <= tf and distance <= td""")
def p12(t: Tables) -> DataFrame:
    return clean.drop_outliers(t.fares, "fare", ["fare", "distance"]).select("id", "fare", "distance")


@query("p13_missing_counts", "select count(*) filter (where distance is null) as distance, count(*) filter (where fare is null) as fare, 0::bigint as plate from $fares")
def p13(t: Tables) -> DataFrame:
    return clean.missing_counts(t.fares, ["distance", "fare", "plate"])


@query("p13b_assert_complete", "select id, plate from $fares")
def p13b(t: Tables) -> DataFrame:
    return clean.assert_complete(t.fares, ["id", "plate"]).select("id", "plate")


@query("p14_column_selection", "select id, plate, fare, distance from $fares")
def p14(t: Tables) -> DataFrame:
    return t.fares.select("id", "plate", "fare", "distance")


@query("p16_trace_length", "select trip_id, t, lat, lon from (select *, count(*) over (partition by trip_id) as c from $pts) x where c >= 10")
def p16(t: Tables) -> DataFrame:
    return trips.long_enough(t.pts, "trip_id", 10).select("trip_id", "t", "lat", "lon")


@query("p21_speed_scaling", "select event_id, speed * 2 as doubled from $hbp")
def p21(t: Tables) -> DataFrame:
    return t.hbp.select("event_id", (F.col("speed") * 2).alias("doubled"))


@query("p22_to_wkt", "select event_id, concat('POINT(', cast(event_id % 180 as varchar), ' ', cast(event_id % 90 as varchar), ')') as wkt from $hbp")
def p22(t: Tables) -> DataFrame:
    return t.hbp.select("event_id", tx.to_wkt(F.col("event_id") % 180, F.col("event_id") % 90).alias("wkt"))


@query("p23_dry_run", "select count(*) as n, round(min(v), 6) as least, round(max(v), 6) as most from (select avg(speed) as v from $hbp where speed between 0 and 150 group by vehicle) x")
def p23(t: Tables) -> DataFrame:
    means = t.hbp.filter("speed between 0 and 150").groupBy("vehicle").agg(F.avg("speed").alias("v"))
    return means.agg(F.count("*").alias("n"), F.round(F.min("v"), 6).alias("least"), F.round(F.max("v"), 6).alias("most"))


@query("j01_p15_hired_semi", "select event_id, vehicle, t from $hbp h where exists (select 1 from $trips t where t.vehicle = h.vehicle and h.t between t.start_s and t.end_s)")
def j01(t: Tables) -> DataFrame:
    return trips.hired(t.hbp, t.trips, "vehicle", "t", "start_s", "end_s").select("event_id", "vehicle", "t")


@query("j01b_hire_flags", """select event_id, case when exists (select 1 from $trips t where t.vehicle = h.vehicle and h.t between t.start_s and t.end_s and t.vehicle < 15) then 'TRUE' else 'FALSE' end as hire_status
  from $hbp h where h.vehicle < 15""")
def j01b(t: Tables) -> DataFrame:
    return trips.hire_flags(t.hbp, t.trips.filter("vehicle < 15"), "vehicle", "t", "start_s", "end_s", "event_id").select("event_id", "hire_status")


@query("j02_interval_inner", "select h.event_id, t.trip_id from $hbp h join $trips t on h.vehicle = t.vehicle and h.t between t.start_s and t.end_s")
def j02(t: Tables) -> DataFrame:
    return trips.in_interval(t.hbp, t.trips, "vehicle", "t", "start_s", "end_s").select("event_id", "trip_id")


@query("j03_lookup", "select event_id, case when vehicle < 15 then concat('Car', cast(vehicle + 1 as varchar)) end as car from $hbp")
def j03(t: Tables) -> DataFrame:
    ids = t.hbp.select("vehicle").distinct().filter("vehicle < 15").select("vehicle", F.concat(F.lit("Car"), (F.col("vehicle") + 1).cast("string")).alias("car"))
    return t.hbp.join(ids, "vehicle", "left").select("event_id", "car")


@query("j04_a11_extend_ids", """select id, name from (select distinct meter_id as id, concat('Car', cast(row_number() over (order by meter_id) as varchar)) as name from (select distinct meter_id from $hb where event_id % 20 < 5)) k
  union all select id, concat('Car', cast(n + row_number() over (order by id) as varchar)) from (select distinct meter_id as id from hb where meter_id not in (select meter_id from hb where event_id % 20 < 5)) f, (select count(distinct meter_id) as n from hb where event_id % 20 < 5) c""")
def j04(t: Tables) -> DataFrame:
    known = t.hb.filter("event_id % 20 < 5").select(F.col("meter_id").alias("id")).distinct()
    named = known.select("id", F.concat(F.lit("Car"), F.row_number().over(Window.orderBy("id")).cast("string")).alias("name"))
    return clean.extend_ids(named, t.hb.select(F.col("meter_id").alias("id")))


@query("j14_frequent_plates", "select id, plate from $fares where plate in (select plate from fares group by plate having count(*) > 10)")
def j14(t: Tables) -> DataFrame:
    return clean.frequent_only(t.fares, "plate", 10).select("id", "plate")


@query("a11_highest_number", "select max(cast(substr(meter_id, 4) as int)) as highest from $hb")
def a11(t: Tables) -> DataFrame:
    return clean.highest_number(t.hb, "meter_id")


@query("w04_dedup_first", "select meter_id, hour_no, event_id from (select meter_id, epoch_us(server_time) // 3600000000 as hour_no, event_id, row_number() over (partition by meter_id, epoch_us(server_time) // 3600000000 order by server_time, event_id) as rn from $hb) x where rn = 1")
def w04(t: Tables) -> DataFrame:
    hours = t.hb.withColumn("hour_no", F.floor(ts.micros(F.col("server_time")) / 3_600_000_000).cast("long"))
    return clean.dedup_first(hours, ["meter_id", "hour_no"], ["server_time", "event_id"]).select("meter_id", "hour_no", "event_id")


@query("w09_runs", "select vehicle, cast(run as bigint) as run, count(*) as n from (select vehicle, sum(case when vehicle is distinct from prev then 1 else 0 end) over (order by event_id) as run from (select event_id, vehicle, lag(vehicle) over (order by event_id) as prev from $hbp) a) b group by vehicle, run")
def w09(t: Tables) -> DataFrame:
    return ranking.runs(t.hbp.select("event_id", "vehicle"), "vehicle", "event_id").groupBy("vehicle", "run").agg(F.count("*").alias("n"))


@query("s01_s02_sorted", "select meter_id, event_id, row_number() over (partition by meter_id order by server_time, event_id) as place from $hb")
def s01(t: Tables) -> DataFrame:
    ordered = t.hb.orderBy("meter_id", "server_time", "event_id")
    return ordered.select("meter_id", "event_id", F.row_number().over(Window.partitionBy("meter_id").orderBy("server_time", "event_id")).cast("long").alias("place"))


@query("s03_sorted_json", """select concat('{', string_agg(concat('"', id, '":"', n, '"'), ',' order by id), '}') as json from (select meter_id as id, cast(count(*) as varchar) as n from $hb group by meter_id) x""")
def s03(t: Tables) -> DataFrame:
    counts = t.hb.groupBy(F.col("meter_id").alias("id")).agg(F.count("*").cast("string").alias("n"))
    return counts.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("id", "n"))))).alias("json"))


@query("s04_s08_limit", "select event_id, speed from $hbp order by event_id limit 5")
def s04(t: Tables) -> DataFrame:
    return t.hbp.orderBy("event_id").limit(5).select("event_id", "speed")


@query("s05_first_of_key", "select vehicle, event_id from (select vehicle, event_id, row_number() over (partition by vehicle order by event_id) as rn from $hbp) x where rn = 1")
def s05(t: Tables) -> DataFrame:
    return clean.dedup_first(t.hbp, ["vehicle"], ["event_id"]).select("vehicle", "event_id")


@query("s06_middle_row", "select vehicle, event_id from (select vehicle, event_id, row_number() over (partition by vehicle order by event_id) as rn, count(*) over (partition by vehicle) as n from $hbp) x where rn = n // 2 + 1")
def s06(t: Tables) -> DataFrame:
    return live.middle_row(t.hbp, "vehicle", ["event_id"]).select("vehicle", "event_id")


SAMPLE = """select trip_id, t, lat, lon from $pts where trip_id in (select trip_id from (select trip_id, count(*) over () as n,
  row_number() over (order by md5(concat(cast(trip_id as varchar), ':0')), trip_id) as r from (select distinct trip_id from $pts) a) b where r <= floor(n * 0.3::double))"""


@query("s07_sample_trips", SAMPLE)
def s07(t: Tables) -> DataFrame:
    return trips.sample_trips(t.pts, "trip_id", 0.3).select("trip_id", "t", "lat", "lon")


@query("u01_u06_union_all", "select cast(event_id as double) as v, 'h' as kind from $hbp where event_id % 2 = 0 union all select speed as v, 's' as kind from hbp where event_id % 2 = 1")
def u01(t: Tables) -> DataFrame:
    a = t.hbp.filter("event_id % 2 = 0").select(F.col("event_id").cast("double").alias("v"), F.lit("h").alias("kind"))
    return a.unionByName(t.hbp.filter("event_id % 2 = 1").select(F.lit("s").alias("kind"), F.col("speed").alias("v")))


@query("u02_union_distinct", "select concat('VEH', cast(v as varchar)) as id from (select vehicle as v from $hbp union select id % 30 as v from $fares) x")
def u02(t: Tables) -> DataFrame:
    v = t.hbp.select(F.col("vehicle").alias("v")).union(t.fares.select((F.col("id") % 30).alias("v"))).distinct()
    return v.select(F.concat(F.lit("VEH"), F.col("v").cast("string")).alias("id"))


@query("u03_u04_known_and_others", "select distinct meter_id as id, case when cast(substr(meter_id, 4) as int) < 12 then 'known' else 'Other' end as kind from $hb")
def u03(t: Tables) -> DataFrame:
    lists = t.spark.createDataFrame([("red", [f"VEH{i}" for i in range(8)]), ("green", [f"VEH{i}" for i in range(6, 12)])], "kind string, ids array<string>")
    known = lists.select(F.explode("ids").alias("id")).distinct()
    every = t.hb.select(F.col("meter_id").alias("id")).distinct()
    both = every.intersect(known).select("id", F.lit("known").alias("kind"))
    return both.unionByName(every.subtract(known).select("id", F.lit("Other").alias("kind")))


@query("u05_intersect", "select id from $fares where fare <= 700 intersect select id from fares where distance <= 20")
def u05(t: Tables) -> DataFrame:
    return t.fares.filter("fare <= 700").select("id").intersect(t.fares.filter("distance <= 20").select("id"))


@query("f01_pad_milliseconds", """select event_id, case event_id % 4 when 0 then '2025-02-28 16:00:01.000 UTC' when 1 then '2025-02-28 16:00:01.500 UTC' when 2 then '2025-02-28 16:00:01.250 UTC' else '2025-02-28 16:00:01.123 UTC' end as fixed from $hbp""")
def f01(t: Tables) -> DataFrame:
    k = F.col("event_id") % 4
    raw = F.concat(F.lit("2025-02-28 16:00:01"), F.when(k == 0, "").when(k == 1, ".5").when(k == 2, ".25").otherwise(".123"), F.lit(" UTC"))
    return t.hbp.select("event_id", tx.pad_milliseconds(raw).alias("fixed"))


@query("f02_f03_f06_parse_times", """select event_id, case event_id % 5 when 0 then null else 1740758400 + event_id % 60 end as seconds from $hbp""")
def f02(t: Tables) -> DataFrame:
    k, two = F.col("event_id") % 5, F.lpad((F.col("event_id") % 60).cast("string"), 2, "0")
    raw = F.when(k == 0, F.lit("never")).when(k == 1, F.concat(F.lit("2025-02-28T16:00:"), two, F.lit("Z"))).when(k == 2, F.concat(F.lit("2025-02-28 16:00:"), two, F.lit(".5 UTC"))).otherwise(F.concat(F.lit("2025-02-28 16:00:"), two))
    return t.hbp.select("event_id", ts.epoch_seconds(ts.parse_time(raw)).alias("seconds"))


@query("f04_f28_time_slot", """select event_id, cast(dayofweek(server_time) * 288 + hour(server_time) * 12 + minute(server_time) // 5 as int) as slot, cast(hour(server_time) as int) as slot_hour from $hb""")
def f04(t: Tables) -> DataFrame:
    return t.hb.select("event_id", ts.slot(F.col("server_time")).alias("slot"), ts.slot_hour(ts.slot(F.col("server_time"))).alias("slot_hour"))


@query("f05_time_value", "select event_id, cast(round_even((epoch_us(server_time) - epoch_us(timestamp '2024-01-01 00:00:00')) / 1000000::double + 28800, 0) as bigint) as time_value from $hb")
def f05(t: Tables) -> DataFrame:
    return t.hb.select("event_id", ts.time_value(F.col("server_time"), "2024-01-01 00:00:00", P.utc_shift_s).alias("time_value"))


@query("f07_iso_utc", "select event_id, strftime(make_timestamp(t * 1000000), '%Y-%m-%dT%H:%M:%SZ') as iso from $hbp")
def f07(t: Tables) -> DataFrame:
    return t.hbp.select("event_id", ts.iso_utc(F.col("t")).alias("iso"))


@query("f08_round_half_even", "select event_id, round_even(lat / 3, 5) as lat5 from $hbp")
def f08(t: Tables) -> DataFrame:
    return t.hbp.select("event_id", F.bround(F.col("lat") / 3, 5).alias("lat5"))


@query("f09_f10_f11_names", """select s_suppkey, cast(nullif(regexp_extract(s_name, '(\\d+)', 1), '') as int) as number, coalesce(lower(s_name) like '%supp%', false) as is_supp, concat('b_c_', cast(s_suppkey as varchar)) as tail from $supplier""")
def f09(t: Tables) -> DataFrame:
    path = F.concat(F.lit("/x/y/a_b_c_"), F.col("s_suppkey").cast("string"), F.lit(".parquet"))
    return t.supplier.select("s_suppkey", tx.first_number(F.col("s_name")).alias("number"), tx.contains_folded(F.col("s_name"), "SUPP").alias("is_supp"), tx.name_tail(path).alias("tail"))


@query("f12_is_missing", """select event_id, x is null or lower(x) in ('nan', 'none', 'inf', '-inf', '+inf', 'na', '') as missing, v is null or isnan(v) as missing_number from (select event_id,
  ['nan', 'None', 'INF', '-inf', '+Inf', 'NA', '', null, '1.5', 'name', ' nan ', 'infinity', 'n/a'][event_id % 13 + 1] as x, ['nan'::double, 'inf'::double, '-inf'::double, null, 0, 1.5][event_id % 6 + 1] as v from $hbp) a""")
def f12(t: Tables) -> DataFrame:
    """Every text that stands for a missing value, and some that don't: padded ones, and infinite numbers."""
    texts = F.array(*[F.lit(x) for x in ("nan", "None", "INF", "-inf", "+Inf", "NA", "", None, "1.5", "name", " nan ", "infinity", "n/a")])
    numbers = F.array(*[F.lit(x).cast("double") for x in (float("nan"), float("inf"), float("-inf"), None, 0.0, 1.5)])
    x, v = F.get(texts, (F.col("event_id") % 13).cast("int")), F.get(numbers, (F.col("event_id") % 6).cast("int"))
    return t.hbp.select("event_id", tx.is_missing(x).alias("missing"), tx.is_missing(v, numeric=True).alias("missing_number"))


@query("f26_f27_json_shapes", """select trip_id, concat('[', string_agg(concat('{"lat":', cast(event_id % 90 as varchar), ',"lon":', cast(event_id % 180 as varchar), '}'), ',' order by t, event_id), ']') as shape from $pts group by trip_id""")
def f26(t: Tables) -> DataFrame:
    rows = t.pts.select("trip_id", "t", "event_id", (F.col("event_id") % 90).alias("lat"), (F.col("event_id") % 180).alias("lon"))
    one = trips.traces(rows, "trip_id", "t", "event_id", "lat", "lon")
    return one.select("trip_id", F.to_json(F.transform("points", lambda p: F.struct(p["lat"].alias("lat"), p["lon"].alias("lon")))).alias("shape"))

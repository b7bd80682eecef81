"""Deterministic traffic tables over the driver's tables, the same text for Spark and DuckDB.

$div is integer division, 1000$d a double literal, $us(x) microseconds since 1970.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from roadloom.operators.trips import in_interval
from roadloom.session import ship

VIEWS: dict[str, str] = {
    # Heartbeats: 20 vehicles, 2 % without device time, some points out of the box and some impossible speeds.
    "hb": """select event_id, concat('VEH', cast(user_id % 20 as varchar(10))) as meter_id,
       concat('POINT(', cast((1137500 + (event_id * 7919) % 6000) $div 10000 as varchar(10)), '.',
              lpad(cast((1137500 + (event_id * 7919) % 6000) % 10000 as varchar(10)), 4, '0'), ' ',
              cast((219500 + (event_id * 104729) % 7000) $div 10000 as varchar(10)), '.',
              lpad(cast((219500 + (event_id * 104729) % 7000) % 10000 as varchar(10)), 4, '0'), ')') as location,
       (event_id * 37) % 360 as bearing, round(value / 3$d, 4) as speed,
       case when event_id % 50 = 0 then null else ts end as device_time, ts as server_time from $events""",
    # The same, parsed: positions as doubles, whole seconds.
    "hbp": """select event_id, user_id % 20 as vehicle, (1137500 + (event_id * 7919) % 6000) / 10000$d as lon,
       (219500 + (event_id * 104729) % 7000) / 10000$d as lat, round(value / 3$d, 4) as speed, $us(ts) $div 1000000 as t from $events""",
    # One trip per vehicle and day, 8 to 20 h, and an overlapping one from 10 to 14 h on every fifth day.
    "trips": """select vehicle, day, vehicle * 100000 + day as trip_id, day * 86400 + 28800 as start_s, day * 86400 + 72000 as end_s
       from (select distinct user_id % 20 as vehicle, $us(ts) $div 86400000000 as day from $events) a
       union all select vehicle, day, vehicle * 100000 + day + 50000 as trip_id, day * 86400 + 36000 as start_s, day * 86400 + 50400 as end_s
       from (select distinct user_id % 20 as vehicle, $us(ts) $div 86400000000 as day from $events) b where day % 5 = 0""",
    # Positions of trips, by time.
    "pts": """select t.trip_id, h.t, h.lat, h.lon, h.event_id, h.speed from $hbp h join $trips t on h.vehicle = t.vehicle and h.t between t.start_s and t.end_s""",
    # Trips with fares, distances and end points, some invalid.
    "fares": """select o_orderkey as id, concat('P', cast(o_custkey % 50 as varchar(10))) as plate, o_totalprice / 500$d as fare,
       case when o_orderkey % 41 = 0 then null else (o_custkey % 97) / 4$d + case when o_orderkey % 500 = 7 then 500$d else 0$d end end as distance,
       case when o_orderkey % 17 = 0 then 0$d else 22$d + (o_orderkey * 7919 % 600) / 1000$d end as s_lat,
       case when o_orderkey % 17 = 0 then 0$d else 113$d + (o_orderkey * 104729 % 1200) / 1000$d end as s_lon,
       case when o_orderkey % 11 = 0 then case when o_orderkey % 17 = 0 then 0$d else 22$d + (o_orderkey * 7919 % 600) / 1000$d end
            when o_orderkey % 19 = 0 then 22.5$d else 22$d + (o_orderkey * 611953 % 600) / 1000$d end as e_lat,
       case when o_orderkey % 11 = 0 then case when o_orderkey % 17 = 0 then 0$d else 113$d + (o_orderkey * 104729 % 1200) / 1000$d end
            when o_orderkey % 19 = 0 then 22.5$d else 113$d + (o_orderkey * 999983 % 1200) / 1000$d end as e_lon,
       $us(o_orderdate) $div 1000000 as start_s from $orders""",
    # Edge and slot speeds: 100 edges; a few slots of each week.
    "obs": """select l_suppkey % 100 as edge_no, (l_linenumber % 3) + (l_suppkey % 10) * 8 + (l_suppkey % 100) * 33554432 as graph_id,
       cast(l_orderkey % 2016 as int) as slot, l_quantity * 2$d as speed_kph, l_orderkey * 8 + l_linenumber as seq from $lineitem""",
    # Ways of four edges each; way 13 has none, edge 99 no way.
    "ways": """select edge_no, edge_no $div 4 as way_id from (select distinct l_suppkey % 100 as edge_no from $lineitem) e where edge_no < 99 and edge_no $div 4 <> 13""",
    "roads": """select s_suppkey as way_id, case s_nationkey % 5 when 0 then 'motorway' when 1 then 'primary' when 2 then 'secondary' when 3 then 'residential' else 'track' end as highway_type,
       case when s_suppkey % 7 = 0 then concat('North Tunnel ', cast(s_suppkey as varchar(10))) when s_suppkey % 11 = 0 then null else concat('Road ', cast(s_suppkey as varchar(10))) end as name from $supplier""",
}
TABLES = ["events", "orders", "lineitem", "supplier", "part", "customer", "nation", "region"]


def _render(text: str, duck: bool) -> str:
    text = text.replace("$div", "//" if duck else "div")
    text = re.sub(r"\$us\(([^()]*)\)", r"epoch_us(\1)" if duck else r"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', \1)", text)
    return text.replace("$d", "::DOUBLE" if duck else "D") if duck else re.sub(r"\$d\b", "D", text)


def names_in(text: str) -> list[str]:
    return [n for n in re.findall(r"\$(\w+)", text) if n in VIEWS or n in TABLES]


def oracle(body: str, ctes: str = "") -> str:
    """DuckDB SQL: the views that a query names with $, as common table expressions, before it."""
    need: list[str] = []

    def add(text: str) -> None:
        for n in names_in(text):
            if n in VIEWS and n not in need:
                add(VIEWS[n])
                need.append(n)

    add(ctes + body)
    plain = lambda t: re.sub(r"\$(" + "|".join([*VIEWS, *TABLES]) + r")\b", r"\1", _render(t, True))
    parts = [f"{n} AS MATERIALIZED ({plain(VIEWS[n])})" for n in need] + ([plain(ctes)] if ctes else [])
    return (f"WITH RECURSIVE {', '.join(parts)} " if parts else "") + plain(body)


class Tables:
    """The driver's tables and the views over them, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir, self.made = ship(spark), sf_dir, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in VIEWS and name not in TABLES:
            raise AttributeError(name)
        if name not in self.made:
            if name in TABLES:
                self.made[name] = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
            else:
                self.made[name] = self.sql(VIEWS[name])
        return self.made[name]

    def sql(self, text: str) -> DataFrame:
        need = {n: getattr(self, n) for n in names_in(text)}
        return self.spark.sql(re.sub(r"\$(" + "|".join([*VIEWS, *TABLES]) + r")\b", r"{\1}", _render(text, False)), **need)

    @cached_property
    def pts(self) -> DataFrame:
        """The view of that name by the bucketed interval join: a busy vehicle is spread over its hours."""
        found = in_interval(self.hbp, self.trips.select("vehicle", "trip_id", "start_s", "end_s"), "vehicle", "t", "start_s", "end_s")
        return found.select("trip_id", "t", "lat", "lon", "event_id", "speed")

    @cached_property
    def heartbeats(self) -> DataFrame:
        return self.hb

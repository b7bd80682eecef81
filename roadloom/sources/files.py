"""Readers of the traffic files. All take explicit schemas; bad values become nulls, not failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadloom.functions.graphid import parse_base
from roadloom.functions.text import number_or_zero, wkt_tokens
from roadloom.operators.clean import valid_for_conversion, valid_live
from roadloom.operators.trips import long_enough
from roadloom.params import Params

text_fields = lambda names: T.StructType([T.StructField(n, T.StringType()) for n in names.split()])
HEARTBEAT = text_fields("id f0_ location bearing speed device_time server_time")
TRIP = text_fields("id license_plate payment_type make model start_location end_location trip_start trip_end fare distance extra tip discount wait_time")
ROADS = "way_id long, highway_type string, name string"
TRACE = "trip_id string, t long, lat double, lon double"


def table_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A CSV table with a header; a missing path fails when it is named."""
    return spark.read.schema(schema).option("header", True).csv(path)


def parse_heartbeats(raw: DataFrame, p: Params = Params()) -> DataFrame:
    """Typed live records of raw text rows; rows that don't parse or fail the box and speed test go."""
    point, speed, bearing = wkt_tokens(F.col("location")), number_or_zero(F.col("speed")), number_or_zero(F.col("bearing"))
    typed = raw.select("id", F.col("f0_").alias("meter_id"), point["lon"].alias("lon"), point["lat"].alias("lat"), bearing.alias("bearing"), speed.alias("speed"), "device_time", "server_time")
    return typed.dropna(subset=["lon", "lat", "bearing", "speed"]).filter(valid_live(F.col("lat"), F.col("lon"), F.col("speed"), p))


def convert_heartbeats(raw: DataFrame, most: int = 0, order: str = "id", p: Params = Params()) -> DataFrame:
    """The converter's scan: the limit counts raw rows (by ``order``), before any test."""
    rows = raw.orderBy(order).limit(most) if most else raw
    point, speed = wkt_tokens(F.col("location")), number_or_zero(F.col("speed"))
    typed = rows.withColumns({"lon": point["lon"], "lat": point["lat"], "kph": speed})
    return typed.dropna(subset=["lon", "lat", "kph"]).filter(valid_for_conversion(F.col("lat"), F.col("lon"), F.col("kph"), p))


def heartbeat_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(HEARTBEAT).option("header", True).csv(path)


def traces_parquet(spark: SparkSession, path: str, least: int) -> DataFrame:
    """Points of all files under ``path`` (four columns only), of traces with at least ``least`` points."""
    return long_enough(spark.read.schema(TRACE).parquet(path), "trip_id", least)


def traces_ndjson(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema("trip_id string, points array<struct<t:long,lat:double,lon:double>>").json(path)
    return rows.select("trip_id", F.explode("points").alias("p")).select("trip_id", "p.*")


def way_edges(lines: DataFrame, strict: bool = False) -> DataFrame:
    """(edge_no, way_id) of lines way,(direction,edge)*. Strict: every field must be a number, and a later way takes an edge over (``line`` orders). Tolerant: short lines, ways and pairs that are no numbers go."""
    parts = F.split("value", ",")
    rows = lines.withColumn("f", parts).withColumn("way_id", F.get("f", F.lit(0)).cast("long") if strict else F.get("f", F.lit(0)).try_cast("long"))
    if not strict:
        rows = rows.filter((F.size("f") >= 3) & F.col("way_id").isNotNull())
    pairs = rows.filter(F.size("f") >= 3).select("line", "way_id", "f", F.explode(F.sequence(F.lit(1), F.size("f") - 2, F.lit(2))).alias("i"))
    number = lambda i: F.get("f", i).cast("long") if strict else F.get("f", i).try_cast("long")
    got = pairs.select("line", "i", "way_id", number(F.col("i")).alias("direction"), number(F.col("i") + 1).alias("edge_no"))
    if not strict:
        got = got.dropna(subset=["direction", "edge_no"])
    return got.groupBy("edge_no").agg(F.max_by("way_id", F.struct("line", "i")).alias("way_id"))


def first_line_with(lines: DataFrame, needle: str) -> DataFrame:
    """The first line that contains a text anywhere."""
    return lines.filter(F.contains("value", F.lit(needle))).orderBy("line").limit(1)


def json_map(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of a file that is one JSON object of texts."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(F.from_json("value", "map<string,string>"))).toDF("key", "value")


def edge_speed_lines(lines: DataFrame) -> DataFrame:
    """(line, tile, edge_index, speed_kph, congestion) of lines key,edge,speed[,congestion]; blank and # lines and bad ones go; congestion is 1 by default."""
    real = lines.filter((F.trim("value") != "") & ~F.startswith(F.trim("value"), F.lit("#")))
    f = lambda i: F.trim(F.get(F.split("value", ","), F.lit(i)))
    rows = real.select("line", parse_base(f(0)).alias("tile"), f(1).try_cast("int").alias("edge_index"), f(2).try_cast("float").alias("speed_kph"), F.coalesce(f(3).try_cast("int"), F.lit(1)).alias("congestion"))
    return rows.dropna(subset=["tile", "edge_index", "speed_kph"])


def edge_specs(spark: SparkSession, tokens: list[str]) -> DataFrame:
    """Edges given on a command line: tile edge speed [congestion]; a fourth token that is a number is the congestion."""
    out, at = [], 0
    while at + 3 <= len(tokens):
        more = at + 3 < len(tokens) and tokens[at + 3].isdigit()
        out.append((len(out), ",".join(tokens[at : at + 3 + more])))
        at += 3 + more
    return edge_speed_lines(spark.createDataFrame(out, "line int, value string"))


def numbered(lines: DataFrame, order: Column | str) -> DataFrame:
    """Adds ``line`` numbers by an explicit order (small tables)."""
    return lines.withColumn("line", F.row_number().over(Window.orderBy(order)))

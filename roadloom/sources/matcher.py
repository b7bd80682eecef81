"""Map matching and snapping behind one interface: an external service, or recorded responses."""

from __future__ import annotations

import json
import time
import urllib.request
from abc import ABC, abstractmethod
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.functions.graphid import pseudo_edge

MATCHED = "matched_points array<struct<edge_index:int,type:string>>, edges array<struct<id:long,length:double>>"


class Matcher(ABC):
    @abstractmethod
    def match(self, traces: DataFrame) -> DataFrame:
        """(trip_id, matched_points, edges) for traces (trip_id, points); those without an answer are left out."""


class RecordedMatcher(Matcher):
    """Answers from a table (trip_id, response JSON)."""

    def __init__(self, responses: DataFrame):
        self.responses = responses

    def match(self, traces: DataFrame) -> DataFrame:
        parsed = self.responses.select("trip_id", F.from_json("response", MATCHED).alias("r"))
        return traces.join(parsed.dropDuplicates(["trip_id"]), "trip_id").select("trip_id", "r.*").filter("matched_points is not null")


def post(url: str, body: str, timeout_s: float, tries: int, wait_s: float) -> str | None:
    """The response text, or None after ``tries`` failures; waits grow linearly."""
    for attempt in range(1, tries + 1):
        try:
            request = urllib.request.Request(url, body.encode(), {"Content-Type": "application/json"})
            with urllib.request.urlopen(request, timeout=timeout_s) as answer:
                return answer.read().decode()
        except (OSError, ValueError):
            if attempt < tries:
                time.sleep(wait_s * attempt)
    return None


def _ask(url: str, timeout_s: float, tries: int, wait_s: float, pause_s: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        answers = []
        for body in batch.column("body").to_pylist():
            answers.append(post(url, body, timeout_s, tries, wait_s))
            time.sleep(pause_s)
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(answers, pa.string())], names=["key", "response"])


def ask(requests: DataFrame, url: str, timeout_s: float, tries: int, wait_s: float, pause_s: float = 0.0) -> DataFrame:
    """(key, response) of (key, body), asked from the tasks: the number of partitions bounds the requests at a time, ``pause_s`` the pace of each. The response is null where all tries failed."""
    kind = requests.schema["key"].dataType.simpleString()
    return requests.select("key", "body").mapInArrow(partial(_ask, url, timeout_s, tries, wait_s, pause_s), f"key {kind}, response string")


class HttpMatcher(Matcher):
    """Asks a service for each trace."""

    def __init__(self, url: str, timeout_s: float = 30, tries: int = 3, wait_s: float = 1.0):
        self.ask = partial(ask, url=url, timeout_s=timeout_s, tries=tries, wait_s=wait_s)

    def match(self, traces: DataFrame) -> DataFrame:
        shape = F.transform("points", lambda p: F.struct(p["lat"].alias("lat"), p["lon"].alias("lon")))
        body = F.to_json(F.struct(shape.alias("shape"), F.lit("auto").alias("costing"), F.lit("map_snap").alias("shape_match")))
        answers = self.ask(traces.select(F.col("trip_id").alias("key"), body.alias("body"))).withColumnRenamed("key", "trip_id")
        return RecordedMatcher(answers.filter("response is not null")).match(traces.select("trip_id"))


def parse_snap(response):
    """Column: the first edge's graph id in a snap response of the newer ([{edges:[{edge_id:{value}}]}]) or older ([{edges:[{id}]}]) form."""
    v = F.try_parse_json(response)
    newer = F.try_variant_get(v, "$[0].edges[0].edge_id.value", "long")
    return F.coalesce(newer, F.try_variant_get(v, "$[0].edges[0].id", "long"))


def snap(points: DataFrame, key: str, url: str, timeout_s: float = 30, tries: int = 3, wait_s: float = 1.0, pause_s: float = 0.0) -> DataFrame:
    """(key, edge_id) of points (key, lat, lon): the nearest edge that a service names for each different position, which is asked once. Points without an answer are left out."""
    where = F.struct("lat", "lon")
    body = F.to_json(F.struct(F.array(where).alias("locations"), F.lit("auto").alias("costing"), F.lit(True).alias("verbose")))
    asked = points.select(key, body.alias("body")).filter("lat is not null and lon is not null")
    answers = ask(asked.select("body").distinct().select(F.col("body").alias("key"), "body"), url, timeout_s, tries, wait_s, pause_s)
    edges = answers.select(F.col("key").alias("body"), parse_snap(F.col("response")).alias("edge_id")).filter("edge_id is not null")
    return asked.join(edges, "body").select(key, "edge_id")


def pseudo_match(points: DataFrame, least_reliable: int = 7) -> DataFrame:
    """Recorded responses for tests: (trip_id, response) from traces (trip_id, points), by the pseudo edge function. Every ``least_reliable``-th point is unmatched."""
    edges = F.transform("points", lambda p: F.struct(pseudo_edge(p["lat"], p["lon"]).cast("long").alias("id"), F.lit(1.0).alias("length")))
    matched = F.transform("points", lambda p, i: F.struct(i.cast("int").alias("edge_index"), F.when(p["event_id"] % least_reliable == 0, "unmatched").otherwise("matched").alias("type")))
    return points.select("trip_id", F.to_json(F.struct(matched.alias("matched_points"), edges.alias("edges"))).alias("response"))


def dumps(value: object) -> str:
    return json.dumps(value, separators=(",", ":"))

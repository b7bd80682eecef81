"""Operators against plain re-derivations, edge cases, archives and streams."""

import json
import os
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadloom.operators import clean, live, profiles, speeds, trips
from roadloom.params import Params
from roadloom.plans import batch
from roadloom.sinks import files as sinks
from roadloom.sources import files as src
from roadloom.sources import matcher
from roadloom.sources.tiles import TileTar, decode_tile
from roadloom.streaming import live as stream


def test_interval_ends_and_overlaps(spark):
    points = spark.createDataFrame([(1, 0), (1, 10), (1, 20), (1, 21), (2, 5), (None, 5), (1, 50_000)], "v int, t long")
    t = spark.createDataFrame([(1, 10, 20, "a"), (1, 15, 30, "b"), (1, 0, 100_000, "long"), (1, 9, 3, "backwards")], "v int, s long, e long, name string")
    got = sorted((r.t, r.name) for r in trips.in_interval(points, t, "v", "t", "s", "e").collect())
    assert got == [(0, "long"), (10, "a"), (10, "long"), (20, "a"), (20, "b"), (20, "long"), (21, "b"), (21, "long"), (50_000, "long")]
    assert trips.hired(points, t.filter("name in ('a', 'b')"), "v", "t", "s", "e").count() == 3


def test_gap_and_dip(spark):
    rows = [("x", 0, 22.0, 114.0), ("x", 10, 22.001, 114.0), ("x", 20, 22.0011, 114.0), ("x", 30, 22.0021, 114.0), ("x", 40, 22.0022, 114.0), ("x", 51, 22.01, 114.0), ("x", 51, 22.02, 114.0)]
    p = spark.createDataFrame(rows, "k string, t long, lat double, lon double")
    got = speeds.trace_speeds(p, "k", Params(), ["lat"]).orderBy("t", "lat").collect()
    assert [r.t for r in got] == [0, 10, 20, 30, 40, 51]  # 11 s after the one before goes, standing still stays
    by = {(r.t, round(r.lat, 4)): r for r in got}
    assert by[(0, 22.0)].speed_kph == 0
    dip = by[(20, 22.0011)]
    assert dip.speed_kph == pytest.approx((by[(10, 22.001)].raw_kph + by[(30, 22.0021)].raw_kph) / 2)
    assert by[(51, 22.02)].raw_kph is None and by[(51, 22.02)].speed_kph is None


def test_min_points(spark):
    p = spark.createDataFrame([("a", i) for i in range(10)] + [("b", i) for i in range(9)], "k string, t int")
    assert {r.k for r in trips.long_enough(p, "k", 10).collect()} == {"a"}


def naive_fill(obs, k, n):
    d = {t: list(v) for t, v in obs.items()}
    for t in range(n):
        if t not in d:
            near = [v for s in range(max(0, t - k), min(n - 1, t + k) + 1) if s in d for v in d[s]]
            if near:
                d[t] = [sum(near) / len(near)]
    return {t: sum(v) / len(v) for t, v in d.items()}


def test_fill(spark):
    rng = np.random.default_rng(0)
    weeks = {e: {int(s): rng.uniform(5, 90, rng.integers(1, 4)).tolist() for s in rng.choice(2016, m, replace=False)} for e, m in ((1, 1), (2, 30), (3, 900), (4, 2016))}
    rows = [(e, s, v) for e, w in weeks.items() for s, vs in w.items() for v in vs] + [(1, 2016, 5.0), (1, -1, 5.0)]
    obs = spark.createDataFrame(rows, "e long, s int, v double")
    got = {}
    for r in profiles.fill_temporal(obs, "e", "s", "v", 3).collect():
        got.setdefault(r.e, {})[r.slot] = r.speed_kph
    for e, w in weeks.items():
        want = naive_fill(w, 3, 2016)
        assert got[e].keys() == want.keys()
        assert all(abs(got[e][s] - want[s]) < 1e-9 for s in want)


def test_fill_fold_equals_matrix(spark):
    obs = spark.createDataFrame([(1, 4, 10.0), (1, 4, 20.0), (1, 9, 40.0), (2, 0, 7.0)], "e long, s int, v double")
    fold = {(r.e, r.slot): (round(r.speed_kph, 9), r.filled) for r in profiles.fill_fold(obs, "e", "s", "v", 2, slots=20).collect()}
    full = {(r.e, r.slot): (round(r.speed_kph, 9), r.filled) for r in profiles.fill_temporal(obs, "e", "s", "v", 2).filter("slot < 20").collect()}
    assert fold == full


def test_hampel_by_definition():
    rng = np.random.default_rng(2)
    x = np.where(rng.random((3, 60)) < 0.1, 120.0, rng.normal(40, 3, (3, 60)))
    got = profiles.hampel(x, 7, 2.5, 1.4826)
    for i in range(3):
        for t in range(60):
            c = min(max(t, 3), 56)
            w = x[i, c - 3 : c + 4]
            m = np.median(w)
            want = m if abs(x[i, t] - m) > 2.5 * 1.4826 * np.median(np.abs(w - m)) else x[i, t]
            assert got[i, t] == np.float32(want)


def test_hampel():
    x = np.full((1, 40), 50.0)
    x[0, [0, 20, 39]] = 500
    assert (profiles.hampel(x, 15, 2.5, 1.4826) == 50).all()
    short = np.arange(10.0)[None, :]
    assert (profiles.hampel(short, 15, 2.5, 1.4826) == short).all()
    with pytest.raises(ValueError):
        profiles.hampel(x, 4, 2.5, 1.4826)


def test_trimmed_means_of_equal_speeds(spark):
    obs = spark.createDataFrame([(1, 0, 30.0)] * 5 + [(1, 1, 10.0), (1, 1, 11.0), (1, 1, 12.0), (1, 1, 500.0)], "e int, s int, v double")
    got = {r.s: r.speed_kph for r in profiles.trimmed_means(obs, "e", "s", "v", 1.5).collect()}
    assert got == {0: 30.0, 1: 11.0}


def test_edges_without_way(spark):
    e = spark.createDataFrame([(1,), (2,), (3,)], "edge_no long")
    w = spark.createDataFrame([(1, 10), (2, 11)], "edge_no long, way_id long")
    r = spark.createDataFrame([(10, "primary", None)], "way_id long, highway_type string, name string")
    assert sorted((x.edge_no, x.highway_type) for x in profiles.edge_types(e, w, r, strict=False).collect()) == [(1, "primary"), (2, "unknown")]
    with pytest.raises(Exception, match="edge without way"):
        profiles.edge_types(e, w, r, strict=True).collect()


def test_missing_values_fail(spark):
    df = spark.createDataFrame([("a",), (None,)], "x string")
    with pytest.raises(Exception, match="missing value"):
        clean.assert_complete(df, ["x"]).collect()


def test_way_edges(spark):
    lines = spark.createDataFrame([(1, "7,0,1,1,2"), (2, "8,0,1"), (3, "bad,0,5"), (4, "9"), (5, "9,x,6,0,7"), (6, "")], "line int, value string")
    assert sorted((r.edge_no, r.way_id) for r in src.way_edges(lines).collect()) == [(1, 8), (2, 7), (7, 9)]
    with pytest.raises(Exception):  # noqa: B017
        src.way_edges(lines, strict=True).collect()


def test_edge_specs(spark):
    got = [(r.tile, r.edge_index, r.speed_kph, r.congestion) for r in src.edge_specs(spark, "2/7/0 1 40 2/8/0 2 50 9".split()).orderBy("line").collect()]
    assert got == [(58, 1, 40.0, 1), (66, 2, 50.0, 9)]
    # A bare tile number after three tokens reads as a congestion.
    assert src.edge_specs(spark, "58 1 40 66 2 50".split()).count() == 1


def test_missing_file(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        src.table_csv(spark, str(tmp_path / "none.csv"), src.HEARTBEAT)


def test_sampling_repeats_itself(spark):
    p = spark.createDataFrame([(i % 20, i) for i in range(200)], "k int, t int")
    a, b = (sorted(r.t for r in trips.sample_trips(p, "k", 0.33).collect()) for _ in range(2))
    assert a == b and len({x % 20 for x in a}) == 6


def test_one_writer_at_a_time(tmp_path):
    import os

    folder = str(tmp_path)
    with sinks.single_writer(folder), pytest.raises(sinks.Busy), sinks.single_writer(folder):
        pass
    (tmp_path / "writer.lock").touch()
    os.utime(tmp_path / "writer.lock", (0, 0))
    with sinks.single_writer(folder):
        pass
    assert not (tmp_path / "writer.lock").exists()


def test_publish_swaps(spark, tmp_path):
    folder = str(tmp_path / "live")
    tile = live.constant_tile(spark, 7, 100, 20)
    first = sinks.publish(tile, folder, updated=1)
    assert os.readlink(f"{folder}/current") == os.path.basename(first)
    held = open(first, "rb").read()
    second = sinks.publish(live.upsert_constant(tile, 33), folder, updated=2)
    assert second != first and os.readlink(f"{folder}/current") == os.path.basename(second)
    assert open(first, "rb").read() == held  # a reader of the old archive is not disturbed
    assert sinks.publish(tile.filter("false"), folder) is None
    assert os.readlink(f"{folder}/current") == os.path.basename(second)
    spark.dataSource.register(TileTar)
    rows = spark.read.format("tile_tar").load(second).collect()
    assert len(rows) == 100 and {r.last_update for r in rows} == {2} and {r.record & 127 for r in rows} == {33}


def test_tile_bytes(spark):
    blob = sinks.tile_blobs(live.constant_tile(spark, 9, 3, 45), updated=5).first()
    assert blob.member == "00009.gph" and len(blob.blob) == 32 + 3 * 8 + 8
    tile, updated, version, records = decode_tile(bytes(blob.blob))
    assert (tile, updated, version, [int(r) & 127 for r in records]) == (9, 5, 4, [45, 45, 45])


def test_tile_csv_files(spark, tmp_path):
    rows = spark.createDataFrame([("2/003/015.csv", 1, "b"), ("2/003/015.csv", 0, "a"), ("0/001.csv", 0, "c")], "file_path string, edge_in_tile long, line string")
    assert sorted(map(tuple, sinks.write_tile_csv(rows, str(tmp_path)).collect())) == [("0/001.csv", 1), ("2/003/015.csv", 2)]
    assert (tmp_path / "2/003/015.csv").read_text() == "a\nb\n"


class Service(BaseHTTPRequestHandler):
    seen: list = []

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        Service.seen.append(body)
        fail = len(body["shape"]) == 1
        answer = json.dumps({"matched_points": [{"edge_index": 0, "type": "matched"}] * len(body["shape"]), "edges": [{"id": 5, "length": 1.5}]})
        self.send_response(500 if fail else 200)
        self.end_headers()
        self.wfile.write(b"" if fail else answer.encode())

    def log_message(self, *args):
        pass


def test_http_matcher(spark):
    server = HTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    rows = spark.createDataFrame([("a", 1, 22.0, 114.0), ("a", 2, 22.1, 114.1), ("b", 1, 22.0, 114.0)], "trip_id string, t long, lat double, lon double")
    m = matcher.HttpMatcher(f"http://127.0.0.1:{server.server_port}/trace", timeout_s=5, tries=2, wait_s=0.01)
    got = m.match(trips.traces(rows, "trip_id", "t", "lat", "lon")).collect()
    server.shutdown()
    assert [(r.trip_id, len(r.matched_points), r.edges[0].id) for r in got] == [("a", 2, 5)]
    assert {x["costing"] for x in Service.seen} == {"auto"}


class Snapper(BaseHTTPRequestHandler):
    seen: list = []

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        Snapper.seen.append(body)
        lat = body["locations"][0]["lat"]
        again = sum(b == body for b in Snapper.seen) > 1
        # 22: the newer form; 23: the older one, at the second try; 24: no edge; 25: never an answer.
        answer = {22.0: [{"edges": [{"edge_id": {"value": 7}}]}], 23.0: [{"edges": [{"id": 8}]}], 24.0: [{"edges": []}]}.get(lat)
        self.send_response(500 if answer is None or lat == 23.0 and not again else 200)
        self.end_headers()
        self.wfile.write(json.dumps(answer).encode() if answer is not None else b"")

    def log_message(self, *args):
        pass


def test_http_snap(spark):
    server = HTTPServer(("127.0.0.1", 0), Snapper)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    rows = [(1, 22.0, 114.0), (2, 22.0, 114.0), (3, 23.0, 114.0), (4, 24.0, 114.0), (5, 25.0, 114.0), (6, None, 114.0)]
    points = spark.createDataFrame(rows, "event_id long, lat double, lon double")
    got = matcher.snap(points, "event_id", f"http://127.0.0.1:{server.server_port}/locate", timeout_s=5, tries=2, wait_s=0.01, pause_s=0.01).collect()
    server.shutdown()
    assert sorted(map(tuple, got)) == [(1, 7), (2, 7), (3, 8)]
    assert sorted(b["locations"][0]["lat"] for b in Snapper.seen) == [22.0, 23.0, 23.0, 24.0, 25.0, 25.0]
    assert all(b["verbose"] is True for b in Snapper.seen)


def test_exact_state_stream(spark, tmp_path):
    p = Params(window_s=60)
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(1, 0.0, 10.0), (1, 30.0, 20.0)], "edge int, t double, speed double").coalesce(1).write.parquet(path)
    q = stream.publish_each(stream.exact_state(spark.readStream.schema("edge int, t double, speed double").parquet(path), p), str(tmp_path / "c"), lambda df, i: df.write.mode("overwrite").parquet(f"{out}/batch={i}"))
    run = lambda: q.trigger(availableNow=True).start().awaitTermination()
    run()
    spark.createDataFrame([(1, 61.0, 40.0)], "edge int, t double, speed double").coalesce(1).write.mode("append").parquet(path)
    run()
    got = {r.now: (round(r.speed_kph, 6), r.samples) for r in spark.read.parquet(out).collect()}
    w = max(0.1, 1 - 31 / 60)
    assert got == {30.0: (round((0.5 * 10 + 20) / 1.5, 6), 2), 61.0: (round((w * 20 + 40) / (w + 1), 6), 2)}


def test_exact_state_drops_silent_edges(spark, tmp_path):
    """An edge without samples for a window of event time has no state left; one that goes on has."""
    p = Params(window_s=60)
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    kind = "edge int, t double, speed double"
    for rows in ([(1, 0.0, 10.0), (2, 0.0, 10.0)], [(2, 300.0, 20.0)], [(1, 301.0, 30.0)]):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(path)
        q = stream.publish_each(stream.exact_state(spark.readStream.schema(kind).parquet(path), p), str(tmp_path / "c"), lambda df, i: df.write.mode("overwrite").parquet(f"{out}/batch={i}")).trigger(availableNow=True).start()
        q.awaitTermination()
        alive = q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
        assert alive == (2 if rows[0][1] != 300.0 else 1)
    assert {(r.edge, r.now, r.samples) for r in spark.read.parquet(out).collect()} == {(1, 0.0, 1), (2, 0.0, 1), (2, 300.0, 1), (1, 301.0, 1)}


def test_toggles(spark):
    hb = spark.createDataFrame([(1, 0, 22.0, 114.0, 1)], "vehicle long, t long, lat double, lon double, event_id long")
    t = spark.createDataFrame([(1, 1, 0, 10)], "vehicle long, trip_id long, start_s long, end_s long")
    m = lambda traces: matcher.RecordedMatcher(matcher.pseudo_match(traces))
    state = batch.run({"heartbeats": hb, "trips": t}, m, Params(min_points=1), {"fill": False, "profiles": False})
    assert set(state.frames) == {"heartbeats", "trips", "points", "matched", "edge_speeds"}
    state.frames["points"].collect()
    assert state.observed["clean"].get["rows"] == 1
    with pytest.raises(ValueError, match="needs points"):
        batch.run({"heartbeats": hb, "trips": t}, m, Params(), {"clean": False})


def test_global_orders(spark):
    import random

    from roadloom.operators import ranking

    rng = random.Random(0)
    rows = [(i, rng.choice("ab") if i % 50 else None, float(rng.randrange(40))) for i in range(500)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "i int, k string, v double")
    assert {(r.i, r.number) for r in ranking.numbered(df, ["i"]).collect()} == {(i, i + 1) for i in range(500)}
    run, last, want = 0, object(), {}
    for i, k, _ in sorted(rows, key=lambda r: r[0]):
        run += k != last
        want[i], last = run, k
    assert {r.i: r.run for r in ranking.runs(df, "k", "i").collect()} == want
    at = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    for f in (ranking.quantiles, ranking.ranged_quantiles):
        assert f(df, "v", at) == pytest.approx(np.quantile([r[2] for r in rows], at).tolist())
        assert f(df.filter("false"), "v", [0.5]) == [None]


def test_heartbeat_file_stream(spark, tmp_path):
    """A CSV feed, parsed and drained, gives the rows of the batch reader."""
    rows = [("1", "m", "POINT(114.0 22.3)", "1", "30", "2025-02-28 16:00:00", None), ("2", "m", "POINT(114.0)", "1", "30", None, None), ("3", "m", "POINT(114.0 23.3)", "", "", None, None), ("4", "n", "POINT(114.1 22.4)", "", "", None, None)]
    path = str(tmp_path / "feed")
    spark.createDataFrame(rows, src.HEARTBEAT).write.option("header", True).csv(path)
    want = sorted(map(str, src.parse_heartbeats(src.table_csv(spark, path, src.HEARTBEAT)).collect()))
    stream.run_once(src.parse_heartbeats(src.heartbeat_stream(spark, path)), str(tmp_path / "c"), str(tmp_path / "out"))
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "out")).collect())) == want
    assert len(want) == 2


def test_late_samples_close_windows(spark, tmp_path):
    """A sample older than the watermark is left out; windows are given out once."""
    from pyspark.sql import functions as F

    p = Params(window_s=60, interval_s=60)
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    put = lambda rows, n: spark.createDataFrame(rows, "edge int, speed double, s long").select("edge", "speed", F.timestamp_seconds("s").alias("ts")).coalesce(1).write.parquet(f"{path}/{n}")
    feed = lambda: spark.readStream.schema("edge int, speed double, ts timestamp").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(path)
    for n, rows in enumerate([[(1, 30.0, 10), (1, 50.0, 40)], [(1, 20.0, 1000)], [(1, 99.0, 15), (1, 20.0, 2000)], [(1, 20.0, 3000)]]):
        put(rows, n)
        stream.run_once(stream.windowed_speeds(feed(), p), str(tmp_path / "c"), out)
    got = {r.window_end: (r.speed_kph, r.samples) for r in spark.read.parquet(out).collect()}
    assert set(got) >= {60, 1020}
    w = [max(0.1, 1 - 50 / 60), 1 - 20 / 60]
    assert got[60] == (pytest.approx((w[0] * 30 + w[1] * 50) / sum(w)), 2)

"""Golden values of single functions, and round trips."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadloom.functions import encode, geo, graphid
from roadloom.functions import text as tx
from roadloom.functions import timeslot as ts
from roadloom.functions import traffic_bits as bits
from roadloom.operators import live


def values(spark, rows, schema, **columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*[c.alias(n) for n, c in columns.items()]).collect()]


def test_speed_encoding(spark):
    cases = [(0.0, 0), (4.5, 4), (45.5, 44), (60.0, 60), (120.0, 120), (254.0, 252), (300.0, 252)]
    got = values(spark, [(v,) for v, _ in cases], "v double", d=bits.decode_speed(bits.encode_speed(F.col("v"))))
    assert [g[0] for g in got] == [d for _, d in cases]
    assert values(spark, [(254.0,)], "v double", d=bits.encode_speed(F.col("v"), 127)) == [(127,)]
    assert values(spark, [(70,), (0,), (63,), (64,)], "c int", d=bits.clamp_congestion(F.col("c"), 1)) == [(63,), (1,), (63,), (63,)]


def test_record_fields(spark):
    r = bits.record(F.lit(60), F.lit(63))
    got = values(spark, [(1,)], "x int", overall=bits.unpack(r, "overall"), b=bits.unpack(r, "breakpoint2"), c=bits.unpack(r, "congestion3"), i=bits.unpack(r, "incidents"), ok=bits.speed_valid(r), bad=bits.speed_valid(bits.invalid()), shut=bits.closed(bits.record(F.lit(0), F.lit(1))))
    assert got == [(60, 255, 63, 0, True, False, True)]


@pytest.mark.parametrize(("level", "tile", "index"), [(0, 3381, 0), (0, 3381, 15), (0, 647736, 5), (1, 47701, 23), (2, 3015, 0)])
def test_graph_ids(spark, level, tile, index):
    g = graphid.pack(F.lit(level), F.lit(tile), F.lit(index))
    assert values(spark, [(1,)], "x int", a=graphid.level(g), b=graphid.tile(g), c=graphid.index(g), n=graphid.name(g)) == [(level, tile, index, f"{level}/{tile}/{index}")]


def test_tile_names(spark):
    got = values(spark, [("2/647736/0",), ("5181890",), ("x/1/0",), ("",)], "k string", v=graphid.parse_base(F.col("k")))
    assert got == [(5181890,), (5181890,), (None,), (None,)]
    got = values(spark, [(3015,), (7,), (1234567,)], "t int", p=graphid.tile_path(F.lit(0), F.col("t")), m=graphid.member_name(F.col("t")))
    assert got == [("0/003/015.csv", "03015.gph"), ("0/007.csv", "00007.gph"), ("0/001/234/567.csv", "1234567.gph")]


def test_points_and_numbers(spark):
    rows = [("POINT(114.1 22.3)",), ("POINT(114.1)",), ("x",), (None,), ("POINT(a b)",), ("POINT(1 2 3)",)]
    p, q = tx.wkt_point(F.col("s")), tx.wkt_tokens(F.col("s"))
    got = values(spark, rows, "s string", lon=p["lon"], lat=p["lat"], strict=q["lat"])
    assert got == [(114.1, 22.3, 22.3), (None, None, None), (None, None, None), (None, None, None), (None, None, None), (None, None, None)]
    assert values(spark, [("",), ("4.5",), ("x",), (None,)], "s string", v=tx.number_or_zero(F.col("s"))) == [(0.0,), (4.5,), (None,), (0.0,)]


def test_milliseconds(spark):
    rows = ["2025-02-28 16:00:01 UTC", "2025-02-28 16:00:01.5 UTC", "2025-02-28 16:00:01.25 UTC", "2025-02-28 16:00:01.125 UTC", "other", None]
    got = [g[0] for g in values(spark, [(r,) for r in rows], "s string", v=tx.pad_milliseconds(F.col("s")))]
    assert got == ["2025-02-28 16:00:01.000 UTC", "2025-02-28 16:00:01.500 UTC", "2025-02-28 16:00:01.250 UTC", "2025-02-28 16:00:01.125 UTC", "other", None]


def test_slots(spark):
    t = F.col("s").cast("timestamp_ntz")
    rows = [("2024-01-07 00:00:00",), ("2024-01-07 00:05:00",), ("2024-01-06 23:59:59",)]
    assert values(spark, rows, "s string", a=ts.slot(t), b=ts.slot_of_epoch(ts.epoch_seconds(t))) == [(0, 0), (1, 1), (2015, 2015)]
    assert values(spark, [("2025-02-03 00:00:00.5",), ("2025-02-03 00:00:01.5",)], "s string", v=ts.time_value(t, "2025-02-03 00:00:00", 28800)) == [(28800,), (28802,)]


def test_distance_matches_vectors(spark):
    points = [(22.3, 114.1, 22.4, 114.2), (22.3, 114.1, 22.3, 114.1), (-33.0, 151.0, 51.0, 0.0), (22.3, 114.1, 22.300001, 114.100001)]

    def unit(lat, lon):
        e2 = 1 - (1 - 1 / 298.257223563) ** 2
        phi, lam = np.radians(lat), np.radians(lon)
        n = 1 / np.sqrt(1 - e2 * np.sin(phi) ** 2)
        v = np.array([n * np.cos(phi) * np.cos(lam), n * np.cos(phi) * np.sin(lam), n * (1 - e2) * np.sin(phi)])
        return v / np.linalg.norm(v)

    got = [g[0] for g in values(spark, points, "a double, b double, c double, d double", v=geo.distance_km(F.col("a"), F.col("b"), F.col("c"), F.col("d")))]
    for (a, b, c, d), v in zip(points, got, strict=True):
        x, y = unit(a, b), unit(c, d)
        assert v == pytest.approx(np.arctan2(np.linalg.norm(np.cross(x, y)), x @ y) * 6378.1, abs=1e-6)


def test_fade_and_fusion(spark):
    ages = [(0,), (600,), (1800,), (3600,), (7200,)]
    assert [round(g[0], 2) for g in values(spark, ages, "a int", v=live.fade(F.col("a")))] == [1.0, 0.83, 0.5, 0.0, 0.0]
    kph = live.fused_speed(F.lit(None).cast("double"), F.lit(0), F.lit(1.0), F.lit(None).cast("double"), F.lit(40.0), F.lit(50.0), F.col("s"), 35.0)
    assert values(spark, [(7 * 3600,), (7 * 3600 - 1,), (19 * 3600,)], "s int", v=kph) == [(40.0,), (50.0,), (50.0,)]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.integers(-32768, 32767), min_size=200, max_size=200))
def test_profile_text_round_trip(coefficients):
    text = encode.to_text(np.array(coefficients, dtype=np.int16))
    assert len(text) == 536
    assert encode.from_text(text).tolist() == coefficients


def test_dct(spark):
    week = 40 + 10 * np.sin(np.arange(2016) * 2 * np.pi / 288)
    c = encode.compress(week[None, :])[0]
    assert np.abs(encode.decompress(c) - week).max() < 1.0  # 200 of 2016 coefficients are kept
    with pytest.raises(ValueError):
        encode.compress(np.zeros((1, 10)))
    rows = spark.createDataFrame([(week.astype(np.float32).astype(float).tolist(),)], "p array<double>")
    got = rows.select(encode.coefficients_of(F.col("p")).alias("c")).select("c", encode.pack_text(F.col("c")).alias("t")).first()
    assert got["c"] == c.tolist()
    assert got["t"] == encode.to_text(c)
